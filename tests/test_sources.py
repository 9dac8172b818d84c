"""Reader and sink behaviour not covered by the oracle queries."""

import os
import tempfile

from conftest import rows
from pitlane.sources import readers as RD
from pitlane.sources import sinks as SK


def test_landed_json_bad_rows(spark):
    d = tempfile.mkdtemp(prefix="pitlane-landed-")
    with open(os.path.join(d, "part.json"), "w") as f:
        f.write('{"GAME_ID": "1", "PTS": 100}\n{"GAME_ID": "2", "PTS": "abc"}\nnot json\n{"GAME_ID": "3"}\n')
    schema = "GAME_ID string, PTS int"
    keep = RD.read_landed(spark, d, schema, fmt="json")                      # PERMISSIVE: bad fields -> NULL
    drop = RD.read_landed(spark, d, schema, fmt="json", bad_rows="DROPMALFORMED")
    assert len(rows(keep)) == 4
    assert rows(drop) == [("1", 100), ("3", None)]


def test_snapshot_switch_keeps_old_version(spark):
    base = SK.scratch_dir(spark, "snap-test")
    v1 = SK.write_snapshot(spark.createDataFrame([(1,)], "x int"), base)
    SK.write_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), base)
    assert rows(SK.read_snapshot(spark, base)) == [(2,), (3,)]
    assert rows(spark.read.parquet(v1)) == [(1,)]       # the previous version is untouched
