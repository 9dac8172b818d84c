"""Secret scans over an incremental blob ledger."""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.shared import stored, text_chunks

#: Kinds in their order where spans start alike: (kind, pattern, least length, group whose length counts).
#: The first three are the base kinds; the others are this operator's own. All are matched leftmost,
#: non-overlapping, within the kind. Fixed values.
RULES = (
    ("assign", r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 12, 2),
    ("access", r"AKIA[A-Z0-9]+", 18, 0),
    ("hex", r"[0-9a-f]{16,}", 16, 0),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}", 22, 0),
    ("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", 26, 0),
)
#: Lower-case byte strings, one of which stands in every text that the kind can match.
CUES = {"assign": (b"password", b"passwd", b"secret", b"token", b"api"), "access": (b"akia",), "forge": (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"),
        "chat": (b"xox",), "jwt": (b"eyj",), "pem": (b"-----begin",)}
#: Raised whenever RULES change: ledger entries of an older version don't count as seen.
RULES_VERSION = 1

FINDINGS = "array<struct<start:bigint,kind:int,end:bigint>>"
_LONG_HEX = re.compile(rb"[0-9a-f]{16,}")


def _rows_with(lowered: bytes, offsets, cues: tuple[bytes, ...]) -> set[int]:
    """Rows of the joined texts in which a cue stands (or seems to, across two rows)."""
    found: set[int] = set()
    ends = offsets[1:].tolist()
    for cue in cues:
        at = lowered.find(cue)
        while at >= 0:
            row = bisect.bisect_right(ends, at)
            found.add(row)
            at = lowered.find(cue, max(at + 1, ends[row] if row < len(ends) else len(lowered)))
    return found


def find_secrets(text: str, kinds: list[int], rules=RULES) -> list[tuple[int, int, int]]:
    """Spans (start, index of the kind, end) in code points, ordered."""
    spans = []
    for k in kinds:
        _, pattern, least, group = rules[k]
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                spans.append((m.start(), k, m.end()))
    return sorted(spans)


def _scan(batches, text_at: int, id_at: int):
    cued = [k for k, rule in enumerate(RULES) if rule[0] in CUES]
    hexes = [k for k, rule in enumerate(RULES) if rule[0] not in CUES]
    for batch in batches:
        texts = batch.column(text_at)
        found: list[list] = []
        for first, last, data, offsets in text_chunks(texts):
            lowered = data.tobytes().lower()
            kinds: dict[int, list[int]] = {}
            for k in cued:
                for row in _rows_with(lowered, offsets, CUES[RULES[k][0]]):
                    kinds.setdefault(row, []).append(k)
            ends = offsets[1:].tolist()
            for m in _LONG_HEX.finditer(lowered):  # a run may span rows: each row it touches is looked at
                row = bisect.bisect_right(ends, m.start())
                while row < len(ends) and (row == 0 or ends[row - 1] < m.end()):
                    if hexes[0] not in kinds.get(row, ()):
                        kinds.setdefault(row, []).extend(hexes)
                    row += 1
            for row in range(last - first):
                spans = find_secrets(texts[first + row].as_py() or "", kinds[row]) if row in kinds else []
                found.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(id_at), pa.array(found, kind)], ["blob", "findings"])


def scan_versions(versions: DataFrame, path_col: str, text_col: str, ledger: str | None = None) -> DataFrame:
    """Findings of every path: (path, blob, findings), one row for each row of `versions`.

    Every version's text is addressed by its content (SHA-256 of its UTF-8
    bytes). Only blobs that `ledger` (a Parquet folder that all executors share,
    or None for an empty one) doesn't hold under RULES_VERSION are scanned, once
    however many paths or versions hold them; their findings, also empty ones,
    are appended to it, and all findings are joined back to all paths.

    Of each unseen blob the row of the smallest path is picked by a small
    aggregate over digests, so a blob that a third of all paths share costs one
    scan and only its digest rows move. A null text counts as empty, a null path
    stays a row, repeated rows give repeated rows, an empty table an empty
    result; other columns of `versions` are ignored."""
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    spark = versions.sparkSession
    index = stored(rows.select("path", "blob"), "blobs")
    todo = index.groupBy("blob").agg(F.min("path").alias("least"))
    if ledger is not None and _exists(spark, ledger):
        seen = spark.read.parquet(ledger).where(F.col("rules_version") == RULES_VERSION)
        todo = todo.join(seen.select("blob"), "blob", "left_anti")
    unseen = rows.join(todo.hint("shuffle_hash").withColumnRenamed("blob", "todo"),
                       (F.col("blob") == F.col("todo")) & F.col("path").eqNullSafe(F.col("least")))
    fresh = unseen.select("blob", "text").mapInArrow(lambda it: _scan(it, 1, 0), f"blob binary, findings {FINDINGS}")
    if ledger is None:
        known = stored(fresh, "findings")
    else:
        fresh.withColumn("rules_version", F.lit(RULES_VERSION)).write.mode("append").parquet(ledger)
        known = spark.read.parquet(ledger).where(F.col("rules_version") == RULES_VERSION).select("blob", "findings")
    some = known.where(F.size("findings") > 0).dropDuplicates(["blob"])
    return index.join(some, "blob", "left").select("path", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def _exists(spark, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def secret_digest(found: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """The contract's columns from `scan_versions`: counts and digest of the base kinds, all spans as text."""
    names = F.array(*[F.lit(r[0]) for r in RULES])
    spell = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    base = F.filter("findings", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("findings", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("path").alias(id_name), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(F.encode(spell(base), "UTF-8"), 256).alias("base_sha256"), spell(F.col("findings")).alias("spans"))
