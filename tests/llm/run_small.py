"""Run named queries on a small folder and print their shape: python tests/llm/run_small.py DIR NAME..."""

import sys
import time

sys.path.insert(0, "/root/repo")

import __spark_entry__ as E  # noqa: E402
from pitlane.session import LOCAL_TUNING, get_session  # noqa: E402

if __name__ == "__main__":
    spark = get_session("local[6]", extra={**LOCAL_TUNING, "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        began = time.time()
        df = E.queries()[name](spark, sys.argv[1])
        rows = df.toPandas()
        print(name, rows.shape, round(time.time() - began, 1), "s")
        print(rows.head(12).to_string()[:3000])
        print(rows.describe().to_string()[:2000])
