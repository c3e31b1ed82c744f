"""Command line: compare all or the named queries. Prints one line per query."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as e  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main():
    from pyspark.sql import SparkSession
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("NO_BROADCAST"):  # large dimensions: sort-merge joins only
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    con, qs, sql = connect(folder), e.queries(), e.oracle_sql()
    names = sys.argv[1:] or list(qs)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = qs[n](spark, folder)
            r = compare(df, con, sql[n]) if n in sql else [f"rows only: {len(df.collect())}"]
        except Exception as ex:  # noqa: BLE001
            r = ["ERROR " + "".join(traceback.format_exception_only(ex))[:700]]
        bad += bool(r) and not r[0].startswith("rows only")
        print(f"{time.time() - t:6.2f} {n}: {'ok' if not r else '; '.join(r)}", flush=True)
    print("bad:", bad, "of", len(names))


if __name__ == "__main__":
    main()
