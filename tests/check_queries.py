"""Command line: compare registered queries with their SQL. Usage: check_queries.py SF [name ...]"""

import sys
import time
import traceback

sys.path[:0] = [__file__.rsplit("/", 2)[0], __file__.rsplit("/", 1)[0]]

import importlib

from compare import compare, connect
from pyspark.sql import SparkSession

from tallyfold.plans import registry


def main(sf: str, names: list[str]) -> int:
    mods = [n[1:] for n in names if n.startswith("@")]
    names = [n for n in names if not n.startswith("@")]
    if mods:
        for m in mods:
            importlib.import_module(f"tallyfold.plans.{m}_queries")
    else:
        registry.load_all()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con = connect(sf_dir)
    bad = 0
    for name in names or list(registry.QUERIES):
        start = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            if name in registry.SQL:
                problems = compare(df, con, registry.SQL[name])
                status = "OK" if not problems else "DIFF " + "; ".join(problems)[:900]
            else:
                rows = df.collect()
                status = f"ROWS {len(rows)} {[tuple(map(str, r))[:8] for r in rows[:2]]}"[:400]
        except Exception as e:
            status = "ERROR " + str(e)[:600]
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name:26s} {time.time() - start:6.2f}s {status}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a != "-v"]
    sys.exit(bool(main(args[0], args[1:])))
