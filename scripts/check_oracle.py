"""Compare registered queries with their DuckDB oracles.

python scripts/check_oracle.py [--force-distributed] [sf_dir] [name ...]

``--force-distributed`` sets every size threshold to 0 so the code paths meant
for very large inputs run instead: distributed rank-search quantiles,
range-partitioned checkpointed prefix sums and shuffle joins instead of
broadcasts.  Results must still equal the oracle exactly.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.plans.catalog import QUERIES, load_all  # noqa: E402
from panelkit.plans.verify import compare, duckdb_connection  # noqa: E402
from panelkit.session import build_session, release_intermediates  # noqa: E402


def main():
    args = sys.argv[1:]
    force = "--force-distributed" in args
    args = [a for a in args if a != "--force-distributed"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    load_all()
    spark = build_session()
    if force:
        for key in ("panelkit.quantiles.inMemoryLimit", "panelkit.prefix.inMemoryLimit", "panelkit.broadcast.maxRows"):
            spark.conf.set(key, "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    con = duckdb_connection(sf_dir)
    bad = 0
    for name in names or sorted(QUERIES):
        t = time.time()
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            r = {"query": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:600]}"}
        release_intermediates(spark)
        ok = r["status"] in ("exact", "no-oracle")
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:34s} {time.time() - t:6.2f}s {r}", flush=True)
    print(f"{bad} not exact")


if __name__ == "__main__":
    main()
