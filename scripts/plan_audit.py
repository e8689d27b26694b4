"""Plan audit: per query, count exchanges and flag scale hazards in the physical plan.

python scripts/plan_audit.py [sf_dir]  ->  one line per query
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.plans.catalog import QUERIES, load_all  # noqa: E402
from panelkit.session import build_session, release_intermediates  # noqa: E402

SKIP = {"model_gradient_boosting", "early_stop_epoch", "model_logistic_regression", "model_sequence_mlp"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: what would be planned before runtime stats
    for name in sorted(QUERIES):
        if name in SKIP:
            continue
        try:
            plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            release_intermediates(spark)
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} ERROR {exc}")
            continue
        flags = []
        for pat, label in [("CartesianProduct", "CARTESIAN"), ("BroadcastNestedLoopJoin", "BNLJ"),
                           ("BatchEvalPython", "PY-UDF"), ("ArrowEvalPython", "PANDAS-UDF"),
                           ("SinglePartition", "SINGLE-PARTITION")]:
            n = plan.count(pat)
            if n:
                flags.append(f"{label}x{n}")
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
        widest = max((s.count(":") for s in schemas), default=0)
        print(f"{name:34s} exchanges={plan.count('Exchange hashpartitioning') + plan.count('Exchange rangepartitioning')} "
              f"broadcasts={plan.count('BroadcastExchange')} scans={len(schemas)} widest_scan_cols={widest} {' '.join(flags)}")


if __name__ == "__main__":
    main()
