"""Audit the physical plans of every registered query.

Flags nested-loop joins, Cartesian products, Python UDF evaluation and
windows without a partition key. Usage: python tests/plan_audit.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FLAGS = {
    "nested_loop": "BroadcastNestedLoopJoin",
    "cartesian": "CartesianProduct",
    "python_udf": "BatchEvalPython",
    "arrow_udf": "ArrowEvalPython",
}


def audit(spark, sf_dir, names=None):
    import __spark_entry__ as E
    out = {}
    for name, fn in E.queries().items():
        if names and name not in names:
            continue
        try:
            plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            out[name] = {"error": str(e)[:120]}
            continue
        found = {k: plan.count(v) for k, v in FLAGS.items() if v in plan}
        unpartitioned = len(re.findall(r"Window \[.*?\], \[\]", plan))
        if unpartitioned:
            found["window_no_partition"] = unpartitioned
        out[name] = found
        print(f"{name:32s} {found or 'clean'}", flush=True)
    return out


if __name__ == "__main__":
    from civora.session import get_session
    spark = get_session("local[4]", 4)
    audit(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:] or None)
