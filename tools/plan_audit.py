"""Audit the physical plans of the SQL-checked queries.

Flags Cartesian products, nested-loop joins, single-partition exchanges,
generators, sort aggregates and windows without a partition spec.
Usage: python tools/plan_audit.py [sf_dir]
"""
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from cohortlens.session import get_spark
from cohortlens.plans import catalog
spark=get_spark("local[8]", shuffle_partitions=8)
q=catalog.queries(); o=catalog.oracle_sql()
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
for n in sorted(o):
    df=q[n](spark, sf)
    plan=df._jdf.queryExecution().executedPlan().toString()
    flags=[k for k in ("CartesianProduct","BroadcastNestedLoopJoin","SinglePartition","Generate","SortAggregate") if k in plan]
    if "Window" in plan:
        # any window with empty partition spec?
        for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan):
            if m.group(1).strip()=="":
                flags.append("UNPARTITIONED_WINDOW")
    print(n, flags, flush=True)
