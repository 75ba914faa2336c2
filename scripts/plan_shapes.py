"""Plan shapes of registered queries with size-based broadcast off (the shape at scale).

    python scripts/plan_shapes.py mart_city_sales scd2_apply ...
"""
import contextlib
import io
import os
import re
import sys
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from strata.session import get_spark
from strata.plans.queries import QUERIES
# no size-based broadcast: the plan shape a 100 TB run gets when no side is under the threshold
spark = get_spark(master="local[8]", shuffle_partitions=8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
sf = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.01")
for name in sys.argv[1:]:
    df = QUERIES[name](spark, sf)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf): df.explain()
    text = buf.getvalue()
    lines = []
    for l in text.splitlines():
        m = re.search(r"(Exchange \w+\([^)]*\)|SortMergeJoin \[[^\]]*\], \[[^\]]*\], \w+|BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], \w+|WindowGroupLimit \[[^\]]*\]|Window \[|HashAggregate\(keys=\[[^\]]*\]|SortAggregate\(keys=\[[^\]]*\]|ObjectHashAggregate\(keys=\[[^\]]*\]|TakeOrderedAndProject|Generate \w+|Expand|FileScan parquet \[[^\]]*\])", l)
        if m:
            s = re.sub(r"#\d+L?", "", m.group(1))
            lines.append(" " * (len(l) - len(l.lstrip(" :+-"))) + s)
    print("=====", name, f"exchanges={sum('Exchange' in x for x in lines)}")
    print("\n".join(lines))
