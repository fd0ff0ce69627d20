"""Print the physical plan tree of registered queries (for plan review).

usage: python tools/plan_summary.py [sf_dir] name ...
"""

import re
import os
import sys

sys.path.insert(0, ".")

from portalforge.queries import QUERIES  # noqa: E402
from portalforge.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1]
    os.environ.setdefault("SPARK_DRIVER_MEMORY", "8g")
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:]:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}\n")
        print("```")
        for line in plan.splitlines():
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            print(line[:170])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
