"""Print the final (adaptive) physical plans of the main queries as markdown.

usage: python tools/plans.py [sf_dir] > PLANS.md
Each query is run once (no-op sink) so the adaptive plan is final, then its operator tree and the
scan details (pushed filters, read schema) are printed.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bluelines.plans import catalogue  # noqa: E402
from bluelines.session import build_session  # noqa: E402

QUERIES = ["stream_list_all", "work_segments", "break_segments", "upstream_pairs", "start_of_route", "side_channels", "snap_measure",
           "clip_lines", "run_collapse", "insert_ignore", "first_per_key", "code_descendant", "attr_link"]


def plan_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print(f"# Physical plans\n\nFinal adaptive plans at `{sf_dir}` (generated by `tools/plans.py`).\n")
    for name in QUERIES:
        df = catalogue.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        text = plan_text(df)
        tree = text.split("\n\n")[0]
        scans = re.findall(r"\(\d+\) Scan parquet.*?(?:PushedFilters: \[.*?\]\n)?ReadSchema: .*?\n", text, re.S)
        print(f"## {name}\n\n```\n{tree.strip()}\n```\n")
        for sc in scans:
            loc = re.search(r"Location: \S+ \[(.*?)\]", sc)
            pf = re.search(r"PushedFilters: (\[.*?\])", sc)
            rs = re.search(r"ReadSchema: (.*)", sc)
            where = os.path.basename(loc.group(1)) if loc else "?"
            print(f"- scan `{where}`: read `{rs.group(1) if rs else '?'}`" + (f", pushed `{pf.group(1)}`" if pf else ""))
        print()


if __name__ == "__main__":
    main()
