"""Write the physical plans of the headline queries to docs/plans.md.

The plans are taken after execution (AQE's final plan) with automatic
broadcast disabled, which is the plan shape at cluster scale: only the
tables broadcast explicitly (region, nation, bounded lookups) stay broadcast,
every table that grows with the data is joined with a sort-merge join.

Usage: python scripts/explain_plans.py [SF_DIR]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from cuenca.plans.registry import load_all  # noqa: E402
from cuenca.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[4]", app="cuenca-plans", shuffle_partitions=8,
                        extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    out = ["# Physical plans of the headline queries", "",
           f"Final AQE plans on `{sf}` with automatic broadcast disabled (the shape at cluster "
           "scale). Generated by `scripts/explain_plans.py`.", ""]
    for k in HEADLINE:
        df = reg[k].build(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0]
        counts = {n: len(re.findall(rf"\b{n}\b", tree)) for n in
                  ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
                   "WindowGroupLimit", "Window", "HashAggregate", "Expand")}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", text)))
        out += [f"## {k}", "", reg[k].build.__doc__.strip().split("\n\n")[0] if reg[k].build.__doc__ else "",
                "", "Operators: " + ", ".join(f"{n} {c}" for n, c in counts.items() if c), ""]
        if pushed:
            out += ["Pushed filters: " + "; ".join(pushed), ""]
        out += ["```", tree.strip(), "```", ""]
    path = os.path.join(ROOT, "docs", "plans.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
