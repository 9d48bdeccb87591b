"""Write the physical plans of the line-level stage to docs/PLANS.md.

Two settings: as planned for the test data, and as planned when no table
may be broadcast (Spark's size-based broadcast off) — the shape the plan
takes when every table is large.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.operators import rollups  # noqa: E402
from shelfwise.session import local_session  # noqa: E402
from shelfwise.sources import tables  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans of the line-level stage", "",
           f"Input: `{sf_dir}`. Generated by `tools/explain_plans.py`.", ""]
    for title, auto in (("As planned for the test data", None), ("Every table large: nothing is broadcast", "-1")):
        if auto is not None:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", auto)
        facts = tables.line_facts(spark, sf_dir)
        parts = rollups.combined_rollup_parts(facts, tables.TESTDATA_CATEGORY_MAP)
        out += [f"## {title}", "", "```", plan(parts).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
