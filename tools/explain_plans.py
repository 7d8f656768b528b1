"""Write PLANS.md: physical plans of the key operators at a small scale.

    python tools/explain_plans.py [sf_dir]

AQE is switched off for the dump only, so whole-stage-codegen spans (``*(n)``)
and join strategies are visible in the static plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHOW = [
    ("phrase_match", "one pass: regex pieces -> token array -> posexplode -> broadcast hash join on the first token"),
    ("classify_threshold", "scores per (doc, type), arg-max, threshold"),
    ("entity_merge_dedupe", "text + table entities, dedupe by aggregation, per-document seq"),
    ("range_match", "rule lookup and range arrays joined by broadcast, first matching range by filter()[0]"),
    ("ocr_page_text", "lag + running sum over (doc, page), lines then pages"),
]


def clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    plan = re.sub(r"file:[^\],]*", "file:…", plan)
    return "\n".join(line[:220] for line in plan.splitlines())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from scribeflow.plans import queries as Q
    from scribeflow.session import local_session

    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the key operators", "",
           f"Generated by `tools/explain_plans.py` on `{sf}` with AQE off (so codegen spans `*(n)` show).", ""]
    for name, what in SHOW:
        df = Q.QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", what + ".", "", "```", clean(plan).rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
