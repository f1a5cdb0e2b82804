"""Write PLANS.md: final (post-AQE) physical plans of the main query shapes.

python tools_explain.py [sf_dir]   (default /root/testdata/sf0.01)
Each query is executed first, so the plan shows AQE's runtime choices.
"""

import contextlib
import io
import re
import sys

from paceline.plans.queries import BATCH_QUERIES
from paceline.session import build_session

KEYS = ["results_clean", "dim_athlete", "events_per_year", "gender_distribution",
        "country_representation", "distance_races", "top_countries"]


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    scans = [line.strip() for line in text.splitlines()
             if re.match(r"^(ReadSchema|PushedFilters|DataFilters)", line.strip())]
    return tree + "\n\n" + "\n".join(dict.fromkeys(scans))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    out = ["# PLANS", "",
           f"Final physical plans (AQE, after execution) at `{sf_dir}` on local[8], from "
           "`python tools_explain.py`. Scan lines list the pruned read schema and pushed filters.", ""]
    for key in KEYS:
        out += [f"## {key}", "", "```", final_plan(BATCH_QUERIES[key](spark, sf_dir)).rstrip(), "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
