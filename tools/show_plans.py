"""Print the physical plans of the main stages (formatted), for review.

    python tools/show_plans.py [sf_dir] [--no-broadcast]

``--no-broadcast`` sets autoBroadcastJoinThreshold=-1 so that small test
tables plan the way large ones do (sort-merge joins on the join keys).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricenet.operators import graph as N  # noqa: E402
from pricenet.operators import vectors as V  # noqa: E402
from pricenet.plans import catalog  # noqa: E402
from pricenet.session import get_session  # noqa: E402
from pricenet.sources import panel  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.01")
    spark = get_session("local[8]", 8)
    if "--no-broadcast" in args:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    c = catalog.ctx(spark, sf_dir)
    a = c.analysis()
    stages = {
        "raw price panel": panel.raw_price_panel(spark, sf_dir),
        "cosine pairs": V.cosine_pairs(a.roster_features),
        "threshold edges + metadata": N.network_metadata(a.groups, a.all_edges, a.n, a.tau),
        "scores": a.scores.select("*"),
    }
    for name, df in stages.items():
        print(f"==================== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
