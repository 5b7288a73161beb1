"""Benchmark: the analysis flow on one scale factor, one JSON line out.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stages run in dependency order in one session; each stage's time is the
work it adds (earlier stages are materialised once and reused, as in a
real run).  Every result is fully computed with the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricenet.operators import scoring as W  # noqa: E402
from pricenet.operators import vectors as V  # noqa: E402
from pricenet.plans import catalog  # noqa: E402
from pricenet.session import drop_run_tables, get_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # Start the JVM's machinery on another input first: no stage pays for it.
    run(spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count())
    ctx = timed("panel", lambda: catalog.ctx(spark, sf_dir))
    a = ctx.analysis(tau=catalog.TAU)
    timed("cosine_pairs", lambda: run(a.pairs))
    timed("threshold_networks", lambda: (run(a.networks), run(a.edges)))
    timed("shortest_paths", lambda: a.paths)
    timed("components", lambda: run(a.component_counts))
    timed("closeness_path_metrics", lambda: (run(a.closeness), run(a.path_metrics)))
    timed("betweenness_centrality", lambda: run(a.betweenness))
    timed("eigenvector_centrality", lambda: run(a.eigenvector))
    timed("centrality_all", lambda: run(a.centrality))
    timed("clustering_evolution", lambda: run(a.evolution))
    timed("rankings", lambda: run(W.rankings(a.year_scores, "Score_Equal")))

    timed("panel_brand", lambda: ctx.brand_obs)
    timed("cosine_pairs_brand", lambda: run(V.cosine_pairs(V.roster_features(V.features(ctx.brand_obs), ctx.roster))))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "end_to_end_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    drop_run_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
