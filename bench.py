"""

Prints one JSON line: {"metric", "value", "unit", "queries", "cold", "sf", ...}.
Every stage is executed fully with the ``noop`` sink (no collect).  One
warm-up pass runs first on the smallest scale directory (JVM / codegen warm-up).

In ``queries`` the stages share written tables (events, pairs, dataset), so each
time is the increment over the stages before it.  In ``cold`` each stage starts
from the source tables.
"""

from __future__ import annotations

import json
import os
import platform
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stakeflow.operators import dataset as D  # noqa: E402
from stakeflow.operators import train as TR  # noqa: E402
from stakeflow.operators.warp import train_warp  # noqa: E402
from stakeflow.plans import stages as P  # noqa: E402
from stakeflow.plans.catalog import load_all  # noqa: E402
from stakeflow.session import get_spark  # noqa: E402
from stakeflow.sources.fixtures import Tables  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def _features(t):
    f = P.features(t)
    for df in (f.users, f.games, f.providers, f.user_game):
        run(df)


def _split(t):
    for name in ("interaction_triplets", "feature_matrices"):
        run(load_all()[name].build(t))


def _train_epoch(t):
    d = P.dataset(t)
    run(TR.fit_als(D.triplets(d.train_pairs, d.user_index, d.item_index), max_iter=1).userFactors)


def _warp_epoch(t):
    d = P.dataset(t)
    train_warp(d.train_pairs, d.user_tokens, d.item_tokens, d.user_index, d.item_index, epochs=1, local_epochs=1)


def _query(name):
    return lambda t: run(load_all()[name].build(t))


STAGES = {
    "asof_enrichment": lambda t: run(P.enriched_bets(t)),  # session as-of join and device cascade
    "features": _features,  # alignment, user, game, provider and pair features
    "split_matrices": _split,  # temporal split, dictionaries, vocabularies, triplets, feature matrices
    "top5_all_users": _query("top5_all_users"),  # every user against the whole catalog, in blocks
    "train_epoch": _train_epoch,  # one ALS iteration
    "warp_epoch": _warp_epoch,  # one sharded WARP epoch
    "ranking_metrics": _query("user_ranking_metrics"),
    "batch_recommend": _query("recommendations"),
    "flagship_top_games": _query("top_games_by_implicit_score"),
}


def stages(spark, sf_dir, shared=True):
    t, out = Tables(spark, sf_dir), {}
    for name, fn in STAGES.items():
        t = t if shared else Tables(spark, sf_dir)
        t0 = time.perf_counter()
        fn(t)
        out[name] = round(time.perf_counter() - t0, 3)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        stages(spark, warm_dir)
    q = stages(spark, sf_dir)
    cold = stages(spark, sf_dir, shared=False)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_stage_seconds",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": q,
        "cold": cold,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "machine": f"{platform.machine()} {os.cpu_count()} cpus, {platform.system()}",
    }))


if __name__ == "__main__":
    main()
