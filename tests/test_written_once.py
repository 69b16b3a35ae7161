"""Tables that several steps read are written once: what follows does not hold the plan they came from."""

from pyspark.sql import functions as F

from stakeflow.operators import dataset as D
from stakeflow.operators import metrics as MT
from stakeflow.operators import scoring as S
from stakeflow.operators.stats import quantile_bucket
from tests.test_dataset_scoring import _events


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_do_not_read_their_input_again(spark):
    out = quantile_bucket(spark.range(7).select("id", (F.col("id") % 3).alias("v")), "id", "v", ["a", "b"], "bucket")
    assert "Range (0, 7" not in plan(out)
    assert sorted((r.v, r.id, r.bucket) for r in out.collect()) == [
        (0, 0, "a"), (0, 3, "a"), (0, 6, "a"), (1, 1, "a"), (1, 4, "b"), (2, 2, "b"), (2, 5, "b")]


def test_features_of_a_dataset_are_aggregated_once(spark):
    d = D.build_dataset(_events(spark))
    popular = S.popularity_ranking(d.ife)
    for table in (d.ufe, d.ife, d.user_tokens, d.item_tokens, d.test_pairs, d.active_users, d.active_items, popular):
        assert "mode(" not in plan(table) and "collect_set" not in plan(table)
    # the same rows as the unwritten tables give
    users = d.train.users.join(D.active_ids(d.train_pairs, d.test_pairs, "userId"), "userId", "left_semi")
    assert sorted(map(str, d.ufe.collect())) == sorted(map(str, users.collect()))


def test_recommendations_score_every_cell_once(spark):
    users = spark.createDataFrame([(f"u{i}", [float(i), 1.0]) for i in range(4)], "userId string, embedding array<double>")
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", [0.0, 1.0])], "gameId string, embedding array<double>")
    seen = spark.createDataFrame([("u1", "b")], "userId string, gameId string")
    ife = items.select("gameId", F.lit("slot").alias("game_type"), F.lit("p").alias("provider"), F.lit(1.0).alias("popularity_score"))
    req = spark.createDataFrame([(f"u{i}", 2, True) for i in range(5)], "user_id string, top_k int, exclude_played boolean")
    blocks = S.item_blocks(items)
    recs, _ = S.recommend(req, users, users, seen, blocks, S.popularity_ranking(ife), S.game_metadata(ife, None))
    top = S.top_k(users, blocks, 2, "userId")
    # whoever reads a result twice, as the histogram does, would run the grid again
    assert "CoGroups" not in plan(recs) and "CoGroups" not in plan(top)
    assert "Join" not in plan(MT.items_returned_histogram(recs, req))
    assert {(r.user_id, r["rank"]): r.game_id for r in recs.collect()} == {
        ("u0", 1): "c", ("u0", 2): "a", ("u1", 1): "a", ("u1", 2): "c", ("u2", 1): "b", ("u2", 2): "a",
        ("u3", 1): "b", ("u3", 2): "a", ("u4", 1): "a", ("u4", 2): "b"}
    assert recs.count() == 10
