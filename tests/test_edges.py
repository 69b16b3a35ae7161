"""Edge cases: split fallbacks, exhausted candidates, empty and one-row inputs."""

import datetime as dt


from stakeflow.operators import dataset as D
from stakeflow.operators import scoring as S
from stakeflow.operators import stats as ST

T0 = dt.datetime(2024, 1, 1)


def _ev(spark, rows):
    return spark.createDataFrame(rows, "userId string, gameId string, timestamp timestamp_ntz")


def test_holdout_fallback_single_game_users(spark):
    # nobody has >= 2 games: one globally latest pair is held out
    ev = _ev(spark, [("u1", "g1", T0), ("u2", "g2", T0 + dt.timedelta(hours=1)), ("u1", "g1", T0 + dt.timedelta(hours=2))])
    hold = D.holdout_pairs(ev).collect()
    assert [(r.userId, r.gameId) for r in hold] == [("u1", "g1")]


def test_train_falls_back_to_test(spark):
    # every event belongs to the held-out pair: train := test
    ev = _ev(spark, [("u1", "g1", T0), ("u1", "g1", T0 + dt.timedelta(hours=1))])
    hold = D.holdout_pairs(ev)
    train, test = D.split_events(ev, hold)
    assert train.count() == test.count() == 2


def test_holdout_tie_takes_larger_game(spark):
    ev = _ev(spark, [("u1", "g1", T0), ("u1", "g2", T0), ("u1", "g0", T0)])
    assert [(r.userId, r.gameId) for r in D.holdout_pairs(ev).collect()] == [("u1", "g2")]


def test_known_user_with_everything_played_gets_no_rows(spark):
    items = spark.createDataFrame([("g1", [1.0, 0.0]), ("g2", [0.0, 1.0])], "gameId string, embedding array<double>")
    users = spark.createDataFrame([("u1", [1.0, 1.0], ["g1", "g2"]), ("u2", [1.0, 0.0], None)],
                                  "userId string, embedding array<double>, seen array<string>")
    got = S.top_k(users, S.item_blocks(items), 5, "userId", exclude="seen").collect()
    assert {r.rid for r in got} == {"u2"}
    assert [r.gameId for r in sorted(got, key=lambda r: r["rank"])] == ["g1", "g2"]


def test_quantiles_empty_and_single(spark):
    empty = spark.createDataFrame([], "x double")
    assert ST.quantiles(empty, "x", [0.5]) == [None]
    one = spark.createDataFrame([(3.5,)], "x double")
    assert ST.quantiles(one, "x", [0.33, 0.95]) == [3.5, 3.5]
    nulls = spark.createDataFrame([(None,), (1.0,), (3.0,)], "x double")
    assert ST.quantiles(nulls, "x", [0.5]) == [2.0]


def test_dense_index_empty(spark):
    assert ST.dense_index(spark.createDataFrame([], "k string"), "k").count() == 0


def test_popularity_bucket_empty_catalog(spark):
    df = spark.createDataFrame([], "gameId string, popularity_score double")
    assert D.popularity_bucket(df).count() == 0


def test_feature_matrix_entity_without_tokens(spark):
    idx = spark.createDataFrame([("u1", 0), ("u2", 1)], "userId string, idx long")
    toks = spark.createDataFrame([("u1", ["a:x", "b:y"])], "userId string, tokens array<string>")
    vocab = spark.createDataFrame([("a:x", 0), ("b:y", 1)], "token string, token_idx long")
    fm = {(r.entity_idx, r.feature_idx): r.value for r in D.feature_matrix(idx, "userId", toks, vocab).collect()}
    assert fm[(1, 1)] == 1.0                      # identity only
    assert abs(fm[(0, 0)] - 1 / 3) < 1e-12 and abs(fm[(0, 2)] - 1 / 3) < 1e-12 and abs(fm[(0, 3)] - 1 / 3) < 1e-12
