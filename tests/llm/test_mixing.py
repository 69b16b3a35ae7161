"""Mixing: the fit meets its targets; the sample follows the probabilities; edge rows."""

import hashlib

from stakeflow.llm import mixing as M

SF = "/root/testdata/sf0.01"


def test_fit_meets_the_targets(spark):
    cells = [("a", "en", "x", 900), ("a", "fr", "x", 50), ("b", "en", "y", 300), ("b", "fr", "x", 200), ("c", "en", "x", 10),
             ("c", "fr", "y", 40), ("a", "en", "y", 70), ("d", "en", "x", 0), ("c", "en", "y", 25), ("b", "en", "x", 31)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens bigint")
    goal = {"lang": spark.createDataFrame([("en", 3), ("fr", 1), ("xx", 9)], "value string, target int")}
    got = M.fit(df, goal, rounds=60).collect()
    weight = {(r.source, r.lang, r.topic): r.tokens * r.factor for r in got}
    assert abs(sum(weight.values()) - 1) < 1e-9
    for value, share in (("en", 0.75), ("fr", 0.25)):
        assert abs(sum(w for k, w in weight.items() if k[1] == value) - share) < 1e-9
    total = {s: sum(c[3] for c in cells if c[0] == s) ** M.TEMPER for s in "abc"}
    for s in "abc":
        assert abs(sum(w for k, w in weight.items() if k[0] == s) - total[s] / sum(total.values())) < 1e-6
    assert max(r.probability for r in got) == 1 and min(r.probability for r in got) > 0


def test_sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as row", "2 as tokens", "'z' as topic")
    rows = {r.doc_id: r for r in M.op7_mixing(spark, SF).collect()}
    for i, r in rows.items():
        u = int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) / 2**32
        assert r.selected == (u < r.probability) or abs(u - r.probability) < 1e-8
    out = M.sample_to_targets(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, r in rows.items() if r.selected)


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b c", "s", "en"), (1, "a b c", "s", "en"), (2, None, None, None), (3, "", "s", None),
                                (None, "x " * 500, None, "en"), (4, "word " * 30_000, "t", "en")],
                               "doc_id bigint, text string, source string, lang string")
    out = M.sample_to_targets(df).collect()
    assert len(out) <= 6 and sum(r.doc_id == 1 for r in out) in (0, 2)
    assert M.sample_to_targets(df.limit(0)).count() == 0
    assert M.sample_to_targets(df.where("doc_id in (2, 3)")).count() == 2
    counts = [r[0] for r in df.select(M.token_count(M.F.col("text"))).collect()]
    assert counts == [3, 3, 0, 0, 500, 30_000]
