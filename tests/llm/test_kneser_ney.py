"""Kneser-Ney model against a plain dictionary version, and the verdicts."""

import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stakeflow.llm import kneser_ney as K

SF = "/root/testdata/sf0.01"


def brute_bits(train, texts, order):
    """Code length of each text, by dictionaries."""
    grams = lambda t, k=order: [(b"\n" * (order - 1) + t.encode())[i:i + order] for i in range(len(t.encode()))]
    counts = {order: Counter(g for t in train for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d, total, mass = {}, {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d[k] = [min(i + 1, max(0.1, i + 1 - (i + 2) * y * n[i + 1] / n[i])) if n[i] else (i + 1) / 2 for i in range(3)]
        total[k], mass[k] = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[k][g[:-1]] += v
            mass[k][g[:-1]] += d[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        below = p(g[1:])
        if g[:-1] not in total[k]:
            return below
        v = counts[k].get(g, 0)
        return ((v - d[k][min(v, 3) - 1] if v else 0) + mass[k][g[:-1]] * below) / total[k][g[:-1]]

    return [-sum(math.log2(p(g)) for g in grams(t)) for t in texts]


def test_probabilities_match(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()
    rows = [(r.doc_id, r.text, r.lang) for r in docs] + [(900, None, "en"), (901, "", None), (902, "ab", "xx"), (3, "twice", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 as block", "2 as code")
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint")
    got = sorted((r.doc_id, r.n_bytes, round(r.bits, 6)) for r in K.score_documents(df, trusted).collect())
    texts = [t or "" for _, t, _ in rows]
    bits = brute_bits([t for i, t, _ in rows if i % 2 == 0 and i < 60 and t], texts, K.ORDER)
    assert got == sorted((i, len(t.encode()), round(b, 6)) for (i, _, _), t, b in zip(rows, texts, bits))


def test_probabilities_sum_to_one(spark):
    codes = [(a << 8 | b, n) for a, b, n in [(97, 98, 3), (97, 99, 1), (98, 97, 2), (99, 97, 1)]]
    every = {a << 8 | b: 0 for a in (97, 100) for b in range(256)} | dict(codes)
    df = spark.createDataFrame(list(every.items()), "code bigint, n bigint")
    p = {r.code: r.p for r in K.probabilities(df, 2).collect()}
    for a in (97, 100):
        assert abs(sum(p[a << 8 | b] for b in range(256)) - 1) < 1e-9


def test_verdicts(spark):
    got = {r.doc_id: r for r in K.op5_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [got[r.doc_id].kept for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [got[r.doc_id].kept for r in labels if r.quality == 0]
    assert len(got) == 1000
    assert sum(good) / len(good) >= 0.97 and sum(bad) / len(bad) <= 0.1


def test_toxic_and_clean_apart(spark):
    got = {r.doc_id: r for r in K.op5_quality_classifier(spark, SF).collect()}
    labels = [(r.toxic, got[r.doc_id].kept) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1]
    caught = [not kept for toxic, kept in labels if toxic == 1]
    lost = [not kept for toxic, kept in labels if toxic == 0]
    print(f"toxic caught {sum(caught)} of {len(caught)}, clean lost {sum(lost)} of {len(lost)}")
    assert sum(caught) / len(caught) >= 0.6 and sum(lost) / len(lost) <= 0.03


def test_many_rows_without_or_with_one_id_are_dealt_out(spark):
    """10,000 rows without an id fill all blocks, 10,000 of one id ``SALTS`` of them; each row meets its label."""
    rows = spark.range(20_000).selectExpr("if(id < 10000, null, 7L) as doc_id", "concat('text ', id) as text")
    block = K._block(F.col("doc_id"), K._salt(F.col("doc_id"), F.col("text")), 40)
    sizes = {(r.doc_id, r.b): r["count"] for r in rows.groupBy("doc_id", block.alias("b")).count().collect()}
    nulls, one = ([n for (i, _), n in sizes.items() if i == d] for d in (None, 7))
    assert len(nulls) == 40 and max(nulls) < 400 and 5 <= len(one) <= K.SALTS and max(one) < 3500
    docs = spark.createDataFrame([(7, f"words {i} and more of them", "en") for i in range(60)] + [(None, "words of none", "en")] * 2,
                                 "doc_id bigint, text string, lang string")
    trained = K.score_documents(docs, spark.createDataFrame([(7,)], "doc_id bigint")).collect()
    want = brute_bits([r.text for r in docs.collect() if r.doc_id == 7], [r.text for r in docs.collect()], K.ORDER)
    assert sorted(round(r.bits, 6) for r in trained) == sorted(round(b, 6) for b in want)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "some text", "en"), (None, "no id", "en")],
                                 "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {(r.doc_id, r.kept) for r in K.quality(docs, none).collect()} == {(1, False), (2, False), (3, True), (None, True)}
    both = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (2, 1, None)], "doc_id bigint, quality int, toxic int")
    assert K.quality(docs, both).count() == 4
    assert K.quality(docs.limit(0), both).count() == 0
