"""Language ID: held-out accuracy and edge cases."""

from zlib import crc32

from stakeflow.llm import lang_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = lang_id.op8_language_id(spark, SF).collect()
    assert len(got) == len(want)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in want if crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    rows = [(i, "the house and the river of that day " * 4, "en", "x") for i in range(1, 40)]
    rows += [(i, "der und die straße nicht für über " * 4, "de", "x") for i in range(40, 80)]
    rows += [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 + 4 !!", "de", "x"),
             (103, "The House and That river", None, "x"), (103, "für die Straße und der", None, "x"),
             (None, "the day of that house", None, "x"), (104, "the river and " * 9000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = sorted((r.doc_id or -1, r.lang_pred) for r in lang_id.language_id(df).collect() if (r.doc_id or -1) < 0
                 or r.doc_id >= 100)
    assert got == [(-1, "en"), (100, "und"), (101, "und"), (102, "und"), (103, "de"), (103, "en"), (104, "en")]


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r)[2:] for r in lang_id.language_id(df).collect()] == [("und", 0.0)]
    assert lang_id.language_id(df.limit(0)).count() == 0
