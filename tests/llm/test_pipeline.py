"""Pipeline: every stage on its own input against brute force, and the whole run."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from stakeflow.llm import bpe, kneser_ney, mixing
from stakeflow.llm.tables import materialise, read
from tests.llm import test_line_dedup, test_ngram_join

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage by name, as lists of rows."""
    out, docs = {}, read(spark, SF, "documents")
    for name, stage in P.STAGES:
        kept = materialise(stage(spark, docs, SF), name)
        out[name] = docs, docs.collect(), kept.collect(), kept.columns
        docs = kept
    return out


def test_columns_stay(stages):
    names = [n for n, _ in P.STAGES]
    for name in names[:-1]:
        assert stages[name][3] == stages[name][0].columns
    assert len(names) == 5


def test_quality(spark, stages):
    docs, before, after, _ = stages["quality_classifier"]
    kept = {r.doc_id for r in kneser_ney.quality(docs, read(spark, SF, "labels")).where("kept").collect()}
    assert sorted(after) == sorted(r for r in before if r.doc_id in kept)
    good = {r.doc_id for r in read(spark, SF, "labels").where("quality = 1 and toxic = 0").collect()}
    assert len(good & kept) >= 0.97 * len(good)


def test_lines(stages):
    _, before, after, _ = stages["line_dedup"]
    want = {i: t for i, _, _, t in test_line_dedup.brute([(r.doc_id, r.text) for r in before])}
    left = {i: t for i, t in want.items() if t.split()}
    assert {r.doc_id: r.text for r in after} == left and 0 < len(want) - len(left) < 0.05 * len(want)
    assert all(r.n_chars == len(r.text) for r in after)
    assert {(r.doc_id, r.source, r.lang) for r in after} == {(r.doc_id, r.source, r.lang) for r in before if r.doc_id in left}


def test_near_duplicates(stages):
    _, before, after, _ = stages["ngram_jaccard_join"]
    want = test_ngram_join.brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(after) == sorted(r for r in before if want[r.doc_id][1] == r.doc_id)


def test_mixing(spark, stages):
    docs, before, after, _ = stages["mixing"]
    cells = mixing.fit(mixing.cells_of(mixing.with_cell(docs).drop("row", "id")))
    rate = {(r.source, r.lang, r.topic): r.probability for r in cells.collect()}
    cell = {r.id: (r.source, r.lang, r.topic) for r in mixing.with_cell(docs).drop("row").collect()}
    u = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) / 2**32 for i in cell}
    assert sorted(after) == sorted(r for r in before if u[r.doc_id] < rate[cell[r.doc_id]])


def test_tokens(stages):
    _, before, after, _ = stages["bpe"]
    library = Tokenizer.from_file(bpe.public_path())
    assert {r.doc_id: r.ids for r in after} == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in before}
    assert all(r.n_tokens == len(r.ids) > 0 and r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in after)


def test_run(spark, stages):
    got = P.run(spark, SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in stages["bpe"][2])


def test_empty_and_odd_documents(spark):
    odd = spark.createDataFrame([(1, None, "en", "s", 0, "x"), (1, None, "en", "s", 0, "x"), (None, "text", None, None, None, None)],
                                "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")
    for docs in (odd, odd.limit(0)):
        for _, stage in P.STAGES:
            docs = materialise(stage(spark, docs, SF), "odd")
        docs.collect()
