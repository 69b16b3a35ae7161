"""BPE: ids and decoded text equal to the tokenizers library."""

import random

import pytest
from tokenizers import Tokenizer

from stakeflow.llm import bpe

PATH = bpe.public_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text):
    return bpe.vocabulary(PATH).encode(text)


CASES = ["", " ", "Hello, World's 123 don't", "<|endoftext|>x <|startoftext|>", "a<|b|>", "ΑΣ Σ ΟΔΟΣ",
         "İstanbul é Å", "tab\tnew\nline\x1cfs\x85nel　wide", "emoji 👩‍👩‍👧 ½ ²", "x" * 5000,
         "THERHAOU!! *** ciónñ | äöü ß ŉ", "\x00\x01\x7f", "ab​cd ﻿", "''s'll 'RE"]


@pytest.mark.parametrize("text", CASES)
def test_cases(library, text):
    want = library.encode(text, add_special_tokens=False)
    assert ids_of(text) == want.ids


def test_random_texts(library):
    rng = random.Random(5)
    pools = [range(32, 127), range(160, 400), range(0x370, 0x530), range(0x3040, 0x30ff), range(0x1f300, 0x1f340),
             range(0, 32), range(0x300, 0x320), range(0x10000, 0x20000), range(0xe000, 0x10000)]
    for _ in range(400):
        text = "".join(chr(rng.choice(pools[min(int(rng.expovariate(0.5)), 8)])) for _ in range(rng.randrange(60)))
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_rows(spark, library):
    rows = [(1, "One two, THREE!", "x"), (2, None, "y"), (3, "", "z"), (1, "again", None), (None, "no id", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = {(r.doc_id, tuple(r.ids), r.decoded) for r in bpe.bpe_decode(bpe.bpe_encode(df, PATH), PATH).collect()}
    want = set()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == want
    assert got == {(r.doc_id, tuple(r.ids), r.decoded) for r in bpe.bpe_round_trip(df.withColumn("decoded", bpe.F.lit(1)), PATH).collect()}
    assert bpe.bpe_encode(df.limit(0), PATH).count() == 0


def test_every_code_point(library):
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    ids, count = bpe.vocabulary(PATH).encode_batch(texts)
    off = [0, *count.cumsum().tolist()]
    ids = ids.tolist()
    wrong = [t for t, want, i, j in zip(texts, library.encode_batch(texts, add_special_tokens=False), off, off[1:]) if want.ids != ids[i:j]]
    assert not wrong


def test_batches_forget_and_agree(library, monkeypatch):
    """The table of known words is bounded; special tokens keep their places."""
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    v = bpe.BpeVocabulary(PATH)
    for texts in (["one two", "", "three <|endoftext|> four"], ["five six seven eight", "one <|startoftext|>one"], [], ["two"]):
        ids, count = v.encode_batch(texts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert count.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert len(v.known) <= 12


def test_long_fragments(library):
    rng = random.Random(3)
    for text in ("the" * 400, "x" * 1001, "".join(rng.choice("thesandig") for _ in range(3000)), "漢字" * 700, "á" * 300 + "b"):
        assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


def test_forced_boundaries_change_nothing():
    v = bpe.vocabulary(PATH)
    word = "zqxjthekwvqzñçthing".encode()
    assert len(v.cuts(word)) > 1
    symbols = v.inner[list(word)].tolist()
    symbols[-1] = int(v.final[word[-1]])
    assert v.encode_words([word.decode()])[0].tolist() == v.merge_long(symbols)
