"""BPE encoding and decoding with forced boundaries.

A pair of adjacent bytes that occurs inside no vocabulary token can never be
merged over, so every such pair is a certain cut: a word is cut there, its
fragments are encoded by themselves and the ids are concatenated.  The
fragments of all new words of a batch are merged together, one numpy step per
round of merges; each Python worker keeps the ids of the words it has met in a
table of bounded size.

Letters and numbers are those of Unicode 16.0 and lower case is that of 17.0, as
in the tokenizers library: Python's tables (15.1 in Python 3.13) and the fixed
additions below.  Tests compare every code point.

The vocabulary file is a parameter (a tokenizers JSON file of kind BPE with
byte-level symbols and a suffix at the word end); it is read once per worker
and not shipped with the job.  Every row is encoded by itself: no shuffle.

Defined results: a null text counts as empty and gives no ids; rows repeating
a ``doc_id`` are separate rows; special tokens written out in a text become
their ids, as in the library; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.llm.tables import read
from stakeflow.llm.textnum import frugal

#: Words whose ids a worker remembers.
REMEMBERED = 400_000
#: Bytes of text that are encoded together, and bytes of ids that become one output batch.
BATCH_BYTES = 4 << 20
#: Fragments above this length are merged by a heap, one by one.
LONG = 256
NONE = np.int64(1) << 62

# The letters and numbers that Unicode 16.0 added to 15.1, as ranges of code points.
ADDED = {
    "L": "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B "
         "1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C "
         "18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0",
    "N": "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA",
}
# Lower case of the capital letters that Unicode 16.0 and 17.0 added.
LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
_RARE = re.compile("[" + "".join(map(chr, LOWER)) + "]")
# White space of Unicode, which Python's own class takes with four control characters more.
SPACE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in shown else chr(extra))
        extra += b not in shown
    return out


@functools.cache
def unicode_class(kind: str) -> str:
    """The letters (L) or numbers (N) as the inside of a character class."""
    # no letter or number has a place above the third plane
    found = {c for c in range(0x40000) if unicodedata.category(chr(c))[0] == kind}
    for r in ADDED[kind].split():
        a, b = r.split("-")
        found.update(range(int(a, 16), int(b, 16) + 1))
    at = np.sort(np.fromiter(found, np.int64))
    first = at[np.append(True, np.diff(at) > 1)]
    last = at[np.append(np.diff(at) > 1, True)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last))


class BpeVocabulary:
    """Ids, merge ranks and forced boundaries of one vocabulary file, and the words met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: merges by pair of ids (left << 32 | right): rank << 32 | id of the merged token
        self.merge = {self.ids[a] << 32 | self.ids[b]: i << 32 | self.ids[a + b] for i, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for kind in "LN":
            inside = unicode_class(kind)
            split = split.replace(f"[\\p{{{kind}}}]", f"[{inside}]").replace(f"\\p{{{kind}}}", inside)
        split = split.replace("\\s", SPACE)
        self.pre_token = re.compile(split)
        self.special_split = re.compile(
            "(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        symbols = byte_symbols()
        #: id of each byte inside a word and at its end
        self.inner = np.array([self.ids[c] for c in symbols], np.int64)
        self.final = np.array([self.ids[c + self.suffix] for c in symbols], np.int64)
        byte_of = {c: b for b, c in enumerate(symbols)}
        #: joined[x, y]: some token has byte y right after byte x
        self.joined = np.zeros((256, 256), bool)
        for token in self.ids:
            raw = token.removesuffix(self.suffix) if self.suffix else token
            codes = [byte_of[c] for c in raw if c in byte_of]
            self.joined[codes[:-1], codes[1:]] = True
        order = sorted(self.merge)
        self.keys = np.array([*order, NONE], np.int64)
        self.steps = np.array([*(self.merge[k] for k in order), NONE], np.int64)
        self._forget()

    def _forget(self) -> None:
        """Start the table of known words anew: number of each word, then first id and ids by number.
        Special tokens stand in it as tuples, so that no run of text equals one."""
        self.known: dict = {(s,): i for i, s in enumerate(self.special)}
        self.first = np.arange(len(self.special) + 1)
        self.flat = np.array(list(self.special.values()), np.int32)

    def _step_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | merged id of each pair of ids, NONE where they don't merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.steps[at], NONE)

    def cuts(self, word: bytes) -> list[bytes]:
        """``word`` cut at its forced boundaries."""
        raw = np.frombuffer(word, np.uint8)
        at = (np.flatnonzero(~self.joined[raw[:-1], raw[1:]]) + 1).tolist()
        return [word[i:j] for i, j in zip([0, *at], [*at, len(word)])]

    def merge_long(self, ids: list[int]) -> list[int]:
        """Ids of one fragment from its symbols: a heap of the pairs that merge, lowest rank first."""
        n, merge = len(ids), self.merge.get
        ids, left, right = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(s, i) for i in range(n - 1) if (s := merge(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            step, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] < 0 or j >= n or merge(ids[i] << 32 | ids[j]) != step:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = step & 0xFFFFFFFF, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (s := merge(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (s, i))
            h = left[i]
            if h >= 0 and (s := merge(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (s, h))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each); no word is empty or holds a line feed."""
        raw = np.frombuffer("\n".join([*words, ""]).encode(), np.uint8)
        line = raw == 10
        length = np.diff(np.append(-1, np.flatnonzero(line))) - 1
        raw = raw[~line]
        last = np.cumsum(length) - 1
        ids = self.inner[raw]
        ids[last] = self.final[raw[last]]
        # a fragment ends with its word or at a forced boundary
        ends = np.append(~self.joined[raw[:-1], raw[1:]], True)[:len(raw)]
        ends[last] = True
        part = np.cumsum(ends) - ends
        size = np.bincount(part)
        at = np.arange(len(raw))
        done: list[tuple[np.ndarray, np.ndarray]] = [(at[:0], ids[:0])]
        first = np.cumsum(size) - size
        for f in np.flatnonzero(size > LONG):
            own = np.array(self.merge_long(ids[first[f]:first[f] + size[f]].tolist()), np.int64)
            done.append((first[f] + np.arange(len(own)), own))
        short = np.flatnonzero((size <= LONG)[part])
        at, ids, part = at[short], ids[short], part[short]
        step = np.full(len(ids), NONE)  # of each symbol with the next one of its fragment
        i = np.flatnonzero(part[1:] == part[:-1])
        step[i] = self._step_of(ids[i], ids[i + 1])
        while len(ids):
            new = np.append(True, part[1:] != part[:-1])
            lowest = np.minimum.reduceat(step, np.flatnonzero(new))[np.cumsum(new) - 1]
            i = np.flatnonzero((step == lowest) & (step != NONE))
            # in a run such as aaa the pairs overlap: every other one merges, from the left
            if (ids[i] == ids[np.minimum(i + 1, len(ids) - 1)]).any():
                run = np.append(True, np.diff(i) > 1)
                nth = np.arange(len(i))
                i = i[(nth - np.maximum.accumulate(np.where(run, nth, 0))) % 2 == 0]
            over = lowest == NONE
            done.append((at[over], ids[over]))
            ids[i] = step[i] & 0xFFFFFFFF
            stay = ~over
            stay[i + 1] = False
            stale = np.zeros(len(ids), bool)
            stale[i] = True
            keep = np.flatnonzero(stay)
            at, ids, part, step, stale = at[keep], ids[keep], part[keep], step[keep], stale[keep]
            stale[:-1] |= stale[1:]
            j = np.flatnonzero(stale)
            step[j] = NONE
            j = j[j < len(ids) - 1]
            j = j[part[j] == part[j + 1]]
            step[j] = self._step_of(ids[j], ids[j + 1])
        at, ids = (np.concatenate(x) for x in zip(*done))
        of = np.zeros(len(raw), bool)
        of[at] = True
        out = np.zeros(len(raw), np.int32)
        out[at] = ids
        total = np.append(0, np.cumsum(of))
        return out[of], total[last + 1] - total[last + 1 - length]

    def _add(self, keys: list[str], flat: np.ndarray, count: np.ndarray) -> None:
        self.known.update(zip(keys, range(len(self.known), len(self.known) + len(keys))))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
        self.flat = np.concatenate([self.flat, flat])

    def _ids_of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of entries of the table."""
        first = self.first[number]
        size = self.first[number + 1] - first
        end = np.cumsum(size)
        return self.flat[np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - size), size)], size

    def _learn(self, chunks: list[str]) -> None:
        """Give the ids of runs of text without white space to the table: words first, then what holds several."""
        mixed = [c for c in chunks if not c.isalpha()]
        parts = [self.pre_token.findall(c if c.isascii() or not _RARE.search(c) else c.translate(LOWER)) for c in mixed]
        words = dict.fromkeys(c for c in chunks if c.isalpha())
        words.update(dict.fromkeys(itertools.chain.from_iterable(parts)))
        words = [w for w in words if w not in self.known]
        self._add(words, *self.encode_words(words))
        left = [k for k, (c, p) in enumerate(zip(mixed, parts)) if p != [c]]
        number = [self.known[w] for k in left for w in parts[k]]
        ids, size = self._ids_of(np.array(number, np.int64))
        per = np.fromiter((len(parts[k]) for k in left), np.int64, len(left))
        total = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(per))]
        self._add([mixed[k] for k in left], ids, np.diff(total))

    def _plain(self, text: str) -> list[str]:
        """The runs of ``text`` without white space, after normalisation."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # \x1c-\x1f part words for str.split but are no white space to the pattern
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [text]
        return text.split()

    def _parts(self, text: str) -> list[str]:
        """Runs of ``text`` without white space, and special tokens as they are."""
        if "<|" not in text or not self.special:
            return self._plain(text)
        parts = self.special_split.split(text)
        return [c for i, p in enumerate(parts) for c in ([(p,)] if i % 2 else self._plain(p))]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        parts = [self._parts(t) for t in texts]
        chunks = list(itertools.chain.from_iterable(parts))
        per_text = np.fromiter(map(len, parts), np.int64, len(parts))
        distinct = dict.fromkeys(chunks)
        unknown = [c for c in distinct if c not in self.known]
        if unknown:
            self._learn(unknown)
        distinct.update(zip(distinct, map(self.known.__getitem__, list(distinct))))
        number = np.fromiter(map(distinct.__getitem__, chunks), np.int64, len(chunks))
        ids, size = self._ids_of(number)
        total = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(per_text))]
        if len(self.known) > REMEMBERED:
            self._forget()
        return ids, np.diff(total)

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> BpeVocabulary:
    return BpeVocabulary(path)


@functools.lru_cache(maxsize=4)
def token_texts(path: str) -> pa.Array:
    """The text of each token, by id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)])


def encoded_runs(vocab: BpeVocabulary, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, number of ids of each row) of runs of about ``BATCH_BYTES`` bytes of text;
    a null text has no ids."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size, dtype=np.int64) // BATCH_BYTES
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for i, j in itertools.pairwise(edges):
        if i < j:
            yield i, j, *vocab.encode_batch([t or "" for t in texts.slice(i, j - i).to_pylist()])


def _encode_batches(tokenizer: str):
    """Batches with ``text`` become batches with ``ids``."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(local_file(tokenizer))
        for batch in batches:
            for i, j, ids, count in encoded_runs(vocab, batch.column("text")):
                off = np.append(0, np.cumsum(count)).astype(np.int32)
                part = batch.slice(i, j - i).drop_columns(["text"])
                yield part.append_column("ids", pa.ListArray.from_arrays(pa.array(off), pa.array(ids)))
    return encode


def _decode_batches(tokenizer: str):
    """Batches with ``ids`` get ``decoded``."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = token_texts(local_file(tokenizer))
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids = part.column("ids")
                if ids.null_count:
                    ids = pc.fill_null(ids, pa.scalar([], pa.list_(pa.int32())))
                off = np.zeros(len(ids) + 1, np.int32)
                np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False), out=off[1:])
                tokens = pa.ListArray.from_arrays(pa.array(off), texts.take(ids.flatten()))
                yield part.append_column("decoded", pc.binary_join(tokens, " "))
    return decode


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_DECODED = T.StructField("decoded", T.StringType())


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
               carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, ids array<int>`` and the columns to carry, per input row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text_col).alias("text"))
    return rows.mapInArrow(frugal(_encode_batches(tokenizer)), T.StructType([*rows.drop("text").schema, _IDS]))


def bpe_decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows with ``decoded``: the tokens' texts joined by a space (the file names no decoder)."""
    return encoded.mapInArrow(frugal(_decode_batches(tokenizer)), T.StructType([*encoded.schema, _DECODED]))


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """``bpe_decode(bpe_encode(docs))`` with both steps in one Python worker."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text_col).alias("text"))
    encode, decode = _encode_batches(tokenizer), _decode_batches(tokenizer)
    return rows.mapInArrow(frugal(lambda batches: decode(encode(batches))),
                           T.StructType([*rows.drop("text").schema, _IDS, _DECODED]))


#: The vocabulary file of the registered queries.
PUBLIC = "word_bpe_49k.json"


def public_path(name: str = PUBLIC) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def local_file(tokenizer: str) -> str:
    """The place of a vocabulary file on this machine: a path, or the bare name of a public file,
    which each worker looks up for itself."""
    return tokenizer if "/" in tokenizer else public_path(tokenizer)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_round_trip(read(spark, sf_dir, "documents"), PUBLIC)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
