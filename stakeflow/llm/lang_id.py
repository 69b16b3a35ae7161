"""Language ID with a byte convolutional network.

The network reads fixed-length windows of bytes: filters of several widths
over one-hot bytes, ReLU, max pooling over the window, and a softmax layer.
It is trained in numpy on the driver on a bounded, documented sample of
labelled text (``per_lang`` documents of each language, ``windows`` windows of
each at hashed places of the whole text), and applied in Arrow batches to every
window of every whole text; a text's answer is the mean of its windows'
probabilities, weighted by their bytes.

Only texts and languages of documents with ``crc32(doc_id) mod 5 <> 0`` are
learned from.  A filter's answer is a sum of table rows picked by bytes, so a
worker needs the weights alone (about 200 kB); nothing is shuffled.

Defined results: a null text, or one without letters, is ``und`` with score 0;
without any labelled row all are ``und``; a null ``doc_id`` is not held out
and not learned from; rows repeating a ``doc_id`` are separate rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import textnum as T
from stakeflow.llm.tables import read

WINDOW = 128
WIDTHS = (3, 4, 5)
FILTERS = 16
BLOCK = 256  # windows that are convolved at once


@dataclass
class ByteCnn:
    """Weights: one (width, 256, FILTERS) table per width, and the softmax layer."""

    langs: list[str]
    tables: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, x: np.ndarray, places: bool = False):
        """Max over the window of every filter (and where it is) for byte windows ``x``."""
        best, at = [], []
        for table, bias in zip(self.tables, self.bias):
            width = len(table)
            span = x.shape[1] - width + 1
            conv = table[0][x[:, :span]]
            for j in range(1, width):
                conv += table[j][x[:, j:j + span]]
            if places:
                p = conv.argmax(1)
                at.append(p)
                best.append(np.take_along_axis(conv, p[:, None], 1)[:, 0] + bias)
            else:
                best.append(conv.max(1) + bias)
        h = np.concatenate(best, 1)
        return (h, at) if places else h

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(x), 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def windows_of(data: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """All windows of one text, the last filled up with zeros."""
    n = max(1, -(-len(data) // length))
    x = np.zeros(n * length, np.uint8)
    x[:len(data)] = data
    return x.reshape(n, length)


def train(texts: list[str], langs: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01,
          seed: int = 7) -> ByteCnn:
    """Fit by Adam on windows of labelled text; gradients pass the max pool at its places only."""
    names = sorted(set(langs))
    x = np.concatenate([windows_of(np.frombuffer(t.encode()[:WINDOW], np.uint8)) for t in texts])
    y = np.array([names.index(v) for v in langs])
    rng = np.random.default_rng(seed)
    k = len(WIDTHS) * FILTERS
    net = ByteCnn(names, [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                  [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                  rng.normal(0, 0.2, (k, len(names))).astype(np.float32), np.zeros(len(names), np.float32))
    params = [*net.tables, *net.bias, net.out, net.out_bias]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    lane = np.arange(FILTERS)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            xb = x[rows]
            h, at = net.pooled(xb, places=True)
            a = np.maximum(h, 0)
            z = a @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            dh = (p @ net.out.T) * (h > 0)
            grads = []
            for f, (table, place) in enumerate(zip(net.tables, at)):
                g = dh[:, f * FILTERS:(f + 1) * FILTERS]
                dt = np.empty_like(table)
                for j in range(len(table)):
                    byte = np.take_along_axis(xb, place + j, 1).astype(np.int64)
                    dt[j] = np.bincount((byte * FILTERS + lane).ravel(), g.ravel(),
                                        256 * FILTERS).reshape(256, FILTERS)
                grads.append(dt)
            grads += [dh[:, f * FILTERS:(f + 1) * FILTERS].sum(0) for f in range(len(WIDTHS))]
            grads += [a.T @ p, p.sum(0)]
            step += 1
            for q, g, mq, vq in zip(params, grads, m, v):
                mq += 0.1 * (g - mq)
                vq += 0.001 * (g * g - vq)
                q -= (rate * (mq / (1 - 0.9 ** step)) / (np.sqrt(vq / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def sample(labelled: DataFrame, per_lang: int, windows: int) -> list[tuple[str, str]]:
    """(text of a window, lang): ``windows`` windows of about ``per_lang`` documents of each
    language, at most twice that many in all."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, per_lang / n)])
    unit = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    room = F.greatest(F.length("text") - F.lit(WINDOW), F.lit(0)) + 1
    starts = F.array(*[(F.pmod(F.xxhash64("doc_id", F.lit(i)), room) + 1).cast("int") for i in range(windows)])
    rows = (labelled.where(unit < share[F.col("lang")])
            .select("doc_id", "lang", "text", F.explode(F.array_distinct(starts)).alias("at"))
            .select("doc_id", "lang", "at", F.expr(f"substring(text, at, {WINDOW})").alias("text"))
            .limit(2 * per_lang * windows * len(counts)).collect())
    rows.sort(key=lambda r: (r["doc_id"], r["at"]))
    return [(r["text"], r["lang"]) for r in rows]


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                per_lang: int = 300, windows: int = 4) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per input row."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("text"),
                       F.col(lang_col).alias("lang"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    seen = sample(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                             & F.col("letters")), per_lang, windows)
    net = train([t for t, _ in seen], [v for _, v in seen]) if seen else None

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for i, j, data, off in T.chunks(batch.column("text")):
                lang, score = ["und"] * (j - i), np.zeros(j - i)
                known = np.flatnonzero(letters[i:j]) if net else []
                if len(known):
                    total = _document_means(net, data, off, known)
                    for k, p in zip(known, total):
                        lang[k] = net.langs[int(p.argmax())]
                        score[k] = min(1.0, float(p.max()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i),
                     pa.array(lang, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    return (rows.select("doc_id", "held_out", "letters", "text")
            .mapInArrow(T.frugal(predict), "doc_id bigint, held_out boolean, lang_pred string, score double"))


def _document_means(net: ByteCnn, data: np.ndarray, off: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Mean class probabilities of each text over its windows, weighted by their bytes."""
    length = off[docs + 1] - off[docs]
    n = -(-length // WINDOW)
    owner = np.repeat(np.arange(len(docs)), n)
    first = np.cumsum(n) - n
    begin = off[docs][owner] + (np.arange(len(owner)) - first[owner]) * WINDOW
    size = np.minimum(WINDOW, off[docs + 1][owner] - begin)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    total = np.zeros((len(docs), len(net.langs)))
    step = np.arange(WINDOW)
    for i in range(0, len(owner), BLOCK):
        x = padded[begin[i:i + BLOCK, None] + step]
        x[step >= size[i:i + BLOCK, None]] = 0
        p = net.probabilities(x) * size[i:i + BLOCK, None]
        np.add.at(total, owner[i:i + BLOCK], p)
    return total / length[:, None]


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))
