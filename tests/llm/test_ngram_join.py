"""N-gram Jaccard join against all pairs that share a shingle."""

import random
import re
from collections import Counter, defaultdict

from stakeflow.llm import ngram_join as N

SF = "/root/testdata/sf0.01"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows}
    lists, root = defaultdict(list), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sorted(sets.items()):
        common = Counter(o for g in s for o in lists[g])
        for o, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[o]) - c):
                a, b = find(d), find(o)
                root[max(a, b)] = min(a, b)
        for g in s:
            lists[g].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check(spark, rows, k=4, percent=85, **kw):
    df = spark.createDataFrame([(d, t, d, "x") for d, t in rows], "doc_id bigint, text string, k bigint, n string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_join(df, k, percent, **kw).collect()}
    assert got == brute(rows, k, percent)


def test_whole_table(spark):
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def made(rng):
    rows, n = [], 0
    for _ in range(30):
        base = [f"{rng.choice('abcdefgh')}{rng.randrange(40)}" for _ in range(rng.choice([1, 3, 5, 9, 14, 30, 90]))]
        for _ in range(rng.randrange(1, 12)):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(words))
                words[at:at + 1] = rng.choice([[], ["new%d" % rng.randrange(99)], [words[at], words[at]]])
                words = words or ["w"]
            rows.append((n * 7 % 1009, " ".join(words[:rng.choice([len(words), len(words), max(1, len(words) * 9 // 10)])])))
            n += 1
    return rows + [(5000, None), (5001, ""), (5002, "  \n"), (5003, "one two three"), (5004, "ONE two three"),
                   (5005, "w " * 5000), (5006, "W " * 4000)]


def test_light_and_heavy_sets(spark):
    rows = made(random.Random(11))
    for boundary in (None, 0, 12, 10**6):
        check(spark, rows, boundary=boundary)
    check(spark, rows, k=2, percent=60, boundary=20)


def test_common_shingles_take_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(N, "COMMON_IN_SAMPLE", 3)
    check(spark, made(random.Random(12)))


def test_repeated_and_null_rows(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(2, text), (2, text), (1, text.upper()), (None, text), (3, "q"), (3, None)], "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0) for r in N.ngram_join(df).collect())
    assert got == [(0, 5, 0), (1, 5, 1), (2, 5, 1), (2, 5, 1), (3, 0, 3), (3, 1, 3)]
    assert N.ngram_join(df.limit(0)).count() == 0
