"""Quality rules: counts against plain Python, host verdicts, edge rows."""

import random
import re
from collections import Counter

from stakeflow.llm import quality_rules as Q


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = Counter(x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()), len(hit))


TEXTS = [None, "", " \n\n ", "one", "a b c a b c a b c", "a b\nc d\na b\n a b\na b", "é#*$%&|<>x\r\n\r\n", "a " * 9000,
         "line\x0bwith\x0ctabs\tand\rmore", "dup\n\ndup\n\n", "x\n" * 70, " ".join(f"w{i}" for i in range(60))]


def test_counts(spark):
    rows = [(i, t, "h", 1, True) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_words int, kept boolean")
    got = {r.doc_id: tuple(r[s] for s in Q.STATS) for r in Q.document_stats(df).collect()}
    assert got == {i: counts(t) for i, t in enumerate(TEXTS)}


def test_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too few"
    rows = [(i, good, "clean") for i in range(40)] + [(100 + i, bad, "junk") for i in range(80)] + [(300, good, "junk"), (301, good, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.kept for r in Q.quality_rules(df).collect()}
    assert all(kept[i] for i in range(40)) and not any(kept[100 + i] for i in range(80)) and not kept[300] and kept[301]
    hosts = {r.host: r for r in Q.host_verdicts(Q.document_stats(df)).collect()}
    assert 0 < hosts["clean"].host_rate < 0.1 and 0.75 < hosts["junk"].host_rate < 1  # shrunk towards the others
    assert Q.quality_rules(df.limit(0)).count() == 0


def test_planted_bad_host_among_alike_ones(spark):
    """Twenty hosts fail at about a tenth; one at a third: it goes, and none of the others does."""
    good, bad = " ".join(f"w{i}" for i in range(60)), "too few"
    rng = random.Random(4)
    rows = [(h * 1000 + i, bad if rng.random() < 0.1 else good, f"host{h}") for h in range(20) for i in range(rng.choice([60, 200]))]
    rows += [(90_000 + i, bad if i % 3 == 0 else good, "planted") for i in range(150)]
    rows += [(95_000 + i, bad, f"tiny{i}") for i in range(2)] + [(96_000, good, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = Q.quality_rules(df)
    gone = {r.host for r in Q.host_verdicts(Q.document_stats(df)).where("not host_ok").collect()}
    assert "planted" in gone and not any(h and h.startswith("host") for h in gone) and None not in gone
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert all(kept[i] == (t == good and h != "planted") for i, t, h in rows)


def test_one_host_alone_and_hosts_that_fail_wholly(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too few"
    alone = spark.createDataFrame([(1, good, "a"), (2, bad, "a")], "doc_id bigint, text string, source string")
    assert {r.doc_id: r.kept for r in Q.quality_rules(alone).collect()} == {1: True, 2: False}
    all_bad = spark.createDataFrame([(1, bad, "a"), (2, bad, "b"), (3, bad, "c")], "doc_id bigint, text string, source string")
    assert not any(r.kept for r in Q.quality_rules(all_bad).collect())
