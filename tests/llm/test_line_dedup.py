"""Line dedup against plain Python, and edge rows."""

from collections import defaultdict

from stakeflow.llm import line_dedup as D

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                docs[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(docs.get(key(x), ())) >= 3 and max(docs[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_edges(spark):
    a, b = "A line of twenty characters or more", "Ünïcode line that is as long as the other"
    rows = [(1, f"{a}\nshort\n {a.upper()}\t"), (2, f"{b}\n\n{a}\n"), (3, f"x\r\n{a}\n{b}"), (4, b), (5, None), (6, ""), (7, "\n\n"),
            (8, "\n".join([a, b] * 3000)), (9, "é" * 19), (10, "é" * 20), (11, "é" * 20 + " "), (12, "É" * 20), (13, "é" * 20),
            (13, "é" * 20), (13, f"other row of the same document\n{a}")]
    df = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in rows], "doc_id bigint, text string, pos int, h1 int, key string")
    got = sorted(tuple(r) for r in D.line_dedup(df).collect())
    assert got == brute(rows)
    assert D.line_dedup(df.limit(0)).count() == 0


def test_null_id_and_digest(spark):
    a = "A line of twenty characters or more"
    df = spark.createDataFrame([(None, a), (1, a), (2, a)], "doc_id bigint, text string")
    got = {r.doc_id: r.kept_text for r in D.line_dedup(df).collect()}
    assert got == {None: "", 1: "", 2: a}
