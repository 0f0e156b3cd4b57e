import hashlib
from collections import defaultdict

from civicframe.llm import line_dedup


def brute_lines(by_id, min_docs, min_chars):
    """doc -> (lines, dropped, kept)"""
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower().decode()
    where = defaultdict(set)
    for d, t in by_id.items():
        for x in (t or "").split("\n"):
            where[key(x)].add(d)
    out = {}
    for d, t in by_id.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(where[key(x)]) < min_docs]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def check(df, by_id, min_docs=10, min_chars=1):
    want = brute_lines(by_id, min_docs, min_chars)
    got = df.collect()
    assert len(got) == len(want)
    for r in got:
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_lines"], r["n_dropped"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


LINES = ["Ein Ärger", "ein Ärger", " EIN Ärger\t", "ein ärger", "K", "K", "k ", "", " ", "\x0b", "\x1c", "a\rb", "İ", "same", "Same"]


def test_against_brute_force(spark, docs, by_id):
    check(line_dedup.digest(docs), by_id)
    check(line_dedup.digest(docs, min_docs=2, min_chars=0, batches=5), by_id, 2, 0)


def test_keys(spark):
    texts = {i: "\n".join(LINES[(i * k) % len(LINES)] for k in range(1, 9)) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for least in (2, 10, 31):
        check(line_dedup.digest(df, min_docs=least), texts, least)


def test_empty_and_repeated_rows(docs, empty, by_id):
    assert line_dedup.digest(empty).count() == 0
    once = {tuple(r) for r in line_dedup.digest(docs, min_docs=3).collect()}
    twice = line_dedup.digest(docs.union(docs), min_docs=3).collect()
    assert {tuple(r) for r in twice} == once and len(twice) == 2 * len(by_id)
