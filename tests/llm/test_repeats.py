import hashlib
import random

import numpy as np
import pyarrow as pa

from civicframe.llm import automaton_dedup, repeats, suffix_dedup
from civicframe.llm.suffix_array import permuted_lcp, suffix_array


def brute(symbols: dict, window: int) -> dict:
    """doc -> flags of the symbols that are covered by a window that starts earlier too."""
    seen, out = set(), {}
    for doc in sorted(symbols):
        s = symbols[doc]
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            w = tuple(s[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        out[doc] = gone
    return out


def check_bytes(got, by_id, window):
    raw = {d: (t or "").encode() for d, t in by_id.items()}
    want = brute(raw, window)
    assert len(got) == len(raw)
    for r in got:
        gone = want[r["doc_id"]]
        kept = bytes(b for b, g in zip(raw[r["doc_id"]], gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(gone), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def check_words(got, by_id, window):
    words = {d: (t or "").encode().split() for d, t in by_id.items()}
    want = brute(words, window)
    assert len(got) == len(words)
    for r in got:
        gone = want[r["doc_id"]]
        kept = b" ".join(w for w, g in zip(words[r["doc_id"]], gone, strict=True) if not g)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(gone), sum(gone), hashlib.sha256(kept).hexdigest())


def test_suffix_array_sorts():
    r = random.Random(3)
    for _ in range(300):
        k = r.choice([1, 2, 3, 256])
        text = bytes(r.randrange(k) for _ in range(r.randrange(80)))
        if r.random() < 0.3:
            text = text[:7] * 9
        x = np.frombuffer(text, np.uint8)
        sa = suffix_array(x).tolist()
        assert sa == sorted(range(len(text)), key=lambda i: text[i:])
        plcp = permuted_lcp(x, np.array(sa, np.int64), 12)
        for a, b in zip(sa, sa[1:], strict=False):
            n = 0
            while n < 12 and text[a + n : a + n + 1] == text[b + n : b + n + 1] != b"":
                n += 1
            assert plcp[b] == n


def test_suffix_array_sorts_only_what_is_tied(monkeypatch):
    """Also to a depth; the reduced string isn't sorted as a whole for each doubled length."""
    r = random.Random(8)
    passage = "".join(r.choices("abcdefgh", k=300))
    text = "".join("".join(r.choices("abcdefgh", k=300)) + passage[r.randrange(200) :] for _ in range(60)).encode()
    x = np.frombuffer(text, np.uint8)
    assert suffix_array(x).tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    wide, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *args, **kwargs: (wide.append(len(a) if a.dtype.itemsize == 8 else 0), argsort(a, *args, **kwargs))[1])
    sa = suffix_array(x, depth=100).tolist()
    cut = [text[i : i + 100] for i in sa]
    assert sorted(sa) == list(range(len(text))) and cut == sorted(cut)
    assert sum(wide) < len(text)


def test_shards_against_brute_force():
    r = random.Random(9)
    for window in (1, 2, 3, 5):
        for _ in range(100):
            raw = {(d, v): bytes(r.choices(b"ab", k=r.randrange(window, 30))) for d in range(3) for v in r.choice([(0,), (-4, 9)])}
            pieces = []
            for (d, v), t in raw.items():
                lo = r.randrange(len(t) - window + 1)
                n = r.randrange(1, len(t) - window + 2 - lo)
                pieces.append(repeats.Piece(d, v, lo, n, t[lo : lo + n + window - 1]))
            starts = sorted((p.doc, p.ver, p.lo + i, p.raw[i : i + window]) for p in pieces for i in range(p.n))
            seen, want = set(), set()
            for *at, w in starts:
                if w in seen:
                    want.add(tuple(at))
                seen.add(w)
            found = [(p.doc, p.ver, i) for p, a, b in suffix_dedup.shard_repeats(pieces, window) for i in range(a, b + 1)]
            assert len(found) == len(set(found)) and set(found) == want


def test_bytes_against_brute_force(docs, by_id):
    check_bytes(suffix_dedup.digest(docs).collect(), by_id, 100)
    check_bytes(suffix_dedup.dedup_substrings(docs, window=30, gram=8).collect(), by_id, 30)


def test_hot_anchors_are_split(docs, by_id):
    """Ranges and single windows instead of neighbourhoods, and keys with many contents, give the same."""
    for bounds in ({"some": 0}, {"some": 0, "many": 0}, {"contents": 1}, {"some": 0, "contents": 1}):
        check_bytes(suffix_dedup.dedup_substrings(docs, window=30, gram=8, step=5, **bounds).collect(), by_id, 30)
        check_words(automaton_dedup.dedup_words(docs, window=6, gram=2, step=2, **bounds).collect(), by_id, 6)


def test_resolver_finds_all_but_whole_copies(docs, by_id, monkeypatch):
    """Hashes only route: without what the resolver finds, just copies of whole documents are removed."""
    first = {}
    for d in sorted(by_id):
        first.setdefault(by_id[d] or "", d)
    nothing = lambda *_: lambda keys: iter(())
    monkeypatch.setattr(suffix_dedup, "_resolver", nothing)
    monkeypatch.setattr(automaton_dedup, "_resolver", nothing)
    copies = {d for d, t in by_id.items() if first[t or ""] < d}
    assert {r["doc_id"] for r in suffix_dedup.digest(docs).where("n_removed > 0").collect()} == {d for d in copies if len((by_id[d] or "").encode()) >= 100}
    assert {r["doc_id"] for r in automaton_dedup.digest(docs).where("n_removed > 0").collect()} == {d for d in copies if len((by_id[d] or "").split()) >= 20}


def test_several_texts_of_a_doc_id(spark):
    """They are documents of their own: nothing is cut out of the wrong one."""
    words = " ".join(f"w{i}" for i in range(60))
    letters = "".join(random.Random(1).choices("abcdefghij", k=400))
    rows = [(1, "p" * 150), (1, letters), (1, "a " * 60), (1, words), (2, words), (2, letters[:200]), (3, "p" * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.digest(docs).collect()}
    assert got == {(1, 150, 149), (1, 400, 0), (1, 120, 118), (1, len(words), 0), (2, len(words), len(words)), (2, 200, 200), (3, 150, 150)}
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in automaton_dedup.digest(docs).collect()}
    assert got == {(1, 1, 0), (1, 60, 59), (1, 60, 0), (2, 60, 60), (2, 1, 0), (3, 1, 0)}


def test_very_long_texts(spark):
    """Over several segments, with repeats across their borders."""
    r = random.Random(2)
    long = " ".join(f"{r.choice('abcdef')}{r.randrange(10**6)}" for _ in range(160_000))
    rows = [(1, long), (2, "start " + long[600_000:700_000] + " end"), (3, long[1000:1050])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"]) for x in suffix_dedup.digest(docs).collect()}
    assert len(long) > 3 * (1 << 18) and got[1] == got[3] == (0, 0) and got[2][1] == 1 and 100_000 <= got[2][0] <= 100_002
    got = {x["doc_id"]: x["n_removed"] for x in automaton_dedup.digest(docs).collect()}
    assert got[1] == got[3] == 0 and abs(got[2] - len(long[600_000:700_000].split())) <= 2


def test_words_against_brute_force(docs, by_id):
    check_words(automaton_dedup.digest(docs).collect(), by_id, 20)
    check_words(automaton_dedup.dedup_words(docs, window=6, gram=2).collect(), by_id, 6)


def test_automaton_statistics():
    r = random.Random(5)
    for _ in range(200):
        seqs = [[r.randrange(3) for _ in range(r.randrange(12))] for _ in range(3)]
        a = automaton_dedup.SuffixAutomaton()
        for s in seqs:
            a.add(s)
        q = [r.randrange(4) for _ in range(14)]
        subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        want = [max([n for n in range(1, i + 2) if tuple(q[i + 1 - n : i + 1]) in subs], default=0) for i in range(len(q))]
        assert a.statistics(q) == want


def test_empty_and_repeated_rows(docs, empty, by_id):
    assert suffix_dedup.digest(empty).count() == automaton_dedup.digest(empty).count() == 0
    once = {tuple(r) for r in suffix_dedup.digest(docs).collect()}
    twice = [tuple(r) for r in suffix_dedup.digest(docs.union(docs)).collect()]
    assert set(twice) == once and len(twice) == 2 * len(once)
    once = {tuple(r) for r in automaton_dedup.digest(docs).collect()}
    assert {tuple(r) for r in automaton_dedup.digest(docs.union(docs)).collect()} == once


def test_resolvers():
    piece = lambda d, lo, n, raw: repeats.Piece(d, 0, lo, n, raw)
    group = [piece(1, 0, 4, b"abcdefg"), piece(2, 5, 2, b"abcde"), piece(3, 0, 3, b"xbcdef")]
    words = [piece(p.doc, p.lo, p.n, b" ".join(bytes([c]) for c in p.raw)) for p in group]
    for most in (1, 1 << 20):
        assert {(p.doc, a, b) for p, a, b in suffix_dedup._resolver(4, most)(iter([group, group]))} == {(2, 5, 6), (3, 1, 2)}
    assert {(p.doc, a, b) for p, a, b in automaton_dedup._resolver(4)(iter([words]))} == {(2, 5, 6), (3, 1, 2)}


def decided(rows, most, size):
    """What _decide makes of rows (key, content, doc, lo), read in batches of a size."""
    u = lambda x: np.array(x, np.int64)
    key, content, doc, lo = (u([r[i] for r in rows]) for i in range(4))
    parts = [pa.RecordBatch.from_arrays([pa.array(x[a : a + size]) for x in (key, np.zeros(len(key), bool), key, content, doc, u([0] * len(key)), lo, lo)], [x.split()[0] for x in repeats.ROUTED.split(", ")]) for a in range(0, len(key), size)]
    out = [r for b in repeats._decide(most)(iter(parts)) for r in b.to_pylist()]
    return sorted((r["what"], r["key"] if r["key"] in (1, 2, 3, 4) else 0, r["doc"], r["second"]) for r in out)


def test_decide_reads_keys_over_many_batches():
    """Also a key whose classes outgrow what is held, whatever the batches."""
    r = random.Random(4)
    rows = []
    for key in (1, 2, 3, 4):
        contents = [r.choice([1, 1, 2, 5]) for _ in range([1, 3, 40, 2][key - 1])]
        rows += [(key, c, 100 * c + k, 0) for c, n in enumerate(contents) for k in range(n)]
    rows += [x for x in rows if r.random() < 0.2]  # repeated rows
    rows.sort()
    want = decided(rows, 10, 10_000)
    for size in (1, 2, 3, 7, 20):
        assert set(decided(rows, 10, size)) == set(want)
    firsts = {k: {x[2] for x in want if x[:2] == (repeats.ASK if k != 3 else repeats.SPLIT, k) and not x[3]} for k in (1, 2, 3)}
    assert firsts == {1: set(), 2: {0, 100, 200}, 3: {100 * c for c in range(40)}}


def test_long_text_in_segments(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 50)
    x = np.random.default_rng(1).integers(0, 2**63, 400).astype(np.uint64)
    starts = sorted(s for text, lo, hi, _, _ in repeats.neighbourhoods(x, np.array([0, 150, 160, 400]), 20, 5) for t, a, b in zip(text, lo, hi, strict=True) for s in range([0, 150, 160][t] + a, [0, 150, 160][t] + b + 1))
    assert starts == [*range(131), *range(160, 381)]


def test_neighbourhoods_of_many_texts(monkeypatch):
    """All windows once, none over a text's end, whatever the segments; short and empty texts have none."""
    r = random.Random(10)
    for segment in (7, 50, 10_000):
        monkeypatch.setattr(repeats, "SEGMENT", segment)
        for _ in range(20):
            sizes = [r.choice([0, 0, 3, 19, 20, 21, 60, 200]) for _ in range(12)]
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            x = np.array([r.randrange(3) for _ in range(offsets[-1])], np.uint64)
            got = [(t, s) for text, lo, hi, _, _ in repeats.neighbourhoods(x, offsets, 20, 5) for t, a, b in zip(text.tolist(), lo.tolist(), hi.tolist(), strict=True) for s in range(a, b + 1)]
            assert got == [(t, s) for t, n in enumerate(sizes) for s in range(n - 19)]
