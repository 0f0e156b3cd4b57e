import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pytest

from civicframe.llm import packing, tokens

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(tokens.default_path())


ODD = ["It's DON'T we've", "a<|endoftext|>b", "é è ÀÉ ÿß", "x́ é ́", "１２ Ⅷ ² ½ 12a b3", "ΣΑΣ İI", "  x\ty\x0b\x1cz", "###*** a&&&", "日本語 テスト", "", " ", "\n\n", "ªº×÷", "a_b [c] ~x~", "ab'cd''s"]


def test_ids_equal_the_tokenizer(plain, texts):
    tok = tokens.WordTokenizer(tokens.default_path())
    some = ODD + [t or "" for t in texts]
    for _ in range(2):  # the second time from the tables
        for t, raw in zip(some, tok.encode(some), strict=True):
            assert np.frombuffer(raw, tok.dtype).tolist() == plain.encode(t, add_special_tokens=False).ids, t


def check(rows, by_id, plain, window=2048):
    ids = {d: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for d, t in by_id.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        part = own[r["start"] : r["start"] + r["length"]]
        assert r["length"] == len(part) > 0 and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for d, x in pieces.items():
        at = 0
        for a, n in sorted(x):
            assert a == at
            at += n
        assert at == len(ids[d])
    for x in sequences.values():
        at = 0
        for a, n in sorted(x):
            assert a == at
            at += n
        assert at == window or at < window and at & (at - 1) == 0  # no padding at all
    return sequences


def test_packing(docs, by_id, plain):
    check(packing.pack(docs).collect(), by_id, plain)


def test_small_windows_and_shards(docs, by_id, plain):
    check(packing.pack(docs, window=64, shard_tokens=500).collect(), by_id, plain, 64)


def test_neighbours_are_lexical():
    r = np.random.default_rng(1)
    docs = [(i, 0, 50, r.integers(1000 * (i % 4), 1000 * (i % 4) + 60, 50)) for i in range(40)]
    rows = list(packing.pack_shard(docs, 500, count()))
    groups = defaultdict(set)
    for doc, *_, sequence, _ in rows:
        groups[sequence].add(doc % 4)
    assert sum(len(g) for g in groups.values()) <= len(groups) + 4


def test_neighbours_by_all_terms():
    """Every document that shares any term, in the order of the whole BM25 score, also when used documents have left the index."""
    r = np.random.default_rng(2)
    texts = [np.concatenate((r.integers(0, 40, 10), np.arange(1000 + 30 * i, 1020 + 30 * i))) for i in range(25)]
    size = np.array([len(t) for t in texts])
    sets = [set(t.tolist()) for t in texts]
    index = packing.Index(texts)
    gone = np.arange(25) % 3 == 1
    index.drop(gone)
    for seed in range(25):
        want = {}
        for d in np.flatnonzero(~gone).tolist():
            for t in sets[seed] & sets[d]:
                df, tf = sum(t in s for s in sets), int((texts[d] == t).sum())
                want[d] = want.get(d, 0) + np.log(1 + (25 - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * size[d] / size.mean()))
        want.pop(seed, None)
        got = [d for d in index.neighbours(seed).tolist() if d != seed]
        assert set(got) == set(want)
        scores = [want[d] for d in got]
        assert all(a >= b - 1e-9 for a, b in zip(scores, scores[1:], strict=False))


def test_repeated_rows_are_packed_each(docs, by_id, plain):
    rows = packing.pack(docs.union(docs)).collect()
    lengths = {}
    for r in rows:
        lengths.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in lengths.values():
        assert sum(n for _, n in x) == max(a + n for a, n in x) <= 2048
    assert sum(r["length"] for r in rows) == 2 * sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for t in by_id.values())


def test_empty(empty):
    assert packing.pack(empty).count() == 0


def test_the_quick_way_is_taken():
    tok = tokens.WordTokenizer(tokens.default_path())
    assert tok.quick is not tok.tokenizer


def brute_scores(docs, seed):
    """BM25 of each document for all terms of the seed that another document has too."""
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = defaultdict(int)
    for d in docs:
        for t in set(d):
            df[t] += 1
    out = []
    for d in docs:
        score = 0.0
        for t in set(docs[seed]):
            if df[t] > 1 and t in d:
                tf = d.count(t)
                score += np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))
        out.append(score)
    return out


def corpus(seed, n=60):
    r = np.random.default_rng(seed)
    topics = [r.integers(0, 400, 30) for _ in range(5)]
    return [np.concatenate([r.choice(topics[r.integers(5)], r.integers(1, 40)), r.integers(0, 400, r.integers(0, 10)), [1]]).astype(np.uint16) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_retrieval_against_brute_force(seed):
    docs = corpus(seed)
    index, plain = packing.Index(docs), [d.tolist() for d in docs]
    for k in range(len(docs)):
        scores = brute_scores(plain, k)
        got = index.neighbours(k).tolist()
        assert set(got) == {i for i, s in enumerate(scores) if s > 0}
        assert np.allclose([scores[i] for i in got], sorted((s for s in scores if s > 0), reverse=True))


def test_windows_against_brute_force():
    """Each window holds the first unused document and its best unused neighbours, in their order."""
    docs = corpus(3)
    plain, window = [d.tolist() for d in docs], 64
    left, want = [len(d) for d in docs], []
    scores = {}
    while sum(left) >= window:
        line, room = [], window
        while room:
            seed = next((k for k, x in enumerate(left) if x), None)
            if seed is None:
                break
            scores.setdefault(seed, brute_scores(plain, seed))
            for k in [seed, *sorted((i for i, s in enumerate(scores[seed]) if s > 0), key=lambda i: (-round(scores[seed][i], 9), i))]:
                take = min(room, left[k])
                if take:
                    line.append((k, take))
                    left[k] -= take
                    room -= take
        want.append(line)
    got = defaultdict(list)
    for doc, _, length, _, _, name, _ in packing.pack_shard([(i, 0, len(d), d) for i, d in enumerate(docs)], window, count()):
        got[name].append((doc, length))
    whole = [x for x in got.values() if sum(n for _, n in x) == window]
    assert whole == want[: len(whole)] and len(whole) >= len(want) - 1


MARKS = [tokens.CUT_PROBE, "H\u0331. h\u0331 T\u0308x W\u030a J\u030c I\u0307 =\u0338a", "A<|ENDOFTEXT|>B. c", "it's.'s a.'T b'.c", "R2.D2 x_1 7%", "\u212bngstr\u00f6m. Caf\u00e9, \u00c9T\u00c9!", "\x00a.\x1cB", "\u0391\u03a3. \u0391\u03a3 A\u03a3"]


def test_cut_texts_have_the_tokenizers_ids(plain):
    """Cutting at signs and lower case changes no id, whatever stands beside them."""
    tok = tokens.WordTokenizer(tokens.default_path())
    assert tok.cut is tokens.cut_texts
    signs = [chr(x) for x in range(1, 128)] + ["\u0331", "\u0308", "\u00e9", "\u4e2d", "\u00a0", "\u0130", "\u00b2"]
    some = MARKS + [a + b + c + "Z" for a in "aH1" for b in signs for c in signs]
    for t, raw in zip(some, tok.encode(some), strict=True):
        assert np.frombuffer(raw, tok.dtype).tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_forms_of_a_word_are_one_part():
    tok = tokens.WordTokenizer(tokens.default_path())
    tok.encode(["Alpha alpha, ALPHA. (alpha) alpha/Alpha"])
    assert set(tok.parts) == {"", "alpha", ",", ".", "(", ")", "/"}
