import random

import pytest
from pyspark.sql import functions as F

from civicframe.llm import components, jaccard_join


def brute(by_id, words, percent):
    sets = {}
    for d, t in by_id.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[d] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: (len(sets[d]), top(d)) for d in sets}


def check(df, by_id, words=3, percent=90):
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()} == brute(by_id, words, percent)


def near_copies(seed, groups=6, size=14):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(500)}"
    out = []
    passage = [word() for _ in range(30)]
    for g in range(groups):
        base = [word() for _ in range(r.randrange(20, 120))]
        if g % 2:
            base = passage * (1 if g % 3 else 3) + base[: r.randrange(1, 12)]
        for _ in range(size):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w).title() if r.random() < 0.3 else " ".join(w))
    r.shuffle(out)
    return out


def test_against_brute_force(docs, by_id):
    check(jaccard_join.similarity_classes(docs), by_id)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, seed):
    texts = near_copies(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check(jaccard_join.similarity_classes(df), dict(enumerate(texts)))


def test_lists_that_are_long(spark):
    """With a limit of two, nearly every list goes through blocks, here many small ones."""
    texts = near_copies(3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check(jaccard_join.similarity_classes(df, words=2, percent=80, longest=2, block_tokens=600), dict(enumerate(texts)), 2, 80)


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_blocks_of_chains_and_strangers(spark, seed):
    """Groups of several blocks whose members link in chains, in parts, or only share a passage."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    passage, texts = [word() for _ in range(25)], []
    for _ in range(3):  # chains: each edits the one before
        w = passage + [word() for _ in range(30)]
        for _ in range(25):
            texts.append(" ".join(w))
            w = list(w)
            w[r.randrange(25, len(w))] = word()
    texts += [" ".join(passage + [word() for _ in range(r.randrange(1, 12))]) for _ in range(30)]
    texts += [" ".join(r.sample(passage, 3) * 20 + [word()]) for _ in range(10)]
    r.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for block_members in (3, 20):
        check(jaccard_join.similarity_classes(df, words=2, percent=85, longest=2, block_members=block_members), dict(enumerate(texts)), 2, 85)


def test_marks(spark):
    import numpy as np

    r = np.random.default_rng(1)
    tokens = r.integers(-(2**63), 2**63, 3000)
    bitmap = jaccard_join.marks(spark.createDataFrame([(int(x),) for x in tokens[:1000]], "token long"))
    found = jaccard_join.is_marked(bitmap, tokens.view(np.uint64))
    assert found[:1000].all() and found[1000:].mean() < 0.01
    assert not jaccard_join.is_marked(jaccard_join.marks(spark.createDataFrame([], "token long")), tokens.view(np.uint64)).any()


def test_empty_and_repeated_rows(docs, empty, by_id):
    assert jaccard_join.similarity_classes(empty).count() == 0
    got = jaccard_join.similarity_classes(docs.union(docs))
    assert got.count() == 2 * len(by_id)
    check(got, by_id)


def test_components_of_a_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.range(1000, 1005).select("id", F.lit(1010)))
    got = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in (*range(1000, 1005), 1010))


def test_pairs_by_slices(spark, monkeypatch):
    """No table or shuffle holds all pairs of the lists at once, and the slices together find the same links."""
    texts, made = near_copies(4), []
    pairs = jaccard_join._pairs
    monkeypatch.setattr(jaccard_join, "_pairs", lambda percent, slices, this: made.append((slices, this)) or pairs(percent, slices, this))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check(jaccard_join.similarity_classes(df, words=2, percent=80, slice_pairs=12), dict(enumerate(texts)), 2, 80)
    assert made[0][0] > 2 and made == [(made[0][0], k) for k in range(made[0][0])]


def test_strangers_with_frequent_tokens_meet_no_blocks(spark, monkeypatch):
    """Texts that share long lists but don't link aren't dealt to blocks; copies among them are still found."""
    r = random.Random(9)
    texts = [" ".join(r.sample([f"w{i}" for i in range(300)], 150)) for _ in range(200)]
    texts += [t + " again" for t in texts[::7]]
    met, blocks = [], jaccard_join.block_links
    monkeypatch.setattr(jaccard_join, "block_links", lambda members, *a, **k: met.append(members.select("id").distinct().count()) or blocks(members, *a, **k))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check(jaccard_join.similarity_classes(df, words=1), dict(enumerate(texts)), 1)
    assert met[0] < 20


@pytest.mark.parametrize("percent", [50, 80, 90, 95, 100])
def test_linked_sets_share_a_part_and_their_parities_are_near(percent):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(percent)
    linked = 0
    for n in [*range(1, 60), 300, 2000, 9000]:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for way in range(3):  # tokens dropped, added, or both, as many as two linked sets can differ in
            lost, new = (0, n * (100 - percent) // percent) if way == 0 else (n - -(-n * percent // 100), 0) if way == 1 else [n * (100 - percent) // (100 + percent)] * 2
            b = np.unique(np.concatenate([rng.permutation(a)[lost:], rng.integers(0, 2**63, new).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < percent * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            assert len(np.intersect1d(jaccard_join.signatures(a, percent), jaccard_join.signatures(b, percent)))
            row = [[0], [1], [len(a)], [len(b)], [jaccard_join.parities(a)], [jaccard_join.parities(b)]]
            batch = pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["a", "b", "an", "bn", "x", "y"])
            assert next(jaccard_join._near(percent)(iter([batch]))).num_rows == 1
            linked += 1
    assert linked > 20 or percent == 100
