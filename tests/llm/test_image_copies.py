import tracemalloc
from itertools import combinations

import numpy as np

from civicframe.llm import image_copies, linking


def picture(seed, h=120, w=120):
    r = np.random.default_rng(seed)
    small = r.uniform(0, 255, (h // 8, w // 8)).astype(np.float32)
    return (image_copies._resize(h // 8, h) @ small @ image_copies._resize(w // 8, w).T).clip(0, 255).astype(np.uint8)


def resized(p, by):
    h, w = round(p.shape[0] * by), round(p.shape[1] * by)
    return (image_copies._resize(p.shape[0], h) @ p.astype(np.float32) @ image_copies._resize(p.shape[1], w).T).round().clip(0, 255).astype(np.uint8)


def turned(p, degrees):
    """About the middle; what comes from outside is black."""
    t = np.deg2rad(degrees)
    yy, xx = np.mgrid[: p.shape[0], : p.shape[1]] - (np.array(p.shape)[:, None, None] - 1) / 2
    x, y = np.cos(t) * xx - np.sin(t) * yy + (p.shape[1] - 1) / 2, np.sin(t) * xx + np.cos(t) * yy + (p.shape[0] - 1) / 2
    inside = (x >= 0) & (y >= 0) & (x < p.shape[1] - 1) & (y < p.shape[0] - 1)
    i, j = np.where(inside, y, 0).astype(int), np.where(inside, x, 0).astype(int)
    fy, fx, q = y - i, x - j, p.astype(float)
    v = q[i, j] * (1 - fx) * (1 - fy) + q[i, j + 1] * fx * (1 - fy) + q[i + 1, j] * (1 - fx) * fy + q[i + 1, j + 1] * fx * fy
    return np.where(inside, v, 0).round().clip(0, 255).astype(np.uint8)


def described(p):
    _, places, bits = image_copies.describe(p[None])
    return places.astype(np.float32), bits


def rows_of(pictures):
    return [(i, None, None, None) if p is None else (i, p.shape[1], p.shape[0], p.tobytes()) for i, p in pictures]


def test_crops_edits_and_turns_are_found(spark):
    r = np.random.default_rng(0)
    out, want = [], {}
    for s in range(8):
        p = picture(s)
        edits = [p, p[10:, 15:], p[:-20, 5:-9], np.rot90(p), (p * 0.7 + 30).astype(np.uint8), np.clip(p + r.normal(0, 4, p.shape), 0, 255).astype(np.uint8)]
        stamped = p.copy()
        stamped[20:40, 30:60] = 0
        edits.append(stamped)
        for k, e in enumerate(edits):
            out.append((s * 100 + k, np.ascontiguousarray(e)))
            want[s * 100 + k] = s * 100
    for s in range(30):
        out.append((5000 + s, picture(1000 + s)))
        want[5000 + s] = 5000 + s
    out += [(9000, np.zeros((50, 50), np.uint8)), (9001, np.zeros((50, 50), np.uint8)), (9002, None), (9003, None), (9004, np.zeros((3, 3), np.uint8))]
    want |= {9000: 9000, 9001: 9000, 9002: 9002, 9003: 9003, 9004: 9004}
    df = spark.createDataFrame(rows_of(out), "image_id long, width int, height int, pixels binary").repartition(4)
    got = {x["image_id"]: x["component_id"] for x in image_copies.copies(df).collect()}
    assert set(got) == set(want)
    assert {i for i in want if want[i] == i or i >= 5000} == {i for i in want if got[i] == want[i] and (want[i] == i or i >= 5000)}  # nothing is linked that shouldn't be
    found = [got[i] == want[i] for i in want if i % 100 and i < 5000]
    assert sum(found) >= 0.95 * len(found)


def test_resized_and_turned_copies_are_found():
    """Candidates by keys, against what verification accepts: at least 0.9 of the copies, here of 15 edits of 12 pictures."""
    edits = [lambda p, b=b: resized(p, b) for b in (0.5, 0.6, 0.75, 0.85, 1.2, 1.5, 2.0)] + [lambda p, d=d: turned(p, d) for d in (5, 10, 20, 30, 45, 70, 135)]
    edits.append(lambda p: np.clip(p + np.random.default_rng(1).normal(0, 16, p.shape), 0, 255).astype(np.uint8))
    shares = []
    for edit in edits:
        found = []
        for s in range(12):
            a, b = described(picture(s, 160, 160)), described(edit(picture(s, 160, 160)))
            assert image_copies.agree(*a, *b) >= image_copies.AGREE
            found.append(len(np.intersect1d(image_copies.tokens_of(*a), image_copies.tokens_of(*b))) > 0)
        shares.append(np.mean(found))
    assert np.mean(shares) >= 0.95 and min(shares) >= 0.75, shares


def test_copies_against_all_pairs(spark):
    """Components of what verification accepts among all pairs; candidates may miss one copy in ten."""
    pictures = {}
    for s in range(8):
        p = picture(300 + s)
        for k, q in enumerate((p, resized(p, 0.7), turned(p, 25), p[20:, 10:], turned(resized(p, 1.3), 80))):
            pictures[10 * s + k] = np.ascontiguousarray(q)
    sets = {i: described(p) for i, p in pictures.items()}
    want = {i: {i} for i in pictures}
    for i, j in combinations(pictures, 2):
        if image_copies.agree(*sets[i], *sets[j]) >= image_copies.AGREE:
            for k in (both := want[i] | want[j]):
                want[k] = both
    assert {frozenset(x) for x in want.values()} == {frozenset(range(10 * s, 10 * s + 5)) for s in range(8)}
    df = spark.createDataFrame(rows_of(list(pictures.items())), "image_id long, width int, height int, pixels binary")
    got = {r["image_id"]: r["component_id"] for r in image_copies.copies(df).collect()}
    assert all(c in want[i] for i, c in got.items())  # no link that all pairs don't have
    assert np.mean([got[i] == min(want[i]) for i in got]) >= 0.9


def test_one_shared_key_is_enough(spark):
    """Copies that share a single key with the picture, and pass verification, are linked."""
    out, want = [], {}
    for s in range(40):
        p = picture(s, 160, 160)
        q = turned(p, 37)
        if len(np.intersect1d(image_copies.tokens_of(*described(p)), image_copies.tokens_of(*described(q)))) == 1:
            assert image_copies.agree(*described(p), *described(q)) >= image_copies.AGREE
            out += [(10 * s, p), (10 * s + 1, q)]
            want |= {10 * s: 10 * s, 10 * s + 1: 10 * s}
    assert out
    df = spark.createDataFrame(rows_of(out), "image_id long, width int, height int, pixels binary")
    assert {x["image_id"]: x["component_id"] for x in image_copies.copies(df).collect()} == want


def test_large_pictures_in_bounded_memory():
    """A noisy picture of 1000 x 800 has some 20,000 corners; comparing all at once would take gigabytes."""
    p = np.random.default_rng(3).integers(0, 256, (800, 1000)).astype(np.uint8)
    tracemalloc.start()
    a, b = described(p), described(p[200:700, 300:900])
    assert len(a[0]) > 10_000
    shared = np.intersect1d(image_copies.tokens_of(*a), image_copies.tokens_of(*b))
    assert len(shared) > 1000 and image_copies.agree(*a, *b) > 2000
    assert tracemalloc.get_traced_memory()[1] < 700 << 20
    tracemalloc.stop()


def test_large_resized_picture_is_found():
    p = picture(77, 640, 800)
    for q in (resized(p, 0.55), turned(p[100:500, 200:700], 33)):
        a, b = described(p), described(q)
        assert len(np.intersect1d(image_copies.tokens_of(*a), image_copies.tokens_of(*b))) and image_copies.agree(*a, *b) >= image_copies.AGREE


def test_repeated_ids_and_clashing_columns(spark):
    """Of an id's different pictures one counts, the same in every run; other columns don't matter."""
    p, q = picture(1), picture(2)
    rows = [(i, 120, 120, x.tobytes(), "a", 1, "b") for i, x in ((1, p), (1, q), (2, p), (3, q), (4, p), (4, p))] + [(4, 1, 1, None, "a", 1, "b")]
    df = spark.createDataFrame(rows, "image_id long, width int, height int, pixels binary, content string, token int, id string")
    got = [{r["image_id"]: r["component_id"] for r in image_copies.copies(x).collect()} for x in (df, df.repartition(3))]
    assert got[0] == got[1] and set(got[0]) == {1, 2, 3, 4} and sorted((got[0][2] == 1, got[0][3] == 1)) == [False, True] and got[0][4] == got[0][2]


def test_lists_over_batches():
    """Pairs of short lists, members of long ones, whatever the batches."""
    import pyarrow as pa

    lists = {1: [5], 2: [1, 2, 3], 3: list(range(20)), 4: [7, 9], 5: list(range(30))}
    rows = [(t, i) for t, ids in lists.items() for i in ids]
    pairs = sorted((None, a, b) for t in (2, 4) for a, b in combinations(lists[t], 2))
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows[i : i + size]], pa.int64()) for k in range(2)], ["token", "id"]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in image_copies._lists(iter(batches)) for r in b.to_pylist()]
        assert sorted(x for x in got if x[0] is None) == pairs
        assert sorted(x[:2] for x in got if x[0] is not None) == [(t, i) for t in (3, 5) for i in lists[t]]


def test_ill_sized_and_empty(spark):
    schema = "image_id long, width int, height int, pixels binary"
    bad = spark.createDataFrame([(1, 5, 5, b"abc"), (2, None, 3, b"abc"), (3, -1, -3, b"abc"), (None, 1, 1, b"a")], schema)
    assert sorted((r["image_id"], r["n_corners"], r["component_id"]) for r in image_copies.copies(bad).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert image_copies.copies(spark.createDataFrame([], schema)).count() == 0


def test_thumbnails_of_vectors(spark):
    v = [[float(i * j % 7) for j in range(64)] for i in range(1, 4)]
    df = spark.createDataFrame([(0, v[0]), (1, v[0]), (2, v[1]), (3, None), (4, [1.0]), (5, [float("nan")] * 64)], "vec_id long, embedding array<double>")
    got = {r["image_id"]: r["component_id"] for r in image_copies.copies(image_copies.thumbnails(df)).collect()}
    assert got[1] == got[0] == 0 and got[2] == 2 and got[3] == 3 and got[4] == 4 and got[5] == 5


def joined_rows(spark, run):
    """Rows that joins put out while ``run`` runs, by Spark's metrics."""
    store = spark._jsparkSession.sharedState().statusStore()
    before, total = store.executionsList().size(), 0
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    done = store.executionsList()
    for k in range(before, done.size()):
        name = done.apply(k).executionId()
        values, nodes = store.executionMetrics(name), store.planGraph(name).allNodes()
        for i in range(nodes.size()):
            metrics = nodes.apply(i).metrics() if "Join" in nodes.apply(i).name() else None
            for j in range(metrics.size() if metrics else 0):
                if metrics.apply(j).name() == "number of output rows" and values.contains(metrics.apply(j).accumulatorId()):
                    total += int(values.apply(metrics.apply(j).accumulatorId()).replace(",", ""))
    return total


def test_lists_of_one_component_are_not_joined_by_member(spark):
    """30 linked copies share 200 long lists: joins take a few rows for each copy, not one for each member of each list."""
    short = spark.createDataFrame([(i, i + 1) for i in range(29)], "a long, b long")
    long = spark.createDataFrame([(t, i, 0) for t in range(200) for i in range(30)] + [(300, i, 40) for i in range(40, 48)], "token long, id long, first long")
    asked, labels = [], []

    def verified(pairs):
        asked.extend((r["a"], r["b"]) for r in pairs.collect())
        return pairs.where("a < 30 or b < 44")

    rows = joined_rows(spark, lambda: labels.extend(linking.link_members(short, long, verified).collect()))
    assert {r["node"]: r["label"] for r in labels} == {i: 0 for i in range(30)} | {i: 40 for i in range(40, 44)}
    assert set(combinations(range(40, 48), 2)) <= {*asked, (40, 41)} | set(combinations(range(40, 44), 2))  # every pair of an open list, but within a component
    assert 0 < rows < 3000


def test_pairs_within_a_component_are_not_all_verified(spark):
    """40 images, all candidates of each other: copies cost a few pairs and rows each, what doesn't link is asked whole."""
    everyone = list(combinations(range(40), 2))
    short = spark.createDataFrame(everyone, "a long, b long")
    long = spark.createDataFrame([(t, i, 100 * t) for t in (1, 2) for i in range(100 * t, 100 * t + 9)], "token long, id long, first long")
    links = {"copies": lambda a, b: True, "two groups, one by a late link": lambda a, b: a % 2 == b % 2 and (b < 39 or a == 37)}
    for name, link in links.items():
        asked, labels = [], []

        def verified(pairs, link=link, asked=asked):
            some = [(r["a"], r["b"]) for r in pairs.collect()]
            asked.extend(some)
            return spark.createDataFrame([(a, b) for a, b in some if b < 40 and link(a, b)], "a long, b long")

        rows = joined_rows(spark, lambda verified=verified, labels=labels: labels.extend(linking.link_members(short, long, verified).collect()))
        want = {i: {i} for i in range(40)}
        for a, b in everyone:
            if link(a, b):
                for k in (both := want[a] | want[b]):
                    want[k] = both
        assert {r["node"]: r["label"] for r in labels} == {i: min(x) for i, x in want.items() if len(x) > 1}, name
        assert len(asked) == len(set(asked)), name
        assert {(a, b) for a, b in everyone if want[a] is not want[b]} <= set(asked), name  # every pair between components
        assert {x for t in (100, 200) for x in combinations(range(t, t + 9), 2)} <= set(asked), name
        if name == "copies":
            assert len(asked) < 40 * 2 + 2 * 36 + 1 and 0 < rows < 4000, (len(asked), rows)
