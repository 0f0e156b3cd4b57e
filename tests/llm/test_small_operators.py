"""Language ID, mixing, secrets and vector search on small inputs."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.llm import language_id, mixing, secrets, vector_topk

SF = "/root/testdata/sf0.01"


# language ID


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_is_learned_from_held_out_rows(spark, docs):
    changed = docs.withColumn("lang", F.when(language_id.held_out(), "zz").otherwise(F.col("lang")))
    rows = lambda df: sorted(tuple(r) for r in language_id.identify(df).collect())
    assert rows(docs) == rows(changed)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in language_id.identify(docs).collect())


def test_texts_without_letters(spark, docs, empty, by_id):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs).collect()}
    assert len(got) == len(by_id)
    for d, t in by_id.items():
        assert (got[d] == ("und", 0.0)) == (not t or not any(c.isalpha() for c in t))
    assert language_id.identify(empty).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_filters_beyond_64_languages():
    counts = {f"l{i:02}": [(i * 100 + k, 10, 1000) for k in range(50)] for i in range(70)}
    m = language_id.Model.build(counts, {lang: 5 for lang in counts})
    keys = np.array([6900 + k for k in range(50)], np.uint64)
    masks = m.table[m.places(keys)[0]] & m.table[m.places(keys)[1]] & m.table[m.places(keys)[2]]
    assert (masks[:, 1] >> np.uint64(5) & np.uint64(1)).all()


def plain_grams(text):
    """Trigrams of letters and blanks with two letters at least, one by one."""
    low = (text or "").lower() + "\n\n"
    c = [x if x.isalpha() else " " for x in low]
    return ["".join(c[i : i + 3]) for i in range(len(c) - 2) if sum(x != " " for x in c[i : i + 3]) >= 2]


def test_languages_against_plain_sets(spark):
    """The same decision from plain sets of n-grams, without Bloom filters; false positives corrected by the filters' fill."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    counts, n_rows = {}, {}
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            n_rows[r["lang"]] = n_rows.get(r["lang"], 0) + 1
            own = counts.setdefault(r["lang"], {})
            for g in plain_grams(r["text"]):
                own[g] = own.get(g, 0) + 1
    number = lambda g: int(np.array([sum(ord(x) << 21 * k for k, x in enumerate(g))], np.uint64).view(np.int64)[0])
    sets, share = {}, {}
    for lang, own in counts.items():
        total = sum(own.values())
        sets[lang] = {g: n / total for g, n in sorted(own.items(), key=lambda x: (-x[1], number(x[0])))[: language_id.TOP]}
        for g, x in sets[lang].items():
            share[g] = max(share.get(g, 0), x)
    sets = {lang: {g for g, x in own.items() if x >= language_id.CONTRAST * share[g]} for lang, own in sets.items()}
    langs, model = sorted(sets), language_id.fit(docs)
    assert model.langs == langs and max(model.wrong) < 0.05
    every = np.array(sorted({number(g) for own in sets.values() for g in own})).view(np.uint64)
    at = model.places(every)
    masks = model.table[at[0]] & model.table[at[1]] & model.table[at[2]]
    have = {lang: {number(g) for g in own} for lang, own in sets.items()}
    for i, lang in enumerate(langs):
        hit = {int(x) for x in every.view(np.int64)[(masks[:, 0] >> np.uint64(i) & np.uint64(1)).astype(bool)]}
        assert have[lang] <= hit and len(hit - have[lang]) <= 0.05 * len(every)  # none is missed, few are wrong
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}
    clear = same = 0
    for r in rows:
        grams = plain_grams(r["text"])
        hits = sorted(((sum(g in sets[lang] for g in grams), lang) for lang in langs), reverse=True)
        if not any(c.isalpha() for c in r["text"] or ""):
            assert got[r["doc_id"]] == "und"
        elif hits[0][0] - hits[1][0] > 0.02 * len(grams):
            clear += 1
            same += got[r["doc_id"]] == hits[0][1]
    assert clear > 0.9 * len(rows) and same >= 0.999 * clear


def test_ties_of_languages_go_to_the_first(spark):
    rows = [(i, "abc def ghi", lang) for i, lang in enumerate(["zz", "aa"] * 20)]
    df = spark.createDataFrame([*rows, (1000, "abc def ghi", None), (1001, "abc", "bb")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(df.where("doc_id <> 1001")).collect()}
    assert set(got.values()) == {"aa"}


def test_texts_over_100_kb(spark):
    """Whole texts count: what decides stands at the very end."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and text is not null").limit(300).collect()
    one = next(r for r in rows if len(r["text"]) > 500)
    long = "1234 " * 60_000 + one["text"]
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows] + [(10**9, long, None, "s"), (10**9 + 1, "x " * 100_000 + "password=abcdefgh", None, "s")], "doc_id long, text string, lang string, source string")
    assert {r["lang_pred"] for r in language_id.identify(df).where("doc_id = 1000000000").collect()} == {one["lang"]}
    assert [r["spans"] for r in secrets.digest(df).where("doc_id = 1000000001").collect()] == ["assign:200000:200017"]
    assert {r["doc_id"]: r["size"] for r in mixing.mix_sources(df).collect()}[10**9 + 1] == 100_001


# mixing


def test_mix_meets_targets(docs, empty, by_id):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(by_id) and mixing.mix_sources(empty).count() == 0
    size = {d: len((t or "").encode().split()) for d, t in by_id.items()}
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    sources = sorted({s for s in source.values() if s is not None}) + [None]
    total = {s: sum(size[d] for d in size if source[d] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, full, budget = {}, set(), 1.5 * sum(total.values())
    while True:  # water-filling by rounds
        rest = budget - sum(2 * total[s] for s in full)
        share = sum(weight[s] for s in sources if s not in full)
        over = {s for s in sources if s not in full and rest * weight[s] / share > 2 * total[s]}
        if not over:
            target = {s: 2 * total[s] if s in full else rest * weight[s] / share for s in sources}
            break
        full |= over
    taken = dict.fromkeys(sources, 0)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and math.isclose(r["target"], target[s], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sources)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sources(docs.repartition(2)).collect()))  # reruns agree


def test_mix_prefers_by_propensity(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"), (F.col("id") % 2 * 3 + 1).alias("w"))
    rows = mixing.mix_sources(df, propensity=F.col("w")).collect()
    extra = [sum(r["taken"] == 6 for r in rows if r["doc_id"] % 2 == k) for k in (0, 1)]
    assert sum(r["taken"] for r in rows) == 18000 and 3 * extra[0] < extra[1] < 5 * extra[0]


def test_refined_edges_take_the_same(spark, docs, monkeypatch):
    """However far a source's edge is refined, in words and in copies; rows that repeat an id count each."""
    rows = lambda: sorted(tuple(r) for r in mixing.mix_sources(docs).collect())
    copies = lambda df: sorted((r["doc_id"], r["text"]) for r in mixing.take_copies(df).collect())
    once, taken = rows(), copies(docs)
    for buckets, few in ((4, 0), (2, 3), (256, 0)):
        monkeypatch.setattr(mixing, "BUCKETS", buckets)
        monkeypatch.setattr(mixing, "FEW", few)
        assert rows() == once and copies(docs) == taken
    words = {}
    for d, t in copies(docs.union(docs)):
        words[d] = words.get(d, 0) + len(t.encode().split())
    twice = {}
    for r in mixing.mix_sources(docs.union(docs)).collect():
        twice[r["doc_id"]] = twice.get(r["doc_id"], 0) + r["taken"]
    assert all(abs(words.get(d, 0) - n) <= 1 for d, n in twice.items())


def test_mix_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, "x", "a")], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix_sources(df).collect()] == [(0.0, 0)] * 2


# secrets


def base_spans(text):
    out = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


SECRETS = [
    'é password = "hunter2hunter2" TOKEN:abc', "toKenK", "ſecret=aaaaaaaaaaaa secret=aaaaaaaaaaaa", "AKIAABCDEFGHIJKL AKIAABC AKIA" + "B" * 40,
    "0" * 31 + " " + "deadbeef" * 4 + "F", "api_key: x password: " + "q" * 9, "apikey='" + "a1" * 20 + "'", "-----BEGIN RSA PRIVATE KEY-----", "token=token=tokentoken", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl",
    "passwordpassword==abcdefgh", None, "",
]


def test_secrets_against_the_patterns(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS * 3)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in secrets.digest(df).collect()}
    assert len(got) == 3 * len(SECRETS)
    for i, t in enumerate(SECRETS * 3):
        want = base_spans(t or "")
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [got[i][n] for n in ("n_assign", "n_access", "n_hex")] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert all(x in got[i]["spans"].split(",") for x in text.split(",") if x)
    assert "key:0:31" in got[7]["spans"] and "jwt:0:" in got[9]["spans"]


def test_ledger_scans_only_what_is_new(spark):
    schema = "doc_id long, text string"
    first = spark.createDataFrame([(1, "password=abcdefgh"), (2, "x"), (3, "password=abcdefgh")], schema)
    rows, ledger = secrets.scan(first)
    assert ledger.count() == 2 and rows.where("n_assign = 1").count() == 2
    # a ledger that claims a finding for a known blob is believed: the blob isn't read again
    marked = ledger.withColumn("spans", F.lit("assign:7:9"))
    rows, ledger = secrets.scan(spark.createDataFrame([(4, "x"), (5, "secret=12345678")], schema), marked)
    assert {r["doc_id"]: r["spans"] for r in rows.collect()} == {4: "assign:7:9", 5: "assign:0:15"}
    assert ledger.count() == 3
    rows, ledger = secrets.scan(spark.createDataFrame([(4, "x")], schema), marked, version=2)  # new rules, read again
    assert [r["spans"] for r in rows.collect()] == [""]


def test_ledger_is_kept(spark, tmp_path):
    """A stored ledger serves later scans; what a scan left unfinished isn't read; no rows, no findings."""
    schema = "doc_id long, text string, blob string, version int, spans string"
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.rows() is None
    rows = ledger.scan(spark.createDataFrame([(1, "password=abcdefgh", "x", 1, "y"), (2, "x", "x", 1, "y")], schema))
    assert {r["doc_id"]: r["spans"] for r in rows.collect()} == {1: "assign:0:17", 2: ""}
    again = secrets.Ledger(spark, str(tmp_path / "ledger"))
    assert again.rows().count() == 2
    rows = again.scan(spark.createDataFrame([(3, "password=abcdefgh", "x", 1, "y"), (4, "new", "x", 1, "y"), (4, "new", "x", 1, "y")], schema))
    assert sorted((r["doc_id"], r["spans"]) for r in rows.collect()) == [(3, "assign:0:17"), (4, ""), (4, "")]
    assert again.rows().count() == 3 and len(again.batches()) == 2
    (tmp_path / "ledger" / "segments" / "unfinished").mkdir()
    assert again.rows().count() == 3
    assert again.scan(spark.createDataFrame([], schema)).count() == 0 and again.rows().count() == 3
    assert again.scan(spark.createDataFrame([(5, "x", "", 0, "")], schema), version=2).count() == 1 and again.rows().count() == 4


# vector search


@pytest.mark.parametrize("size", [3, 8])
def test_top_k_against_brute_force(spark, size):
    r = np.random.default_rng(size)
    v = {int(i): r.normal(0, 1, size).tolist() for i in r.permutation(300)}
    for i in range(100, 140):
        v[i] = v[100]  # ties
    odd = [(1000, None), (1001, [1.0, None]), (1050, [float("nan")] * size), (1100, [float("inf")] * size), (1150, [0.5])]
    df = spark.createDataFrame([*v.items(), *odd], "vec_id long, embedding array<double>").repartition(3)
    v[1150] = [0.5]
    q = {i: np.pad(np.floor(256 * np.array(x)).astype(int), (0, size - len(x))) for i, x in v.items()}
    want = []
    for i in q:
        if i % 50 == 0:
            best = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    for blocks in (1000, 70):
        got = [tuple(x) for x in vector_topk.top_k(df, block_rows=blocks, group_rows=2).collect()]
        assert sorted(got) == sorted(want)


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert vector_topk.top_k(spark.createDataFrame([], schema)).count() == 0
    assert vector_topk.top_k(spark.createDataFrame([(50, [1.0])], schema)).count() == 0
    got = vector_topk.top_k(spark.createDataFrame([(50, [-1.0]), (51, [1.0]), (52, [0.001])], schema)).collect()
    assert [tuple(r) for r in got] == [(50, 1, 52, 0), (50, 2, 51, -65536)]


def test_top_k_of_repeated_ids_and_clashing_columns(spark):
    """Each row that repeats a query's id has ranks of its own; columns with names used inside don't matter."""
    df = spark.createDataFrame([(50, [1.0], 1, 7, "a"), (50, [-1.0], 2, 8, "b"), (51, [1.0], 3, 9, "c"), (52, [2.0], 4, 9, "d"), (53, [2.0], 4, 9, "d")], "vec_id long, embedding array<double>, id int, block int, part string")
    got = sorted(tuple(r) for r in vector_topk.top_k(df).collect())
    assert got == sorted([(50, 1, 52, 131072), (50, 2, 53, 131072), (50, 3, 51, 65536), (50, 1, 51, -65536), (50, 2, 52, -131072), (50, 3, 53, -131072)])
    twice = spark.createDataFrame([(50, [1.0]), (50, [1.0]), (51, [1.0]), (51, [1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in vector_topk.top_k(twice).collect()) == sorted([(50, 1, 51, 65536), (50, 2, 51, 65536)] * 2)


def test_top_k_of_huge_components(spark):
    """No finite component is too large: ranks are exact, a score beyond a long shows as the nearest long."""
    import math
    from fractions import Fraction

    v = {50: [1.0, 2.0], 51: [1.0, 1.0], 52: [2.0**21, 1.0], 53: [2.0**70, -1.0], 54: [2.0**70 + 2.0**20, -1.0], 55: [-1e300, 0.0], 56: [1.7e308, 1.0], 57: [0.1, 2.0**40], 100: [-(2.0**45), 3.5]}
    q = {i: [math.floor(Fraction(c) * 256) for c in x] for i, x in v.items()}
    want = []
    for i in (50, 100):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i)[:5]
        want += [(i, k + 1, j, min(max(-s, -(2**63)), 2**63 - 1)) for k, (s, j) in enumerate(best)]
    got = [tuple(r) for r in vector_topk.top_k(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == sorted(want)
    some = [0, 1, -1, 255, 256, -255, -256, 2**63, -(2**63), 2**200, -(2**200), 7, -7, 65535, -65536]
    assert sorted(some) == sorted(some, key=vector_topk.sort_key)


def test_top_k_of_long_vectors(spark):
    r = np.random.default_rng(5)
    v = {i: r.normal(0, 1, 1000 if i % 7 == 0 else 3).tolist() for i in range(1, 120)}
    q = {i: np.pad(np.floor(256 * np.array(x)).astype(int), (0, 1000 - len(x))) for i, x in v.items()}
    want = [(i, k + 1, j, -s) for i in (50, 100) for k, (s, j) in enumerate(sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5])]
    got = [tuple(x) for x in vector_topk.top_k(spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>"), block_rows=40).collect()]
    assert sorted(got) == sorted(want)


def test_intermediate_tables_are_discarded(spark):
    from pathlib import Path

    from civicframe.llm import common, components

    mark = common.tables()
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    nodes = components.components(links)
    left = common._TABLES[mark:]
    assert len(left) <= 8 and nodes.where("label = 0").count() == 301
    other = common.written(spark.range(3), "other")
    common.discard(spark, mark, nodes)
    assert nodes.count() == 301 and not any(Path(p).exists() for p in left if "/nodes-" not in p)
    assert not Path(next(iter([p for p in [other.inputFiles()[0]]])).removeprefix("file://")).exists()
