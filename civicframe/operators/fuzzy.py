"""Best fuzzy match of candidates among street names.

token_set_ratio: both texts in lower case, other signs than letters and digits as blanks, tokens as sets; 100 if one set
holds the other (and they share a token), else the best ratio among: common tokens against common + rest of either, and
the two. The ratio of two texts is 200 * LCS / (sum of lengths), rounded.

Scoring runs only on pairs that can reach the threshold: pairs that share a token, and pairs whose sorted distinct tokens
are few enough insertions and deletions apart. The latter are found by pieces: of two texts k edits apart, one of any k + 1
pieces of the first stands in the second, shifted by k places at most; so an equi-join on pieces loses no pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.session import ship

#: Streets of one city that a candidate is compared with, all of them, when the nearest one is asked for.
MOST_STREETS = 100_000


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def tokens(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def token_set_ratio(a: str, b: str) -> int:
    x, y = set(tokens(a)), set(tokens(b))
    if not x or not y:
        return 0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100
    left, right = (" ".join(filter(None, [both, " ".join(sorted(z))])) for z in (x - y, y - x))
    scores = [ratio(left, right)]
    if both:
        scores += [ratio(both, left), ratio(both, right)]
    return round(max(scores))


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["score"] = [token_set_ratio(a, b) for a, b in zip(pdf["candidate"], pdf["street"], strict=True)]
        yield pdf[["candidate", "street", "score"]]


def _joined_tokens(text: Column) -> Column:
    """The distinct tokens of a text in order, joined by blanks: what is compared if no token is shared."""
    words = F.split(F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), " ")


def _near(candidates: DataFrame, streets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (candidate, street) of (text, key) tables whose keys are so few edits apart that their ratio, rounded, may reach the threshold."""
    q = 201 - 2 * threshold  # edits <= (sum of lengths) * q / 200, as scores are rounded
    edits = lambda a, b: F.floor((a + b) * q / 200).cast("int")
    low = lambda n: F.greatest(F.lit(1), F.ceil(n * (200 - q) / (200 + q))).cast("int")
    high = lambda n: F.floor(n * (200 + q) / (200 - q)).cast("int")

    def pieces(df: DataFrame, own: str, other: str) -> DataFrame:
        df = df.withColumn(own, F.length("key")).where(F.col(own) > 0)
        df = df.withColumn(other, F.explode(F.sequence(low(F.col(own)), high(F.col(own))))).withColumn("k", edits(F.col("c"), F.col("s")))
        df = df.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
        at = lambda i: F.floor(i * F.col("s") / (F.col("k") + 1)).cast("int")
        return df.withColumn("at", at(F.col("i"))).withColumn("size", at(F.col("i") + 1) - F.col("at"))

    s = pieces(streets, "s", "c").select(F.col("text").alias("street"), F.col("key").alias("street_key"), "c", "s", "i", F.substring(F.col("key"), F.col("at") + 1, F.col("size")).alias("piece"))
    c = pieces(candidates, "c", "s")
    first, last = F.greatest(F.lit(0), F.col("at") - F.col("k")), F.least(F.col("c") - F.col("size"), F.col("at") + F.col("k"))
    c = c.withColumn("from", F.explode(F.when(first <= last, F.sequence(first, last))))
    c = c.select(F.col("text").alias("candidate"), "key", "c", "s", "i", "k", F.substring(F.col("key"), F.col("from") + 1, F.col("size")).alias("piece")).distinct()
    pairs = c.join(s, ["c", "s", "i", "piece"]).select("candidate", "street", "key", "street_key", "k").distinct()
    return pairs.where(F.levenshtein("key", "street_key") <= F.col("k")).select("candidate", "street")


def best_matches(candidates: DataFrame, streets: DataFrame, threshold: int = X.FUZZY_THRESHOLD) -> DataFrame:
    """candidate, street, score: the best street of each candidate that reaches the threshold; ties to the first by name."""
    ship(candidates.sparkSession)
    c = candidates.where("candidate is not null").select(F.col("candidate").alias("text")).distinct().withColumn("key", _joined_tokens(F.col("text")))
    s = streets.where("name is not null").select(F.col("name").alias("text")).distinct().withColumn("key", _joined_tokens(F.col("text")))
    words = lambda df, name: df.where("key <> ''").select(F.col("text").alias(name), F.explode(F.split("key", " ")).alias("word"))
    shared = words(c, "candidate").join(words(s, "street"), "word").select("candidate", "street")
    pairs = shared.union(_near(c, s, threshold)).distinct()
    scored = pairs.mapInPandas(_score, "candidate string, street string, score int").where(F.col("score") >= threshold)
    best = scored.groupBy("candidate").agg(F.min(F.struct((-F.col("score")).alias("minus"), "street")).alias("b"))
    return best.select("candidate", "b.street", (-F.col("b.minus")).alias("score"))


def ascii_folded(column):
    """Umlauts and sharp s in ASCII, so that edit distances count the same everywhere."""
    return F.replace(F.translate(F.lower(column), "äöü", "aou"), F.lit("ß"), F.lit("ss"))


def nearest_by_edits(candidates: DataFrame, streets: DataFrame) -> DataFrame:
    """candidate, street, edits: the street with the fewest edits; ties to the first by name. ``streets`` must be small (it is broadcast)."""
    names = streets.select(F.col("name").alias("street")).where("street is not null").distinct()
    if names.limit(MOST_STREETS + 1).count() > MOST_STREETS:
        raise ValueError(f"a nearest street always exists, so all are compared: {MOST_STREETS} at most; use best_matches")
    pairs = candidates.select("candidate").distinct().crossJoin(F.broadcast(names))
    pairs = pairs.withColumn("edits", F.levenshtein(ascii_folded(F.col("candidate")), ascii_folded(F.col("street"))))
    best = pairs.groupBy("candidate").agg(F.min(F.struct("edits", "street")).alias("b"))
    return best.select("candidate", "b.street", "b.edits")
