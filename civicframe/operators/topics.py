"""Topics of texts by keywords; places linked to outside entities; pluggable sentiment."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions import fixed as X
from civicframe.functions.text import let


def topic_text(name: Column, text: Column) -> Column:
    return F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.left(F.coalesce(text, F.lit("")), F.lit(X.TOPIC_CHARS)))


def scores(text: Column, topics: dict[str, tuple[str, ...]] | None = None, threshold: float = X.TOPIC_THRESHOLD) -> Column:
    """array<struct<category, confidence>>: share of a topic's words in the text, best first, ties in order of the topics."""
    topics = topics or X.TOPICS

    def all_of(low: Column) -> Column:
        found = []
        for place, (topic, words) in enumerate(topics.items()):
            hits = sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))
            found.append(F.struct((-hits / float(len(words))).alias("minus"), F.lit(place).alias("place"), F.lit(topic).alias("category")))
        return F.array(*found)

    # the lower-cased text is bound once: it would be computed for every word
    best = F.array_sort(F.filter(let(F.lower(text), all_of), lambda s: -s["minus"] >= threshold))
    return F.transform(best, lambda s: F.struct(s["category"].alias("category"), (-s["minus"]).alias("confidence")))


def link_first(places: DataFrame, entities: DataFrame, name: str = "name") -> DataFrame:
    """Left join to the first entity of each name (entities: name, rank, and what is wanted)."""
    rest = [c for c in entities.columns if c not in (name, "rank")]
    first = entities.groupBy(F.lower(name).alias("name_")).agg(F.min_by(F.struct(*rest), "rank").alias("e"))
    return places.join(first, F.lower(places[name]) == F.col("name_"), "left").select(*places.columns, *[F.col(f"e.{c}").alias(c) for c in rest])


def hierarchy(places: DataFrame, parents: DataFrame) -> DataFrame:
    """Adds ``hierarchy``: the parents (id, level, parent_name) of each place, from the top."""
    h = parents.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "parent_name"))), lambda p: p["parent_name"]).alias("hierarchy"))
    return places.join(h, "id", "left")


def sentiment(df: DataFrame, text: str, model: Callable[[list[str]], list[tuple[str, float]]] | None = None, chars: int = 512) -> DataFrame:
    """Adds label and score of the first characters of a text; nulls without a model."""
    if model is None:
        return df.withColumns({"sentiment": F.lit(None).cast("string"), "sentiment_score": F.lit(None).cast("double")})

    @F.pandas_udf("label string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model(texts.fillna("").tolist()), columns=["label", "score"])

    out = df.withColumn("s_", run(F.left(F.col(text), F.lit(chars))))
    return out.withColumns({"sentiment": F.col("s_.label"), "sentiment_score": F.col("s_.score")}).drop("s_")
