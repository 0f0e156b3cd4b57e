"""Components of a similarity graph whose candidates come from lists of members, without pairs for each list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import written
from civicframe.llm.components import components

#: Partners of a node that are compared in the first round.
FEW = 2


def link_members(short: DataFrame, long: DataFrame, verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, label) of all linked nodes.

    ``short``: candidate pairs (a, b), a < b, without repeats. ``long``: members (token, id, first: the list's smallest id) of
    lists that are too long for pairs. Pairs within a component need no verification, and most pairs of a group of copies
    end there: in each round a node is compared with its first few partners of other components, FEW at first, then four
    times as many each round, until no pair between components is left.
    Lists of one component end at once: a group's lists share most of their pairs (first, id), so labels
    meet each such pair once, not every member of every list. In each round
    some members of a list, the pivots, are compared with all members that aren't yet in their components, and leave the
    list: one at first, the member of most lists, then four times as many each round, those of the smallest components
    first. A list ends when its members are one component. So no pair is left out, and a group whose members
    link with each other costs a few rows each. ``verified`` keeps the pairs (a, b) that do link, as a written table. Of
    earlier links only the labels go on, a row for each node.
    """
    partners = F.row_number().over(Window.partitionBy("b").orderBy("a"))
    short, few = written(short.select("a", "b", partners.alias("rank")), "ranked-pairs"), FEW
    done = short.where(F.col("rank") <= few).select("a", "b")
    labels = components(verified(done))
    named = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"{x}_label"))
    apart = lambda some, x, y: some.join(named(x), x, "left").join(named(y), y, "left").where(F.coalesce(f"{x}_label", x) != F.coalesce(f"{y}_label", y)).select(x, y)
    split = written(apart(long.where("first <> id").select("first", "id").distinct(), "first", "id"), "split")
    split = written(long.join(split, ["first", "id"], "left_semi").select("token").distinct(), "split")
    long = long.join(split, "token", "left_semi").select("token", "id", F.count("*").over(Window.partitionBy("id")).alias("central"))
    pivots = 1
    while True:
        short = written(apart(short.where(F.col("rank") > few).select("a", "b"), "a", "b").withColumn("rank", partners), "open-pairs")
        few *= 4
        labelled = long.join(labels.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "central", F.coalesce("label", "id").alias("label"))
        open_ = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
        rest = labelled.join(open_, "token").withColumn("own", F.count("*").over(Window.partitionBy("token", "label")))
        rank = Window.partitionBy("token").orderBy(F.lit(0) if pivots == 1 else F.col("own"), F.desc("central"), "id")
        rest = written(rest.withColumn("rank", F.row_number().over(rank)), "members")
        if rest.isEmpty() and short.isEmpty():
            return labels
        chosen = rest.where(F.col("rank") <= pivots).select("token", F.col("id").alias("a"), F.col("label").alias("alabel"))
        pairs = rest.join(chosen, "token").where("label <> alabel").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b"))
        pairs = pairs.union(short.where(F.col("rank") <= few).select("a", "b")).distinct()
        pairs = written(pairs.join(done, ["a", "b"], "left_anti"), "new-pairs")
        if not pairs.isEmpty():
            done = done.unionByName(pairs)
            links = verified(pairs)
            if not links.isEmpty():
                labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links))
        long = rest.where(F.col("rank") > pivots).select("token", "id", "central")
        pivots *= 4
