"""Ranking, top-1, and exact greedy one-to-one assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import checkpointed, release, stored


def best_and_alternatives(pairs: DataFrame, left: str, right: str, score: str, tie: str, alternatives: int = 5) -> DataFrame:
    """Per left id the best right id and the next ones as `id:score` joined by `|`."""
    w = Window.partitionBy(left).orderBy(F.desc(score), tie, right)
    ranked = pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= alternatives + 1)
    rest = F.transform(
        F.filter(F.array_sort(F.collect_list(F.struct("_r", F.col(right).cast("string").alias("id"), F.format_number(score, 2).alias("s")))), lambda x: x["_r"] > 1),
        lambda x: F.concat_ws(":", x["id"], x["s"]),
    )
    return ranked.groupBy(left).agg(
        F.max(F.when(F.col("_r") == 1, F.col(right))).alias("best"), F.max(F.when(F.col("_r") == 1, F.col(score))).alias("best_score"), F.array_join(rest, "|").alias("alternatives")
    )


def greedy_one_to_one(edges: DataFrame, left: str, right: str, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """The edges that sequential greedy in the strict order keeps.

    An edge is kept iff no better edge at either end is kept. Each round keeps the edges that
    rank first at both their ends and deletes all edges that touch a kept end, until none is
    left; the best of all edges goes in every round, so it ends. The rank at an end is the least
    order struct there (an aggregate, not a sort). What a round leaves is stored, without the order
    structs, and the former round's files are deleted. order is (column, whether descending) and must
    end in a unique key; descending columns are numbers, and no order column is null.
    """
    held, kept = stored(edges), None
    while not held.isEmpty():
        live = held.withColumn("_o", F.struct(*[(-F.col(c) if down else F.col(c)).alias(f"k{i}") for i, (c, down) in enumerate(order)]))
        first = lambda end: live.groupBy(end).agg(F.min("_o").alias("_o"))
        won = stored(live.join(first(left), [left, "_o"], "left_semi").join(first(right), [right, "_o"], "left_semi").select(*edges.columns))
        kept = won if kept is None else kept.unionByName(won)
        rest = stored(held.join(won.select(left), left, "left_anti").join(won.select(right), right, "left_anti").select(*edges.columns))
        release(held)
        held = rest
    return held if kept is None else kept


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its least node) of every node of an undirected graph.

    Every round each node takes the least label among itself, its neighbours and its label's own
    label (pointer jumping), so a chain of n nodes needs about log n rounds, not n. Lineage is cut
    after every round and the former checkpoint deleted. Null ends take no part.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    both = checkpointed(known.select(F.col(a).alias("node"), F.col(b).alias("peer")).unionAll(known.select(F.col(b).alias("node"), F.col(a).alias("peer"))).distinct())
    labels = checkpointed(both.groupBy("node").agg(F.least(F.col("node"), F.min("peer")).alias("component")))
    while True:
        offered = both.join(labels.select(F.col("node").alias("peer"), "component"), "peer").groupBy("node").agg(F.min("component").alias("_o"))
        near = labels.join(offered, "node").select("node", "component", F.least("component", "_o").alias("_n"))
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_j"))
        moved = checkpointed(near.join(jump, "_n").select("node", F.least("_n", "_j").alias("component"), (F.least("_n", "_j") < F.col("component")).alias("_moved")))
        release(labels)
        labels = moved
        if moved.where("_moved").isEmpty():
            release(both)
            return labels.drop("_moved")


def representative(rows: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """The shortest name of each group, then the first."""
    return rows.groupBy(*group).agg(F.min_by(name, F.struct(F.length(name), F.col(name))).alias("representative"))


def top_k(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(k)
