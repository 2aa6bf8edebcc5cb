"""Connected components of links, by hooking and pointer jumping, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import attach, stage


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``links`` (``a``, ``b``, not null): the label is the
    least node that can be reached.

    Each round, every label that borders on a smaller one is hooked to the smallest such label, and
    hooks are followed twice, so that chains shrink to a quarter at least. Nodes may have few links
    each or many; labels, which gather many nodes, are joined with their hot ones split. Only a
    boolean comes to the driver in each round.
    """
    both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stage(both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("label")
    ))
    while True:
        of_neighbour = labels.select(F.col("node").alias("b"), "label")
        nearest = (
            attach(both, of_neighbour, "b", [F.col("a")])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("nearest"))
        )
        hooks = stage(
            labels.join(nearest, "node")
            .groupBy("label")
            .agg(F.min(F.least("label", "nearest")).alias("target"))
        )
        if hooks.filter("target < label").isEmpty():
            return labels
        for _ in range(2):
            hooks = stage(_follow(hooks, "label", "target", hooks))
        labels = stage(_follow(labels, "node", "label", hooks))


def _follow(rows: DataFrame, key: str, pointer: str, hooks: DataFrame) -> DataFrame:
    """``rows`` with ``pointer`` replaced by where ``hooks`` leads from it."""
    onward = hooks.select(F.col("label").alias("__at"), F.col("target").alias("__to"))
    pointing = rows.select(F.col(key).alias("__key"), F.col(pointer).alias("__at"))
    found = attach(pointing, onward, "__at", [F.col("__key")], "left")
    return found.select(
        F.col("__key").alias(key), F.coalesce("__to", "__at").alias(pointer)
    )
