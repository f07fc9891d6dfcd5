"""Connected components of a link table by alternating large and small stars.

Each round is two grouped minima and two joins on the links alone; nothing is gathered in one place, and a node with very
many links is an aggregate per task first and a skewed join that adaptive execution may split. The rounds grow with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.common import checkpointed, fresh_folder


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    joined = links.join(least, "u")
    if larger_only:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    both = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return both.select("e.*").where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node that can be reached. Loops are ignored."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = checkpointed(edges)
    mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = checkpointed(_star(_star(both, True), False))
        before, mark = mark, edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def labelled(prints: DataFrame, links: DataFrame) -> DataFrame:
    """``prints`` (id, text_key, print) with component_id and component_key: smallest id of the component of ``links`` over prints, and its text's key."""
    # nulls last: a struct with a flag in front
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("least")
    distinct = checkpointed(prints.groupBy("print").agg(least))
    group = components(links)
    group = distinct.join(group, distinct["print"] == group["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least")
    best = group.groupBy("root").agg(F.min("least").alias("best"))
    labels = group.join(best, "root").select(
        "print", F.col("best.id").alias("component_id"), F.col("best.text_key").alias("component_key"))
    # as a table, so that both sides of the last join are shuffled and a hot fingerprint can be split
    folder = fresh_folder(prints.sparkSession, "components")
    labels.write.parquet(folder)
    return prints.join(prints.sparkSession.read.parquet(folder), "print", "left")
