"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken floor(rate) times, and once more for a sample drawn with inclusion probability
frac(rate), where rate is the source's target over its size. The sample is balanced: the flight phase moves the
probabilities of a block of documents through the null space of two constraints, words and documents, until at most two
of them are still between 0 and 1. What is left of many blocks forms the blocks of the next level, until one block per
source remains; its last fractions are landed by giving up the document constraint, then the word constraint. So the
words taken from a source differ from its target by the size of a few documents, and blocks of a fixed size keep every
task small, whatever the share of one source.

Defined cases: a null text has size 0; null is a source of its own and comes last; a source of size 0 gets target 0. A source
whose target is capped is taken ``CAP`` times whole. Repeated rows are documents of their own. An empty table gives an empty
result. The draw depends on the rows alone (ids, sizes, sources), not on their order or partitions. Whole rows that are
repeated lie in one block, so ids are expected to be distinct for the most part.
"""

from __future__ import annotations

import math
import random
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.common import WORD, as_text, checkpointed, unused_name

#: Most times a source, and so a document, may be taken.
CAP = 3
#: Documents of a block of the flight phase.
BLOCK = 2000
#: A probability closer than this to 0 or 1 counts as 0 or 1.
NEAR = 1e-9


def word_count(text: str | Column) -> Column:
    return F.regexp_count(as_text(text), F.lit(WORD))


def targets(sizes: DataFrame) -> DataFrame:
    """Per source of ``sizes`` (source, size): n_docs, source_size and target.

    Weights 1, 2, 3, 1, ... go by the order of the sources, null last. All sources together get the sum of all sizes; none
    gets over ``CAP`` times its own, and what it leaves is shared by weight among the others. With the sources in the
    order of cap over weight, the capped ones come first, so one running sum finds the level. One row per source goes
    through these windows.
    """
    own = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    own = own.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    own = own.withColumn("cap", F.col("source_size") * float(CAP))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    own = own.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("fill", "level")))
    own = own.withColumn("fill", F.row_number().over(filling))
    own = own.withColumn("level", open_level.over(everything)["level"])
    return own.select("source", "n_docs", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def flight(sizes: list[float], probs: list[float], rng: random.Random, by_size: bool = True, by_count: bool = True) -> None:
    """Move ``probs`` in place along the null space of the constraints until too few fractions are left to move.

    Each step takes as many open units as there are constraints and one more, finds a direction that keeps the sums, and
    goes one way or the other as far as the first unit that becomes 0 or 1, each way with the chance that keeps every
    inclusion probability.
    """
    need = 1 + by_size + by_count
    hand: list[int] = []
    for unit in range(len(probs)):
        if NEAR < probs[unit] < 1 - NEAR:
            hand.append(unit)
        while len(hand) == need:
            if need == 3:
                a, b, c = (sizes[i] for i in hand)
                step = (b - c, c - a, a - b)
                if a == b == c:
                    step = (1.0, -1.0, 0.0)
            elif need == 2:
                a, b = (sizes[i] for i in hand) if by_size else (1.0, 1.0)
                step = (b, -a) if a or b else (1.0, -1.0)
            else:
                step = (1.0,)
            up = min((1 - probs[i]) / s if s > 0 else probs[i] / -s for i, s in zip(hand, step, strict=True) if s)
            down = min(probs[i] / s if s > 0 else (1 - probs[i]) / -s for i, s in zip(hand, step, strict=True) if s)
            move = up if rng.random() < down / (up + down) else -down
            for i, s in zip(hand, step, strict=True):
                p = probs[i] + move * s
                probs[i] = 0.0 if p < NEAR else 1.0 if p > 1 - NEAR else p
            hand = [i for i in hand if 0.0 < probs[i] < 1.0]


def _fly(seed: int, last: bool):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["mixed", "id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        sizes, probs = rows["size"].astype(float).tolist(), rows["prob"].tolist()
        rng = random.Random(zlib.crc32(f"{seed}|{rows['source'].iloc[0]}|{rows['block'].iloc[0]}".encode()))
        flight(sizes, probs, rng)
        if last:
            flight(sizes, probs, rng, by_count=False)
            flight(sizes, probs, rng, by_size=False, by_count=False)
        rows["prob"] = probs
        return rows
    return block


def plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """Per row of ``df``: id, text_key (hash of the text), source, size, source_size, target, copies."""
    sizes = checkpointed(df.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(as_text(text_col)).alias("text_key"),
        F.col(source_col).alias("source"), word_count(text_col).cast("bigint").alias("size")))
    shares = checkpointed(targets(sizes))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shares = shares.withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + NEAR))
    shares = shares.withColumn("prob", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    shares = shares.withColumnsRenamed({"source": "share_source"})
    rows = sizes.join(shares, F.col("source").eqNullSafe(F.col("share_source")), "left").drop("share_source", "rate")
    rows = rows.withColumn("mixed", F.xxhash64("id", "size", "text_key"))
    blocks = F.ceil(F.col("n_docs") / BLOCK)
    rows = rows.withColumn("block", F.pmod(F.shiftright("mixed", 17), blocks))
    largest = shares.agg(F.max("n_docs")).first()[0] or 0
    open_blocks = math.ceil(largest / BLOCK)
    is_open = (F.col("prob") > NEAR) & (F.col("prob") < 1 - NEAR)
    done, level = [rows.where(~is_open)], rows.where(is_open)
    while True:
        last = open_blocks <= 1
        flown = checkpointed(level.groupBy("source", "block").applyInPandas(_fly(seed, last), rows.schema))
        done.append(flown if last else flown.where(~is_open))
        if last:
            break
        # two fractions are left of a block, so half as many blocks as a block has rows go together
        level = flown.where(is_open).withColumn("block", F.floor(F.col("block") / (BLOCK // 2)))
        open_blocks = math.ceil(open_blocks / (BLOCK // 2))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    copies = (F.col("whole") + F.when(F.col("prob") > 0.5, 1).otherwise(0)).cast("int")
    return result.select("id", "text_key", "source", "size", "source_size", "target", copies.alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """The mixed corpus: every row of ``df`` as often as the plan takes it, all columns as they were.

    Rows repeated whole count as documents each and share the sum of their copies.
    """
    decided = plan(df, id_col, text_col, source_col, seed).groupBy("id", "text_key", "source").agg(F.sum("copies").alias("copies"))
    names = {c: unused_name(df, f"mix_{c}") for c in decided.columns}
    decided = decided.where("copies > 0").select(*[F.col(c).alias(n) for c, n in names.items()])
    own_id, own_key, again = (unused_name(df, c) for c in ("own_id", "own_key", "again"))
    rows = df.withColumns({own_key: F.xxhash64(as_text(text_col)), own_id: F.col(id_col).cast("bigint")})
    same = (F.col(own_id).eqNullSafe(F.col(names["id"])) & (F.col(own_key) == F.col(names["text_key"]))
            & F.col(source_col).eqNullSafe(F.col(names["source"])))
    rows = rows.join(decided, same).dropDuplicates([own_id, own_key, source_col])
    rows = rows.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int"))))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])
