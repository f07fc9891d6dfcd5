"""Exact deduplication against a persistent digest index.

The index is a table of one row per text seen so far, bucketed and sorted by the text's SHA-256. New rows are reduced to
digests, grouped (partial aggregation first, so a text that a third of the rows share is one row per task), and the
groups are anti-joined with the index by sort and merge; the index side is read bucket by bucket without a shuffle.
``mark`` answers for a batch and changes nothing; ``commit``, once the answer is stored, appends what is new. A batch that is
run again before its commit gets the same answer, and a commit run again adds nothing. Only digests and ids are shuffled.
Everything is DataFrame operations.

Defined cases: a null text is the empty text; all texts of white space alone are equal. Of equal texts the row with most
code points stays, then the smallest id; a null id comes after all others. Rows repeated whole (id and text) are marked
alike by ``mark``; ``drop_copies`` leaves one of them. Other columns are ignored, whatever their names. An empty input gives
an empty result and adds nothing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, checkpointed, task_count, unused_name

#: Characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\x0c\r"


def text_digest(text: str | Column) -> Column:
    """SHA-256 of the text without its blanks, in lower-case hex."""
    return F.sha2(F.translate(as_text(text), BLANKS, "").cast("binary"), 256)


class DigestIndex:
    """One row per distinct text: ``digest``, the id and length of the row that stayed, and the size of its group.

    ``path`` must be on storage that all executors share and may hold an index of an earlier run. The number of buckets stands
    beside the files; opening the index with another one is an error, as its buckets would be read wrongly.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        # names with an underscore in front are no part of the table
        layout = f"{path}/_layout"
        try:
            stored = spark.read.schema("buckets int").json(layout).first()["buckets"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = buckets or task_count(spark)
            spark.createDataFrame([(stored,)], "buckets int").coalesce(1).write.json(layout)
        if buckets not in (None, stored):
            raise ValueError(f"the index at {path} has {stored} buckets, not {buckets}")
        self.buckets = stored
        self.table = "digest_index_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest STRING, keep_id BIGINT, keep_chars INT, group_size BIGINT) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        """The index as a bucketed table."""
        return self.spark.table(self.table)

    def missing(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the index lacks."""
        return groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add the rows of ``groups`` that the index does not have yet."""
        self.missing(groups).repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def forget(self) -> None:
        """Drop the table's name from the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


@dataclass(frozen=True)
class Marking:
    """The answer for a batch: ``rows`` (see ``mark``), and the groups that are new to the index."""

    rows: DataFrame
    new: DataFrame
    index: DigestIndex

    def commit(self) -> None:
        """Append the new texts; call it when the answer is stored."""
        self.index.append(self.new)


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.col(id_col).cast("bigint").alias("id"), text_digest(text_col).alias("digest"),
        F.length(as_text(text_col)).alias("chars"))


def mark(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> Marking:
    """Per row of ``df``: id, digest, chars, keep_id, group_size and whether the row stays.

    A row whose text the index has is a copy of that earlier row; ``group_size`` is the number of rows of the batch that
    first brought the text.
    """
    digests = checkpointed(_digests(df, id_col, text_col))
    # the row with most characters, then the smallest id, none last
    best = F.min(F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("no_id"), "id")).alias("best")
    groups = digests.groupBy("digest").agg(best, F.count("*").alias("group_size"))
    groups = groups.select("digest", F.col("best.id").alias("keep_id"), (-F.col("best.fewer")).alias("keep_chars"), "group_size")
    groups = checkpointed(groups)
    new = checkpointed(index.missing(groups))
    old = index.rows().join(groups.select("digest"), "digest", "left_semi").hint("merge")
    known = new.withColumn("is_new", F.lit(True)).unionByName(old.withColumn("is_new", F.lit(False)))
    marked = digests.join(checkpointed(known), "digest")
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars")) & F.col("is_new")
    return Marking(marked.select("id", "digest", "chars", "keep_id", "group_size", stays.alias("kept")), new, index)


def drop_copies(df: DataFrame, marking: Marking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, marked before, that stay, one for each text new to the index; all columns as they were.

    Whole rows are dealt by id and digest together, so a large group of copies spreads over all tasks.
    """
    kept = marking.rows.where("kept").select("id", "digest", "chars").distinct()
    names = {c: unused_name(df, f"kept_{c}") for c in kept.columns}
    keyed = df.withColumns({
        names["id"]: F.col(id_col).cast("bigint"), names["digest"]: text_digest(text_col),
        names["chars"]: F.length(as_text(text_col))})
    kept = kept.select(*[F.col(c).alias("k_" + names[c]) for c in kept.columns])
    same = [F.col(n).eqNullSafe(F.col("k_" + n)) for n in names.values()]
    return keyed.join(kept, same, "left_semi").dropDuplicates(list(names.values())).drop(*names.values())
