"""A corpus pipeline: quality filter, exact and near deduplication, mixing of sources, encoding into pieces.

``STAGES`` lists the stages; each takes the documents its predecessor kept, and all but the last return the columns of
``documents``. Every stage works on all rows it gets; null, empty and very long texts, repeated rows and further columns
are handled as the stage's operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm import exact_dedup, mixing, quality, sentence_pieces, simhash
from streamlab.llm.common import fresh_folder, read_table
from streamlab.llm.queries import PIECE_MODEL

#: A document with a lower chance of being good goes.
LEAST_QUALITY = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return quality.keep_good(docs, labels, LEAST_QUALITY)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marking = exact_dedup.mark(docs, exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests")))
    marking.commit()
    return exact_dedup.drop_copies(docs, marking)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies by the shingle length and bit distance of ``op2_simhash``."""
    return simhash.drop_near_copies(docs, settings=simhash.CLOSE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document taken more than once is as many rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) per row."""
    model = sentence_pieces.read_model(PIECE_MODEL)
    rows = sentence_pieces.round_trip(docs, model)
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality", keep_good), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies), ("mixing", mix_sources),
    ("sentence_pieces", encode),
]

#: The stages learn weights and draw samples; a test holds each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
