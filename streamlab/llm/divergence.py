"""Source divergence audit: how far the smoothed word chances of each source lie from those of every other one.

A group is a (lang, source) that occurs; a term counts for a language if at least ``LEAST_DOCS`` of its documents have it.
With c occurrences in a group that has n of the language's v terms, p = 1 + floor(10^9 (c + 1) / (n + v)), for every term,
also one that the group lacks. Two groups diverge by the sum of f(p, q) = floor((p - q)^2 / q) over all terms of the language.

The sum is taken row by row, as Gustavson multiplies sparse matrices: the index lists, for a term, the groups that have it; a
group walks its terms and adds what each peer in the term's list contributes to a dense array with one number a peer. Such
a contribution is a correction: what the pair's two values give beyond the baseline, in which the term is zero on one side or both.
Baselines need no walk, since f depends on a group's count alone: they are summed over the number of terms with each count.
So no pair of postings ever leaves a task, only one number for two groups and task. Everything is in whole numbers and exact.

Counting reduces each task's documents in a dictionary (written out at ``HELD`` terms) before the shuffle, and terms are
then summed by group, so a source or language with a third of all rows is as many partial rows as tasks. A term's list has
one row a group. Tasks hold ``HELD`` index rows (and the rest of a term's list) and ``CELLS`` sums at a time.

Defined cases: null text, lang or source is the empty text; a group without terms still has its pairs; a language without
terms has value 0 for every pair; a source alone in its language has no pair. Repeated rows count again. Other columns
are ignored, whatever their names. An empty table gives an empty result. Sums are 64-bit: p is at most 10^9 + 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, fresh_folder
from streamlab.operators.topn import top_n

#: Documents of its language that a term must be in.
LEAST_DOCS = 3
#: Terms of a group that are reported.
TERMS = 200
#: Entries a task holds while it counts or walks, and sums it holds.
HELD, CELLS = 300_000, 4_000_000

_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, cnt, docs) of the rows of a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def written() -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in held.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(total), pa.string()),
                 pa.array(list(total.values()), pa.int64()), pa.array([docs[t] for t in total], pa.int64())],
                ["lang", "source", "term", "cnt", "docs"])
        held.clear()

    entries = 0
    for batch in batches:
        for lang, source, text in zip(*[batch[c] for c in ("lang", "source", "text")], strict=True):
            total, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            terms = text.as_py().encode().translate(_LETTERS).split()
            entries -= len(total)
            total.update(terms)
            docs.update(set(terms))
            entries += len(total)
            if entries > HELD:
                yield from written()
                entries = 0
    yield from written()


def term_counts(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, cnt, lang_cnt, first) of the terms that count; ``first`` marks one row a term of the language."""
    texts = df.select(as_text(lang_col).alias("lang"), as_text(source_col).alias("source"), as_text(text_col).alias("text"))
    rows = texts.mapInArrow(_count, "lang string, source string, term string, cnt bigint, docs bigint")
    rows = rows.groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    rows = rows.withColumns({
        "lang_cnt": F.sum("cnt").over(term), "lang_docs": F.sum("docs").over(term),
        "first": F.row_number().over(term.orderBy("source")) == 1})
    return rows.where(F.col("lang_docs") >= LEAST_DOCS).drop("docs", "lang_docs")


def _chance(count: Column, n: Column, v: Column) -> Column:
    """p, exactly: the product may pass 64 bits. 1 where the language has no terms."""
    wide = "decimal(19,0)"
    share = F.call_function("div", F.lit(1_000_000_000).cast("decimal(10,0)") * (count.cast(wide) + 1), F.nullif((n + v).cast(wide), F.lit(0).cast(wide)))
    return (1 + F.coalesce(share, F.lit(0))).cast("bigint")


def _groups(df: DataFrame, kept: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, idx, peers, n, v, lang_n, p0) of every group; idx counts the language's sources from 0."""
    occur = df.select(as_text(lang_col).alias("lang"), as_text(source_col).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("cnt").alias("n"), F.sum(F.col("first").cast("bigint")).alias("v"))
    whole = Window.partitionBy("lang")
    groups = occur.join(own, ["lang", "source"], "left").fillna(0, ["n", "v"])
    groups = groups.select(
        "lang", "source", (F.row_number().over(whole.orderBy("source")) - 1).alias("idx"),
        F.count("*").over(whole).cast("int").alias("peers"), "n", F.sum("v").over(whole).alias("v"), F.sum("n").over(whole).alias("lang_n"))
    return groups.withColumn("p0", _chance(F.lit(0), F.col("n"), F.col("v")))


def f(p, q):
    """The divergence of two chances; numbers, arrays or columns of whole numbers."""
    return F.call_function("div", (p - q) * (p - q), q) if isinstance(p, Column) else (p - q) * (p - q) // q


def corrections(idx: np.ndarray, p: np.ndarray, p0: np.ndarray, starts: np.ndarray, sums: dict[int, np.ndarray], peers: int) -> None:
    """Add to ``sums`` what the terms of an index slice give beyond the baselines.

    Rows ``starts[i]`` up to ``starts[i + 1]`` are the groups that have the i-th term.
    """
    term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.argsort(idx, kind="stable")
    cuts = np.flatnonzero(np.diff(idx[order])) + 1
    for rows in np.split(order, cuts):
        row = sums.setdefault(int(idx[rows[0]]), np.zeros(peers, dtype=np.int64))
        sizes = starts[term[rows] + 1] - starts[term[rows]]
        ends = np.cumsum(sizes)
        done = 0
        while done < len(rows):  # so many of the group's terms that their lists make about HELD rows
            to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + HELD, "right")))
            part, size = rows[done:to], sizes[done:to]
            at = np.repeat(starts[term[part]] - np.cumsum(size) + size, size) + np.arange(size.sum())
            mine, base, theirs, other = np.repeat(p[part], size), p0[part[0]], p[at], p0[at]
            np.add.at(row, idx[at], f(mine, theirs) - f(mine, other) - f(base, theirs) + f(base, other))
            done = to


_SUMS = "lang string, g int, s int, value bigint"


def _sums(lang: str, g: np.ndarray, s: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int32()), pa.array(s, pa.int32()), pa.array(value, pa.int64())],
        ["lang", "g", "s", "value"])


def _whole_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table, np.ndarray]]:
    """Slices of one language with the rows at which terms start, from batches sorted by lang and term."""
    rest: list[pa.Table] = []
    rows = 0
    for batch in batches:
        rest.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= HELD:
            whole = pa.concat_tables(rest).combine_chunks()
            cut = int(_term_starts(whole)[-2])
            if cut:
                yield from _by_lang(whole.slice(0, cut))
            rest, rows = [whole.slice(cut)], whole.num_rows - cut
    if rows:
        yield from _by_lang(pa.concat_tables(rest))


def _differs(column: pa.ChunkedArray) -> np.ndarray:
    return pc.not_equal(column[1:], column[:-1]).to_numpy()


def _term_starts(table: pa.Table) -> np.ndarray:
    new = _differs(table["lang"]) | _differs(table["term"])
    return np.concatenate([[0], np.flatnonzero(new) + 1, [table.num_rows]])


def _by_lang(table: pa.Table) -> Iterator[tuple[str, pa.Table, np.ndarray]]:
    table = table.combine_chunks()
    cuts = [0, *(np.flatnonzero(_differs(table["lang"])) + 1).tolist(), table.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = table.slice(a, b - a).combine_chunks()
        yield part["lang"][0].as_py(), part, _term_starts(part)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    open_lang = None

    def written() -> Iterator[pa.RecordBatch]:
        for g, row in sums.items():
            s = np.flatnonzero(row)
            yield _sums(open_lang, np.full(len(s), g), s, row[s])
        sums.clear()

    for lang, table, starts in _whole_terms(batches):
        if lang != open_lang or sum(map(len, sums.values())) > CELLS:
            yield from written()
            open_lang = lang
        corrections(
            table["idx"].to_numpy().astype(np.int64), table["p"].to_numpy(), table["p0"].to_numpy(), starts, sums, table["peers"][0].as_py())
    yield from written()


def _baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of a group, its number of terms with each chance and all groups' p0: what the group gives to its pairs."""
    for batch in batches:
        for r in range(batch.num_rows):
            lang, idx, v, own = (batch[c][r].as_py() for c in ("lang", "idx", "v", "p0"))
            chances, base = batch["chances"][r].values, np.array(batch["bases"][r].as_py(), dtype=np.int64)
            p, n = (chances.field(c).to_numpy() for c in ("p", "n"))
            neither = f(own, base)
            mine, theirs = v * neither, np.zeros(len(base), dtype=np.int64)
            for at in range(0, len(p), 4096):
                x, k = p[at:at + 4096, None], n[at:at + 4096, None]
                mine += (k * (f(x, base) - neither)).sum(axis=0)
                theirs += (k * (f(base, x) - f(base, own))).sum(axis=0)
            peers, me = np.arange(len(base)), np.full(len(base), idx)
            yield _sums(lang, me, peers, mine)
            yield _sums(lang, peers, me, theirs)


def divergence(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: a row for each other source of the language (item) with the sum over all terms. Part ``term``: the
    ``TERMS`` terms of the group with most f of its chance against the language's, where its own is larger.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, "divergence")
    term_counts(df, lang_col, source_col, text_col).write.parquet(f"{folder}/terms")
    kept = spark.read.parquet(f"{folder}/terms")
    _groups(df, kept, lang_col, source_col).write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups")

    index = kept.join(groups, ["lang", "source"]).withColumn("p", _chance(F.col("cnt"), F.col("n"), F.col("v")))
    walked = index.select("lang", "term", "idx", "peers", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term", "idx")
    walked = walked.mapInArrow(_walk, _SUMS)

    chances = index.groupBy("lang", "idx", "p").agg(F.count("*").alias("k"))
    chances = chances.groupBy("lang", "idx").agg(F.collect_list(F.struct("p", F.col("k").alias("n"))).alias("chances"))
    bases = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("idx", "p0"))).alias("bases"))
    rows = groups.select("lang", "idx", "v", "p0").join(chances, ["lang", "idx"], "left").join(bases, "lang")
    none = F.array().cast("array<struct<p:bigint,n:bigint>>")
    rows = rows.select("lang", "idx", "v", "p0", F.coalesce("chances", none).alias("chances"), F.col("bases.p0").alias("bases"))
    based = rows.mapInArrow(_baselines, _SUMS)

    sums = walked.unionByName(based).where("g <> s").groupBy("lang", "g", "s").agg(F.sum("value").alias("value"))
    sources = groups.select("lang", "source", "idx")
    pairs = sums.join(sources.withColumnRenamed("idx", "g"), ["lang", "g"])
    pairs = pairs.join(sources.select("lang", F.col("source").alias("item"), F.col("idx").alias("s")), ["lang", "s"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.withColumn("rank", rank)

    q = _chance(F.col("lang_cnt"), F.col("lang_n"), F.col("v"))
    terms = index.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), f(F.col("p"), F.col("q")).alias("value"))
    terms = top_n(terms, ["lang", "source"], [F.desc("value"), F.asc("item")], TERMS)
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.select(*columns).unionByName(terms.select(*columns))
