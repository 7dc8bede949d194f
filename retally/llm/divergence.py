"""Source divergence audit: how the sources of each language differ in their words.

1. Whole texts are written once to the shared folder, filed by language, and
   parted into terms (runs of ASCII letters, A-Z in lower case, and characters
   beyond ASCII) where they are read: by Arrow kernels, cheaper than a stored
   array of terms is to write and read.
2. Per language a ``CountVectorizer`` with ``minDF = min_docs`` and the largest
   integer as ``vocabSize`` learns every term of at least ``min_docs``
   documents.  It asks only in how many documents a term is, so it is given each
   document's distinct terms.  The model then turns each document, repeated
   terms included, into its exact sparse count vector.
3. The vectors are added up per (language, source), in each task by whole arrays
   first, as ``Summarizer`` does but sparse; only terms that occur in a group
   have a row.  Terms are numbered in UTF-8 order, so numbers stand for terms
   until the listed ones are looked up at the end.
4. A group's share of a term is ``1 + floor(SCALE * (n + 5) / (N + 5 V))`` (n its
   occurrences there, N those of all kept terms, V the kept terms), in whole
   numbers.  The divergence of two sources is the sum of the absolute
   differences over all kept terms.  It is evaluated sparsely: V times the
   difference of the shares of an absent term, corrected at the terms that
   either source has.
5. Sources are dealt into tiles of about ``TILE`` and terms into blocks of
   ``BLOCK``; a task holds two tiles for one block and sends one partial sum per
   pair.  So neither a term that all sources have nor a language with very many
   sources meets in one task, and pairs are formed of sources, never of rows.
6. The terms that mark a group are those with a larger share than in the whole
   language; the ``top`` largest differences are listed.

The vocabulary of one language at a time is held by the driver and sent to the
executors, as in every ``CountVectorizer``; it has at most (distinct terms per
document) * (documents) / ``min_docs`` entries and in natural text far fewer.

Defined results: null text, language and source are read as empty strings,
which are values like others; every occurring group takes part, also without a
term; a language without kept terms gives pairs of value 0 and no terms;
repeated rows are documents of their own; a lone source has no pairs; an empty
table gives an empty result.  Only the named columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retally.llm.shared import fresh_path, materialise
from retally.llm.terms import distinct_terms, terms_of
from retally.llm.tokens import slices

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50
TILE = 64            # sources of a tile, about
BLOCK = 2048         # terms of a block
ALL_TERMS = 2**31 - 1

BATCH_BYTES = 4 * 1024 * 1024     # of an Arrow batch given to Python
TERM_SLICE = 1024 * 1024          # bytes of text parted at once
HELD = 500_000                    # entries of vectors that a task holds before it adds them up
NARROW = 9_000_000_000            # below this, SCALE * (n + SMOOTHING) is a long


def with_terms(docs: DataFrame, text: str = "text", distinct: bool = False) -> DataFrame:
    """The other columns of ``docs`` and ``terms``, those of the whole text, for documents that have any.

    All terms in order, or each of a document's terms once.
    """
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            for a, b in slices(texts, TERM_SLICE):
                lists, some = terms_of(texts.slice(a, b - a))
                yield pa.record_batch([*[c.slice(a, b - a).filter(some) for c in batch.columns[:-1]],
                                       distinct_terms(lists) if distinct else lists], names=[*others, "terms"])
                del lists
                pa.default_memory_pool().release_unused()      # what a slice took is given back before the next one

    read = docs.select(*others, text)
    return read.mapInArrow(run, read.drop(text).schema.add("terms", T.ArrayType(T.StringType())))


def _added(number: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds up the entries of (source, indices, values) rows of a task to (source, place, n); ``number``: places by index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[pa.Table] = []

        def sums() -> pa.Table:
            return pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

        def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
            source, place = np.divmod(table["key"].to_numpy(), len(number))
            out = pa.table({"source": pa.array(list(names), pa.string()).take(pa.array(source)),
                            "place": place.astype(np.int32), "n": table["n"]})
            yield from out.to_batches(max_chunksize=65_536)

        for batch in batches:
            sources, places, values = batch.columns
            coded = sources.dictionary_encode()
            codes = np.array([names.setdefault(s, len(names)) for s in coded.dictionary.to_pylist()], np.int64)
            base = np.repeat(codes[coded.indices.to_numpy()] * len(number), places.value_lengths().to_numpy())
            held.append(pa.table({"key": base + number[places.flatten().to_numpy()], "n": values.flatten().cast(pa.int64())}))
            if sum(map(len, held)) > HELD:
                held = [sums()]
                if len(held[0]) > HELD // 2:
                    yield from rows(held.pop())
                    names.clear()
                pa.default_memory_pool().release_unused()
        if held:
            yield from rows(sums())

    return run


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand rows to Python ``BATCH_BYTES`` at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def group_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str,
                 min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Tables of the kept terms' counts (lang, source, place, n, lang_n), of all groups (lang, source), of
    vocabulary sizes (lang, v) and of the vocabularies (lang, place, term), numbered from 0 in UTF-8 order.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "divergence-texts")
    read = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).alias("text"))
    read.withColumn("file_key", F.hex(F.xxhash64("lang"))).write.partitionBy("file_key").parquet(path)
    texts = spark.read.schema("lang string, source string, text string, file_key string").parquet(path)
    groups = materialise(texts.groupBy("lang", "source", "file_key").agg(F.count("*").alias("docs")), "divergence-groups")
    sums_path, vocabulary_path = fresh_path(spark, "divergence-sums"), fresh_path(spark, "divergence-vocabulary")
    vector = F.unwrap_udt("vector")
    sizes = []
    with small_batches(spark):
        for lang in groups.groupBy("lang", "file_key").agg(F.sum("docs").alias("docs")).collect():      # one row per language
            own = texts.where((F.col("file_key") == lang["file_key"]) & (F.col("lang") == lang["lang"])).select("source", "text")
            if lang["docs"] < min_docs:                          # no term can be in so many documents
                sizes.append((lang["lang"], 0))
                continue
            model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=ALL_TERMS).fit(
                with_terms(own.select("text"), distinct=True))
            words = model.vocabulary
            sizes.append((lang["lang"], len(words)))
            if not words:
                continue
            order = sorted(range(len(words)), key=words.__getitem__)
            number = np.empty(len(words), np.int64)
            number[order] = np.arange(len(words))
            entries = model.transform(with_terms(own)).select("source", vector["indices"].alias("places"), vector["values"].alias("n"))
            counts = (entries.mapInArrow(_added(number), "source string, place int, n long").repartition("source", "place")
                      .groupBy("source", "place").agg(F.sum("n").alias("n")))
            (counts.select(F.lit(lang["lang"]).alias("lang"), "source", "place", "n",
                           F.sum("n").over(Window.partitionBy("place")).alias("lang_n"))
             .write.mode("append").parquet(sums_path))
            numbered = pa.table({"place": pa.array(np.arange(len(words), dtype=np.int32)), "term": pa.array([words[k] for k in order], pa.string())})
            spark.createDataFrame(numbered).withColumn("lang", F.lit(lang["lang"])).write.mode("append").parquet(vocabulary_path)
    sized = spark.createDataFrame(sizes, "lang string, v long")
    sums, vocabulary = "lang string, source string, place int, n long, lang_n long", "place int, term string, lang string"
    if not any(v for _, v in sizes):
        return spark.createDataFrame([], sums), groups, sized, spark.createDataFrame([], vocabulary)
    return (spark.read.schema(sums).parquet(sums_path), groups, sized, spark.read.schema(vocabulary).parquet(vocabulary_path))


def share(n: Column, total: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * v))``, exactly (null without terms)."""
    wide = "decimal(22,0)"
    below = F.nullif(total + SMOOTHING * v, F.lit(0))
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTHING).cast(wide)
    narrow = F.call_function("div", F.lit(SCALE).cast("long") * (n + SMOOTHING), below)
    return F.when(n < NARROW, narrow).otherwise(F.call_function("div", above, below.cast(wide))) + 1


def _pair_sums(rows: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences between the sources of two tiles over one block of terms."""
    lang, block, low, high, v = sources[["lang", "block", "low", "high", "v"]].iloc[0]
    names = sources["source"].to_numpy()
    absent = sources["absent"].to_numpy(dtype=np.int64)
    place, column = np.unique(rows["place"].to_numpy(dtype=np.int64), return_inverse=True)
    number = pd.Series(np.arange(len(names)), index=names)[rows["source"]].to_numpy() if len(rows) else np.empty(0, np.int64)
    shares = np.repeat(absent[:, None], len(place), axis=1)
    shares[number, column] = rows["share"].to_numpy(dtype=np.int64)
    has = np.zeros(shares.shape, bool)
    has[number, column] = True
    left, right = (np.flatnonzero(sources["tile"].to_numpy() == tile) for tile in (low, high))
    theirs_row, theirs_column = np.nonzero(has[right])                   # entries of the right tile, source by source
    theirs = shares[right[theirs_row], theirs_column]
    bounds = np.searchsorted(theirs_row, np.arange(len(right) + 1))
    found = []
    for a in left:
        apart = np.abs(absent[right] - absent[a])
        own = np.flatnonzero(has[a])
        total = (np.abs(shares[np.ix_(right, own)] - shares[a, own]) - apart[:, None]).sum(axis=1, dtype=np.int64)
        only = np.where(has[a][theirs_column], 0, np.abs(theirs - absent[a]) - apart[theirs_row])
        upto = np.concatenate(([0], np.cumsum(only, dtype=np.int64)))
        total += upto[bounds[1:]] - upto[bounds[:-1]]
        if block == 0:
            total += int(v) * apart
        other = right != a
        found.append(pd.DataFrame({"source": names[a], "item": names[right[other]], "value": total[other]}))
    out = pd.concat(found, ignore_index=True) if found else pd.DataFrame({"source": [], "item": [], "value": []})
    if low != high:
        out = pd.concat([out, out.rename(columns={"source": "item", "item": "source"})], ignore_index=True)
    return out.assign(lang=lang)[["lang", "source", "item", "value"]].astype({"value": "int64"})


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): divergence between every two sources of a language."""
    wide = Window.partitionBy("lang")
    sources = (groups.withColumn("tiles", F.ceil(F.count("*").over(wide) / TILE).cast("int"))
               .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
               .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK)).cast("int"))
               .select("lang", "source", "v", "total", "tile", "tiles", "blocks", F.coalesce("absent", F.lit(0).cast("long")).alias("absent")))
    sources = materialise(sources, "divergence-sources")

    def met(rows: DataFrame) -> DataFrame:
        """Every row once for each tile that its own tile meets."""
        other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return other.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})

    shares = counts.join(sources.drop("absent"), ["lang", "source"]).withColumn("share", share(F.col("n"), F.col("total"), F.col("v")))
    entries = met(shares).select("lang", F.pmod("place", "blocks").alias("block"), "low", "high", "source", "place", "share")
    bases = met(sources.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))).select(
        "lang", "block", "low", "high", "source", "tile", "absent", "v")
    key = ["lang", "block", "low", "high"]
    parts = entries.groupBy(*key).cogroup(bases.groupBy(*key)).applyInPandas(
        _pair_sums, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, item: str = "item") -> DataFrame:
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc(item))
    return rows.withColumn("rank", F.row_number().over(place))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair``: every other source of the language by divergence.  Part
    ``term``: the ``top`` terms with the largest surplus over the language.
    """
    counts, groups, sizes, vocabulary = group_counts(docs, text_col, lang_col, source_col, min_docs)
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    whole = Window.partitionBy("lang")
    groups = (groups.join(sizes, "lang").join(totals, ["lang", "source"], "left")
              .select("lang", "source", "v", F.coalesce("total", none).alias("total"))
              .withColumn("lang_total", F.sum("total").over(whole))
              .withColumn("absent", share(F.lit(0), F.col("total"), F.col("v"))))
    groups = materialise(groups, "divergence-totals")
    pairs = _ranked(_pairs(counts, groups)).withColumn("part", F.lit("pair"))
    surplus = share(F.col("n"), F.col("total"), F.col("v")) - share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    above = counts.join(groups, ["lang", "source"]).select("lang", "source", "place", surplus.alias("value")).where("value > 0")
    terms = (_ranked(above, "place").where(F.col("rank") <= top).join(vocabulary, ["lang", "place"])
             .withColumnRenamed("term", "item").withColumn("part", F.lit("term")))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
