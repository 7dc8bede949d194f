"""From raw documents to packed token sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)``; ``docs`` are the rows its
predecessor kept, with the columns of ``documents`` (and any others, which are
passed on).  A stage's decision takes effect in the rows it returns:

1. ``quality_rules``: rows that the rules reject go;
2. ``exact_dedup``: one row of each group of equal texts stays;
3. ``simhash_near_dedup``: one row of each group stays, the one with the
   smallest id, null last, then the smallest hash (3-word shingles, at most 3
   bits apart);
4. ``source_mixing``: a row comes as often as the mix takes its document;
5. ``packing``: pieces of the documents' token ids in sequences of at most
   2048 ids: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``,
   ``sequence_id``, ``offset``.

Where verdicts per row are joined back, it is by the id and a hash of the row, so
a null or repeated id does no harm.  Repeated rows are judged alike, but both
dedup stages keep one of them.  Small verdict tables are written
first, so Spark knows their size when it chooses between a broadcast and a sort
merge join.  An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retally.llm.exact_dedup import drop_exact
from retally.llm.mixing import mix
from retally.llm.packing import pack_documents
from retally.llm.quality import good_documents
from retally.llm.shared import materialise
from retally.llm.simhash import near_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _compared(docs: DataFrame) -> list[str]:
    """The columns that tell rows apart: all but maps, which Spark neither hashes nor compares."""
    return [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]


def _row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*[docs[f"`{c}`"] for c in _compared(docs)])


def _keyed(docs: DataFrame) -> DataFrame:
    """What the operators read, under a name that no other column has."""
    return docs.select(*COLUMNS, _row_hash(docs).alias("row_hash"))


def _same_row(docs: DataFrame, verdicts: DataFrame) -> Column:
    return (_row_hash(docs) == verdicts["row_hash"]) & docs["doc_id"].eqNullSafe(verdicts["doc_id"])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = (near_groups(_keyed(docs), shingle=3, radius=3, row_key="row_hash").groupBy("doc_id", "row_hash")
            .agg(F.first("first").alias("first"), F.count("*").alias("n_rows")).where("not first or n_rows > 1"))
    gone = materialise(rows, "pipeline-near")
    # Rows that repeat another in every column: all go with the losers, one of each comes back.
    repeated = materialise(gone.where("first").select("doc_id", "row_hash"), "pipeline-near-repeated")
    again = docs.join(repeated, _same_row(docs, repeated), "left_semi").dropDuplicates(_compared(docs))
    return docs.join(gone, _same_row(docs, gone), "left_anti").unionByName(again)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdicts = materialise(mix(_keyed(docs), ["doc_id", "row_hash"]).groupBy("doc_id", "row_hash")
                           .agg(F.sum("copies").alias("copies"), F.count("*").alias("n_rows")), "pipeline-copies")

    often = "copies"
    while often in docs.columns:
        often += "_"

    def taken(rows: DataFrame, part: DataFrame) -> DataFrame:
        part = part.where("copies > 0").withColumnRenamed("copies", often)
        return (rows.join(part, _same_row(rows, part)).select(
            F.struct(*[rows[f"`{c}`"] for c in docs.columns]).alias("doc"), F.explode(F.sequence(F.lit(1), F.col(often))).alias("copy"))
            .select("doc.*"))

    # Rows that repeat another in every column are one row here, taken as often as all of them.
    repeated = materialise(verdicts.where("n_rows > 1"), "pipeline-repeated")
    again = docs.join(repeated, _same_row(docs, repeated), "left_semi").dropDuplicates(_compared(docs))
    return taken(docs, verdicts.where("n_rows = 1")).unionByName(taken(again, repeated))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, end_id=1, window=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

# SimHash components, the Newton solution and token ids have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
