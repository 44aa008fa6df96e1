"""A training corpus from `documents`, stage by stage.

Each stage takes all that its predecessor kept and returns the columns of `documents`; the last
returns pieces of packed sequences. Stages: quality rules drop what they reject; of each group of
near-duplicates one document stays; personal data is replaced inside the texts; sources are mixed
to their target sizes, a document as often as the mix takes it; documents are packed.

Defined results, besides those of the operators: rows without a doc_id are never near-duplicates
of others and stay; rows that repeat a doc_id and its text are one document to the near-duplicate
stage; the mix gives repeated rows the copies of all of them in turn; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm import minmax, mixing, packing, quality, sanitise
from statloom.llm.tables import read, settled, shipped

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _text_key() -> Column:
    return F.xxhash64("text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the cutoffs of their language and source."""
    groups = quality.rates(quality.measure(docs, ["lang", "source"]))
    measured = quality.measure(docs, COLUMNS)
    return quality.judged(measured, quality.cutoffs(groups)).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 % of five-word shingles: the smallest doc_id."""
    docs = docs.select(*COLUMNS)
    decided = minmax.near_duplicates(docs, size=5, percent=80)
    staying = decided.where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("stays")).distinct()
    again = Window.partitionBy("doc_id", _text_key()).orderBy("source", "lang")
    found = (
        docs.hint("merge").join(staying, F.col("doc_id") == F.col("stays"), "left_semi")
        .withColumn("again", F.row_number().over(again)).where("again = 1"))
    return found.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data, and terms that give it away, replaced."""
    spans = (
        sanitise.spans_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
        .where(F.size("spans") > 0)
        .groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"))
        .agg(F.first("spans").alias("spans")))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (_text_key() == F.col("of_text"))
    joined = docs.select(*COLUMNS).hint("merge").join(spans, same, "left")
    return sanitise.rewritten(joined, COLUMNS).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    size = mixing.words_in(F.col("text"))
    sized = docs.select("doc_id", "source", size.alias("size"))
    # Rows alike in these columns share their copies.
    taken = (
        mixing.copies(sized).groupBy("doc_id", "source", "size")
        .agg(F.sum("copies").alias("total"), F.count("*").alias("rows"))
        .withColumnsRenamed({"doc_id": "of", "source": "of_source", "size": "of_size"}))
    same = (F.col("doc_id").eqNullSafe(F.col("of")) & (size == F.col("of_size"))
            & F.col("source").eqNullSafe(F.col("of_source")))
    k = F.row_number().over(Window.partitionBy("of", "of_source", "of_size").orderBy(_text_key()))
    upto = lambda n: F.floor(F.col("total") * n / F.col("rows"))
    return (
        docs.select(*COLUMNS).hint("merge").join(taken, same)
        .withColumn("k", k).withColumn("copies", (upto(F.col("k")) - upto(F.col("k") - 1)))
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*COLUMNS)
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    shipped(spark)
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_dedup), ("pii", pii),
          ("mix", mix_sources), ("pack", pack)]

#: Sketches, shingle sets, Luhn sums and tokens are beyond SQL; tests compare each stage with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written before the next reads them."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settled(docs, f"stage{i}")
    return docs
