"""Mixing sources to target sizes by systematic sampling.

A source's target over its size is what each of its documents is expected to be copied. Expected
copies are summed along the source's documents, in order of size, one random offset per source is
added, and a document is emitted once for every whole number its stretch of the sum crosses. Lying in
order of size, the documents taken are spread evenly over all sizes, so the words taken come near
the target. Expected copies are at most LIMIT, and so are copies.

The sum along a source is its document's rank times the expected copies. Documents are range
partitioned by (source, size, hash, id), counted by partition, and ranked inside their partition on
top of the counts before it: a hot source is many partitions.

Defined results: a null text has size 0; the null source comes last among sources and is one
of them; ties of size go by a hash of the id, then the id; repeated rows are ranked each; a source
without words has target 0 and is never taken; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.tables import WORD, settled

#: Fixed values of the mix: repeating weights, share of all sizes, most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
SEED = 10


def words_in(text: Column) -> Column:
    """Words of a text: starts of runs that aren't white space."""
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def unit(text: Column) -> Column:
    """A number in [0, 1) from a text's digest; any engine with md5 gives the same."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / 16.0**12


def named(source: str) -> Column:
    """The source as text that is never null and tells null from every name."""
    return F.coalesce(F.concat(F.lit("+"), F.col(source)), F.lit("-"))


def targets(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """source, source_size, target and offset, a row per source.

    Weighted shares that stop at LIMIT times the source's size: a source is full when the level
    (target by weight) is above its own limit by weight, so sources fill in order of that limit. The
    level is what is left after the full ones, over the weights of the rest.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(ordered) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)),
                          (place % len(WEIGHTS) + 1).cast("int"))
    everything = Window.partitionBy()
    first = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    rest = first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) \
        / F.sum("weight").over(rest)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.col("source_size").cast("double") * LIMIT)
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * SHARE)
        .withColumn("level", level)
        # A source is open if the level, were it the first open one, leaves it below its limit.
        .withColumn("open", F.col("level") < F.col("ratio"))
        # Levels only fall after the first open source, so its level is the greatest of them.
        .withColumn("final", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
        .select("source", "source_size",
                F.when(F.col("open"), F.col("final") * F.col("weight"))
                .otherwise(F.col("most")).alias("target"),
                unit(F.concat(F.lit(f"{seed}:"), named("source"))).alias("offset"))
    )


def copies(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds source_size, target and copies to rows of doc_id, source and size."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # Ranks are built on the counts of the same partitions, so these are written down. `of` is
    # the source as a value that is never null.
    dealt = settled(
        sized.select("doc_id", "source", "size", key.alias("key"), named("source").alias("of"))
        .repartitionByRange(F.col("of"), F.col("size"), F.col("key"), F.col("doc_id"))
        .withColumn("part", F.spark_partition_id()), "dealt")
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = targets(dealt, seed).withColumn("of", named("source")).drop("source")
    # A row for each source and partition: ranks before it, and the source's target.
    ahead = (
        dealt.groupBy("of", "part").agg(F.count("*").alias("n"))
        .select("of", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
        .join(plan, "of")
    )
    own = Window.partitionBy("of", "part").orderBy("size", "key", "doc_id")
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = lambda rank: F.floor(F.col("offset") + step * rank)
    return (
        dealt.withColumn("own", F.row_number().over(own))
        .join(ahead, ["of", "part"])
        .withColumn("rank", F.col("ahead") + F.col("own"))
        .select("doc_id", "source", "size", "source_size", "target",
                (crossed(F.col("rank")) - crossed(F.col("rank") - 1)).alias("copies"))
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken for each row of doc_id, text and source."""
    sized = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"))
    return copies(sized, seed).select("doc_id", "size", "source_size", "target",
                                      (F.col("copies") * F.col("size")).alias("taken"))
