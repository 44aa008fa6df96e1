"""Joins of a large fact with a lookup table.

The lookup side is measured first. Up to ``BROADCAST_BYTES`` it is broadcast; beyond that the join is
shuffled. Keys of which the fact has more than ``HOT_ROWS`` rows are counted out and salted, each over as
many tasks as its count asks for; only their lookup rows are copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
HOT_ROWS = 10_000_000


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's rows, from one aggregate over it."""
    width = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def _shuffled_join(fact: DataFrame, lookup: DataFrame, key: str, how: str,
                   hot_rows: int) -> DataFrame:
    """An equi join whose hot keys, if the fact has any, are salted."""
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    # At most one entry for each hot_rows rows of the fact.
    hot = {r[key]: -(-r["_n"] // hot_rows) for r in counts.filter(F.col("_n") > hot_rows).collect()}
    if not hot:
        return fact.join(lookup.hint("merge"), key, how)
    spread = fact.sparkSession.createDataFrame(
        list(hot.items()), f"`{key}` {dict(fact.dtypes)[key]}, _salts int")
    # The task number spreads even identical rows, and stays the same when a task is run again.
    salt = F.pmod(F.spark_partition_id(), F.coalesce("_salts", F.lit(1)))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    salted = fact.join(F.broadcast(spread), key, "left").withColumn("_salt", salt).drop("_salts")
    copied = lookup.join(F.broadcast(spread), key, "left").withColumn("_salt", copies).drop("_salts")
    return salted.join(copied.hint("merge"), [key, "_salt"], how).drop("_salt")


def semi_lookup(fact: DataFrame, entities: DataFrame, key: str,
                broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keep fact rows whose key occurs in ``entities``; columns stay in order."""
    ids = entities.select(key)
    if measured_bytes(ids) <= broadcast_bytes:
        joined = fact.join(F.broadcast(ids), key, "left_semi")
    else:
        joined = _shuffled_join(fact, ids.distinct(), key, "left_semi", hot_rows)
    return joined.select(*fact.columns)


def lookup_name(fact: DataFrame, dimension: DataFrame, key: str = "player_id",
                name: str = "player_name", broadcast_bytes: int = BROADCAST_BYTES,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the name of an entity from ``dimension(id, full_name)``; the id as text if it has none.

    The dimension is reduced to one name per id (the smallest), so no fact row is multiplied.
    """
    entries = dimension.filter(F.col("id").isNotNull()).select(F.col("id").alias(key), "full_name")
    names = entries.groupBy(key).agg(F.min("full_name").alias("_name"))
    if measured_bytes(entries) <= broadcast_bytes:
        joined = fact.join(F.broadcast(names), key, "left")
    else:
        joined = _shuffled_join(fact, names, key, "left", hot_rows)
    return joined.select(
        *[c for c in fact.columns if c != name],
        F.coalesce("_name", F.col(key).cast("string")).alias(name),
    )
