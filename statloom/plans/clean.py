"""Cleaning: raw records to the typed, deduplicated contract of a table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions import casts
from statloom.operators import columns, rows
from statloom.schemas import CORRUPT, ODD, STAMP, TableSpec
from statloom.session import small_methods


def _are_records(df: DataFrame) -> bool:
    """Whether a frame comes from ``sources.jsonl.records``, with declared and variant columns."""
    return "odd" in df.columns and any(c.startswith(ODD) for c in df.columns)


class _Values:
    """Expressions over the columns of a raw frame, by lower-cased name, whichever way a record was read."""

    def __init__(self, df: DataFrame):
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.both = _are_records(df)

    def of(self, name: str, make: Callable[[str, T.DataType], Column]) -> Column:
        """``make`` of the column as declared or, where a record holds a variant of it, of that; null for a broken line."""
        plain = make(name, self.types[name])
        if not self.both or ODD + name not in self.types:
            return plain
        declared = F.col(ODD + name).isNull() & F.col(CORRUPT).isNull()
        return F.when(declared, plain).otherwise(make(ODD + name, T.VariantType()))


def _cast(spec: TableSpec, field: T.StructField) -> Callable[[str, T.DataType], Column]:
    """How a raw column becomes the contract's: the feed's own cast, then the contract's type."""
    def make(name: str, source: T.DataType) -> Column:
        if field.name == spec.date_column:
            return casts.to_date(name, spec.date_format, source)
        if field.name in spec.int_columns:
            return casts.to_integral(name, source)
        if field.name in spec.float_columns:
            return casts.to_float(name)
        if isinstance(field.dataType, T.LongType):
            return casts.to_integral(name, source, "bigint")
        return casts.to_text(name, source)
    return make


def typed(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Column work only: names, dates, casts, null keys, projection. No shuffle.

    The stamp is added after deduplication; records that carry one already keep it.
    """
    small_methods(raw.sparkSession)
    stamped = STAMP in raw.columns
    contract = T.StructType([f for f in spec.contract.fields if stamped or f.name != STAMP])
    if _are_records(raw):
        value = _Values(raw)
        return raw.select(*[
            F.col(STAMP) if f.name == STAMP
            else value.of(f.name, _cast(spec, f)).cast(f.dataType).alias(f.name)
            for f in contract.fields]).transform(rows.drop_null_keys, spec.required)
    return (
        raw.transform(columns.lowercase_columns)
        .transform(columns.parse_date, spec.date_column, spec.date_format)
        .transform(columns.cast_int, spec.int_columns)
        .transform(columns.cast_float, spec.float_columns)
        .transform(columns.conform, contract)
        .transform(rows.drop_null_keys, spec.required)
    )


def clean(raw: DataFrame, spec: TableSpec, run_date: date | str) -> DataFrame:
    """The cleaned batch of one run. The deduplication is the only shuffle."""
    return (
        raw.transform(typed, spec)
        .transform(rows.dedupe, spec.keys, dealt=True)
        .transform(columns.stamp, run_date)
        .transform(columns.project, spec.contract)
    )


def _has_value(name: str, source: T.DataType) -> Column:
    if isinstance(source, T.VariantType):
        return F.col(name).isNotNull() & ~F.is_variant_null(name)
    return F.col(name).isNotNull()


def _judgement(low: DataFrame, spec: TableSpec) -> list[Column]:
    """``rejected``, the columns that can't be read, and ``dropped``: no key is left.

    Both follow from the values, so they do not depend on what a caller selects.
    """
    value = _Values(low)
    fields = {f.name: f for f in spec.contract.fields}
    wide = [n for n, f in fields.items() if isinstance(f.dataType, T.LongType)]
    checked = [fields[n] for n in dict.fromkeys(
        [spec.date_column, *spec.int_columns, *spec.float_columns, *wide]) if n in value.types]

    def unreadable(field: T.StructField) -> Callable[[str, T.DataType], Column]:
        def test(name: str, source: T.DataType) -> Column:
            # Of typed columns only text can be unreadable.
            if not isinstance(source, (T.StringType, T.VariantType)):
                return F.lit(False)
            return _has_value(name, source) & _cast(spec, field)(name, source).isNull()
        return test

    failed = {f.name: value.of(f.name, unreadable(f)) for f in checked
              if value.both or isinstance(value.types[f.name], (T.StringType, T.VariantType))}
    if CORRUPT in value.types:
        failed[CORRUPT] = F.col(CORRUPT).isNotNull()
    required = fields[spec.required]
    names = F.array(*[F.when(test, F.lit(c)) for c, test in failed.items()])
    any_failed = reduce(Column.__or__, failed.values(), F.lit(False))
    return [F.when(any_failed, F.array_compact(names)).otherwise(F.array().cast("array<string>"))
            .alias("rejected"),
            value.of(required.name, _cast(spec, required)).isNull().alias("dropped")]


def _judged(raw: DataFrame, spec: TableSpec) -> DataFrame:
    small_methods(raw.sparkSession)
    low = raw.transform(columns.lowercase_columns)
    return low.select("*", *_judgement(low, spec))


def judge(records: DataFrame, spec: TableSpec) -> DataFrame:
    """Every record once, for all that a job makes of it: the contract's columns typed, ``rejected``, ``dropped``, and
    of records with either the text (``record``)."""
    small_methods(records.sparkSession)
    value = _Values(records)
    kept = [STAMP] if STAMP in records.columns else []
    rejected, dropped = _judgement(records, spec)
    return records.select(
        *(value.of(f.name, _cast(spec, f)).cast(f.dataType).alias(f.name)
          for f in spec.contract.fields if f.name != STAMP), rejected, dropped, "value", *kept
    ).select("*", F.when((F.size("rejected") > 0) | F.col("dropped"), F.col("value")).alias("record")
             ).drop("value")


def refused(judged: DataFrame) -> DataFrame:
    """Of judged records those that are dropped or hold an unreadable value, as their text."""
    return judged.filter(F.col("record").isNotNull()).select("record", "rejected", "dropped")


def accepted(judged: DataFrame, spec: TableSpec) -> DataFrame:
    """Of judged records the rows to store, in the contract's columns (without a stamp if there is none)."""
    return judged.filter(~F.col("dropped")).select(
        *(n for n in spec.contract.names if n in judged.columns))


def rejects(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Records that are dropped for want of a key, or that have a value the casts cannot read.

    ``rejected`` names the columns concerned, ``_corrupt_record`` standing for a broken line.
    ``dropped`` tells the records that are not stored; the others are, with null in those columns.
    """
    return _judged(raw, spec).filter((F.size("rejected") > 0) | F.col("dropped"))


def audit(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: records read, kept, dropped and duplicate (read is the sum of the others), and the
    records with an unreadable value. Takes raw or judged records.

    Counted per key before the shuffle, so copies of a key are one row.
    """
    judged = raw if "dropped" in raw.columns else _judged(raw, spec)
    value = _Values(judged)
    fields = [f for f in spec.contract.fields if f.name in spec.keys]
    by_key = judged.select(
        "dropped", (F.size("rejected") > 0).alias("flagged"),
        *(value.of(f.name, _cast(spec, f)).alias(f.name) for f in fields)
    ).groupBy("dropped", *spec.keys).agg(
        F.count("*").alias("n"), F.sum(F.col("flagged").cast("long")).alias("flagged"))
    stored = ~F.col("dropped")
    return by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_read"),
        F.count(F.when(stored, 1)).alias("kept"),
        F.coalesce(F.sum(F.when(~stored, F.col("n"))), F.lit(0)).alias("dropped"),
        F.coalesce(F.sum(F.when(stored, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("flagged"), F.lit(0)).alias("unreadable"))
