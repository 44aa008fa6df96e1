"""Projections and column transforms."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions import casts
from statloom.functions.dates import day


def _types(df: DataFrame) -> dict[str, T.DataType]:
    """Column types by lower-cased name, as names match without regard to case."""
    return {f.name.lower(): f.dataType for f in df.schema.fields}


def cast_int(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast the listed columns to 32-bit integers."""
    types = _types(df)
    return df.withColumns({
        c: casts.to_integral(c, types[c.lower()], "int") for c in columns
    })


def cast_float(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast the listed columns to 32-bit floats."""
    return df.withColumns({c: casts.to_float(c) for c in columns})


def parse_date(df: DataFrame, column: str, fmt: str) -> DataFrame:
    """Replace a text column by its date."""
    return df.withColumn(column, casts.to_date(column, fmt, _types(df)[column.lower()]))


def stamp(df: DataFrame, run_date: date | str, column: str = "ingestion_date") -> DataFrame:
    """Add the run date as a constant DATE column."""
    return df.withColumn(column, day(run_date))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def project(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select the contract's columns in order; a missing one is an error, extra ones go."""
    return df.select(*contract.names)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to the contract and bring every column to the contract's type."""
    types = _types(df)
    return df.select(*[
        F.col(f.name) if types[f.name] == f.dataType
        else casts.to_text(f.name, types[f.name]).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else casts.to_integral(f.name, types[f.name], "bigint").alias(f.name)
        if isinstance(f.dataType, T.LongType)
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in contract.fields
    ])


def widen(df: DataFrame) -> DataFrame:
    """Turn 32-bit numbers into their 64-bit types."""
    wider = {T.IntegerType(): "bigint", T.FloatType(): "double"}
    return df.withColumns({
        f.name: F.col(f.name).cast(wider[f.dataType])
        for f in df.schema.fields if f.dataType in wider
    })


def fill_missing(df: DataFrame) -> DataFrame:
    """Replace every null (and NaN) by zero, written as "0" in text columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(0).na.fill("0", subset=texts)
