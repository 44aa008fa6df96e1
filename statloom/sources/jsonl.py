"""JSON lines: one record per line, never with an inferred schema.

A feed is read as records: keys match without regard to case, and a value that is not of the declared
type keeps its JSON type (as a variant), so that a number spelled as text, or a decimal id, reaches the
tolerant casts instead of being lost. ``read_json_lines`` is for files whose types are our own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.schemas import CORRUPT, ODD, STAMP, TableSpec


# Lines of one file at most: a compressed file is read by one task.
FILE_LINES = 500_000
# Whole numbers below this are exact as doubles.
EXACT = 2.0 ** 53
# Text that may be another JSON value written out: a variant would spell some of those differently.
_MAY_BE_VALUE = r"^(?:[\"{\[]|(?:-?[0-9]+(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|[-+]?(?:NaN|INF|Infinity))$)"
# Among it digits alone are the same either way; with leading zeros they can only be text.
_DIGITS = "^[0-9]{1,18}$"


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write every record with all its keys, replacing what the path holds unless ``mode`` is ``append``.

    Files are compressed, since each record repeats the names of its keys, and bounded, since such files are not split.
    A low level is enough for repeated keys; the default one takes longer than making the records.
    """
    (df.write.mode(mode).option("ignoreNullFields", "false")
     .option("compression", "gzip").option("zlib.compress.level", "THREE")
     .option("maxRecordsPerFile", FILE_LINES).json(path))


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    keep_corrupt: bool = False) -> DataFrame:
    """Read one or many paths in a single scan; a broken line becomes a row of nulls.

    With ``keep_corrupt`` the text of broken lines is kept in an extra column.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _spec_keys(spec: TableSpec) -> list[str]:
    return [n for n in spec.contract.names if n != STAMP]


def spellings(lines: DataFrame, spec: TableSpec) -> list[str]:
    """The keys of a feed that are contract columns, in every spelling that occurs: a few rows.

    Lines are only split into tokens; those that are no JSON objects have no keys.
    """
    # Records of one make have the same keys: their lists are compared before they are taken apart.
    lists = lines.select(F.json_object_keys("value").alias("keys")).distinct()
    keys = lists.select(F.explode("keys").alias("key")).distinct()
    return sorted(r["key"] for r in keys.filter(F.lower("key").isin(_spec_keys(spec))).collect())


def _as_declared(spec: TableSpec, name: str, source: T.DataType, value: Column) -> Column:
    """Whether a value read as declared is what its variant would give; false for null.

    A variant is cast by a look-up and several casts a value, and of an odd record most values still are of their declared type.
    """
    if isinstance(source, T.StringType):
        same = value.rlike(_DIGITS) | ~value.rlike(_MAY_BE_VALUE)
    elif name in spec.float_columns and isinstance(source, T.DoubleType):
        # Halfway between two floats the decimal digits decide, and they do on the sign of a zero.
        near = value.cast("float").cast("double")
        other = value * 2 - near
        same = F.abs(value).between(1e-30, 1e30) & ((value == near) | (other != other.cast("float").cast("double")))
    elif isinstance(source, T.DoubleType):
        same = F.abs(value) < F.lit(EXACT)
    else:
        same = value.isNotNull()
    return F.coalesce(same, F.lit(False))


def records(lines: DataFrame, spec: TableSpec, *kept: str, known: list[str] | None = None) -> DataFrame:
    """Lines of text (column ``value``) as records of a feed.

    Lines are parsed by the declared types under the spellings ``known``, by default the spec's own. Where that
    can't read a record (a key spelled otherwise, another JSON type, a broken line) the record is ``odd``
    and values that were not read, or not exactly, come as variants. So there are one column of the declared type and one
    variant column (ODD and the name) for each contract column, under its lower-cased name; ``odd``; the text of a line that
    is no JSON object; ``value`` and the columns ``kept``. Blank lines are skipped, other keys ignored; a record with two spellings of one
    key is an error.
    """
    names = _spec_keys(spec)
    types = {f.name.lower(): f.dataType for f in spec.raw.fields}
    own = {n: [f.name for f in spec.raw.fields if f.name.lower() == n] for n in names}
    by_name = {n: [k for k in known if k.lower() == n] or own[n] for n in names} if known else own
    keys = [k for n in names for k in by_name[n]]
    schema = T.StructType([*(T.StructField(k, types[k.lower()]) for k in keys),
                           T.StructField(CORRUPT, T.StringType())])
    # Fields go by number from here on: Spark takes spellings of one name for the same field.
    numbered = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(schema.fields)])
    declared = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).cast(numbered)
    field = {k: F.col("_plain")[f"k{i}"] for i, k in enumerate([*keys, CORRUPT])}
    several = [sum((field[k].isNotNull().cast("int") for k in by_name[n]), F.lit(0)) > 1
               for n in names if len(by_name[n]) > 1]
    unread = F.col("_plain").isNull() | field[CORRUPT].isNotNull() | ~F.ltrim("value").startswith("{")
    if known is None:
        # A column is null for want of its key under this spelling, or by its value: the keys tell.
        others = F.filter(F.json_object_keys("value"), lambda k: F.lower(k).isin(names) & ~k.isin(keys))
        several.append(reduce(Column.__or__, [field[k].isNull() for k in keys]) & (F.size(others) > 0))
    odd = reduce(Column.__or__, several, unread)
    values = F.transform_keys(F.from_json("value", "map<string,variant>"), lambda k, _: F.lower(k))
    declared_of = {n: F.coalesce(*(field[k] for k in by_name[n])) for n in names}
    # Exploding a list of one keeps the optimizer from parsing the line anew for each column.
    return (
        lines.filter(F.trim("value") != "")
        .select("value", F.explode(F.array(declared)).alias("_plain"), *kept)
        .select("*", F.explode(F.array(F.coalesce(odd, F.lit(True)))).alias("odd"))
        .select("*", F.explode(F.array(F.when(F.col("odd"), values))).alias("_record"))
        .select(*(declared_of[n].alias(n) for n in names), "_record", "odd", "value", *kept)
        .select(*names,
                *(F.when(F.col("odd") & ~_as_declared(spec, n, types[n], F.col(n)), F.col("_record")[n]).alias(ODD + n)
                  for n in names), "odd",
                F.when(F.col("odd") & F.col("_record").isNull(), F.col("value")).alias(CORRUPT),
                "value", *kept)
    )


def read_records(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """Records of a feed from one or many paths, under the spellings that a first pass finds."""
    lines = spark.read.text(path)
    return records(lines, spec, known=spellings(lines, spec))


def presence(spec: TableSpec) -> list[Column]:
    """Aggregates over records: how many there are, and whether each contract column has a value."""
    return [F.count(F.when(F.col(CORRUPT).isNull(), 1)).alias("_n"),
            *(F.max((F.col(n).isNotNull() | F.col(ODD + n).isNotNull()).cast("int")).alias(n)
              for n in _spec_keys(spec))]


def require_columns(seen: dict[str, int | None], spec: TableSpec, lines: DataFrame | None = None) -> None:
    """Raise if a contract column occurs in no record; an empty feed passes.

    A column that only ever is null has its key in the ``lines``, which are searched for it.
    """
    missing = [n for n in _spec_keys(spec) if not seen[n]]
    if seen["_n"] and missing:
        held = {k.lower() for k in spellings(lines, spec)} if lines is not None else set()
        if absent := [n for n in missing if n not in held]:
            raise ValueError(f"{spec.name}: no record has {', '.join(absent)}")
