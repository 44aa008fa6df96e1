"""Casts that never fail a job: bad input gives null (or the nearest limit), ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Truncation toward zero; NaN is 0 and values out of range take the nearest limit.
_FROM_FLOATING = {
    "int": "cast(case when isnan({0}) then 0 when {0} >= 2147483647D then 2147483647 "
           "when {0} <= -2147483648D then -2147483648 else cast({0} as int) end as int)",
    "bigint": "case when isnan({0}) then 0L when {0} >= 9223372036854775807D "
              "then 9223372036854775807L when {0} <= -9223372036854775808D "
              "then -9223372036854775808L else cast({0} as bigint) end",
}

# Spark's casts ignore blanks and control characters around a number.
_PADDING = "[\\x00-\\x20\\x7f]*"
_WHOLE_PART = f"^{_PADDING}([+-]?[0-9]+)(?:[.][0-9]*)?{_PADDING}$"
_FRACTION_ONLY = f"^{_PADDING}[+-]?[.][0-9]*{_PADDING}$"


# How Spark's JSON writer spells doubles that JSON has no number for.
_NOT_FINITE = ("NaN", "Infinity", "-Infinity")


def _is_text(name: str) -> Column:
    """Whether a variant holds a JSON text; numbers follow another rule."""
    return ((F.schema_of_variant(name) == "STRING")
            & ~F.expr(f"try_cast(`{name}` as string)").isin(*_NOT_FINITE))


def to_text(name: str, source: T.DataType) -> Column:
    """The named column as text; a JSON null is null."""
    if isinstance(source, T.VariantType):
        return F.expr(f"try_cast(`{name}` as string)")
    return F.col(name).cast("string")


def _from_text(value: Column, target: str) -> Column:
    """The whole part of a decimal number; null for other text and for values out of range.

    The pattern comes before the cast, because a cast that fails costs an exception per row.
    """
    whole_part = F.nullif(F.regexp_extract(value, _WHOLE_PART, 1), F.lit(""))
    return F.coalesce(
        whole_part.try_cast(target),
        F.when(value.rlike(_FRACTION_ONLY), F.lit(0).cast(target)),
    )


def _from_variant(name: str, target: str) -> Column:
    """Text by the rule of text, whole numbers as they are, other numbers by the rule of doubles."""
    double = f"try_cast(`{name}` as double)"
    whole = F.expr(f"try_cast(`{name}` as {target})")
    return (
        F.when(_is_text(name), _from_text(to_text(name, T.VariantType()), target))
        .when(F.schema_of_variant(name) == "BIGINT", F.coalesce(
            whole, F.expr(_FROM_FLOATING[target].format(double))))
        .otherwise(F.expr(_FROM_FLOATING[target].format(double)))
    )


def to_integral(name: str, source: T.DataType, target: str = "int") -> Column:
    """Cast the named column, of type ``source``, to ``int`` or ``bigint``."""
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return F.expr(_FROM_FLOATING[target].format(f"`{name}`"))
    if isinstance(source, T.VariantType):
        return _from_variant(name, target)
    if isinstance(source, T.StringType):
        return _from_text(F.col(name), target)
    if isinstance(source, T.LongType) and target == "int":
        # Keep the low 32 bits, sign-extended.
        return F.expr(f"cast(shiftright(shiftleft(`{name}`, 32), 32) as int)")
    return F.expr(f"try_cast(`{name}` as {target})")


def to_float(name: str) -> Column:
    """Cast to a 32-bit float; unreadable text gives null."""
    return F.expr(f"try_cast(`{name}` as float)")


def to_date(name: str, fmt: str, source: T.DataType | None = None) -> Column:
    """Parse a date; text that does not fit the format gives null."""
    return F.try_to_date(to_text(name, source or T.StringType()), fmt)
