"""Column expressions the operators are built from. All of them stay in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long")
_FRACTIONAL = ("float", "real", "double", "decimal", "dec", "numeric")

# The texts Spark's cast reads as booleans, in any case.
_TRUE_TEXTS = ["t", "true", "y", "yes", "1"]
_FALSE_TEXTS = ["f", "false", "n", "no", "0"]


def named(name: str) -> Column:
    """Top-level column by its exact name, even if the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def resolved(schema: T.StructType, name: str) -> Column:
    """A top-level column by its exact name, else whatever Spark takes the name for, such
    as a field of a struct."""
    return named(name) if name in schema.names else F.col(name)


def string_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def lenient_cast(column: Column, source: T.DataType, target: str) -> Column:
    """Cast that yields NULL on bad input, whatever the session's ANSI setting.

    A decimal string bound for an integer type is cut at its point, as the non-ANSI cast
    does and ``try_cast`` does not. Numbers out of the target's range give NULL instead
    of wrapping around. Text that cannot be a number is set aside before the cast:
    ``try_cast`` raises and catches an exception for each, which is slow in bulk.
    """
    kind = target.strip().lower()
    if isinstance(source, T.DateType) and (
        kind in _INTEGRAL or kind == "boolean" or kind.startswith(_FRACTIONAL)
    ):
        return F.lit(None).cast(target)
    if not isinstance(source, T.StringType):
        return column.try_cast(target)
    if kind in _INTEGRAL:
        # Nothing before the point is zero or no number; only then a second pattern is tried.
        whole = F.regexp_extract(column, r"^\s*([+-]?\d*)(?:\.\d*)?\s*$", 1)
        fraction = column.rlike(r"^\s*[+-]?\.\d*\s*$")
        return F.when(
            whole.isin("", "+", "-"), F.when(fraction, F.lit(0).cast(target))
        ).otherwise(whole.try_cast(target))
    if kind == "boolean":
        text = F.lower(F.trim(column))
        return F.when(text.isin(_TRUE_TEXTS), True).when(text.isin(_FALSE_TEXTS), False)
    if kind.startswith(_FRACTIONAL):
        return F.when(column.rlike("(?i)[0-9]|nan|inf"), column.try_cast(target))
    return column.try_cast(target)


def trimmed(column: Column, whitespace: str) -> Column:
    """``spaces`` strips U+0020 only; ``all`` strips tabs and line ends as well."""
    if whitespace == "all":
        return F.regexp_replace(column, r"^\s+|\s+$", "")
    return F.trim(column)


def salted_sha256(column: Column, salt: str) -> Column:
    """Hex digest of value and salt; NULL stays NULL."""
    return F.sha2(F.concat(column.cast("string"), F.lit(salt)), 256)
