"""The type of text columns, from flags that hold for every value of a file.

Columns are melted to rows (file, column, value) once; they are aggregated by file, column and shape, shapes by file and
column, and a CASE reads the flags in the order of the rules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import paths

#: Java: ``\\z`` is the end; ``$`` would let a final line break pass.
INTEGER = "^-?\\d+\\z"
LEADING_ZEROS = "^-?0\\d"
NUMBER = "^-?\\d+(\\.\\d+)?\\z"
THOUSANDS = "^-?\\d{1,3}(,\\d{3})+(\\.\\d+)?\\z"
FLOAT = "^[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\z"
DATE = "^\\d{4}-\\d{2}-\\d{2}\\z"
#: ISO 8601 as loaders take it: a date alone, or with hours, minutes and so on.
TIMESTAMP = "^\\d{4}-\\d{2}-\\d{2}([ T]\\d{2}(:?\\d{2}(:?\\d{2}(\\.\\d{1,9})?)?)?(Z|[+-]\\d{2}(:?\\d{2})?)?)?\\z"
ZONE = "(Z|[+-]\\d{2}:?\\d{2})\\z"

NUMERIC, TEMPORAL = ("bigint", "double", "decimal"), ("date", "timestamp")
KEYABLE = ("bigint", "text", "date", "timestamp", "bool")


@dataclass(frozen=True)
class Options:
    """Knobs of a profile; see the README."""

    max_rows: int | None = None
    decimals: bool = False
    narrow: bool = False
    strict_nulls: bool = False
    text_headroom: float = 1.5
    int_headroom: float = 10.0
    decimal_headroom: int = 2
    date_formats: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    categorical_max: int = 50
    distinct_max: int = 1_000_000
    composite_keys: bool = True
    key_columns_max: int = 12
    key_sets_max: int = 20
    key_repeat_threshold: float = 0.5


def melt(df: DataFrame, columns: list[str], file: str = "_file") -> DataFrame:
    """(file, column, value) with one row for each value, nulls included."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.col(file).alias("file"), F.explode(pairs).alias("x")).select("file", "x.column", "x.value")


def as_timestamp(value: Column) -> Column:
    """Null unless the text is ISO 8601; compact times get their colons, as casts want them."""
    text = F.regexp_replace(value, "T", " ")
    text = F.regexp_replace(text, "^(\\S+ \\d{2})(?=Z|[+-]|\\z)", "$1:00")
    text = F.regexp_replace(text, "^(\\S+ \\d{2}):?(\\d{2}):?(\\d{2})", "$1:$2:$3")
    text = F.regexp_replace(text, "([+-]\\d{2})(\\d{2})\\z", "$1:$2")
    return F.when(value.rlike(TIMESTAMP), text.try_cast("timestamp"))


def format_fits(value: Column, fmt: str) -> tuple[Column, Column]:
    """Whether a value has the format, and whether it is at midnight then."""
    at = F.try_to_timestamp(value, F.lit(paths.spark_format(fmt)))
    return at.isNotNull(), at == F.date_trunc("day", at)


def shape(value: Column) -> Column:
    """The text with every digit as 9. What is too long for a number, date or time gets one shape a kind."""
    digits = "9" * 39
    long = F.when(value.rlike(INTEGER), digits).when(value.rlike(NUMBER), f"{digits}.9").when(value.rlike(THOUSANDS), "9,999").when(value.rlike(FLOAT), "9e9").otherwise("long text")
    return F.when(F.length(value) <= 64, F.translate(value, "012345678", "999999999")).otherwise(F.when(value.isNotNull(), long))


def infer(melted: DataFrame, formats: tuple[str, ...] = (), by: tuple[str, ...] = ("file", "column"), sums: dict[str, tuple[Column, Callable[[str], Column]]] | None = None) -> DataFrame:
    """(*by, kind, reason, format, int_digits, frac_digits, zoned, *sums): the kind that fits every value that isn't null.

    No values: no kind (the row has a null kind). In order: given date formats, integers (text with leading zeros or
    beyond 64 bits), decimals, thousands separators (text), floats, true/false, dates, timestamps, text.

    Values are grouped by shape first: there are few shapes, so patterns are matched a few times and not on every
    value, and the code that runs for each value stays small enough to be compiled. ``sums`` are further aggregates:
    one for a shape, and what combines it over the shapes.
    """
    value, form = F.col("value"), F.col("shape")
    timed = form.rlike("^9999-99-99")
    flags = {
        "has_zeros": F.bool_or(value.rlike(LEADING_ZEROS)),
        "too_long": F.bool_or(F.when(F.length(value) >= 19, F.expr("try_cast(value as bigint)").isNull()).otherwise(False)),
        "is_time": F.bool_and(F.when(timed, F.when(F.length(value) == 10, F.expr("try_cast(value as date)").isNotNull()).otherwise(as_timestamp(value).isNotNull())).otherwise(False)),
    }
    for i, f in enumerate(formats):
        fits, midnight = format_fits(value, f)
        flags |= {f"fits_{i}": F.bool_and(fits), f"midnight_{i}": F.bool_and(midnight)}
    more = sums or {}
    shaped = melted.withColumn("shape", shape(value)).groupBy(*by, "shape").agg(*[c.alias(n) for n, c in flags.items()], *[c.alias(f"_{n}") for n, (c, _) in more.items()])
    every = {
        "is_int": form.rlike(INTEGER),
        "is_number": form.rlike(NUMBER),
        "is_thousands": form.rlike(THOUSANDS),
        "is_float": form.rlike(FLOAT),
        "is_bool": F.lower(form).isin("true", "false"),
        "is_date": form.rlike(DATE) & F.col("is_time"),
        "is_timestamp": form.rlike(TIMESTAMP) & F.col("is_time"),
        "is_zoned": form.rlike(ZONE),
        "fits_long": ~F.col("too_long"),
        **{c: F.col(c) for i in range(len(formats)) for c in (f"fits_{i}", f"midnight_{i}")},
    }
    some = {"has_zeros": F.col("has_zeros"), "any_zoned": form.rlike(ZONE) & form.rlike("[ T]")}
    most = {"int_part": F.length(F.regexp_extract(form, "^-?(\\d+)", 1)), "frac_part": F.length(F.regexp_extract(form, "\\.(\\d+)\\z", 1))}
    present = form.isNotNull()
    got = shaped.groupBy(*by).agg(
        F.count("shape").alias("n_shapes"),
        *[F.bool_and(F.when(present, c)).alias(n) for n, c in every.items()],
        *[F.bool_or(F.when(present, c)).alias(n) for n, c in some.items()],
        *[F.max(c).alias(n) for n, c in most.items()],
        *[combine(f"_{n}").alias(n) for n, (_, combine) in more.items()],
    )
    kind, reason, fmt = F.when(F.lit(False), ""), F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for i, f in enumerate(formats):
        kind = kind.when(F.col(f"fits_{i}") & F.col(f"midnight_{i}"), "date").when(F.col(f"fits_{i}"), "timestamp")
        reason, fmt = reason.when(F.col(f"fits_{i}"), F.lit(None)), fmt.when(F.col(f"fits_{i}"), f)
    kind = kind.when(F.col("is_int"), F.when(F.col("has_zeros") | ~F.col("fits_long"), "text").otherwise("bigint"))
    reason = reason.when(F.col("is_int"), F.when(F.col("has_zeros"), "leading zeros").when(~F.col("fits_long"), "integers beyond 64 bit"))
    kind = kind.when(F.col("is_number"), "decimal").when(F.col("is_thousands"), "text").when(F.col("is_float"), "double").when(F.col("is_bool"), "bool").when(F.col("is_date"), "date").when(F.col("is_timestamp"), "timestamp").otherwise("text")
    reason = reason.when(F.col("is_number"), F.lit(None)).when(F.col("is_thousands"), "thousands separators")
    some_value = F.col("n_shapes") > 0
    out = got.select(*by, F.when(some_value, kind).alias("kind"), F.when(some_value, reason).alias("reason"), F.when(some_value, fmt).alias("format"), "int_part", "frac_part", "is_zoned", "any_zoned", *more)
    decimal = F.col("kind") == "decimal"
    zoned = F.when(F.col("kind") == "timestamp", F.when(F.col("format").isNotNull(), False).otherwise(F.col("is_zoned") | F.col("any_zoned")))
    return out.select(*by, "kind", "reason", "format", F.when(decimal, F.col("int_part")).otherwise(0).alias("int_digits"), F.when(decimal, F.col("frac_part")).otherwise(0).alias("frac_digits"), zoned.alias("zoned"), *more)
