"""Column and table statistics as aggregations with partial combining; nothing is sampled or kept per value.

Melted input: (file, column, value), see ``typing.melt``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Quirks of values (fixed patterns). (?d) makes . stop at \n only; \z is the end; white space is \t \n \f \r and blank.
QUIRKS = {
    "newline": "[\\r\\n]",
    "double_quoted": '(?d)^".*"\\z',
    "quote_doubling": '""',
    "backslash_escape": '\\\\["\\\\nrt]',
    "surrounding_whitespace": "^[\\t\\n\\f\\r ]|[\\t\\n\\f\\r ]\\z",
    "leading_zeros": "^-?0\\d",
    "thousands_separator": "^-?\\d{1,3}(,\\d{3})+(\\.\\d+)?\\z",
    "non_ascii": "[^\\x00-\\x7F]",
}
#: Texts that mostly mean that there is no value (fixed values).
NULL_LIKE = ("-", "--", ".", "n.a.", "N.A.", "none", "None", "NONE", "#N/A", "N/A", "NA", "null", "NULL", "nan", "NaN")
BINS = 10
#: Lengths are counted exactly up to this many different ones.
EXACT_LENGTHS = 20


def counts(melted: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, rows, nulls, null_ratio, files)."""
    got = melted.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"), F.count_distinct("file").alias("files"))
    return got.withColumn("null_ratio", F.round(F.col("nulls") / F.col("rows"), 4))


def finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


def numeric(values: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, min, max, zeros, negatives) over the finite doubles ``number``."""
    x = F.col("number")
    return values.where(finite(x)).groupBy(*by).agg(F.min(x).alias("min"), F.max(x).alias("max"), F.count_if(x == 0).alias("zeros"), F.count_if(x < 0).alias("negatives"))


def histogram(values: DataFrame, bounds: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, bin, n): equal-width bins between min and max, the last one closed; one value gets half a unit on either side.

    ``bounds`` (*by, min, max) has a row for each column.
    """
    one = F.col("min") == F.col("max")
    low, high = F.when(one, F.col("min") - 0.5).otherwise(F.col("min")), F.when(one, F.col("max") + 0.5).otherwise(F.col("max"))
    joined = values.where(finite(F.col("number"))).join(F.broadcast(bounds), list(by))
    place = F.least(F.floor((F.col("number") - low) / ((high - low) / BINS)), F.lit(BINS - 1)).cast("int")
    return joined.withColumn("bin", place).groupBy(*by, "bin").agg(F.count("*").alias("n"))


def edges(low: float, high: float) -> list[float]:
    if low == high:
        low, high = low - 0.5, high + 0.5
    return [round(low + (high - low) * i / BINS, 6) for i in range(BINS)] + [round(high, 6)]


def fraction_digits(at: Column) -> Column:
    micros = F.unix_micros(at.cast("timestamp"))
    return F.when(F.pmod(micros, F.lit(1000)) != 0, 6).when(F.pmod(micros, F.lit(1_000_000)) != 0, 3).otherwise(0)


def temporal(values: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, min, max, fraction_digits, all_midnight) over the timestamps ``at``."""
    at = F.col("at")
    return values.where(at.isNotNull()).groupBy(*by).agg(F.min(at).alias("min"), F.max(at).alias("max"), F.max(fraction_digits(at)).alias("fraction_digits"), F.bool_and(at == F.date_trunc("day", at)).alias("all_midnight"))


def text(melted: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, min_len, max_len, max_bytes, empty, fixed_length, varied, <quirks>)."""
    v = F.col("value")
    n = F.char_length(v)
    got = melted.where(v.isNotNull()).groupBy(*by).agg(
        F.min(n).alias("min_len"),
        F.max(n).alias("max_len"),
        F.max(F.octet_length(v)).alias("max_bytes"),
        F.count_if(n == 0).alias("empty"),
        (F.min(v) != F.max(v)).alias("varied"),
        *[F.count_if(v.rlike(p)).alias(q) for q, p in QUIRKS.items()],
    )
    return got.withColumn("fixed_length", F.col("min_len") == F.col("max_len"))


def lengths(melted: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, length, n)."""
    return melted.where(F.col("value").isNotNull()).groupBy(*by, F.char_length("value").alias("length")).agg(F.count("*").alias("n"))


def length_histogram(counted: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, low, n): each length where there are few, else the lower edges of equal bins. Works on the counts of lengths."""
    whole = W.partitionBy(*by)
    sized = counted.withColumns({"_kinds": F.count("*").over(whole), "_min": F.min("length").over(whole), "_max": F.max("length").over(whole)})
    width = (F.col("_max") - F.col("_min")) / BINS
    place = F.least(F.floor((F.col("length") - F.col("_min")) / width), F.lit(BINS - 1))
    low = F.when(F.col("_kinds") <= EXACT_LENGTHS, F.col("length")).otherwise(F.floor(F.col("_min") + place * width).cast("int"))
    return sized.groupBy(*by, low.alias("low")).agg(F.sum("n").alias("n"))


def null_like(melted: DataFrame, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, value, n) of texts that mostly mean nothing."""
    return melted.where(F.col("value").isin(*NULL_LIKE)).groupBy(*by, "value").agg(F.count("*").alias("n"))


def categorical(melted: DataFrame, most: int = 50, by: tuple[str, ...] = ("column",)) -> DataFrame:
    """(*by, value, n) of the columns with at most ``most`` different values."""
    counted = melted.where(F.col("value").isNotNull()).groupBy(*by, "value").agg(F.count("*").alias("n"))
    # counted per column with partial sums: no window over all values of a column
    few = counted.groupBy(*by).agg(F.count("*").alias("_kinds")).where(F.col("_kinds") <= most)
    return counted.join(F.broadcast(few.drop("_kinds")), list(by), "left_semi")


def rows_per_file(rows: DataFrame, file: str = "file") -> DataFrame:
    return rows.groupBy(file).agg(F.count("*").alias("n_rows"))


def volume(per_file: DataFrame) -> DataFrame:
    """(business_date, n_files, n_rows) from (business_date, n_rows) of files."""
    return per_file.groupBy("business_date").agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"))


def spread(values: DataFrame, column: str) -> DataFrame:
    """One row (min, max, mean, n)."""
    return values.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.round(F.avg(column), 2).alias("mean"), F.count(column).alias("n"))


def file_key_metadata(files: DataFrame) -> DataFrame:
    """(name) of the attributes that differ between files (business_date, attributes map) of one date; a missing one counts as a value."""
    dated = files.withColumn("_n", F.count("*").over(W.partitionBy("business_date"))).where("_n > 1")
    names = dated.select(F.explode(F.map_keys("attributes")).alias("name")).distinct()
    each = dated.select("business_date", "attributes").join(F.broadcast(names))
    value = F.coalesce(F.concat(F.lit("="), F.try_element_at("attributes", F.col("name"))), F.lit(""))
    return each.groupBy("business_date", "name").agg(F.count_distinct(value).alias("n")).where("n > 1").select("name").distinct()
