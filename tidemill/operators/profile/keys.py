"""Keys: column sets that are unique in every file, how their values recur, and what changes from file to file.

``values``: (key_set, file_no, key, n), the distinct values of each set in each file with their counts. The set of
files of a value is never gathered; what is needed are counts, and the neighbour file by a shifted join.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Between the parts of a composite value (fixed value).
SEPARATOR = "\x1f"


def joined(columns: tuple[str, ...]):
    """The value of a column set as text; null if any part is."""
    parts = []
    for i, c in enumerate(columns):
        parts += ([F.lit(SEPARATOR)] if i else []) + [F.col(f"`{c}`").cast("string")]
    return F.concat(*parts)


def values(df: DataFrame, sets: list[tuple[str, ...]], file_no: str) -> DataFrame:
    """(key_set, file_no, key, n) for all sets in one pass; nulls have a row of their own."""
    each = F.array(*[F.struct(F.lit("+".join(s)).alias("key_set"), joined(s).alias("key")) for s in sets])
    rows = df.select(F.col(file_no).alias("file_no"), F.explode(each).alias("x")).select("x.key_set", "file_no", "x.key")
    return rows.groupBy("key_set", "file_no", "key").agg(F.count("*").alias("n"))


def per_file(held: DataFrame) -> DataFrame:
    """(key_set, file_no, rows, nulls, keys, is_unique): unique if every row has a value of its own."""
    got = held.groupBy("key_set", "file_no").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.count("key").alias("keys"))
    return got.withColumn("is_unique", F.col("keys") == F.col("rows"))


def alive(files: DataFrame) -> DataFrame:
    """``per_file`` with ``alive``: unique in this file and in all before it."""
    return files.withColumn("alive", F.bool_and("is_unique").over(W.partitionBy("key_set").orderBy("file_no")))


def churn(held: DataFrame, files: DataFrame) -> DataFrame:
    """(key_set, file_no, keys, n_new, n_dropped) while a set is alive; null against no file before."""
    ids = held.where(F.col("key").isNotNull()).select("key_set", "file_no", "key")
    # every value meets itself in the next file: what meets nothing is new there, or dropped from here
    before = ids.select("key_set", (F.col("file_no") + 1).alias("file_no"), "key", F.lit(True).alias("was"))
    both = ids.withColumn("is", F.lit(True)).join(before, ["key_set", "file_no", "key"], "full")
    sums = both.groupBy("key_set", "file_no").agg(F.count_if(F.col("was").isNull()).alias("new"), F.count_if(F.col("is").isNull()).alias("dropped"))
    first = F.min("file_no").over(W.partitionBy("key_set"))
    got = alive(files).withColumn("first", first).where("alive").join(sums, ["key_set", "file_no"], "left")
    later = F.col("file_no") > F.col("first")
    return got.select("key_set", "file_no", "keys", F.when(later, F.coalesce("new", F.lit(0))).alias("n_new"), F.when(later, F.coalesce("dropped", F.lit(0))).alias("n_dropped"))


def recurrence(held: DataFrame, n_files: int, distinct_max: int | None = None) -> DataFrame:
    """(key_set, n_distinct, n_recurring, repeat_ratio); null counts above ``distinct_max`` if it is given, and no ratio of one file."""
    each = held.where(F.col("key").isNotNull()).groupBy("key_set", "key").agg(F.count("*").alias("n_files"))
    sums = each.groupBy("key_set").agg(F.count("*").alias("d"), F.count_if(F.col("n_files") > 1).alias("r"))
    known = F.lit(True) if distinct_max is None else F.col("d") <= distinct_max
    ratio = F.when(known & (F.col("d") > 0) & F.lit(n_files >= 2), F.round(F.col("r") / F.col("d"), 4))
    return sums.select("key_set", F.when(known, F.col("d")).alias("n_distinct"), F.when(known, F.col("r")).alias("n_recurring"), ratio.alias("repeat_ratio"))


def composite_candidates(first_file: DataFrame, singles: list[tuple[str, int | None]], key_columns_max: int = 12, key_sets_max: int = 20) -> list[tuple[str, ...]]:
    """Pairs, or else triples, that are unique in the first file, of the columns with most different values.

    ``singles``: keyable columns without nulls that aren't unique alone, with their numbers of values. One aggregation
    estimates all combinations of a size, within 2 %; those that come near the number of rows are counted exactly.
    """
    top = [c for c, _ in sorted(singles, key=lambda s: (-(s[1] if s[1] is not None else float("inf")), s[0]))][:key_columns_max]
    for size in (2, 3):
        sets = list(combinations(top, size))
        if not sets:
            continue
        near = first_file.agg(F.count("*").alias("rows"), *[F.approx_count_distinct(joined(s), 0.02).alias(f"s{i}") for i, s in enumerate(sets)]).first()
        # five times the deviation of the estimate: no key is missed
        likely = [s for i, s in enumerate(sets) if near[f"s{i}"] >= 0.9 * near["rows"]]
        if not likely:
            continue
        row = first_file.agg(*[F.count_distinct(joined(s)).alias(f"s{i}") for i, s in enumerate(likely)]).first()
        if found := [s for i, s in enumerate(likely) if row[f"s{i}"] == near["rows"]]:
            return found[:key_sets_max]
    return []


def candidates(files: DataFrame, recurring: DataFrame, n_files: int) -> DataFrame:
    """(key_set, repeat_ratio, unique_overall) of the sets that are unique in every file, likeliest business key first."""
    whole = files.groupBy("key_set").agg(F.bool_and("is_unique").alias("ok"), F.count("*").alias("n")).where(F.col("ok") & (F.col("n") == n_files))
    got = whole.join(recurring, "key_set").select("key_set", "repeat_ratio", (F.col("n_recurring") == 0).alias("unique_overall"))
    return got.orderBy(F.coalesce("repeat_ratio", F.lit(0.0)).desc(), F.size(F.split("key_set", "\\+")), "key_set")


def candidate_columns(files: DataFrame, recurring: DataFrame, n_files: int) -> DataFrame:
    """(column, n_distinct) without nulls and present in every file, most values first."""
    whole = files.groupBy("key_set").agg(F.sum("nulls").alias("nulls"), F.count("*").alias("n")).where((F.col("nulls") == 0) & (F.col("n") == n_files))
    return whole.join(recurring, "key_set").select(F.col("key_set").alias("column"), "n_distinct").orderBy(F.col("n_distinct").desc_nulls_first(), "column")
