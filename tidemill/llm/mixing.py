"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1]: straight lines between knots. Its integral is
the source's cumulative token demand; the mix takes the words of a source in a fixed shuffled order, again from the
start where they run out, and a document's training position is the time at which the demand reaches it: the
inverse of the integral. Documents are then sorted by range of position.

Targets: weights share all words; a target stops at ``most_repeats`` times its source's words and the excess is
shared again by weight, which ends at a water level: target = min(most_repeats * size, level * weight).

Running sums never gather a source in one task: the order within a source is the MD5 of the id, its leading hex
digits are buckets of a bounded number of rows, sums of buckets give offsets, and windows run within buckets only.
The table of sources (one row each) is the only thing ordered as a whole. Words are counted in the JVM.

Defined cases: a null text has size 0; a null source is a source of its own, the last; an empty table gives an
empty result; rows without an id are ordered by the MD5 of their text; rows with one id by size and then text; repeated
rows each count; sources without words get target 0; rows of which nothing is taken have no position and come first.
A document that the mix takes only in part is the last one of its source's final round.
"""

from __future__ import annotations

import math
import re
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import common

#: Knots (time, factor on the weight) by place of the source, repeating; each has mean 1: falling, level, rising.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
WEIGHTS = (5, 2, 1)
WORD = re.compile("[^\x20\x09-\x0d]+")


def integral(schedule: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float]]:
    """(time, factor, slope, demand so far) at the start of each piece, with demand scaled to end at 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))
    out, so_far = [], 0.0
    for a, b in zip(schedule, schedule[1:]):
        out.append((a[0], a[1] / area, (b[1] - a[1]) / (b[0] - a[0]) / area, so_far))
        so_far += (b[0] - a[0]) * (a[1] + b[1]) / 2 / area
    return out


def position(share: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a source's cumulative demand reaches ``share`` of its target."""
    out = None
    for t, factor, slope, so_far in integral(schedule):
        left = share - F.lit(so_far)
        # the root of the quadratic that has no difference of large numbers; at the start of a piece from weight 0 it is 0
        at = F.lit(t) + (left / factor if slope == 0 else F.coalesce(F.try_divide(2 * left, factor + F.sqrt(F.greatest(F.lit(factor * factor) + 2 * slope * left, F.lit(0.0)))), F.lit(0.0)))
        out = at if out is None else F.when(share >= so_far, at).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3) -> DataFrame:
    """(source, source_size, place, target) from (source, source_size)."""
    by_code_point = W.orderBy(F.col("source").isNull(), F.col("source"))
    table = F.array(*[F.lit(w) for w in weights])
    placed = sources.withColumn("place", F.row_number().over(by_code_point) - 1).withColumn("weight", F.element_at(table, (F.col("place") % len(weights) + 1).cast("int")))
    cap = most_repeats * F.col("source_size")
    filling = W.orderBy((cap / F.col("weight")), "place")
    upto, everything = filling.rowsBetween(W.unboundedPreceding, 0), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = placed.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    level = level.withColumn("heavy", F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"))
    # sources are full from the left up to the first one that the level of all from it on leaves below its cap
    level = level.withColumn("level", F.col("left") / F.col("heavy")).withColumn("below", F.col("level") * F.col("weight") <= cap)
    first = F.min(F.when(F.col("below"), F.struct(cap / F.col("weight"), "place", "level"))).over(everything)
    level = level.withColumn("first", first)
    full = F.col("first").isNull() | (F.struct(cap / F.col("weight"), F.col("place")) < F.struct(F.col("first.col1"), F.col("first.place")))
    return level.select("source", "source_size", "place", F.when(full, cap.cast("double")).otherwise(F.col("first.level") * F.col("weight")).alias("target"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most_repeats: int = 3, bucket_rows: int = 4000, extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, source, size, source_size, target, rounds, taken, position, *extra) for every row.

    ``rounds`` full copies are taken and, if ``taken`` > rounds * size, the first taken - rounds * size words once more.
    ``position`` is the training time of the first copy; null if nothing is taken.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text|"), F.md5(text))))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(common.WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), order.alias("order"), F.xxhash64(text).alias("tie"), *extra)
    if not extra:
        # without texts the rows are few bytes: words are counted once
        sized = materialize(sized, "mix-sizes")
    digits = max(0, math.ceil(math.log(max(1, sized.count() / bucket_rows), 16)))
    sized = sized.withColumn("bucket", F.substring("order", 1, digits) if digits else F.lit(""))
    buckets = materialize(sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    running = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    held = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, most_repeats)
    offsets = buckets.withColumn("before", F.coalesce(F.sum("bucket_size").over(running), F.lit(0)))
    offsets = materialize(offsets.join(held, offsets["source"].eqNullSafe(held["source"])).select(offsets["source"], "bucket", "before", "source_size", "place", "target"), "mix-offsets")
    within = W.partitionBy(sized["source"], sized["bucket"]).orderBy("order", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, placed["source"].eqNullSafe(offsets["source"]) & (placed["bucket"] == offsets["bucket"])).drop(offsets["source"], offsets["bucket"])
    start = F.col("before") + F.col("inside")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    placed = placed.withColumn("start", start).withColumn("rounds", rounds)
    rest = F.round(F.col("target") - F.col("rounds") * F.col("source_size")).cast("long")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start")))
    placed = placed.withColumn("taken", F.col("rounds") * F.col("size") + last)
    share = F.try_divide(F.col("start"), F.col("target"))
    at = None
    for i, schedule in enumerate(SCHEDULES):
        here = position(share, schedule)
        at = here if at is None else F.when(F.col("place") % len(SCHEDULES) == i, here).otherwise(at)
    return placed.select("id", "source", "size", "source_size", "target", "rounds", "taken", F.when(F.col("taken") > 0, at).alias("position"), *extra)


@F.pandas_udf(T.StringType())
def first_words(text: pd.Series, words: pd.Series) -> pd.Series:
    """Each text up to its n-th word; null stays null."""

    def head(t: str, n: int) -> str:
        last = next(islice(WORD.finditer(t), n - 1, None), None) if n > 0 else None
        return t[: last.end()] if last else t if n > 0 else ""

    return pd.Series([None if t is None else head(t, n) for t, n in zip(text, words)], dtype=object)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows that the mix takes, as often as it takes them, in ranges of training position."""
    boxed = docs.select(F.col(id_col), F.col(text_col), F.col(source_col), F.struct(*docs.columns).alias("row_of_doc"))
    taken = plan(boxed, id_col, text_col, source_col, extra=("row_of_doc",), **how).where("taken > 0")

    rest = F.col("taken") - F.col("rounds") * F.col("size")
    copies = F.col("rounds").cast("int") + F.when(rest > 0, 1).otherwise(0)
    each = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    text = F.col("row_of_doc")[text_col]
    part = (F.col("copy") > F.col("rounds")) & (rest < F.col("size"))
    each = each.withColumn("cut", F.when(part, first_words(F.when(part, text), rest)).otherwise(text))
    # later copies follow a whole round of the source later
    each = each.withColumn("at", F.col("position") + (F.col("copy") - 1) * F.col("source_size") / F.col("target"))
    return each.repartitionByRange(F.col("at"), F.col("id")).sortWithinPartitions("at", "id").select(*[F.col("cut").alias(c) if c == text_col else F.col("row_of_doc")[c].alias(c) for c in docs.columns])


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it, in ranges of training position."""
    mixed = plan(common.table(spark, sf_dir, "documents"))
    found = mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "position")
    return found.repartitionByRange(F.col("position"), F.col("doc_id")).sortWithinPartitions("position", "doc_id")


OP4_SQL = """
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, 'text|' || md5(coalesce(text, '')))) as ord
  from documents
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), placed as (
  select *, row_number() over (order by source is null, source) - 1 as place from sources
), weighed as (
  select *, [5, 2, 1][(place % 3) + 1] as weight, 3 * source_size as cap from placed
), levels as (
  select *, ((sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0))::double
      / (sum(weight) over () - sum(weight) over (order by cap / weight, place rows between unbounded preceding and current row) + weight)::double) as level
  from weighed
), firsts as (
  select min({'a': cap / weight, 'b': place, 'c': level}) as f from levels where level * weight <= cap
), targets as (
  select source, source_size, place, case when f is null or {'a': cap / weight, 'b': place} < {'a': f.a, 'b': f.b} then cap::double else f.c * weight end as target
  from levels cross join firsts
), started as (
  select *, coalesce(sum(size) over (partition by source order by ord, size rows between unbounded preceding and 1 preceding), 0)::bigint as start from sized
), counted as (
  select s.*, t.source_size, t.target, t.place, case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as rounds
  from started s join targets t on s.source is not distinct from t.source
), mixed as (
  select *, rounds * size + greatest(0, least(size, round(target - rounds * source_size)::bigint - start)) as taken, start / target as share from counted
)
select doc_id, size, source_size, target, taken::bigint as taken,
  case when taken > 0 then least(greatest(case place % 3
    when 0 then 0.0::double + 2 * (share - 0.0::double) / (1.5::double + sqrt(greatest(2.25::double + 2 * -1.0::double * (share - 0.0::double), 0.0::double)))
    when 1 then 0.0::double + (share - 0.0::double) / 1.0::double
    else 0.0::double + 2 * (share - 0.0::double) / (0.5::double + sqrt(greatest(0.25::double + 2 * 1.0::double * (share - 0.0::double), 0.0::double))) end, 0.0::double), 1.0::double) end as position
from mixed
"""
