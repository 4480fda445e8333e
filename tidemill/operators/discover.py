"""What a listing of a remote suggests: subsets, path patterns, cadence, lag, schedule and exclusions.

``files``: (path, mtime timestamp or null, size), metadata only. Groups of files are aggregated by Spark; what comes
to the driver is a row for each path pattern.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import paths

#: Date shapes in order of preference: format, regex, regex as it is put into a suggested pattern (fixed values).
SHAPES = (("%Y-%m-%d", "\\d{4}-\\d{2}-\\d{2}", "\\d{4}\\-\\d{2}\\-\\d{2}"), ("%Y%m%d", "\\d{8}", "\\d{8}"), ("%Y%m", "\\d{6}", "\\d{6}"), ("%Y", "\\d{4}", "\\d{4}"))
#: Files that make evidence.
ENOUGH = 3


@dataclass(frozen=True)
class PatternSuggestion:
    subset: str
    pattern: str
    date_format: str
    examples: tuple[str, ...]
    cadence: str | None
    weekdays: tuple[int, ...]
    lag_days: tuple[int, int] | None
    files_per_date: tuple[int, int]


@dataclass(frozen=True)
class DiscoveryReport:
    root: str
    files: int
    subsets: dict[str, str]
    maxdepth: int
    cron: str | None
    exclude_candidates: tuple[str, ...]
    patterns: tuple[PatternSuggestion, ...]
    caveats: tuple[str, ...]

    def to_dict(self) -> dict:
        return asdict(self)


def quoted(text: Column) -> Column:
    """The text as a regex, as re.escape gives it."""
    return F.regexp_replace(text, "([\\\\.^$*+?{}\\[\\]|()\\-#&~ \\t\\n\\r\\x0B\\f])", "\\\\$1")


def shaped(files: DataFrame, root: str) -> DataFrame:
    """Files with subset, name, and the first date shape in the name: date_text, date_format, prefix, suffix, pattern, business_date."""
    root = root.rstrip("/")
    rel = F.when(F.col("path").startswith(F.lit(f"{root}/")), F.substring(F.col("path"), F.lit(len(root) + 2), F.length("path"))).otherwise(F.col("path"))
    out = files.withColumn("rel", rel).withColumn("name", paths.basename(F.col("rel")))
    out = out.withColumn("subset", F.when(F.instr("rel", "/") > 0, paths.first_part(F.col("rel"))))
    text, fmt, dated, parsed = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("date")
    for f, regex, inside in reversed(SHAPES):
        here = F.col("name").rlike(regex)
        value = F.regexp_extract("name", f"({regex})", 1)
        text = F.when(here, value).otherwise(text)
        fmt = F.when(here, F.lit(f)).otherwise(fmt)
        dated = F.when(here, F.lit(inside)).otherwise(dated)
        parsed = F.when(here, F.try_to_date(value, paths.spark_format(f))).otherwise(parsed)
    out = out.withColumns({"date_text": text, "date_format": fmt, "inside": dated, "business_date": parsed})
    at = F.expr("locate(date_text, name)")
    out = out.withColumn("prefix", F.expr("substring(name, 1, locate(date_text, name) - 1)")).withColumn("suffix", F.substring(F.col("name"), at + F.length("date_text"), F.length("name")))
    folder = F.regexp_replace(F.regexp_extract("rel", "^[^/]*/(.*)$", 1), "(^|/)[^/]*$", "")
    where = F.concat(quoted(F.col("subset")), F.when(folder == "", "/").otherwise(F.concat(F.lit("/"), quoted(folder), F.lit("/"))))
    pattern = F.concat(F.lit("^"), where, quoted(F.col("prefix")), F.lit("(?P<date>"), F.col("inside"), F.lit(")"), quoted(F.col("suffix")), F.lit("$"))
    return out.withColumn("pattern", F.when(F.col("subset").isNotNull() & F.col("business_date").isNotNull(), pattern)).drop("inside")


GROUP = ("subset", "pattern", "date_format")


def cadences(dated: DataFrame) -> DataFrame:
    """(subset, pattern, date_format, cadence) from the gaps between different dates; null if they tell nothing."""
    days = dated.select(*GROUP, "business_date").distinct()
    gap = F.datediff("business_date", F.lag("business_date").over(W.partitionBy(*GROUP).orderBy("business_date")))
    sums = days.withColumn("gap", gap).groupBy(*GROUP).agg(F.count("*").alias("n"), F.min("gap").alias("least"), F.max("gap").alias("most"))
    cadence = F.when(F.col("n") < ENOUGH, F.lit(None)).when(F.col("most") <= 3, "daily").when((F.col("least") >= 6) & (F.col("most") <= 8), "weekly").when((F.col("least") >= 27) & (F.col("most") <= 32), "monthly")
    return sums.select(*GROUP, cadence.alias("cadence"))


def groups(dated: DataFrame) -> DataFrame:
    """A row for each pattern: files, examples, weekdays, lags, files per date, minutes of arrival."""
    nth = F.row_number().over(W.partitionBy(*GROUP).orderBy("path"))
    per_day = dated.groupBy(*GROUP, "business_date").agg(F.count("*").alias("n")).groupBy(*GROUP).agg(F.min("n").alias("least_files"), F.max("n").alias("most_files"), F.sort_array(F.collect_set(F.weekday("business_date") + 1)).alias("weekdays"))
    lag = F.datediff(F.to_date("mtime"), "business_date")
    minute = F.hour("mtime") * 60 + F.minute("mtime")
    sums = dated.withColumn("nth", nth).groupBy(*GROUP).agg(
        F.count("*").alias("files"),
        F.array_sort(F.collect_list(F.when(F.col("nth") <= ENOUGH, F.col("rel")))).alias("examples"),
        F.count("mtime").alias("timed"),
        F.min(lag).alias("least_lag"),
        F.max(lag).alias("most_lag"),
        F.min(minute).alias("first_minute"),
        F.max(minute).alias("last_minute"),
        F.max("mtime").alias("latest"),
        F.coalesce(F.bool_and(F.weekday("mtime") < 5), F.lit(True)).alias("on_weekdays"),
    )
    return sums.join(per_day, list(GROUP)).join(cadences(dated), list(GROUP))


def exclude_candidates(files: DataFrame) -> DataFrame:
    """(pattern) of undated names that look like a dated series without its date, as a copy of the newest file does."""
    trimmed = lambda c: F.regexp_replace(c, "[-_.]+$", "")
    extension = F.regexp_extract("name", "[^.](\\.[^.]*)$", 1)
    dated = files.where(F.col("pattern").isNotNull())
    often = dated.groupBy(*GROUP).agg(F.count("*").alias("n")).where(F.col("n") >= ENOUGH)
    signatures = dated.join(often, list(GROUP), "left_semi").select("subset", trimmed(F.col("prefix")).alias("stem"), extension.alias("extension")).distinct()
    bare = files.where(F.col("subset").isNotNull() & F.col("date_text").isNull()).select("subset", "name", trimmed(F.expr("substring(name, 1, length(name) - length(regexp_extract(name, '[^.](\\\\.[^.]*)$', 1)))")).alias("stem"), extension.alias("extension"))
    return bare.join(signatures, ["subset", "stem", "extension"], "left_semi").select(F.concat(F.lit("^"), quoted(F.col("name")), F.lit("$")).alias("pattern")).distinct()


def cron_of(rows: list, zoned: bool = True) -> str | None:
    """A daily schedule a little after the latest arrival, if arrivals lie within two hours."""
    from datetime import timedelta

    timed = [r for r in rows if r["timed"]]
    if not rows or any(r["files"] < ENOUGH for r in rows) or sum(r["timed"] for r in rows) < ENOUGH or not zoned:
        return None
    if max(r["last_minute"] for r in timed) - min(r["first_minute"] for r in timed) > 120:
        return None
    at = max(r["latest"] for r in timed).replace(second=0, microsecond=0) + timedelta(minutes=25)
    if at.minute:
        at = at.replace(minute=0) + timedelta(hours=1)
    return f"{at.minute} {at.hour} * * {'1-5' if all(r['on_weekdays'] for r in timed) else '*'}"


def caveats(files: DataFrame) -> DataFrame:
    """(caveat), each once."""
    quote = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    loose = files.where(F.col("subset").isNull()).select(F.concat("rel", F.lit(": no subset folder below discovery root")).alias("caveat"))
    invalid = files.where(F.col("subset").isNotNull() & F.col("date_text").isNotNull() & F.col("business_date").isNull())
    invalid = invalid.select(F.concat(F.col("rel"), F.lit(": date-shaped value "), quote(F.col("date_text")), F.lit(" is invalid")).alias("caveat"))
    sums = files.agg(F.count_if(F.col("mtime").isNull()).alias("untimed"), F.count("*").alias("n"))
    untimed = sums.where("untimed > 0").select(F.lit("some files have missing or unparseable mtimes; schedule and lag evidence excludes them").alias("caveat"))
    few = sums.where(F.col("n") < ENOUGH).select(F.lit("fewer than three files observed; cadence, lag, cron, and exclusions need more history").alias("caveat"))
    return loose.unionByName(invalid).unionByName(untimed).unionByName(few).distinct()


def analyze(files: DataFrame, root: str) -> DiscoveryReport:
    root = root.rstrip("/")
    all_files = shaped(files, root).cache()
    rows = groups(all_files.where(F.col("pattern").isNotNull())).orderBy(*GROUP).collect()
    n, depth = all_files.agg(F.count("*"), F.coalesce(F.max(F.length("rel") - F.length(F.replace("rel", F.lit("/"), F.lit("")))), F.lit(0))).first()
    subsets = [r[0] for r in all_files.where(F.col("subset").isNotNull()).select("subset").distinct().orderBy("subset").collect()]
    patterns = tuple(
        PatternSuggestion(
            r["subset"], r["pattern"], r["date_format"], tuple(r["examples"]), r["cadence"], tuple(r["weekdays"]), (r["least_lag"], r["most_lag"]) if r["timed"] >= ENOUGH else None, (r["least_files"], r["most_files"])
        )
        for r in rows
    )
    report = DiscoveryReport(
        root,
        n,
        {s: f"{root}/{s}" for s in subsets},
        depth,
        cron_of(rows),
        tuple(r[0] for r in exclude_candidates(all_files).orderBy("pattern").collect()),
        patterns,
        tuple(r[0] for r in caveats(all_files).orderBy("caveat").collect()),
    )
    all_files.unpersist()
    return report


def to_json(report: DiscoveryReport) -> str:
    return json.dumps(report.to_dict(), indent=2, default=str)


def parse_mtime(text: Column) -> Column:
    """ISO text as a timestamp; text without a zone is UTC; null if it doesn't parse."""
    zoned = F.regexp_replace(text, "Z$", "+00:00")
    with_zone = F.when(zoned.rlike("[+-]\\d{2}:?\\d{2}$"), zoned).otherwise(F.concat(zoned, F.lit("+00:00")))
    return F.when(text.rlike("^\\d{4}-\\d{2}-\\d{2}"), F.try_to_timestamp(with_zone))


def is_regex(text: str) -> bool:
    try:
        re.compile(text)
    except re.error:
        return False
    return True
