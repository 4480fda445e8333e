"""One query for each relational operator on the driver's tables, next to its SQL.

The tables have no manifest, so queries define one by projection, alike in Spark and in SQL:
events: id, table = event_type, business date = day of ts, subset = user_id % 5, loaded if user_id % 3 = 0;
documents: id, identity = n_chars, content hash of the text. Files: the months of orders, the days of events.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import calendars, checks, classify, discover, merge, nest, planning
from ..operators import manifest as m
from ..operators.profile import keys, propose, stats, typing
from ..sources import patterns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    loaded = F.col("user_id") % 3 == 0
    made = {
        "id": F.col("event_id"),
        "feed": F.lit("events"),
        "subset": (F.col("user_id") % 5).cast("string"),
        "remote_path": F.concat(F.lit("/in/"), F.col("user_id").cast("string")),
        "path": F.concat((F.col("user_id") % 5).cast("string"), F.lit("/"), F.col("user_id").cast("string")),
        "remote_mtime": F.date_format("ts", "yyyy-MM-dd"),
        "size": F.length("props").cast("long"),
        "version": F.lit(1),
        "status": F.when(F.col("user_id") % 7 == 0, m.SUPERSEDED).otherwise(m.DOWNLOADED),
        "local_path": F.lit(None),
        "sha256": F.sha2("props", 256),
        "downloaded_at": F.col("ts"),
        "parent_id": F.when(F.col("user_id") % 4 == 0, F.col("event_id") - 1),
        "member": F.lit(None),
        "table": F.when(F.col("event_type") != "view", F.col("event_type")),
        "business_date": F.to_date("ts"),
        "attributes": F.create_map(F.lit("region"), (F.col("user_id") % 2).cast("string")),
        "identity": F.concat(F.col("event_type"), F.lit("|"), F.col("user_id").cast("string")),
        "loaded_at": F.when(loaded, F.col("ts")),
        "load_id": F.when(loaded, F.lit("load")),
    }
    return e.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in m.SCHEMA])


#: The same in SQL.
MF = """mf as (
  select event_id as id, (user_id % 5)::varchar as subset, '/in/' || user_id::varchar as remote_path, (user_id % 5)::varchar || '/' || user_id::varchar as path,
    strftime(ts, '%Y-%m-%d') as remote_mtime, length(props)::bigint as size, case when user_id % 7 = 0 then 'superseded' else 'downloaded' end as status, sha256(props) as sha256,
    case when user_id % 4 = 0 then event_id - 1 end as parent_id, case when event_type <> 'view' then event_type end as "table", ts::date as business_date, user_id % 2 as region,
    event_type || '|' || user_id::varchar as identity, user_id % 3 = 0 as loaded
  from events)"""
EVENT = "purchase"
START, END = date(2024, 1, 5), date(2024, 1, 12)


# --- manifest ---


@query(f"with {MF} select id, remote_path, status from mf where status <> 'superseded' qualify row_number() over (partition by remote_path order by id desc) = 1")
def manifest_latest(spark, sf_dir):
    return m.latest(events_manifest(spark, sf_dir), "events").select("id", "remote_path", "status")


@query(f"with {MF} select id, path from mf where status = 'downloaded' and \"table\" is null and parent_id is null")
def manifest_unclassified(spark, sf_dir):
    return m.unclassified(events_manifest(spark, sf_dir), "events", top_level=True).select("id", "path")


@query(f"with {MF} select id, business_date from mf where \"table\" = '{EVENT}' and status = 'downloaded' and business_date >= date '{START}' and business_date < date '{END}'")
def files_for_window(spark, sf_dir):
    return m.files_for(events_manifest(spark, sf_dir), EVENT, START, END).select("id", "business_date")


@query(f"with {MF} select business_date, max(id) as newest_id from mf where \"table\" = '{EVENT}' and status = 'downloaded' and not loaded group by 1")
def pending_days(spark, sf_dir):
    return m.pending_days(events_manifest(spark, sf_dir), EVENT)


@query(f"with {MF} select business_date, count(*) as n_files from mf where \"table\" = '{EVENT}' and status = 'downloaded' and business_date >= date '{START}' group by 1")
def file_counts(spark, sf_dir):
    return m.file_counts(events_manifest(spark, sf_dir), EVENT, START)


@query(f"with {MF} select id, sha256 from mf where identity = '{EVENT}|10' and status = 'downloaded' and id <> 5")
def active_with_identity(spark, sf_dir):
    return m.active_with_identity(events_manifest(spark, sf_dir), f"{EVENT}|10", 5)


@query(f"with {MF} select id, case when id in (1, 2, 3, 50) then 'ignored' else status end as status from mf")
def ops_ignore(spark, sf_dir):
    return m.ignore(events_manifest(spark, sf_dir), [1, 2, 3, 50]).select("id", "status")


@query(f"with {MF} select id, (loaded and not (coalesce(\"table\", '') = '{EVENT}' and status = 'downloaded' and business_date >= date '{START}' and business_date < date '{END}')) as is_loaded from mf")
def ops_reload(spark, sf_dir):
    files, _ = m.reload(events_manifest(spark, sf_dir), EVENT, START, END)
    return files.select("id", F.col("loaded_at").isNotNull().alias("is_loaded"))


@query(f"with {MF} select id, case when \"table\" = '{EVENT}' then null else \"table\" end as table_key, case when \"table\" = '{EVENT}' then null else identity end as identity, case when \"table\" = '{EVENT}' then 'downloaded' else status end as status from mf")
def ops_reclassify(spark, sf_dir):
    files, _ = m.reclassify(events_manifest(spark, sf_dir), EVENT)
    return files.select("id", F.col("table").alias("table_key"), "identity", "status")


@query(f"with {MF} select id, case when id % 10 = 0 then 'L' else case when loaded then 'load' end end as load_id from mf")
def mark_loaded(spark, sf_dir):
    files = events_manifest(spark, sf_dir)
    return m.mark_loaded(files, files.select("id").where("id % 10 = 0"), "L").select("id", "load_id")


@query(f"""with {MF}, new as (select max(id) + 1 as id, remote_path from mf where business_date = date '2024-01-30' group by 2)
select id, remote_path, case when remote_path in (select remote_path from new) then 'superseded' else status end as status from mf where parent_id is null or ((parent_id in (select id from mf where remote_path in (select remote_path from new))) is not null and parent_id not in (select id from mf where remote_path in (select remote_path from new)))
union all select id, remote_path, 'superseded' from mf where parent_id in (select id from mf where remote_path in (select remote_path from new))
union all select id, remote_path, 'downloaded' from new""")
def manifest_record(spark, sf_dir):
    files = events_manifest(spark, sf_dir)
    last = files.where(F.col("business_date") == F.lit(date(2024, 1, 30))).groupBy("remote_path").agg(F.max("id").alias("_id"))
    new = last.join(files.withColumnRenamed("remote_path", "_path"), (F.col("_id") == F.col("id")) & (F.col("_path") == F.col("remote_path")))
    new = new.withColumns({"id": F.col("id") + 1, "version": F.lit(2), "status": F.lit(m.DOWNLOADED)})
    return m.record(files, new.select(*m.SCHEMA.names)).select("id", "remote_path", "status")


@query("""with a as (select page_id, 'web' as subset, url from pages), members as (select page_id, 'm' || i::varchar || '.csv' as member, i from a cross join range(3) t(i))
select 'expanded' as status, page_id as id, 'web/' || page_id::varchar as path, null::bigint as parent_id from a
union all select 'downloaded', (select max(page_id) from pages) + row_number() over (order by page_id, member), 'web/' || page_id::varchar || '!' || member, page_id from members""")
def expand_archives(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    base = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in m.SCHEMA}
    base |= {"id": F.col("page_id").alias("id"), "feed": F.lit("f").alias("feed"), "subset": F.lit("web").alias("subset"), "remote_path": F.col("url").alias("remote_path"), "path": F.concat(F.lit("web/"), F.col("page_id").cast("string")).alias("path"), "status": F.lit(m.DOWNLOADED).alias("status")}
    files = pages.select(*[base[f.name].cast(f.dataType).alias(f.name) for f in m.SCHEMA])
    members = pages.select(F.col("page_id").alias("parent_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
    members = members.select("parent_id", F.concat(F.lit("m"), F.col("i").cast("string"), F.lit(".csv")).alias("member"), F.lit(1).alias("member_size"), F.lit("x").alias("member_sha256"))
    return m.add_members(files, members, files.agg(F.max("id")).first()[0] + 1).select("status", "id", "path", "parent_id")


@query(f"""with {MF}, today as (select id, remote_path, remote_mtime, size from mf where business_date = date '2024-01-10' qualify row_number() over (partition by remote_path order by id desc) = 1),
before as (select remote_path, remote_mtime, size from mf where business_date = date '2024-01-09' qualify row_number() over (partition by remote_path order by id desc) = 1)
select t.remote_path, case when regexp_matches(regexp_extract(t.remote_path, '[^/]*$'), '^13') then case when b.remote_path is null then 'ignored' else 'unchanged' end
  when b.remote_path is null then 'new' when b.size is not distinct from t.size then 'unchanged' else 'revision' end as action,
  (case when b.remote_path is null then 1 else 2 end)::int as version
from today t left join before b using (remote_path)""")
def mirror_diff(spark, sf_dir):
    from ..operators import mirror

    files = events_manifest(spark, sf_dir)
    day = lambda d: m.latest(files.where(F.col("business_date") == F.lit(date(2024, 1, d))), "events", any_status=True)
    # times of both days differ, so sizes alone tell revisions here
    listing = day(10).select("remote_path", F.lit("same").alias("remote_mtime"), "size")
    known = day(9).withColumn("remote_mtime", F.lit("same"))
    return mirror.diff(listing, known, exclude="^13").select("remote_path", "action", "version")


# --- classification ---

RULE = r"'^https?://([^/]+)/([a-z]{2})/(\d+)'"


@query(f"select page_id, nullif(regexp_extract(url, {RULE}, 1), '') as host, nullif(regexp_extract(url, {RULE}, 2), '') as lang_code, regexp_matches(url, {RULE}) as matched from pages")
def pattern_classify(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    pattern = "^https?://(?P<host>[^/]+)/(?P<language>[a-z]{2})/(\\d+)"
    groups = paths.group_names(pattern)
    got = {k: F.nullif(F.regexp_extract("url", paths.java_regex(pattern), i), F.lit("")) for k, i in groups.items()}
    return pages.select("page_id", got["host"].alias("host"), got["language"].alias("lang_code"), paths.matches(F.col("url"), pattern).alias("matched"))


ORDER_NAME = "concat('EM/', case when o_orderkey % 3 = 0 then 'apac' else 'emea' end, '/prices-', strftime(o_orderdate, '%Y%m%d'), '-', o_orderkey % 10, '.csv')"


def order_files(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    region = F.when(F.col("o_orderkey") % 3 == 0, "apac").otherwise("emea")
    path = F.concat(F.lit("EM/"), region, F.lit("/prices-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"), (F.col("o_orderkey") % 10).cast("string"), F.lit(".csv"))
    return o.select("o_orderkey", path.alias("path"))


PRICES = patterns.Patterns(("^EM/(?P<region>[a-z]+)/prices-(?P<date>\\d{8})-(?P<part>\\d)\\.csv$",), ignore=("-9\\.csv$",), date_format="%Y%m%d")


@query(f"""with f as (select o_orderkey, {ORDER_NAME} as path, o_orderdate::date as d, case when o_orderkey % 3 = 0 then 'apac' else 'emea' end as region, (o_orderkey % 10)::varchar as part from orders)
select o_orderkey, case when part <> '9' then d end as business_date, case when part <> '9' then region end as region, case when part <> '9' then part end as part,
  case when part <> '9' then 'EM|' || regexp_extract(path, '[^/]*$') || '|' || d::varchar || '|part=' || part || '|region=' || region end as identity from f""")
def default_identity(spark, sf_dir):
    got = order_files(spark, sf_dir).withColumn("c", PRICES.classify(F.col("path")))
    return got.select("o_orderkey", "c.business_date", F.col("c.attributes")["region"].alias("region"), F.col("c.attributes")["part"].alias("part"), "c.identity")


@query(f"""with f as (select o_orderkey, {ORDER_NAME} as path, case when o_orderkey % 3 = 0 then 'apac' else 'emea' end as region, (o_orderkey % 10)::varchar as part from orders)
select o_orderkey, regexp_extract(path, '[^/]*$') || '|part=' || part || '|region=' || region as identity from f where part <> '9'""")
def identity_across_subsets(spark, sf_dir):
    source = patterns.Patterns(PRICES.select, PRICES.ignore, date_format=PRICES.date_format, identity=patterns.across_subsets)
    got = order_files(spark, sf_dir).withColumn("c", source.classify(F.col("path"))).where(F.col("c").isNotNull())
    return got.select("o_orderkey", "c.identity")


@query("""with p as (select page_id, url, case when page_id % 2 = 0 then 'a/b.zip!' || page_id::varchar || '.csv' when page_id % 3 = 0 then 'b.zip!x' else 'c/' || page_id::varchar end as path from pages)
select page_id, path, case when page_id % 2 = 0 then 'a/' || page_id::varchar || '.csv' when page_id % 3 = 0 then 'x' else path end as matched_path from p""")
def match_path(spark, sf_dir):
    i = F.col("page_id").cast("string")
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("a/b.zip!"), i, F.lit(".csv"))).when(F.col("page_id") % 3 == 0, "b.zip!x").otherwise(F.concat(F.lit("c/"), i))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path")).withColumn("matched_path", paths.match_path(F.col("path")))


def year_table(name: str, pattern: str):
    from ..config import Table

    return Table("web", name, patterns.Patterns((pattern,), date_format="%Y"))


def page_manifest(spark, sf_dir) -> DataFrame:
    base = {f.name: F.lit(None) for f in m.SCHEMA}
    host = F.regexp_extract("url", "^https?://([^/]+)/", 1)
    base |= {"id": F.col("page_id"), "feed": F.lit("web"), "subset": F.lit("s"), "remote_path": F.col("url"), "path": F.concat(F.lit("s/"), host, F.lit("/2024")), "status": F.lit(m.DOWNLOADED), "version": F.lit(1), "sha256": F.sha2("html", 256)}
    return table(spark, sf_dir, "pages").select(*[base[f.name].cast(f.dataType).alias(f.name) for f in m.SCHEMA])


@query(r"""with p as (select page_id as id, 's/' || regexp_extract(url, '^https?://([^/]+)/', 1) || '/2024' as path from pages),
rules as (select 'web/all' as t, '^s/[^/]+/(\d{4})$' as r union all select 'web/blogs', '^s/blog\.[^/]+/(\d{4})$' union all select 'web/org', '^s/[^/]+\.org/(\d{4})$')
select id, count(*)::int as n_tables, string_agg(t, ',' order by t) as tables from p join rules on regexp_matches(path, r) group by id having count(*) > 1""")
def classify_ambiguous(spark, sf_dir):
    tables = [year_table("all", "^s/[^/]+/(?P<date>\\d{4})$"), year_table("blogs", "^s/blog\\.[^/]+/(?P<date>\\d{4})$"), year_table("org", "^s/[^/]+\\.org/(?P<date>\\d{4})$")]
    found = classify.candidates(page_manifest(spark, sf_dir), tables).where(F.size("found") > 1)
    return found.select("id", F.size("found").alias("n_tables"), F.array_join(F.array_sort(F.transform("found", lambda x: x["table"])), ",").alias("tables"))


@query(r"""with p as (select page_id as id, 's/' || regexp_extract(url, '^https?://([^/]+)/', 1) || '/2024' as path, sha256(html) as sha from pages where regexp_matches(url, '^https?://blog\.')),
f as (select *, coalesce(sha = lag(sha) over (order by id), false) as same from p),
g as (select *, max(case when not same then id end) over () as last from f)
select id, 'web/blogs' as table_key, date '2024-01-01' as business_date, case when same then 'duplicate' when id = last then 'downloaded' else 'superseded' end as status from g""")
def classify_assign(spark, sf_dir):
    files, _ = classify.classify(page_manifest(spark, sf_dir), "web", [year_table("blogs", "^s/blog\\.[^/]+/(?P<date>\\d{4})$")])
    return files.where(F.col("table").isNotNull()).select("id", F.col("table").alias("table_key"), "business_date", "status")


def same_documents(spark, sf_dir, policy: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("identity"), F.sha2("text", 256).alias("sha256"), F.lit(policy).alias("on_collision"))
    return classify.resolve(rows).select("id", "status")


@query("""with r as (select doc_id as id, n_chars as k, sha256(text) as sha from documents), s as (select *, coalesce(sha = lag(sha) over (partition by k order by id), false) as same from r)
select id, case when same then 'duplicate' when id = max(case when not same then id end) over (partition by k) then 'downloaded' else 'superseded' end as status from s""")
def resolve_latest(spark, sf_dir):
    return same_documents(spark, sf_dir, "latest")


@query("""with r as (select doc_id as id, n_chars as k, sha256(text) as sha from documents)
select id, case when id = min(id) over w then 'downloaded' when sha = first_value(sha) over (partition by k order by id) then 'duplicate' else 'superseded' end as status from r window w as (partition by k)""")
def resolve_first(spark, sf_dir):
    return same_documents(spark, sf_dir, "first")


@query("select doc_id, sha256(text) as sha256, strlen(text)::bigint as size from documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size"))


@query("select sha256(text) as sha256, count(*) as n_copies, min(doc_id) as first_id from documents group by 1 having count(*) > 1")
def duplicates_by_content(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha256"))
    return d.agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_id")).where("n_copies > 1")


# --- calendars and checks ---

CALENDAR_START, CALENDAR_END = date(2023, 12, 1), date(2025, 2, 1)
SERIES = f"(select unnest(generate_series(date '{CALENDAR_START}', date '{CALENDAR_END}', interval 1 day))::date as d)"
HOLIDAYS = (date(2023, 12, 25), date(2024, 1, 1), date(2024, 12, 25))


@query(f"select d from {SERIES} where isodow(d) < 6 and d not in (date '2023-12-25', date '2024-01-01', date '2024-12-25')")
def calendar_weekdays(spark, sf_dir):
    return calendars.Weekdays(HOLIDAYS).days(spark, CALENDAR_START, CALENDAR_END)


@query(f"select d from {SERIES} where isodow(d) = 5")
def calendar_weekly(spark, sf_dir):
    return calendars.Weekly(4).days(spark, CALENDAR_START, CALENDAR_END)


@query(f"select d from {SERIES} where isodow(d) = 6 and (day(d) - 1) // 7 + 1 in (1, 3)")
def calendar_nth_weekday(spark, sf_dir):
    return calendars.NthWeekday((1, 3), 5).days(spark, CALENDAR_START, CALENDAR_END)


@query(f"select d from {SERIES} where day(d) = 31")
def calendar_monthly(spark, sf_dir):
    return calendars.Monthly(31).days(spark, CALENDAR_START, CALENDAR_END)


@query(f"select d from {SERIES} where month(d) = 2 and day(d) = 1")
def calendar_yearly(spark, sf_dir):
    return calendars.Yearly(2, 1).days(spark, CALENDAR_START, CALENDAR_END)


@query("select distinct o_orderdate::date as d from orders where o_orderstatus = 'F' and o_orderdate::date between date '1996-01-01' and date '1997-06-30' and o_orderdate::date <> date '1996-12-25'")
def calendar_exchange(spark, sf_dir):
    sessions = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("exchange"), F.to_date("o_orderdate").alias("d")).distinct()
    return calendars.Exchange("F", (date(1996, 12, 25),), sessions).days(spark, date(1996, 1, 1), date(1997, 6, 30))


DUE_SQL = f"""{MF}, due as (select d from {SERIES} where isodow(d) < 6 and d <= date '2024-01-22' order by d desc limit 10),
counts as (select business_date as d, count(*) as n from mf where "table" = '{EVENT}' and status = 'downloaded' and business_date <> date '2024-01-22' group by 1), filled as (select d, coalesce(n, 0) as n_files from due left join counts using (d))"""


def due_days(spark, sf_dir) -> DataFrame:
    files = events_manifest(spark, sf_dir).where(F.col("business_date") != F.lit(date(2024, 1, 22)))
    return checks.deliveries(m.file_counts(files, EVENT, CALENDAR_START), calendars.Weekdays().days(spark, CALENDAR_START, date(2024, 1, 22)), 10)


@query(f"with {DUE_SQL}, m as (select avg(n_files) as a from filled) select d, n_files from filled where n_files < 1 or n_files > 60")
def delivery_violations(spark, sf_dir):
    return checks.violations(due_days(spark, sf_dir), 1, 60)


@query(f"with {DUE_SQL}, w as (select d, n_files, n_files < 1 as wrong from filled) select count(*) filter (wrong) = 0 as passed, case when count(*) filter (wrong) = 1 and max(d) filter (wrong) = max(d) and max(n_files) filter (wrong) = 0 then 'WARN' else 'ERROR' end as severity from w")
def delivery_severity(spark, sf_dir):
    return checks.verdict(due_days(spark, sf_dir), 1, None)


# --- partitions and runs ---

KEY_SQL = {"day": "d", "week": "(d - dayofweek(d)::int)::date", "month": "date_trunc('month', d)::date", "year": "date_trunc('year', d)::date"}


def partition_key_query(period: str, name: str) -> None:
    def run(spark, sf_dir):
        days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
        return days.groupBy(planning.partition_key(F.col("d"), period).alias("key")).agg(F.count("*").alias("n"))

    query(f"with o as (select o_orderdate::date as d from orders) select {KEY_SQL[period]} as key, count(*) as n from o group by 1", f"partition_key_{name}")(run)


for _period, _name in (("day", "daily"), ("week", "weekly"), ("month", "monthly"), ("year", "yearly")):
    partition_key_query(_period, _name)

WINDOW_STARTS = tuple(date(y, mth, d) for y in range(1995, 2002) for mth, d in ((1, 10), (4, 20), (9, 5)))


@query("with s as (" + " union all ".join(f"select date '{d}' as s" for d in WINDOW_STARTS) + "), o as (select distinct o_orderdate::date as d from orders) select d, max(s) as key from o left join s on s <= d group by d")
def partition_key_windows(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return planning.Windows(WINDOW_STARTS).keys(days, "d").select("d", "key")


ISLANDS = """p as (select {key} as key, max(o_orderkey) as newest_id from (select o_orderdate::date as d, o_orderkey from orders where o_orderkey % 3 <> 0) group by 1),
n as (select key, newest_id, {ordinal} - row_number() over (order by key) as island from p), c as (select *, (row_number() over (partition by island order by key) - 1) // {most} as chunk from n)"""


def pending_orders(spark, sf_dir) -> DataFrame:
    """Pending days of a manifest in which every order is a file, and a third of them are loaded."""
    o = table(spark, sf_dir, "orders")
    made = {"id": F.col("o_orderkey"), "table": F.lit("orders"), "status": F.lit(m.DOWNLOADED), "business_date": F.to_date("o_orderdate"), "loaded_at": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate"))}
    return m.pending_days(o.select(*[v.alias(k) for k, v in made.items()]), "orders")


@query("with " + ISLANDS.format(key="d", ordinal="(key - date '1970-01-04')", most=31) + " select min(key) as start, max(key) as \"end\", max(newest_id) as newest_id from c group by island, chunk")
def pending_ranges(spark, sf_dir):
    return planning.Daily("1990-01-01").runs(pending_orders(spark, sf_dir))


@query("with " + ISLANDS.format(key="date_trunc('month', d)::date", ordinal="(year(key) * 12 + month(key))", most=12) + " select 'orders/' || min(key)::varchar || '/' || max(key)::varchar || '/' || max(newest_id)::varchar as run_key from c group by island, chunk having max(newest_id) % 2 = 0")
def run_keys_not_issued(spark, sf_dir):
    runs = planning.run_keys(planning.Monthly("1990-01-01").runs(pending_orders(spark, sf_dir)), "orders")
    return planning.not_issued(runs, runs.where("newest_id % 2 <> 0")).select("run_key")


# --- loads ---


@query("""with t as (select o_orderkey, o_totalprice, o_orderdate::date as _business_date from orders), i as (select o_orderkey, round(o_totalprice * 2, 2) as o_totalprice, _business_date from t where _business_date between date '1996-03-01' and date '1996-03-31')
select * from t where _business_date not in (select _business_date from i) union all select * from i""")
def replace_by_day(spark, sf_dir):
    target = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("_business_date"))
    incoming = target.where("_business_date between date '1996-03-01' and date '1996-03-31'").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return merge.replace_day(target, incoming)


@query("""with i as (select o_custkey, o_totalprice, o_orderkey as _source_file from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
select c_custkey, c_acctbal from (select c_custkey, c_acctbal from customer where c_custkey not in (select o_custkey from i) union all select o_custkey, o_totalprice from i)""")
def upsert_by_key(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    incoming = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), F.col("o_orderkey").alias("_source_file"))
    return merge.upsert(target, incoming, ("c_custkey",)).select("c_custkey", "c_acctbal")


@query("select p_partkey, p_name, null::double as p_discount from part union all select p_partkey, p_name, p_retailprice / 2 from part")
def evolve_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    target, incoming = part.drop("p_retailprice"), part.select("p_partkey", "p_name", (F.col("p_retailprice") / 2).alias("p_discount"))
    merge.check_contract(target.schema, incoming.schema)
    return target.unionByName(incoming, allowMissingColumns=True)


@query("select 'p_retailprice' as name union all select 'p_size'")
def new_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    committed = [c for c in part.columns if c not in ("p_size", "p_retailprice")]
    return spark.createDataFrame([(c,) for c in merge.new_columns([*part.columns, "_load_id"], committed, ["_load_id"])], "name string")


@query("select event_id, ts::date as _business_date, (user_id % 5)::varchar as _subset, event_id as _source_file, 'run' as _load_id, (user_id % 2)::varchar as _region from events")
def metadata_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("_load_id", F.lit("old"))
    meta = {"_business_date": F.to_date("ts"), "_subset": (F.col("user_id") % 5).cast("string"), "_source_file": F.col("event_id"), "_load_id": F.lit("run"), "_region": (F.col("user_id") % 2).cast("string")}
    return merge.with_metadata(rows, meta).select("event_id", *meta)


@query("select event_id, (json_extract_string(props, '$.k'))::bigint as props__k, user_id as who__id, event_type as who__kind__type from events")
def json_flatten(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long").alias("props"), F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("type")).alias("kind")).alias("who"))
    return nest.flatten(e)


@query("select vec_id, i - 1 as _list_idx, embedding[i]::double as value from embeddings, unnest(generate_series(1, len(embedding))) t(i)")
def unnest_child(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    child = nest.denest(e, "e", carried=("vec_id",))["e__embedding"]
    return child.select("vec_id", F.col("_list_idx").cast("long").alias("_list_idx"), F.col("value").cast("double").alias("value"))


@query("select conv_id, row_number() over (partition by conv_id order by turn) - 1 as _list_idx, role, length(text) as n_chars from conversations")
def unnest_objects(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    lists = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    child = nest.denest(lists, "c", carried=("conv_id",))["c__turns"]
    return child.select("conv_id", F.col("_list_idx").cast("long").alias("_list_idx"), "role", F.char_length("text").cast("long").alias("n_chars"))


@query("""select vec_id, len(embedding) as n, embedding[1]::double as first from embeddings""")
def nesting_limit(spark, sf_dir):
    flat = nest.denest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "e", max_nesting=0)["e"]
    values = F.from_json("embedding", "array<float>")
    return flat.select("vec_id", F.size(values).cast("long").alias("n"), values[0].cast("double").alias("first"))


# --- profile ---

ORDERS_TEXT = "nullif(o_orderpriority, '3-MEDIUM')"


def order_columns(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("_file"), "o_orderkey", "o_custkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("o_orderpriority"))
    return typing.melt(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


MELTED = f"""melted as (
  select strftime(o_orderdate, '%Y-%m') as file, 'o_orderkey' as "column", o_orderkey::varchar as value from orders union all select strftime(o_orderdate, '%Y-%m'), 'o_custkey', o_custkey::varchar from orders
  union all select strftime(o_orderdate, '%Y-%m'), 'o_orderstatus', o_orderstatus from orders union all select strftime(o_orderdate, '%Y-%m'), 'o_orderpriority', {ORDERS_TEXT} from orders)"""


@query(f"""with {MELTED} select "column", count(*) as "rows", count(*) filter (value is null) as nulls, count(distinct file) as files, round(count(*) filter (value is null) / count(*), 4) as null_ratio from melted group by 1""")
def column_null_stats(spark, sf_dir):
    return stats.counts(order_columns(spark, sf_dir))


def prices(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.lit("l_extendedprice").alias("column"), F.col("l_extendedprice").alias("number"))


@query("select 'l_extendedprice' as \"column\", min(l_extendedprice) as min, max(l_extendedprice) as max, count(*) filter (l_extendedprice = 0) as zeros, count(*) filter (l_extendedprice < 0) as negatives from lineitem")
def numeric_stats(spark, sf_dir):
    return stats.numeric(prices(spark, sf_dir))


@query("with b as (select min(l_extendedprice) as a, max(l_extendedprice) as z from lineitem) select 'l_extendedprice' as \"column\", least(floor((l_extendedprice - a) / ((z - a) / 10)), 9)::int as bin, count(*) as n from lineitem, b group by 1, 2")
def numeric_histogram(spark, sf_dir):
    rows = prices(spark, sf_dir)
    return stats.histogram(rows, stats.numeric(rows).select("column", "min", "max"))


@query(r"with p as (select p_retailprice::decimal(12,2)::varchar as v from part) select max(length(regexp_extract(v, '^-?(\d+)', 1)))::int as int_digits, max(length(regexp_extract(v, '\.(\d+)$', 1)))::int as frac_digits from p")
def int_frac_digits(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lit("f").alias("_file"), F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("price"))
    return typing.infer(typing.melt(p, ["price"])).select("int_digits", "frac_digits")


@query("""with t as (select 'l_shipdate' as "column", l_shipdate as v from lineitem union all select 'ts', ts from events)
select "column", min(v) as min, max(v) as max, max(case when epoch_us(v) % 1000 <> 0 then 6 when epoch_us(v) % 1000000 <> 0 then 3 else 0 end)::int as fraction_digits, bool_and(v = date_trunc('day', v)) as all_midnight from t group by 1""")
def temporal_stats(spark, sf_dir):
    both = table(spark, sf_dir, "lineitem").select(F.lit("l_shipdate").alias("column"), F.col("l_shipdate").alias("at")).unionByName(table(spark, sf_dir, "events").select(F.lit("ts").alias("column"), F.col("ts").alias("at")))
    return stats.temporal(both)


def texts(spark, sf_dir) -> DataFrame:
    one = table(spark, sf_dir, "documents").select(F.lit("d").alias("file"), F.lit("documents").alias("column"), F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit(" "), F.col("text"))).otherwise(F.col("text")).alias("value"))
    return one.unionByName(table(spark, sf_dir, "conversations").select(F.lit("c").alias("file"), F.lit("conversations").alias("column"), F.col("text").alias("value")))


TEXTS = "texts as (select 'documents' as \"column\", case when doc_id % 10 = 0 then ' ' || text else text end as value from documents union all select 'conversations', text from conversations)"
#: The same patterns as RE2 takes them.
RE2 = {q: p.replace("(?d)", "").replace("\\z", "$").replace("'", "''") for q, p in stats.QUIRKS.items()}


@query(f"with {TEXTS} select \"column\", min(length(value))::int as min_len, max(length(value))::int as max_len, max(strlen(value))::int as max_bytes, count(*) filter (value = '') as empty, min(value) <> max(value) as varied, min(length(value)) = max(length(value)) as fixed_length from texts where value is not null group by 1")
def text_lengths(spark, sf_dir):
    return stats.text(texts(spark, sf_dir)).select("column", "min_len", "max_len", "max_bytes", "empty", "varied", "fixed_length")


@query(f"with {TEXTS} select \"column\", " + ", ".join(f"count(*) filter (regexp_matches(value, '{p}')) as {q}" for q, p in RE2.items()) + " from texts where value is not null group by 1")
def quirk_flags(spark, sf_dir):
    return stats.text(texts(spark, sf_dir)).select("column", *stats.QUIRKS)


@query("""with v as (select 'p_name' as "column", p_name as value from part union all select 'text', text from documents), l as (select "column", length(value) as length, count(*) as n from v group by 1, 2),
s as (select *, count(*) over w as kinds, min(length) over w as a, max(length) over w as z from l window w as (partition by "column"))
select "column", case when kinds <= 20 then length else floor(a + least(floor((length - a) / ((z - a) / 10)), 9) * ((z - a) / 10)) end::int as low, sum(n)::bigint as n from s group by 1, 2""")
def length_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.lit("p_name").alias("column"), F.col("p_name").alias("value")).unionByName(table(spark, sf_dir, "documents").select(F.lit("text").alias("column"), F.col("text").alias("value")))
    return stats.length_histogram(stats.lengths(rows))


@query("""with v as (select case user_id % 4 when 0 then '-' when 1 then 'none' when 2 then 'NA' else event_type end as value from events)
select 'x' as "column", value, count(*) as n from v where value in ('-', 'none', 'NA') group by 2""")
def null_like_tokens(spark, sf_dir):
    u = F.col("user_id") % 4
    value = F.when(u == 0, "-").when(u == 1, "none").when(u == 2, "NA").otherwise(F.col("event_type"))
    return stats.null_like(table(spark, sf_dir, "events").select(F.lit("x").alias("column"), value.alias("value")))


@query(f"""with {MELTED}, c as (select "column", value, count(*) as n from melted where value is not null group by 1, 2) select * from c where "column" in (select "column" from c group by 1 having count(*) <= 50)""")
def categorical_counts(spark, sf_dir):
    return stats.categorical(order_columns(spark, sf_dir))


@query("select ts::date as business_date, count(distinct user_id) as n_files, count(*) as n_rows from events group by 1")
def volume_by_date(spark, sf_dir):
    per_file = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("business_date"), F.col("user_id").alias("file")).agg(F.count("*").alias("n_rows"))
    return stats.volume(per_file).select("business_date", "n_files", F.col("n_rows").cast("long").alias("n_rows"))


@query("with f as (select strftime(o_orderdate, '%Y-%m') as file, count(*) as n_rows from orders group by 1) select min(n_rows) as min, max(n_rows) as max, round(avg(n_rows), 2) as mean, count(n_rows) as n from f")
def volume_spread(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("file"))
    return stats.spread(stats.rows_per_file(files), "n_rows")


@query("""with e as (select ts::date as d, user_id % 2 as region, 1 as fixed from events), u as (select d, 'region' as name, region as v from e union all select d, 'fixed', fixed from e)
select distinct name from (select d, name from u group by 1, 2 having count(distinct v) > 1)""")
def file_key_metadata(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("business_date"), F.create_map(F.lit("region"), (F.col("user_id") % 2).cast("string"), F.lit("fixed"), F.lit("1")).alias("attributes"))
    return stats.file_key_metadata(e)


ORDER_SETS = [("o_orderkey",), ("o_custkey",), ("o_orderkey", "o_custkey")]


def order_values(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("file_no", (F.year("o_orderdate") * 12 + F.month("o_orderdate")))
    return keys.values(o, ORDER_SETS, "file_no")


VALUES = """o as (select (year(o_orderdate) * 12 + month(o_orderdate))::int as file_no, o_orderkey, o_custkey from orders),
held as (select 'o_orderkey' as key_set, file_no, o_orderkey::varchar as key, count(*) as n from o group by 2, 3 union all select 'o_custkey', file_no, o_custkey::varchar, count(*) from o group by 2, 3
  union all select 'o_orderkey+o_custkey', file_no, o_orderkey::varchar || chr(31) || o_custkey::varchar, count(*) from o group by 2, 3),
files as (select key_set, file_no, sum(n)::bigint as "rows", count(key) as keys, count(key) = sum(n) as is_unique from held group by 1, 2)"""


@query(f"with {VALUES} select * from files")
def key_unique_per_file(spark, sf_dir):
    return keys.per_file(order_values(spark, sf_dir)).select("key_set", "file_no", "rows", "keys", "is_unique")


@query(f"with {VALUES}, e as (select key_set, key, count(*) as f from held group by 1, 2) select key_set, count(*) as n_distinct, count(*) filter (f > 1) as n_recurring, round(count(*) filter (f > 1) / count(*), 4) as repeat_ratio from e group by 1")
def key_repeat_ratio(spark, sf_dir):
    return keys.recurrence(order_values(spark, sf_dir), 80)


@query(f"""with {VALUES}, alive as (select *, bool_and(is_unique) over (partition by key_set order by file_no) as alive, min(file_no) over (partition by key_set) as first from files)
select a.key_set, a.file_no, a.keys,
  case when a.file_no > first then (select count(*) from held h where h.key_set = a.key_set and h.file_no = a.file_no and not exists (select 1 from held b where b.key_set = h.key_set and b.file_no = h.file_no - 1 and b.key = h.key)) end as n_new,
  case when a.file_no > first then (select count(*) from held h where h.key_set = a.key_set and h.file_no = a.file_no - 1 and not exists (select 1 from held b where b.key_set = h.key_set and b.file_no = h.file_no + 1 and b.key = h.key)) end as n_dropped
from alive a where alive""")
def key_churn(spark, sf_dir):
    held = order_values(spark, sf_dir)
    return keys.churn(held, keys.per_file(held))


@query(f"with {VALUES}, whole as (select key_set from files group by 1 having bool_and(is_unique)), e as (select key_set, key, count(*) as f from held group by 1, 2), r as (select key_set, round(count(*) filter (f > 1) / count(*), 4) as repeat_ratio, count(*) filter (f > 1) = 0 as unique_overall from e group by 1) select * from r where key_set in (select key_set from whole)")
def key_candidates(spark, sf_dir):
    held = order_values(spark, sf_dir)
    n = table(spark, sf_dir, "orders").select(F.date_trunc("month", "o_orderdate")).distinct().count()
    return keys.candidates(keys.per_file(held), keys.recurrence(held, n), n)


@query("""with f as (select l_orderkey, l_partkey, l_linenumber from lineitem where strftime(l_shipdate, '%Y-%m') = (select min(strftime(l_shipdate, '%Y-%m')) from lineitem)),
p as (select 'l_orderkey+l_partkey' as key_set, count(distinct (l_orderkey, l_partkey)) = count(*) as u from f union all select 'l_orderkey+l_linenumber', count(distinct (l_orderkey, l_linenumber)) = count(*) from f union all select 'l_partkey+l_linenumber', count(distinct (l_partkey, l_linenumber)) = count(*) from f),
t as (select 'l_orderkey+l_partkey+l_linenumber' as key_set, count(distinct (l_orderkey, l_partkey, l_linenumber)) = count(*) as u from f)
select array_to_string(list_sort(string_split(key_set, '+')), '+') as key_set from p where u union all select array_to_string(list_sort(string_split(key_set, '+')), '+') from t where u and not exists (select 1 from p where u)""")
def composite_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("m", F.date_format("l_shipdate", "yyyy-MM"))
    first = lines.where(F.col("m") == F.lit(lines.agg(F.min("m")).first()[0]))
    names = ["l_orderkey", "l_partkey", "l_linenumber"]
    n = first.agg(*[F.count_distinct(c) for c in names]).first()
    found = keys.composite_candidates(first, list(zip(names, n)))
    return spark.createDataFrame([("+".join(sorted(s)),) for s in found], "key_set string")


@query(f"""with {VALUES}, r as (select key_set, count(distinct key) as n_distinct from held where key_set <> 'o_orderkey+o_custkey' group by 1) select key_set as "column", n_distinct from r""")
def candidate_columns(spark, sf_dir):
    held = order_values(spark, sf_dir).where("key_set <> 'o_orderkey+o_custkey'")
    n = table(spark, sf_dir, "orders").select(F.date_trunc("month", "o_orderdate")).distinct().count()
    return keys.candidate_columns(keys.per_file(held), keys.recurrence(held, n), n)


TYPED = {
    "orders": {"o_orderkey": "o_orderkey::varchar", "o_totalprice": "o_totalprice::decimal(12,2)::varchar", "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d')", "o_orderstatus": "o_orderstatus", "zeros": "'00' || o_custkey::varchar", "flag": "case when o_custkey % 2 = 0 then 'True' else 'false' end", "stamp": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')", "thousands": "'1,' || lpad((o_custkey % 1000)::varchar, 3, '0')", "science": "o_custkey::varchar || 'e-3'", "compact": "strftime(o_orderdate, '%Y%m%d')", "big": "'99999999999999999999'"}
}


@query("with v as (" + " union all ".join(f"select 'orders' as file, '{c}' as \"column\", {e} as value from orders" for c, e in TYPED["orders"].items()) + r""")
select file, "column", case when "column" = 'compact' and bool_and(try_strptime(value, '%Y%m%d') is not null) then 'date'
  when bool_and(regexp_matches(value, '^-?\d+$')) then case when bool_or(regexp_matches(value, '^-?0\d')) or not bool_and(try_cast(value as bigint) is not null) then 'text' else 'bigint' end
  when bool_and(regexp_matches(value, '^-?\d+(\.\d+)?$')) then 'decimal' when bool_and(regexp_matches(value, '^-?\d{1,3}(,\d{3})+(\.\d+)?$')) then 'text'
  when bool_and(regexp_matches(value, '^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$')) then 'double' when bool_and(lower(value) in ('true', 'false')) then 'bool'
  when bool_and(regexp_matches(value, '^\d{4}-\d{2}-\d{2}$') and try_cast(value as date) is not null) then 'date'
  when bool_and(regexp_matches(value, '^\d{4}-\d{2}-\d{2}[ T]') and try_cast(value as timestamptz) is not null) then 'timestamp' else 'text' end as kind,
  case when bool_and(regexp_matches(value, '^-?\d+$')) and "column" <> 'compact' then case when bool_or(regexp_matches(value, '^-?0\d')) then 'leading zeros' when not bool_and(try_cast(value as bigint) is not null) then 'integers beyond 64 bit' end
    when bool_and(regexp_matches(value, '^-?\d{1,3}(,\d{3})+(\.\d+)?$')) then 'thousands separators' end as reason
from v group by 1, 2""")
def infer_types(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cust = F.col("o_custkey").cast("string")
    made = {
        "o_orderkey": F.col("o_orderkey").cast("string"),
        "o_totalprice": F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "o_orderstatus": F.col("o_orderstatus"),
        "zeros": F.concat(F.lit("00"), cust),
        "flag": F.when(F.col("o_custkey") % 2 == 0, "True").otherwise("false"),
        "stamp": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "thousands": F.concat(F.lit("1,"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0")),
        "science": F.concat(cust, F.lit("e-3")),
        "compact": F.date_format("o_orderdate", "yyyyMMdd"),
        "big": F.lit("99999999999999999999"),
    }
    rows = o.select(F.lit("orders").alias("_file"), *[c.alias(n) for n, c in made.items()])
    plain = [n for n in made if n != "compact"]
    got = typing.infer(typing.melt(rows, plain)).unionByName(typing.infer(typing.melt(rows, ["compact"]), formats=("%Y%m%d",)))
    return got.select("file", "column", "kind", "reason")


@query("""with l as (select p_brand, min(length(p_name)) as a, max(length(p_name)) as z, min(p_name) <> max(p_name) as varied from part group by 1)
select p_brand, case when z = 0 then 20 when a = z and varied then z when ceil(z * 1.5) <= 20 then 20 when ceil(z * 1.5) <= 50 then 50 when ceil(z * 1.5) <= 100 then 100 when ceil(z * 1.5) <= 255 then 255 when ceil(z * 1.5) <= 1000 then 1000 when ceil(z * 1.5) <= 4000 then 4000 end::int as precision from l""")
def text_bucket(spark, sf_dir):
    got = stats.text(table(spark, sf_dir, "part").select("p_brand", F.lit("f").alias("file"), F.col("p_name").alias("value")), by=("p_brand",))
    return got.select("p_brand", propose.text_length_of(F.col("min_len"), F.col("max_len"), F.col("varied")).alias("precision"))


@query("""with k as (select user_id, case when user_id % 5 = 0 then ['bigint'] when user_id % 5 = 1 then ['bigint', 'decimal'] when user_id % 5 = 2 then ['bigint', 'text'] when user_id % 5 = 3 then ['date', 'timestamp'] else []::varchar[] end as kinds from events group by 1)
select user_id, case user_id % 5 when 0 then 'bigint' when 1 then 'decimal' when 2 then 'text' when 3 then 'timestamp' else 'text' end as data_type from k""")
def propose_column(spark, sf_dir):
    u = F.col("user_id") % 5
    kinds = F.when(u == 0, F.array(F.lit("bigint"))).when(u == 1, F.array(F.lit("bigint"), F.lit("decimal"))).when(u == 2, F.array(F.lit("bigint"), F.lit("text"))).when(u == 3, F.array(F.lit("date"), F.lit("timestamp"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "events").select("user_id").distinct().select("user_id", propose.data_type_of(kinds).alias("data_type"))


@query("""with f as (select user_id, user_id % 5 as u, min(value) as a, max(value) as z, count(*) as n, sum(case when value > 50 then 1 else 0 end) as nulls, (user_id % 4)::int as frac, (user_id % 7)::int as whole from events group by 1)
select user_id::varchar as name, case u when 0 then 'bigint' when 1 then 'double' when 2 then 'text' when 3 then 'timestamp' else 'text' end as data_type, nulls > 0 as nullable,
  case u when 0 then case when greatest(abs(a), abs(z)) * 10 < 32768 then 16 when greatest(abs(a), abs(z)) * 10 < 2147483648 then 32 end when 2 then case when whole = 0 then 20 when ceil(whole * 9 * 1.5) <= 20 then 20 when ceil(whole * 9 * 1.5) <= 50 then 50 else 100 end when 3 then case frac when 0 then null when 3 then 3 else 7 end end::int as precision,
  case when u = 3 then whole > 3 end as timezone,
  case u when 1 then 'would fit decimal(' || (whole + 2 + frac) || ',' || frac || '), see --decimals' when 2 then 'no type holds all of: bigint, text' when 4 then 'there were no values' end as description from f""")
def propose_sizes(spark, sf_dir):
    """Facts of a column for each user: kinds by the user, numbers from the values."""
    u, kinds_of = F.col("user_id") % 5, (("bigint",), ("bigint", "decimal"), ("bigint", "text"), ("date", "timestamp"), ())
    kinds = F.array().cast("array<string>")
    for i, names in enumerate(kinds_of[:4]):
        kinds = F.when(u == i, F.array(*map(F.lit, names))).otherwise(kinds)
    frac, whole = (F.col("user_id") % 4).cast("int"), (F.col("user_id") % 7).cast("int")
    each = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.count("*").alias("rows"), F.count_if(F.col("value") > 50).alias("nulls"))
    made = {"name": F.col("user_id").cast("string"), "kinds": kinds, "reasons": F.array(), "declared": F.array(), "int_digits": whole, "frac_digits": frac, "zoned": whole > 3, "fraction_digits": frac, "min_len": F.lit(0), "max_len": whole * 9, "varied": F.lit(True)}
    facts = each.select(*[made.get(f.name, F.col(f.name) if f.name in each.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in propose.FACTS])
    return propose.propose(facts, typing.Options(narrow=True, strict_nulls=True)).select("name", "data_type", "nullable", "precision", "timezone", "description")


@query(f"with {VALUES}, e as (select key_set, key, count(*) as f from held group by 1, 2), r as (select key_set, round(count(*) filter (f > 1) / count(*), 4) as ratio from e group by 1) select key_set, case when ratio >= 0.5 then 'Upsert' else 'ReplaceDay' end as merge from r")
def suggest_merge(spark, sf_dir):
    return keys.recurrence(order_values(spark, sf_dir), 80).select("key_set", propose.merge_of(F.col("repeat_ratio"), F.lit(80)).alias("merge"))


# --- discovery ---


def listing(spark, sf_dir) -> DataFrame:
    """Names with dates; every status is a folder, and one of them has files a week apart and undated copies."""
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    names = o.select(F.concat(F.lit("/in/"), F.col("o_orderstatus"), F.lit("/em-"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv")).alias("path"), F.timestamp_add("HOUR", F.lit(30), day.cast("timestamp")).alias("mtime")).distinct()
    weekly = o.where(F.weekday("o_orderdate") == 2).select(F.concat(F.lit("/in/W/w_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".txt")).alias("path"), F.timestamp_add("HOUR", F.lit(6), day.cast("timestamp")).alias("mtime")).distinct()
    copies = spark.createDataFrame([("/in/W/w.txt",), ("/in/O/em.csv",), ("/in/O/other.csv",)], "path string").withColumn("mtime", F.lit(None).cast("timestamp"))
    return names.unionByName(weekly).unionByName(copies).withColumn("size", F.lit(1).cast("long"))


LISTING = """listing as (select distinct '/in/' || o_orderstatus || '/em-' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' as path, o_orderdate::date as d, o_orderstatus as subset, 'em-' as prefix, '.csv' as suffix, '%Y-%m-%d' as fmt, 1 as lag from orders
  union all select distinct '/in/W/w_' || strftime(o_orderdate, '%Y%m%d') || '.txt', o_orderdate::date, 'W', 'w_', '.txt', '%Y%m%d', 0 from orders where isodow(o_orderdate) = 3)"""


@query(f"with {LISTING} select subset, fmt as date_format, prefix, suffix, count(*) as n_files, min(d) as first_date, max(d) as last_date from listing group by 1, 2, 3, 4")
def date_shapes(spark, sf_dir):
    got = discover.shaped(listing(spark, sf_dir), "/in").where(F.col("pattern").isNotNull())
    return got.groupBy("subset", "date_format", "prefix", "suffix").agg(F.count("*").alias("n_files"), F.min("business_date").alias("first_date"), F.max("business_date").alias("last_date"))


@query(f"""with {LISTING}, g as (select subset, fmt, d - lag(d) over (partition by subset, fmt order by d) as gap from (select distinct subset, fmt, d from listing))
select subset, case when count(*) < 3 then null when max(gap) <= 3 then 'daily' when min(gap) >= 6 and max(gap) <= 8 then 'weekly' when min(gap) >= 27 and max(gap) <= 32 then 'monthly' end as cadence from g group by subset""")
def cadence(spark, sf_dir):
    return discover.cadences(discover.shaped(listing(spark, sf_dir), "/in").where(F.col("pattern").isNotNull())).select("subset", "cadence")


@query(f"""with {LISTING} select subset, count(*) as files, min(lag)::int as least_lag, max(lag)::int as most_lag, 1::bigint as most_files, list_sort(list(distinct isodow(d)::int)) as weekdays from listing group by 1""")
def lag_days(spark, sf_dir):
    got = discover.groups(discover.shaped(listing(spark, sf_dir), "/in").where(F.col("pattern").isNotNull()))
    return got.select("subset", "files", "least_lag", "most_lag", "most_files", "weekdays")


@query("""select 'x.csv: no subset folder below discovery root' as caveat union all select 'O/em-2020-02-31.csv: date-shaped value ''2020-02-31'' is invalid'
union all select 'some files have missing or unparseable mtimes; schedule and lag evidence excludes them'""")
def discovery_caveats(spark, sf_dir):
    odd = spark.createDataFrame([("/in/x.csv",), ("/in/O/em-2020-02-31.csv",)], "path string").withColumns({"mtime": F.lit(None).cast("timestamp"), "size": F.lit(1).cast("long")})
    return discover.caveats(discover.shaped(listing(spark, sf_dir).unionByName(odd), "/in"))


@query("""select event_id, epoch_ms(case user_id % 4 when 0 then ts when 1 then ts when 2 then ts - interval 2 hour end)::bigint as ms from (select *, date_trunc('second', ts) as s from events) x(event_id, ts0, user_id, event_type, value, props, ts)""")
def tolerant_mtimes(spark, sf_dir):
    """Texts with Z, without a zone, two hours east, and no time at all."""
    e, at = table(spark, sf_dir, "events"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    u = F.col("user_id") % 4
    text = F.when(u == 0, F.concat(at, F.lit("Z"))).when(u == 1, at).when(u == 2, F.concat(at, F.lit("+02:00"))).otherwise(F.concat(F.lit("on "), at))
    return e.select("event_id", F.unix_millis(discover.parse_mtime(text)).alias("ms"))


@query("""select page_id, regexp_matches(path, '^in/[0-9]*[02468]\\.zip') or regexp_matches(path, '^old/') as expands from (select page_id, case when page_id % 3 = 0 then 'old/' else 'in/' end || page_id::varchar || '.zip' as path from pages)""")
def archive_patterns(spark, sf_dir):
    path = F.concat(F.when(F.col("page_id") % 3 == 0, "old/").otherwise("in/"), F.col("page_id").cast("string"), F.lit(".zip"))
    source = patterns.Patterns((r"(\d+)",), archives=(r"^in/\d*[02468]\.zip", "^old/"))
    return table(spark, sf_dir, "pages").select("page_id", source.expands(path).alias("expands"))


@query("select '^em\\.csv$' as pattern union all select '^w\\.txt$'")
def exclude_candidates(spark, sf_dir):
    return discover.exclude_candidates(discover.shaped(listing(spark, sf_dir), "/in"))


# --- streams ---


@query("select date_trunc('day', ts) as start, event_type, count(*) as n_rows from events group by 1, 2")
def volume_windows(spark, sf_dir):
    from ..streaming.arrivals import volume_stream

    return volume_stream(table(spark, sf_dir, "events"), "ts", ("event_type",))


# --- a whole profile ---

LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(
    "with v as ("
    + " union all ".join(f"select '{c}' as \"column\", {'strftime(l_shipdate, ' + chr(39) + '%Y-%m-%d' + chr(39) + ')' if c == 'l_shipdate' else c + '::decimal(18,4)::varchar' if c in ('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax') else c + '::varchar'} as value from lineitem" for c in LINE_COLUMNS)
    + r""") select "column", count(*) as "rows", count(*) filter (value is null) as nulls, count(distinct value) as n_distinct, min(length(value))::int as min_len, max(length(value))::int as max_len,
  case when bool_and(regexp_matches(value, '^-?\d+$')) then 'bigint' when bool_and(regexp_matches(value, '^-?\d+(\.\d+)?$')) then 'decimal' when bool_and(regexp_matches(value, '^\d{4}-\d{2}-\d{2}$')) then 'date' else 'text' end as kind from v group by 1"""
)
def profile_lineitem(spark, sf_dir):
    """Types, lengths, nulls and exact distinct counts of all columns of lineitem, as texts, in one pass over the melted rows."""
    decimal = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    texts_of = [F.date_format(c, "yyyy-MM-dd").alias(c) if c == "l_shipdate" else F.col(c).cast("decimal(18,4)").cast("string").alias(c) if c in decimal else F.col(c).cast("string").alias(c) for c in LINE_COLUMNS]
    melted = typing.melt(table(spark, sf_dir, "lineitem").select(F.lit("lineitem").alias("_file"), *texts_of), list(LINE_COLUMNS))
    # values are counted once; all facts come from the counted values, on their way to shapes and columns
    counted = melted.groupBy("file", "column", "value").agg(F.count("*").alias("n"))
    facts = {
        "rows": (F.sum("n"), F.sum),
        "nulls": (F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)), F.sum),
        "n_distinct": (F.count("value"), F.sum),
        "min_len": (F.min(F.char_length("value")), F.min),
        "max_len": (F.max(F.char_length("value")), F.max),
    }
    return typing.infer(counted, sums=facts).select("column", "rows", "nulls", "n_distinct", "min_len", "max_len", "kind")
