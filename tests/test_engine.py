"""Feeds in a local folder, through mirror, classification, planning, loads and profiles."""

import gzip
import io
import json
import tarfile
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schema as committed
from tidemill.alerts import Notifier, failure, findings, root_cause
from tidemill.config import Dataset, Feed, Remote, Table, coerce_option
from tidemill.operators import checks, classify, discover, merge, mirror, nest, planning
from tidemill.operators import manifest as m
from tidemill.operators.calendars import Monthly, NthWeekday, Weekdays, Weekly, Yearly
from tidemill.operators.profile import keys, propose, report, sniff, typing
from tidemill.plans.engine import Engine
from tidemill.sources import archives, patterns, readers

PATTERN = r"^EM/em-(?P<date>\d{4}-\d{2}-\d{2})\.csv(\.zip|\.gz)?$"


class Space:
    """A provider's folder and an engine on it."""

    def __init__(self, spark, tmp, **table):
        self.spark, self.tmp, self.remote = spark, tmp, tmp / "remote"
        (self.remote / "EM").mkdir(parents=True)
        self.table = Table("tw", "em", patterns.Patterns((PATTERN,)), **({"checks": (checks.WeekdayCalendar(),)} | table))
        self.dataset = Dataset(Feed("tw", Remote(), "0 7 * * *", {"EM": str(self.remote / "EM")}, exclude=r"^em\.csv$"), (self.table,), schema_dir=tmp / "schemas")

    def put(self, name, content):
        path = self.remote / "EM" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())

    @property
    def engine(self):
        return Engine(self.spark, self.dataset, str(self.tmp / "landing"), str(self.tmp / "target"), str(self.tmp / "manifest"))

    def rows(self, *columns):
        return [tuple(r) for r in self.engine.store.read().orderBy("id").select(*columns).collect()]


@pytest.fixture
def space(spark, tmp_path):
    s = Space(spark, tmp_path)
    s.put("em-2026-09-08.csv", "isin,price\nXS1,1.0\n")
    s.put("em-2026-09-09.csv", "isin,price\nXS1,2.0\nXS2,3.0\n")
    s.put("em.csv", "isin,price\nXS1,2.0\nXS2,3.0\n")
    return s


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


# --- mirror and classification ---


def test_sync(space):
    first = space.engine.sync()
    assert (first.downloaded, first.ignored, first.assigned) == (2, 1, 2)
    assert space.rows("path", "status", "business_date") == [("EM/em-2026-09-08.csv", "downloaded", date(2026, 9, 8)), ("EM/em-2026-09-09.csv", "downloaded", date(2026, 9, 9)), ("EM/em.csv", "ignored", None)]
    assert (space.tmp / "landing/tw/EM/em-2026-09-08.csv").read_bytes() == (space.remote / "EM/em-2026-09-08.csv").read_bytes()
    again = space.engine.sync()
    assert (again.downloaded, again.revisions, again.unchanged) == (0, 0, 3)


def test_listing_by_fsspec(spark, tmp_path, monkeypatch):
    """With a stand-in for the package, as it may not be installed."""
    import sys
    import types

    class Store:
        def find(self, root, maxdepth=None, detail=True):
            return {"/out/a.csv": {"type": "file", "name": "/out/a.csv", "size": 3, "mtime": 60.7}, "/out/d": {"type": "directory", "name": "/out/d"}}

    module = types.ModuleType("fsspec")
    module.filesystem = lambda protocol, **options: Store()
    monkeypatch.setitem(sys.modules, "fsspec", module)
    got = mirror.listing_by_fsspec(spark, "sftp", {"host": "h"}, {"EM": "/out/"}, 1).collect()
    assert [tuple(r) for r in got] == [("EM", "sftp:///out/a.csv", "EM/a.csv", "1970-01-01T00:01:00+00:00", 3)]


def test_revision_and_late_file(space):
    space.engine.sync()
    space.put("em-2026-09-08.csv", "isin,price\nXS1,1.5\nXS9,9.0\n")
    space.put("em-2026-09-07.csv", "isin,price\nXS1,0.5\n")
    r = space.engine.sync()
    assert (r.downloaded, r.revisions) == (1, 1)
    assert (space.tmp / "landing/tw/EM/em-2026-09-08.csv.v2").exists()
    assert {(p, v, s) for p, v, s in space.rows("path", "version", "status") if "09-08" in p} == {("EM/em-2026-09-08.csv", 1, "superseded"), ("EM/em-2026-09-08.csv", 2, "downloaded")}
    runs = space.engine.plan(space.table)
    assert [(r["start"], r["end"]) for r in runs] == [(date(2026, 9, 7), date(2026, 9, 9))]


def test_archive_members(space):
    space.engine.sync()
    source = patterns.Patterns((r"^EM/em-(?P<date>\d{4}-\d{2}-\d{2})\.csv$",), archives=(r"all-\d+\.zip$",))
    space.dataset = Dataset(space.dataset.feed, (space.table.with_source(source),), schema_dir=space.dataset.schema_dir)
    space.put("all-2026.zip", zipped(**{"em-2026-09-07.csv": "isin,price\nXS1,0.5\n", "em-2026-09-08.csv": "isin,price\nXS1,1.0\n", "em-2026-09-09.csv": "isin,price\nXS1,7.0\n"}))
    space.engine.sync()
    got = {(p, s) for p, s in space.rows("path", "status")}
    assert {("EM/all-2026.zip", "expanded"), ("EM/all-2026.zip!em-2026-09-07.csv", "downloaded"), ("EM/all-2026.zip!em-2026-09-08.csv", "duplicate"), ("EM/all-2026.zip!em-2026-09-09.csv", "downloaded"), ("EM/em-2026-09-09.csv", "superseded")} <= got
    result = space.engine.load(space.engine.table("em"), date(2026, 9, 7), date(2026, 9, 10))
    assert result.rows == 3 and result.details["files"] == 3
    assert {(r["price"], r["_business_date"].day) for r in space.engine.target("em").collect()} == {(0.5, 7), (1.0, 8), (7.0, 9)}


def test_ambiguous(space):
    other = Table("tw", "other", patterns.Patterns((r"em-(?P<date>\d{4}-\d{2}-09)",)))
    space.dataset = Dataset(space.dataset.feed, (space.table, other), schema_dir=space.dataset.schema_dir)
    with pytest.raises(classify.AmbiguousMatch, match="em-2026-09-09"):
        space.engine.sync()
    assert {p: t for p, t in space.rows("path", "table")} == {"EM/em-2026-09-08.csv": "tw/em", "EM/em-2026-09-09.csv": None, "EM/em.csv": None}


def fold(rows, policy):
    """Collisions one by one."""
    active, out = None, {}
    for i, sha in rows:
        if active is None:
            active, out[i] = (i, sha), "downloaded"
        elif active[1] == sha:
            out[i] = "duplicate"
        elif policy == "first":
            out[i] = "superseded"
        else:
            out[active[0]], out[i], active = "superseded", "downloaded", (i, sha)
    return out


@pytest.mark.parametrize("policy", ["latest", "first"])
def test_collisions_match_a_fold(spark, policy):
    import random

    r = random.Random(5)
    rows = [(i, f"k{r.randrange(40)}", r.choice("abc"), policy) for i in range(600)]
    got = {x["id"]: x["status"] for x in classify.resolve(spark.createDataFrame(rows, "id long, identity string, sha256 string, on_collision string")).collect()}
    want = {}
    for k in {x[1] for x in rows}:
        want |= fold([(i, s) for i, key, s, _ in rows if key == k], policy)
    assert got == want


def test_patterns(spark):
    def one(source, path):
        return spark.createDataFrame([(path,)], "p string").select(source.classify(F.col("p")).alias("c")).first()["c"]

    p = patterns.Patterns((r"^a/(?P<region>\w+)/x-(?P<date>\d{6})(?P<part>_\d)?\.csv$",), ignore=(r"tmp",), date_format="%Y%m")
    got = one(p, "a/apac/x-202609.csv")
    assert got["business_date"] == date(2026, 9, 1) and got["attributes"] == {"region": "apac", "part": None} and got["identity"] == "a|x-202609.csv|2026-09-01|part=None|region=apac"
    assert one(p, "a/tmp/x-202609.csv") is None and one(p, "b") is None and p.attribute_names == ("part", "region")
    with pytest.raises(Exception, match="(?i)pars"):
        one(p, "a/apac/x-202699.csv")
    with pytest.raises(ValueError, match="named date"):
        patterns.Patterns((r"x(?P<region>\w)",))
    f = patterns.FunctionSource(lambda path: (date(2026, 1, 1), {"k": path[:1]}, path) if "ok" in path else None, ("k",))
    assert one(f, "ok/1")["attributes"] == {"k": "o"} and one(f, "no") is None


def test_ops(space):
    e = space.engine
    e.sync()
    e.load(space.table, date(2026, 9, 8), date(2026, 9, 10))
    assert e.plan(space.table) == []
    files, n = m.reload(e.store.read(), "tw/em", date(2026, 9, 9))
    e.store.write(files)
    assert n == 1 and [r["start"] for r in e.plan(space.table)] == [date(2026, 9, 9)]
    e.store.write(m.ignore(e.store.read(), [2]))
    assert e.plan(space.table) == []
    files, n = m.reclassify(e.store.read(), "tw/em")
    e.store.write(files)
    assert n == 1 and e.classify() == 1 and [r["start"] for r in e.plan(space.table)] == [date(2026, 9, 8)]


# --- loads ---


def test_reload_is_idempotent(space):
    e = space.engine
    e.sync()
    for _ in range(2):
        e.load(space.table, date(2026, 9, 8), date(2026, 9, 10), "run")
    got = {(r["isin"], r["price"], str(r["_business_date"]), r["_subset"], r["_source_file"], r["_load_id"]) for r in e.target("em").collect()}
    assert got == {("XS1", 1.0, "2026-09-08", "EM", 1, "run"), ("XS1", 2.0, "2026-09-09", "EM", 2, "run"), ("XS2", 3.0, "2026-09-09", "EM", 2, "run")} and e.target("em").count() == 3
    assert e.load(space.table, date(2020, 1, 1)).rows == 0 and e.target("em").count() == 3


def test_lists_go_and_come_with_their_parents(spark, tmp_path):
    """Under a keyed merge: rows of replaced parents go, and those of rows that lose to one with the same key don't come."""
    root = f"file://{tmp_path}"
    w = merge.Writer(merge.Upsert(("k",)))

    def load(file, *rows):
        schema = "k long, a struct<items: array<struct<n: long, tags: array<string>>>>, _source_file long, _position long"
        return w.write(spark.createDataFrame([(k, ([(n, [f"t{n}"]) for n in items],), file, i) for i, (k, items) in enumerate(rows)], schema), root, "t")

    held = lambda name, c: sorted(r[c] for r in w.current(spark, root, name).collect())
    load(1, (1, [10, 11]), (2, [12]))
    assert held("t__a__items", "n") == [10, 11, 12]
    load(2, (1, [20]), (3, [30]), (3, [31]))
    assert held("t", "k") == [1, 2, 3] and held("t__a__items", "n") == [12, 20, 31] and held("t__a__items__tags", "value") == ["t12", "t20", "t31"]
    load(3, (1, []))
    assert held("t__a__items", "n") == [12, 31]
    # a load without lists takes away those of the rows that it replaces
    w.write(spark.createDataFrame([(3, 4, 0)], "k long, _source_file long, _position long"), root, "t")
    assert held("t", "k") == [1, 2, 3] and held("t__a__items", "n") == [12] and held("t__a__items__tags", "value") == ["t12"]
    ids = {r["_row_id"] for r in w.current(spark, root, "t").collect()}
    assert {r["_parent_id"] for r in w.current(spark, root, "t__a__items").collect()} <= ids
    # two states are kept, and no stage
    assert len(list((tmp_path / "t").glob("snapshot-*"))) == 2 and not list((tmp_path / "t").glob("stage-*"))


def test_a_load_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    w = merge.Writer(merge.Upsert(("k",)))
    row = lambda k, n: spark.createDataFrame([(k, [n], 1, 0)], "k long, items array<long>, _source_file long, _position long")
    w.write(row(1, 1), root, "t")
    add = merge.Records.add
    monkeypatch.setattr(merge.Records, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        w.write(row(1, 2), root, "t")
    monkeypatch.setattr(merge.Records, "add", add)
    values = lambda: [r["value"] for r in w.current(spark, root, "t__items").collect()]
    assert values() == [1]
    (tmp_path / "t/records/v=2").mkdir()  # a record that was begun
    assert values() == [1]
    w.write(row(1, 3), root, "t")
    assert values() == [3] and w.current(spark, root, "t").count() == 1


def test_days_without_lists_any_more(spark, tmp_path):
    root, w = f"file://{tmp_path}", merge.Writer()
    row = lambda items: spark.createDataFrame([(date(2026, 1, 5), 1, items, 1, 0)], "_business_date date, k long, items array<long>, _source_file long, _position long")
    w.write(row([1, 2]), root, "t", metadata=("_business_date",))
    assert w.current(spark, root, "t__items").count() == 2
    w.write(row([1]).drop("items"), root, "t", metadata=("_business_date",))
    assert w.current(spark, root, "t__items") is None and w.current(spark, root, "t").count() == 1


def test_upsert(spark, tmp_path):
    s = Space(spark, tmp_path, writer=merge.Writer(merge.Upsert(("isin",))))
    s.put("em-2026-09-08.csv", "isin,price\nXS1,1.0\nXS7,7.0\n")
    s.put("em-2026-09-09.csv", "isin,price\nXS1,2.0\n")
    s.engine.sync()
    s.engine.load(s.table, date(2026, 9, 8), date(2026, 9, 10))
    assert {(r["isin"], r["price"]) for r in s.engine.target("em").collect()} == {("XS1", 2.0), ("XS7", 7.0)}
    s.put("em-2026-09-10.csv", "isin,price\nXS7,8.0\nXS8,1.0\n")
    s.engine.sync()
    s.engine.load(s.table, date(2026, 9, 10))
    assert {(r["isin"], r["price"]) for r in s.engine.target("em").collect()} == {("XS1", 2.0), ("XS7", 8.0), ("XS8", 1.0)}


def test_nested_json(spark, tmp_path):
    lines = [{"isin": "XS1", "issuer": {"name": "A", "country": "FR"}, "coupons": [{"date": "d1", "amt": 1.5}, {"date": "d2", "amt": 2.5}]}, {"isin": "XS2", "issuer": {"name": "B", "country": "DE"}, "coupons": []}]
    s = Space(spark, tmp_path, reader=readers.JsonReader())
    s.put("em-2026-09-08.csv", "\n".join(map(json.dumps, lines)) + "\n\n")
    s.engine.sync()
    for _ in range(2):
        s.engine.load(s.table, date(2026, 9, 8))
    assert {(r["isin"], r["issuer__name"], r["issuer__country"]) for r in s.engine.target("em").collect()} == {("XS1", "A", "FR"), ("XS2", "B", "DE")}
    child = s.engine.target("em__coupons").orderBy("_list_idx").collect()
    assert [(r["date"], r["amt"], r["_list_idx"]) for r in child] == [("d1", 1.5, 0), ("d2", 2.5, 1)]
    parent = {r["isin"]: r["_row_id"] for r in s.engine.target("em").collect()}
    assert {r["_parent_id"] for r in child} == {parent["XS1"]}
    flat = nest.denest(spark.createDataFrame([(1, [(1, [2, 3])])], "a int, b array<struct<x int, y array<int>>>"), "t")
    assert set(flat) == {"t", "t__b", "t__b__y"}
    assert set(nest.denest(spark.createDataFrame([(1, [(1, [2, 3])])], "a int, b array<struct<x int, y array<int>>>"), "t", 1)) == {"t", "t__b"}


def test_contract(spark, tmp_path):
    s = Space(spark, tmp_path, reader=readers.JsonReader())
    s.put("em-2026-09-08.csv", '{"isin": "XS1", "price": 1.5}')
    s.engine.sync()
    s.engine.load(s.table, date(2026, 9, 8))
    committed.write_schema(s.dataset, {"em": {"columns": {"isin": {"data_type": "text"}, "price": {"data_type": "double"}}}})
    s.put("em-2026-09-09.csv", '{"isin": "XS2", "price": 2.5, "currency": "EUR"}')
    s.engine.sync()
    assert s.engine.load(s.table, date(2026, 9, 9)).details["new_columns"] == ["currency"]
    s.put("em-2026-09-10.csv", '{"isin": "XS3", "price": "high"}')
    s.engine.sync()
    with pytest.raises(Exception, match="(?i)cast"):
        s.engine.load(s.table, date(2026, 9, 10))
    assert {(r["isin"], r["price"], r["currency"]) for r in s.engine.target("em").collect()} == {("XS1", 1.5, None), ("XS2", 2.5, "EUR")}
    with pytest.raises(merge.ContractError):
        merge.check_contract(T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("a", T.StringType())]))


@pytest.mark.parametrize("upsert", [False, True])
def test_jdbc(spark, tmp_path, upsert):
    from tidemill.operators.jdbc import JdbcWriter

    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    writer = JdbcWriter(url, merge.Upsert(("isin",)) if upsert else merge.ReplaceDay(), properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    s = Space(spark, tmp_path, reader=readers.JsonReader(), writer=writer)
    s.put("em-2026-09-08.csv", '{"isin": "XS1", "price": 1.5, "c": [{"x": 1}, {"x": 2}]}\n{"isin": "XS2", "price": 2.5, "c": [{"x": 3}]}')
    s.engine.sync()
    for _ in range(2):
        assert s.engine.load(s.table, date(2026, 9, 8)).rows == 5
    s.put("em-2026-09-09.csv", '{"isin": "XS1", "price": 9.5, "more": "m", "c": [{"x": 7}]}')
    s.engine.sync()
    s.engine.load(s.table, date(2026, 9, 9))
    rows = {(r["isin"], r["price"], r["more"]) for r in s.engine.target("em").collect()}
    xs = sorted(r["x"] for r in s.engine.target("em__c").collect())
    assert rows == {("XS1", 9.5, "m"), ("XS2", 2.5, None)} | (set() if upsert else {("XS1", 1.5, None)})
    assert xs == ([3, 7] if upsert else [1, 2, 3, 7])
    s.put("em-2026-09-10.csv", '{"isin": 5, "price": 1.5, "c": []}')
    s.engine.sync()
    with pytest.raises(merge.ContractError):
        s.engine.load(s.table, date(2026, 9, 10))
    assert s.engine.target("em").count() == len(rows)


# --- readers ---


def read(spark, tmp_path, reader, files, types=None):
    rows = []
    for i, (name, content, *member) in enumerate(files):
        (tmp_path / name).write_bytes(content if isinstance(content, bytes) else content.encode())
        rows.append((i, str(tmp_path / name), member[0] if member else None))
    got = reader.read(spark.createDataFrame(rows, "file_id long, path string, member string"), types)
    return got.orderBy("_source_file", "_position").drop("_position").collect()


def test_csv_dialect(spark, tmp_path):
    got = read(spark, tmp_path, readers.CsvReader(delimiter=";", skip_rows=2), [("a.csv", "made by x\n\nisin;price\nXS1;1.5\nNA;2\n"), ("b.csv", "made by x\n\nprice;isin;more\n3;XS3;x\n")])
    assert [(r["isin"], r["price"], r["more"], r["_source_file"]) for r in got] == [("XS1", 1.5, None, 0), (None, 2.0, None, 0), ("XS3", 3.0, "x", 1)]


def test_csv_types(spark, tmp_path):
    kinds = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.DecimalType(5, 2)), T.StructField("d", T.DateType()), T.StructField("t", T.TimestampNTZType())])
    reader = readers.CsvReader(newlines_in_values=True, null_values=("-",), date_formats=("%Y%m%d", "%d/%m/%Y %H:%M"))
    r = read(spark, tmp_path, reader, [("a.csv", 'id,price,d,t,note\n007,1.50,20260908,08/09/2026 10:30,"a\nb"\n')], kinds)[0]
    assert (r["id"], str(r["price"]), r["d"], r["t"], r["note"]) == ("007", "1.50", date(2026, 9, 8), datetime(2026, 9, 8, 10, 30), "a\nb")
    assert [r["id"] for r in read(spark, tmp_path, readers.CsvReader(), [("b.csv", "id\n007\n")], "string")] == ["007"]


ODD_VALUES = ("1", " 1 ", "007", "-0", "+5", "99999999999999999999", "1.50", " 2.5", "1e3", ".5", "5.", "1,000", "true", "TRUE", "yes", "NaN", "NA", "-", "2026-09-08", "2026-9-8", "20260908", "2026-09-08 10:30", "2026-09-08T10:30:00Z", "10:30", "x", "é")


@pytest.mark.parametrize(("delimiter", "options"), [(",", {}), (";", {"quote_char": None}), ("|", {"null_values": ("-",), "strings_can_be_null": False}), ("\t", {"date_formats": ("%Y%m%d",), "column_names": tuple(f"n{i}" for i in range(len(ODD_VALUES)))})])
def test_both_ways_of_reading_text_agree(spark, tmp_path, monkeypatch, delimiter, options):
    """Spark's own reader, and tasks that read whole files: the same columns, types and rows, whatever the size. Each value has a column."""
    values = [f'"{v}"' if delimiter in v else v for v in ODD_VALUES]
    head = "" if "column_names" in options else delimiter.join(f"n{i}" for i in range(len(values))) + "\n"
    files = [("all.csv", head + (delimiter.join(values) + "\n") * 2)]
    reader = readers.CsvReader(delimiter=delimiter, **options)
    for types in ("string", None):
        split = read(spark, tmp_path, reader, files, types)
        with monkeypatch.context() as m:
            m.setattr(readers.CsvReader, "splits", lambda self: False)
            whole = read(spark, tmp_path, reader, files, types)
        assert [r.asDict() for r in split] == [r.asDict() for r in whole] and len(split) == 2


def test_types_are_inferred_from_all_values(spark, tmp_path):
    files = [("a.csv", "id,price,d,flag,note,t\n1,1.5,2026-09-08,true,x,2026-09-08 10:30:00\n2,NA,2026-09-09,false,,\n"), ("b.csv", "price,id,more\n3,007,x\n")]
    rows = read(spark, tmp_path, readers.CsvReader(), files)
    assert [(r["id"], r["price"], r["d"], r["flag"], r["more"]) for r in rows] == [(1, 1.5, date(2026, 9, 8), True, None), (2, None, date(2026, 9, 9), False, None), (7, 3.0, None, None, "x")]


def test_first_rows_end_the_reading(spark, tmp_path):
    """What comes after the rows that are asked for isn't parsed."""
    line = '{"a": %d}'
    cases = [(readers.CsvReader(), "a.csv", "a\n" + "".join(f"{i}\n" for i in range(20)) + "x,y,z\n"), (readers.CsvReader(block_size=16), "b.csv.v2", "a\n" + "".join(f"{i}\n" for i in range(20)) + "x,y,z\n"), (readers.JsonReader(), "c.json", "\n".join(line % i for i in range(20)) + "\n{broken")]
    for reader, name, text in cases[1:]:
        path = tmp_path / name
        path.write_text(text)
        files = spark.createDataFrame([(1, f"file://{path}", None)], "file_id long, path string, member string")
        assert sorted(int(r["a"]) for r in readers.first_rows(reader, files, "string", 3).collect()) == [0, 1, 2], name


def test_xml_of_archives_and_later_versions(spark, tmp_path):
    import zipfile

    page = "<t><r><a>%d</a></r></t>"
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.xml", page % 1)
        z.writestr("n.xml", page % 2)
    (tmp_path / "x.xml").write_text(page % 3)
    (tmp_path / "x.xml.v2").write_text(page % 4)
    files = spark.createDataFrame([(1, f"file://{tmp_path}/z.zip", "n.xml"), (2, f"file://{tmp_path}/x.xml", None), (3, f"file://{tmp_path}/x.xml.v2", None)], "file_id long, path string, member string")
    got = readers.XmlReader("r").read(files).select("_source_file", "a").collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 3), (3, 4)]


def test_formats(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "p.parquet")
    data = (tmp_path / "p.parquet").read_bytes()
    assert [r["a"] for r in read(spark, tmp_path, readers.ParquetReader(), [("p.parquet", data)])] == [1, 2]
    assert [r["a"] for r in read(spark, tmp_path, readers.ParquetReader(), [("p.parquet.v2", data)])] == [1, 2]
    for i, text in enumerate(('{"a": 1}\n\n{"a": 2}\n', ' [{"a": 1},\n {"a": 2}]')):
        for name in (f"j{i}.json", f"j{i}.json.v2"):
            assert [r["a"] for r in read(spark, tmp_path, readers.JsonReader(), [(name, text)])] == [1, 2]
    assert [r["a"] for r in read(spark, tmp_path, readers.FunctionReader(lambda s: [[{"a": len(s.read())}]]), [("f.txt", "xyz")])] == [3]
    assert sorted(r["a"] for r in read(spark, tmp_path, readers.XmlReader("r"), [("x.xml", "<t><r><a>1</a></r><r><a>2</a></r></t>")])) == [1, 2]


def test_archives(spark, tmp_path):
    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as t:
        for name in ("b.csv", "a.csv"):
            info = tarfile.TarInfo(name)
            info.size = 4
            t.addfile(info, io.BytesIO(f"x\n{ord(name[0]) % 10}\n".encode()))
    z = zipped(**{"m.csv": "x\n1\n", "n.csv": "x\n2\n"})
    got = read(spark, tmp_path, readers.CsvReader(), [("a.zip", z), ("b.zip", z, "n.csv"), ("c.tar.gz", tar.getvalue()), ("d.csv.gz", gzip.compress(b"x\n5\n")), ("e.csv.gz.v2", gzip.compress(b"x\n6\n")), ("_f.csv", "x\n7\n")])
    assert [r["x"] for r in got] == [1, 2, 2, 7, 8, 5, 6, 7]
    members = archives.list_members(spark.createDataFrame([(9, str(tmp_path / "a.zip"))], "id long, local_path string")).collect()
    assert [(r["parent_id"], r["member"], r["member_size"]) for r in members] == [(9, "m.csv", 4), (9, "n.csv", 4)]
    assert archives.archive_kind("x.tgz.v3") == "tar" and archives.archive_kind("x.csv.gz") is None


# --- calendars, checks, runs ---


def test_no_guess_at_sessions(spark):
    with pytest.raises(ValueError, match="no sessions of XLON"):
        checks.Exchange().days(spark, date(2026, 9, 1), date(2026, 9, 9))


def test_calendars(spark):
    days = lambda c, a, b: [r["d"].day for r in c.days(spark, a, b).orderBy("d").collect()]
    assert days(Weekdays((date(2026, 9, 8),)), date(2026, 9, 4), date(2026, 9, 9)) == [4, 7, 9]
    assert days(Weekly(0), date(2026, 9, 1), date(2026, 9, 30)) == [7, 14, 21, 28]
    assert days(NthWeekday((1, 3), 5), date(2026, 9, 1), date(2026, 9, 30)) == [5, 19]
    assert days(Monthly(31), date(2026, 1, 1), date(2026, 4, 30)) == [31, 31]
    assert days(Yearly(2, 1), date(2025, 2, 2), date(2027, 3, 1)) == [1, 1]


def test_delivery(spark, space):
    e = space.engine
    e.sync()
    check = checks.WeekdayCalendar().with_files(exactly=1)
    ctx = checks.CheckContext(spark, e.store.read(), space.table, date(2026, 9, 10))
    few = checks.Delivery(Weekdays(), occurrences=2, min_files=1, max_files=1)
    assert few.evaluate(ctx).passed
    late = few.evaluate(checks.CheckContext(spark, e.store.read(), space.table, date(2026, 9, 11)))
    assert (late.passed, late.severity, late.metadata) == (False, "WARN", {"violations": {"2026-09-10": 0}})
    old = check.evaluate(ctx)
    assert not old.passed and old.severity == "ERROR" and len(old.metadata["violations"]) == 3
    assert checks.Delivery(Yearly(1, 1), lag_days=1000).evaluate(ctx).passed is False
    alerts = list(findings("tw/em", {"a": late, "b": old}, ["c"]))
    assert [a.subject for a in alerts] == ["[tidemill] 1 failed checks of tw/em", "[tidemill] new columns in tw/em"]
    mail = Notifier(recipients="a@b.example, c@d.example").message(failure("x", ValueError("why")))
    assert (mail["To"], mail["Subject"], mail.get_content().strip()) == ("a@b.example, c@d.example", "[tidemill] failed: x", "why")


def test_root_cause():
    try:
        try:
            raise KeyError("deep")
        except KeyError as e:
            raise RuntimeError("top") from e
    except RuntimeError as e:
        assert root_cause(e) == "'deep'"


def test_runs(spark):
    days = spark.createDataFrame([(date(2026, 1, d), d) for d in (1, 2, 3, 5, 6, 7, 8, 20)], "business_date date, newest_id long")
    got = [(r["start"].day, r["end"].day, r["newest_id"]) for r in planning.Daily(max_per_run=3).runs(days).orderBy("start").collect()]
    assert got == [(1, 3, 3), (5, 7, 7), (8, 8, 8), (20, 20, 20)]
    assert [r["start"] for r in planning.Weekly("2025-12-01").runs(days).collect()] and planning.Weekly().window(date(2026, 1, 4), date(2026, 1, 11)) == (date(2026, 1, 4), date(2026, 1, 18))
    key = spark.createDataFrame([(date(2026, 9, 9),)], "d date").select(planning.partition_key(F.col("d"), "week").alias("k")).first()["k"]
    assert key == date(2026, 9, 6)
    assert planning.Monthly().window(date(2026, 11, 1), date(2026, 12, 1)) == (date(2026, 11, 1), date(2027, 1, 1))


def test_config():
    with pytest.raises(ValueError, match="name of a folder"):
        Feed("f", Remote(), "", {"a/b": "/x"})
    t = Table("f", "t", patterns.Patterns((r"(\d+)",)))
    assert t.with_expectation(None).checks == () and t.key == "f/t"
    with pytest.raises(ValueError, match="several checks are named delivery"):
        t.with_check(checks.Delivery())
    with pytest.raises(ValueError, match="another feed"):
        Dataset(Feed("g", Remote(), "", {"a": "/x"}), (t,))
    assert [coerce_option(x) for x in ("22", "true", "x")] == [22, True, "x"]
    assert mirror.modification_time({"mtime": 0.5}) == "1970-01-01T00:00:00+00:00" and mirror.modification_time({}) is None


def test_run_end_to_end(space):
    results = space.engine.run(date(2026, 9, 10))
    assert [r.rows for r in results.values()] == [3] and list(results) == ["tw/em/2026-09-08/2026-09-09/2"]
    assert space.engine.run(date(2026, 9, 10)) == {}


# --- profile ---


def profiled(spark, tmp_path, files, options=typing.Options(), reader=readers.CsvReader(), **table):
    s = Space(spark, tmp_path, reader=reader, **table)
    for day, text in files:
        s.put(f"em-2026-09-{day:02}.csv", text)
    s.engine.sync()
    rows = m.files_for(s.engine.store.read(), "tw/em", date.min, date.max).collect()
    return (*report.profile(spark, s.dataset, s.table, rows, options), s)


def test_profile_types(spark, tmp_path):
    text = "id,qty,price,as_of,ts,flag,note,big,blank\n007,1,10.25,2026-09-08,2026-09-08T10:00:00.123Z,true,a,\"1,000\",\n008,2,3.125,2026-09-09,2026-09-09T11:00:00.000Z,FALSE,,\"2,000\",\n"
    got, schema, s = profiled(spark, tmp_path, [(8, text)], typing.Options(decimals=True))
    c = got["tables"]["em"]["columns"]
    kinds = {n: x["proposed"]["data_type"] for n, x in c.items()}
    assert kinds == {"id": "text", "qty": "bigint", "price": "decimal", "as_of": "date", "ts": "timestamp", "flag": "bool", "note": "text", "big": "text", "blank": "text"}
    assert c["id"]["proposed"]["precision"] == 3 and c["id"]["proposed"]["description"] == "leading zeros"
    assert (c["price"]["proposed"]["precision"], c["price"]["proposed"]["scale"]) == (7, 3)
    assert c["ts"]["proposed"]["timezone"] is True and c["ts"]["proposed"]["precision"] == 3
    assert c["price"]["kinds"] == {"decimal": 2} and c["note"]["kinds"] == {"text": 1}
    assert c["note"]["nulls"] == 1 and c["blank"]["proposed"]["description"] == "there were no values"
    assert c["price"]["numeric"]["histogram"]["counts"] == [1, 0, 0, 0, 0, 0, 0, 0, 0, 1] and c["as_of"]["temporal"]["min"] == "2026-09-08"
    committed.write_schema(s.dataset, schema)
    assert committed.committed_types(s.dataset, "em")["price"].dataType == T.DecimalType(7, 3)
    report.write_report(got, s.dataset, s.table)
    assert report.load_report(s.dataset, s.table)["version"] == 1 and "em: 2 rows" in report.summary(got)
    assert s.engine.load(s.table, date(2026, 9, 8)).rows == 2 and s.engine.target("em").schema["id"].dataType == T.StringType()


def test_profile_keys(spark, tmp_path):
    files = [(8, "isin,leg,px\nA,1,1\nA,2,1\nB,1,1\n"), (9, "isin,leg,px\nA,1,1\nA,2,1\nC,1,1\nC,2,1\n")]
    got, _, _ = profiled(spark, tmp_path, files)
    k = got["tables"]["em"]["keys"]
    assert k["candidates"][0]["columns"] == ["isin", "leg"] and k["candidates"][0]["repeat_ratio"] == 0.4 and len(k["candidates"]) == 1
    assert [x.get("new") for x in k["candidates"][0]["churn"]] == [None, 2] and k["candidates"][0]["churn"][1]["dropped"] == 1
    assert got["tables"]["em"]["suggested"]["merge"] == "ReplaceDay" and k["candidate_columns"] == ["isin", "leg", "px"]
    assert got["tables"]["em"]["volume"]["rows_per_file"] == {"min": 3, "max": 4, "mean": 3.5, "n": 2}


def test_profile_quirks(spark, tmp_path):
    text = 'a,b\n" x","a\nb"\n-,""""""\né,007\n'
    got, _, _ = profiled(spark, tmp_path, [(8, text)], reader=readers.CsvReader(newlines_in_values=True))
    c = got["tables"]["em"]["columns"]
    assert c["a"]["text"]["flags"] == {"non_ascii": 1, "surrounding_whitespace": 1} and c["a"]["text"]["null_like"] == {"-": 1}
    assert c["b"]["text"]["flags"]["newline"] == 1 and c["b"]["text"]["flags"]["leading_zeros"] == 1
    assert got["files"][0]["csv"]["lines_with_odd_quotes"] == 2 if "csv" in got["files"][0] else True


def test_profile_nested(spark, tmp_path):
    lines = [{"isin": f"XS{i}", "issuer": {"name": "A"}, "coupons": [{"on": "2026-01-01", "amt": i + 0.5}]} for i in range(3)]
    got, schema, _ = profiled(spark, tmp_path, [(8, "\n".join(map(json.dumps, lines)))], reader=readers.JsonReader())
    assert set(schema) == {"em", "em__coupons"} and schema["em__coupons"]["parent"] == "em"
    assert schema["em__coupons"]["columns"]["on"]["data_type"] == "date" and schema["em"]["columns"]["issuer__name"]["data_type"] == "text"


def test_tries_locks_and_sensor(spark, tmp_path):
    from tidemill.plans import engine as plans

    tried, waits = [], []

    def fails(times):
        tried.append(1)
        if len(tried) <= times:
            raise OSError("away")
        return "done"

    assert plans.Again(2, 120)("x", lambda: fails(2), waits.append) == "done" and waits == [120, 120]
    tried.clear()
    with pytest.raises(OSError):
        plans.Again(1, 60)("x", lambda: fails(9), waits.append)
    assert len(tried) == 2
    lock = plans.Lock(spark, f"file://{tmp_path}/f.lock")
    with lock.held():
        with pytest.raises(plans.Busy):
            plans.Lock(spark, f"file://{tmp_path}/f.lock").take()
    plans.Lock(spark, f"file://{tmp_path}/f.lock").take()  # free again
    plans.Lock(spark, f"file://{tmp_path}/f.lock", stale=-1).take()  # left behind
    now, pending = [0.0], [{"run_key": "a"}]
    planned = type("E", (), {"dataset": type("D", (), {"tables": ("t",)}), "plan": lambda self, t: list(pending)})()
    sensor = plans.Sensor(planned, interval=1, clock=lambda: now[0])
    assert [r["run_key"] for _, r in sensor.look()] == ["a"]
    pending.append({"run_key": "b"})
    now[0] = 299
    assert sensor.look() == []
    now[0] = 300
    assert [r["run_key"] for _, r in sensor.look()] == ["b"]
    with pytest.raises(ValueError, match="TIDEMILL_TARGET"):
        plans.engine_from(spark, Dataset(Feed("g", Remote(), "", {"a": "/x"})), {"TIDEMILL_LANDING": "/a"})
    made = plans.engine_from(spark, Dataset(Feed("g", Remote(), "", {"a": "/x"})), {f"TIDEMILL_{k}": f"file://{tmp_path}/{k}" for k in ("LANDING", "TARGET", "MANIFEST")} | {"TIDEMILL_SMTP_HOST": "mail", "TIDEMILL_SMTP_TO": "a@b.example"})
    assert made.notifier.server.host == "mail" and made.notifier.recipients == "a@b.example"


def test_propose_sizes(spark):
    def of(*facts, **options):
        rows = [{"name": str(i), "rows": 2, "nulls": 0, "reasons": [], "declared": [], "int_digits": 0, "frac_digits": 0, "zoned": False, "fraction_digits": 0, "varied": False} | f for i, f in enumerate(facts)]
        made = propose.propose(spark.createDataFrame(rows, propose.FACTS), typing.Options(**options)).collect()
        return [propose.Column(**r.asDict()) for r in sorted(made, key=lambda r: int(r["name"]))]

    narrow = of({"kinds": ["bigint"], "min": -5.0, "max": 300.0}, {"kinds": ["bigint"], "min": 0.0, "max": 1e5}, {"kinds": ["bigint"], "min": 0.0, "max": 2.0**40}, {"kinds": ["bigint"]}, narrow=True)
    assert [c.precision for c in narrow] == [16, 32, None, None] and {c.data_type for c in narrow} == {"bigint"}
    text = of({"kinds": ["text"], "min_len": 12, "max_len": 12, "varied": True}, {"kinds": ["text"], "min_len": 1, "max_len": 80}, {"kinds": ["text"], "min_len": 1, "max_len": 5000}, {"kinds": []}, {"kinds": ["bigint", "text"], "min_len": 1, "max_len": 2})
    assert [c.precision for c in text] == [12, 255, None, None, 20] and {c.data_type for c in text} == {"text"}
    assert [c.description for c in text[3:]] == ["there were no values", "no type holds all of: bigint, text"]
    number = {"kinds": ["bigint", "decimal"], "int_digits": 3, "frac_digits": 2, "reasons": ["b", "a"]}
    assert of(number)[0].to_dict() == {"name": "0", "data_type": "double", "nullable": True, "description": "would fit decimal(7,2), see --decimals"}
    assert of(number, decimals=True, strict_nulls=True)[0].to_dict() == {"name": "0", "data_type": "decimal", "nullable": False, "precision": 7, "scale": 2, "description": "a / b"}
    times = of(*[{"kinds": ["date", "timestamp"], "zoned": n > 3, "fraction_digits": n} for n in (0, 3, 5, 6)])
    assert [(c.data_type, c.precision, c.timezone) for c in times] == [("timestamp", None, False), ("timestamp", 3, False), ("timestamp", 7, True), ("timestamp", 6, True)]
    small, wide, day = ({"data_type": "bigint", "precision": 8}, {"data_type": "bigint", "precision": 32}, {"data_type": "date"})
    files = of({"kinds": ["bigint"], "declared": [small, wide]}, {"kinds": ["bigint", "date"], "declared": [small, day]}, {"kinds": ["bigint", "text"], "declared": [small]}, {"kinds": [], "declared": [day]}, keys=("0",))
    assert [(c.data_type, c.precision, c.nullable) for c in files] == [("bigint", 32, False), ("text", None, True), ("text", 20, True), ("date", None, True)]
    assert files[1].description == "files differ in type: bigint, date"
    assert [propose.suggest_merge(*x)["merge"] for x in (([], 3), ([(["a"], 0.9)], 3), ([(["a"], 0.1)], 3), ([(["a"], None)], 1))] == ["ReplaceDay", "Upsert", "ReplaceDay", None]


def test_sniff():
    got = sniff.sniff(b"\xef\xbb\xbfa;b\r\n1;2\n\"x;3\n", readers.CsvReader())
    assert got["bom"] and got["line_endings"] == "mixed" and got["delimiters_in_header"] == {";": 1} and len(got["hints"]) >= 3


def test_dates_and_times(spark):
    values = ["2026-09-08", "2026-9-8", "2026-09", "2026-02-30", "10:30", "yes", " 7 ", "2026-09-08T10", "2026-09-08 10:30", "2026-09-08T10:30:00+0200", "20260908"]
    df = spark.createDataFrame([("f", v, v) for v in values], "file string, column string, value string")
    got = {r["column"]: r["kind"] for r in typing.infer(df).collect()}
    assert got == {"2026-09-08": "date", "2026-9-8": "text", "2026-09": "text", "2026-02-30": "text", "10:30": "text", "yes": "text", " 7 ": "text", "2026-09-08T10": "timestamp", "2026-09-08 10:30": "timestamp", "2026-09-08T10:30:00+0200": "timestamp", "20260908": "bigint"}
    both = spark.createDataFrame([("f", "c", "7\n"), ("f", "c", "8")], "file string, column string, value string")
    assert typing.infer(both).first()["kind"] == "text"


# --- discovery ---


def test_discover(spark, tmp_path):
    rows = [(f"/in/{s}/em-2026-09-{d:02}.csv", datetime(2026, 9, d + 1, 6, 10 + d)) for s in ("EM", "AP") for d in (7, 8, 9)] + [("/in/EM/em.csv", datetime(2026, 9, 10, 6, 30)), ("/in/EM/x-20269999.csv", None), ("/in/top.csv", None)]
    got = discover.analyze(spark.createDataFrame([(p, t, 1) for p, t in rows], "path string, mtime timestamp, size long"), "/in")
    assert got.subsets == {"AP": "/in/AP", "EM": "/in/EM"} and got.cron == "0 7 * * 1-5" and got.exclude_candidates == (r"^em\.csv$",) and got.maxdepth == 1
    p = got.patterns[1]
    assert (p.pattern, p.cadence, p.weekdays, p.lag_days, p.files_per_date) == (r"^EM/em\-(?P<date>\d{4}\-\d{2}\-\d{2})\.csv$", "daily", (1, 2, 3), (1, 1), (1, 1))
    assert len(got.caveats) == 3 and json.loads(discover.to_json(got))["files"] == 9
    few = discover.analyze(spark.createDataFrame([("/in/a/x-2026.csv", None, 1)], "path string, mtime timestamp, size long"), "/in")
    assert few.cron is None and few.patterns[0].cadence is None and few.patterns[0].lag_days is None


def test_inventory(spark, space):
    got = mirror.inventory(spark, str(space.remote)).collect()
    assert [r["path"].rpartition("/")[2] for r in got] == ["em-2026-09-08.csv", "em-2026-09-09.csv", "em.csv"] and got[0]["size"] == 19


def test_cli(spark, space, monkeypatch, capsys, tmp_path):
    from tidemill import cli

    monkeypatch.setattr(cli, "discover_datasets", lambda name: [space.dataset])
    for x in ("LANDING", "TARGET", "MANIFEST"):
        monkeypatch.setenv(f"{x}_ROOT", str(space.tmp / x.lower()))
    space.engine.sync()
    cli.main(["profile", "sets", "em", "--skim"], spark)
    cli.main(["ops", "sets", "reload", "tw/em", "2026-09-08"], spark)
    cli.main(["discover", str(space.remote)], spark)
    out = capsys.readouterr().out
    assert "em: 3 rows" in out and "reload: 1 file(s)" in out and '"subsets"' in out and "em\\\\-(?P<date>" in out


def test_arrivals(spark, space, tmp_path):
    from tidemill.streaming.arrivals import watch

    seen = []
    for _ in range(2):
        watch(spark, str(space.remote), str(tmp_path / "ck"), lambda df, n: seen.extend(r["path"] for r in df.collect())).awaitTermination(60)
    assert len(seen) == 3


def test_recurrence_of_many_values(spark):
    """Counts are exact above a million values; a limit holds where it is asked for."""
    df = spark.range(1_000_002).select(F.explode(F.array(F.lit(0), F.lit(1))).alias("file_no"), F.col("id").alias("a"))
    held = keys.values(df.where("file_no = 0 or a < 3"), [("a",)], "file_no")
    assert keys.recurrence(held, 2).first()[:] == ("a", 1_000_002, 3, 0.0)
    assert keys.candidates(keys.per_file(held), keys.recurrence(held, 2), 2).first()["unique_overall"] is False
    assert keys.recurrence(held, 2, distinct_max=1_000_000).first()[:] == ("a", None, None, None)
