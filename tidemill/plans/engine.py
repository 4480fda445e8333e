"""The engine: mirror, classify, check, plan and load a dataset. Any scheduler may call it.

One engine at a time works on a dataset's manifest: ``run`` and the sensor's loads hold the feed's lock. Every step that
fails leaves the last manifest as it was; a load that ends before it is marked is simply done again, as merges are
idempotent. ``run`` tries mirroring and loads again as often as ``Again`` says.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as committed
from ..alerts import MailServer, Notifier, failure, findings
from ..config import Dataset, Table
from ..operators import checks, classify, merge, mirror, planning
from ..operators import manifest as m
from ..operators.jdbc import writer_to
from ..sources import archives
from .store import ManifestStore


@dataclass(frozen=True)
class SyncResult:
    downloaded: int = 0
    revisions: int = 0
    ignored: int = 0
    unchanged: int = 0
    assigned: int = 0


log = logging.getLogger("tidemill")
Result = TypeVar("Result")


@dataclass(frozen=True)
class Again:
    """Tries after the first one, and the seconds between them."""

    times: int
    wait: float

    def __call__(self, what: str, fn: Callable[[], Result], sleep: Callable[[float], None] = time.sleep) -> Result:
        for left in range(self.times, 0, -1):
            try:
                return fn()
            except Exception as e:
                log.warning("%s failed, %d more tries: %s", what, left, e)
                sleep(self.wait)
        return fn()


class Busy(RuntimeError):
    """Another engine works on the feed."""


class Lock:
    """A file that only one engine can create. One that is older than ``stale`` seconds was left behind and is taken over."""

    def __init__(self, spark: SparkSession, path: str, stale: float = 6 * 3600):
        self.jvm, self.path, self.stale = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path), stale
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def take(self) -> None:
        if self.fs.exists(self.path) and time.time() - self.fs.getFileStatus(self.path).getModificationTime() / 1000 > self.stale:
            self.fs.delete(self.path, False)
        try:
            self.fs.create(self.path, False).close()
        except Exception as e:  # the JVM's, as it is there
            raise Busy(f"{self.path.toString()} is held") from e

    @contextmanager
    def held(self):
        self.take()
        try:
            yield
        finally:
            self.fs.delete(self.path, False)


@dataclass
class Engine:
    spark: SparkSession
    dataset: Dataset
    landing_root: str
    target_root: str
    manifest_root: str
    notifier: Notifier = field(default_factory=Notifier)
    sync_again: Again = Again(2, 120)
    load_again: Again = Again(1, 60)

    def __post_init__(self) -> None:
        self.store = ManifestStore(self.spark, f"{self.manifest_root}/{self.dataset.name}")
        self.landing_root = self.dataset.landing_root or self.landing_root
        self.destination = self.dataset.target_root or self.target_root
        self.target_root = f"{self.destination}/{self.dataset.schema_name}"
        self.lock = Lock(self.spark, f"{self.manifest_root}/{self.dataset.name}.lock")
        remote = self.dataset.feed.remote
        for k, v in ({} if remote.protocol else remote.options).items():
            self.spark._jsc.hadoopConfiguration().set(k, str(v))

    def table(self, name: str) -> Table:
        return next(t for t in self.dataset.tables if name in (t.name, t.key))

    def target(self, name: str) -> DataFrame | None:
        """The present rows of a table, or of a child table."""
        own = next((t for t in self.dataset.tables if name == t.name or name.startswith(f"{t.name}__")), None)
        writer = writer_to(self.destination, own.writer if own else merge.Writer())
        return writer.current(self.spark, self.target_root, name)

    # --- mirror ---

    def sync(self) -> SyncResult:
        """Copy what is new or changed and record it; then expand archives and classify."""
        feed = self.dataset.feed
        remote = feed.remote
        if remote.protocol:
            listing = mirror.listing_by_fsspec(self.spark, remote.protocol, remote.options, feed.subsets, feed.maxdepth)
        else:
            listing = mirror.listing(self.spark, feed.subsets, feed.maxdepth)
        actions = mirror.diff(listing, m.latest(self.store.read(), feed.name, any_status=True), feed.exclude)
        local = mirror.landing_path(self.landing_root, feed.name, F.col("path"), F.col("version"))
        actions = actions.withColumn("local_path", local).cache()
        n = {r["action"]: r["count"] for r in actions.groupBy("action").count().collect()}
        copied = actions.where(F.col("action").isin(mirror.NEW, mirror.REVISION))
        if n.get(mirror.NEW, 0) + n.get(mirror.REVISION, 0) + n.get(mirror.IGNORED, 0):
            # hashes come from the bytes that were copied; kept, so that nothing is copied twice
            hashes = mirror.copy(copied.repartition(max(1, min(1000, n.get(mirror.NEW, 0) + n.get(mirror.REVISION, 0)))), remote.protocol, remote.options).persist()
            ignored = actions.where(F.col("action") == mirror.IGNORED).withColumn("sha256", F.lit(None).cast("string")).withColumn("local_path", F.lit(None).cast("string"))
            rows = copied.join(hashes.select("remote_path", "sha256"), "remote_path").unionByName(ignored)
            rows = mirror.number(rows, self.store.next_id()).withColumns({"feed": F.lit(feed.name), "status": F.when(F.col("action") == mirror.IGNORED, m.IGNORED).otherwise(m.DOWNLOADED), "downloaded_at": F.lit(datetime.now(UTC).replace(tzinfo=None))})
            full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in m.SCHEMA])
            self.store.write(m.record(self.store.read(), full))
            hashes.unpersist()
        actions.unpersist()
        return SyncResult(n.get(mirror.NEW, 0), n.get(mirror.REVISION, 0), n.get(mirror.IGNORED, 0), n.get(mirror.UNCHANGED, 0), self.classify())

    def classify(self) -> int:
        """Assign what can be; ambiguous files are an error after all others are assigned."""
        feed, tables = self.dataset.feed.name, self.dataset.tables
        files = self.store.read()
        expand = classify.to_expand(files, feed, tables)
        if not expand.isEmpty():
            files = self.store.write(m.add_members(files, archives.list_members(expand).persist(), self.store.next_id()))
        before = m.unclassified(files, feed).count()
        decided, ambiguous = classify.classify(files, feed, tables)
        clash = {r["path"]: sorted(r["tables"]) for r in ambiguous.collect()}
        files = self.store.write(decided)
        if clash:
            raise classify.AmbiguousMatch(clash)
        return before - m.unclassified(files, feed).count()

    # --- checks and runs ---

    def check(self, table: Table, target: str = "raw", today: date | None = None, partition: date | None = None) -> dict[str, checks.CheckResult]:
        ctx = checks.CheckContext(self.spark, self.store.read(), table, today or date.today(), self.target(table.name) if target == "sql" else None, partition)
        return {f"{c.name}_{table.name}": c.evaluate(ctx) for c in table.checks if c.target == target}

    def plan(self, table: Table, issued: DataFrame | None = None) -> list:
        """Runs (start, end, newest_id, run_key) over pending partitions."""
        runs = planning.run_keys(table.partitioning.runs(m.pending_days(self.store.read(), table.key)), table.key)
        return (runs if issued is None else planning.not_issued(runs, issued)).orderBy("start").collect()

    # --- load ---

    def load(self, table: Table, start: date, end: date | None = None, load_id: str | None = None) -> merge.WriteResult:
        """Load all active files of [start, end); without files the target stays untouched."""
        load_id = load_id or uuid.uuid4().hex
        window = m.files_for(self.store.read(), table.key, start, end)
        held = window.select("id", "subset", "local_path", "member", "business_date", "attributes").cache()
        n = held.count()
        if not n:
            return merge.WriteResult(0, {"files": 0})
        files = held.select(F.col("id").alias("file_id"), F.col("local_path").alias("path"), "member")
        types = committed.committed_types(self.dataset, table.name)
        rows = table.reader.read(files, types)
        attributes = table.source.attribute_names
        metadata = {"_business_date": F.col("_m.business_date"), "_subset": F.col("_m.subset"), "_load_id": F.lit(load_id), **{f"_{k}": F.try_element_at("_m.attributes", F.lit(k)) for k in attributes}}
        known = held.select(F.col("id").alias("_source_file"), F.struct("business_date", "subset", "attributes").alias("_m"))
        rows = merge.with_metadata(rows.join(known, "_source_file"), metadata).drop("_m")
        result = writer_to(self.destination, table.writer).write(rows, self.target_root, table.name, types, ("_business_date", "_subset", "_source_file", "_load_id", *[f"_{k}" for k in attributes]))
        self.store.write(m.mark_loaded(self.store.read(), held.select("id"), load_id))
        held.unpersist()
        return merge.WriteResult(result.rows, result.details | {"files": n})

    def run(self, today: date | None = None) -> dict[str, merge.WriteResult]:
        """Mirror, check, and load all that is pending; findings and failures go to the notifier."""
        with self.lock.held():
            self.attempt(f"sync of {self.dataset.name}", self.sync_again, self.sync)
            out: dict[str, merge.WriteResult] = {}
            for t in self.dataset.tables:
                self.report(t, self.check(t, "raw", today))
                out |= {r["run_key"]: self.load_run(t, r, today) for r in self.plan(t)}
        return out

    def attempt(self, what: str, again: Again, fn: Callable[[], Result]) -> Result:
        try:
            return again(what, fn)
        except Exception as e:
            self.notifier.notify(failure(what, e))
            raise

    def load_run(self, table: Table, run, today: date | None = None) -> merge.WriteResult:
        """A run of ``plan``, with the checks after it."""
        first, last = table.partitioning.window(run["start"], run["end"])
        result = self.attempt(run["run_key"], self.load_again, lambda: self.load(table, first, last))
        self.report(table, self.check(table, "sql", today, run["start"]), result.details.get("new_columns", []))
        return result

    def report(self, table: Table, found: dict[str, checks.CheckResult], new_columns: list[str] | None = None) -> None:
        for alert in findings(table.key, found, new_columns or []):
            self.notifier.notify(alert)

    def extra(self) -> dict[str, DataFrame]:
        return {name: fn(self.spark, self) for name, fn in self.dataset.extra.items()}


class Sensor:
    """Looks for runs that are pending and weren't issued yet; a look that comes too early after the last one sees nothing."""

    #: Seconds that lie between two looks at least (fixed value).
    LEAST = 300

    def __init__(self, engine: Engine, interval: float = LEAST, clock: Callable[[], float] = time.monotonic):
        self.engine, self.interval, self.clock = engine, max(interval, self.LEAST), clock
        self.last, self.issued = None, set()

    def look(self) -> list[tuple[Table, object]]:
        """(table, run) of new runs."""
        now = self.clock()
        if self.last is not None and now - self.last < self.interval:
            return []
        self.last = now
        pending = [(t, r) for t in self.engine.dataset.tables for r in self.engine.plan(t)]
        new = [(t, r) for t, r in pending if r["run_key"] not in self.issued]
        self.issued = {r["run_key"] for _, r in pending}  # a key that isn't pending any more can't come again
        return new

    def load(self) -> dict[str, merge.WriteResult]:
        """Load what a look finds, under the feed's lock."""
        found = self.look()
        if not found:
            return {}
        with self.engine.lock.held():
            return {r["run_key"]: self.engine.load_run(t, r) for t, r in found}


def engine_from(spark: SparkSession, dataset: Dataset, env: Mapping[str, str] = os.environ) -> Engine:
    """An engine whose folders and mail server come from the environment: TIDEMILL_LANDING, _TARGET, _MANIFEST and _SMTP_*."""
    held = {k.removeprefix("TIDEMILL_").lower(): v for k, v in env.items() if k.startswith("TIDEMILL_")}
    if missing := [f"TIDEMILL_{k.upper()}" for k in ("landing", "target", "manifest") if k not in held]:
        raise ValueError(f"not in the environment: {', '.join(missing)}")
    server = MailServer(held["smtp_host"], int(held.get("smtp_port", 25)), held.get("smtp_user"), held.get("smtp_password", "")) if "smtp_host" in held else None
    notifier = Notifier(server, held.get("smtp_from", Notifier.sender), held.get("smtp_to", ""))
    return Engine(spark, dataset, held["landing"], held["target"], held["manifest"], notifier)
