"""One ingest run: parse, check, resolve, log drift, merge and keep the books."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweave import schemas
from feedweave.operators import bookkeeping, drift, entities, merge, metrics, resolve, validate
from feedweave.operators.normalize import ApiMapping, parse_api, parse_csv, parse_rss, to_records
from feedweave.session import drop_folder, entries, scratch, stage
from feedweave.sources import files
from feedweave.store import RunTable

log = logging.getLogger(__name__)

QUARANTINE = T.StructType(
    [
        T.StructField("source_type", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("raw_data", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class RunResult:
    run_id: str
    source_type: str
    status: str
    processed: int = 0
    inserted: int = 0
    updated: int = 0
    failed: int = 0
    skipped: int = 0
    error: str | None = None


@dataclass(frozen=True)
class Feed:
    """What a run needs to know about one source.

    ``parse`` gives parsed records; ``expected`` and ``mismatches`` describe its drift check,
    ``inspect`` adds what that check looks at.
    """

    name: str
    parse: Callable[[], DataFrame]
    expected: Mapping[str, str] | None = None
    mismatches: Column | None = None
    inspect: Callable[[DataFrame], DataFrame] = lambda rows: rows
    metadata: Mapping[str, str] = field(default_factory=dict)

    @property
    def source_type(self) -> str:
        """Any API feed but the first is stored as ``api2``."""
        return self.name if self.name in ("csv", "api1", "rss", "text") else "api2"


def csv_feed(spark: SparkSession, path: str, columns: list[str] | None = None) -> Feed:
    def parse() -> DataFrame:
        rows = files.read_csv(spark, path, columns, unreadable=True)
        return parse_csv(rows)

    return replace(csv_rows_feed(parse), metadata={"path": path})


def csv_rows_feed(parse: Callable[[], DataFrame]) -> Feed:
    expected = schemas.EXPECTED_FIELDS["csv"]
    value = F.get_json_object("raw_data", "$.value")
    return Feed("csv", parse, expected, drift.text_mismatches({"value": value}, expected))


def api_feed(
    spark: SparkSession, path: str, name: str, whole_files: bool = False,
    mapping: ApiMapping = ApiMapping(),
) -> Feed:
    expected = schemas.EXPECTED_FIELDS["api"]
    return Feed(
        name,
        lambda: parse_api(files.read_json_payloads(spark, path, whole_files), name, mapping),
        expected,
        drift.json_mismatches(F.col("record"), expected),
        files.as_records,
        {"path": path, "api_name": name},
    )


def rss_feed(spark: SparkSession, path: str, atom: bool = False) -> Feed:
    read = files.read_atom if atom else files.read_rss
    return Feed(
        "rss", lambda: parse_rss(read(spark, path)), schemas.EXPECTED_FIELDS["rss"], metadata={"path": path}
    )


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


#: What a source can be told of a run; the other events only say that a folder counts.
RUN_STATUSES = ["running", "success", "failure"]


class Lake:
    """The stored tables and the runs that fill them.

    Every run writes folders of its own (``store.py``) and then one event, and only that event makes them count: a run that
    ends before it has changed nothing, and a repeated one writes its folders again. Run history, checkpoints and
    high-water marks are folds over the events. ``compact`` joins what has gathered. One writer at a time for each source;
    any number of readers.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        book: resolve.AliasBook | DataFrame = resolve.CRYPTO,
        cascade: Sequence[resolve.Strategy] = resolve.CASCADE,
        clock: Callable[[], dt.datetime] = _now,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.book, self.cascade, self.clock = book, cascade, clock

        def table(name: str, schema: T.StructType, **how) -> RunTable:
            return RunTable(spark, f"{self.root}/{name}", schema, self.committed, **how)

        self.records = table("records", schemas.RECORDS, merge=merge.current_records, sort_by=["canonical_id", "source_id"])
        self.raw = table("raw_records", schemas.RAW_RECORDS, merge=merge.current_raw, sort_by=["source_id"])
        self.drift_log = table("drift_log", schemas.DRIFT_LOG)
        self.quarantine = table("quarantine", QUARANTINE)
        self.sketches = table("entity_sketches", schemas.ENTITY_SKETCHES)
        self.checkpoints = SimpleNamespace(read=lambda: bookkeeping.checkpoints_from_events(self.run_events()))

    @property
    def tables(self) -> list[RunTable]:
        return [self.records, self.raw, self.drift_log, self.quarantine, self.sketches]

    # The log of events: a folder for each run, into which its events are appended.

    @property
    def _log(self) -> str:
        return f"{self.root}/events"

    def events(self) -> DataFrame:
        """All events, each once: a compaction that did not end may have left some of them twice."""
        if not entries(self.spark, self._log):
            return self.spark.createDataFrame([], schemas.LOG_EVENTS)
        reader = self.spark.read.schema(schemas.LOG_EVENTS).option("recursiveFileLookup", True)
        return reader.parquet(self._log).dropDuplicates(["seq", "run_id"])

    def run_events(self) -> DataFrame:
        return self.events().filter(F.col("status").isin(RUN_STATUSES))

    def runs(self) -> DataFrame:
        return bookkeeping.runs_from_events(self.run_events(), "seq")

    def committed(self) -> list[str]:
        """Runs whose folders count, in their order: the last compaction and what ended well after it."""
        whole = self.events().filter(F.col("status").isin("success", "change", "base"))
        base = whole.agg(F.max(F.when(F.col("status") == "base", F.col("seq"))).alias("seq"))
        kept = whole.filter(F.col("seq") >= F.coalesce(base.scalar(), F.lit(0)))
        return [r["run_id"] for r in kept.select("run_id", "seq").orderBy("seq").collect()]

    def _next(self) -> int:
        return (self.events().agg(F.max("seq")).first()[0] or 0) + 1

    def _note(
        self, run_id: str, source: str, status: str, at: dt.datetime, result: RunResult | None = None, error: str | None = None,
        mark: tuple[str | None, dt.datetime | None] = (None, None), metadata: Mapping[str, str] | None = None,
    ) -> int:
        """Add one event. What runs, checkpoints and marks say follows from it."""
        seq, done = self._next(), result or RunResult(run_id, source, status)
        event = self.spark.createDataFrame(
            [(seq, run_id, source, at, status, done.processed, done.inserted, done.updated, done.failed, error,
              dict(metadata or {}), *mark)], schemas.LOG_EVENTS)
        event.coalesce(1).write.mode("append").parquet(f"{self._log}/run_id={run_id}")
        return seq

    def distinct_entities(self) -> DataFrame:
        """About how many entities runs have brought, by source and in all (``entities.estimated_ids``), from their sketches.

        An entity counts once it has been brought, also if its records have others now.
        """
        return entities.estimated_ids(self.sketches.read())

    def metrics(self) -> DataFrame:
        """All metrics of the lake as one JSON document."""
        at = F.lit(self.clock()).cast("timestamp")
        return metrics.document(
            self.runs(), self.records.read(), self.drift_log.read(), self.checkpoints.read(), at
        )

    def write_event_log(self, path: str) -> None:
        """Runs and drift as structured log lines."""
        metrics.event_log(self.runs(), self.drift_log.read()).write.text(path)

    def run_all(self, feeds: Sequence[Feed], incremental: bool = True) -> list[RunResult]:
        """Run each feed; a failing one does not stop the others."""
        return [self.run(feed, incremental=incremental) for feed in feeds]

    def run(
        self, feed: Feed, incremental: bool = True, metadata: dict[str, str] | None = None,
        batch: tuple[str, int] | None = None,
    ) -> RunResult:
        """Ingest one feed. ``batch`` names the (stream, batch id) of a streaming call, which
        makes a repeated call change nothing twice."""
        started = self.clock()
        if batch is None:
            run_id = f"run_{started:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
        else:
            tail = hashlib.md5(f"{batch[0]}|{batch[1]}".encode()).hexdigest()
            run_id = f"batch_{batch[1]:08d}_{tail[:16]}"
            done = self._finished(run_id)
            if done is not None:
                return done
        try:
            seq = self._note(run_id, feed.name, "running", started, metadata=dict(feed.metadata) | (metadata or {}))
            with scratch(self.spark, run_id) as folder:
                result, mark = self._ingest(feed, run_id, seq, started, incremental, folder)
            self._note(run_id, feed.name, "success", self.clock(), result, mark=mark)
        except Exception as error:  # the books must show the failure, whatever it was
            log.exception("run %s of %s failed", run_id, feed.name)
            self._note(run_id, feed.name, "failure", self.clock(), error=str(error))
            return RunResult(run_id, feed.name, "failure", error=str(error))
        return result

    def _finished(self, run_id: str) -> RunResult | None:
        """The result of a run that has ended well, as its event tells."""
        row = self.events().filter((F.col("run_id") == run_id) & (F.col("status") == "success")).first()
        if row is None:
            return None
        return RunResult(run_id, row["source_type"], "success", row["records_processed"], row["records_inserted"],
                         row["records_updated"], row["records_failed"])

    def _ingest(self, feed: Feed, run_id: str, seq: int, started: dt.datetime, incremental: bool, folder: str):
        at = F.lit(started).cast("timestamp")
        mark = bookkeeping.high_water(self.checkpoints.read(), feed.name)
        stale = F.lit(False)
        if incremental and mark is not None:
            stale = F.coalesce(F.col("source_timestamp") <= F.lit(mark), F.lit(False))

        # One scan: records are checked, counted and sifted; what is neither taken in nor to be told of goes no further.
        parsed = feed.parse().withColumn("_place", F.monotonically_increasing_id())
        checked = drift.detect(feed.inspect(parsed), feed.expected, mismatches=feed.mismatches).select(*parsed.columns, *drift.COLUMNS)
        accepted = F.size("reasons") == 0
        # What could not be read as a record has no fields to speak of.
        record = ~F.arrays_overlap("reasons", F.array(*[F.lit(r) for r in validate.UNREADABLE_REASONS]))
        marked = checked.withColumns({"_fresh": accepted & ~stale, "has_drift": F.col("has_drift") & record})
        seen, fresh = Observation(f"{run_id}-seen"), F.col("_fresh")
        marked = marked.observe(
            seen, F.count_if(fresh).alias("processed"), F.count_if(~accepted).alias("failed"), F.count_if(accepted & ~fresh).alias("skipped"),
            F.count_if("has_drift").alias("drifted"), F.max(F.when(fresh, F.col("source_timestamp"))).alias("ts"),
            F.max_by(F.when(fresh, F.col("source_id")), F.when(fresh, F.col("_place"))).alias("id"))
        staged = stage(marked.filter(fresh | F.col("has_drift") | ~accepted), "batch", folder)
        counts = seen.get

        if counts["drifted"]:
            drifted = drift.with_suggestions(staged.filter("has_drift"), folder=folder)
            self.drift_log.write(run_id, drift.log_rows(drifted, F.lit(feed.name), F.col("source_id"), at))
        if counts["failed"]:
            self.quarantine.write(run_id, validate.quarantine(staged))
        inserted = 0
        if counts["processed"]:
            latest = merge.latest(staged.filter(fresh).drop(*drift.COLUMNS), "source_id", "_place", folder)
            # Keys only: which of the batch's are known. The smaller side decides how they meet.
            known = self.records.keys().join(latest.select("source_id"), "source_id", "left_semi").distinct()
            known = stage(known, "known", folder)
            # Dealt out, so that a task's rows depend on the size of a shuffle's partition and not of an input file.
            dealt = resolve.resolve(latest.repartition("source_id"), self.book, self.cascade)
            met = dealt.join(known.withColumn("_known", F.lit(True)), "source_id", "left")
            new = Observation(f"{run_id}-new")
            met = met.observe(new, F.count_if(F.col("_known").isNull()).alias("inserted"))
            taken = stage(met, "latest", folder).withColumns({"seq": F.lit(seq).cast("long"), "stamp": at})
            inserted = new.get["inserted"]
            self.raw.write(run_id, taken.select(
                "source_type", "source_id", F.lit(feed.name).alias("source_name"), "raw_data", at.alias("ingested_at"), "seq", "stamp"))
            self.records.write(run_id, _stored(taken, at))
            self.sketches.write(run_id, entities.sketches(taken))
        newest = max([t for t in (counts["ts"], mark) if t is not None], default=None)
        result = RunResult(run_id, feed.name, "success", counts["processed"], inserted, counts["processed"] - inserted,
                           counts["failed"], counts["skipped"])
        return result, (counts["id"], newest)

    def change(self, rows: DataFrame, what: str = "change") -> None:
        """Store records (each key once, with or without seq and stamp) as a run of its own that no source is told of.

        A key that is there already keeps created_at and source_type; without a stamp its updated_at stays as the rows have it.
        """
        seq = self._next()
        run_id = f"{what}_{seq:08d}"
        stamp = F.col("stamp") if "stamp" in rows.columns else F.col("updated_at")
        self.records.write(run_id, rows.withColumns({"seq": F.lit(seq).cast("long"), "stamp": stamp}))
        self.sketches.write(run_id, entities.sketches(self.records.rows([run_id])))
        self._note(run_id, "", "change", self.clock())

    def renormalize(self, parsed: DataFrame) -> None:
        """Replace unified rows by re-parsed archive rows, keeping created_at."""
        at = F.lit(self.clock()).cast("timestamp")
        rows = resolve.resolve(validate.valid(parsed), self.book, self.cascade)
        self.change(_stored(rows.withColumns({"seq": F.lit(None).cast("long"), "stamp": at}), at), "renormalized")

    def backfill(self) -> None:
        """Resolve the stored rows without a canonical id and add what was found."""
        lacking = self.records.read().filter("canonical_id IS NULL")
        self.change(resolve.backfill(lacking, self.book, self.cascade).filter("canonical_id IS NOT NULL"), "backfilled")

    def override(self, overrides: DataFrame) -> None:
        """Store manual corrections (source_id, canonical_id), one per record at most."""
        fixes = overrides.select("source_id", F.col("canonical_id").alias("_fixed"))
        rows = self.records.read().join(fixes, "source_id").filter(F.col("_fixed").isNotNull() & ~F.col("_fixed").eqNullSafe(F.col("canonical_id")))
        self.change(rows.withColumn("canonical_id", F.col("_fixed")), "overridden")

    def compact(self) -> None:
        """Join what runs have brought into one folder of current rows for each table, and their events into one file.

        The joined folders count from the event on that ends the compaction, and only then the folders of the runs they
        hold are deleted. A compaction is a writer like a run; readers that have planned before it must be done.
        """
        seq, folded = self._next(), set(self.committed())
        run_id = f"base_{seq:08d}"
        for table in self.tables:
            if folded & set(table.runs()):
                table.write(run_id, table.current(), ranged=True)
        self._note(run_id, "", "base", self.clock())
        last = self.events().groupBy("run_id").agg(F.max_by("status", "seq").alias("status")).filter("status <> 'running'").collect()
        failed, kept = {r["run_id"] for r in last if r["status"] == "failure"}, set(self.committed())
        for table in self.tables:
            for old in ({r["run_id"] for r in last} - kept) & set(table.runs()):
                drop_folder(self.spark, table.home(old))
        # A failed run may be repeated under its id: its events stay where they are, too.
        old = [name for name in entries(self.spark, self._log) if name.removeprefix("run_id=") not in failed]
        stage(self.events(), f"joined_{seq:08d}-{uuid.uuid4().hex[:8]}", self._log)
        for name in old:
            drop_folder(self.spark, f"{self._log}/{name}")


def _stored(rows: DataFrame, at: Column) -> DataFrame:
    """Parsed records with seq and stamp to rows of the records' folders."""
    return to_records(rows, at, "seq", "stamp")
