"""Tables made of runs: every run adds a Parquet folder of its own, and reads merge what the runs have brought.

A run's folder counts once an event says that the run is whole; until then, and if it fails, nobody reads it. A
repeated run replaces its own folder and no other. What folders count, and in which order, is the business of the log
of events (``operators/bookkeeping.py``); this module only reads and writes them with Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweave.session import entries

#: The number of the event that began the run, and what ``updated_at`` becomes if the key was there before.
ORDER = T.StructType([T.StructField("seq", T.LongType()), T.StructField("stamp", T.TimestampType())])

#: Keys that readers look up: a Bloom filter for each row group that holds them.
LOOKED_UP = ("source_id", "canonical_id")


class RunTable:
    """``committed`` gives the runs that count; ``merge`` makes current rows (with seq and stamp) of all their rows."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, committed: Callable[[], Sequence[str]],
        merge: Callable[[DataFrame], DataFrame] | None = None, sort_by: Sequence[str] = (),
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.committed, self.merge, self.sort_by = committed, merge, list(sort_by)
        self.stored = T.StructType(schema.fields + (ORDER.fields if merge else []))

    def home(self, run_id: str) -> str:
        return f"{self.path}/run_id={run_id}"

    def runs(self) -> list[str]:
        """Runs that have a folder, whole or not."""
        return [name.removeprefix("run_id=") for name in entries(self.spark, self.path) if name.startswith("run_id=")]

    def write(self, run_id: str, rows: DataFrame, ranged: bool = False) -> None:
        """The rows of one run; each key once if the table is merged. ``ranged`` deals all rows by the sort columns first."""
        out = rows.select(*self.stored.fieldNames())
        if self.sort_by:
            out = (out.repartitionByRange(*self.sort_by) if ranged else out).sortWithinPartitions(*self.sort_by)
        blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKED_UP if c in self.schema.fieldNames()}
        out.write.mode("overwrite").options(**blooms).parquet(self.home(run_id))

    def rows(self, counting: Sequence[str] | None = None) -> DataFrame:
        """All rows of the runs that count, as stored. A folder written before a column existed has nulls there."""
        there = set(self.runs())
        homes = [self.home(r) for r in (self.committed() if counting is None else counting) if r in there]
        if not homes:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*homes)

    def current(self) -> DataFrame:
        """Current rows with seq and stamp: a single run holds each key once, so there is nothing to merge."""
        there = set(self.runs())
        counting = [r for r in self.committed() if r in there]
        rows = self.rows(counting)
        return self.merge(rows) if self.merge and len(counting) > 1 else rows

    def read(self) -> DataFrame:
        return self.current().select(*self.schema.fieldNames())

    def keys(self, key: str = "source_id") -> DataFrame:
        """Keys of all runs that count, repeated as often as runs have brought them; no other column is read."""
        return self.rows().select(key)
