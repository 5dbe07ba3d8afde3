"""The layer tables: bootstrap, batch and stream access, compaction, SQL views.

With plain files, every append and every streaming batch is one load: a folder of its own, which counts from the moment the
table's ledger has an entry for it. So a reader sees a load as a whole or not at all, loads of batch jobs and of streams
stand side by side, and a streaming batch that is tried again after a crash is there once, for batch readers and for the streams
behind. Nothing depends on the rename of a folder, only on that a file is put under a name that is free.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.config import TickConfig
from tickloom.schemas import PARTITION_COLUMNS, TABLES, TIME_COLUMNS
from tickloom.session import ROCKS_DB, STATE_STORE
from tickloom.sources.ledger import APPEND, ENTRY, REWRITE, Files, Ledger, Load, batch_load
from tickloom.sources.load_files import rows_of

#: first partition level of the stored files
LOAD = "load"
VIEWS = ("bronze", "silver", "gold", "predictions")


class Tables:
    """Tables of one base path. Reads always use the declared schema, so a symbol such as ``7203``
    stays text, and a column added later reads as NULL from older files."""

    def __init__(self, spark: SparkSession, cfg: TickConfig):
        self.spark = spark
        self.cfg = cfg
        self.files = Files(spark)
        self._ledgers: dict[str, Ledger] = {}
        self._queries: dict[str, str] = {}

    @property
    def _delta(self) -> bool:
        return self.cfg.table_format == "delta"

    def exists(self, name: str) -> bool:
        """Whether the table's folder is there (created by a bootstrap, a stream or an append)."""
        return self.files.exists(self.cfg.path(name))

    def ledger(self, name: str) -> Ledger:
        if name not in self._ledgers:
            self._ledgers[name] = Ledger(self.files, self.files.full_name(self.cfg.path(name)))
        return self._ledgers[name]

    # --- writing -------------------------------------------------------------------------------

    def _write_load(self, name: str, df: DataFrame, load: str) -> None:
        """Write ``df`` as the load of that name, unless it is committed. The rebalance gathers each symbol's rows into
        few files and, unlike a plain repartition by symbol, splits a symbol that is too large for one task."""
        ledger = self.ledger(name)
        if ledger.holds(load):
            # the rows are there; the state of the query behind them still has to be brought up
            df.write.format("noop").mode("overwrite").save()
            return
        # every try has a folder of its own; one without an entry is never read
        folder = f"{LOAD}={load}-{uuid.uuid4().hex[:8]}"
        self._write_files(name, df, f"{ledger.table}/{folder}", PARTITION_COLUMNS[name])
        written = self.files.data_files(f"{ledger.table}/{folder}")
        load_rows = Load(folder, [f for f, _ in written], sum(n for _, n in written))
        micros = F.unix_micros(TIME_COLUMNS[name])
        told = self._loads(name, [load_rows] if written else []).agg(
            F.count("*").alias("rows"), F.count(micros).alias("timed"), F.min(micros).alias("first"), F.max(micros).alias("last")
        ).first()
        if not told["rows"]:
            # an empty batch leaves nothing behind
            self.files.delete(f"{ledger.table}/{folder}")
        elif told["timed"] == told["rows"]:
            ledger.commit(load, [replace(load_rows, first=told["first"], last=told["last"])])
        else:
            ledger.commit(load, [load_rows])

    def _write_files(self, name: str, df: DataFrame, path: str, partitions: list[str]) -> None:
        writer = df.hint("rebalance", *partitions).write.format(self.cfg.table_format)
        if self.cfg.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", self.cfg.max_records_per_file)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.save(path)

    def stream_load(self, checkpoint: str, batch_id: int) -> str:
        """Name of the load of a streaming batch: the query's own id, which its checkpoint keeps, and the batch. A new
        checkpoint has another id, so its batches are not taken for those of the old one."""
        if checkpoint not in self._queries:
            place = self.cfg.checkpoint(checkpoint)
            if self.files.exists(f"{place}/metadata"):
                self._queries[checkpoint] = json.loads(self.files.text(f"{place}/metadata"))["id"]
            else:
                # a batch outside of a query
                self.files.put_if_absent(f"{place}_token", uuid.uuid4().hex)
                self._queries[checkpoint] = self.files.text(f"{place}_token")
        return batch_load(self._queries[checkpoint], batch_id)

    def bootstrap(self, name: str) -> bool:
        """Create an empty table where there is none; True when it was created."""
        if self.exists(name):
            return False
        if self._delta:
            writer = self.spark.createDataFrame([], TABLES[name]).write.format(self.cfg.table_format)
            writer.partitionBy(*PARTITION_COLUMNS[name]).mode("ignore").save(self.cfg.path(name))
        else:
            self.files.make_folder(self.ledger(name).folder)
        return True

    def append(self, name: str, df: DataFrame) -> None:
        """Append a batch."""
        if not self._delta:
            self._write_load(name, df, f"b-{uuid.uuid4().hex}")
            return
        partitions = PARTITION_COLUMNS[name]
        writer = df.hint("rebalance", *partitions).write.format(self.cfg.table_format).mode("append")
        writer.option("mergeSchema", "true").partitionBy(*partitions).save(self.cfg.path(name))

    def put_batch(self, name: str, df: DataFrame, checkpoint: str, batch_id: int) -> None:
        """Write the rows of one streaming batch, once however often the batch is tried."""
        if not self._delta:
            self._write_load(name, df, self.stream_load(checkpoint, batch_id))
            return
        writer = df.write.format(self.cfg.table_format).mode("append")
        writer = writer.option("txnAppId", checkpoint).option("txnVersion", batch_id)
        writer.partitionBy(*PARTITION_COLUMNS[name]).save(self.cfg.path(name))

    def holds_batch(self, name: str, checkpoint: str, batch_id: int) -> bool:
        return not self._delta and self.ledger(name).holds(self.stream_load(checkpoint, batch_id))

    # --- reading -------------------------------------------------------------------------------

    def read(self, name: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The table as it is now. With ``since`` or ``until`` only rows from the one and before the other, and files of
        loads that lie outside are not opened (naive times are local, as everywhere in PySpark)."""
        at = F.col(TIME_COLUMNS[name])
        rows = self._all(name) if self._delta else self._loads(name, self.ledger(name).loads(_micros(since), _micros(until)))
        if since is not None:
            rows = rows.where(at >= F.timestamp_micros(F.lit(_micros(since))))
        if until is not None:
            rows = rows.where(at < F.timestamp_micros(F.lit(_micros(until))))
        return rows

    def _all(self, name: str) -> DataFrame:
        return self.spark.read.format(self.cfg.table_format).load(self.cfg.path(name)).select(*TABLES[name].names)

    def _loads(self, name: str, loads: list[Load]) -> DataFrame:
        table = self.ledger(name).table
        if not loads:
            return self.spark.createDataFrame([], TABLES[name])
        reader = self.spark.read.format(self.cfg.table_format).schema(_stored_schema(name)).option("basePath", table)
        return reader.load([f"{table}/{x.path}" for x in loads]).select(*TABLES[name].names)

    def read_stream(self, name: str) -> DataFrame:
        """The table as a stream, from its beginning.

        The stream follows the entries of the ledger, in their order and at most ``max_loads_per_batch`` in a batch. A load is
        never taken in parts: its files hold different symbols over the same time, and the first would move the watermark
        past the others. Rewritten loads bring no new rows. The table itself is not listed.
        """
        if self._delta:
            reader = self.spark.readStream.format(self.cfg.table_format)
            reader = reader.options(startingVersion="0", ignoreChanges="true", ignoreDeletes="true")
            return reader.load(self.cfg.path(name)).select(*TABLES[name].names)
        ledger = self.ledger(name)
        reader = self.spark.readStream.schema(ENTRY)
        if self.cfg.max_loads_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.cfg.max_loads_per_batch)
        added = reader.json(ledger.folder).where(F.col("kind") == APPEND).select(F.inline("adds"))
        paths = added.select("path", F.explode("files").alias("file")).select(F.concat_ws("/", "path", "file").alias("path"))
        return paths.repartition("path").mapInArrow(rows_of(ledger.table, TABLES[name]), TABLES[name])

    def watermarks(self, checkpoint: str, batch_id: int) -> tuple[int, int]:
        """The watermarks (milliseconds) of the batch before and of this one, as the checkpoint keeps them: a batch that is tried
        again finds the same."""
        place = f"{self.cfg.checkpoint(checkpoint)}/offsets"
        told = [self.files.text(f"{place}/{n}").splitlines()[1] for n in (batch_id - 1, batch_id) if n >= 0]
        before, now = ([0] + [json.loads(line)["batchWatermarkMs"] for line in told])[-2:]
        return before, now

    def start_stream(
        self,
        name: str,
        df: DataFrame,
        available_now: bool = False,
        aside: dict[str, Column] | None = None,
        outcomes: Callable[[DataFrame, int], DataFrame] | None = None,
    ) -> StreamingQuery:
        """Append a stream to the table under its own checkpoint and query name. Rows that meet a condition of ``aside``
        go to the table of that name instead, from the same run; ``outcomes`` makes the rows they look at from a batch and its number."""
        # state of deduplication and windows belongs on disk, whatever session starts the stream
        self.spark.conf.set(STATE_STORE, ROCKS_DB)
        writer = (
            df.writeStream.outputMode("append")
            .queryName(f"{name}_ingestion")
            .option("checkpointLocation", self.cfg.checkpoint(name))
        )
        if self._delta:
            writer = writer.format("delta").option("mergeSchema", "true").partitionBy(*PARTITION_COLUMNS[name])
        else:
            self._queries.pop(name, None)

            def put(batch: DataFrame, batch_id: int) -> None:
                load = self.stream_load(name, batch_id)
                if not aside:
                    self._write_load(name, batch, load)
                    return
                rows = (outcomes(batch, batch_id) if outcomes else batch).persist()
                try:
                    rest = rows
                    for other, condition in aside.items():
                        self._write_load(other, rows.where(condition).select(*TABLES[other].names), load)
                        rest = rest.where(~condition)
                    self._write_load(name, rest.select(*TABLES[name].names), load)
                finally:
                    rows.unpersist()

            writer = writer.foreachBatch(put)
        if available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.cfg.processing_time)
        return writer.start(self.cfg.path(name)) if self._delta else writer.start()

    # --- upkeep --------------------------------------------------------------------------------

    def compact(self, name: str, least_loads: int = 2) -> int:
        """Rewrite the loads that came since the last time into one load per day, in files by symbol and ordered by time. Loads
        that earlier runs made for those days go in again if they are smaller than ``small_load_bytes``. Returns the number of loads
        replaced; 0 also if another compaction was faster. Readers and streams go on undisturbed: the old files stay until
        ``vacuum``, and the ledger passes from the old loads to the new in one entry.
        """
        ledger = self.ledger(name)
        loads = ledger.loads()
        fresh = [x for x in loads if x.day is None]
        if len(fresh) < least_loads:
            return 0
        small = [x for x in loads if x.day is not None and x.bytes < self.cfg.small_load_bytes and any(x.meets(f.first, None if f.last is None else f.last + 1) for f in fresh)]
        chosen = fresh + small
        at, partitions = TIME_COLUMNS[name], PARTITION_COLUMNS[name]
        root = f"c-{uuid.uuid4().hex}"
        day = F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("none"))
        rows = self._loads(name, chosen).withColumn(LOAD, day).hint("rebalance", LOAD, *partitions)
        writer = rows.sortWithinPartitions(LOAD, *partitions, at).write.format(self.cfg.table_format)
        if self.cfg.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", self.cfg.max_records_per_file)
        aside = f"{ledger.table}/_aside/{root}"
        writer.partitionBy(LOAD, *partitions).save(aside)
        by_day: dict[str, list[tuple[str, int]]] = {}
        for file, size in self.files.data_files(aside):
            folder, _, rest = file.partition("/")
            by_day.setdefault(folder.split("=", 1)[1], []).append((rest, size))
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        adds = []
        for one, files in sorted(by_day.items()):
            # beside the other loads, where readers expect the same depth of folders; not read before the entry is there
            path = f"{LOAD}={root}-{one}"
            self.files.rename(f"{aside}/{LOAD}={one}", f"{ledger.table}/{path}")
            adds.append(Load(path, [f for f, _ in files], sum(n for _, n in files), *_day_range(one, zone), one))
        self.files.delete(aside)
        if not ledger.commit(root, adds, [x.path for x in chosen], REWRITE):
            for add in adds:
                self.files.delete(f"{ledger.table}/{add.path}")
            return 0
        return len(chosen)

    def vacuum(self, name: str, keep_hours: float = 168) -> list[str]:
        """Delete the folders of loads that were rewritten more than ``keep_hours`` ago, and those of tries that were never
        committed and are as old. A stream that is further behind, or begins later, then fails with the name of the file it misses."""
        ledger = self.ledger(name)
        before = int((time.time() - keep_hours * 3600) * 1000)
        live = {x.path for x in ledger.loads()}
        old = set(ledger.gone_before(before)) - live
        known = live | set(ledger.gone_before(int(time.time() * 1000) + 1))
        old |= {n for n, changed in self.files.folder(ledger.table) if n[0] not in "_." and n not in known and changed < before}
        for path in sorted(old):
            self.files.delete(f"{ledger.table}/{path}")
        return sorted(old)

    # --- views ---------------------------------------------------------------------------------

    def create_views(self) -> list[str]:
        """Temporary views by table name; tables that are not there yet are left out."""
        made = [name for name in VIEWS if self.exists(name)]
        for name in made:
            self.read(name).createOrReplaceTempView(name)
        return made

    def describe(self, name: str) -> DataFrame:
        """Column names and types of a view."""
        return self.spark.sql(f"DESCRIBE {name}").select("col_name", "data_type")


def _micros(at: datetime | None) -> int | None:
    if at is None:
        return None
    since = at.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


def _day_range(day: str, zone: str) -> tuple[int | None, int | None]:
    """First and last microsecond of a day. Where the zone is not UTC, a day more on either side."""
    if day == "none":
        return None, None
    first = _micros(datetime.fromisoformat(day).replace(tzinfo=timezone.utc))
    slack = 0 if zone == "UTC" else 86_400_000_000
    return first - slack, first + 86_400_000_000 - 1 + slack


def _stored_schema(name: str) -> StructType:
    """The declared schema with the partition columns last, where a file scan puts them."""
    declared = TABLES[name]
    partitions = PARTITION_COLUMNS[name]
    data = [f for f in declared.fields if f.name not in partitions]
    return StructType([*data, StructField(LOAD, StringType()), *(declared[c] for c in partitions)])
