"""File streams: append, JSON batches, Parquet sinks, and continuous upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedloom.operators.ranking import newest_per_group
from feedloom.operators.state import SEEN, fold_changes, soft_delete, upsert
from feedloom.session import written
from feedloom.sources.lake import NumberedFolders, TableVersions
from feedloom.types import ACTION, CONTENT_HASH, INTEGRATION_ID, NO_KEY


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_trigger: int = 1, **options) -> DataFrame:
    """A stream over the files of a folder, oldest first, so many files per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def run_available(query: StreamingQuery) -> StreamingQuery:
    """Wait until all present input is processed; a failure of the stream is raised here."""
    query.awaitTermination()
    return query


def to_memory(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """A running aggregate in the memory sink, as the table ``name``. The sink lives on the driver: small results only."""
    run_available(stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start())
    return stream.sparkSession.table(name)


def append_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return run_available(
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def write_batches(stream: DataFrame, path: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df, every: str | None = None) -> StreamingQuery:
    """Each micro-batch to a folder of its own, which a repeated batch overwrites."""

    def save(batch: DataFrame, number: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    query = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    return query if every else run_available(query)


#: Action of the row that ends a full load; its execution date says which load.
LOAD_END = "LOAD_END"

#: Column that names a full load: the digest of its execution date.
LOAD = "load_id"


class ChangeStream:
    """A table kept current from a stream of changes.

    Micro-batches only append to a change log, so their cost is their own size. The log is folded into a
    new snapshot after ``compact_every`` batches; :meth:`current` reads snapshot and log together. Log
    folders are deleted once two snapshots hold them, so frames from :meth:`current` stay valid until
    the table has been compacted twice more.

    A full load may come in any number of micro-batches. Its rows have load type ``FULL`` and share their
    execution date; a row with the action ``LOAD_END`` and that date ends it. Only then are the keys that
    none of its rows had marked as deleted, in a snapshot of its own; rows of other load types with the
    same date are not part of it. The keys of full loads are logged
    once more by load, so its end reads the keys of that load alone and they are deleted with it. A load
    ends once: a later ``LOAD_END`` with its date changes nothing, and later rows are changes like others.

    Micro-batch b writes log folder b and snapshot b + 1 at most, and deletes only what snapshots up to b
    or a written snapshot b + 1 hold, hence a repeated batch leaves what it left before.
    """

    def __init__(self, spark: SparkSession, path: str, initial: DataFrame, compact_every: int = 100):
        base = path.rstrip("/")
        self.spark = spark
        self.log = NumberedFolders(spark, f"{base}/log", "batch_no")
        self.snapshots = TableVersions(spark, f"{base}/table")
        self.load_keys = NumberedFolders(spark, f"{base}/loads", "batch_no")
        self.ended = f"{base}/ended"
        self.compact_every = compact_every
        if not self.snapshots.versions():
            seen = initial if SEEN in initial.columns else initial.withColumn(SEEN, F.col("elt_execution_date"))
            self.snapshots.write(seen, 0)

    def _pending(self, upto: int | None = None, newest: int | None = None) -> tuple[int, list[int]]:
        """The newest snapshot (not after ``newest``) and the log folders after it, as of a batch."""
        last = newest if newest is not None or upto is None else upto + 1
        version = max(v for v in self.snapshots.versions() if last is None or v <= last)
        return version, [n for n in self.log.numbers() if n >= version and (upto is None or n <= upto)]

    def current(self) -> DataFrame:
        return self._state().drop(SEEN)

    def _state(self, upto: int | None = None, newest: int | None = None) -> DataFrame:
        version, pending = self._pending(upto, newest)
        table = self.snapshots.read(version)
        # Written, since the upsert reads its changes three times and the log is folded by several windows.
        return upsert(table, written(fold_changes(self.log.read(pending), target=table), "folded")) if pending else table

    def compact(self, upto: int) -> None:
        """Write snapshot ``upto + 1`` unless it is there."""
        if upto + 1 not in self.snapshots.versions():
            self.snapshots.write(self._state(upto), upto + 1)

    def _path(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _has_ended(self, load: str) -> bool:
        fs, mark = self._path(f"{self.ended}/{load}")
        return fs.exists(mark)

    def _load_folders(self, load: str, upto: int) -> dict[int, str]:
        """Folders with the keys of one load, by batch up to ``upto``."""
        folders = {n: f"{self.load_keys.folder(n)}/{LOAD}={load}" for n in self.load_keys.numbers() if n <= upto}
        return {n: f for n, f in folders.items() if (at := self._path(f))[0].exists(at[1])}

    def end_loads(self, loads: list[str], upto: int) -> None:
        """Write snapshot ``upto + 1``, without the keys that these full loads lacked in all of their batches."""
        if upto + 1 not in self.snapshots.versions():
            table = self._state(upto, newest=upto)
            for load in sorted(loads):
                if folders := self._load_folders(load, upto):
                    table = soft_delete(table, self.spark.read.parquet(*folders.values()), INTEGRATION_ID)
            self.snapshots.write(table, upto + 1)
        for load in loads:
            fs, mark = self._path(f"{self.ended}/{load}")
            fs.mkdirs(mark)
            for number, folder in self._load_folders(load, upto).items():
                fs, where = self._path(folder)
                fs.delete(where, True)
                if not any(f.isDirectory() for f in fs.listStatus(where.getParent())):
                    self.load_keys.remove([number])

    def retire(self, number: int) -> None:
        """Delete log folders and snapshots that two snapshots up to ``number`` have made superfluous."""
        complete = [v for v in self.snapshots.versions() if v <= number]
        if len(complete) > 2:
            self.snapshots.folders.remove(complete[:-2])
        if len(complete) > 1:
            self.log.remove([n for n in self.log.numbers() if n < complete[-2]])

    def apply(self, batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            # A key's row in a load stays in the log even if the same batch has a newer change of that key.
            same = [F.coalesce(INTEGRATION_ID, F.lit(NO_KEY)), ACTION, "elt_load_type", "elt_execution_date"]
            self.log.write(newest_per_group(batch, same, [F.col(CONTENT_HASH).desc()]), number)
            of_load = F.sha1(F.col("elt_execution_date").cast("string"))
            in_load = (F.col("elt_load_type") == "FULL") & F.col("elt_execution_date").isNotNull()
            found = batch.agg(
                F.collect_set(F.when(F.col(ACTION) == LOAD_END, of_load)).alias("ends"), F.collect_set(F.when(in_load, of_load)).alias("loads")
            ).first()
            repeated = number + 1 in self.snapshots.versions()
            ends = [load for load in found.ends if repeated or not self._has_ended(load)]
            open_ = [load for load in found.loads if load in ends or not self._has_ended(load)]
            if open_:
                keys = batch.where(in_load & of_load.isin(open_)).select(INTEGRATION_ID, "elt_delete_ind", "elt_load_type", of_load.alias(LOAD))
                self.load_keys.write(keys, number, [LOAD])
            if ends:
                self.end_loads(ends, number)
            elif len(self._pending(number)[1]) >= self.compact_every:
                self.compact(number)
            self.retire(number)
        finally:
            batch.unpersist()

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return run_available(
            stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def dump_inserts(batch: DataFrame, path: str, number: int) -> None:
    """The inserted rows of a micro-batch to a folder of its own, which a repeated batch overwrites."""
    batch.where(F.col(ACTION) == "INSERT").write.mode("overwrite").parquet(f"{path}/batch={number}")


#: Rows of a file of :func:`replay_files`, about.
ROWS_PER_FILE = 4_000_000


def replay_files(df: DataFrame, path: str, step: str, fmt: str = "parquet", rows_per_file: int = ROWS_PER_FILE, **options) -> None:
    """A table as files per step value, to be streamed: steps one after the other, so all files of a step are older than
    those of the next (null comes first), and each in as many files, by a task each, as its rows ask for."""
    kind = df.schema[step].dataType
    steps = df.groupBy(step).agg(F.count(F.lit(1))).orderBy(step).collect() or [(None, 1)]
    for i, (value, n) in enumerate(steps):
        rows = df.where(F.col(step).eqNullSafe(F.lit(value).cast(kind))).repartition(-(-n // rows_per_file))
        rows.write.mode("append" if i else "error").partitionBy(step).format(fmt).options(**options).save(path)
