"""Streams over files written from the shared tables; the results equal those of one batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import state
from feedloom.plans.registry import query, table
from feedloom.plans.state_queries import ORDERS_SQL, STANDING_SQL, order_changes, order_target
from feedloom.session import scratch_path
from feedloom.streaming import streams
from feedloom.types import INTEGRATION_ID


def day_files(spark, sf, fmt="parquet"):
    """Events as one folder of files per week of the month."""
    path = scratch_path(spark, "event-days")
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "props", F.floor((F.dayofmonth("ts") - 1) / 7).alias("week"))
    streams.replay_files(e, path, "week", fmt, header=True, escape='"')
    return path


EVENT_SCHEMA = "event_id bigint, ts string, user_id bigint, event_type string, props string, week bigint"


@query("stream_append", "SELECT event_id, event_type, cast(ts AS varchar) AS ts FROM events")
def stream_append(spark, sf):
    stream = streams.file_stream(spark, day_files(spark, sf), EVENT_SCHEMA, files_per_trigger=2)
    out = scratch_path(spark, "appended")
    streams.append_to_parquet(stream.select("event_id", "event_type", "ts"), out, scratch_path(spark, "cp"))
    return spark.read.parquet(out)


@query("stream_memory_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_memory_counts(spark, sf):
    stream = streams.file_stream(spark, day_files(spark, sf), EVENT_SCHEMA, files_per_trigger=3)
    name = scratch_path(spark, "counts").rsplit("/", 1)[1].replace("-", "_")
    return streams.to_memory(stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), name)


@query("stream_parquet_sink", "SELECT event_id, user_id, props FROM events")
def stream_parquet_sink(spark, sf):
    """A CSV stream to Parquet; a second run from the same checkpoint adds nothing."""
    path, out, checkpoint = day_files(spark, sf, "csv"), scratch_path(spark, "sink"), scratch_path(spark, "cp")
    schema = "event_id bigint, ts string, user_id bigint, event_type string, props string, week bigint"
    for _ in range(2):
        stream = streams.file_stream(spark, path, schema, "csv", 3, header="true", escape='"')
        streams.append_to_parquet(stream.select("event_id", "user_id", "props"), out, checkpoint)
    return spark.read.parquet(out)


@query("stream_json_batch", "SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events")
def stream_json_batch(spark, sf):
    stream = streams.file_stream(spark, day_files(spark, sf), EVENT_SCHEMA, files_per_trigger=3)
    parsed = stream.select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.k")
    out = scratch_path(spark, "json-batches")
    streams.write_batches(parsed, out, scratch_path(spark, "cp"))
    return spark.read.parquet(out).drop("batch")


@query("stream_upsert", f"""
WITH {STANDING_SQL} SELECT id AS elt_integration_id, custkey, status, price, priority, h AS elt_columns_hash, exec AS elt_execution_date, del AS elt_delete_ind FROM standing
""")
def stream_upsert(spark, sf):
    """The changes as files of a stream, the table read from snapshot and change log."""
    changes = order_changes(spark, sf)
    path = scratch_path(spark, "changes")
    streams.replay_files(changes, path, "elt_execution_date")
    target = streams.ChangeStream(spark, scratch_path(spark, "target"), order_target(spark, sf))
    stream = streams.file_stream(spark, path, changes.schema, files_per_trigger=1)
    target.run(stream.withColumn("elt_execution_date", F.col("elt_execution_date").cast("string")), scratch_path(spark, "cp"))
    return target.current().drop("elt_load_type")


@query("stream_full_load", f"""
WITH {STANDING_SQL} SELECT id AS elt_integration_id, status, price, exec AS elt_execution_date,
  CASE WHEN id NOT IN (SELECT id FROM changes) AND id NOT IN (SELECT id FROM o WHERE y = 2000 AND priority = '3-MEDIUM') THEN 1 ELSE del END AS elt_delete_ind FROM standing
""")
def stream_full_load(spark, sf):
    """An incremental load, a full load of several files, one per micro-batch, and its end: keys that none of the
    files had become deleted."""
    changes = order_changes(spark, sf)
    early, late = changes.where("elt_execution_date = '2024-01-02'"), changes.where("elt_execution_date = '2024-01-03'")
    path = scratch_path(spark, "changes")
    late_full = late.withColumn("elt_load_type", F.lit("FULL")).repartition(3, INTEGRATION_ID)
    end = {"elt_stream_action": streams.LOAD_END, "elt_load_type": "FULL", "elt_execution_date": "2024-01-03"}
    marker = spark.range(1).select(*[F.lit(end.get(f.name)).cast(f.dataType).alias(f.name) for f in changes.schema])
    target = streams.ChangeStream(spark, scratch_path(spark, "target"), order_target(spark, sf))
    checkpoint = scratch_path(spark, "cp")
    for step, batch in enumerate((early, late_full, marker)):
        batch.write.parquet(f"{path}/step={step}")
        stream = streams.file_stream(spark, path, changes.schema, files_per_trigger=1, recursiveFileLookup="true")
        target.run(stream, checkpoint)
    return target.current().select(INTEGRATION_ID, "status", "price", "elt_execution_date", "elt_delete_ind")


@query("stream_dump", f"WITH {ORDERS_SQL} SELECT id AS elt_integration_id, price FROM changes")
def stream_dump(spark, sf):
    """The inserts of a consumed change stream, one dump folder per micro-batch, read together."""
    newest = state.dedupe_changes(order_changes(spark, sf).where("elt_integration_id IS NOT NULL"), INTEGRATION_ID)
    path = scratch_path(spark, "dump-in")
    newest.repartition(4, INTEGRATION_ID).write.parquet(path)
    out = scratch_path(spark, "dump")
    stream = streams.file_stream(spark, path, newest.schema, files_per_trigger=2)
    query_ = stream.writeStream.foreachBatch(lambda b, n: streams.dump_inserts(b, out, n)).option("checkpointLocation", scratch_path(spark, "cp")).trigger(availableNow=True).start()
    streams.run_available(query_)
    return spark.read.parquet(out).select(INTEGRATION_ID, "price")
