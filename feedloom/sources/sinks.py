"""Text outputs: extracts, dumps, and bounded files with header and trailer."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.functions.dates import file_suffix
from feedloom.session import written


def extract_name(prefix: str, template: str | None, at: dt.datetime, fmt: str = "csv") -> str:
    suffix = file_suffix(template, at)
    return f"{prefix}_{suffix}.{fmt}" if suffix else f"{prefix}.{fmt}"


def write_extract(
    df: DataFrame,
    folder: str,
    prefix: str,
    at: dt.datetime,
    template: str | None = "",
    sep: str = ",",
    header: bool = False,
    fmt: str = "csv",
    single_file: bool = False,
) -> str:
    """A query result below ``<prefix>_<date>.<fmt>``. One file only on request: it runs in one task."""
    path = f"{folder.rstrip('/')}/{extract_name(prefix, template, at, fmt)}"
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", sep).option("header", header).option("escape", '"').csv(path)
    return path


def write_quoted(df: DataFrame, path: str, sep: str = ",") -> None:
    """Lower-case header, every field quoted."""
    out = df.toDF(*[c.lower() for c in df.columns])
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("sep", sep).csv(path)


def chunked(df: DataFrame, counter: str, max_records: int) -> DataFrame:
    """Add ``chunk`` (0-based) and ``record_in_chunk`` (1-based) from a dense 1-based record number.

    An entity's lines share their number, so none is ever cut in two.
    """
    zero = F.col(counter) - 1
    return df.withColumns({"chunk": F.floor(zero / max_records), "record_in_chunk": zero % max_records + 1})


def bounded_lines(
    chunks: DataFrame,
    line: Column,
    order: Sequence[str],
    header: Column | None,
    trailer: Column | None,
    keys: Sequence[str] = (),
    counted: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines of all chunks with a header before and a trailer after each.

    ``trailer`` may use ``records``, the number of distinct records of the chunk. ``counted`` is the list
    of records with their chunk where that is at hand, so that the lines need not be read to count them.
    Columns of ``keep`` stay on the lines for the condition of :func:`write_bounded`; edges have null there.
    """
    group = [*keys, "chunk"]
    key = F.struct(*order)
    body = chunks.select(*group, F.lit(1).alias("place"), key.alias("at"), line.alias("value"), *keep)
    totals = (counted or chunks).groupBy(*group).agg(F.max("record_in_chunk").alias("records"))
    nothing = F.lit(None).cast(body.schema["at"].dataType)
    for place, text in ((0, header), (2, trailer)):
        if text is not None:
            edge = totals.select(*group, F.lit(place).alias("place"), nothing.alias("at"), text.alias("value"), *[F.lit(None).cast(body.schema[c].dataType).alias(c) for c in keep])
            body = body.unionByName(edge)
    return body


def write_bounded(lines: DataFrame, path: str, keys: Sequence[str] = (), having: Column | None = None) -> DataFrame:
    """One file per chunk, all in one folder, lines in order, equals by their text; a row per file comes back.

    Files are named after their keys and chunk (``kind=A.chunk=12.txt``); the manifest has the keys, ``chunk``,
    ``path`` and ``n_lines``. Chunks are dealt out by their hash, so a task writes any number of them, one after the
    other and a batch of lines at a time. A file is written aside and named when it is whole: a task that is run again
    puts the same file in its place. The folder is emptied first. Null lines are empty ones.

    ``having`` is a condition that lines must meet to be written. It is checked where the lines of a chunk have met, in
    order, so it may look over them by windows that are partitioned by the keys, ``chunk``, ``place`` and ``at`` without
    another shuffle or sort.
    """
    group, spark = [*keys, "chunk"], lines.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(where, True)
    files.mkdirs(where)
    folder = files.makeQualified(where).toString()
    aside = f"{folder}/_unfinished"
    schema = T.StructType([*[lines.schema[c] for c in group], T.StructField("path", T.StringType()), T.StructField("n_lines", T.LongType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(f"{base}/_unfinished", recursive=True)
        sink, now, count = None, None, 0

        def close() -> pa.RecordBatch:
            sink.close()
            parts = [f"{c}={quote(str(v), safe='') if v is not None else '__HIVE_DEFAULT_PARTITION__'}" for c, v in zip(group, now, strict=True)]
            name = f"{'.'.join(parts)}.txt"
            try:
                store.move(unfinished, f"{base}/{name}")
            except OSError:
                if store.get_file_info(f"{base}/{name}").type != pafs.FileType.File:
                    raise
                store.delete_file(unfinished)
            columns = [pa.array([v], kind) for v, kind in zip(now, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64())], [*group, "path", "n_lines"])

        for batch in batches:
            kinds = [batch.column(c).type for c in group]
            rows, values = list(zip(*[batch.column(c).to_pylist() for c in group], strict=True)), batch.column("value").to_pylist()
            edges = [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
            for first, last in zip([0, *edges], [*edges, len(rows)], strict=True):
                if first == last:
                    continue
                if rows[first] != now or sink is None:
                    if sink is not None:
                        yield close()
                    now, count, unfinished = rows[first], 0, f"{base}/_unfinished/{uuid.uuid4().hex}"
                    sink = store.open_output_stream(unfinished)
                sink.write(b"".join([(v or b"") + b"\n" for v in values[first:last]]))
                count += last - first
        if sink is not None:
            yield close()

    ordered = lines.repartition(*group).sortWithinPartitions(*group, "place", "at", "value")
    if having is not None:
        ordered = ordered.withColumn("__having", having).where("__having")
    manifest = written(ordered.select(*group, F.col("value").cast("binary").alias("value")).mapInArrow(write, schema), "bounded-files")
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(aside), True)
    return manifest
