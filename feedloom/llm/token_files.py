"""Arrow files of equal-length token sequences: written by range of document id, read without copying."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from feedloom.llm.token_ids import encoder_of, send_vocabulary
from feedloom.session import scratch_path, written

LENGTH = 2048
END_ID = 2
#: Sequences in a record batch: its ids take 512 KB at the default length.
BATCH = 64


def file_schema(length: int, ids: pa.DataType) -> pa.Schema:
    """``ids`` and ``mask`` (true: an id, false: padding) of one sequence, and the documents that begin in it, by offset."""
    return pa.schema(
        [
            pa.field("ids", pa.list_(pa.field("item", ids, False), length), False),
            pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False),
            pa.field("doc_ids", pa.list_(pa.int64()), False),
            pa.field("doc_offsets", pa.list_(pa.int32()), False),
        ]
    )


class SequenceWriter:
    """Collects documents and writes them as record batches of ``BATCH`` sequences; only the last one is padded."""

    def __init__(self, sink, length: int, ids: pa.DataType):
        self.length, self.schema = length, file_schema(length, ids)
        self.file = pa.ipc.new_file(sink, self.schema)
        self.ids, self.held = [], 0
        self.starts, self.names = [], []
        self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.starts.append(self.held)
        self.names.append(doc_id)
        self.ids.append(ids)
        self.held += len(ids)
        self.n_docs += 1
        self.n_tokens += len(ids)
        if self.held >= BATCH * self.length:
            self._flush(self.held // (BATCH * self.length) * BATCH)

    def _flush(self, sequences: int) -> None:
        """Write so many sequences of what is held, padding the last one where that is not enough."""
        size = sequences * self.length
        held = np.concatenate(self.ids) if self.ids else np.empty(0, np.uint32)
        ids = np.zeros(size, self.schema.field("ids").type.value_type.to_pandas_dtype())
        ids[: len(held)] = held[:size]
        mask = np.arange(size) < len(held)
        here = int(np.searchsorted(self.starts, size))
        rows, offsets = np.divmod(np.array(self.starts[:here], np.int64), self.length)
        bounds, names = np.searchsorted(rows, np.arange(sequences + 1)), self.names[:here]
        for first in range(0, sequences, BATCH):
            last = min(first + BATCH, sequences)
            of, to = slice(first * self.length, last * self.length), slice(bounds[first], bounds[last])
            starts = pa.array(bounds[first : last + 1] - bounds[first], pa.int32())
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(ids[of]), type=self.schema.field("ids").type),
                pa.FixedSizeListArray.from_arrays(pa.array(mask[of]), type=self.schema.field("mask").type),
                pa.ListArray.from_arrays(starts, pa.array(names[to], pa.int64())),
                pa.ListArray.from_arrays(starts, pa.array(offsets[to], pa.int32())),
            ]
            self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n_sequences += sequences
        self.ids, self.held = [held[size:]], max(0, self.held - size)
        self.starts, self.names = [s - size for s in self.starts[here:]], self.names[here:]

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        self.file.close()


def _crc(ids: np.ndarray, before: int = 0) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers, whatever width the file has."""
    return zlib.crc32(ids.astype("<u4", copy=False), before)


class SequenceFile:
    """Random access to the sequences of one file: ids and masks are views of the mapped file."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path)
        self.source = pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size

    def batches(self) -> Iterator[pa.RecordBatch]:
        return (self.reader.get_batch(i) for i in range(self.reader.num_record_batches))

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * BATCH + self.reader.get_batch(n - 1).num_rows if n else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        batch, start = self.reader.get_batch(i // BATCH), i % BATCH * self.length
        return batch.column(0).flatten().to_numpy()[start : start + self.length], batch.column(1).flatten().slice(start, self.length)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """Id, start in the file, number of ids and their CRC-32 of every document, one batch in memory at a time."""
        doc, at, count, crc, base = None, None, 0, 0, 0
        for batch in self.batches():
            ids = batch.column(0).flatten().to_numpy()
            real = batch.column(1).flatten().true_count
            rows = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            starts = rows * self.length + batch.column(3).flatten().to_numpy()
            names = batch.column(2).flatten().to_pylist()
            first = int(starts[0]) if len(starts) else real
            if at is not None:
                crc, count = _crc(ids[:first], crc), count + first
            for name, start, end in zip(names, starts, [*starts[1:], real][: len(starts)], strict=True):
                if at is not None:
                    yield doc, at, count, crc
                doc, at, count, crc = name, base + int(start), int(end - start), _crc(ids[start:end])
            base += len(ids)
        if at is not None:
            yield doc, at, count, crc


def write_token_files(
    docs: DataFrame, vocabulary: str, folder: str | None = None, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """Write all texts (``doc_id``, ``text``) as token files below ``folder``; one manifest row per file comes back.

    Documents are dealt out by range of ``doc_id`` (null first, equal ids by the hash of their text) and each task
    writes its range in order into a file of its own, as it reads it. A task that is run again writes another file;
    the manifest names the files of the tasks that counted, and readers go by it. Null and blank texts are a single
    end id, repeated rows are written each, other columns are not read, no documents give an empty manifest.
    ``offset`` is the number of ids in all files before. Ids take 16 bits where the vocabulary allows it, 32 otherwise.
    The vocabulary's file is read on the driver.
    """
    spark = docs.sparkSession
    sent = send_vocabulary(spark, vocabulary)
    folder = folder or scratch_path(spark, "token-files")
    schema = "part int, path string, n_docs long, n_tokens long, n_sequences long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        task, out, sink, end = TaskContext.get(), None, None, np.array([end_id], np.uint32)
        encoder = encoder_of(sent)
        width = pa.uint16() if max(end_id, encoder.size - 1) < 1 << 16 else pa.uint32()
        path = f"{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{path}")
                out = SequenceWriter(sink, length, width)
            ids, bounds = encoder.encode(batch.column(1))
            for doc_id, first, last in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                out.add(doc_id, np.concatenate([ids[first:last], end]))
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": task.partitionId(), "path": f"{folder}/{path}", "n_docs": out.n_docs, "n_tokens": out.n_tokens, "n_sequences": out.n_sequences}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_sequences", pa.int64())]),
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    files = written(ordered.mapInArrow(write, schema), "token-manifest")
    sent.destroy()
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files the manifest names."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(SequenceFile(path).documents())
                ids, starts, counts, crcs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([offset + s for s in starts], pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = manifest.select("path", "offset")
    return files.repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
