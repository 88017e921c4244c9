"""Token sequences in training order, as binary shards of fixed stride.

Documents are tokenized and cut into sequences, numbered densely in the order of the data. A keyed Feistel network over
the next even number of bits, with cycle-walking, permutes 0..n-1, so every sequence has a global slot that needs no
shuffled index to look up, and the order can be drawn again from the key alone. Each shard is one partition, whose task
writes the sequences of consecutive slots, padded to one stride, to a binary file: slot s of a shard starts at byte
``(s % shard_sequences) * stride``, so a reader goes on from any slot with one seek. An index table names each slot's file
and origin. It is written last and lists only the files of the attempts that succeeded.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adpulse.llm.common import mix, rank_id, row_key, shared_files, staged, unstaged
from adpulse.llm.tokens import token_sequences
from adpulse.session import scratch_path

SEQUENCE_TOKENS = 512
SHARD_SEQUENCES = 16_384
ROUNDS = 6
# Rounds in which the shards are written; each reads the staged sequences again.
ROUNDS_OF_SHARDS = 2
_PIECE = "doc_id long, piece int, start long, length long, crc long"
_INDEX = f"slot long, {_PIECE}, payload_crc long, shard long, file string"


def permute(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """Slots of ``numbers`` under the permutation of 0..count-1 that ``key`` names."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64(2**half - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % 2**64))
    slots = numbers.astype(np.uint64)
    walking = np.arange(len(slots))
    while len(walking):
        values = slots[walking]
        left, right = values >> shift, values & mask
        for round_key in keys:
            left, right = right, left ^ (mix(right ^ round_key) & mask)
        slots[walking] = left << shift | right
        walking = walking[slots[walking] >= np.uint64(count)]
    return slots.astype(np.int64)


# -- numbers -----------------------------------------------------------------------------------------------------------


def in_data_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text, file, row``: rows of a table in files have their place there, whatever the partitioning; other rows
    are sorted by doc_id (none last) and text first, and have their place in that order."""
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    try:
        return docs.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        ordered = docs.orderBy(rank_id(), row_key()).select(*columns)
        return ordered.select("*", F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("row"))


def _sequences(tokenizer_path: str, sequence_tokens: int):
    """Sequences with their number within a run: consecutive rows of one file, or the rows of one task in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cut = token_sequences(tokenizer_path, sequence_tokens)
        run_of, last, number = (None, TaskContext.get().partitionId()), None, 0
        for batch in batches:
            places = zip(batch.column("file").to_pylist(), batch.column("row").to_pylist())
            begin = 0
            for counts, made in cut(batch.column("text")):
                files, firsts, numbers = [], [], []
                for count, (file, row) in zip(counts.tolist(), places):
                    if row is not None and last != (file, row - 1):
                        run_of, number = (file, row), 0
                    last = (file, row)
                    files.append(run_of[0])
                    firsts.append(run_of[1])
                    numbers.append(number)
                    number += count
                own = pa.array(np.repeat(np.arange(len(counts)), counts))
                place = np.repeat(numbers, counts) + made.column("piece").to_numpy()
                doc_ids = batch.column("doc_id").slice(begin, len(counts)).take(own)
                begin += len(counts)
                more = [pa.array(files, pa.string()).take(own), pa.array(firsts, pa.int64()).take(own), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays([doc_ids, *made.columns, *more], _SEQUENCE_NAMES)

    return run


_SEQUENCES = f"{_PIECE}, ids binary, run_file string, run_first long, place long"
_SEQUENCE_NAMES = [part.split()[0] for part in _SEQUENCES.split(", ")]


def numbered(sequences: DataFrame) -> DataFrame:
    """Adds ``number``: dense from 0, in the order of files, rows and pieces."""
    keys = ["run_file", "run_first"]
    runs = sequences.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # One row per piece of a file that a task read: a few numbers each.
    before = runs.select(*(F.col(key).alias(f"_{key}") for key in keys), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    same = F.col("run_file").eqNullSafe(F.col("_run_file")) & (F.col("run_first") == F.col("_run_first"))
    return sequences.join(F.broadcast(before), same).withColumn("number", F.col("before") + F.col("place"))


def _slot(count: int, key: int):
    """Column function: the slots of numbers. Only these go to Python, the ids do not."""

    @F.arrow_udf("long")
    def slot(numbers: pa.Array) -> pa.Array:
        return pa.array(permute(numbers.to_numpy(zero_copy_only=False), count, key))

    return slot


# -- shards ------------------------------------------------------------------------------------------------------------


def padded(ids: pa.Array, stride: int) -> bytes:
    """The values one behind the other, each filled up with zeros to ``stride`` bytes."""
    offsets = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset)
    data = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros(len(ids) * stride, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(ids)) * stride - (offsets[:-1] - offsets[0]), sizes)] = data
    return out.tobytes()


def _written(path: str, stride: int, shard_sequences: int):
    """Writes the rows of a partition, one shard in order of slots, and yields their index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = shared_files(path)
        out, shard, name = None, None, None
        try:
            for batch in batches:
                payload = memoryview(padded(batch.column("ids").cast(pa.binary()), stride))
                shards = batch.column("shard").to_numpy(zero_copy_only=False)
                slots = batch.column("slot").to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(shards) else shards
                names = []
                for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(shards)]):
                    own, slot = int(shards[at]), int(slots[at])
                    if own != shard:
                        if out is not None:
                            out.close()
                        # A name of its own for each attempt: a task run twice never touches its twin's file.
                        shard, name = own, f"shard-{own:08d}-{uuid.uuid4().hex}.bin"
                        files.create_dir(folder, recursive=True)
                        out = files.open_output_stream(f"{folder}/{name}", compression=None)
                        if slot % shard_sequences:
                            raise ValueError(f"shard {own} starts with slot {slot}")
                    out.write(payload[at * stride : end * stride])
                    names += [name] * (end - at)
                crcs = [zlib.crc32(payload[at * stride : (at + 1) * stride]) for at in range(batch.num_rows)]
                own = [batch.column(column) for column in ("slot", "doc_id", "piece", "start", "length", "crc")]
                more = [pa.array(crcs, pa.int64()), batch.column("shard").cast(pa.int64()), pa.array(names, pa.string())]
                yield pa.RecordBatch.from_arrays([*own, *more], [part.split()[0] for part in _INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return run


def _read(path: str, stride: int, shard_sequences: int):
    """Index rows with their payload: consecutive slots of a file are one read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = shared_files(path)
        source, opened = None, None
        try:
            for batch in batches:
                slots = batch.column("slot").to_numpy(zero_copy_only=False)
                names = batch.column("file").to_pylist()
                payload: list[bytes] = []
                at = 0
                while at < len(slots):
                    end = at + 1
                    while end < len(slots) and slots[end] == slots[end - 1] + 1 and names[end] == names[at]:
                        end += 1
                    if names[at] != opened:
                        if source is not None:
                            source.close()
                        opened, source = names[at], files.open_input_file(f"{folder}/{names[at]}")
                    source.seek(int(slots[at] % shard_sequences) * stride)
                    data = source.read((end - at) * stride)
                    payload += [data[n * stride : (n + 1) * stride] for n in range(end - at)]
                    at = end
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(payload, pa.binary())], [*batch.schema.names, "payload"])
        finally:
            if source is not None:
                source.close()

    return run


@dataclass(frozen=True)
class Shards:
    """Binary files below ``path`` and their index; ``stride`` bytes per sequence."""

    path: str
    sequences: int
    shard_sequences: int
    stride: int

    def index(self, spark: SparkSession, slot: int = 0, count: int | None = None) -> DataFrame:
        """Origin and file of ``count`` slots from ``slot`` on."""
        end = self.sequences if count is None else min(self.sequences, slot + count)
        rows = spark.read.schema(_INDEX).parquet(f"{self.path}/index")
        return rows.where((F.col("slot") >= slot) & (F.col("slot") < end))

    def read(self, spark: SparkSession, slot: int = 0, count: int | None = None) -> DataFrame:
        """The index rows with their ``payload``, opening only their shards, each at its place."""
        read = _read(self.path, self.stride, self.shard_sequences)
        return self.index(spark, slot, count).mapInArrow(read, f"{_INDEX}, payload binary")

    def locate(self, spark: SparkSession, slot: int) -> tuple[str, int]:
        """File and byte at which a sequential reader goes on with ``slot``."""
        name = self.index(spark, slot, 1).first()["file"]
        return f"{self.path}/{name}", slot % self.shard_sequences * self.stride


def write_in_training_order(
    docs: DataFrame,
    tokenizer_path: str,
    key: int,
    path: str | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_sequences: int = SHARD_SEQUENCES,
) -> Shards:
    """Writes the sequences of ``docs`` to ``path`` (default: a folder in the shared scratch folder).

    A sequence has up to ``sequence_tokens`` ids of one document (its ids and one end marker) as little-endian unsigned
    16-bit numbers, padded with zeros to ``2 * sequence_tokens`` bytes; ``length`` tells how many count and ``crc`` is
    that of its ids as 32-bit numbers. A null or empty text is the end marker alone; every row makes sequences of its
    own, also where doc_ids repeat; other columns are ignored. The same files, or the same rows, and the same key give
    the same order, whatever the partitioning (rows alike in doc_id and text may change places). A vocabulary of more
    than 65,536 ids raises an error.
    """
    spark = docs.sparkSession
    sequences = staged(
        in_data_order(docs).mapInArrow(_sequences(tokenizer_path, sequence_tokens), _SEQUENCES), "sequences", compression="zstd"
    )
    count = sequences.count()
    shards = Shards((path or scratch_path(spark, "shards")).rstrip("/"), count, shard_sequences, 2 * sequence_tokens)
    columns = ["doc_id", "piece", "start", "length", "crc", "ids"]
    ordered = numbered(sequences).select(_slot(count, key)("number").alias("slot"), *columns)
    ordered = ordered.withColumn("shard", F.expr(f"int(slot div {shard_sequences})"))
    total = max(1, -(-count // shard_sequences))
    # The shards are written in rounds, so that only a part of the sequences is held a second time by a shuffle.
    rounds, parts = min(ROUNDS_OF_SHARDS, total), []
    for turn in range(rounds):
        first, end = turn * total // rounds, (turn + 1) * total // rounds
        own = ordered.where((F.col("shard") >= first) & (F.col("shard") < end))
        written = (
            own.repartitionById(end - first, (F.col("shard") - F.lit(first)).cast("int"))
            .sortWithinPartitions("slot")
            .mapInArrow(_written(shards.path, shards.stride, shard_sequences), _INDEX)
        )
        parts.append(staged(written, "index"))
    unstaged(sequences)
    # Last and at once: a run that ends before has no index.
    reduce(DataFrame.unionByName, parts).write.parquet(f"{shards.path}/index")
    unstaged(*parts)
    return shards


def manifest(spark: SparkSession, shards: Shards) -> DataFrame:
    """One row per sequence, read back from the shards: slot, shard, row in it, doc_id, piece, start, length, the bytes
    of the stride, the checksum of the ids, and whether the bytes read back are those that were written."""
    return shards.read(spark).select(
        "slot",
        "shard",
        (F.col("slot") % shards.shard_sequences).alias("row"),
        "doc_id",
        "piece",
        "start",
        "length",
        F.length("payload").alias("stride"),
        F.col("crc").alias("ids_crc32"),
        (F.crc32("payload") == F.col("payload_crc")).alias("intact"),
    )
