"""Helpers shared by the operators: input columns, word hashing on Arrow batches, staged tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.session import scratch_path, session_conf
from adpulse.sources import folders

# A word is a run of other bytes than ASCII white space, which is also what ``bytes.split()`` does.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
# Bytes of text handled at once; bounds the memory of the array arithmetic, not the length of a text.
SLICE_BYTES = 2_000_000
LAST_ID = 2**63 - 1
RELEASE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Rows of a batch that goes to Python at once: bounds what executors and their Python workers hold of long texts.
BATCH_ROWS, _BATCH_KEY = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> dict[str, str]:
    """Setting for jobs that hand texts to Python; a session that asks for fewer rows gets these."""
    rows = int(spark.conf.get(_BATCH_KEY))
    return {_BATCH_KEY: str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)}


def staged(rows: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``rows`` written as a table in the shared folder and read back: lineage ends here, what several consumers read is
    computed once, and the shuffle files that made it go at once."""
    path = scratch_path(rows.sparkSession, purpose)
    with session_conf(rows.sparkSession, {**RELEASE_CONF, **small_batches(rows.sparkSession)}):
        rows.write.option("compression", compression).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def unstaged(*tables: DataFrame | None) -> None:
    """Removes staged tables that nothing reads any more, so that a long job holds no more than it needs."""
    for table in tables:
        files = table.inputFiles() if table is not None else []
        if files:
            folders.remove(table.sparkSession, files[0].rpartition("/")[0])


def shared_files(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a shared folder, and the folder's path there, for what Spark's own writers cannot lay out."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def row_key() -> Column:
    """Identifies a row by its id and text, so that rows which share an id, or have none, stay apart; equal rows share
    a key and get equal results."""
    return F.xxhash64("doc_id", "text")


def rank_id() -> Column:
    """Order of documents: by doc_id, rows without one last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


# -- hashing ---------------------------------------------------------------------------------------------------------

_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[list(SPACES)] = 0
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_PLACE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD1342543DE82EF95)
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 2**64))


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """The words of consecutive texts: hashes, byte spans, and for each text the range of its words."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first[i]:first[i + 1] are the words of text i

    def __len__(self) -> int:
        return len(self.hashes)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on; meaningless where the text ends before (see ``whole``)."""
        total = np.zeros(max(0, len(self) - size + 1), np.uint64)
        for step, factor in enumerate(powers(_STEP, size)):
            total += self.hashes[step : step + len(total)] * factor
        return mix(total)

    def whole(self, size: int) -> np.ndarray:
        """Indices of words from which ``size`` words of the same text go on."""
        at = np.arange(max(0, len(self) - size + 1))
        end = np.repeat(self.first[1:], np.diff(self.first))
        return at[at + size <= end[: len(at)]]

    def prefix(self) -> np.ndarray:
        sums = np.zeros(len(self) + 1, np.uint64)
        np.cumsum(self.hashes * powers(_STEP, len(self)), out=sums[1:])
        return sums


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words start:end from ``Words.prefix``, independent of their place."""
    back = powers(_STEP_BACK, len(prefix))
    return mix(mix((prefix[end] - prefix[start]) * back[start]) + (end - start).astype(np.uint64))


# For words without punctuation: all ASCII but letters and digits separates.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(data: np.ndarray, offsets: np.ndarray, separates: np.ndarray = _IS_SPACE) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``: runs of bytes that do not separate."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~separates[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(starts)
    ends = inside
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    ends = np.flatnonzero(ends) + 1
    if len(starts):
        place = np.arange(len(data), dtype=np.int64)
        place -= np.repeat(np.concatenate([[0], starts[1:]]), np.diff(np.concatenate([[0], starts[1:], [len(data)]])))
        # White space before the first word counts nothing, its byte value being 0.
        if starts[0]:
            place[: starts[1] if len(starts) > 1 else None] -= starts[0]
            place[: starts[0]] = 0
        longest = int((ends - starts).max())
        np.minimum(place, longest, out=place)
        terms = _BYTE[data]
        terms[separates[data]] = 0
        terms *= powers(_PLACE, longest + 1)[place]
        hashes = mix(np.add.reduceat(terms, starts))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, hashes, starts, ends, np.searchsorted(starts, offsets))


def lane_words(data: np.ndarray, offsets: np.ndarray, separates: np.ndarray = _IS_SPACE) -> Words:
    """:func:`words_of` with other hashes, taken from eight bytes of a word at once: a few operations per word instead of
    some per byte."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~separates[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    inside[:-1] &= ~inside[1:] | edge[1:-1]
    ends = np.flatnonzero(inside) + 1
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    hashes = length.astype(np.uint64) * _PLACE
    left = np.arange(len(length))
    step = 0
    while len(left):
        rest = length[left] - step
        beyond = np.uint64(8) * np.clip(8 - rest, 0, 7).astype(np.uint64)
        hashes[left] = mix(hashes[left] * _STEP + (lanes[starts[left] + step] << beyond))
        left = left[rest > 8]
        step += 8
    return Words(data, hashes, starts, ends, np.searchsorted(starts, offsets))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, null as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data and len(data) else np.zeros(0, np.uint8), at


def text_slices(
    batch: pa.RecordBatch, column: str = "text", separates: np.ndarray = _IS_SPACE, words=words_of, size: int = SLICE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) of consecutive rows, about ``size`` bytes at once."""
    data, offsets = text_buffer(batch.column(column))
    start, count = 0, len(offsets) - 1
    while start < count:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(count, max(start + 1, end))
        yield start, end, words(data, offsets[start : end + 1], separates)
        start = end
