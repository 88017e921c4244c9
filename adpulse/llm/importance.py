"""Importance resampling towards a target distribution.

Features of a text are its runs of up to ``max_words`` consecutive words; they are hashed into buckets. A bucket's gain is
the smoothed log ratio of its share among the target's features and its share among all features. A document's weight is
the mean gain of its features, its score that weight plus Gumbel noise drawn from its id, and the highest scores win,
which is sampling without replacement in proportion to the weights.

Inside a task, texts are handled in slices. :class:`NgramTable` interns the n-grams of a slice: an open-addressed NumPy
table with xxhash64 keys, in which equal keys count as equal only after their bytes were compared. Each slot holds the
n-gram's bucket and count, so that a bucket is worked out once per distinct n-gram; occurrences keep their slot and gather
the gain from there. Spark sums the counts of the buckets and the scores' ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import PUNCTUATION, SLICE_BYTES, staged, text_buffer
from adpulse.session import session_conf

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
SHARE_PERCENT = 10
SEED = 2024
# Bound of what is sent to all tasks: one gain per bucket, one offset per score.
MAX_BUCKETS = 1 << 22

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)
_LANE = 8


# -- n-grams of a slice ----------------------------------------------------------------------------------------------


@dataclass
class Ngrams:
    """N-grams as byte spans of ``data``, in which single spaces part the words of a text; ``owner`` is an n-gram's
    text, ``words`` the number of words per text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, max_words: int) -> Ngrams:
        """N-grams of the texts ``data[offsets[i]:offsets[i + 1]]``. A-Z is lower-cased; words are runs of letters,
        digits and bytes beyond ASCII."""
        data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        inside = ~PUNCTUATION[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        finishes[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        first = np.searchsorted(starts, offsets)
        words = np.diff(first)
        owner = np.repeat(np.arange(len(words)), words)
        # Word bytes, and a space behind each word, also where the next text's first byte follows at once.
        lengths = ends - starts
        places = np.concatenate([[0], np.cumsum(lengths + 1)])
        packed = np.full(int(places[-1]) + 4 * _LANE, 0x20, np.uint8)
        kept = np.flatnonzero(inside)
        values = data[kept]
        upper = (values >= 0x41) & (values <= 0x5A)
        values = values + (upper * 0x20).astype(np.uint8)
        packed[np.arange(len(kept)) + np.repeat(np.arange(len(starts)), lengths)] = values
        starts, ends = places[:-1], places[1:] - 1
        last = np.repeat(first[1:], words)  # the word after the own text's last
        spans = []
        for size in range(1, max_words + 1):
            at = np.arange(max(0, len(starts) - size + 1))
            at = at[at + size <= last[: len(at)]]
            spans.append((starts[at], ends[at + size - 1], owner[at]))
        joined = [np.concatenate(part) for part in zip(*spans)]
        return cls(packed, *joined, words)

    def __len__(self) -> int:
        return len(self.starts)


def _rotate(values: np.ndarray, bits: int) -> np.ndarray:
    return (values << np.uint64(bits)) | (values >> np.uint64(64 - bits))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit value at every byte."""
    return np.ndarray(len(data) - _LANE + 1, dtype="<u8", buffer=data, strides=(1,))


def xxhash64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of byte spans of a buffer that goes on for eight bytes after the last span. Spans of 32 bytes and
    more, which the algorithm treats otherwise and which are rare, are left to the library."""
    lengths = ends - starts
    lanes = _lanes(data)
    out = lengths.astype(np.uint64) + _P5
    at = starts.copy()
    left = np.where(lengths < 32, lengths, 0)
    for _ in range(3):
        own = np.flatnonzero(left >= 8)
        if not len(own):
            break
        term = _rotate(lanes[at[own]] * _P2, 31) * _P1
        out[own] = _rotate(out[own] ^ term, 27) * _P1 + _P4
        at[own] += 8
        left[own] -= 8
    own = np.flatnonzero(left >= 4)
    out[own] = _rotate(out[own] ^ ((lanes[at[own]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[own] += 4
    left[own] -= 4
    for _ in range(3):
        own = np.flatnonzero(left > 0)
        if not len(own):
            break
        out[own] = _rotate(out[own] ^ (data[at[own]].astype(np.uint64) * _P5), 11) * _P1
        at[own] += 1
        left[own] -= 1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    out ^= out >> np.uint64(32)
    for long in np.flatnonzero(lengths >= 32):
        out[long] = xxhash.xxh64_intdigest(data[starts[long] : ends[long]].tobytes())
    return out


class NgramTable:
    """Open-addressed table of the distinct n-grams of one slice, with linear probing.

    ``bucket`` and ``count`` have one entry per slot; ``slots`` is the slot of every occurrence. The table has at least
    twice as many slots as occurrences, so it never fills up.
    """

    def __init__(self, grams: Ngrams, buckets: int = BUCKETS, hashes: np.ndarray | None = None) -> None:
        self._grams, self._lanes = grams, _lanes(grams.data)
        hashes = xxhash64(grams.data, grams.starts, grams.ends) if hashes is None else hashes
        size = 1 << max(4, (2 * len(grams)).bit_length())
        self._holder = np.full(size, -1, np.int64)  # the occurrence whose bytes a slot holds
        self.slots = np.zeros(len(grams), np.int64)
        pending = np.arange(len(grams))
        at = (hashes & np.uint64(size - 1)).astype(np.int64)
        while len(pending):
            free = np.flatnonzero(self._holder[at] < 0)
            # Of several that reach a free slot at once the last one written holds it.
            self._holder[at[free]] = pending[free]
            held = self._holder[at]
            same = np.flatnonzero(hashes[held] == hashes[pending])
            same = same[self._equal_bytes(held[same], pending[same])]
            self.slots[pending[same]] = at[same]
            rest = np.ones(len(pending), bool)
            rest[same] = False
            pending, at = pending[rest], (at[rest] + 1) & (size - 1)
        self.used = np.flatnonzero(self._holder >= 0)
        data, holders = grams.data, self._holder[self.used]
        crcs = [zlib.crc32(data[start:end]) for start, end in zip(grams.starts[holders], grams.ends[holders])]
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = np.array(crcs, np.int64) % buckets
        self.count = np.bincount(self.slots, minlength=size)

    def _equal_bytes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        grams = self._grams
        lengths = grams.ends[left] - grams.starts[left]
        equal = lengths == grams.ends[right] - grams.starts[right]
        equal[left == right] = True
        open_ = np.flatnonzero(equal & (left != right))
        step = 0
        while len(open_):
            rest = lengths[open_] - step
            a = self._lanes[grams.starts[left[open_]] + step]
            b = self._lanes[grams.starts[right[open_]] + step]
            beyond = np.uint64(8) * np.clip(_LANE - rest, 0, _LANE - 1).astype(np.uint64)
            differs = ((a ^ b) << beyond) != 0
            equal[open_[differs]] = False
            open_ = open_[~differs & (rest > _LANE)]
            step += _LANE
        return equal

    def bucket_counts(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        np.add.at(out, self.bucket[self.used], self.count[self.used])
        return out

    def gather(self, gains: np.ndarray) -> np.ndarray:
        """The gain of every occurrence, by way of its slot."""
        by_slot = np.zeros(len(self.bucket), np.int64)
        by_slot[self.used] = gains[self.bucket[self.used]]
        return by_slot[self.slots]


def _slices(texts: pa.Array, max_words: int) -> Iterator[tuple[int, int, Ngrams]]:
    data, offsets = text_buffer(texts)
    start, count = 0, len(offsets) - 1
    while start < count:
        end = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
        end = min(count, max(start + 1, end))
        yield start, end, Ngrams.of(data, offsets[start : end + 1], max_words)
        start = end


# -- counts, gains, scores -------------------------------------------------------------------------------------------


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """``bucket, n``: how many features of ``texts.text`` fall into each bucket that has any. A task sends one row per
    bucket, however many texts it reads."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, grams in _slices(batch.column(0), max_words):
                if len(grams):
                    total += NgramTable(grams, buckets).bucket_counts(buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS
) -> np.ndarray:
    """Gain per bucket in thousandths, from one pass over either side; the driver receives one row per bucket."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    sides = bucket_counts(corpus, buckets, max_words).withColumn("side", F.lit(0)).unionByName(
        bucket_counts(target, buckets, max_words).withColumn("side", F.lit(1))
    )
    found = sides.toPandas()
    counts = np.zeros((2, buckets))
    counts[found["side"], found["bucket"]] = found["n"]
    (s, t), (s_all, t_all) = counts, counts.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, max_words: int = MAX_WORDS) -> DataFrame:
    """``doc_id, text_key, n_words, n_features, weight`` per row of ``docs``."""
    buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for start, end, grams in _slices(batch.column(2), max_words):
                count = np.bincount(grams.owner, minlength=end - start)
                total = np.zeros(end - start, np.int64)
                if len(grams):
                    np.add.at(total, grams.owner, NgramTable(grams, buckets).gather(gains))
                words.append(grams.words)
                features.append(count)
                weights.append(total // np.maximum(count, 1))
            if words:
                parts = [pa.array(np.concatenate(part).astype(np.int64)) for part in (words, features, weights)]
                names = ["doc_id", "text_key", "n_words", "n_features", "weight"]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *parts], names)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(score, "doc_id long, text_key long, n_words long, n_features long, weight long")


def _gumbel(seed: int) -> Column:
    """Noise in thousandths from the document's id; rows without one draw it from their text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.col("text_key").cast("string")))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share_percent: int = SHARE_PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs``: of the N rows with ``min_words`` words, the
    ``floor(share_percent * N / 100)`` highest scores are drawn and numbered by falling score, ties by rising doc_id;
    other rows have no rank. ``target`` is the text table whose features are wanted.

    Null texts have no words, weight 0 and are not drawn (unless ``min_words`` is 0). Rows without doc_id take their noise
    from their text and come last among ties; rows alike in doc_id and text get ranks of their own in any order. Other
    columns are ignored. An empty target or corpus counts as zero features; the smoothing keeps all gains finite.

    Scores are whole thousandths: their number is bounded by the range of weights and noise (some ten thousand), not by
    the number of documents, so their counts go to the driver and give each score's first rank. Only rows of one score are
    sorted together, and the noise spreads even equal weights over thousands of scores.
    """
    if not 0 <= share_percent <= 100:
        raise ValueError("share_percent must lie in [0, 100]")
    gains = bucket_gains(docs, target, buckets, max_words)
    scored = staged(
        weigh(docs, gains, max_words).withColumn("score", F.col("weight") + _gumbel(seed)), "importance"
    )
    spark = docs.sparkSession
    counts = scored.where(F.col("n_words") >= min_words).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas()
    counts = counts.sort_values("score", ascending=False)
    drawn = share_percent * int(counts["n"].sum()) // 100
    counts["before"] = counts["n"].cumsum() - counts["n"]
    counts = counts[counts["before"] < drawn]
    plain = scored.select("doc_id", "n_features", "weight", "score")
    if counts.empty:
        return plain.withColumn("rank", F.lit(None).cast("long"))
    lowest = int(counts["score"].min())
    with session_conf(spark, {"spark.sql.execution.arrow.pyspark.enabled": "true"}):
        before = spark.createDataFrame(counts[["score", "before"]], "score long, before long")
    reaches = (F.col("n_words") >= min_words) & (F.col("score") >= lowest)
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    ranked = (
        scored.where(reaches)
        .join(F.broadcast(before), "score")
        .withColumn("rank", (F.col("before") + F.row_number().over(order)).cast("long"))
        .select(*plain.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    )
    return ranked.unionByName(
        scored.where(~reaches).select(*plain.columns, F.lit(None).cast("long").alias("rank"))
    )
