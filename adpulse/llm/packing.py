"""Packing of token pieces into sequences by non-negative least squares over length patterns.

The pieces' lengths make a histogram with one bin per length. Patterns are combinations of a few lengths that fill a
sequence exactly. Their repeat counts are fitted to the histogram by non-negative least squares and rounded down to what
the histogram still holds; what remains, the residual, is packed best-fit, longest first, also by histogram. The plan has
a size that depends on the sequence length only. Pieces are numbered within their length by a distributed count, and
each finds its slot in the plan by its length and number.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import staged
from adpulse.llm.tokens import PIECE_SCHEMA, token_pieces

SEQUENCE_TOKENS = 4096
SWEEPS = 12
SHORT_POWER = 2.0
# Splits tried for each longest part of a three-part pattern.
SPLITS = 12

Plan = list[tuple[tuple[int, ...], int]]


def patterns(counts: np.ndarray, splits: int = SPLITS) -> list[tuple[int, ...]]:
    """Combinations of one to three lengths present in the histogram that sum to the sequence length."""
    size = len(counts) - 1
    present = np.flatnonzero(counts)
    have = set(present.tolist())
    found: set[tuple[int, ...]] = {(size,)} if size in have else set()
    for longest in present[::-1].tolist():
        rest = size - longest
        if 0 < rest <= longest and rest in have:
            found.add((longest, rest))
        # Middle parts spread over the lengths that leave a smaller third part.
        low, high = np.searchsorted(present, (rest + 1) // 2), np.searchsorted(present, min(rest - 1, longest), "right")
        if 0 < low < high or low == 0 < high:
            for at in np.unique(np.linspace(low, high - 1, splits).astype(int)).tolist():
                middle = int(present[at])
                if rest - middle in have and 0 < rest - middle <= middle:
                    found.add((longest, middle, rest - middle))
    return sorted(found, key=lambda parts: (len(parts), [-part for part in parts]))


def fit(counts: np.ndarray, parts: list[tuple[int, ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative repeat counts x of ``parts`` with least weighted squared distance of their lengths from the
    histogram, by coordinate descent: each step solves for one count with all others fixed. Short lengths weigh less,
    as what remains of them fills gaps."""
    size = len(counts) - 1
    weigh = (np.arange(size + 1) / size) ** SHORT_POWER
    residual, repeats = counts.astype(float).copy(), np.zeros(len(parts))
    columns = []
    for pattern in parts:
        lengths, uses = np.unique(pattern, return_counts=True)
        columns.append(list(zip(lengths.tolist(), uses.tolist(), (weigh[lengths] * uses).tolist())))
    norms = [sum(use * weighed for _, use, weighed in column) for column in columns]
    left = residual.tolist()
    for _ in range(sweeps):
        moved = 0.0
        for number, column in enumerate(columns):
            step = 0.0
            for length, _, weighed in column:
                step += weighed * left[length]
            step = max(step / norms[number], -repeats[number])
            if step:
                repeats[number] += step
                moved = max(moved, abs(step))
                for length, use, _ in column:
                    left[length] -= use * step
        if moved < 0.5:
            break
    return repeats


def plan_packing(counts: np.ndarray) -> Plan:
    """Sequences as (lengths of their pieces, number of such sequences). ``counts[n]`` pieces have length n; the last
    bin is the sequence length."""
    left = counts.astype(np.int64).copy()
    plan: Plan = []
    parts = patterns(left)
    repeats = fit(left, parts)
    for number in np.argsort(-repeats, kind="stable").tolist():
        lengths, uses = np.unique(parts[number], return_counts=True)
        times = int(min(int(repeats[number] + 1e-6), (left[lengths] // uses).min()))
        if times > 0:
            left[lengths] -= uses * times
            plan.append((parts[number], times))
    return plan + best_fit(left)


def best_fit(counts: np.ndarray) -> Plan:
    """Longest pieces first, each into the open sequence with the least space that takes it. Equal pieces and equal
    sequences move together."""
    size = len(counts) - 1
    spaces: list[int] = []  # sorted; each has its open sequences
    open_by: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def add(space: int, parts: tuple[int, ...], times: int) -> None:
        if space not in open_by:
            insort(spaces, space)
            open_by[space] = []
        open_by[space].append((parts, times))

    for length in np.flatnonzero(counts)[::-1].tolist():
        todo = int(counts[length])
        moved = []
        at = bisect_left(spaces, length)
        while todo and at < len(spaces):
            space = spaces[at]
            fits, kinds = space // length, open_by[space]
            while todo and kinds:
                parts, times = kinds.pop()
                full = min(times, todo // fits)
                if full:
                    moved.append((space - fits * length, parts + (length,) * fits, full))
                    todo -= full * fits
                    times -= full
                if times and todo:
                    moved.append((space - todo * length, parts + (length,) * todo, 1))
                    todo, times = 0, times - 1
                if times:
                    kinds.append((parts, times))
            if kinds:
                at += 1
            else:
                del open_by[space]
                spaces.pop(at)
        fits = size // length
        if todo >= fits:
            moved.append((size - fits * length, (length,) * fits, todo // fits))
        if todo % fits:
            moved.append((size - todo % fits * length, (length,) * (todo % fits), 1))
        for space, parts, times in moved:
            add(space, parts, times)
    return [kind for space in spaces for kind in open_by[space]]


def _slots(plan: Plan, size: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: number of the first piece of each slot range, pattern's first sequence, pieces of this length in one
    sequence of the pattern, and their first offset. Equal lengths stand together in a pattern."""
    ranges: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for parts, times in plan:
        offset = 0
        lengths, uses = np.unique(parts, return_counts=True)
        for length, use in zip(lengths[::-1].tolist(), uses[::-1].tolist()):
            first = taken.get(length, 0)
            ranges.setdefault(length, []).append((first, sequence, use, offset))
            taken[length] = first + use * times
            offset += length * use
        sequence += times
    return {length: tuple(np.array(column) for column in zip(*rows)) for length, rows in ranges.items()}


def _placed(slots: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            numbers = batch.column("number").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                first, start, use, begin = slots[length]
                at = np.searchsorted(first, numbers[mine], "right") - 1
                local = numbers[mine] - first[at]
                sequence[mine] = start[at] + local // use[at]
                offset[mine] = begin[at] + local % use[at] * length
            columns = {name: batch.column(name) for name in batch.schema.names if name != "number"}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return run


def numbered(pieces: DataFrame, *within: str) -> DataFrame:
    """Adds ``number``: a dense count from 0 over all pieces (of equal ``within``), from (part, place)."""
    counts = pieces.groupBy("part", *within).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", *within, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if not within:
        # One row per task that made pieces, two numbers each.
        before = F.broadcast(before)
    return pieces.join(before, ["part", *within]).withColumn("number", F.col("before") + F.col("place")).drop("before")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and one end marker; a null or empty text is the marker alone. Only documents longer than
    ``size`` are cut. Rows that share a doc_id are packed each on its own. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = staged(texts.mapInArrow(token_pieces(tokenizer_path, size), PIECE_SCHEMA), "pieces")
    # At most ``size`` rows, whatever the number of documents.
    bins = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(size + 1, np.int64)
    for row in bins:
        counts[row["length"]] = row["n"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return (
        numbered(pieces, "length")
        .select("doc_id", "piece", "start", "length", F.col("crc").alias("ids_crc32"), "number")
        .mapInArrow(_placed(_slots(plan_packing(counts), size)), schema)
    )
