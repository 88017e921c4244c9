"""Substring de-duplication by seed and extend over word sequences.

Seed: every window of ``min_words`` words has one anchor, the winnowed (least) hash among its ``anchor_words``-word
shingles; equal windows choose the same anchor at the same place, so documents that share a window meet in a join on
anchors. Extend: an anchor's neighbourhood reaches both ways over all windows that chose it. Where all occurrences of an
anchor have the same neighbourhood, the match is extended to all of it at once. Where neighbourhoods differ, a match
ends inside: only there are the single windows compared, with 128-bit fingerprints. Overlapping matches of a document
merge into maximal repeats. Nothing is compared pair by pair, so that thousands of copies cost no more than their rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import rank_id, row_key, span_hash, staged, text_slices

ANCHOR_WORDS = 5
MIN_WORDS = 13


def _winnow(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its least one (of equal ones the last)."""
    least, place, have = values, np.zeros(len(values), np.int64), 1
    while have < width:
        step = min(have, width - have)
        count = len(least) - step
        right = least[step:] <= least[:count]
        place = np.where(right, place[step:] + step, place[:count])
        least = np.where(right, least[step:], least[:count])
        have += step
    return place + np.arange(len(place))


def _anchors(anchor_words: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("row_key", "rank_id"))
            for begin, _, words in text_slices(batch):
                starts = words.whole(min_words)
                if not len(starts):
                    continue
                grams = words.grams(anchor_words)
                chosen = _winnow(grams, min_words - anchor_words + 1)[starts]
                owner = words.owner()[starts]
                # Consecutive windows with the same anchor are one neighbourhood.
                new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])]))
                count = np.diff(np.append(new, len(starts)))
                start, text = starts[new], owner[new]
                around = span_hash(words.prefix(), start, start + count + min_words - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[chosen[new]].view(np.int64)),
                        pa.array(around.view(np.int64)),
                        pa.array(ids[begin + text]),
                        pa.array(keys[begin + text]),
                        pa.array((start - words.first[text]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["anchor", "around", "rank_id", "row_key", "start", "windows"],
                )

    return run


def _windows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("row_key", "rank_id"))
            spans = batch.column("spans")
            for begin, end, words in text_slices(batch):
                prefix, out = words.prefix(), []
                for row in range(begin, end):
                    mine = spans[row].values
                    start = mine.field("start").to_numpy().astype(np.int64)
                    count = mine.field("windows").to_numpy().astype(np.int64)
                    at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                    out.append((row, at))
                at = np.concatenate([a for _, a in out])
                row = np.repeat([r for r, _ in out], [len(a) for _, a in out])
                place = at + words.first[row - begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(span_hash(prefix, place, place + min_words).view(np.int64)),
                        pa.array(words.grams(min_words)[place].view(np.int64)),
                        pa.array(ids[row]),
                        pa.array(keys[row]),
                        pa.array(at.astype(np.int32)),
                    ],
                    ["print_a", "print_b", "rank_id", "row_key", "start"],
                )

    return run


def _kept(min_words: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = batch.column("text"), batch.column("spans")
            total, removed, digest, repeats, kept_text = [], [], [], [], []
            for row in range(batch.num_rows):
                words = text[row].as_buffer().to_pybytes().split() if text[row].is_valid else []
                runs: list[list[int]] = []
                if spans[row].is_valid:
                    for start, count in sorted((x["start"], x["windows"]) for x in spans[row].as_py()):
                        stop = start + count + min_words - 1
                        if runs and start <= runs[-1][1]:
                            runs[-1][1] = max(stop, runs[-1][1])
                        else:
                            runs.append([start, stop])
                kept, place = [], 0
                for start, stop in runs:
                    kept += words[place:start]
                    place = stop
                kept = b" ".join(kept + words[place:] if runs else words)
                total.append(len(words))
                removed.append(sum(stop - start for start, stop in runs))
                digest.append(hashlib.sha256(kept).hexdigest())
                repeats.append(runs)
                kept_text.append(kept)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()),
                "repeats": pa.array(repeats, pa.list_(pa.list_(pa.int32()))),
            }
            if keep_text:
                columns["kept_text"] = pa.array(kept_text, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def deduplicate_substrings(
    docs: DataFrame, anchor_words: int = ANCHOR_WORDS, min_words: int = MIN_WORDS, keep_text: bool = True
) -> DataFrame:
    """Removes from each document the words of every window of ``min_words`` words that also starts in a document with
    a smaller doc_id. Windows are judged on the input.

    Returns one row per input row: doc_id, n_words, n_removed, kept_sha256, repeats (the maximal removed runs as
    [first word, end)) and, with ``keep_text``, kept_text (the other words joined by one space).

    A null or empty text has no words and stays empty. Rows without doc_id come after all others. Rows that share a
    doc_id never remove words of each other. Other columns of ``docs`` are ignored.
    """
    if not 1 <= anchor_words <= min_words:
        raise ValueError("anchor_words must lie between 1 and min_words")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        row_key().alias("row_key"),
        rank_id().alias("rank_id"),
    )
    anchors = texts.select("row_key", "rank_id", "text").mapInArrow(
        _anchors(anchor_words, min_words),
        "anchor long, around long, rank_id long, row_key long, start int, windows int",
    )
    shared = (
        anchors.groupBy("anchor")
        .agg(
            F.min("rank_id").alias("first_id"),
            F.max("rank_id").alias("last_id"),
            F.min("around").alias("around_from"),
            F.max("around").alias("around_to"),
        )
        .where("first_id < last_id")
        .select("anchor", "first_id", F.expr("around_from = around_to").alias("alike"))
    )
    seeds = staged(
        anchors.drop("around").join(shared, "anchor").where("rank_id > first_id or not alike").drop("anchor"), "seeds"
    )
    whole = seeds.where("alike").select("row_key", "start", "windows")
    unclear = (
        seeds.where("not alike")
        .groupBy("row_key")
        .agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    )
    windows = (
        texts.select("row_key", "rank_id", "text")
        .join(unclear, "row_key")
        .mapInArrow(_windows(min_words), "print_a long, print_b long, rank_id long, row_key long, start int")
    )
    prints = ["print_a", "print_b"]
    first = windows.groupBy(*prints).agg(F.min("rank_id").alias("first_id"), F.max("rank_id").alias("last_id"))
    single = (
        windows.join(first.where("first_id < last_id").drop("last_id"), prints)
        .where("rank_id > first_id")
        .select("row_key", "start", F.lit(1).alias("windows"))
    )
    single = staged(single, "ends")
    removals = whole.union(single).groupBy("row_key").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, repeats array<array<int>>"
    if keep_text:
        schema += ", kept_text string"
    return (
        texts.join(removals, "row_key", "left").select("doc_id", "text", "spans").mapInArrow(_kept(min_words, keep_text), schema)
    )
