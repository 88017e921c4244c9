"""Benchmark decontamination: training passages as BM25 queries against an inverted index of test items.

The items go, in the order of their ids, in blocks of bounded text size, each an index small enough to send to every task;
document frequencies and the mean length are those of the whole benchmark, so that scores do not depend on the blocks. Impacts are BM25 weights
divided by the item's score against itself, so that one threshold serves all items. Terms are also counted in the corpus:
an item's passages above the threshold must hold one of its essential terms, the corpus-rarest ones without which the
others cannot reach the threshold. Overlapping passages of every document that hold an essential term are run as queries
with block-max bounds: lists are sorted by item, and the summed maxima of their blocks decide whether the items of a
block are scored or skipped. No document is left out by this; passages without an essential term cannot match. What is retrieved is verified: the shares of the item's question and answer that occur in
the text around the passage.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import PUNCTUATION, Words, small_batches, staged, text_slices, words_of
from adpulse.session import session_conf

# Text of the items in one index, and so the bound of what a task holds of the benchmark.
INDEX_BYTES = 8_000_000
# Bytes of text handled at once: words of letters and digits take some 25 bytes of arrays per byte of text.
TEXT_BYTES = 500_000
K1, B = 1.2, 0.75
# Impacts of an item's commonest terms that are left out of its essential ones, as a share of the threshold.
MISSING = 0.5


@dataclass(frozen=True)
class Settings:
    # Share of an item's own BM25 score that a passage must reach.
    threshold: float = 0.5
    # At least; twice the longest item of an index, so that every place of an item lies in one passage.
    passage_words: int = 128
    # The last words of an item are its answer.
    answer_words: int = 8
    shingle_words: int = 3
    question_overlap: float = 0.5
    answer_overlap: float = 0.5
    posting_block: int = 8


@dataclass
class Statistics:
    """Of the whole benchmark: number of items, mean number of words, items per term."""

    items: int
    mean: float
    terms: DataFrame

    def frequencies(self, vocabulary: np.ndarray) -> np.ndarray:
        """Of the terms of one block, in their order; the block bounds what is collected."""
        wanted = self.terms.sparkSession.createDataFrame(pa.table({"term": pa.array(vocabulary.view(np.int64))}))
        found = self.terms.join(F.broadcast(wanted), "term").toArrow()
        terms = found.column("term").to_numpy().view(np.uint64)
        return found.column("df").to_numpy()[np.argsort(terms)]


@dataclass
class Posting:
    items: np.ndarray
    impacts: np.ndarray
    blocks: np.ndarray  # item ranges that hold an item of this list, and the greatest impact there
    maxima: np.ndarray
    top: float


def _spans(first: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Places first[t] ... first[t + 1] - 1 of every t of ``own``."""
    size = first[own + 1] - first[own]
    end = np.cumsum(size)
    return np.arange(end[-1]) + np.repeat(first[own] - end + size, size)


@dataclass
class Index:
    """Items of one block; terms are word hashes."""

    item_ids: list[int | None]
    terms: list[np.ndarray]  # words of each item in order
    vocabulary: np.ndarray  # sorted
    postings: list[Posting]
    block_items: int
    essential: np.ndarray | None = None  # by term

    def __post_init__(self) -> None:
        """All lists and all blocks end to end: those of term t from first[t], and block_first[t], on."""
        self.first = np.cumsum([0, *(len(x.items) for x in self.postings)])
        self.block_first = np.cumsum([0, *(len(x.blocks) for x in self.postings)])
        if self.postings:
            self.items, self.impacts = (np.concatenate([getattr(x, name) for x in self.postings]) for name in ("items", "impacts"))
            self.blocks, self.maxima = (np.concatenate([getattr(x, name) for x in self.postings]) for name in ("blocks", "maxima"))

    @staticmethod
    def build(items: Sequence[tuple[int | None, str]], settings: Settings, statistics: Statistics | None = None) -> Index:
        """Without ``statistics`` the items are the whole benchmark."""
        texts = [(text or "").lower().encode() for _, text in items]
        offsets = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
        words = words_of(np.frombuffer(b"".join(texts), np.uint8), offsets, PUNCTUATION)
        terms = [words.hashes[a:b] for a, b in zip(words.first, words.first[1:])]
        vocabulary = np.unique(words.hashes)
        mean = statistics.mean if statistics else max(1.0, len(words) / max(1, len(terms)))
        uses = [np.unique(np.searchsorted(vocabulary, own), return_counts=True) for own in terms]
        df, total = np.zeros(0), len(terms)
        if statistics and len(vocabulary):
            df, total = statistics.frequencies(vocabulary), statistics.items
        elif len(vocabulary):
            df = np.bincount(np.concatenate([own for own, _ in uses]), minlength=len(vocabulary))
        idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
        rows: list[list[tuple[int, float]]] = [[] for _ in vocabulary]
        for item, (own, tf) in enumerate(uses):
            impact = idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(terms[item]) / mean))
            for term, value in zip(own.tolist(), (impact / impact.sum()).tolist() if len(own) else []):
                rows[term].append((item, value))
        postings = []
        for row in rows:
            numbers, impacts = np.array([i for i, _ in row]), np.array([v for _, v in row])
            at = np.unique(numbers // settings.posting_block, return_index=True)
            maxima = np.maximum.reduceat(impacts, at[1])
            postings.append(Posting(numbers, impacts, at[0], maxima, float(maxima.max())))
        return Index([i for i, _ in items], terms, vocabulary, postings, settings.posting_block)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for other words."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def choose_essential(self, corpus: np.ndarray, threshold: float) -> None:
        """``corpus``: how often each term occurs in the corpus. Per item the commonest terms, as long as their impacts
        stay below a share of the threshold, are not essential; the essential ones must bring the rest, ``need``."""
        own: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for term, posting in enumerate(self.postings):
            for item, value in zip(posting.items.tolist(), posting.impacts.tolist()):
                own[item].append((term, value))
        self.essential = np.zeros(len(self.vocabulary), bool)
        self.need = np.full(len(self.terms), threshold)
        chosen: list[list[tuple[int, float]]] = [[] for _ in self.postings]
        for item, terms in enumerate(own):
            rest = 0.0
            for term, value in sorted(terms, key=lambda x: -corpus[x[0]]):
                rest += value
                if rest >= MISSING * threshold - 1e-9:
                    self.essential[term] = True
                    chosen[term].append((item, value))
                else:
                    self.need[item] -= value
        self.essential_first = np.cumsum([0, *map(len, chosen)])
        self.essential_items = np.array([item for row in chosen for item, _ in row], np.int64)
        self.essential_impacts = np.array([value for row in chosen for _, value in row])

    def promising(self, passages: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Of the ``passages`` that hold an essential term each (pairs, in any order and repeated), those whose essential
        impacts for some item suffice, if all its other terms were there too."""
        count = len(self.vocabulary)
        pairs = np.unique(passages * count + terms)
        passages, terms = pairs // count, pairs % count
        at = _spans(self.essential_first, terms)
        if not len(at):
            return at
        key = np.repeat(passages, np.diff(self.essential_first)[terms]) * len(self.terms) + self.essential_items[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        score = np.add.reduceat(self.essential_impacts[at][order], first)
        enough = score >= self.need[key[first] % len(self.terms)] - 1e-9
        return np.unique(key[first][enough] // len(self.terms))

    def above(self, terms: Sequence[int], threshold: float) -> list[tuple[int, float]]:
        """Items whose summed impacts over ``terms`` reach the threshold, bounded by blocks."""
        if not len(terms):
            return []
        own = np.asarray(terms)
        at = _spans(self.block_first, own)
        reach = np.bincount(self.blocks[at], self.maxima[at])
        if reach.max() < threshold - 1e-9:
            return []
        # Items of blocks that cannot reach the threshold are skipped, all others are scored.
        at = _spans(self.first, own)
        at = at[(reach >= threshold - 1e-9)[self.items[at] // self.block_items]]
        scores = np.bincount(self.items[at], self.impacts[at])
        return [(int(item), float(scores[item])) for item in np.flatnonzero(scores >= threshold - 1e-9)]

    def overlaps(self, item: int, around: np.ndarray, settings: Settings) -> tuple[float, float]:
        """Shares of the shingles of the item's question, and of its answer, that occur in ``around``."""
        words = self.terms[item]
        cut = len(words) - settings.answer_words if len(words) > 2 * settings.answer_words else len(words)
        size = settings.shingle_words
        there = set(map(tuple, np.lib.stride_tricks.sliding_window_view(around, size).tolist())) if len(around) >= size else set()

        def share(part: np.ndarray) -> float:
            if len(part) < size:
                return float(set(part.tolist()) <= set(around.tolist()))
            own = set(map(tuple, np.lib.stride_tricks.sliding_window_view(part, size).tolist()))
            return len(own & there) / len(own)

        return share(words[:cut]), share(words[cut:]) if cut < len(words) else share(words[:cut])


def _counted(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(index.vocabulary) + 1, np.int64)
        for batch in batches:
            for _, _, words in text_slices(batch, separates=PUNCTUATION, size=TEXT_BYTES):
                counts += np.bincount(index.find(words.hashes) + 1, minlength=len(counts))
        term = np.flatnonzero(counts[1:])
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(counts[1:][term])], ["term", "n"])

    return run


def _matches(index: Index, settings: Settings):
    width = max([settings.passage_words, *(2 * len(own) for own in index.terms)])
    stride = max(1, width // 2)

    def leaks(words: Words, terms: np.ndarray, begin: int, end: int, numbers: np.ndarray) -> dict[int, tuple]:
        """Best verified passage per item in the text of the words begin:end."""
        found: dict[int, tuple] = {}
        for number in numbers.tolist():
            start = begin + number * stride
            stop = min(end, start + width)
            query = np.unique(terms[start:stop])
            for item, score in index.above(query[query >= 0].tolist(), settings.threshold):
                if item in found and found[item][1] >= score:
                    continue
                reach = len(index.terms[item])
                around = words.hashes[max(begin, start - reach) : min(end, stop + reach)]
                question, answer = index.overlaps(item, around, settings)
                if question >= settings.question_overlap and answer >= settings.answer_overlap:
                    found[item] = (start - begin, score, question, answer)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for begin, end, words in text_slices(batch, separates=PUNCTUATION, size=TEXT_BYTES):
                terms = index.find(words.hashes)
                hits = np.flatnonzero((terms >= 0) & index.essential[terms])
                owner = np.searchsorted(words.first, hits, "right") - 1
                # Passages overlap by half: a word lies in the one that begins last before it and in the one before.
                number = (hits - words.first[owner]) // stride
                passage = np.concatenate([owner * len(words) + number, (owner * len(words) + number - 1)[number > 0]])
                passage = index.promising(passage, np.concatenate([terms[hits], terms[hits][number > 0]])) if len(hits) else hits
                owner = passage // max(1, len(words))
                for text in np.unique(owner).tolist():
                    mine = passage[np.searchsorted(owner, text) : np.searchsorted(owner, text, "right")] % len(words)
                    found = leaks(words, terms, words.first[text], words.first[text + 1], mine)
                    rows += [(ids[begin + text].as_py(), index.item_ids[item], *best) for item, best in found.items()]
            if rows:
                columns = [pa.array(column) for column in zip(*rows)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], _NAMES)

    return run


_NAMES = ["doc_id", "item_id", "start_word", "score", "question_overlap", "answer_overlap"]
_SCHEMA = "doc_id long, item_id long, start_word long, score double, question_overlap double, answer_overlap double"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, words) of every item's distinct terms; null terms carry the number of words of an item."""
    for batch in batches:
        for _, _, words in text_slices(batch, separates=PUNCTUATION, size=TEXT_BYTES):
            pairs = np.unique(np.stack([words.owner().astype(np.uint64), words.hashes]), axis=1)[1] if len(words) else words.hashes
            lengths = np.diff(words.first)
            terms = pa.array(np.concatenate([pairs.view(np.int64), np.zeros(len(lengths), np.int64)]), mask=np.arange(len(pairs) + len(lengths)) >= len(pairs))
            yield pa.RecordBatch.from_arrays([terms, pa.array(np.concatenate([np.zeros(len(pairs), np.int64), lengths]))], ["term", "words"])


def benchmark_statistics(items: DataFrame) -> Statistics:
    """Over the distinct items (item_id, text in lower case)."""
    counted = staged(
        items.select("text").mapInArrow(_item_terms, "term long, words long").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("words").alias("words")),
        "terms",
    )
    row = counted.where("term is null").first()
    count, words = (row["df"], row["words"]) if row else (0, 0)
    return Statistics(count, max(1.0, words / max(1, count)), counted.where("term is not null").select("term", "df"))


def _blocks(items: DataFrame, index_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of about ``index_bytes`` of text, by rising id; the driver holds one at a time."""
    block, held = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1] or "")
        if held >= index_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, start_word (of the best passage), score (share
    of the item's own BM25 score), question_overlap and answer_overlap.

    Words are runs of letters and digits, in lower case. Null or empty texts and items without words never match; items
    too short for a question and an answer are verified as a whole. Equal items are one; rows that share a doc_id each
    give their own rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")
    )
    items = staged(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")).distinct(),
        "items",
    )
    statistics = benchmark_statistics(items)
    found = []
    for block in _blocks(items, index_bytes):
        index = Index.build(block, settings, statistics)
        if not len(index.vocabulary):
            continue
        # One row per term of the block at most.
        counts = np.zeros(len(index.vocabulary), np.int64)
        uses = texts.select("text").mapInArrow(_counted(index), "term long, n long").groupBy("term").agg(F.sum("n"))
        with session_conf(spark, small_batches(spark)):
            for row in uses.collect():
                counts[row[0]] = row[1]
        index.choose_essential(counts, settings.threshold)
        found.append(staged(texts.mapInArrow(_matches(index, settings), _SCHEMA), "leaks"))
    if not found:
        return spark.createDataFrame([], _SCHEMA)
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def drop_leaking(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents in which ``find_leaks`` finds a test item. Rows without doc_id are judged like
    any other, by their text."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    leaks = find_leaks(keyed.select(F.col("__row").alias("doc_id"), "text"), benchmark, settings)
    return keyed.join(leaks.select(F.col("doc_id").alias("__row")).distinct(), "__row", "left_anti").drop("__row")
