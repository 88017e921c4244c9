"""Near-duplicate detection by improved consistent weighted sampling over TF-IDF shingles.

A document is the bag of its five-word shingles, weighted by count and inverse document frequency. Copies raise the
frequencies of what they share, so a share of all documents is added to every frequency: else, the larger a group of copies
and the corpus, the more would a few words of a copy's own outweigh all that it shares. Document frequencies
are counted exactly over all documents: every task holds the most frequent shingles, a bounded number; the others that
occur more than once are looked up by a join; what is in neither occurs once. Each of ``bands * rows`` samples draws a
shingle and a level of its weight so that two documents agree with the probability of their weighted Jaccard similarity.
A frequency that a task does not hold lies between one and the least that it holds, and mostly both draw alike: only the
few shingles of a document on which a draw still depends are looked up for the samples. Documents that share a bucket look
up all theirs.
Documents with equal word sequences are one node. Nodes that agree in a band are first compared with centres of that
bucket: the smallest id, then, where the others still belong to several groups, one of these chosen anew. A node that was
the centre has met its whole bucket and leaves it. What several groups still share after that is compared by an exact
prefix join: two bags can only reach the threshold if they share one of their rarest shingles, with enough weight left
from there on. So every two nodes of a bucket end up compared, in one group, or bounded below the threshold. A pair links
if its exact weighted Jaccard similarity reaches the threshold; groups are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import PUNCTUATION, Words, lane_words, mix, powers, rank_id, row_key, span_hash, staged, text_slices, unstaged
from adpulse.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
# Rounds of centres before the prefix join, which finds all that they leave; they only make it smaller.
CENTRES = 3
# Shingles whose document frequency every task holds; the driver gathers and sends them.
COMMON = 2**18
# Share of all documents that a weight adds to each frequency: shingles of far fewer documents weigh nearly alike.
SPREAD = 0.1

# Shingles that are counted together, and bytes of text whose counts one task gathers at once.
COUNTED, PART_BYTES = 1_000_000, 4_000_000
# Bytes of text cut into words at once: bounds what a Python worker holds.
WORDS_BYTES = 500_000
_CACHED = 2**16
_TABLE_BITS = 16
_random = np.random.Generator(np.random.PCG64(5))
# Per table entry: shape r and log of c, both Gamma(2, 1), and offset beta of the sampling scheme.
_R = _random.gamma(2.0, 1.0, 2**_TABLE_BITS)
_LOG_C = np.log(_random.gamma(2.0, 1.0, 2**_TABLE_BITS))
_BETA = _random.random(2**_TABLE_BITS)
# As the sampling uses them: 1 / r, and log a = (log c - r + r beta) - r level.
_LOG_A = (_LOG_C - _R + _R * _BETA).astype(np.float32)
_INVERSE, _R, _BETA = (x.astype(np.float32) for x in (1 / _R, _R, _BETA))
_SAMPLE_KEYS = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _text_order(values: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Order by text, then by value: by one key of the text's number and the value's leading bits, unless two values of a
    text agree in these."""
    bits = np.uint64(max(1, int(texts.max()).bit_length()))
    key = (texts.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits)
    order = np.argsort(key)
    key, sorted_ = key[order], values[order]
    if np.any((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])):
        return np.lexsort((values, texts))
    return order


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, text, count), each shingle of a text once, ordered by text. Texts shorter than ``size`` words but not
    empty have one shingle, all their words."""
    at = words.whole(size)
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    values, texts = words.grams(size)[at] if len(at) else np.zeros(0, np.uint64), owner[at]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        values = np.concatenate([values, span_hash(words.prefix(), words.first[short], words.first[short + 1])])
        texts = np.concatenate([texts, short])
    if not len(values):
        return values, texts, np.zeros(0, np.int64)
    order = _text_order(values, texts)
    values, texts = values[order], texts[order]
    new = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])]))
    return values[new], texts[new], np.diff(np.append(new, len(values)))


def lookup(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``values`` are among the sorted ``keys``, and where these are there."""
    if not len(keys):
        return np.zeros(len(values), bool), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    hit = keys[at] == values
    return hit, at[hit]


def word_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    return text_slices(batch, separates=PUNCTUATION, words=lane_words, size=WORDS_BYTES)


@dataclass
class Frequencies:
    """Number of documents, document frequencies of the common shingles, sorted, and the most that any other may have."""

    total: int
    shingles: np.ndarray
    counts: np.ndarray
    others: int = 1

    def of(self, values: np.ndarray, *own: np.ndarray) -> np.ndarray:
        """``own``: sorted shingles and their frequencies, of those that are not common."""
        n = np.ones(len(values))
        for keys, counts in ((self.shingles, self.counts), own):
            hit, at = lookup(keys, values)
            n[hit] = counts[at]
        return n

    def idf(self, values: np.ndarray, *own: np.ndarray) -> np.ndarray:
        return self.rarity(self.of(values, *own))

    def between(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest frequency that each shingle may have."""
        least, most = np.ones(len(values)), np.full(len(values), float(self.others))
        hit, at = lookup(self.shingles, values)
        least[hit] = most[hit] = self.counts[at]
        return least, most

    def rarity(self, n: np.ndarray) -> np.ndarray:
        return np.log(1 + (1 + self.total) / (1 + n))

    def weight(self, n: np.ndarray) -> np.ndarray:
        return self.rarity(n + SPREAD * self.total)


def _own(batch: pa.RecordBatch, begin: int, end: int, *sides: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles and their frequencies that came to the rows begin:end by the join."""
    keys, counts = (
        np.concatenate([batch.column(name + side).slice(begin, end - begin).flatten().to_numpy(zero_copy_only=False) for side in sides or ("",)])
        for name in ("own", "own_n")
    )
    keys, at = np.unique(keys.astype(np.int64).view(np.uint64), return_index=True)
    return keys, counts[at]


def _levels(values: np.ndarray, log_weight: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Level and log a of each shingle in a sample. More weight never lowers the level nor raises log a."""
    entry = ((values * _SAMPLE_KEYS[sample]) >> np.uint64(64 - _TABLE_BITS)).view(np.int64)
    level = log_weight * _INVERSE.take(entry)
    level += _BETA.take(entry)
    np.floor(level, out=level)
    log_a = _R.take(entry)
    log_a *= level
    np.subtract(_LOG_A.take(entry), log_a, out=log_a)
    return level, log_a


@dataclass
class Draws:
    """Of texts that have shingles: per text and sample the least log a with its shingle and level."""

    texts: np.ndarray
    low: np.ndarray
    shingles: np.ndarray
    levels: np.ndarray

    def hashes(self) -> np.ndarray:
        return mix(self.shingles + mix(self.levels.astype(np.int64).view(np.uint64)))

    def best(self, other: Draws) -> Draws:
        """The better draw of either, for the same texts; of equal ones the smallest shingle."""
        mine = (self.low < other.low) | ((self.low == other.low) & (self.shingles <= other.shingles))
        pick = [np.where(mine, getattr(self, name), getattr(other, name)) for name in ("low", "shingles", "levels")]
        return Draws(self.texts, *pick)


def draws(
    values: np.ndarray, texts: np.ndarray, weight: np.ndarray, samples: int, lightest: np.ndarray | None = None
) -> tuple[Draws, np.ndarray]:
    """The draws of each text, and which of its shingles are open.

    With ``lightest`` a shingle's weight is only known to lie between ``lightest`` and ``weight``. It is open if in some
    sample its level is not the same at both and it may yet be the one drawn. There the draw is the best of the others (of
    infinite log a if there is none), and the text's open shingles decide with their exact weights, by :meth:`Draws.best`.
    """
    first = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]])) if len(texts) else np.zeros(0, np.int64)
    ends = np.append(first, len(texts))[1:]
    log_weight = np.log(weight).astype(np.float32)
    unsure = np.flatnonzero(lightest < weight) if lightest is not None else np.zeros(0, np.int64)
    log_lightest = np.log(lightest[unsure]).astype(np.float32) if lightest is not None else log_weight[:0]
    open_ = np.zeros(len(values), bool)
    shape = (len(first), samples)
    out = Draws(texts[first], np.zeros(shape, np.float32), np.zeros(shape, np.uint64), np.zeros(shape, np.float32))
    begin = 0
    while begin < len(first):  # whole texts, about as many shingles at once as the processor's cache holds
        end = max(begin + 1, int(np.searchsorted(ends, first[begin] + _CACHED, "right")))
        own = slice(first[begin], ends[end - 1])
        places, sizes = first[begin:end] - first[begin], ends[begin:end] - first[begin:end]
        some = slice(*np.searchsorted(unsure, (own.start, own.stop)))
        at = unsure[some] - own.start
        for sample in range(samples):
            level, log_a = _levels(values[own], log_weight[own], sample)
            if len(at):
                lower, most = _levels(values[own][at], log_lightest[some], sample)
                wide = np.flatnonzero(lower != level[at])
                where = at[wide]
                best = log_a[where]
                # Above the least log a that is reached whatever the weights are, nothing is drawn.
                log_a[where] = most[wide]
                bound = np.repeat(np.minimum.reduceat(log_a, places), sizes)[where]
                open_[own.start + where[best <= bound]] = True
                log_a[where] = np.inf
            low = np.minimum.reduceat(log_a, places)
            least = np.flatnonzero(log_a == np.repeat(low, sizes))
            # Of equal ones the first, that is the smallest shingle.
            least = least[np.searchsorted(least, places)]
            out.low[begin:end, sample], out.shingles[begin:end, sample], out.levels[begin:end, sample] = low, values[own][least], level[least]
        begin = end
    return out, open_


def signatures(values: np.ndarray, texts: np.ndarray, weight: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and per such text ``samples`` hashes of the (shingle, level) drawn."""
    drawn, _ = draws(values, texts, weight, samples)
    return drawn.texts, drawn.hashes()


def band_hashes(drawn: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = powers(np.uint64(0x9E3779B97F4A7C15), rows)
    band = [mix((drawn[:, b * rows : (b + 1) * rows] * factors).sum(axis=1, dtype=np.uint64) + np.uint64(b)) for b in range(bands)]
    return np.stack(band, axis=1).view(np.int64)


def _counted(size: int, part_bits: int):
    """(part, values, counts): sorted shingles of about ``COUNTED`` places, each once, dealt by their leading bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            n = n.astype(np.uint32)
            bounds = np.searchsorted(values >> np.uint64(64 - part_bits), np.arange(2**part_bits + 1, dtype=np.uint64))
            parts = np.flatnonzero(np.diff(bounds))
            spans = [(bounds[part], bounds[part + 1]) for part in parts.tolist()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(parts.astype(np.int32)),
                    pa.array([values[begin:end].tobytes() for begin, end in spans], pa.binary()),
                    pa.array([n[begin:end].tobytes() for begin, end in spans], pa.binary()),
                ],
                ["part", "values", "counts"],
            )

        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, words in word_slices(batch):
                held.append(shingles(words, size)[0])
                if sum(map(len, held)) >= COUNTED:
                    yield counted()
                    held = []
        if held:
            yield counted()

    return run


def _summed(table: pa.Table) -> pa.Table:
    """(shingle, n) of the shingles of one part that occur more than once."""
    values, counts = (
        np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in (("values", np.uint64), ("counts", np.uint32))
    )
    order = np.argsort(values)
    values = values[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    n = np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    many = n > 1
    return pa.table({"shingle": pa.array(values[first[many]].view(np.int64)), "n": pa.array(n[many])})


def _uncommon(size: int, shared: Broadcast):
    """(row_key, shingle) of shingles that are not common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value.shingles
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False)
            for begin, _, words in word_slices(batch):
                values, texts, _ = shingles(words, size)
                rest = ~lookup(common, values)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[begin + texts[rest]]), pa.array(values[rest].view(np.int64))], ["row_key", "shingle"]
                )

    return run


def _shared_counts(texts: DataFrame, size: int, common: int) -> tuple[Broadcast, DataFrame, int]:
    """Frequencies of the at most ``common`` most frequent shingles; (shingle, n) of all that occur more than once; the
    least n of the common ones, 2 if there are no others."""
    sizes = texts.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    total = sizes["rows"]
    # Counts travel as sorted runs, of which a task adds up those of one part; parts grow in number with the texts.
    part_bits = min(30, max(6, (int(sizes["bytes"]) // PART_BYTES).bit_length()))
    counts = staged(
        texts.select("text")
        .mapInArrow(_counted(size, part_bits), "part int, values binary, counts binary")
        .groupBy("part")
        .applyInArrow(_summed, "shingle long, n long"),
        "frequencies",
    )
    # One row per frequency that occurs.
    least, held = 2, 0
    for n, times in sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True):
        held += times
        if held > common:
            least = n + 1
            break
    found = counts.where(F.col("n") >= least).toArrow()
    keys = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    # One copy for all functions of all stages, of a bounded size.
    known = Frequencies(total, keys[order], found.column("n").to_numpy()[order], least - 1)
    return texts.sparkSession.sparkContext.broadcast(known), counts, least


def _own_frequencies(texts: DataFrame, size: int, known: Broadcast, others: DataFrame) -> DataFrame:
    """(row_key, own, own_n): shingles of each text that are not common but occur more than once, with their frequencies."""
    pairs = texts.select("row_key", "text").mapInArrow(_uncommon(size, known), "row_key long, shingle long")
    own = pairs.join(others.hint("merge"), "shingle").groupBy("row_key").agg(F.collect_list(F.struct("shingle", "n")).alias("own"))
    return staged(own.select("row_key", F.col("own.shingle").alias("own"), F.col("own.n").alias("own_n")), "own")


def frequencies(texts: DataFrame, size: int, common: int = COMMON) -> tuple[Broadcast, DataFrame | None]:
    """Document frequencies of the at most ``common`` most frequent shingles, and those of others that occur more than
    once as (row_key, own, own_n) by text, if there are any."""
    known, counts, least = _shared_counts(texts, size, common)
    own = None if least == 2 else _own_frequencies(texts, size, known, counts.where(F.col("n") < least))
    unstaged(counts)
    return known, own


def _signed(size: int, shared: Broadcast, bands: int, rows: int):
    """Signatures of texts. Where shingles are open, they and the draws without them take the place of the bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keys, ids = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("row_key", "rank_id"))
            for begin, end, words in word_slices(batch):
                values, texts, counts = shingles(words, size)
                if not len(values):
                    continue
                least, most = known.between(values)
                drawn, open_ = draws(values, texts, counts * known.weight(least), bands * rows, counts * known.weight(most))
                text, count = drawn.texts, len(drawn.texts)
                asked = np.bincount(texts[open_], minlength=end - begin)[text]
                sure = asked == 0
                prefix = words.prefix()
                whole = span_hash(prefix, words.first[text], words.first[text + 1])
                other = np.add.reduceat(mix(words.hashes + np.uint64(1)) * powers(np.uint64(0xD6E8FEB86659FD93), len(words)), words.first[text])
                back = powers(np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64)), len(words) + 1)[words.first[text]]

                def lists(rows: np.ndarray, flat: np.ndarray) -> pa.ListArray:
                    """``rows``: how many of the flat values each text has."""
                    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(rows)).astype(np.int32)), pa.array(flat))

                drawn_rows = np.where(sure, 0, bands * rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[begin + text]),
                        pa.array(ids[begin + text]),
                        pa.array(whole.view(np.int64)),
                        pa.array(mix(other * back).view(np.int64)),
                        lists(np.where(sure, bands, 0), band_hashes(drawn.hashes()[sure], bands, rows).ravel()),
                        lists(asked, values[open_].view(np.int64)),
                        lists(asked, counts[open_]),
                        lists(drawn_rows, drawn.low[~sure].ravel()),
                        lists(drawn_rows, drawn.shingles[~sure].view(np.int64).ravel()),
                        lists(drawn_rows, drawn.levels[~sure].ravel()),
                    ],
                    ["row_key", "rank_id", "print_a", "print_b", "bands", "open", "times", "low", "drawn", "levels"],
                )

    return run


_SIGNED = "row_key long, rank_id long, print_a long, print_b long, bands array<long>"
_DRAWN = "open array<long>, times array<long>, low array<float>, drawn array<long>, levels array<float>"


def _decided(shared: Broadcast, bands: int, rows: int):
    """Signatures of texts whose open shingles came back with their frequencies, as structs in ``exact``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, samples = shared.value, bands * rows
        for batch in batches:
            if not batch.num_rows:
                continue
            exact = batch.column("exact")
            texts = np.repeat(np.arange(len(exact)), exact.value_lengths().to_numpy())
            values, times, n = (column.to_numpy(zero_copy_only=False) for column in exact.flatten().flatten())
            values = values.view(np.uint64)
            order = np.lexsort((values, texts))
            values, texts, weight = values[order], texts[order], (times * known.weight(n))[order]
            late, _ = draws(values, texts, weight, samples)
            early = Draws(
                late.texts,
                *(batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, samples) for c in ("low", "drawn", "levels")),
            )
            early.shingles = early.shingles.view(np.uint64)
            band = band_hashes(early.best(late).hashes(), bands, rows)
            found = pa.ListArray.from_arrays(pa.array(np.arange(len(band) + 1, dtype=np.int32) * bands), pa.array(band.ravel()))
            names = ["row_key", "rank_id", "print_a", "print_b"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), found], [*names, "bands"])

    return run


def _signatures(texts: DataFrame, size: int, known: Broadcast, others: DataFrame | None, bands: int, rows: int) -> DataFrame:
    """(row_key, rank_id, print_a, print_b, bands) of texts with words. Only the few shingles of a text that are open go to
    the frequencies of those that are not common; the text itself moves nowhere."""
    signed = staged(texts.select("row_key", "rank_id", "text").mapInArrow(_signed(size, known, bands, rows), f"{_SIGNED}, {_DRAWN}"), "signatures")
    plain = signed.columns[:5]
    if others is None:
        return signed.select(plain)
    waiting = signed.where(F.size("open") > 0)
    asked = waiting.select("row_key", F.explode(F.arrays_zip("open", "times")).alias("its")).select(
        "row_key", F.col("its.open").alias("shingle"), F.col("its.times").alias("times")
    )
    exact = (
        asked.join(others.hint("merge"), "shingle", "left")
        .groupBy("row_key")
        .agg(F.collect_list(F.struct("shingle", "times", F.coalesce("n", F.lit(1)).alias("n"))).alias("exact"))
    )
    decided = waiting.join(exact.hint("merge"), "row_key").mapInArrow(_decided(known, bands, rows), _SIGNED)
    whole = staged(signed.where(F.size("open") == 0).select(plain).union(decided), "signatures")
    unstaged(signed)
    return whole


def weighted_jaccard(a: str, b: str, size: int, known: Frequencies, *own: np.ndarray) -> float:
    data = [x.lower().encode() for x in (a, b)]
    offsets = np.array([0, len(data[0]), len(data[0]) + len(data[1])])
    values, texts, counts = shingles(lane_words(np.frombuffer(b"".join(data), np.uint8), offsets, PUNCTUATION), size)
    weight = counts * known.weight(known.of(values, *own))
    cut = int(np.searchsorted(texts, 1))
    common, at_a, at_b = np.intersect1d(values[:cut], values[cut:], assume_unique=True, return_indices=True)
    shared = np.minimum(weight[:cut][at_a], weight[cut:][at_b]).sum()
    total = weight.sum() - shared
    return float(shared / total) if total > 0 else 0.0


def _compared(size: int, shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            pairs = zip(batch.column("text_a"), batch.column("text_b"))
            values = [
                weighted_jaccard(a.as_py(), b.as_py(), size, known, *_own(batch, at, at + 1, "_a", "_b"))
                for at, (a, b) in enumerate(pairs)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(values, pa.float64())], ["a", "b", "similarity"])

    return run


def prefixes(values: np.ndarray, texts: np.ndarray, weight: np.ndarray, similarity: float) -> tuple[np.ndarray, ...]:
    """(shingle, text, weight from there on, weight of the text) of the shingles with which a text can begin its overlap
    with another, all texts having their shingles in one order, rarest first. With similarity s the overlap is at least
    s of either weight, and the first common shingle has the whole overlap behind it."""
    if not len(values):
        return values, texts, weight, weight
    first = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
    size = np.diff(np.append(first, len(texts)))
    total = np.repeat(np.add.reduceat(weight, first), size)
    before = np.cumsum(weight) - weight
    rest = total - (before - np.repeat(before[first], size))
    at = np.flatnonzero(rest >= (similarity - 1e-6) * total)
    return values[at], texts[at], rest[at], total[at]


def _prefixed(size: int, shared: Broadcast, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            nodes, components = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("node", "component"))
            for begin, end, words in word_slices(batch):
                values, texts, counts = shingles(words, size)
                n = known.of(values, *_own(batch, begin, end))
                order = np.lexsort((values, n, texts))
                values, texts, weight = values[order], texts[order], (known.weight(n) * counts)[order]
                values, texts, rest, total = prefixes(values, texts, weight, similarity)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values.view(np.int64)),
                        pa.array(nodes[begin + texts]),
                        pa.array(components[begin + texts]),
                        pa.array(rest),
                        pa.array(total),
                    ],
                    ["shingle", "node", "component", "rest", "total"],
                )

    return run


def index_prefixes(rows: DataFrame, similarity: float) -> DataFrame:
    """Of ``prefixes`` those with which a text can begin its overlap with one of at least its own weight."""
    return rows.where(F.col("rest") >= (2 * similarity / (1 + similarity) - 1e-6) * F.col("total"))


def _remaining_pairs(texts: DataFrame, similarity: float, size: int, known: Broadcast) -> DataFrame:
    """All pairs of nodes (a, b) of different components that may reach the similarity, from (node, component, text, own,
    own_n).

    Of a pair the side with less weight is the index. The overlap is at least s / (1 + s) of both weights, so 2 s / (1 + s)
    of the index side's and s of the other's: the index needs a shorter prefix. Where many documents share a template and
    little else, the prefixes of the index hold own shingles only, and the documents do not meet. Nor do two nodes of the
    component that has most of a shingle's rows: most of a large group is one component by now.
    """
    schema = "shingle long, node long, component long, rest double, total double"
    rows = staged(texts.mapInArrow(_prefixed(size, known, similarity), schema), "prefixes")
    shared = (
        rows.groupBy("shingle", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("shingle")
        .agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("components"))
        .where("components > 1")
        .select("shingle", F.col("most.component").alias("main"))
    )
    # Rows of the main component meet the others, these meet all.
    outside = F.col("component") != F.col("main")
    meets = F.explode(F.when(outside, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True))))
    left, right = (
        side.join(shared.hint("merge"), "shingle").select(
            "shingle", lane.alias("outside"), *(F.col(c).alias(f"{c}_{name}") for c in rows.columns[1:])
        )
        for name, side, lane in (("a", index_prefixes(rows, similarity), outside), ("b", rows, meets))
    )
    least = F.lit(similarity / (1 + similarity) - 1e-6) * (F.col("total_a") + F.col("total_b"))
    return (
        left.join(right.hint("merge"), ["shingle", "outside"])
        .where("total_a < total_b or (total_a = total_b and node_a < node_b)")
        .where("component_a <> component_b")
        .where(F.least("rest_a", "rest_b") >= least)
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle_words: int = SHINGLE_WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    centres: int = CENTRES,
    common: int = COMMON,
) -> DataFrame:
    """One row per input row: doc_id, row_key, group_id (smallest doc_id of the group), group_size (distinct rows) and
    kept (the row is the group's first by doc_id).

    Words are runs of letters and digits, in lower case. Documents without words (null, empty, punctuation only) are
    each alone. Rows without doc_id come last, and their group_id is null if the whole group has none. Rows alike in
    doc_id and text are one row here and share its result. Other columns are ignored.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lower(F.col("text").cast("string")).alias("text"),
        row_key().alias("row_key"),
        rank_id().alias("rank_id"),
    )
    known, counts, least = _shared_counts(texts, shingle_words, common)
    # Fewer rows each than any of the common ones, so that no key of a join is hot.
    others = None if least == 2 else counts.where(F.col("n") < least)
    signed = _signatures(texts, shingle_words, known, others, bands, rows)
    # Equal word sequences are one node, named after the first row.
    same = ["print_a", "print_b"]
    nodes = staged(
        signed.groupBy(*same).agg(
            F.min(F.struct("rank_id", "row_key")).alias("head"), F.any_value("bands").alias("bands")
        ).select(*same, F.col("head.rank_id").alias("node_rank"), F.col("head.row_key").alias("node"), "bands"),
        "nodes",
    )
    entries = nodes.select("node", "node_rank", F.posexplode("bands").alias("band", "bucket"))
    crowded = entries.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    entries = staged(entries.join(crowded, ["band", "bucket"]), "buckets")
    # The texts of all nodes that share a bucket move once, whatever the number of rounds.
    held = staged(
        texts.select("row_key", "text")
        .join(entries.select(F.col("node").alias("row_key")).distinct().hint("merge"), "row_key")
        .dropDuplicates(["row_key"]),
        "texts",
    )
    if others is None:
        held = held.withColumns({name: F.lit(None).cast("array<long>") for name in ("own", "own_n")})
    else:
        own = _own_frequencies(held, shingle_words, known, others)
        bare, held = held, staged(held.join(own, "row_key", "left"), "texts")
        unstaged(bare, own)
    unstaged(counts)
    groups, links = None, None

    def link(pairs: DataFrame) -> None:
        """Compares (a, b) and unites what is similar enough."""
        nonlocal groups, links
        pairs = staged(pairs, "pairs")
        if pairs.isEmpty():
            return
        compared = (
            pairs.join(held.toDF("a", *(f"{name}_a" for name in held.columns[1:])), "a")
            .join(held.toDF("b", *(f"{name}_b" for name in held.columns[1:])), "b")
            .mapInArrow(_compared(shingle_words, known), "a long, b long, similarity double")
            .where(F.col("similarity") >= similarity)
            .select("a", "b")
        )
        found = staged(compared, "links")
        links = found if links is None else links.union(found)
        groups = components(links)

    # Members of buckets that have not met all others there, with their group so far.
    left = entries.withColumn("component", F.col("node"))
    for turn in range(centres):
        order = F.col("node_rank") if turn == 0 else F.xxhash64("node", "band", F.lit(turn))
        centre = left.groupBy("band", "bucket").agg(F.min(F.struct(order.alias("order"), "node", "component")).alias("its"))
        centre = staged(
            centre.select("band", "bucket", F.col("its.node").alias("centre"), F.col("its.component").alias("its")), "centres"
        )
        met = left.join(centre, ["band", "bucket"]).where("node <> centre")
        link(met.where("component <> its").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
        rest = met.select("band", "bucket", "node", "node_rank")
        rest = (
            rest.withColumn("component", F.col("node"))
            if groups is None
            else rest.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        )
        several = rest.groupBy("band", "bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        left = staged(rest.join(several.where("low <> high").select("band", "bucket"), ["band", "bucket"]), "left")
        if left.isEmpty():
            break
    else:
        crowd = left.select(F.col("node").alias("row_key"), "component").distinct().hint("merge")
        rest = held.join(crowd, "row_key").select(F.col("row_key").alias("node"), "component", "text", "own", "own_n")
        link(_remaining_pairs(rest, similarity, shingle_words, known))
    member = nodes.select(*same, "node")
    member = (
        member.withColumn("group", F.col("node"))
        if groups is None
        else member.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    )
    known.destroy()  # whatever used it is staged
    unstaged(held, entries)
    placed = signed.join(member.select(*same, "group"), same).select("row_key", "rank_id", "group").distinct()
    heads = placed.groupBy("group").agg(
        F.min(F.struct("rank_id", "row_key")).alias("head"), F.count(F.lit(1)).alias("group_size")
    )
    grouped = placed.join(heads, "group").select("row_key", "head", "group_size")
    return (
        texts.select("doc_id", "rank_id", "row_key")
        .join(grouped, "row_key", "left")
        .select(
            "doc_id",
            "row_key",
            F.when(F.col("head").isNull(), F.col("doc_id"))
            .otherwise(F.expr("nullif(head.rank_id, 9223372036854775807)"))
            .alias("group_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            F.coalesce(F.col("row_key") == F.col("head.row_key"), F.lit(True)).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group: its first by doc_id. Rows alike in doc_id and text leave one row."""
    kept = near_duplicates(docs, **options).where("kept").select(F.col("row_key").alias("__row_key"))
    keyed = docs.withColumn("__row_key", row_key())
    return keyed.join(kept.distinct(), "__row_key", "left_semi").dropDuplicates(["__row_key"]).drop("__row_key")
