"""Quality classification by co-training.

Two classifiers see different views of a page: its text (shapes and repetitions of words, layout) and its metadata
(language, source, stated size). Both start from the labelled pages. In each round each view's classifier scores all
pages without a label and names those it is surest about; these pseudo-labels go to the other view's training rows. At
the end each view is calibrated on labelled pages kept aside, and the calibrated log-odds are combined.

The texts are read once for training: what the views need of a page is staged in a compact form, and each round is one
pass over that table. A task proposes its surest pages only, of which Spark takes the surest of all, so what reaches the
driver is bounded by the labelled sample.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import Words, mix, staged, text_slices, unstaged
from adpulse.llm.toxicity import bounded_labels, logistic

# Bound in rows of the labelled pages that are fitted on.
MAX_LABELLED = 16_000
ROUNDS = 4
# Pages that a view may pass on in a round, as a share of the labelled ones, and how sure it must be.
SHARE_PER_ROUND = 0.05
SURE = 0.95
RIDGE, CHUNK = 10.0, 1_000

_SHAPES = 3 * 3 * 3 * 2 * 4 * 2
_LAYOUT = 11
_LANGS, _SOURCES, _SIZES = 16, 32, 24
CONTENT, METADATA = "content", "metadata"
VIEWS = (CONTENT, METADATA)
# What a page is reduced to: word shapes and their counts, layout measures, buckets of the metadata.
FEATURES = "shapes binary, counts binary, layout binary, lang_bucket int, source_bucket int, size long"
FEATURE_NAMES = tuple(part.split()[0] for part in FEATURES.split(", "))

_byte = np.arange(256)
_UPPER = (_byte >= 65) & (_byte <= 90)
_LOWER = (_byte >= 97) & (_byte <= 122)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_PLAIN = np.isin(_byte, list(b".,;:'\"-?()"))
_SYMBOL = (_byte > 32) & (_byte < 127) & ~_UPPER & ~_LOWER & ~_DIGIT & ~_PLAIN
_END = np.isin(_byte, list(b".!?:;\"'"))
# The number of bytes of each kind in a word, added up in fields of one integer.
_FIELD_BITS = 12
_ONE = [np.uint64(1 << (_FIELD_BITS * kind)) for kind in range(5)]
_KINDS = sum(flags.astype(np.uint64) * one for flags, one in zip((_UPPER, _LOWER, _DIGIT, _PLAIN, _SYMBOL), _ONE))
_LEAD = 0xC3  # of the Latin-1 letters, whose capitals end in 80-9E


def _kinds(words: Words) -> tuple[np.ndarray, ...]:
    """Per word the numbers of its upper, lower, digit, plain and other ASCII punctuation bytes."""
    data = words.data
    codes = _KINDS[data]
    lead = np.flatnonzero(data[:-1] == _LEAD) + 1
    codes[lead] = np.where(data[lead] <= 0x9E, _ONE[0], _ONE[1]) * (data[lead] >= 0x80).astype(np.uint64)
    if not len(words):
        return (np.zeros(0, np.int64),) * 5
    sums = np.add.reduceat(codes, words.starts)
    mask = np.uint64((1 << _FIELD_BITS) - 1)
    out = tuple(((sums >> np.uint64(_FIELD_BITS * kind)) & mask).astype(np.int64) for kind in range(5))
    for word in np.flatnonzero(words.ends - words.starts > int(mask)):  # a field would overflow
        own = codes[words.starts[word] : words.ends[word]]
        for kind in range(5):
            out[kind][word] = int(((own >> np.uint64(_FIELD_BITS * kind)) & mask).sum())
    return out


def page_features(words: Words, offsets: np.ndarray) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Word shapes (16-bit), their counts (32-bit) and layout measures of consecutive texts; ``offsets`` are their byte
    bounds in ``words.data``."""
    data, count = words.data, len(words.first) - 1
    owner = words.owner()
    ups, lows, digits, plains, symbols = _kinds(words)
    capital = np.where((ups >= 2) & (lows == 0), 2, (ups > 0).astype(int))
    repeat = np.zeros(len(words), bool)
    repeat[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    shape = capital
    for values, size in (
        (np.minimum(symbols, 2), 3),
        (np.minimum(plains, 2), 3),
        (digits > 0, 2),
        (np.digitize(words.ends - words.starts, [4, 8, 15]), 4),
        (repeat, 2),
    ):
        shape = shape * size + values
    places, times = np.unique(owner * _SHAPES + shape, return_counts=True)
    bounds = np.searchsorted(places, np.arange(count + 1) * _SHAPES)
    shapes, times = (places % _SHAPES).astype(np.uint16), times.astype(np.uint32)
    spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, count)[:count] if len(owner) else np.zeros(count)

    size = np.maximum(np.diff(offsets), 1).astype(float)
    n_words = np.diff(words.first).astype(float)
    # Distinct words of a text: a word's hash mixed with its text's number, each value once.
    own = mix(words.hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    new = np.ones(len(own), bool)
    new[1:] = own[order][1:] != own[order][:-1]
    distinct = np.bincount(owner[order[new]], minlength=count)[:count] if len(own) else np.zeros(count)
    breaks = np.flatnonzero(data == 10)
    in_text = np.searchsorted(offsets, breaks, "right") - 1
    lines = np.bincount(in_text, minlength=count)[:count] + 1.0
    before = np.where(breaks > 0, data[breaks - 1], 0) if len(breaks) else breaks
    open_ends = np.bincount(in_text, ~_END[before], count)[:count] if len(breaks) else np.zeros(count)
    layout = np.stack(
        [
            np.log1p(n_words),
            np.log(lines),
            np.log1p(size / lines),
            open_ends / lines,
            per_text(ups) / size,
            per_text(digits) / size,
            per_text(plains) / size,
            per_text(symbols) / size,
            np.log1p(per_text(symbols)),
            size / (n_words + 1) / 10,
            distinct / np.maximum(n_words, 1),
        ],
        axis=1,
    ).astype(np.float32)
    return [shapes[a:b].tobytes() for a, b in spans], [times[a:b].tobytes() for a, b in spans], layout


def _pages(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """Feature columns of consecutive rows of a batch with text, lang, source and n_chars."""
    text = batch.column("text").fill_null("").cast(pa.large_string())
    at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
    buckets = [
        np.array([zlib.crc32(str(value).encode()) % size for value in batch.column(name).to_pylist()], np.int32)
        for name, size in (("lang", _LANGS), ("source", _SOURCES))
    ]
    sizes = batch.column("n_chars").fill_null(-1).to_numpy(zero_copy_only=False)
    for begin, end, words in text_slices(batch):
        shapes, counts, layout = page_features(words, at[begin : end + 1] - at[begin])
        columns = [pa.array(shapes, pa.binary()), pa.array(counts, pa.binary()), pa.array([row.tobytes() for row in layout], pa.binary())]
        yield begin, end, [*columns, *(pa.array(part[begin:end]) for part in (*buckets, sizes.astype(np.int64)))]


def view_rows(columns: list[pa.Array]) -> dict[str, np.ndarray]:
    """Feature rows of both views from feature columns."""
    shapes, counts, layout, lang, source, size = columns

    def joined(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
        parts = column.to_pylist()
        return np.frombuffer(b"".join(parts), kind), np.array([len(part) for part in parts], np.int64) // np.dtype(kind).itemsize

    places, per_row = joined(shapes, np.uint16)
    content = np.zeros((len(shapes), _SHAPES + _LAYOUT), np.float32)
    content[np.repeat(np.arange(len(shapes)), per_row), places] = np.log1p(joined(counts, np.uint32)[0])
    content[:, _SHAPES:] = joined(layout, np.float32)[0].reshape(-1, _LAYOUT)
    stated = size.to_numpy(zero_copy_only=False)
    metadata = np.zeros((len(shapes), _LANGS + _SOURCES + _SIZES + 1), np.float32)
    row = np.arange(len(shapes))
    metadata[row, lang.to_numpy(zero_copy_only=False)] = 1
    metadata[row, _LANGS + source.to_numpy(zero_copy_only=False)] = 1
    # Size classes by powers of two; one of their own for pages that state none.
    classes = np.where(stated < 0, 0, np.minimum(1 + np.floor(np.log2(np.maximum(stated, 1))), _SIZES - 1)).astype(int)
    metadata[row, _LANGS + _SOURCES + classes] = 1
    metadata[:, -1] = np.log1p(np.maximum(stated, 0))
    return {CONTENT: content, METADATA: metadata}


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at once, since their feature rows are wide."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def _columns(docs: DataFrame) -> list[Column]:
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.col("n_chars").cast("long").alias("n_chars"),
    ]


def quality_features(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, print`` (of the text) and the columns of :data:`FEATURES` of every row: about a tenth of the
    text in size. Stage it: fitting reads it once per round."""
    texts = docs.select(
        *_columns(docs),
        F.xxhash64("doc_id", "text", "lang", "source", "n_chars").alias("row_key"),
        F.xxhash64("text").alias("print"),
    )
    keys = ["doc_id", "row_key", "print"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, columns in _pages(batch):
                own = [batch.column(name).slice(begin, end - begin) for name in keys]
                yield pa.RecordBatch.from_arrays([*own, *columns], [*keys, *FEATURE_NAMES])

    return texts.mapInArrow(run, f"doc_id long, row_key long, print long, {FEATURES}")


# -- classifiers -----------------------------------------------------------------------------------------------------


@dataclass
class View:
    """A linear classifier on standardised features, with the line that calibrates its log-odds."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    line: tuple[float, float] = (0.0, 1.0)

    @staticmethod
    def fit(features: np.ndarray, labels: np.ndarray) -> View:
        """Logistic regression by Newton steps, a chunk of rows at a time: the driver holds the features once."""
        mean = features.mean(axis=0, dtype=float)
        chunks = (features[at : at + CHUNK] for at in range(0, len(features), CHUNK))
        scale = np.sqrt(sum(((own - mean) ** 2).sum(axis=0) for own in chunks) / len(features))
        used = np.flatnonzero(scale > 1e-6)
        penalty = np.diag([1e-6] + [RIDGE] * len(used))
        found = np.zeros(len(used) + 1)
        for _ in range(30):
            hessian, slope = penalty.copy(), -penalty @ found
            for at in range(0, len(features), CHUNK):
                own = (features[at : at + CHUNK, used] - mean[used]) / scale[used]
                x = np.column_stack([np.ones(len(own)), own])
                p = sigmoid(np.clip(x @ found, -30, 30))
                hessian += (x * (p * (1 - p))[:, None]).T @ x
                slope += x.T @ (labels[at : at + CHUNK] - p)
            step = np.linalg.solve(hessian, slope)
            found += step
            if np.abs(step).max() < 1e-6:
                break
        weights = np.zeros(features.shape[1] + 1)
        weights[0], weights[1 + used] = found[0], found[1:]
        return View(mean, np.where(scale > 1e-6, scale, 1.0), weights)

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        slopes = self.weights[1:] / self.scale
        raw = self.weights[0] - self.mean @ slopes + features @ slopes
        return np.clip(self.line[0] + self.line[1] * raw, -30, 30)

    def calibrate(self, features: np.ndarray, labels: np.ndarray) -> None:
        # Small targets' smoothing keeps the line finite where the view separates the classes.
        raw = self.log_odds(features)
        intercept, slope = logistic(raw[:, None], labels, ridge=1.0)
        self.line = (intercept, max(slope, 0.0))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class QualityModel:
    content: View
    metadata: View
    prior: float  # log-odds of the labelled pages
    pseudo_labels: int = 0

    def scores(self, views: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.content.log_odds(views[CONTENT]), self.metadata.log_odds(views[METADATA])
        # Views independent given the class: their evidence adds up, the prior counting once.
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


@dataclass
class Proposal:
    """Pages that the view ``by`` is sure are of class ``mark``, surest first, each text once: prints and features."""

    by: str
    mark: int
    prints: list[int]
    views: dict[str, np.ndarray]


class Pool:
    """The pages without a label. A round asks for at most ``most[mark]`` pages per view and class whose texts were not
    ``given`` to the other view before."""

    def surest(self, fitted: dict[str, View], most: dict[int, int], given: dict[str, set[int]]) -> list[Proposal]:
        raise NotImplementedError


def _ranked(fitted: dict[str, View], views: dict[str, np.ndarray]) -> Iterator[tuple[str, int, np.ndarray]]:
    for name in VIEWS:
        chance = sigmoid(fitted[name].log_odds(views[name]))
        for mark in (1, 0):
            yield name, mark, chance if mark else 1 - chance


def other(name: str) -> str:
    return METADATA if name == CONTENT else CONTENT


@dataclass
class ArrayPool(Pool):
    """A pool in memory."""

    prints: np.ndarray
    views: dict[str, np.ndarray]

    def surest(self, fitted: dict[str, View], most: dict[int, int], given: dict[str, set[int]]) -> list[Proposal]:
        out = []
        for name, mark, chance in _ranked(fitted, self.views):
            rows, seen = [], set(given[other(name)])
            for row in np.lexsort((self.prints, -chance)).tolist():
                if len(rows) == most[mark] or chance[row] < SURE:
                    break
                if int(self.prints[row]) not in seen:
                    seen.add(int(self.prints[row]))
                    rows.append(row)
            out.append(Proposal(name, mark, self.prints[rows].tolist(), {v: self.views[v][rows] for v in VIEWS}))
        return out


@dataclass
class TablePool(Pool):
    """A pool as a staged table of features, scored as a whole in each round."""

    features: DataFrame

    def surest(self, fitted: dict[str, View], most: dict[int, int], given: dict[str, set[int]]) -> list[Proposal]:
        kinds = [(name, mark) for name in VIEWS for mark in (1, 0)]

        def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A task's surest pages so far, per view and class: by text, with chance and features.
            best: dict[tuple[str, int], dict[int, tuple]] = {kind: {} for kind in kinds}
            for batch in parts_of(batches):
                columns = [batch.column(name) for name in FEATURE_NAMES]
                prints = batch.column("print").to_numpy(zero_copy_only=False)
                for name, mark, chance in _ranked(fitted, view_rows(columns)):
                    own, closed = best[name, mark], given[other(name)]
                    # Once there are enough, only what is as sure as the last of them can matter.
                    least = min((value[0] for value in own.values()), default=SURE) if len(own) >= most[mark] else SURE
                    sure = np.flatnonzero(chance >= least)
                    picked = 0
                    for row in sure[np.lexsort((prints[sure], -chance[sure]))].tolist():
                        if picked == most[mark]:
                            break
                        key = int(prints[row])
                        if key not in closed and (key not in own or own[key][0] < chance[row]):
                            own[key] = (float(chance[row]), *(column[row].as_py() for column in columns))
                            picked += 1
                    if len(own) > most[mark]:
                        kept = sorted(own.items(), key=lambda item: (-item[1][0], item[0]))[: most[mark]]
                        best[name, mark] = dict(kept)
            rows = [
                (at, key, *value)
                for at, kind in enumerate(kinds)
                for key, value in sorted(best[kind].items(), key=lambda item: (-item[1][0], item[0]))[: most[kind[1]]]
            ]
            if rows:
                types = [pa.int32(), pa.int64(), pa.float64(), *[pa.binary()] * 3, pa.int32(), pa.int32(), pa.int64()]
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["kind", "print", "chance", *FEATURE_NAMES])

        schema = f"kind int, print long, chance double, {FEATURES}"
        found = staged(self.features.select("print", *FEATURE_NAMES).mapInArrow(propose, schema), "surest")
        # Of a text's copies the surest (they may differ in their metadata).
        single = found.groupBy("kind", "print").agg(F.max(F.struct("chance", *FEATURE_NAMES)).alias("row"))
        single = staged(single.select("kind", "print", "row.*"), "surest")
        out = []
        for at, (name, mark) in enumerate(kinds):
            top = single.where(F.col("kind") == at).orderBy(F.desc("chance"), "print").limit(most[mark]).toArrow().combine_chunks()
            columns = [_whole(top.column(column)) for column in FEATURE_NAMES]
            out.append(Proposal(name, mark, top.column("print").to_pylist(), view_rows(columns)))
        unstaged(found, single)
        return out


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def co_train(views: dict[str, np.ndarray], labels: np.ndarray, pool: Pool, rounds: int = ROUNDS) -> QualityModel:
    """Fits both views; every fifth labelled row is kept aside for calibration."""
    aside = np.arange(len(labels)) % 5 == 4
    prior = float(np.log(max(labels.mean(), 1e-3) / max(1 - labels.mean(), 1e-3)))
    given: dict[str, set[int]] = {name: set() for name in VIEWS}
    rows = {name: [views[name][~aside]] for name in VIEWS}
    marks = {name: [labels[~aside]] for name in VIEWS}
    fitted: dict[str, View] = {}
    share = labels.mean()
    most = {mark: int(SHARE_PER_ROUND * len(labels) * (share if mark else 1 - share)) + 1 for mark in (1, 0)}
    for turn in range(rounds + 1):
        fitted = {name: View.fit(np.vstack(rows[name]), np.concatenate(marks[name])) for name in VIEWS}
        if turn == rounds:
            break
        proposals = pool.surest(fitted, most, given)
        if not any(proposal.prints for proposal in proposals):
            break
        for proposal in proposals:
            name = other(proposal.by)
            # A text that this round calls both good and bad goes with the first, which is good.
            new = [at for at, key in enumerate(proposal.prints) if key not in given[name]]
            given[name].update(proposal.prints)
            rows[name].append(proposal.views[name][new])
            marks[name].append(np.full(len(new), float(proposal.mark)))
    for name in VIEWS:
        if aside.any() and len(set(labels[aside].tolist())) == 2:
            fitted[name].calibrate(views[name][aside], labels[aside])
    return QualityModel(fitted[CONTENT], fitted[METADATA], prior, sum(map(len, given.values())))


def fit_quality(
    features: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS
) -> QualityModel | None:
    """Learns from ``labels`` (doc_id, quality 0/1), about ``max_labelled`` rows at most, and from all pages without a
    label. ``features`` are staged :func:`quality_features`. None if the labelled pages are not of both classes.

    Labels of an id with labels of both classes count as bad. Of several pages with the id of a label one is learned
    from, and none is in the pool."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    chosen = staged(bounded_labels(known, max_labelled), "labels")
    # The sample is bounded, so it goes to all tasks; a page is picked per id before anything is collected.
    sample = (
        features.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct("row_key", "quality", *FEATURE_NAMES)).alias("row"))
        .select("row.*")
        .orderBy("row_key")
        .toArrow()
        .combine_chunks()
    )
    marks = sample.column("quality").to_numpy().astype(float)
    if len(set(marks.tolist())) < 2:
        return None
    views = view_rows([_whole(sample.column(name)) for name in FEATURE_NAMES])
    pool = staged(features.join(known.select("doc_id"), "doc_id", "left_anti").select("print", *FEATURE_NAMES), "pool")
    model = co_train(views, marks, TablePool(pool), rounds)
    unstaged(pool)
    return model


# -- scores ----------------------------------------------------------------------------------------------------------

_SCORES = ("content_score", "metadata_score", "score")


def score_features(features: DataFrame, model: QualityModel | None, threshold: float = 0.5) -> DataFrame:
    """:func:`score_quality` from staged features."""
    rows = features.select("doc_id", "row_key", *FEATURE_NAMES)
    if model is None:
        scored = rows.select("doc_id", "row_key", *(F.lit(1.0).alias(name) for name in _SCORES))
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts_of(batches):
                scores = model.scores(view_rows([batch.column(name) for name in FEATURE_NAMES]))
                own = [batch.column(name) for name in ("doc_id", "row_key")]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(s.astype(float)) for s in scores)], ["doc_id", "row_key", *_SCORES])

        scored = rows.mapInArrow(run, "doc_id long, row_key long, " + ", ".join(f"{name} double" for name in _SCORES))
    return scored.withColumn("keep", F.col("score") >= threshold)


def score_quality(docs: DataFrame, model: QualityModel | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, row_key, content_score, metadata_score, score (0 to 1, higher is better) and keep (score at least
    ``threshold``) of every row. Null columns count as a value of their own, null and empty texts as pages without
    words. Without a model every page is kept with score 1. Rows alike get equal scores; other columns are ignored."""
    return score_features(quality_features(docs), model, threshold)


def keep_quality(docs: DataFrame, model: QualityModel | None, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that ``score_quality`` rejects: judged row by row, without a join."""
    if model is None:
        return docs
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            typed = pa.RecordBatch.from_arrays(
                [batch.column(name).cast(kind) for name, kind in _INPUT.items()], list(_INPUT)
            )
            for begin, end, columns in _pages(typed):
                kept[begin:end] = model.scores(view_rows(columns))[2] >= threshold
            yield batch.select(names).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


_INPUT = {"text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}
