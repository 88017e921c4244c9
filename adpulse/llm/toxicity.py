"""Toxicity by a weighted finite-state grammar over clauses.

Five word transducers map words to symbols with weights: insults (whole words and stems, learned from labelled documents
and kept as a prefix automaton), threats, targets, negations and reported speech. Their union is composed with a clause
grammar, a transducer over symbols whose states remember what a clause has said so far: a negation or a reporting verb
weakens what follows, a target strengthens an insult and makes a threat of a violent word. The weight of a clause is that
of its path; a document is scored from its matched clauses, and a logistic function learned on the same labelled rows
turns the weights into a probability. Clauses without an insult or a violent word have weight 0 and are skipped by
searching the text for these words first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import staged

# Bound of what is learned from, in rows: labelled documents.
MAX_LABELLED = 40_000
STEM_LENGTHS = (4, 5, 6)
MIN_SUPPORT = 6
MIN_LOG_ODDS = 3.0
COVER = 3

# Closed word classes of the four languages.
TARGETS = "you your yours u he she they them him her du dich dir dein euch ihr tu te toi ton vous votre tú ti usted ustedes"
NEGATIONS = "not no never don't isn't without nicht kein keine nie niemals ohne pas jamais sans nunca jamás sin"
REPORTS = (
    "said says say told called calls wrote quoted claimed reported sagte sagt nannte schrieb zitierte dit disait écrit cité "
    "appelé dijo dice llamó escribió citó"
)
THREATS = (
    "kill kills killed hurt murder stab strangle töten umbringen erschlagen tuer tuerai frapper matar mataré golpear"
)

INSULT, THREAT, TARGET, NEGATION, REPORT = "ITGNR"
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n]+")

# The clause grammar: state -> symbol -> (next state, factor on the symbol's weight). A state has a letter for each of:
# target seen, negated, reported. A negation holds until the next insult or threat, a report until the clause ends.
_NEGATED, _REPORTED, _AIMED = 0.5, 0.5, 1.25
_THREAT_ALONE = 0.2


def _grammar() -> dict[str, dict[str, tuple[str, float]]]:
    table: dict[str, dict[str, tuple[str, float]]] = {}
    for target in "-G":
        for negated in "-N":
            for reported in "-R":
                weaken = (_NEGATED if negated == "N" else 1.0) * (_REPORTED if reported == "R" else 1.0)
                aimed = target == "G"
                table[target + negated + reported] = {
                    TARGET: ("G" + negated + reported, 0.0),
                    NEGATION: (target + "N" + reported, 0.0),
                    REPORT: (target + negated + "R", 0.0),
                    INSULT: (target + "-" + reported, weaken * (_AIMED if aimed else 1.0)),
                    THREAT: (target + "-" + reported, weaken * (1.0 if aimed else _THREAT_ALONE)),
                }
    return table


GRAMMAR = _grammar()
START = "---"


@dataclass(frozen=True)
class Lexicon:
    """``words`` and ``stems`` (any longer word that begins so) with their weights."""

    words: dict[str, float]
    stems: dict[str, float]

    def symbol(self, word: str) -> tuple[str, float] | None:
        """The union of the word transducers: symbol and weight of a word, if it has one."""
        weight = max(
            self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS if len(word) > n), 0.0
        )
        return (INSULT, weight) if weight else _CLOSED.get(word)

    def cues(self) -> re.Pattern[str]:
        """Finds the words with weight in a lower-cased text."""
        whole = sorted({*self.words, *THREATS.split()}, key=len, reverse=True)
        parts = [rf"(?:{'|'.join(map(re.escape, whole))})(?![^\W\d_])"]
        if self.stems:
            parts.append(f"(?:{'|'.join(map(re.escape, sorted(self.stems)))})" + r"[^\W\d_]")
        return re.compile(rf"(?<![^\W\d_])(?:{'|'.join(parts)})")


_CLOSED = {
    word: (symbol, 1.0)
    for symbol, words in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS))
    for word in words.split()
}


def clause_weight(clause: str, lexicon: Lexicon) -> float:
    """Weight of the clause's path through the composed grammar."""
    state, total = START, 0.0
    for word in _WORD.findall(clause):
        found = lexicon.symbol(word)
        if found:
            state, factor = GRAMMAR[state][found[0]]
            total += factor * found[1]
    return total


def matched_clauses(text: str, lexicon: Lexicon, cues: re.Pattern[str]) -> list[float]:
    """Weights of the clauses of a lower-cased text that hold an insult or a violent word."""
    weights, done = [], -1
    for match in cues.finditer(text):
        if match.start() < done:
            continue
        start = 0
        # Clauses are found around the match; a clause end within 2,000 characters is looked for first.
        for reach in (2_000, len(text)):
            low = max(0, match.start() - reach)
            ends = [m.end() for m in _CLAUSE_END.finditer(text, max(low, done, 0), match.start())]
            start = ends[-1] if ends else max(0, done)
            if ends or low <= max(0, done):
                break
        end = _CLAUSE_END.search(text, match.end())
        done = end.start() if end else len(text)
        weights.append(clause_weight(text[start:done], lexicon))
    return weights


def clause_features(weights: list[float]) -> tuple[float, float]:
    return math.log1p(sum(weights)), math.log1p(len([w for w in weights if w > 0]))


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    coefficients: tuple[float, ...]  # intercept, then one per clause feature

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.coefficients[0] + features @ np.array(self.coefficients[1:]))))


def document_features(text: str) -> set[str]:
    """Words (``=word``) and stems (``stem``) of a lower-cased text."""
    words = set(_WORD.findall(text))
    found = {"=" + word for word in words if len(word) > 2}
    for length in STEM_LENGTHS:
        found.update(word[:length] for word in words if len(word) > length)
    return found


def _toxic_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            found = sorted(document_features(text))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([key] * len(found), pa.int64())], ["feature", "row"])


def _clean_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "clean"])

    counts: dict[str, int] = {}
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for feature in document_features(text):
                counts[feature] = counts.get(feature, 0) + 1
            if len(counts) >= 500_000:
                yield counted()
                counts = {}
    yield counted()


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words and stems that mark toxic documents, from ``sample`` (row, text in lower case, toxic). A word counts once
    for each distinct text. Of the features whose log-odds suffice, those are taken that cover most toxic documents not
    yet covered ``COVER`` times, so that words common to a few near copies do not crowd out general ones."""
    totals = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic:
        return Lexicon({}, {})
    support = min(MIN_SUPPORT, max(3, n_toxic // 15))
    features = staged(
        sample.where("toxic = 1").select("row", "text").mapInArrow(_toxic_features, "feature string, row long"), "features"
    )
    frequent = features.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    clean = sample.where("toxic = 0").select("text").mapInArrow(_clean_counts, "feature string, clean long")
    both = frequent.join(clean.groupBy("feature").agg(F.sum("clean").alias("clean")), "feature", "left").fillna(0, ["clean"])
    # Only what marks reaches the driver; a little below the bound, which is drawn here.
    rate = ((F.col("n") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    odds = {
        row["feature"]: math.log((row["n"] + 0.5) / (n_toxic + 1)) - math.log((row["clean"] + 0.5) / (n_clean + 1))
        for row in both.where(F.log(rate) >= MIN_LOG_ODDS - 1e-6).collect()
    }
    marking = sorted(feature for feature, value in odds.items() if value >= MIN_LOG_ODDS)
    spark = sample.sparkSession
    wanted = spark.createDataFrame([(feature,) for feature in marking], "feature string")
    # Rows of toxic sample documents and marking features only, both bounded.
    members: dict[str, list[int]] = {}
    for row in features.join(wanted, "feature", "left_semi").collect():
        members.setdefault(row["feature"], []).append(row["row"])
    need = {key: COVER for rows in members.values() for key in rows}
    chosen: dict[str, float] = {}
    while members:
        gain = {feature: sum(need[key] > 0 for key in rows) for feature, rows in members.items()}
        best = max(gain, key=lambda feature: (gain[feature] * odds[feature], feature))
        if gain[best] < support:
            break
        chosen[best] = min(4.0, odds[best]) / 4
        for key in members.pop(best):
            need[key] -= 1
        members = {feature: rows for feature, rows in members.items() if gain[feature] >= support}
    return Lexicon(
        {feature[1:]: weight for feature, weight in chosen.items() if feature[0] == "="},
        {feature: weight for feature, weight in chosen.items() if feature[0] != "="},
    )


def _featured(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = lexicon.cues()
        for batch in batches:
            rows = [clause_features(matched_clauses(text or "", lexicon, cues)) for text in batch.column("text").to_pylist()]
            values = np.array(rows, float).reshape(-1, 2)
            own = {name: batch.column(name) for name in batch.schema.names if name != "text"}
            yield pa.RecordBatch.from_pydict(own | {"weight": pa.array(values[:, 0]), "clauses": pa.array(values[:, 1])})

    return run


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(features)), features])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w.tolist())


def bounded_labels(labels: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` of the rows of ``labels`` at most, chosen by a hash of the id."""
    total = labels.count()
    if total <= bound:
        return labels
    return labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < int(bound / total * 2**20))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Learns from the rows of ``labels`` (doc_id, toxic 0/1) that are not held out; at most about ``max_labelled``.
    Without toxic examples only the closed word classes count."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).select("doc_id", "toxic")
    texts = docs.select(F.col("doc_id"), F.lower(F.col("text").cast("string")).alias("text")).where("text is not null")
    sample = staged(
        texts.join(bounded_labels(known, max_labelled).dropDuplicates(["doc_id"]), "doc_id")
        .groupBy("text")
        .agg(F.min("toxic").cast("int").alias("toxic"))
        .withColumn("row", F.xxhash64("text")),
        "labelled",
    )
    lexicon = learn_lexicon(sample)
    rows = sample.select("text", "toxic").mapInArrow(_featured(lexicon), "toxic int, weight double, clauses double").toPandas()
    if rows["toxic"].nunique() < 2:
        return ToxicityModel(lexicon, (-4.0, 2.0, 2.0))
    return ToxicityModel(lexicon, logistic(rows[["weight", "clauses"]].to_numpy(), rows["toxic"].to_numpy()))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted, clause_weight and n_clauses of every row. A null or empty text has no
    clauses and gets the score of a text without a match. Only the text is an input of the score."""
    intercept, *slopes = model.coefficients
    linear = F.lit(intercept) + sum(F.col(name) * F.lit(slope) for name, slope in zip(("weight", "clauses"), slopes))
    return (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")
        )
        .mapInArrow(_featured(model.lexicon), "doc_id long, weight double, clauses double")
        .withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-linear)))
        .select(
            "doc_id",
            held_out().alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
            F.expm1("weight").alias("clause_weight"),
            F.round(F.expm1("clauses")).cast("long").alias("n_clauses"),
        )
    )
