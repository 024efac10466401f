"""Toxicity by weak supervision.

Voters: every word or word beginning that the training rows show to be far more (or less) common in one class is
a lexicon voter;
patterns (capitals, exclamations, symbols, digits, absence of all lexicon words) vote too, and so does the label
itself, as one more annotator who may err. A generative model with the true class as hidden variable estimates,
by expectation maximization, how often each voter gives each vote in each class; correlations that remain between
voters given the class lower the weight of voters that repeat each other. Its posteriors are the labels of a
logistic regression on the words and patterns, which scores every text.

Lexicons and models are fitted on at most SAMPLE_ROWS labelled rows (taken by a hash of their id, the same
rows at every run); held-out rows are never among them. Scoring covers all rows and whole texts.

Nulls: a null text counts as empty; a row with a null id is scored, held out, and has no label. Ids labelled
more than once count as toxic if any label says so; null labels are ignored. Repeated rows each give a row.
Without labels every score is 0.5 minus a hair, so nothing is predicted toxic. Empty tables give an empty
result. Other columns of the inputs, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebook.llm.bpe import texts_of
from quotebook.llm.staging import keep

SAMPLE_ROWS = 20_000
MAX_FEATURES = 400
LEAST_Z = 4.0
LEAST_ROWS = 4
FOLDS = 5
NO_LABELS = 0.499
BEGINNINGS = (4, 5, 6)
#: Words a worker remembers at most.
KNOWN_WORDS = 300_000

_WORD = re.compile(r"\w+")
PATTERNS = ("capitals", "exclamations", "symbols", "digits")


def terms_of(word: str) -> list[str]:
    """What a lexicon may list of a word: itself, and its beginnings, which inflected forms share."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]


def terms(text: str) -> set[str]:
    return {t for word in set(_WORD.findall(text.lower())) for t in terms_of(word)}


class Lexicon:
    """Numbers of the listed terms in a text; remembers what each word brings."""

    def __init__(self, place: dict[str, int]):
        self._place = place
        self._known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> list[int]:
        out: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            at = self._known.get(word)
            if at is None:
                at = tuple(self._place[t] for t in terms_of(word) if t in self._place)
                if len(self._known) >= KNOWN_WORDS:
                    self._known.clear()
                self._known[word] = at
            if at:
                out.update(at)
        return sorted(out)


def patterns(text: str) -> list[int]:
    """Whether each pattern of PATTERNS holds: a share of the characters above a fixed bound."""
    n = max(1, len(text))
    return [
        int(sum(map(text.count, "AEIOSTNR")) > 0.2 * n),
        int(text.count("!") > 0.02 * n),
        int(sum(map(text.count, "#$%&*@^~")) > 0.05 * n),
        int(sum(map(text.count, "0123456789")) > 0.1 * n),
    ]


def held_out(id_col: str | Column) -> Column:
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """text and label of at most `rows` labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label is not null").where(~held_out("id"))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    chosen = keep(known.orderBy(F.xxhash64("id"), "id").limit(rows), "toxicity-labels")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return keep(texts.join(F.broadcast(chosen), "id").select("text", (F.col("label") > 0).cast("int").alias("label")), "toxicity-rows")


def lexicon(rows: DataFrame, most: int) -> list[tuple[str, float]]:
    """Terms whose share of rows differs most between the classes, with their z-scores (at most `most`)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, toxic = Counter(), Counter()
            for text, label in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                total.update(found)
                if label:
                    toxic.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array([toxic[w] for w in total], pa.int64()),
                 pa.array(total.values(), pa.int64())], names=["word", "toxic", "n"])

    size, positive = rows.agg(F.count("*"), F.sum("label")).first()
    if not size or not positive or positive == size:
        return []
    share = positive / size
    counted = rows.mapInArrow(count, "word string, toxic long, n long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    z = (F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) * (1 - (F.col("n") - 1) / size))
    found = counted.where(F.col("n").between(LEAST_ROWS, size - 1)).withColumn("z", z).where(F.abs("z") >= LEAST_Z)
    return [(r.word, r.z) for r in found.orderBy(F.desc(F.abs("z")), "word").limit(most).collect()]


@dataclass
class LabelModel:
    """P(vote | class) of each voter, and each voter's weight after its correlations with the others."""

    prior: float
    votes: np.ndarray = field(repr=False)  # voter, class, vote (-1, 0, 1 at 0, 1, 2)
    weights: np.ndarray = field(repr=False)
    correlations: np.ndarray = field(repr=False)

    def posterior(self, ballots: np.ndarray) -> np.ndarray:
        log = np.log(self.votes)
        odds = np.full(len(ballots), np.log(self.prior / (1 - self.prior)))
        for j in range(ballots.shape[1]):
            odds += self.weights[j] * (log[j, 1] - log[j, 0])[ballots[:, j] + 1]
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(ballots: np.ndarray, start: np.ndarray, rounds: int = 25) -> LabelModel:
    """Expectation maximization from the posteriors `start`; ballots: rows x voters of -1 (clean), 0, 1 (toxic)."""
    n, m = ballots.shape
    model = LabelModel(0.5, np.full((m, 2, 3), 1 / 3), np.ones(m), np.eye(m))
    posterior = start
    for step in range(rounds):
        mass = np.stack([1 - posterior, posterior])
        model.prior = float(np.clip(posterior.mean(), 1e-4, 1 - 1e-4))
        for vote in (-1, 0, 1):
            model.votes[:, :, vote + 1] = (mass @ (ballots == vote)).T
        model.votes += 0.5
        model.votes /= model.votes.sum(axis=2, keepdims=True)
        if step % 8 == 4:
            model.correlations = _residual_correlations(ballots, posterior, model)
            strong = np.abs(model.correlations) * (np.abs(model.correlations) > 0.15)
            model.weights = 1 / strong.sum(axis=1).clip(1)
        new = model.posterior(ballots)
        if np.abs(new - posterior).max() < 1e-4 and step > 5:
            break
        posterior = new
    return model


def _residual_correlations(ballots: np.ndarray, posterior: np.ndarray, model: LabelModel) -> np.ndarray:
    """Correlation of the votes of each two voters that the class does not explain."""
    mean = model.votes[:, :, 2] - model.votes[:, :, 0]
    rest = ballots - np.outer(1 - posterior, mean[:, 0]) - np.outer(posterior, mean[:, 1])
    scale = np.sqrt((rest**2).sum(axis=0)) + 1e-9
    out = (rest.T @ rest) / np.outer(scale, scale)
    np.fill_diagonal(out, 1.0)
    return out


def fit_linear(x: np.ndarray, target: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + ridge * w
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-5:
            break
    return w


@dataclass
class Scorer:
    """Weights of the listed terms, the patterns and the intercept."""

    place: dict[str, int]
    weights: list[float]
    pattern_weights: list[float]
    intercept: float
    _lexicon: Lexicon | None = field(default=None, repr=False)

    def __call__(self, text: str) -> float:
        if self._lexicon is None:
            self._lexicon = Lexicon(self.place)
        odds = self.intercept + sum(w for w, on in zip(self.pattern_weights, patterns(text), strict=True) if on)
        odds += sum(self.weights[i] for i in self._lexicon(text))
        return float(1 / (1 + math.exp(-min(40.0, max(-40.0, odds)))))


def fit(rows: DataFrame, most: int = MAX_FEATURES) -> Scorer | None:
    """Lexicon, label model and linear classifier from rows (text, label); None without both classes."""
    voters = lexicon(rows, most)
    if not voters:
        return None
    place = {w: i for i, (w, _) in enumerate(voters)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = Lexicon(place)
        for batch in batches:
            seen, held = [], []
            for text in texts_of(batch.column(0)):
                seen.append(listed(text))
                held.append(patterns(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.list_(pa.int32())), pa.array(held, pa.list_(pa.int32())), batch.column(1)],
                names=["seen", "held", "label"])

    # At most SAMPLE_ROWS rows, each with at most MAX_FEATURES numbers.
    sample = rows.mapInArrow(look, "seen array<int>, held array<int>, label int").orderBy("label", "seen", "held").collect()
    x = np.zeros((len(sample), len(voters) + len(PATTERNS)), np.float32)
    label = np.array([r.label for r in sample])
    for i, r in enumerate(sample):
        x[i, r.seen] = 1
        x[i, len(voters):] = r.held

    toward = np.array([1 if z > 0 else -1 for _, z in voters], np.int8)
    by_word = (x[:, : len(voters)] * toward).astype(np.int8)
    nothing = -(~(by_word > 0).any(axis=1)).astype(np.int8)
    by_pattern = x[:, len(voters):].astype(np.int8)
    ballots = np.column_stack([by_word, by_pattern, nothing, np.where(label > 0, 1, -1).astype(np.int8)])
    model = fit_label_model(ballots, np.where(label > 0, 0.9, 0.1))
    w = fit_linear(x, model.posterior(ballots))
    w = [float(v) for v in w]
    return Scorer(place, w[: len(voters)], w[len(voters):-1], w[-1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """id, held_out, score and predicted of every row; the model is fitted first."""
    scorer = fit(training_rows(docs, labels, id_col, text_col, label_col, sample_rows))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value or (lambda text: NO_LABELS)
        for batch in batches:
            scores = pa.array([model(text) for text in texts_of(batch.column(1))], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id_col, "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    scored = docs.select(id_col, text_col).mapInArrow(score, schema)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
