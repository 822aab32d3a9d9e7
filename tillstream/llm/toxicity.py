"""Toxicity by a classifier chain.

Categories are predicted one after another, each by a linear model over hashed
features of the text's words and over the probabilities of the categories
before it. For training, those probabilities come from models of other folds,
so that a later model sees them as uncertain as they will be when it is used.

Features are whole words (A-Z in lower case, marks at their ends taken off)
and all runs of four and of six characters in them, hashed; a feature counts
once for a text, whole texts count. A model weighs the features whose presence goes
with its category beyond chance; the others, most of them, would only be learned
by heart.

The models are fitted on a bounded number of labelled documents (``sample``),
the first by a hash of doc_id, each category's positives first for one half;
every document is scored. Fits are tasks of a Spark job, one for each fold.

A null or empty text has no features and is scored by the constant alone. Rows
without a label, or with a null in it, are not used for training; without a
positive and a negative row a category's probability is its share of positives.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import lower_ascii, with_text_columns

BITS = 18
SAMPLE, FOLDS = 12_000, 3
_MARKS = b".,;:!?\"'()[]{}#$%&*|<>-_/\\"


def word_features(word: bytes) -> list[int]:
    """Hashed features of one word."""
    word = word.strip(_MARKS)
    if not word:
        return []
    out = {zlib.crc32(b"w" + word)}
    for size in (4, 6):
        out.update(zlib.crc32(word[i : i + size]) for i in range(len(word) - size + 1))
    return [value & ((1 << BITS) - 1) for value in out]


class Features:
    """Distinct features of texts, kept by word; of ``useful`` ones only, where given."""

    def __init__(self, useful: np.ndarray | None = None):
        self.known: dict[bytes, np.ndarray] = {}
        self.useful = useful

    def of(self, text: bytes | None) -> np.ndarray:
        words = set(lower_ascii(text).split()) if text else set()
        if len(self.known) > 300_000:
            self.known.clear()
        for word in words.difference(self.known):
            own = np.array(word_features(word), np.int32)
            self.known[word] = own if self.useful is None else own[self.useful[own]]
        found = [own for word in words if len(own := self.known[word])]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


@dataclass
class Linear:
    """Weights by feature, of the chain's earlier probabilities, and the constant."""

    weights: np.ndarray
    chain: np.ndarray
    constant: float

    def scores(self, features: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
        sums = np.array([self.weights[own].sum() for own in features])
        return sums + earlier @ self.chain + self.constant


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(features: list[np.ndarray], labels: np.ndarray, least: float = 15.0) -> np.ndarray:
    """Which features go with the label, by the chi-square of their presence."""
    flat = np.concatenate([*features, np.zeros(0, np.int32)])
    of = np.repeat(labels, [len(own) for own in features])
    a = np.bincount(flat, of, 1 << BITS)
    b = np.bincount(flat, 1 - of, 1 << BITS)
    c, d = labels.sum() - a, len(labels) - labels.sum() - b
    below = (a + b) * (c + d) * (a + c) * (b + d)
    return (a + b > 2) & (len(labels) * (a * d - b * c) ** 2 >= least * np.maximum(below, 1))


def fit_linear(
    features: list[np.ndarray], earlier: np.ndarray, labels: np.ndarray,
    epochs: int = 20, rate: float = 0.5, batch: int = 64,
) -> Linear:
    """Logistic regression by AdaGrad on the telling features; the same for the same rows."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Linear(
        np.zeros(1 << BITS), np.zeros(earlier.shape[1]), float(np.log(share / (1 - share)))
    )
    if not 0 < labels.sum() < len(labels):
        return model
    chosen = telling(features, labels)
    features = [own[chosen[own]] for own in features]
    seen, chain_seen, constant_seen = np.full(1 << BITS, 1e-2), np.full(earlier.shape[1], 1e-2), 1e-2
    order = np.random.default_rng(7)
    for _ in range(epochs):
        turn = order.permutation(len(labels))
        for at in range(0, len(turn), batch):
            rows = turn[at : at + batch]
            own = [features[r] for r in rows]
            error = _sigmoid(model.scores(own, earlier[rows])) - labels[rows]
            flat = np.concatenate(own)
            gradient = np.repeat(error, [len(x) for x in own]) / len(rows)
            target, place = np.unique(flat, return_inverse=True)
            total = np.bincount(place, gradient, len(target))
            seen[target] += total**2
            model.weights[target] -= rate * total / np.sqrt(seen[target])
            chain = earlier[rows].T @ error / len(rows)
            chain_seen += chain**2
            model.chain -= rate * chain / np.sqrt(chain_seen)
            constant_seen += error.mean() ** 2
            model.constant -= rate * error.mean() / np.sqrt(constant_seen)
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int
) -> DataFrame:
    """doc_id, text and a 0/1 column for each category, of ``sample`` rows at most.

    Rows that are positive in the last category come first for up to one half.
    A doc_id that is labelled twice is positive where one of its labels is.
    """
    rare = list(categories)[-1]
    known = labels.select("doc_id", *[c.cast("int").alias(name) for name, c in categories.items()])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(name).alias(name) for name in categories])
    order = F.xxhash64("doc_id"), F.col("doc_id")
    positive = known.filter(F.col(rare) == 1).orderBy(*order).limit(sample // 2)
    negative = known.filter(F.col(rare) == 0).orderBy(*order).limit(sample - sample // 2)
    # at most ``sample`` short rows, so that the texts stay where they are
    return docs.select("doc_id", "text").join(
        F.broadcast(positive.unionByName(negative)), "doc_id"
    )


_MODEL = "category int, fold int, constant double, chain binary, weights binary, held binary"


def _fit_job(rows: DataFrame, names: list[str], category: int, folds: list[int], n_folds: int):
    """Models of one category: one without each listed fold (-1: of all rows)."""

    def fit(table: pa.Table) -> pa.Table:
        fold, features = table.column("fit")[0].as_py(), Features()
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        texts = table.column("text").cast(pa.binary()).to_pylist()
        own = [features.of(text) for text in texts]
        ids = np.array([zlib.crc32(str(x).encode()) % n_folds for x in table.column("doc_id").to_pylist()])
        labels = table.column(names[category]).to_numpy().astype(np.float64)
        earlier = np.array(table.column("earlier").to_pylist(), np.float64).reshape(len(own), category)
        train = np.flatnonzero(ids != fold)
        model = fit_linear([own[i] for i in train], earlier[train], labels[train])
        held = np.flatnonzero(ids == fold)
        guess = _sigmoid(model.scores([own[i] for i in held], earlier[held])) if len(held) else held
        out = np.array([table.column("doc_id")[int(i)].as_py() for i in held], np.int64)
        return pa.table(
            {
                "category": pa.array([category], pa.int32()),
                "fold": pa.array([fold], pa.int32()),
                "constant": pa.array([model.constant]),
                "chain": pa.array([model.chain.tobytes()], pa.binary()),
                "weights": pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()),
                "held": pa.array([out.tobytes() + np.asarray(guess, np.float64).tobytes()], pa.binary()),
            }
        )

    fits = F.explode(F.array(*[F.lit(fold) for fold in folds]))
    return rows.withColumn("fit", fits).groupBy("fit").applyInArrow(fit, _MODEL).collect()


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column],
    sample: int = SAMPLE, folds: int = FOLDS,
) -> list[Linear]:
    """The chain's models. What tasks and driver hold is bounded by ``sample`` documents."""
    from tillstream.llm.common import materialize

    names = list(categories)
    rows = materialize(training_rows(docs, labels, categories, sample))
    rows = rows.withColumn("earlier", F.array().cast("array<double>"))
    models = []
    for number in range(len(names)):
        last = number == len(names) - 1
        wanted = [-1] if last else [-1, *range(folds)]
        guesses: list[tuple[int, float]] = []
        for row in _fit_job(rows, names, number, wanted, folds):
            if row.fold < 0:
                models.append(
                    Linear(
                        np.frombuffer(row.weights, np.float32),
                        np.frombuffer(row.chain, np.float64),
                        row.constant,
                    )
                )
            else:
                half = len(row.held) // 2
                guesses += zip(
                    np.frombuffer(row.held[:half], np.int64).tolist(),
                    np.frombuffer(row.held[half:], np.float64).tolist(),
                    strict=True,
                )
        if not last:
            spark = docs.sparkSession
            found = spark.createDataFrame(guesses, "doc_id bigint, guess double")
            rows = materialize(
                rows.join(found.dropDuplicates(["doc_id"]), "doc_id")
                .withColumn("earlier", F.array_append("earlier", F.col("guess")))
                .drop("guess")
            )
    return models


def predict(docs: DataFrame, models: list[Linear], names: list[str]) -> DataFrame:
    """Probabilities ``p_<category>`` of every document.

    Features that no model weighs are left out, and words stay known for a task.
    """
    useful = np.zeros(1 << BITS, bool)
    for model in models:
        useful |= model.weights != 0
    features = Features(useful)

    def score(texts):
        own = [features.of(text) for text in texts]
        earlier = np.zeros((len(own), 0))
        for model in models:
            guess = _sigmoid(model.scores(own, earlier)) if own else np.zeros(0)
            earlier = np.concatenate([earlier, guess[:, None]], axis=1)
        return [earlier[:, k].tolist() for k in range(len(models))]

    return with_text_columns(docs, ", ".join(f"p_{name} double" for name in names), score)


def chain_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Probabilities of the label table's categories, poor quality before toxicity."""
    categories = {"poor_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    models = fit_chain(docs, labels, categories, **options)
    return predict(docs, models, list(categories)).withColumn("toxic", F.col("p_toxic") >= 0.5)
