"""Quality classifier from trusted positives and unlabelled text: non-negative PU risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import append_columns, chosen, fold, fresh, sample_share, table

CLASSES = 16
WIDTH = 256 + CLASSES * CLASSES + 6
# Rows and columns that the driver widens to double precision at a time.
BLOCK, COLUMNS = 1024, 64


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 11, dtype=np.int32)
    groups = [b" ", b"\n\t\r\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".", b",;:"]
    groups += [b"!?", b"|/\\_=<>~^", b"%&$#*@+", b"'\"`", b"", b"()[]{}-"]
    for kind, members in enumerate(groups):
        kinds[list(members)] = kind
    kinds[0x80:0xC0], kinds[0xC0:] = 13, 14
    return kinds


BYTE_CLASS = _byte_classes()


def features(text: bytes | None) -> np.ndarray:
    """Shape of a whole text: bytes, pairs of byte classes, and how much of it repeats.

    Shares are square roots, which evens out their spread. A null or empty text is all zeros.
    """
    out = np.zeros(WIDTH, dtype=np.float32)
    if not text:
        return out
    data = np.frombuffer(text, dtype=np.uint8)
    out[:256] = np.sqrt(np.bincount(data, minlength=256) / len(data))
    kinds = BYTE_CLASS[data]
    pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
    out[256 : 256 + CLASSES * CLASSES] = np.sqrt(pairs / max(1, len(data) - 1))
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    out[-6:] = (
        np.log1p(len(data)),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        min(1.0, len(data) / n / 40),
        min(1.0, n / len(lines) / 100),
    )
    return out


@dataclass
class Linear:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        margin = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _fit(gradient, dims: int, n: int, seed: int, epochs: int, batch: int, rate: float, decay: float):
    """Adam on a linear model. gradient(weights, bias, rows of P, rows of U) gives both derivatives."""
    rng = np.random.default_rng(seed)
    w, m, v = np.zeros(dims + 1), np.zeros(dims + 1), np.zeros(dims + 1)
    for step in range(1, epochs * max(1, n // batch) + 1):
        g = gradient(w, rng)
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


@dataclass
class Design:
    """Rows of a matrix as the linear model takes them, scaled in double precision when they are drawn.

    The driver thus holds the features as they came, in single precision, and one batch.
    """

    x: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def __len__(self) -> int:
        return len(self.x)

    def half(self, turn: int) -> Design:
        return Design(self.x[turn::2], self.mean, self.scale)

    def rows(self, at: np.ndarray | slice) -> np.ndarray:
        some = self.x[at]
        out = np.ones((len(some), some.shape[1] + 1))
        scaled = out[:, :-1]
        np.subtract(some, self.mean, out=scaled)
        scaled /= self.scale
        np.clip(scaled, -6, 6, out=scaled)
        return out

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([self.rows(slice(i, i + BLOCK)) @ w for i in range(0, len(self), BLOCK)])


def moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every column in double precision, some columns at a time."""
    mean, deviation = np.empty(x.shape[1]), np.empty(x.shape[1])
    for at in range(0, x.shape[1], COLUMNS):
        some = x[:, at : at + COLUMNS].astype(np.float64)
        mean[at : at + COLUMNS], deviation[at : at + COLUMNS] = some.mean(axis=0), some.std(axis=0)
    return mean, deviation


def estimate_prior(positive: Design, unlabelled: Design, seed: int = 3, batch: int = 1024) -> float:
    """Share of positives among the unlabelled, from both samples alone.

    A discriminator of positives against unlabelled text, fitted on one half of each, gives the
    ratio of their densities. Where all text is positive that ratio is one over the share; on
    the other half of the positives its median estimates it. Done both ways round.
    """
    ratios = []
    for turn in range(2):
        p, u = positive.half(turn), unlabelled.half(turn)

        def gradient(w, rng, p=p, u=u):
            a, b = p.rows(rng.integers(0, len(p), batch)), u.rows(rng.integers(0, len(u), batch))
            return (a.T @ (_sigmoid(a @ w) - 1) + b.T @ _sigmoid(b @ w)) / (2 * batch)

        w = _fit(gradient, p.x.shape[1], max(len(p), len(u)), seed, 30, batch, 0.01, 0.003)
        odds = np.exp(np.clip(positive.half(1 - turn).margins(w), -3, 3))
        ratios.append(np.median(odds))
    return float(np.clip(1 / np.mean(ratios), 0.05, 0.98))


def fit_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, seed: int = 5, batch: int = 1024
) -> Linear:
    """Minimise the non-negative unbiased risk of a linear model with the logistic loss.

    The risk of the negatives is estimated as that of the unlabelled, all taken as negative, less
    the positives' part of it. When a batch's estimate falls below zero the model has begun to
    fit the unlabelled rows one by one, and the step goes back up that term instead.
    """
    mean, deviation = moments(unlabelled)
    scale = deviation + 1e-3
    p, u = Design(positive, mean, scale), Design(unlabelled, mean, scale)
    share = estimate_prior(p, u) if prior is None else prior

    def gradient(w, rng):
        a, b = p.rows(rng.integers(0, len(p), batch)), u.rows(rng.integers(0, len(u), 2 * batch))
        za, zb = a @ w, b @ w
        as_negative = b.T @ _sigmoid(zb) / len(b) - share * (a.T @ _sigmoid(za)) / len(a)
        if np.logaddexp(0, zb).mean() - share * np.logaddexp(0, za).mean() < 0:
            return -as_negative
        return share * (a.T @ (_sigmoid(za) - 1)) / len(a) + as_negative

    w = _fit(gradient, p.x.shape[1], len(u), seed, 60, batch, 0.01, 0.001)
    return Linear(mean, scale, w[:-1], float(w[-1]))


def _matrix(rows: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    def make(texts: Iterator[list]) -> Iterator[list]:
        for batch in texts:
            yield [[features(t) for t in batch]]

    # In a fixed order: the fit draws batches by position.
    slim = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made = append_columns(slim, "text", make, {"x": "array<float>"}).select("id", "x").toArrow()
    out = np.zeros((made.num_rows, WIDTH), dtype=np.float32)
    place = np.empty(made.num_rows, dtype=np.int64)
    place[pc.sort_indices(made.column("id")).to_numpy()] = np.arange(made.num_rows)
    at = 0
    for chunk in made.column("x").chunks:
        out[place[at : at + len(chunk)]] = chunk.flatten().to_numpy(zero_copy_only=False).reshape(len(chunk), WIDTH)
        at += len(chunk)
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    positives: int = 6000,
    unlabelled: int = 12000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Linear | None:
    """Model from at most about ``positives`` labelled and ``unlabelled`` other texts of the training folds.

    Only labels of value 1 are read; labels of value 0 and all further columns are not. The
    samples are hash shares of the rows, equal ones taken once, so an id that fills many rows adds
    no more than its share; the features of the sampled texts, some 2 KB each, are what
    the driver gets. None without a positive or a text to learn from.
    """
    seen = fold(id_col, folds) != held_fold
    good = labels.filter((F.col(label_col) == 1) & seen).select(id_col).distinct()
    print_ = fresh("print_", docs.columns)
    rows = docs.filter(seen).select(id_col, text_col, F.xxhash64(id_col, text_col).alias(print_))
    labelled = rows.join(good, id_col, "left_semi")

    def sample(of: DataFrame, wanted: int, seed: int) -> np.ndarray:
        some = of.filter(chosen(F.col(print_), sample_share(of.count(), wanted), seed))
        return _matrix(some.dropDuplicates([print_]), print_, text_col)

    p, u = sample(labelled, positives, 1), sample(rows, unlabelled, 2)
    return fit_nnpu(p, u) if len(p) and len(u) else None


def with_quality(docs: DataFrame, model: Linear | None, out: str, text_col: str = "text") -> DataFrame:
    """All columns and the score of every whole text, from 0 to 1; 0.5 for all without a model."""

    def make(texts: Iterator[list]) -> Iterator[list]:
        for batch in texts:
            if not batch or model is None:
                yield [[0.5] * len(batch)]
            else:
                yield [np.concatenate([model(np.stack([features(t) for t in batch[i : i + 512]])) for i in range(0, len(batch), 512)])]

    return append_columns(docs, text_col, make, {out: "double"})


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of the documents.

    Null and empty texts get the score of a text without any feature; repeated rows are
    scored alike; null ids are in the training folds; an empty table gives no rows.
    """
    model = train(docs, labels)
    scored = with_quality(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_nnpu_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
