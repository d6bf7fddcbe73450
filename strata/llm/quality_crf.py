"""Quality: a linear-chain conditional random field over a document's lines.

Every line is good or bad.  A line's potentials come from figures of the line
and of the lines before and after it (character classes, words, repeated words
and lines); transitions tie neighbouring labels.  Forward-backward gives each
line's marginal probability of being good; weighted by line length these add up
to the document's share of good text, which a fitted curve turns into a score.

Labels are by document.  Lines of good documents are good; a bad document's
lines take the labels that a first, line-by-line fit gives them (its worst line
is always bad).  The chain is then trained on these by maximum likelihood.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import labelled_sample, map_arrow, platt, sigmoid, small_batches

PER_CLASS = 2500  # the bound of the training sample, for each class
MAX_CHARS = 20_000
#: Byte classes, one figure each: their share of a line.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"$%&*#@~^_=+<>{}[]\\/", b"|", b"!?", b".,;:", b" \t")
FIGURES = len(CLASSES) + 10


@dataclass
class Lines:
    """Figures of all lines of some texts; text i has lines ``at[i]`` to ``at[i + 1]``."""

    figures: np.ndarray
    at: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Lines:
        lines = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
        at = np.asarray(lines.offsets).astype("i8")
        flat, at = lines.flatten(), at - at[0]
        n = len(flat)
        _, offsets, data = flat.buffers()
        ends = np.frombuffer(offsets, "i8", n + 1, 8 * flat.offset)
        raw = np.frombuffer(data, "u1")[ends[0] : ends[-1]] if data is not None else np.empty(0, "u1")
        ends = ends - ends[0]
        size = np.diff(ends)
        long = np.maximum(size, 1)

        def per_line(mark: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            """Sums of ``mark`` between ``bounds``."""
            total = np.zeros(len(bounds) - 1)
            full = np.flatnonzero(np.diff(bounds))
            if len(full):
                total[full] = np.add.reduceat(mark, bounds[:-1][full], dtype="f8")
            return total

        out = np.zeros((n, FIGURES))
        for i, chars in enumerate(CLASSES):
            member = np.zeros(256, "u1")
            member[list(chars)] = 1
            out[:, i] = per_line(member[raw], ends) / long
        words = pc.utf8_split_whitespace(flat)
        bounds = np.asarray(words.offsets).astype("i8")
        bounds = bounds - bounds[0]
        code = np.array(words.flatten().dictionary_encode().indices, "i8")
        same = np.zeros(len(code))
        same[1:] = code[1:] == code[:-1]
        heads = bounds[:-1][np.diff(bounds) > 0]
        same[heads] = 0
        n_words = np.maximum(np.diff(bounds), 1)
        k = len(CLASSES)
        out[:, k] = per_line(same, bounds) / n_words
        out[:, k + 1] = np.log1p(size)
        out[:, k + 2] = np.minimum(size / n_words, 40) / 10
        out[:, k + 3] = size == 0
        # Lines that the text has more than once.
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        line = np.array(flat.dictionary_encode().indices, "i8")
        key = text * (n + 1) + line
        _, where, uses = np.unique(key, return_inverse=True, return_counts=True)
        out[:, k + 4] = (uses[where] > 1) & (size > 0)
        out[:, k + 5] = np.minimum(np.log2(uses[where]), 8) * (size > 0)
        out[:, k + 6] = out[:, 0] > 0.5
        out[:, k + 7] = out[:, 2] > 0.05
        out[:, k + 8] = out[:, 3] > 0.01
        out[:, k + 9] = out[:, k] > 0.2
        return Lines(out, at, size.astype("f8"))

    def with_neighbours(self, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
        """Scaled figures of each line, the line before and the line after (zero
        where there is none), and a constant."""
        x = (self.figures - mean) / std
        before, after = np.zeros_like(x), np.zeros_like(x)
        before[1:], after[:-1] = x[:-1], x[1:]
        before[self.at[:-1]] = 0
        after[self.at[1:] - 1] = 0
        return np.concatenate((x, before, after, np.ones((len(x), 1))), 1)


def forward_backward(unary: np.ndarray, at: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(good) of each line, expected transition counts, log partition sum).

    ``unary``: log-potential of good against bad.  Chains advance together, one
    line a step, longest first, so a step only touches chains still running.
    """
    length = np.diff(at)
    order = np.argsort(-length, kind="stable")
    start, length = at[:-1][order], length[order]
    # Potentials scaled by their larger one.
    good = np.exp(np.minimum(unary, 0))
    bad = np.exp(np.minimum(-unary, 0))
    pot = np.stack((bad, good), 1)
    move = np.exp(transition)
    alpha, norm = np.empty_like(pot), np.empty(len(pot))
    steps = int(length[0]) if len(length) else 0
    running = np.searchsorted(-length, -np.arange(steps), "left") if steps else np.empty(0, "i8")
    for t in range(steps):
        i = start[: running[t]] + t
        a = pot[i] if t == 0 else (alpha[i - 1] @ move) * pot[i]
        norm[i] = a.sum(1)
        alpha[i] = a / norm[i][:, None]
    beta = np.ones_like(pot)
    pairs = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        i = start[: running[t + 1]] + t
        ahead = pot[i + 1] * beta[i + 1] / norm[i + 1][:, None]
        beta[i] = ahead @ move.T
        pairs += (alpha[i].T @ ahead) * move
    p = alpha * beta
    log_z = float(np.log(norm).sum() + np.maximum(unary, 0).sum())
    return p[:, 1] / p.sum(1), pairs, log_z


@dataclass
class Model:
    mean: np.ndarray
    std: np.ndarray
    weight: np.ndarray
    transition: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)

    def good_share(self, lines: Lines) -> np.ndarray:
        """Of each text: the length-weighted mean of its lines' marginals."""
        p, _, _ = forward_backward(lines.with_neighbours(self.mean, self.std) @ self.weight, lines.at, self.transition)
        size = lines.size + 1
        return np.add.reduceat(p * size, lines.at[:-1]) / np.add.reduceat(size, lines.at[:-1])

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        return sigmoid(self.curve[0] * _logit(self.good_share(Lines.of(texts))) + self.curve[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p) - np.log1p(-p)


def _ascend(gradient, value: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Adam."""
    m, v = np.zeros_like(value), np.zeros_like(value)
    for t in range(1, steps + 1):
        g = gradient(value)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        value = value + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return value


def train(lines: Lines, y: np.ndarray, steps: int = 150, rate: float = 0.05, ridge: float = 1e-3) -> Model:
    """Both classes of documents weigh the same."""
    mean, std = lines.figures.mean(0), lines.figures.std(0)
    std[std < 1e-6] = 1.0
    x = lines.with_neighbours(mean, std)
    text = np.repeat(np.arange(len(y)), np.diff(lines.at))
    share = np.array([0.5 / max(1, (y == 0).sum()), 0.5 / max(1, (y == 1).sum())])[y.astype(int)]
    by_line = (share / np.diff(lines.at))[text]
    label = y[text].astype("f8")
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 0
    w = _ascend(lambda w: x.T @ (by_line * (label - sigmoid(x @ w))) - penalty * w, np.zeros(x.shape[1]), steps, rate)
    first = sigmoid(x @ w)
    worst = np.minimum.reduceat(first, lines.at[:-1])[text]
    label = np.where(y[text] == 1, 1.0, np.where((first < 0.5) | (first <= worst), 0.0, 1.0))
    seen = np.zeros((2, 2))
    inner = np.ones(len(text), bool)
    inner[lines.at[:-1]] = False
    inner = np.flatnonzero(inner)
    np.add.at(seen, (label[inner - 1].astype(int), label[inner].astype(int)), 1.0)
    n = len(text)

    def gradient(v: np.ndarray) -> np.ndarray:
        p, pairs, _ = forward_backward(x @ v[:-4], lines.at, v[-4:].reshape(2, 2))
        return np.concatenate(((x.T @ (label - p)) / n - penalty * v[:-4], ((seen - pairs) / n).ravel() - ridge * v[-4:]))

    v = _ascend(gradient, np.concatenate((w, np.zeros(4))), steps // 2, rate)
    return Model(mean, std, v[:-4], v[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Learn from ``labels`` (doc_id, quality) and ``docs`` (doc_id, text), on
    the bounded sample.  Without labels of both classes every score is the
    labels' mean (1 without labels: nothing marks a document as bad)."""
    sample, counts = labelled_sample(docs, labels, "quality", per_class, max_chars)
    got = sample.orderBy("doc_id", "text").toArrow()
    y = np.array(got["y"].to_pylist(), "i8")
    if len({*y.tolist()}) < 2:
        model = Model(np.zeros(FIGURES), np.ones(FIGURES), np.zeros(3 * FIGURES + 1), np.zeros((2, 2)))
        model.curve = (0.0, -40.0 if len(y) and not y.any() else 40.0)
        return model
    lines = Lines.of(got["text"].combine_chunks())
    model = train(lines, y)
    stands = np.array([counts.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1)])
    model.curve = platt(_logit(model.good_share(lines)), y.astype("f8"), stands[y] / stands[y].mean())
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` of each row of ``docs`` (doc_id, text): 0 to 1, higher
    is better.  Null and empty texts are one empty line; repeated rows repeat."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.scores(b.column(1)).astype("f8"))], names=["doc_id", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, score double")
