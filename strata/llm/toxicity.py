"""Toxicity: a convolutional text classifier, trained in numpy.

Words are hashed (crc32 of the lower-cased word, and of its first letters, so
that unseen forms of a word share something); each hash met often enough in
training has an embedding, others are zero.  Filters of several widths run over
the word vectors, each is max-pooled over the whole text, and a logistic layer
scores the pooled values.  Only a text is an input of its score.  Languages
have thresholds of their own, calibrated on labelled rows kept out of training.

For scoring, each filter tap times each distinct word's vector is computed once
a batch, so a convolution is a sum of looked-up rows.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import crc_fold, documents, labelled_sample, map_arrow, platt, sigmoid, small_batches

WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 8
PREFIX = 5
PER_CLASS = 2500  # the bound of the training sample, for each class
MAX_CHARS = 20_000
SLICE_WORDS = 400_000  # words convolved at a time
_EDGE = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^@"


def hashes(word: str) -> tuple[int, int]:
    w = word.strip(_EDGE)
    return zlib.crc32(w.encode()), zlib.crc32(b"^" + w[:PREFIX].encode())


@dataclass
class Words:
    """Texts as codes of distinct words: text i has ``code[at[i]:at[i + 1]]``."""

    distinct: list[tuple[int, int]]
    code: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Words:
        texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        pieces = pc.utf8_split_whitespace(texts)
        at = np.asarray(pieces.offsets).astype("i8")
        coded = pieces.flatten().dictionary_encode()
        return Words([hashes(w) for w in coded.dictionary.to_pylist()], np.array(coded.indices, "i8"), at - at[0])


@dataclass
class Model:
    rows: dict[int, int]  # hash -> row of `embedding`; row 0 is zero
    embedding: np.ndarray
    filters: list[np.ndarray]  # for each width: (taps, DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5
    by_lang: dict[str, float] = field(default_factory=dict)

    def vectors(self, distinct: list[tuple[int, int]]) -> np.ndarray:
        """Of the distinct words, with a zero row last for padding."""
        get = self.rows.get
        pair = np.array([(get(a, 0), get(b, 0)) for a, b in distinct] + [(0, 0)], "i8")
        return self.embedding[pair[:, 0]] + self.embedding[pair[:, 1]]

    def pooled(self, words: Words) -> np.ndarray:
        """(texts, widths * FILTERS) maxima of the rectified filter responses.

        A text is followed by padding, so a filter never sees two texts; long
        runs of words are convolved in slices whose maxima are combined.
        """
        x, n = self.vectors(words.distinct), np.diff(words.at)
        pad, total = max(WIDTHS) - 1, len(words.at) - 1
        at = words.at[:-1] + pad * np.arange(total)
        code = np.full(len(words.code) + pad * total + pad, len(x) - 1, "i8")
        code[np.arange(len(words.code)) + np.repeat(at - words.at[:-1], n)] = words.code
        best = np.zeros((total, len(WIDTHS) * FILTERS), "f4")
        for i, width in enumerate(WIDTHS):
            taps = [(x @ self.filters[i][k]).astype("f4") for k in range(width)]
            own = best[:, i * FILTERS : (i + 1) * FILTERS]
            for lo in range(0, len(code) - pad, SLICE_WORDS):
                hi = min(lo + SLICE_WORDS, len(code) - pad)
                r = taps[0][code[lo:hi]]
                for k in range(1, width):
                    r += taps[k][code[lo + k : hi + k]]
                # Texts with a word in the slice; the padding after one counts as its own.
                first = int(np.searchsorted(at, lo, "right")) - 1
                last = int(np.searchsorted(at, hi, "left"))
                starts = np.maximum(at[first:last], lo) - lo
                np.maximum(own[first:last], np.maximum.reduceat(r, starts) + self.bias[i], out=own[first:last])
        return best

    def logits(self, words: Words) -> np.ndarray:
        return self.pooled(words) @ self.out + self.out_bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        return sigmoid(self.scale[0] * self.logits(Words.of(texts)) + self.scale[1])


def _start(words: Words, y: np.ndarray, rng: np.random.Generator, least: int) -> Model:
    """Rows for hashes met in ``least`` texts, begun from their log-odds."""
    text = np.repeat(np.arange(len(y)), np.diff(words.at))
    pairs = np.unique(text * len(words.distinct) + words.code) if len(words.distinct) else np.empty(0, "i8")
    doc, code = pairs // max(1, len(words.distinct)), pairs % max(1, len(words.distinct))
    of = np.array(words.distinct, "i8").reshape(-1, 2)
    flat = np.unique(np.concatenate([doc * 2**33 + of[code, 0], doc * 2**33 + of[code, 1] + 2**32]) if len(pairs) else np.empty(0, "i8"))
    name, owner = flat % 2**32, flat // 2**33
    keys, inverse, uses = np.unique(name, return_inverse=True, return_counts=True)
    toxic = np.bincount(inverse, weights=y[owner], minlength=len(keys)) if len(keys) else np.empty(0)
    n1, n0 = max(1, y.sum()), max(1, len(y) - y.sum())
    odds = np.log((toxic + 0.5) / (n1 + 1)) - np.log((uses - toxic + 0.5) / (n0 + 1))
    kept = uses >= least
    embedding = np.zeros((int(kept.sum()) + 1, DIM), "f4")
    embedding[1:] = rng.normal(0, 0.02, (int(kept.sum()), DIM))
    embedding[1:, 0] += 0.2 * odds[kept]
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype("f4") for w in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] = np.abs(f[:, 0, : FILTERS // 2]) + 0.5
    bias = [np.full(FILTERS, -0.1, "f4") for _ in WIDTHS]
    out = np.abs(rng.normal(0, 0.2, len(WIDTHS) * FILTERS)).astype("f4")
    return Model({int(k): i + 1 for i, k in enumerate(keys[kept])}, embedding, filters, bias, out)


def train(texts: pa.Array, y: np.ndarray, weight: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 0.05, least: int = 4, seed: int = 7) -> Model:
    """Weighted logistic loss by Adagrad.  Pooling passes a gradient only to the
    window with the maximum, so each text updates few rows."""
    rng = np.random.default_rng(seed)
    words = Words.of(texts)
    model = _start(words, y, rng, least)
    if len(set(y.tolist())) < 2:
        model.out[:] = 0
        return model
    get = model.rows.get
    pair = np.array([(get(a, 0), get(b, 0)) for a, b in words.distinct] + [(0, 0)], "i8")
    pad = max(WIDTHS) - 1
    sums: dict[str, np.ndarray] = {}

    def step(name: str, value: np.ndarray, grad: np.ndarray, at=None) -> None:
        total = sums.setdefault(name, np.full(value.shape, 1e-3, "f4"))
        if at is None:
            total += grad * grad
            value -= rate * grad / np.sqrt(total)
        else:
            total[at] += grad * grad
            value[at] -= rate * grad / np.sqrt(total[at])

    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            code = [np.append(words.code[words.at[i] : words.at[i + 1]], [len(pair) - 1] * (pad + 1)) for i in some]
            at = np.cumsum([0, *map(len, code)])
            rows = pair[np.concatenate(code)]
            x = model.embedding[rows[:, 0]] + model.embedding[rows[:, 1]]
            value = np.zeros((len(some), len(WIDTHS) * FILTERS), "f4")
            where = np.zeros((len(some), len(WIDTHS) * FILTERS), "i8")
            for i, width in enumerate(WIDTHS):
                r = x[: len(x) - pad] @ model.filters[i][0]
                for k in range(1, width):
                    r = r + x[k : len(x) - pad + k] @ model.filters[i][k]
                r += model.bias[i]
                for d in range(len(some)):
                    own = r[at[d] : at[d + 1] - pad]
                    top = own.argmax(0)
                    where[d, i * FILTERS : (i + 1) * FILTERS] = at[d] + top
                    value[d, i * FILTERS : (i + 1) * FILTERS] = own[top, np.arange(FILTERS)]
            on = value > 0
            p = sigmoid(np.where(on, value, 0) @ model.out + model.out_bias)
            d_z = (weight[some] * (p - y[some])).astype("f4") / len(some)
            d_value = np.where(on, d_z[:, None] * model.out[None, :], 0).astype("f4")
            d_out = np.where(on, value, 0).T @ d_z + 1e-4 * model.out
            d_x = np.zeros_like(x)
            for i, width in enumerate(WIDTHS):
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                d_f = np.zeros_like(model.filters[i])
                f_of = np.tile(np.arange(FILTERS), len(some))
                g, t = d_value[:, cols].ravel(), where[:, cols].ravel()
                for k in range(width):
                    for f in range(FILTERS):
                        mine = f_of == f
                        d_f[k, :, f] = x[t[mine] + k].T @ g[mine]
                    np.add.at(d_x, t + k, g[:, None] * model.filters[i][k].T[f_of])
                step(f"filter{i}", model.filters[i], d_f)
                step(f"bias{i}", model.bias[i], d_value[:, cols].sum(0))
            step("out", model.out, d_out)
            model.out_bias -= 0.5 * rate * float(d_z.sum())
            touched = np.flatnonzero(np.abs(d_x).sum(1))
            names = rows[touched].T.ravel()
            grads = np.concatenate([d_x[touched]] * 2)
            keep = names > 0
            uniq, inv = np.unique(names[keep], return_inverse=True)
            if len(uniq):
                total = np.zeros((len(uniq), DIM), "f4")
                np.add.at(total, inv, grads[keep])
                step("embedding", model.embedding, total, uniq)
    return model


def _best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Between the scores that give the best weighted F1; of equals the middle."""
    order = np.argsort(-score, kind="stable")
    s, hit, w = score[order], y[order] * weight[order], weight[order]
    f1 = 2 * np.cumsum(hit) / np.maximum(np.cumsum(w) + hit.sum(), 1e-9)
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores fall on the same side
    top = np.flatnonzero(f1 >= f1.max() - 1e-9)
    i = int(top[len(top) // 2])
    return float(np.clip((s[i] + (s[i + 1] if i + 1 < len(s) else 0.0)) / 2, 0.3, 0.95))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS, least: int = 10, least_lang: int = 40) -> Model:
    """Learn from ``labels`` (doc_id, toxic) and ``docs`` (doc_id, text, lang).

    Of the bounded sample, fold 4 of 5 calibrates the scores and thresholds and
    folds 1 to 3 train.  A language with fewer than ``least_lang`` calibration
    rows of either class takes the common threshold, which is 0.5 where there are
    fewer than ``least``.  Without labels of both
    classes every score is the labels' mean (0 without labels).
    """
    sample, counts = labelled_sample(docs, labels, "toxic", per_class, max_chars)
    sample = sample.withColumn("fold", crc_fold(F.col("doc_id")))
    names = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("y", pa.int32()), ("fold", pa.int64())])

    def run(batches):
        own = [b.rename_columns(names.names).cast(names) for b in batches]
        got = pa.Table.from_batches(own, names).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_fitted(got, counts, least, least_lang))], pa.binary())], names=["model"])

    # The sample is bounded; one task learns from it, so that neither its texts nor
    # the arrays of training are the driver's.
    found = sample.coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else _fitted(names.empty_table(), counts, least, least_lang)


def _fitted(got: pa.Table, counts: dict[int, int], least: int, least_lang: int) -> Model:
    """The model of a sample (doc_id, text, lang, y, fold) in the order of doc_id."""
    y = np.array(got["y"].to_pylist(), "f4")
    # Each class stands for all its labelled rows, not for the sample's share.
    stands = {c: counts.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([stands[int(c)] for c in y], "f4")
    if len({*y.tolist()}) < 2:
        model = Model({}, np.zeros((1, DIM), "f4"), [np.zeros((w, DIM, FILTERS), "f4") for w in WIDTHS], [np.zeros(FILTERS, "f4") for _ in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, "f4"))
        model.scale = (1.0, 40.0 if y.sum() else -40.0)
        return model
    weight /= weight.mean()
    held = np.array(got["fold"].to_pylist()) == 4
    if len({*y[held].tolist()}) < 2 or len({*y[~held].tolist()}) < 2:
        held = np.arange(len(y)) % 4 == 0
    texts = got["text"].combine_chunks()
    model = train(texts.filter(pa.array(~held)), y[~held], weight[~held])
    z = model.logits(Words.of(texts.filter(pa.array(held)))).astype("f8")
    model.scale = platt(z, y[held], weight[held].astype("f8"))
    score = sigmoid(model.scale[0] * z + model.scale[1])
    if min((y[held] == 1).sum(), (y[held] == 0).sum()) >= least:
        model.threshold = _best_threshold(score, y[held], weight[held])
    langs = np.array(["" if x is None else x for x in got["lang"].to_pylist()])[held]
    for lang in sorted({*langs.tolist()}):
        own = langs == lang
        if min((y[held][own] == 1).sum(), (y[held][own] == 0).sum()) >= least_lang:
            model.by_lang[lang] = _best_threshold(score[own], y[held][own], weight[held][own])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of documents, with ``score`` and ``rejected``: whether the
    score reaches the threshold of the row's lang (null: the common one).
    Null text scores as the empty text; repeated rows repeat."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        s = m.scores(b.column(1))
        limit = np.array([m.by_lang.get(x, m.threshold) for x in b.column(2).to_pylist()])
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(s.astype("f8")), pa.array(s >= limit)], names=[*b.schema.names, "score", "rejected"])

    return map_arrow(documents(docs), run, "doc_id long, text string, lang string, source string, n_chars long, score double, rejected boolean")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the fitted classifier does not reject."""
    return documents(score(docs, fit(docs, labels)).where("not rejected"))
