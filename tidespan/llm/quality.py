"""Quality rules: plain counts, and a logistic regression on hashed word and character n-grams.

Features of a text are the shares of its word 1- and 2-grams and of its character 3- and 4-grams in hashed bins; the model is linear
in them, so a text is scored by the mean weight of its n-grams, batch by batch, without building features. The
regression is fitted on at most ``SAMPLE`` labelled rows (those with the smallest hash of doc_id), three quarters of them for
the weights and one quarter to calibrate scores to probabilities (Platt scaling). A document is kept if the counts pass and the
probability of good quality is at least ``THRESHOLD``.

Defined results: null text: none, so no words, and the counts fail; rows without a label or with a null one do not train; without
labels of both kinds the probability is null and the counts alone decide; repeated rows are judged alike; an
empty table gives none; the counts ignore other columns, ``passing`` carries them along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.tables import prepared, texts_of
from tidespan.llm.texts import STEP, U64, WORD_BYTE, Words, _hashes, mix, powers, rolling, text_parts

SAMPLE = 3000
THRESHOLD = 0.5
BINS = 1 << 16
EPOCHS, RATE, DECAY = 60, 0.3, 1e-6
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def _per_text(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys made different between texts."""
    with np.errstate(over="ignore"):
        return mix(keys + (rows.astype(U64) + U64(1)) * STEP)


def repeated_words(words: Words, width: int = 8) -> np.ndarray:
    """A flag for each word: inside a window found twice or more in its text."""
    n = len(words.bounds) - 1
    sizes = np.diff(words.bounds)
    row = np.repeat(np.arange(n), sizes)
    ok = np.flatnonzero(np.arange(len(row)) + width <= words.bounds[row + 1])
    flags = np.zeros(len(row) + 1, np.int64)
    if len(ok):
        keys = _per_text(rolling(words.hash, width)[ok], row[ok])
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = ok[order[np.append(same, False) | np.append(False, same)]]
        flags[twice] += 1
        np.subtract.at(flags, twice + width, 1)
    return np.cumsum(flags)[:-1] > 0


def duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the lines with a word that equal an earlier line."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(n, np.int64)
    body = data != 10
    first = body.copy()
    first[1:] &= ~body[:-1]
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[heads] = body[heads]
    starts = np.flatnonzero(first)
    place = np.cumsum(body)
    lengths = np.diff(np.append(place[starts] - 1, place[-1]))
    h = _hashes(data[body], place[starts] - 1, lengths)
    worded = np.diff(np.concatenate([[0], np.cumsum(WORD_BYTE[data], dtype=np.int64)])[np.append(starts, len(data))]) > 0
    row = np.searchsorted(offsets, starts, "right") - 1
    row, h = row[worded], h[worded]
    keys = _per_text(h, row)
    order = np.lexsort((keys, row))
    again = np.append(False, keys[order][1:] == keys[order][:-1])[:len(order)]
    return np.bincount(row[order][again], minlength=n)


def counts_of(data: np.ndarray, offsets: np.ndarray, words: Words) -> list[np.ndarray]:
    chars = WORD_BYTE[data] & (data & 0xC0 != 0x80)
    return [np.diff(words.bounds), _sums(chars, offsets), _sums(SYMBOL[data], offsets), duplicate_lines(data, offsets), _sums(repeated_words(words), words.bounds)]


def grams(data: np.ndarray, offsets: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bin, bounds by text) of all n-grams, one kind after the other: words 1 and 2, characters 3 and 4."""
    yield (words.hash & U64(BINS - 1)).astype(np.int64), words.bounds
    yield _runs(words.hash, words.bounds, 2)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(U64)
    starts = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])[offsets]
    for k in (3, 4):
        yield _runs(points, starts, k)


def _runs(values: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(values) - k + 1
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ok = np.arange(len(row)) + k <= bounds[row + 1]
    with np.errstate(over="ignore"):
        h = sum((values[i:n + i] * powers(k + 1)[i + 1] for i in range(1, k)), values[:max(n, 0)] * STEP) if n > 0 else np.empty(0, U64)
        h = (h ^ h >> U64(32)) * U64(0xBF58476D1CE4E5B9) >> U64(48)
    inside = np.flatnonzero(ok)
    return (h[inside] & U64(BINS - 1)).astype(np.int64), np.concatenate([[0], np.cumsum(ok)])[bounds]


class Model:
    """Weights by kind and bin, intercept, and the two numbers of the calibration."""

    def __init__(self, weights: np.ndarray, intercept: float, slope: float, shift: float):
        self.weights, self.intercept, self.slope, self.shift = weights.astype(np.float32), intercept, slope, shift

    def probability(self, data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
        score = np.full(len(offsets) - 1, self.intercept)
        for kind, (bins, bounds) in enumerate(grams(data, offsets, words)):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[kind][bins], dtype=np.float64)])[bounds]
            score += np.diff(sums) / np.maximum(np.diff(bounds), 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -500, 500)))


def _fitted(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, calibrate: np.ndarray) -> Model:
    sizes = np.array([len(r) for r in rows])
    row, col, val = np.repeat(np.arange(len(rows), dtype=np.int32), sizes), np.concatenate(rows), np.concatenate(values)
    rows.clear(), values.clear()
    train = ~calibrate
    rate = labels[train].mean()
    weights, bias = np.zeros(4 * BINS), float(np.log(rate / (1 - rate)))
    n, m1, m2, b1, b2 = int(train.sum()), np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0

    def scored() -> np.ndarray:
        return np.bincount(row, weights.astype(np.float32)[col] * val, len(labels)) + bias

    for t in range(1, EPOCHS + 1):
        score = scored()
        error = np.where(train, 1 / (1 + np.exp(-np.clip(score, -500, 500))) - labels, 0.0)
        g, gb = np.bincount(col, error.astype(np.float32)[row] * val, len(weights)) / n + DECAY * weights, error.sum() / n
        m1, m2, b1, b2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g, 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
        weights -= RATE * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-9)
        bias -= 0.05 * (b1 / (1 - 0.9 ** t)) / (np.sqrt(b2 / (1 - 0.99 ** t)) + 1e-9)
    score = scored()
    held = calibrate if len(set(labels[calibrate].tolist())) == 2 else np.ones(len(labels), bool)
    return Model(weights.reshape(4, BINS), bias, *_platt(score[held], labels[held]))


def _platt(score: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with the usual smoothed targets and a small ridge."""
    up, down = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([score, np.ones_like(score)])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -500, 500)))
        step = np.linalg.solve(x * (p * (1 - p) + 1e-9) @ x.T + 1e-6 * np.eye(2), x @ (p - target))
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from at most ``sample`` labelled rows, or None if they are not of both kinds. Their features, a few
    thousand numbers a row, meet in one task; the driver gets the weights."""
    prepared(docs.sparkSession)
    chosen = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = texts_of(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_parts(batch.column(1)):
                words = Words(data, offsets)
                kinds = list(grams(data, offsets, words))
                bins, shares = [], []
                for i in range(len(offsets) - 1):
                    b, s = [], []
                    for kind, (found, bounds) in enumerate(kinds):
                        one, n = np.unique(found[bounds[i]:bounds[i + 1]] + kind * BINS, return_counts=True)
                        b.append(one)
                        s.append(n / max(n.sum(), 1))
                    bins.append(np.concatenate(b).astype(np.int32))
                    shares.append(np.concatenate(s).astype(np.float32))
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(2).slice(at, n), pa.array(bins, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))], names=["doc_id", "label", "bins", "shares"])

    features = rows.mapInArrow(run, "doc_id long, label int, bins array<int>, shares array<float>")
    found = features.repartition(1).mapInArrow(_train, "weights binary, intercept double, slope double, shift double").first()
    return Model(np.frombuffer(found.weights, np.float32).reshape(4, BINS), found.intercept, found.slope, found.shift) if found else None


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows, in one task as they are bounded by the sample; no row if they are of one kind."""
    ids, y, bins, shares = [], [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        y += batch.column(1).to_pylist()
        bins += [np.array(x.values) for x in batch.column(2)]
        shares += [np.array(x.values) for x in batch.column(3)]
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    labels = np.array(y, np.float64)[order]
    if len(set(y)) < 2:
        return
    held = (np.array(ids, np.int64)[order].astype(U64) * STEP >> U64(40)) % U64(4) == 0
    if len(set(labels[~held].tolist())) < 2:
        held = np.zeros(len(labels), bool)
    model = _fitted([bins[i] for i in order], [shares[i] for i in order], labels, held)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), *(pa.array([x], pa.float64()) for x in (model.intercept, model.slope, model.shift))], names=["weights", "intercept", "slope", "shift"])


def judged(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``probability`` and ``kept`` of every whole text. The model is of fixed size."""
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_parts(batch.column(1)):
                words, n = Words(data, offsets), len(offsets) - 1
                chance = shared.value.probability(data, offsets, words) if shared.value else None
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), *(pa.array(c, pa.int64()) for c in counts_of(data, offsets, words)), pa.array(chance) if chance is not None else pa.nulls(n, pa.float64())],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"])

    rows = texts_of(docs, id_col, text_col).mapInArrow(run, COUNTS + ", probability double")
    return _verdict(rows, threshold)


def _verdict(rows: DataFrame, threshold: float) -> DataFrame:
    failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("probability") >= threshold, F.lit(True)))


def passing(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) that are kept, as they were."""
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            for at, data, offsets in text_parts(column):
                words = Words(data, offsets)
                n, _, _, _, again = counts_of(data, offsets, words)
                keep = (n >= 20) & (100 * again <= 30 * n)
                if shared.value:
                    keep &= shared.value.probability(data, offsets, words) >= threshold
                yield batch.slice(at, len(n)).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
