"""Quality rules: fixed base rules and a calibrated model on hashed word and character n-grams."""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from metricloom.llm.common import Ranges, fresh, mixed, small_batches, word_bounds

#: Labelled rows the model is fitted on, chosen by a hash of the id. A documented bound.
FIT_ROWS = 4_000
BUCKETS = 1 << 18
MIN_WORDS = 50
#: Fixed threshold on the calibrated probability of good quality.
MIN_PROBABILITY = 0.5
_CHAR_ORDERS = (3, 4)
_STEPS = 150
_RATE = 0.5
_SHRINK = 1e-6
_CHUNK = 1 << 18  # entries of the fitted texts held at once
_ENTRY = np.dtype([("row", np.int32), ("bucket", np.int32), ("share", np.float32)])

SIGNALS = [
    "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint",
    "n_repeat_words bigint",
]


def _base(text: str, points: np.ndarray, start: np.ndarray, end: np.ndarray, windows: np.ndarray):
    """The five base counts of a text."""
    lines = Counter(x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r"))
    repeated = 0
    if windows.size:
        _, back, seen = np.unique(windows, return_inverse=True, return_counts=True)
        twice = seen[back] > 1
        covered = np.zeros(start.size, bool)
        for shift in range(3):
            covered[shift : shift + twice.size] |= twice
        repeated = int(covered.sum())
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (
        int(start.size),
        int((end - start).sum()),
        symbols,
        sum(lines.values()) - len(lines),
        repeated,
    )


class Reader:
    """Turns a text into word and character n-gram hashes; one per task."""

    def __init__(self) -> None:
        self.ranges = Ranges()

    def read(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        start, end = word_bounds(points)
        words = self.ranges.hashes(points, start, end)
        return points, start, end, words

    @staticmethod
    def windows(words: np.ndarray) -> np.ndarray:
        if words.size < 3:
            return words[:0]
        a, b, c = (np.uint64(k) for k in (3, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
        return mixed(words[:-2] * a + words[1:-1] * b + words[2:] * c)

    @staticmethod
    def grams(points: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
        """Buckets of words, word pairs and character n-grams, one array per kind.

        A pair of equal words is one gram of its own, whatever the word, so that
        repetition of unseen words is recognised.
        """
        mask = np.uint64(BUCKETS - 1)
        pairs = mixed(words[:-1] * np.uint64(5) + words[1:] * np.uint64(0x9E3779B97F4A7C15))
        pairs = np.where(words[:-1] == words[1:], np.uint64(77), pairs)
        kinds = [words & mask, pairs & mask]
        wide = points.astype(np.uint64)
        for order in _CHAR_ORDERS:
            n = max(0, wide.size - order + 1)
            packed = np.full(n, order, np.uint64)
            for shift in range(order):
                packed = packed * np.uint64(0x100000001B3) + wide[shift : shift + n]
            kinds.append(mixed(packed) & mask)
        return [k.astype(np.int64) for k in kinds]


@dataclass
class Model:
    """Weights per bucket, one intercept, and the calibration line on the raw score."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, grams: list[np.ndarray]) -> float:
        raw = self.bias + sum(float(self.weights[g].mean()) for g in grams if g.size)
        return float(1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -50, 50))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Spool:
    """(row, bucket, share) of the grams of texts, in a file and read back in chunks.

    Chunks hold whole texts and about ``_CHUNK`` entries each, so what is held at once does
    not grow with the texts.
    """

    def __init__(self) -> None:
        self.file, self.sizes, self.texts = tempfile.TemporaryFile(), [], 0
        self._held: list[np.ndarray] = []

    def add(self, kinds: list[np.ndarray]) -> None:
        for grams in kinds:
            if grams.size:
                unique, seen = np.unique(grams, return_counts=True)
                entries = np.empty(unique.size, _ENTRY)
                entries["row"], entries["bucket"], entries["share"] = self.texts, unique, seen / grams.size
                self._held.append(entries)
        self.texts += 1
        if sum(x.size for x in self._held) >= _CHUNK:
            self._flush()

    def _flush(self) -> None:
        if self._held:
            entries = np.concatenate(self._held)
            self.sizes.append(entries.size)
            for name in _ENTRY.names:
                self.file.write(np.ascontiguousarray(entries[name]).data)
            self._held = []

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        self._flush()
        self.file.seek(0)
        for size in self.sizes:
            kinds = (_ENTRY[name] for name in _ENTRY.names)
            yield tuple(np.frombuffer(self.file.read(size * k.itemsize), k) for k in kinds)

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        out = np.zeros(self.texts)
        for row, bucket, share in self.chunks():
            out[row[0] : row[-1] + 1] += np.bincount(row - row[0], weights[bucket] * share)
        return out + bias


def fit(rows: Iterable[tuple[str, float]]) -> Model | None:
    """Logistic regression on (text, label) by adaptive gradient steps, calibrated on every fifth row.

    The calibration is a logistic line through the held-out scores, with targets drawn
    in from 0 and 1 by the class counts. ``None`` if there are fewer than two classes.
    """
    reader, spool, labels = Reader(), Spool(), []
    for text, label in rows:
        points, _, _, words = reader.read(text)
        spool.add(reader.grams(points, words))
        labels.append(label)
    y = np.array(labels, float)
    n = y.size
    if not n or y.min() == y.max():
        return None  # nothing to tell apart
    held_out = np.arange(n) % 5 == 0
    train = ~held_out
    share = max(1, train.sum())
    weights, bias = np.zeros(BUCKETS), 0.0
    past, past_bias = np.full(BUCKETS, 1e-12), 1e-12
    for _ in range(_STEPS):
        # A text's error needs its own chunk alone: one reading serves score and slope.
        slope = np.zeros(BUCKETS)
        error = np.where(train, _sigmoid(np.full(n, bias)) - y, 0) / share
        for row, bucket, value in spool.chunks():
            first, last = row[0], row[-1] + 1
            score = np.bincount(row - first, weights[bucket] * value) + bias
            error[first:last] = np.where(train[first:last], _sigmoid(score) - y[first:last], 0) / share
            slope += np.bincount(bucket, error[row] * value, BUCKETS)
        slope += _SHRINK * weights
        total = error.sum()
        past += slope**2
        past_bias += total**2
        weights -= _RATE * slope / np.sqrt(past)
        bias -= _RATE * total / np.sqrt(past_bias)
    score = spool.scores(weights, bias)
    use = held_out if 0 < y[held_out].sum() < held_out.sum() else np.ones(n, bool)
    good, bad = y[use].sum(), use.sum() - y[use].sum()
    target = np.where(y[use] > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps on two parameters
        p = _sigmoid(a * score[use] + b)
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        x = score[use]
        haa, hab, hbb = (h * x * x).sum() + 1e-6, (h * x).sum(), h.sum() + 1e-6
        ga, gb = (d * x).sum(), d.sum()
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        step_a, step_b = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - step_a, b - step_b
        if abs(step_a) + abs(step_b) < 1e-9:
            break
    return Model(weights.astype(np.float32), bias, float(a), float(b))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = fit((x["body"], x["label"]) for batch in batches for x in batch.to_pylist())
    if model is None:
        return
    yield pa.RecordBatch.from_pydict(
        {
            "weights": [model.weights.tobytes()],
            "bias": [model.bias],
            "slope": [model.slope],
            "offset": [model.offset],
        }
    )


def train_quality_model(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """Fit on at most ``fit_rows`` labelled documents, all of them read in full.

    A document labelled more than once counts with the mean of its labels, half or more
    being good. Rows without id, text or label are left out. ``None`` if the labels name
    fewer than two classes.
    """
    small_batches(docs)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .withColumn("order", F.xxhash64("__id"))
        .orderBy("order", "__id")
        .limit(fit_rows)
    )
    texts = docs.where("text is not null").select(
        F.col("doc_id").alias("__id"), F.col("text").alias("body")
    )
    # At most `fit_rows` small rows: the broadcast side has a fixed bound.
    sample = texts.join(F.broadcast(chosen), "__id").groupBy("__id", "order", "label").agg(
        F.min("body").alias("body")
    )
    kind = "weights binary, bias double, slope double, offset double"
    # Sorted by Spark, which spills: the fitting task holds a batch of texts at a time.
    one = sample.select("order", "label", "body").coalesce(1).sortWithinPartitions("order", "body")
    row = one.mapInArrow(_train, kind).first()
    if row is None:
        return None
    return Model(
        np.frombuffer(row["weights"], np.float32), row["bias"], row["slope"], row["offset"]
    )


def _score(shared, position: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Model(*shared.value) if shared is not None else None
        reader = Reader()
        for batch in batches:
            out = []
            for text in batch.column(position).to_pylist():
                text = text or ""
                points, start, end, words = reader.read(text)
                base = _base(text, points, start, end, reader.windows(words))
                p = learned.probability(reader.grams(points, words)) if learned else 1.0
                out.append((*base, p))
            columns = list(zip(*out, strict=True)) or [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            arrays.append(pa.array(columns[5], pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names)

    return run


def score_quality(docs: DataFrame, model: Model | None, prefix: str = "") -> DataFrame:
    """Add the base counts, ``base_failed``, ``kept`` and ``probability`` to each row.

    Missing text counts as empty and fails the base rules, as every text of fewer than 50
    words does. Without a model the base rules decide alone. Input columns with the name
    of a result are replaced by it; with ``prefix`` the results are renamed instead.
    """
    small_batches(docs)
    spark = docs.sparkSession
    results = [x.split()[0] for x in SIGNALS] + ["probability"]
    clash = {prefix + x for x in [*results, "base_failed", "kept"]}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in clash])
    kinds = [T.StructField(prefix + x, T.LongType()) for x in results[:5]]
    kinds.append(T.StructField(prefix + "probability", T.DoubleType()))
    schema = T.StructType([*docs.schema.fields, *kinds])
    parts = model and (model.weights, model.bias, model.slope, model.offset)
    shared = spark.sparkContext.broadcast(parts) if parts else None  # of fixed size
    run = _score(shared, docs.columns.index("text"), schema.names)
    scored = docs.mapInArrow(run, schema)
    words, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    failed = (words < MIN_WORDS) | (100 * again > 50 * words)
    good = F.col(f"{prefix}probability") >= MIN_PROBABILITY
    counts = [F.col(f"`{c}`") for c in [*docs.columns, *(prefix + x for x in results[:5])]]
    return scored.select(
        *counts, failed.alias(f"{prefix}base_failed"), (~failed & good).alias(f"{prefix}kept"),
        f"{prefix}probability",
    )


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the model, with their own columns."""
    model = train_quality_model(docs, labels, fit_rows)
    prefix = fresh(docs.columns, "q_")
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    scored = score_quality(docs, model, prefix)
    return scored.where(f"{prefix}kept").select(*[F.col(f"`{c}`") for c in docs.columns])
