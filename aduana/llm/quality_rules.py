"""Quality rules: fixed counts, then a calibrated n-gram classifier.

Counts of a text: words, code points in words, symbols, repeated lines, words in repeated three-word windows. A text that
breaks a count rule is rejected. The others are judged by a logistic regression on hashed words, word pairs and character
n-grams, trained on labelled rows and calibrated on rows it was not trained on; a text is kept at a probability of
`KEEP_AT` or more that its label is 1.

The classifier is fitted on a bounded sample: the `TRAIN_ROWS` labelled rows whose doc_id has the lowest hash. The sample
is collected into one task, which holds of each row the features that occur and makes `_BLOCK_ROWS` rows dense at a time.
Everything else covers all rows, in Arrow batches, and whole texts.

Cases: a null text has no words; repeated rows are judged alike; null labels do not train; without labels of both
values the count rules alone decide; an empty table gives no rows. `quality_verdicts` ignores columns other than doc_id
and text; `keep_good` returns the rows as they are, whatever their columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aduana.llm.common import bounded_batches, filtered_rows, mix, pieces, prefix_hash, range_hash, word_ranges

#: Labelled rows that train the classifier at most.
TRAIN_ROWS = 6000
KEEP_AT = 0.5
MIN_WORDS = 50
#: Hashed features: the first half for words and word pairs, the second for runs of three and four bytes.
FEATURES = 1 << 13
_HALF = FEATURES // 2
_FOLDS = 3
_MARGIN_ROWS = 256
#: Rows of features that are dense at a time while the classifier is fitted: an array that stays in a core's cache.
_BLOCK_ROWS = 64
_U = np.uint64
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of flags between consecutive bounds."""
    return np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[bounds])


def piece_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The `COUNTS` of consecutive texts, one row per text."""
    n = len(offsets) - 1
    starts, ends, first = word_ranges(data, offsets)
    prefix = prefix_hash(data)
    code_points = np.append(0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64))
    words = np.diff(first)
    chars = np.diff(np.append(0, np.cumsum(code_points[ends] - code_points[starts]))[first])
    # Lines with a word that equal an earlier line of their text.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    owner = np.searchsorted(offsets, line_starts, "right") - 1
    line_ends = np.append(line_starts[1:], len(data))[:len(line_starts)]
    line_ends = line_ends - ((line_ends > line_starts) & (data[np.maximum(line_ends - 1, 0)] == 10))
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    hashes = mix(range_hash(prefix, line_starts[has_word], line_ends[has_word]) ^ mix(owner[has_word].astype(np.uint64)))
    _, kept = np.unique(hashes, return_index=True)
    lines = owner[has_word]
    dup_lines = np.bincount(lines, minlength=n) - np.bincount(lines[kept], minlength=n)
    # Words in three-word windows that occur twice in their text.
    hashed = range_hash(prefix, starts, ends)
    text_of = np.repeat(np.arange(n), words)
    covered = np.zeros(len(hashed), bool)
    if len(hashed) >= 3:
        inside = np.flatnonzero(text_of[2:] == text_of[:-2])
        windows = mix(mix(mix(hashed[inside]) + hashed[inside + 1]) + hashed[inside + 2])
        windows = mix(windows ^ mix(text_of[inside].astype(np.uint64) + _U(7)))
        _, inverse, times = np.unique(windows, return_inverse=True, return_counts=True)
        again = inside[times[inverse] > 1]
        for k in range(3):
            covered[again + k] = True
    return np.stack([words, chars, _sums(_SYMBOL[data], offsets), dup_lines, _sums(covered, first)], 1)


def piece_features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the hashed features that occur, and their weights: square roots of shares, half of the mass for
    words and half for characters, so that texts of any length have norm 1."""
    starts, ends, first = word_ranges(data, offsets)
    hashed = range_hash(prefix_hash(data, lower=True), starts, ends)
    word_bins = (hashed % _U(_HALF)).astype(np.int64)
    pair_bins = (mix(hashed[:-1] * _U(3) + hashed[1:]) % _U(_HALF)).astype(np.int64)
    wide = data.astype(np.uint32)
    three = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    four = three[:-1] | wide[3:] << np.uint32(24)
    three_bins, four_bins = (_HALF + ((x * np.uint32(m)) >> np.uint32(20)).astype(np.int64)
                             for x, m in ((three, 0x9E3779B1), (four, 0x85EBCA77)))
    for i in range(len(offsets) - 1):
        a, b, w, v = offsets[i], offsets[i + 1], first[i], first[i + 1]
        bins = np.concatenate([
            word_bins[w:v], pair_bins[w:max(w, v - 1)], three_bins[a:max(a, b - 2)], four_bins[a:max(a, b - 3)]])
        counts = np.bincount(bins, minlength=FEATURES)
        used = np.flatnonzero(counts)
        mass = counts[used].astype(np.float64)
        word_mass = used < _HALF
        for part in (word_mass, ~word_mass):
            if total := mass[part].sum():
                mass[part] /= 2 * total
        yield used, np.sqrt(mass)


def _train_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bins, weights = [], []
        for _, _, data, offsets in pieces(batch["text"]):
            for used, mass in piece_features(data, offsets):
                bins.append(used.astype(np.uint16).tobytes())
                weights.append(mass.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["label"], pa.array(bins, pa.binary()), pa.array(weights, pa.binary())],
            ["doc_id", "label", "bins", "weights"])


class FeatureRows:
    """Rows of features: the bins that occur and their weights, as they came, made dense some rows at a time."""

    def __init__(self, bins: list[np.ndarray], weights: list[np.ndarray]):
        self.bins, self.weights = bins, weights

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Consecutive rows as a dense array, which the next block overwrites."""
        block = np.zeros((_BLOCK_ROWS, FEATURES), np.float32)
        for k in range(0, len(self.bins), _BLOCK_ROWS):
            own = self.bins[k:k + _BLOCK_ROWS]
            place = np.concatenate(own).astype(np.intp)
            place += np.repeat(np.arange(len(own)) * FEATURES, [len(b) for b in own])
            block.ravel()[place] = np.concatenate(self.weights[k:k + _BLOCK_ROWS])
            yield slice(k, k + len(own)), block[:len(own)]
            block.fill(0)


def fit_logistic(
    rows: FeatureRows, labels: np.ndarray, members: np.ndarray, steps: int = 150, decay: float = 1e-4
) -> np.ndarray:
    """Weights and, last, the intercept of one model per column of `members`, which marks the rows that train it. All models
    take their accelerated gradient steps together. Rows have norm 1, which bounds the curvature."""
    at = before = np.zeros((FEATURES + 1, members.shape[1]), np.float32)
    counts, rate = members.sum(0), 1 / (0.5 + decay)
    share = (members / counts).astype(np.float32)
    for t in range(steps):
        ahead = at + np.float32(t / (t + 3)) * (at - before)
        step = np.float32(decay) * ahead
        step[-1] = 0
        for own, block in rows.blocks():
            margin = block @ ahead[:-1] + ahead[-1]
            error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[own, None]).astype(np.float32) * share[own]
            step[:-1] += block.T @ error
            step[-1] += error.sum(0)
        before, at = at, ahead - np.float32(rate) * step
    return at.astype(np.float64)


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn margins into probabilities, by Newton steps; targets are drawn in a little so that
    separable margins give finite values."""
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        error, curve = p - target, p * (1 - p) + 1e-9
        gradient = np.array([(error * margins).sum() + 1e-6 * slope, error.sum()])
        hessian = np.array([[(curve * margins * margins).sum() + 1e-6, (curve * margins).sum()],
                            [(curve * margins).sum(), curve.sum() + 1e-6]])
        change = np.linalg.solve(hessian, gradient)
        change /= max(1.0, np.abs(change).max() / 5)
        slope, shift = slope - change[0], shift - change[1]
    return float(slope), float(shift)


def _own_margins(features: np.ndarray, fitted: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Margin of each row under the model of its fold, in double precision: some rows at a time, as a product with doubles
    makes a copy of its rows in doubles."""
    margins = np.empty(len(features))
    for k in range(0, len(features), _MARGIN_ROWS):
        own = fold[k:k + _MARGIN_ROWS]
        block = features[k:k + _MARGIN_ROWS] @ fitted[:-1] + fitted[-1]
        margins[k:k + _MARGIN_ROWS] = block[np.arange(len(own)), own]
    return margins


def _fit(rows: pa.Table) -> pa.Table:
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    labels = rows["label"].to_numpy()[order].astype(np.float64)
    model: bytes | None = None
    if 0 < labels.sum() < len(labels):
        features = FeatureRows(*([np.frombuffer(rows[name][k].as_buffer(), kind) for k in order.tolist()]
                                 for name, kind in (("bins", np.uint16), ("weights", np.float32))))
        # One model per fold, trained on the other folds, and the model of all rows.
        fold = np.arange(len(labels)) % _FOLDS
        members = np.stack([*(fold != k for k in range(_FOLDS)), np.ones(len(labels), bool)], 1)
        if len(labels) < 2 * _FOLDS:
            members[:] = True
        fitted = fit_logistic(features, labels, members)
        margins = np.concatenate([_own_margins(block, fitted, fold[own]) for own, block in features.blocks()])
        slope, shift = fit_sigmoid(margins, labels)
        model = np.append(slope * fitted[:, -1], shift).tobytes()
    return pa.table({"model": pa.array([model], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray | None:
    """Calibrated weights: features, intercept, shift; None without labels of both values."""
    bounded_batches(docs.sparkSession)
    sample = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_rows)
    # At most `train_rows` rows of two numbers: safe to broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(sample), "doc_id")
    # One text of each label, so that repeated rows do not add up in the task that fits.
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    features = rows.mapInArrow(_train_features, "doc_id long, label int, bins binary, weights binary")
    fitted = features.groupBy().applyInArrow(_fit, "model binary").first()
    return None if fitted is None or fitted["model"] is None else np.frombuffer(fitted["model"])


def judged(texts: pa.Array, model: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, base verdicts, probabilities and final verdicts of texts."""
    counts, chances = [np.zeros((0, len(COUNTS)), np.int64)], []
    for _, _, data, offsets in pieces(texts):
        counts.append(piece_counts(data, offsets))
        if model is None:
            chances += [1.0] * (len(offsets) - 1)
        else:
            margins = np.array([mass @ model[used] for used, mass in piece_features(data, offsets)])
            chances += list(1 / (1 + np.exp(-np.clip(margins + model[-2] + model[-1], -50, 50))))
    table, chance = np.concatenate(counts), np.array(chances, np.float64)
    failed = (table[:, 0] < MIN_WORDS) | (100 * table[:, 4] > 50 * table[:, 0])
    return table, failed, chance, ~failed & (chance >= KEEP_AT)


def quality_verdicts(docs: DataFrame, model: np.ndarray | None) -> DataFrame:
    """Per row of `docs`: doc_id, the counts, base_failed, probability, kept."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, failed, chance, kept = judged(batch["text"], model)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c) for c in table.T), pa.array(failed), pa.array(chance), pa.array(kept)],
                ["doc_id", *COUNTS, "base_failed", "probability", "kept"])

    bounded_batches(docs.sparkSession)
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, f"doc_id long, {counts}, base_failed boolean, probability double, kept boolean")


def keep_good(docs: DataFrame, model: np.ndarray | None) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judged(batch["text"], model)[3]))

    return filtered_rows(docs, keep)
