"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of each whole text (lengths, character classes, repetition, line shape; no label, language, source or id) are
standardised by their mean and deviation over all documents. Random cosine features approximate a Gaussian kernel on
them. The normal equations are summed per partition and fold, then in two levels of groups, so a sum of fixed size is all
that leaves a task; the ridge solution is exact for all labelled rows, with no sample. Scores of either half of the
labelled rows by the model of the other half are counted in narrow bins, and pool-adjacent-violators on the bins gives
the monotone map from ridge score to probability.

Cases: null and empty texts have statistics of their own and get a score like any other; a null doc_id has no label and
is not held out; repeated rows get equal scores; null labels do not train; without training rows every score is 0.5; an
empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from aduana.llm.common import mix, pieces, prefix_hash, range_hash, word_ranges, written
from aduana.llm.quality_rules import piece_counts

STATISTICS = (
    "log_bytes", "log_words", "word_chars", "word_spread", "upper", "lower", "digits", "symbols", "stops", "marks", "bars",
    "spaces", "wide", "distinct", "repeated", "dup_lines", "line_words", "top_word", "entropy", "ends_mark", "starts_upper",
    "twice", "short_words", "full_upper",
)
FOURIER = 256
RIDGE = 1e-3
#: Bins of ridge scores for the calibration, over [-0.5, 1.5].
BINS = 1000
PASS_AT = 0.7
_SEED = 20240
_U = np.uint64
_CLASSES = {
    "upper": (range(65, 91),), "lower": (range(97, 123),), "digits": (range(48, 58),), "symbols": (b"#*$%&|<>@^~=+_\\/{}[]",),
    "stops": (b".,;:",), "marks": (b"!?",), "bars": (b"|",), "spaces": (b" \t\n\r\x0b\x0c",), "wide": (range(0xC0, 256),),
}
_TABLES = {name: np.isin(np.arange(256), [b for part in parts for b in part]) for name, parts in _CLASSES.items()}


def _shares(flags: np.ndarray, bounds: np.ndarray, of: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags, dtype=np.float64))[bounds]) / np.maximum(of, 1)


def piece_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """`STATISTICS` of consecutive texts, one row per text."""
    n = len(offsets) - 1
    starts, ends, first = word_ranges(data, offsets)
    counts = piece_counts(data, offsets).astype(np.float64)
    n_bytes, n_words = np.diff(offsets).astype(np.float64), counts[:, 0]
    hashed = range_hash(prefix_hash(data, lower=True), starts, ends)
    text_of = np.repeat(np.arange(n), np.diff(first))
    length = (ends - starts).astype(np.float64)
    mean = _shares(length, first, n_words)
    spread = np.sqrt(np.maximum(_shares(length ** 2, first, n_words) - mean ** 2, 0))
    share = {name: _shares(flags[data], offsets, n_bytes) for name, flags in _TABLES.items()}
    # Frequencies of words within their text.
    _, kept, times = np.unique(mix(hashed ^ mix(text_of.astype(np.uint64))), return_index=True, return_counts=True)
    distinct = np.bincount(text_of[kept], minlength=n) / np.maximum(n_words, 1)
    top = np.zeros(n)
    np.maximum.at(top, text_of[kept], times)
    lines = _shares(data == 10, offsets, np.ones(n)) + 1
    ends_mark = ~(_TABLES["upper"] | _TABLES["lower"] | _TABLES["digits"])[data[ends - 1]] & (data[ends - 1] < 128)
    twice = np.zeros(len(hashed), bool)
    twice[1:] = (hashed[1:] == hashed[:-1]) & (text_of[1:] == text_of[:-1])
    uppers = np.append(0, np.cumsum(_TABLES["upper"][data], dtype=np.int64))
    full_upper = (uppers[ends] - uppers[starts]) * 2 > length
    entropy = np.zeros(n)
    for i in range(n):
        p = np.bincount(data[offsets[i]:offsets[i + 1]], minlength=256) / max(n_bytes[i], 1)
        p = p[p > 0]
        entropy[i] = -(p * np.log2(p)).sum()
    columns = {
        "log_bytes": np.log1p(n_bytes), "log_words": np.log1p(n_words), "word_chars": np.log1p(mean), "word_spread": np.log1p(spread),
        **{name: np.sqrt(value) for name, value in share.items()},
        "distinct": distinct, "repeated": counts[:, 4] / np.maximum(n_words, 1), "dup_lines": counts[:, 3] / lines,
        "line_words": np.log1p(n_words / lines), "top_word": top / np.maximum(n_words, 1), "entropy": entropy,
        "ends_mark": _shares(ends_mark, first, n_words), "starts_upper": _shares(_TABLES["upper"][data[starts]], first, n_words),
        "twice": _shares(twice, first, n_words), "short_words": _shares(length <= 2, first, n_words),
        "full_upper": _shares(full_upper, first, n_words),
    }
    return np.stack([columns[name] for name in STATISTICS], 1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and `STATISTICS` per row."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.concatenate([np.zeros((0, len(STATISTICS)))] + [piece_statistics(d, o) for _, _, d, o in pieces(batch["text"])])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c) for c in table.T)], ["doc_id", *STATISTICS])

    schema = ", ".join(["doc_id long", *(f"{c} double" for c in STATISTICS)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(describe, schema)


class Model(NamedTuple):
    """Everything a score needs: a few hundred kilobytes at most."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray


def _fourier(table: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Cosine features of a Gaussian kernel whose width is the typical distance of standardised rows, and a constant."""
    rng = np.random.default_rng(_SEED)
    directions = rng.normal(size=(len(STATISTICS), FOURIER)) / np.sqrt(len(STATISTICS) / 2)
    phases = rng.uniform(0, 2 * np.pi, FOURIER)
    standard = np.clip((table - center) / scale, -6, 6)
    features = np.sqrt(2 / FOURIER) * np.cos(standard @ directions + phases)
    return np.concatenate([features, np.ones((len(table), 1))], 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch[c].to_numpy(zero_copy_only=False) for c in STATISTICS], 1) if batch.num_rows else np.zeros((0, len(STATISTICS)))


def normal_equations(rows: DataFrame, center: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold the matrix [X'X | X'y], from rows with `STATISTICS`, fold and label."""
    size = FOURIER + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size, size + 1))
        for batch in batches:
            x, y, fold = _fourier(_matrix(batch), center, scale), batch["label"].to_numpy(), batch["fold"].to_numpy()
            for k in range(2):
                own = x[fold == k]
                sums[k] += own.T @ np.concatenate([own, y[fold == k][:, None]], 1)
        # The same part if the task is repeated.
        part = TaskContext.get().partitionId() % 16
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * 2, pa.int32()), pa.array([0, 1], pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())],
            ["part", "fold", "sums"])

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in group["sums"])
        return pa.table({"part": pa.array([0], pa.int32()), "fold": group["fold"][:1].combine_chunks(), "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "part int, fold int, sums binary"
    sums = rows.mapInArrow(partial, kind).groupBy("part", "fold").applyInArrow(added, kind).groupBy("fold").applyInArrow(added, kind)
    found = {row["fold"]: np.frombuffer(row["sums"]).reshape(size, size + 1) for row in sums.collect()}
    return {k: found.get(k, np.zeros((size, size + 1))) for k in range(2)}


def ridge(sums: np.ndarray) -> np.ndarray:
    size = len(sums)
    penalty = RIDGE * max(sums[-1, -2], 1) * np.eye(size)
    penalty[-1, -1] = 1e-9
    return np.linalg.solve(sums[:, :size] + penalty, sums[:, size])


def isotonic(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Non-decreasing means that fit totals / counts best, by pooling neighbours that violate the order."""
    blocks: list[list[float]] = []
    for n, s in zip(counts, totals, strict=True):
        blocks.append([float(n), float(s), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n_last, s_last, k = blocks.pop()
            blocks[-1][0] += n_last
            blocks[-1][1] += s_last
            blocks[-1][2] += k
    return np.repeat([s / n for n, s, _ in blocks], [k for _, _, k in blocks])


def held_out(doc_id: Column, modulus: int = 4) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == 2


def train(statistics: DataFrame, labels: DataFrame) -> Model | None:
    """Model from `document_statistics` and all labelled rows that are not held out."""
    moments = statistics.agg(*(F.avg(c).alias(f"m_{c}") for c in STATISTICS), *(F.stddev_pop(c).alias(f"s_{c}") for c in STATISTICS)).first()
    if moments[0] is None:
        return None
    center = np.array([moments[f"m_{c}"] for c in STATISTICS])
    scale = np.array([moments[f"s_{c}"] for c in STATISTICS])
    scale = np.where(scale > 1e-9, scale, 1.0)
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    rows = statistics.where(~held_out(F.col("doc_id"))).join(known, "doc_id")
    rows = written(rows.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")), "labelled-statistics")
    sums = normal_equations(rows, center, scale)
    if sums[0][-1, -2] + sums[1][-1, -2] == 0:
        return None
    crossed = [ridge(sums[1 - k]) for k in range(2)]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = _fourier(_matrix(batch), center, scale), batch["fold"].to_numpy()
            scores = np.where(fold == 0, x @ crossed[0], x @ crossed[1])
            yield pa.RecordBatch.from_arrays([pa.array(_bin(scores)), batch["label"]], ["bin", "label"])

    table = rows.mapInArrow(binned, "bin int, label double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("s")).orderBy("bin").collect()
    counts, totals = np.array([r["n"] for r in table], float), np.array([r["s"] for r in table], float)
    steps = (np.array([r["bin"] for r in table]) + 0.5) * 2 / BINS - 0.5
    return Model(center, scale, ridge(sums[0] + sums[1]), steps, isotonic(counts, totals))


def _bin(scores: np.ndarray) -> np.ndarray:
    return np.clip((scores + 0.5) * BINS / 2, 0, BINS - 1).astype(np.int32)


def scored(statistics: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted per row."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                chance = np.full(batch.num_rows, 0.5)
            else:
                chance = np.interp(_fourier(_matrix(batch), model.center, model.scale) @ model.weights, model.steps, model.values)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(chance)], ["doc_id", "score"])

    rows = statistics.mapInArrow(score, "doc_id long, score double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PASS_AT).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    statistics = written(document_statistics(docs), "statistics")
    return scored(statistics, train(statistics, labels))
