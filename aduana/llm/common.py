"""Helpers shared by the operators: scratch tables, byte-level word hashing, Arrow batches in bounded pieces."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aduana.session import shared_folder

#: White space of all contracts: \x20 and \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_REGEX = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once by the numpy kernels, which take about 100 times as much; a longer text is a piece of its own.
PIECE_BYTES = 1 << 18
#: Bytes of rows that a Python worker gets at once, beside a last row of any length.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_U = np.uint64
_R = _U(0x9E3779B97F4A7C15)
_R_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it is not installed, but lies in the same place on every machine."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python workers by `BATCH_BYTES`, unless the session has a bound of its own: a batch is held several times by
    the executor and its workers, and Spark's number of rows bounds no bytes."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filtered_rows(docs: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """The rows that `keep` yields, with all columns, whatever they are called; `keep` finds `text` by name."""
    bounded_batches(docs.sparkSession)
    plain = [c if c in ("doc_id", "text") else f"_column{k}" for k, c in enumerate(docs.columns)]
    renamed = docs.toDF(*plain)
    return renamed.mapInArrow(keep, renamed.schema).toDF(*docs.columns)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaces_trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))


# --- numpy kernels ---------------------------------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher on 64-bit words."""
    h = h ^ (h >> _U(32))
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def _byte_values(lower: bool, seed: int) -> np.ndarray:
    values = mix(np.arange(1 + 256 * seed, 257 + 256 * seed, dtype=np.uint64) * _U(0xA0761D6478BD642F)) | _U(1)
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {(lower, seed): _byte_values(lower, seed) for lower in (False, True) for seed in (0, 1)}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base, or of its inverse, modulo 2**64."""
    key = "inverse" if inverse else "base"
    if key not in _powers or len(_powers[key]) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), _R_INV if inverse else _R, np.uint64)
        steps[0] = 1
        _powers[key] = np.multiply.accumulate(steps)
    return _powers[key][:n]


def prefix_hash(data: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """Prefix sums whose differences, shifted by an inverse power, are polynomial hashes of byte ranges. The two seeds, 0
    and 1, give independent hashes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[lower, seed][data] * powers(len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix((prefix[ends] - prefix[starts]) * powers(int(starts.max()) + 1, True)[starts] + (ends - starts).astype(np.uint64))


def word_ranges(
    data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = ~_IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of consecutive texts, and each text's first word: words of text i are
    first[i]..first[i+1]. `letters` tells which bytes are part of words."""
    letter = letters[data]
    opens, closes = letter.copy(), letter.copy()
    opens[1:] &= ~letter[:-1]
    closes[:-1] &= ~letter[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    opens[heads] = letter[heads]
    closes[tails] = letter[tails]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of whole texts of about `limit` bytes: first row, last row + 1, bytes, offsets into
    the bytes. A null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("" if pa.types.is_large_string(texts.type) else b"")
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and each text's first word."""
    starts, ends, first = word_ranges(data, offsets)
    return range_hash(prefix_hash(data, lower, seed), starts, ends), first


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word runs that start at each word but the last n - 1."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = total * _R + words[k:len(words) - n + 1 + k]
    return mix(total)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit words as the signed integers Spark has."""
    return np.ascontiguousarray(values).view(np.int64)
