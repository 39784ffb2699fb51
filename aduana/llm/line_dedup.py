"""Line dedup with sharded cuckoo filters backed by exact reference counts.

The exact tables are the truth: `postings` (which document holds which line key, and where) and `counts` (documents per
key, and the largest doc_id among them). One cuckoo filter per shard holds the fingerprints of the *crowded* keys, those
in at least `min_docs` documents. Inserting documents raises counts and adds the keys that become crowded to the
filters; deleting documents lowers counts and takes the keys that fall below the threshold out again, which a Bloom
filter could not do. Deduplication asks the filters first; what they let through is looked up in the exact counts, so a
false positive costs a lookup and never a line.

With as many shards as `shards_for` gives, a shard's filter and keys stay bounded however large the corpus is.

A line's key is a 128-bit digest of the line, stripped of white space and with A-Z lower-cased. A common line is one row
per map task in the shuffle that counts it; the join that marks lines is one that adaptive execution splits.

Cases: a null or empty text is one empty line; a null doc_id counts as one document and is never the keeper beside
others; rows that repeat a doc_id count once per key, and each row is returned; an empty table gives no rows; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import ascii_lower, mix, spaces_trimmed, written

SLOTS = 4
#: Keys of one probing group: bounds the memory of a task, whatever the number of keys of a shard.
PROBE_KEYS = 250_000
_U = np.uint64


class LineIndex(NamedTuple):
    """counts: key, n_docs, keeper. postings: key, doc_id. filters: shard, n_keys, slots, overflow."""

    counts: DataFrame
    postings: DataFrame
    filters: DataFrame
    min_docs: int
    min_chars: int
    n_shards: int


def empty_index(spark: SparkSession, min_docs: int = 3, min_chars: int = 20, n_shards: int = 64) -> LineIndex:
    return LineIndex(
        spark.createDataFrame([], "key binary, n_docs long, keeper long"),
        spark.createDataFrame([], "key binary, doc_id long"),
        spark.createDataFrame([], "shard int, n_keys long, slots binary, overflow binary"),
        min_docs, min_chars, n_shards,
    )


def shards_for(lines: DataFrame) -> int:
    """Shards with which the filter and the keys of a shard are bounded, for an index of about these lines."""
    return 64 + lines.count() // PROBE_KEYS


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Every line long enough to have a key: doc_id, row_hash (tells rows with one doc_id apart), pos, key."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("row_hash"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    ).withColumn("line", spaces_trimmed(F.col("line"))).where(F.char_length("line") >= min_chars)
    digest = F.unhex(F.substring(F.sha2(ascii_lower(F.col("line")), 256), 1, 32))
    return lines.select("doc_id", "row_hash", "pos", digest.alias("key"))


def insert_documents(index: LineIndex, docs: DataFrame, lines: DataFrame | None = None) -> LineIndex:
    """Index with the lines of `docs` added. `lines` may hold their `keyed_lines`, already computed."""
    lines = keyed_lines(docs, index.min_chars) if lines is None else lines
    known = index.postings.select("key", "doc_id", F.lit(1).alias("old"))
    pairs = lines.select("key", "doc_id", F.lit(0).alias("old")).unionByName(known)
    pairs = pairs.groupBy("key", "doc_id").agg(F.max("old").alias("old"))
    counted = written(
        pairs.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"), F.sum("old").alias("n_before")),
        "line-counts",
    )
    up = counted.where(f"n_docs >= {index.min_docs} AND n_before < {index.min_docs}").select("key", F.lit(1).alias("op"))
    return index._replace(
        counts=counted.select("key", "n_docs", "keeper"),
        postings=pairs.select("key", "doc_id"),
        filters=_updated_filters(index, up),
    )


def delete_documents(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """Index as if the documents had never been inserted. Keys they do not hold are neither counted nor moved."""
    gone = doc_ids.select(F.col("doc_id").cast("long").alias("gone_id"), F.lit(True).alias("gone")).distinct()
    marked = index.postings.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
    marked = written(marked.select("key", "doc_id", F.coalesce("gone", F.lit(False)).alias("gone")), "line-marked")
    touched = marked.where("gone").select("key").distinct()
    recounted = marked.join(touched, "key", "left_semi").groupBy("key").agg(
        F.count_if(~F.col("gone")).alias("n_docs"), F.max(F.when(~F.col("gone"), F.col("doc_id"))).alias("keeper"))
    recounted = written(recounted, "line-recounted")
    before = index.counts.where(f"n_docs >= {index.min_docs}").select("key")
    down = recounted.where(f"n_docs < {index.min_docs}").join(before, "key", "left_semi")
    counts = index.counts.join(recounted.select("key"), "key", "left_anti").unionByName(recounted.where("n_docs > 0"))
    return index._replace(
        counts=written(counts, "line-counts"),
        postings=marked.where(~F.col("gone")).select("key", "doc_id"),
        filters=_updated_filters(index, down.select("key", F.lit(-1).alias("op"))),
    )


def dropped_lines(index: LineIndex, lines: DataFrame) -> DataFrame:
    """Of `keyed_lines`, those that dedup drops, as sorted positions per row: doc_id, row_hash, dropped."""
    # One row per distinct key, combined before the shuffle, then the filter of its shard.
    maybe = _probed(index, lines.groupBy("key").agg(F.lit(1).alias("one")).select("key"))
    crowded = index.counts.where(f"n_docs >= {index.min_docs}").join(maybe, "key", "left_semi").select("key", "keeper")
    hits = lines.join(written(crowded, "line-crowded"), "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return hits.groupBy("doc_id", "row_hash").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def dedup_lines(index: LineIndex, docs: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Per row of `docs`: doc_id, kept text, n_lines, n_dropped, kept_sha256."""
    lines = keyed_lines(docs, index.min_chars) if lines is None else lines
    drops = dropped_lines(index, lines).withColumnsRenamed({"doc_id": "drop_id", "row_hash": "drop_hash"})
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64("doc_id", text).alias("row_hash"))
    rows = rows.join(
        drops, (F.col("row_hash") == F.col("drop_hash")) & F.col("doc_id").eqNullSafe(F.col("drop_id")), "left")
    return rows.select("doc_id", "text", "dropped").mapInArrow(
        _without_dropped, "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string")


def _without_dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, totals, dropped, digests = [], [], [], []
        for text, drop in zip(batch["text"].to_pylist(), batch["dropped"].to_pylist(), strict=True):
            lines = text.split("\n")
            totals.append(len(lines))
            dropped.append(len(drop or ()))
            if drop:
                out = set(drop)
                text = "\n".join(x for k, x in enumerate(lines) if k not in out)
            texts.append(text)
            digests.append(hashlib.sha256(text.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64()),
             pa.array(digests, pa.string())],
            ["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"])


# --- filters ---------------------------------------------------------------------------------------------------------


def _shard(index: LineIndex):
    return F.pmod(F.xxhash64("key"), F.lit(index.n_shards)).cast("int").alias("shard")


def _hashes(keys: pa.ChunkedArray) -> np.ndarray:
    """The first 8 bytes of each 16-byte key: the key is a digest already."""
    flat = b"".join(keys.to_pylist())
    return np.frombuffer(flat, np.uint64)[::2].copy() if flat else np.zeros(0, np.uint64)


def _places(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and fingerprint (never 0) of each key."""
    return (hashes & _U(n_buckets - 1)).astype(np.int64), ((hashes >> _U(48)) % _U(65535) + _U(1)).astype(np.uint16)


def _other(bucket: np.ndarray, prints: np.ndarray, n_buckets: int) -> np.ndarray:
    return bucket ^ (mix(prints.astype(np.uint64)) & _U(n_buckets - 1)).astype(np.int64)


def cuckoo_insert(table: np.ndarray, overflow: np.ndarray, hashes: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Insert keys into `table` (buckets x SLOTS) in place; returns the new overflow, which holds what found no place."""
    n = len(table)
    bucket, prints = _places(hashes, n)
    rng = np.random.default_rng(len(hashes))
    for _ in range(rounds):
        for attempt in range(2):
            for slot in range(SLOTS):
                if not len(bucket):
                    return overflow
                free = np.flatnonzero(table[bucket, slot] == 0)
                _, first = np.unique(bucket[free], return_index=True)
                placed = free[first]
                table[bucket[placed], slot] = prints[placed]
                keep = np.ones(len(bucket), bool)
                keep[placed] = False
                bucket, prints = bucket[keep], prints[keep]
            if attempt == 0:
                bucket = _other(bucket, prints, n)
        # Both buckets are full: one key per bucket throws out a tenant, which goes on to its other bucket.
        _, chosen = np.unique(bucket, return_index=True)
        slot = rng.integers(0, SLOTS, len(chosen))
        thrown = table[bucket[chosen], slot].copy()
        table[bucket[chosen], slot] = prints[chosen]
        prints[chosen] = thrown
        bucket[chosen] = _other(bucket[chosen], thrown, n)
    return np.concatenate([overflow, (bucket.astype(np.uint64) << _U(16)) | prints])


def cuckoo_delete(table: np.ndarray, overflow: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Take out one fingerprint for each key. Only keys that were inserted may be deleted."""
    n = len(table)
    bucket, prints = _places(hashes, n)
    for candidate in (bucket, _other(bucket, prints, n)):
        for slot in range(SLOTS):
            # A slot serves one key only, should two keys share bucket and fingerprint.
            hit = np.flatnonzero((table[candidate, slot] == prints) & (prints > 0))
            _, first = np.unique(candidate[hit], return_index=True)
            done = hit[first]
            table[candidate[done], slot] = 0
            prints[done] = 0
    left = np.flatnonzero(prints)
    for b, o, p in zip(bucket[left], _other(bucket, prints, n)[left], prints[left], strict=True):
        at = np.flatnonzero(((overflow >> _U(16) == b) | (overflow >> _U(16) == o)) & (overflow & _U(0xFFFF) == p))
        overflow = np.delete(overflow, at[:1])
    return overflow


def cuckoo_contains(table: np.ndarray, overflow: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    n = len(table)
    bucket, prints = _places(hashes, n)
    other = _other(bucket, prints, n)
    found = (table[bucket] == prints[:, None]).any(1) | (table[other] == prints[:, None]).any(1)
    if len(overflow):
        found |= np.isin((bucket.astype(np.uint64) << _U(16)) | prints, overflow)
        found |= np.isin((other.astype(np.uint64) << _U(16)) | prints, overflow)
    return found


def _updated_filters(index: LineIndex, changes: DataFrame) -> DataFrame:
    """Filters after `changes` (key, op: 1 into, -1 out of). A shard whose filter gets too full is built anew, twice as
    large, from the exact counts."""
    changes = changes.select(_shard(index), "key", "op")
    crowded = index.counts.where(f"n_docs >= {index.min_docs}").select(_shard(index), "key", F.lit(0).alias("op"))
    planned = changes.groupBy("shard").agg(F.sum("op").alias("change"))
    full = index.filters.join(planned, "shard").where(
        F.col("n_keys") + F.col("change") > 0.8 * F.length("slots") / 2).select("shard")
    rows = changes.unionByName(crowded.join(full, "shard", "left_semi"))
    updated = rows.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(
        _update_shard, "shard int, n_keys long, slots binary, overflow binary")
    return written(updated, "line-filters")


def _update_shard(rows: pa.Table, old: pa.Table) -> pa.Table:
    if not rows.num_rows:
        return old
    hashes, op = _hashes(rows["key"]), rows["op"].to_numpy()
    if old.num_rows and not (op == 0).any():
        table = np.frombuffer(old["slots"][0].as_py(), np.uint16).reshape(-1, SLOTS).copy()
        overflow, n_keys = np.frombuffer(old["overflow"][0].as_py(), np.uint64), old["n_keys"][0].as_py()
        added = hashes[op == 1]
    else:  # a new shard, or one that is built anew from all its keys
        added, n_keys = hashes[op >= 0], 0
        table = np.zeros((1 << max(4, int(len(added) / (SLOTS * 0.4)).bit_length()), SLOTS), np.uint16)
        overflow = np.zeros(0, np.uint64)
    overflow = cuckoo_insert(table, overflow, added)
    overflow = cuckoo_delete(table, overflow, hashes[op == -1])
    n_keys += len(added) - int((op == -1).sum())
    return pa.table({
        "shard": pa.array([rows["shard"][0].as_py()], pa.int32()), "n_keys": pa.array([n_keys], pa.int64()),
        "slots": pa.array([table.tobytes()], pa.binary()), "overflow": pa.array([overflow.tobytes()], pa.binary())})


def _probed(index: LineIndex, keys: DataFrame) -> DataFrame:
    """Of distinct keys, those that the filters may hold. A group is a slice of a shard's keys with the shard's filter."""
    keys = written(keys, "line-keys")
    slices = keys.count() // (index.n_shards * PROBE_KEYS) + 1
    part = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(slices)).cast("int").alias("slice")
    filters = index.filters.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(int(slices) - 1))))
    return keys.select(_shard(index), part, "key").groupBy("shard", "slice").cogroup(
        filters.groupBy("shard", "slice")).applyInArrow(_probe_shard, "key binary")


def _probe_shard(keys: pa.Table, filters: pa.Table) -> pa.Table:
    if not keys.num_rows or not filters.num_rows:
        return pa.table({"key": pa.array([], pa.binary())})
    table = np.frombuffer(filters["slots"][0].as_py(), np.uint16).reshape(-1, SLOTS)
    found = cuckoo_contains(table, np.frombuffer(filters["overflow"][0].as_py(), np.uint64), _hashes(keys["key"]))
    return pa.table({"key": keys["key"].combine_chunks().filter(pa.array(found))})
