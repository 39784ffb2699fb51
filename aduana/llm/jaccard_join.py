"""N-gram Jaccard join by parity sketches.

A document is its set of word shingles. Every shingle flips one bit of a sketch, so the sketches of two sets differ in at
most as many bits as the sets have shingles not in common. At a Jaccard similarity of p percent, sets of sizes s and t
differ in at most d = (100 - p)(s + t) / (100 + p) shingles. Hence the sketch is cut into more than d blocks: at least one
block per allowed difference remains untouched (pigeonhole), and documents that link share such a block.

* Size bands. Sizes are cut into bands of ratio `BAND_RATIO`; all documents of a band use the same number of blocks. A
  document whose larger partners reach into the next band takes part there, too.
* A block is as wide as the hash: it is held as the XOR of one codeword for each bit flipped, a linear fingerprint of it.
* With m blocks and d differences, m - d blocks stay the same. Blocks are ranked by the number of their shingles, a rank
  that equal blocks share; the highest-ranked of the unchanged blocks is among the d + 1 highest of both documents. So
  each document only sends its d + 1 fullest blocks, the ones least likely to agree by chance.
* Documents with the same set are one class. In a bucket (documents that share a block), members are compared with one
  hub: first within a task's batch, then the hubs of the batches among each other, so that a bucket with a third of
  all documents sends a row per batch to the shuffle, and never all pairs. A member is first verified with the hub it
  shares most blocks with, then with its other hubs where components still differ. Buckets that hold different components
  even then compare one member of each with one of the largest. Only then are members of different components compared with
  each other, each pair in one bucket.
* A pair is first tested by size and by a 512-bit parity sketch, both lower bounds, then verified on the hashed sets.

Hashes have 64 bits (sets 128). Cases: without words or with a null text the set is empty, and the document links with
nothing; with fewer words than a shingle has, the whole sequence is the only shingle; repeated rows and rows with one
doc_id are documents of their own; null doc_ids are ignored by the minimum (the component of documents without ids has a
null id); an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from aduana.llm.common import bounded_batches, mix, pieces, shingle_hashes, signed, word_hashes, written
from aduana.llm.components import connected_components

BAND_RATIO = 3
#: Blocks of a band for each block that must remain unchanged.
SLACK = 1.25
SKETCH_BITS = 512
SKETCH = tuple(f"sketch{k}" for k in range(SKETCH_BITS // 64))
#: Least keys of a class by which repeated pairs are left out.
FIRSTS = 8
#: Block rows that a task combines at a time.
COMBINED_ROWS = 500_000
_U = np.uint64


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first_row, last_row, data, offsets in pieces(texts):
        words, first = word_hashes(data, offsets)
        for i in range(last_row - first_row):
            own = words[first[i]:first[i + 1]]
            if len(own) >= n:
                yield np.unique(shingle_hashes(own, n))
            elif len(own):
                yield shingle_hashes(np.append(own, _U(len(own))), len(own) + 1)
            else:
                yield np.zeros(0, np.uint64)


def set_fingerprint(hashes: np.ndarray) -> bytes | None:
    if not len(hashes):
        return None
    total = mix(hashes ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    parity = np.bitwise_xor.reduce(mix(hashes ^ _U(0x14057B7EF767814F)))
    return np.array([total, parity + _U(len(hashes))], np.uint64).tobytes()


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """The sketch as signed 64-bit words."""
    bits = np.bincount((hashes & _U(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def allowed_difference(size: int, other: int, percent: int) -> int:
    return (100 - percent) * (size + other) // (100 + percent)


def band_of(size: int) -> tuple[int, int]:
    """Number of the size's band, and the first size beyond it."""
    band, end = 0, BAND_RATIO
    while size >= end:
        band, end = band + 1, end * BAND_RATIO
    return band, end


def block_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the blocks a document sends. `hashes` are sorted, so a block, a range of hash values, is contiguous."""
    size = len(hashes)
    if not size:
        return np.zeros(0, np.uint64)
    largest = 100 * size // percent
    band, end = band_of(size)
    keys = []
    for g, group_end, partner in ((band, end, min(largest, end - 1)), (band + 1, end * BAND_RATIO, largest)):
        if g > band and largest < end:
            break
        blocks = int(SLACK * (allowed_difference(group_end - 1, group_end - 1, percent) + 1)) + 1
        sent = allowed_difference(size, partner, percent) + 1
        block = ((hashes >> _U(32)) * _U(blocks)) >> _U(32)
        heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        counts = np.diff(np.append(heads, size))
        salt = _U((g * 0x9E3779B97F4A7C15 + percent) & 0xFFFFFFFFFFFFFFFF)
        content = np.bitwise_xor.reduceat(mix(hashes ^ salt), heads)
        number = block[heads]
        if sent > len(heads):  # rank the empty blocks after the others
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), number)[:sent - len(heads)]
            number, counts = np.append(number, empty), np.append(counts, np.zeros(len(empty), np.int64))
            content = np.append(content, np.zeros(len(empty), np.uint64))
        top = np.argsort(-counts, kind="stable")[:sent]
        keys.append(mix(content[top] + mix(number[top] ^ salt)))
    return np.concatenate(keys)


def _described(n: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch["text"], n))
            sketches = np.array([parity_sketch(x) for x in found], np.int64).reshape(-1, len(SKETCH)).T
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row_hash"], pa.array([len(x) for x in found], pa.int64()),
                 pa.array([set_fingerprint(x) for x in found], pa.binary()), *(pa.array(w) for w in sketches)],
                ["doc_id", "row_hash", "n_shingles", "fp", *SKETCH])

    return describe


def _bucketed(n: int, percent: int):
    """Rows (key, fp, hub): a member and the hub of its batch; for the hub itself `hub` is null."""
    def flush(keys: list[np.ndarray], prints: list[bytes], counts: list[int]) -> pa.RecordBatch:
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        # Copies of a text are one owner.
        seen: dict[bytes, int] = {}
        owner = np.repeat([seen.setdefault(p, i) for i, p in enumerate(prints)], counts).astype(np.int64)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        hub = owner[new][np.cumsum(new) - 1] if len(key) else owner
        kept = new | (owner != hub)
        key, owner, new, hub = key[kept], owner[kept], new[kept], hub[kept]
        names = pa.array(prints, pa.binary())
        hubs = pa.array(np.where(new, -1, hub), pa.int64(), mask=new)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(key)), names.take(pa.array(owner)), names.take(hubs)], ["key", "fp", "hub"])

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, counts, rows = [], [], [], 0
        for batch in batches:
            for hashes in shingle_sets(batch["text"], n):
                if len(hashes):
                    keys.append(block_keys(hashes, percent))
                    prints.append(set_fingerprint(hashes))
                    counts.append(len(keys[-1]))
                    rows += counts[-1]
                if rows >= COMBINED_ROWS:
                    yield flush(keys, prints, counts)
                    keys, prints, counts, rows = [], [], [], 0
                    # The worker goes on to further rows and tasks: what the combined rows took goes back.
                    pa.default_memory_pool().release_unused()
        yield flush(keys, prints, counts)
        pa.default_memory_pool().release_unused()

    return bucket


def _hashed_sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch["text"], n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_fingerprint(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())],
                ["fp", "hashes"])

    return sets


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["hashes_a"], batch["hashes_b"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _could_link(percent: int) -> Column:
    """Size and sketch bounds that linked classes meet; their columns end in _a and _b."""
    larger, smaller = F.greatest("n_a", "n_b"), F.least("n_a", "n_b")
    allowed = F.expr(f"({100 - percent} * (n_a + n_b)) div {100 + percent}")
    distance = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    return (smaller * 100 >= larger * percent) & (distance <= allowed)


class JaccardJoin:
    """The classes, links and components of a corpus. Steps are written to the shared folder as they are needed."""

    def __init__(self, docs: DataFrame, n: int = 5, percent: int = 80):
        bounded_batches(docs.sparkSession)
        text = F.coalesce("text", F.lit(""))
        self.n, self.percent = n, percent
        self.texts = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("row_hash"), text.alias("text"))
        self.rows = written(
            self.texts.mapInArrow(_described(n), ", ".join(["doc_id long, row_hash long, n_shingles long, fp binary", *(f"{c} long" for c in SKETCH)])),
            "shingle-rows")
        first = F.min(F.struct("doc_id", "row_hash")).alias("first")
        self.classes = written(
            self.rows.where("fp IS NOT NULL").groupBy("fp").agg(
                first, F.min("doc_id").alias("low"), F.max("n_shingles").alias("n"), *(F.max(c).alias(c) for c in SKETCH)),
            "shingle-classes")

    def _buckets(self) -> DataFrame:
        """(key, fp, hub): members and hubs of all buckets with more than one class. Copies of a text send the same rows,
        which are one member in their batch, and equal their hub otherwise."""
        rows = self.texts.select("text").mapInArrow(_bucketed(self.n, self.percent), "key long, fp binary, hub binary")
        # Hubs of batches meet here: at most one row per key and batch.
        top = F.min(F.when(F.col("hub").isNull(), F.col("fp"))).over(Window.partitionBy("key"))
        rows = rows.withColumn("top", top)
        return written(
            rows.select("key", "fp", F.coalesce("hub", "top").alias("hub")).where("fp != hub"), "shingle-buckets")

    def _described_class(self, side: str) -> DataFrame:
        return self.classes.select(
            F.col("fp").alias(side), F.col("n").alias(f"n_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in SKETCH))

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """Of pairs of classes (a, b), those that link."""
        pairs = pairs.join(self._described_class("a"), "a").join(self._described_class("b"), "b")
        pairs = written(pairs.where(_could_link(self.percent)).select("a", "b"), "shingle-pairs")
        wanted = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
        # Texts are hashed again once for each class in question.
        for known in self.sets:
            wanted = wanted.join(known.select("fp"), "fp", "left_anti")
        wanted = written(
            self.classes.join(wanted, "fp", "left_semi").select(F.col("first.doc_id").alias("w_id"), F.col("first.row_hash").alias("w_hash")),
            "shingle-wanted")
        texts = self.texts.join(
            wanted, (F.col("row_hash") == F.col("w_hash")) & F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")
        sets = texts.select("text").mapInArrow(_hashed_sets(self.n), "fp binary, hashes binary")
        self.sets.append(written(sets, "shingle-sets"))
        sets = self.sets[0]
        for more in self.sets[1:]:
            sets = sets.unionByName(more)
        # Rows that repeat a doc_id with its text bring a set twice.
        sets = sets.groupBy("fp").agg(F.any_value("hashes").alias("hashes"))
        for side in ("a", "b"):
            pairs = pairs.join(sets.withColumnsRenamed({"fp": side, "hashes": f"hashes_{side}"}), side)
        return written(pairs.mapInArrow(_verified(self.percent), "a binary, b binary").distinct(), "shingle-links")

    def _in_components(self, found: DataFrame, frame: DataFrame, **names: str) -> DataFrame:
        """`frame` with the component of each class column: column=name."""
        for column, name in names.items():
            roots = found.select(F.col("node").alias(column), F.col("root").alias(name))
            frame = frame.join(roots, column, "left").withColumn(name, F.coalesce(name, column))
        return frame

    def components(self) -> DataFrame:
        """fp, root: the component of each class that links with another."""
        self.sets: list[DataFrame] = []
        buckets = self._buckets()
        stars = written(buckets.groupBy("fp", "hub").agg(F.count(F.lit(1)).alias("shared")), "shingle-stars")
        # First each member and the hub it shares most blocks with; then what is still in different components.
        best = stars.groupBy("fp").agg(F.max(F.struct("shared", "hub")).alias("best"))
        links = self._linked(best.select(F.col("fp").alias("a"), F.col("best.hub").alias("b")))
        found = connected_components(links)
        apart = self._in_components(found, stars, fp="r", hub="s").where("r != s")
        links, found = self._with_more(links, found, apart.select(F.col("fp").alias("a"), F.col("hub").alias("b")))
        # Then, in buckets that hold several components, one member of each component and one of the largest component: two
        # components with many links between them become one by the first that is found.
        members = self._members(found, buckets)
        links, found = self._with_more(links, found, self._representatives(members))
        members = written(self._in_components(found, members, r="now").drop("r").withColumnRenamed("now", "r"), "shingle-members")
        # What is left rarely links: members of different components are compared with each other.
        _, found = self._with_more(links, found, self._across(members))
        return found.select(F.col("node").alias("fp"), "root")

    def _members(self, found: DataFrame, buckets: DataFrame) -> DataFrame:
        """key, fp, r (component), n, sketches and `firsts` (the least keys of the class) of buckets with several components."""
        mixed = self._in_components(found, buckets, fp="r", hub="s").where("r != s").select("key").distinct()
        members = buckets.join(mixed, "key", "left_semi")
        members = members.select("key", "fp").unionByName(members.select("key", F.col("hub").alias("fp"))).distinct()
        least = F.row_number().over(Window.partitionBy("fp").orderBy("key")) <= FIRSTS
        firsts = members.select("key", "fp", least.alias("least")).where("least").groupBy("fp").agg(F.collect_list("key").alias("firsts"))
        members = self._in_components(found, members, fp="r").join(self.classes.drop("first", "low").join(firsts, "fp"), "fp")
        return written(members, "shingle-members")

    def _representatives(self, members: DataFrame) -> DataFrame:
        """Pairs (a, b): in each bucket a member of each component, and one of the component with most members."""
        chosen = F.max(F.struct(F.xxhash64("key", "fp").alias("draw"), "fp", "n", *SKETCH)).alias("one")
        ones = members.groupBy("key", "r").agg(chosen, F.count(F.lit(1)).alias("size"))
        hubs = ones.groupBy("key").agg(F.max(F.struct("size", "r", "one")).alias("hub"))
        met = ones.join(hubs, "key").where("r != hub.r").select(
            *(F.col(f"one.{c}").alias("a" if c == "fp" else f"{c}_a") for c in ("fp", "n", *SKETCH)),
            *(F.col(f"hub.one.{c}").alias("b" if c == "fp" else f"{c}_b") for c in ("fp", "n", *SKETCH)))
        return met.where(_could_link(self.percent)).select("a", "b").distinct()

    def _across(self, members: DataFrame) -> DataFrame:
        """Pairs (a, b) of members of different components that share a bucket. A pair that shares an earlier one of the least
        keys of both is left to that bucket; in its first bucket no pair is left out."""
        x, y = (members.select(
            F.col("key").alias(f"key_{side}"), F.col("fp").alias(side), F.col("r").alias(f"r_{side}"), F.col("n").alias(f"n_{side}"),
            F.col("firsts").alias(f"firsts_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in SKETCH)) for side in ("a", "b"))
        earlier = F.array_min(F.array_intersect("firsts_a", "firsts_b")) < F.col("key_a")
        across = x.join(y, (F.col("key_a") == F.col("key_b")) & (F.col("r_a") < F.col("r_b")) & _could_link(self.percent)
                        & ~F.coalesce(earlier, F.lit(False)))
        return across.select("a", "b").distinct()

    def _with_more(self, links: DataFrame, found: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links and components after further pairs were tested."""
        more = self._linked(pairs)
        if more.isEmpty():
            return links, found
        links = links.unionByName(more)
        return links, connected_components(links)

    def documents(self) -> DataFrame:
        """doc_id, row_hash, n_shingles, component_id of every row, and `component`, which also tells components apart that
        have the same smallest doc_id or none; it is null for rows without words."""
        classes = self.classes.select("fp", "low").join(self.components(), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
        classes = written(
            classes.join(lowest, "root").select("fp", "component_id", F.col("root").alias("component")), "shingle-components")
        rows = self.rows.select("doc_id", "row_hash", "n_shingles", "fp").join(classes, "fp", "left")
        return rows.select(
            "doc_id", "row_hash", "n_shingles",
            F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "component")
