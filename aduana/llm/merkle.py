"""Merkle manifest of a data set: one root, and for every document a proof that leads to it.

The leaf of a row hashes its five columns; every `ARITY` consecutive leaves of a source become one node, level by level, up to
the source's subroot; subroots, ordered by source, become the root the same way.

* Places without sorting. A leaf's place is its rank among the doc_ids of its source. Tasks turn their rows into compressed
  bitmaps of `CHUNK` doc_ids (sorted 16-bit offsets while sparse, bits beyond), which are merged per source and chunk. A
  popcount directory, each level by 13 bits of the chunk number, holds how many leaves come before each chunk: one small
  window per directory node, whatever the spread of the ids. Within a chunk the rank is a count of lower bits.
* Repeated ids. A bitmap holds an id once, with its number of rows beside it. Such rows leave the chunk's group and are
  counted as distinct leaves by the first bytes of their digest and then within these, so a hot id spreads, too.
* Slot arrays. Leaves are grouped by place div `BLOCK`: each group is an array of slots, which one call reduces by seven
  levels. Its node goes into the next round's array, until each source has one. No round sorts.
* Proofs go down the same arrays: a node's siblings, from its own run up to the root, are those within its array followed by
  those of the array's node.

Cases: a null source is a source of its own and comes first; a null doc_id comes first in its source and is never tampered
with; rows with the same doc_id follow their leaf digest, and equal rows have one place each; a null column is `-`; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from aduana.llm.common import written

ARITY = 3
#: Levels that one slot array takes in a round, and the leaves it holds.
LEVELS = 7
BLOCK = ARITY**LEVELS
#: Ids per bitmap: 2**10. A chunk below all others holds null.
CHUNK_BITS = 10
CHUNK = 1 << CHUNK_BITS
_NULL_CHUNK = -(1 << 63 - CHUNK_BITS) - 1
_DIGIT = 13
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_PLACED = "s string, place long, doc_id long, leaf binary, tampered binary"


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests as hex text."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def levels(n: int) -> int:
    """Levels from n nodes to one."""
    count = 0
    while n > 1:
        n, count = -(-n // ARITY), count + 1
    return count


# --- leaves ----------------------------------------------------------------------------------------------------------

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """s (the source, null first), chunk, low (where the id's bit is), doc_id, leaf, and the leaf after tampering where
    the row is tampered with."""
    doc_id = F.col("doc_id").cast("long")

    def leaf(text: Column) -> Column:
        fields = (text if c == "text" else doc_id if c == "doc_id" else F.col(c) for c in COLUMNS)
        return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))

    tampered = (F.crc32(doc_id.cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s"),
        F.coalesce(F.shiftright(doc_id, CHUNK_BITS), F.lit(_NULL_CHUNK)).alias("chunk"),
        F.coalesce(doc_id.bitwiseAND(CHUNK - 1), F.lit(0)).cast("int").alias("low"), doc_id.alias("doc_id"),
        leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(F.translate("text", "\n", ""))).alias("tampered"))


# --- bitmaps ---------------------------------------------------------------------------------------------------------

def packed(lows: np.ndarray) -> bytes:
    """Distinct sorted offsets as 16-bit numbers, or as bits where that is shorter."""
    if len(lows) < CHUNK // 16:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, np.uint8)
    bits[lows] = 1
    return np.packbits(bits).tobytes()


def unpacked(bits: bytes) -> np.ndarray:
    if len(bits) < CHUNK // 8:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))


_BITMAP = "s string, chunk long, bits binary, repeated array<int>, times array<long>"


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per source and chunk of a batch, and the ids in it that have several rows."""
    for batch in batches:
        names = batch["s"].dictionary_encode()
        s, chunk, low = names.indices.to_numpy(), batch["chunk"].to_numpy(), batch["low"].to_numpy()
        order = np.lexsort((low, chunk, s))
        s, chunk, low = s[order], chunk[order], low[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (chunk[1:] != chunk[:-1])
        heads = np.flatnonzero(new)
        bits, repeated, times = [], [], []
        for part in np.split(low, heads[1:]) if len(heads) else []:
            ids, n = np.unique(part, return_counts=True)
            bits.append(packed(ids))
            repeated.append(ids[n > 1])
            times.append(n[n > 1])
        yield pa.RecordBatch.from_arrays(
            [names.dictionary.take(pa.array(s[heads])), pa.array(chunk[heads]), pa.array(bits, pa.binary()),
             pa.array(repeated, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
            ["s", "chunk", "bits", "repeated", "times"])


def _rows_of(bits: bytes, repeated: list[int], times: list[int]) -> np.ndarray:
    """Number of rows of each id of a chunk."""
    rows = np.zeros(CHUNK, np.int64)
    rows[unpacked(bits)] = 1
    rows[repeated] = times
    return rows


def _merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap of a chunk, its repeated ids with their rows and the rows below them, and the number of rows."""
    rows = np.zeros(CHUNK, np.int64)
    for batch in batches:
        for part in zip(*(batch[c].to_pylist() for c in ("bits", "repeated", "times")), strict=True):
            rows += _rows_of(*part)
    repeated = np.flatnonzero(rows > 1)
    below = np.cumsum(rows) - rows
    lists = [pa.array([repeated.astype(np.int32)], pa.list_(pa.int32())),
             *(pa.array([x[repeated]], pa.list_(pa.int64())) for x in (rows, below))]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k.as_py()]) for k in key] + [pa.array([packed(np.flatnonzero(rows))], pa.binary()), *lists, pa.array([int(rows.sum())])],
        ["s", "chunk", "bits", "repeated", "times", "below", "n"])


def directory(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps with `before`, the leaves of their source that come before the chunk. The directory has as many levels as
    the spread of the chunks asks for: five for ids all over 64 bits, one up to some 8 million."""
    low, high = bitmaps.where(f"chunk > {_NULL_CHUNK}").agg(F.min("chunk"), F.max("chunk")).first()
    nodes = [bitmaps]
    while high is not None and high - low >= 1 << _DIGIT:
        low, high = low >> _DIGIT, high >> _DIGIT
        up = F.shiftright("chunk", _DIGIT)
        nodes[-1] = nodes[-1].withColumn("up", up)
        nodes.append(nodes[-1].groupBy("s", F.col("up").alias("chunk")).agg(F.sum("n").alias("n")))

    def counted(level: DataFrame, *node: str) -> DataFrame:
        earlier = Window.partitionBy(*node).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        return level.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    found = counted(nodes.pop(), "s")
    while nodes:
        upper = found.select("s", F.col("chunk").alias("up"), F.col("before").alias("above"))
        found = counted(nodes.pop(), "s", "up").join(upper, ["s", "up"])
        found = found.withColumn("before", F.col("before") + F.col("above")).drop("above", "up")
    return found


def _ranks(rows: pa.Table, bitmap: pa.Table) -> pa.Table:
    """Places of the rows of one chunk."""
    place = pa.array([], pa.int64())
    if rows.num_rows:
        times = _rows_of(*(bitmap[c][0].as_py() for c in ("bits", "repeated", "times")))
        below = np.cumsum(times) - times + bitmap["before"][0].as_py()
        place = pa.array(below[rows["low"].to_numpy()])
    return rows.select(["s", "doc_id", "leaf", "tampered"]).add_column(1, "place", place)


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their place in the source, and the number of leaves `n` of each source."""
    pieces = rows.select("s", "chunk", "low").mapInArrow(_bitmaps, _BITMAP)
    bitmaps = pieces.groupBy("s", "chunk").applyInArrow(_merged, f"{_BITMAP}, below array<long>, n long")
    bitmaps = written(directory(written(bitmaps, "id-bitmaps")), "id-directory")
    sizes = bitmaps.groupBy("s").agg(F.sum("n").alias("n"))
    key = ["s", "chunk", "low"]
    repeated = bitmaps.select("s", "chunk", "before", F.explode(F.arrays_zip("repeated", "below")).alias("id")).selectExpr(
        "s", "chunk", "id.repeated AS low", "before + id.below AS first")
    several = not repeated.isEmpty()
    lone = rows.join(repeated, key, "left_anti") if several else rows
    ranked = lone.groupBy("s", "chunk").cogroup(bitmaps.groupBy("s", "chunk")).applyInArrow(_ranks, _PLACED)
    if several:
        ranked = ranked.unionByName(_placed_by_leaf(rows.join(repeated, key), key))
    return ranked, sizes


def _placed_by_leaf(rows: DataFrame, key: list[str]) -> DataFrame:
    """Places of rows with repeated ids, from `first` on in the order of their leaves. Equal leaves are counted first; the
    first two bytes of a leaf split an id into 65,536 parts."""
    leaves = rows.groupBy(*key, "first", "doc_id", "leaf", "tampered").agg(F.count(F.lit(1)).alias("rows"))
    leaves = written(leaves.withColumn("head", F.substring("leaf", 1, 2)), "repeated-leaves")
    earlier = Window.partitionBy(*key).orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = leaves.groupBy(*key, "head").agg(F.sum("rows").alias("all")).select(
        *key, "head", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("above"))
    within = Window.partitionBy(*key, "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.withColumn("below", F.coalesce(F.sum("rows").over(within), F.lit(0))).join(heads, [*key, "head"])
    leaves = leaves.withColumn("at", F.expr("first + above + below"))
    return leaves.select("s", F.expr("explode(sequence(at, at + rows - 1)) AS place"), "doc_id", "leaf", "tampered")


# --- slot arrays -----------------------------------------------------------------------------------------------------

def reduced(slots: list[bytes], height: int) -> list[list[bytes]]:
    """The nodes of an array of slots, level by level."""
    found = [slots]
    for _ in range(height):
        now = found[-1]
        found.append([digest(*now[k:k + ARITY]) for k in range(0, len(now), ARITY)])
    return found


def _arrays(block: pa.Table) -> pa.Table:
    """One row of slots for the leaves of a block, with the node they come to."""
    block = block.take(pa.array(np.argsort(block["place"].to_numpy())))
    slots, n = block["leaf"].to_pylist(), block["n"][0].as_py()
    inner = reduced(slots, min(LEVELS, levels(n)))
    ids, tampered = (block[c].combine_chunks() if c in block.column_names else None for c in ("doc_id", "tampered"))
    columns = {
        "s": pa.array([block["s"][0].as_py()]), "place": pa.array([block["place"][0].as_py() // BLOCK]), "n": pa.array([n]),
        "slots": pa.array([b"".join(slots)], pa.binary()), "leaf": pa.array([inner[-1][0]], pa.binary())}
    if ids is not None:
        one = pa.array([0, len(slots)], pa.int32())
        columns |= {"ids": pa.ListArray.from_arrays(one, ids), "changed": pa.ListArray.from_arrays(one, tampered)}
    return pa.table(columns)


_ARRAY = "s string, place long, n long, slots binary, leaf binary"
_ARRAY_OF_ROWS = f"{_ARRAY}, ids array<long>, changed array<binary>"
_PATH = "s string, place long, turns binary, siblings binary, subroot binary"


class Tree:
    """One tree per `s` over nodes (s, place, n, leaf), kept as rounds of slot arrays."""

    def __init__(self, nodes: DataFrame, name: str, leaves: bool = False):
        self.rounds: list[DataFrame] = []
        while True:
            block = F.expr(f"place div {BLOCK}").alias("block")
            arrays = nodes.groupBy("s", block).applyInArrow(_arrays, _ARRAY_OF_ROWS if leaves and not self.rounds else _ARRAY)
            self.rounds.append(written(arrays, f"{name}-{len(self.rounds)}"))
            # The next round has what is left of sources with several nodes.
            nodes = self.rounds[-1].selectExpr("s", "place", f"(n + {BLOCK - 1}) div {BLOCK} AS n", "leaf").where("n > 1")
            if nodes.isEmpty():
                break

    def roots(self) -> DataFrame:
        """s, leaf: the one node that is left of each source."""
        found = None
        for arrays in self.rounds:
            last = arrays.where(f"n <= {BLOCK}").select("s", "leaf")
            found = last if found is None else found.unionByName(last)
        return found

    def paths(self, above: DataFrame) -> DataFrame:
        """s, place, turns, siblings, subroot: the path from the array `place` of the first round to the root; `above` has
        the path of each s."""
        going: DataFrame | None = None
        for arrays in reversed(self.rounds):
            if going is not None:
                going = by_array(above_arrays, going, _descended, _PATH)
            # Trees that end in this round begin with the path above them.
            ends = arrays.where(f"n <= {BLOCK}").select("s", "place").join(above, "s")
            going = ends if going is None else ends.unionByName(going)
            above_arrays = arrays
        return going


def by_array(arrays: DataFrame, paths: DataFrame, function: Callable, schema: str) -> DataFrame:
    """`function` of each array with its path."""
    paths = paths.toDF(*paths.columns)
    return arrays.groupBy("s", "place").cogroup(paths.groupBy("s", "place")).applyInArrow(function, schema)


def _steps(slots: list[bytes], height: int) -> Iterator[tuple[bytes, bytes]]:
    """For each slot, the path to the array's node: the turns (place in the run and size of the run, one byte a level) and
    the siblings in order."""
    inner = reduced(slots, height)
    paths = [(b"", b"")] * len(inner[-1])
    for nodes in reversed(inner[:-1]):
        now = []
        for k in range(len(nodes)):
            run = nodes[k - k % ARITY:k - k % ARITY + ARITY]
            turns, siblings = paths[k // ARITY]
            now.append((bytes([k % ARITY * 16 + len(run)]) + turns, b"".join(run[:k % ARITY] + run[k % ARITY + 1:]) + siblings))
        paths = now
    yield from paths


def folded(node: bytes, turns: bytes, siblings: bytes) -> bytes:
    """The root that a node leads to along a path."""
    at = 0
    for turn in turns:
        place, size = turn >> 4, turn & 15
        run = [siblings[k:k + 32] for k in range(at, at + 32 * (size - 1), 32)]
        at += 32 * (size - 1)
        node = digest(*run[:place], node, *run[place:])
    return node


def _cut(slots: bytes) -> list[bytes]:
    return [slots[k:k + 32] for k in range(0, len(slots), 32)]


def _joined(array: pa.Table, path: pa.Table) -> dict:
    return array.to_pylist()[0] | path.to_pylist()[0]


def _descended(array: pa.Table, path: pa.Table) -> pa.Table:
    """The path of each slot of an array, by that of its node."""
    row = _joined(array, path)
    steps = list(_steps(_cut(row["slots"]), min(LEVELS, levels(row["n"]))))
    return pa.table({
        "s": [row["s"]] * len(steps), "place": range(row["place"] * BLOCK, row["place"] * BLOCK + len(steps)),
        "turns": pa.array([t + row["turns"] for t, _ in steps], pa.binary()),
        "siblings": pa.array([b + row["siblings"] for _, b in steps], pa.binary()),
        "subroot": pa.array([row["subroot"]] * len(steps), pa.binary())})


def _proofs(root: bytes) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Proof and check of each document of a slot array."""
    def proofs(array: pa.Table, path: pa.Table) -> pa.Table:
        row = _joined(array, path)
        slots, upper = _cut(row["slots"]), (row["turns"], row["siblings"])
        known: dict[tuple[bytes, bytes, bytes], bytes] = {}

        def arrival(node: bytes, turns: bytes, siblings: bytes) -> bytes:
            """`folded` up to the root, with each step from one node taken once."""
            step = (node, turns, siblings)
            if step not in known:
                size = 32 * ((turns[0] & 15) - 1) if turns else 0
                known[step] = (
                    arrival(folded(node, turns[:1], siblings[:size]), turns[1:], siblings[size:]) if turns else folded(node, *upper))
            return known[step]

        steps = list(_steps(slots, min(LEVELS, levels(row["n"]))))
        ends = [arrival(leaf if new is None else new, *step) for leaf, new, step in zip(slots, row["changed"], steps, strict=True)]
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "leaf": [leaf.hex() for leaf in slots],
            "subroot": [row["subroot"].hex()] * len(slots), "root": [root.hex()] * len(slots),
            "proof_sha256": [hashlib.sha256((siblings + upper[1]).hex().encode()).hexdigest() for _, siblings in steps],
            "folded_root": [end.hex() for end in ends], "verified": [end == root for end in ends]})

    return proofs


MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def ordered(subroots: DataFrame) -> DataFrame:
    """Subroots with their place by source. Ranges of sources are sorted apart; only their sizes are added up."""
    ranges = subroots.repartitionByRange("s").sortWithinPartitions("s").select("s", "leaf", F.monotonically_increasing_id().alias("at"))
    ranges = written(ranges, "subroots").withColumn("part", F.shiftright("at", 33))
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"), F.sum("size").over(Window.partitionBy()).alias("n"))
    return ranges.join(offsets, "part").select("s", (F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place"), "n", "leaf")


class Manifest:
    """The tree of a data set: `root` (hex, None for an empty one), `subroots` per source, `documents` with proofs."""

    def __init__(self, docs: DataFrame):
        rows, sizes = placed(written(leaves(docs), "leaves"))
        self.sources = Tree(rows.join(sizes, "s"), "source-tree", leaves=True)
        self.subroots = written(ordered(self.sources.roots()), "places")
        self.top = Tree(self.subroots.withColumnRenamed("s", "source").withColumn("s", F.lit("")), "top-tree")
        last = self.top.roots().first()
        self.root = None if last is None else last["leaf"].hex()

    def documents(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
        arrays = self.sources.rounds[0]
        if self.root is None:
            return arrays.sparkSession.createDataFrame([], MANIFEST)
        start = arrays.sparkSession.sql("SELECT '' AS s, X'' AS turns, X'' AS siblings, X'' AS subroot")
        top = by_array(self.top.rounds[0], self.top.paths(start), _descended, _PATH).select("place", "turns", "siblings")
        above = written(self.subroots.join(top, "place").selectExpr("s", "turns", "siblings", "leaf AS subroot"), "source-paths")
        return by_array(arrays, self.sources.paths(above), _proofs(bytes.fromhex(self.root)), MANIFEST)
