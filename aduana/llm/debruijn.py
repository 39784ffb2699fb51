"""Removal of word passages that a document with a smaller id holds, by compacting a De Bruijn graph of the corpus.

Every run of `size` words is an edge, from its first size - 1 words to its last. An edge that a document with a smaller doc_id
has, too, is repeated, and its words go. Everything is judged on the input.

* Seeds. The seed of an edge is the lowest hash of its `GRAM`-word runs, so equal edges have equal seeds. Neighbouring edges
  mostly share one: about one seed in five words is counted, and only edges with a seed of several documents go on.
* Edges. They are shuffled by a 64-bit hash and sorted by it, doc_id and place: the first one of a hash is the source, all
  with a larger doc_id are repeated and take its coordinates (doc_id, place). The stream is read once; no group is held.
* Hot edges and seeds are resolved within the texts that a task reads together first, and only one of them goes on.
* Paths. Repeated edges of a document that follow each other, as their sources do, form a path without a branch: a branch is
  where the document leaves its source or takes up another. Paths are compacted by document, and `unitigs` cuts those of a
  source where any of them begins or ends and counts their copies.
* Verification. Each path is a claim that two spans, by coordinates, hold the same words. Both are read back from the texts
  and compared by 128-bit digests of the words. Should a hash of an edge ever have lied, all edges are taken anew with
  128-bit hashes of their own.

Cases: a null text has no words; a null doc_id is neither smaller nor larger than others, so its row stays whole and removes
nothing; rows with the same doc_id do not remove each other's words, and each is treated by its own text; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from aduana.llm.common import WORD_REGEX, mix, pieces, shingle_hashes, signed, word_hashes, word_ranges, written

SIZE = 13
GRAM = 5
#: Bytes of text in which seeds and edges are resolved together.
TOGETHER = 1 << 22
#: Rows that a stream puts in order before it sends them on.
HELD_ROWS = 1 << 19
_U = np.uint64

_SEEDS = "route long, seed long, doc_id long, salt long, known boolean"
_PATH = "doc_id long, salt long, place int, n int, from_id long, from_salt long, from_place int"


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    lowest = values[:len(values) - width + 1]
    for k in range(1, width):
        lowest = np.minimum(lowest, values[k:len(values) - width + 1 + k])
    return lowest


def edges(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each edge of consecutive texts: text, first word within it, seed, and the word hashes of all texts with the edge's
    first one."""
    words, first = word_hashes(data, offsets, lower=False)
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = first[text] + place
    grams = shingle_hashes(words, gram)
    seed = _sliding_minimum(grams, size - gram + 1)[at] if len(at) else np.zeros(0, np.uint64)
    return text, place, seed, words, at


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "salt"))


def _seeded(size: int, gram: int):
    """Seeds of texts to be counted: one of those that several documents of a piece share, as `known`; its other documents
    pass by the count, under any route."""
    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, salts = _keys(batch)
            for begin, _, data, offsets in pieces(batch["text"], TOGETHER):
                text, _, seed, _, _ = edges(data, offsets, size, gram)
                change = _firsts(text, seed)
                text, seed = text[change], seed[change]
                order = np.lexsort((text, seed))
                text, seed = text[order], seed[order]
                once = _firsts(text, seed)
                text, seed = text[once], seed[once]
                first = _firsts(seed)
                shared = np.zeros(len(seed), bool)
                shared[:-1] = ~first[1:]
                shared |= ~first
                doc, salt = ids[begin + text], salts[begin + text]
                route = np.where(first, seed, mix(doc.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + salt.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(route)), pa.array(signed(seed)), pa.array(doc), pa.array(salt), pa.array(shared)],
                    ["route", "seed", "doc_id", "salt", "known"])

    return seeded


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a stream sorted by route whose route has another row or is known to have one. At most one row is held."""
    held: pa.RecordBatch | None = None
    going: int | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
            held = None
        route, known = batch["route"].to_numpy(), batch["known"].to_numpy(zero_copy_only=False).copy()
        same = route[1:] == route[:-1]
        known[1:] |= same
        known[:-1] |= same
        known |= route == going if going is not None else False
        if known[-1]:
            going = int(route[-1])
        else:
            held, known[-1] = batch.slice(batch.num_rows - 1), False
        yield batch.filter(pa.array(known)).select(["doc_id", "salt", "seed"])


def _progressions(doc: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted places of equal edges as first index, number and stride of runs of equal strides within a document."""
    head = _firsts(*doc)
    stride = np.diff(place, prepend=0)
    # A place goes on with a run if it is as far from the one before as that one is from its own.
    goes_on = np.zeros(len(place), bool)
    goes_on[2:] = ~head[2:] & ~head[1:-1] & (stride[2:] == stride[1:-1])
    starts = np.flatnonzero(~goes_on)
    times = np.diff(np.append(starts, len(place)))
    return starts, times, np.where(times > 1, stride[np.minimum(starts + 1, len(place) - 1)], 0)


def _edge_rows(size: int, gram: int, wide: bool, edge_bits: int):
    """Edges of texts with one of `seeds`: of each edge those of the smallest document of a piece, still to be compared with
    other pieces, with null from_id (`n` of them, `from_place` words apart); and paths of what that document repeats."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, salts = _keys(batch)
            lists = batch["seeds"]
            wanted = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            for begin, end, data, offsets in pieces(batch["text"], TOGETHER):
                text, place, seed, words, at = edges(data, offsets, size, gram)
                mine = (owner >= begin) & (owner < end)
                # A seed is looked up together with its text.
                tag = mix((owner[mine] - begin).astype(np.uint64) + _U(1))
                kept = np.isin(seed ^ mix(text.astype(np.uint64) + _U(1)), wanted[mine] ^ tag)
                text, place, at = text[kept], place[kept], at[kept]
                if not len(at):
                    continue
                hashes = [shingle_hashes(words, size)[at] >> _U(64 - edge_bits)]
                if wide:
                    hashes = [shingle_hashes(w, size)[at] for w in (words, word_hashes(data, offsets, lower=False, seed=1)[0])]
                doc, salt = ids[begin + text], salts[begin + text]
                order = np.lexsort((place, salt, doc, *hashes[::-1]))
                *hashes, doc, salt, place = (c[order] for c in (*hashes, doc, salt, place))
                head = np.maximum.accumulate(np.where(_firsts(*hashes), np.arange(len(doc)), 0))
                repeated = doc > doc[head]
                *own, own_place = (c[~repeated] for c in (*hashes, doc, salt, place))
                starts, times, stride = _progressions(own, own_place)
                # Rows of a document together: they are smaller in the shuffle.
                order = np.lexsort((own_place[starts], own[-1][starts], own[-2][starts]))
                starts, times, stride = starts[order], times[order], stride[order]
                yield _rows([c[starts] for c in own[:-2]], own[-2][starts], own[-1][starts], own_place[starts], times, None, None, stride)
                # Paths within the piece.
                head = head[repeated]
                path = [c[repeated] for c in (doc, salt, place)] + [c[head] for c in (doc, salt, place)]
                order = np.lexsort((path[2], path[1], path[0]))
                path = [c[order] for c in path]
                step = np.arange(len(order))
                starts = np.flatnonzero(_firsts(path[0], path[1], path[2] - step, path[3], path[4], path[5] - step))
                n = np.diff(np.append(starts, len(order)))
                doc, salt, place, from_id, from_salt, from_place = (c[starts] for c in path)
                route = mix(doc.astype(np.uint64) + salt.astype(np.uint64))
                yield _rows([route] * len(hashes), doc, salt, place, n, from_id, from_salt, from_place)

    return rows


def _rows(hashes, doc, salt, place, n, from_id, from_salt, from_place) -> pa.RecordBatch:
    none = pa.nulls(len(doc), pa.int64())
    columns = [*(pa.array(signed(h)) for h in hashes), pa.array(doc), pa.array(salt), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32)),
               none if from_id is None else pa.array(from_id), none if from_salt is None else pa.array(from_salt), pa.array(from_place.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, [*(f"e{k + 1}" for k in range(len(hashes))), *(c.split()[0] for c in _PATH.split(", "))])


def _sourced(hashes: list[str]):
    """Paths out of a stream of edges sorted by hash, doc_id, salt and place: what has a smaller document before it, and
    paths found earlier. Only the source of the last hash is kept between batches, and a bounded number of rows."""
    names = [c.split()[0] for c in _PATH.split(", ")]

    def ordered(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Rows of a document together."""
        found = pa.concat_batches(rows)
        doc, salt, place = (found[c].to_numpy() for c in ("doc_id", "salt", "place"))
        return found.take(pa.array(np.lexsort((place, salt, doc))))

    def sourced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] | None = None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            found = pc.is_valid(batch["from_id"])
            held.append(batch.filter(found).select(names))
            batch = batch.filter(pc.invert(found))
            if batch.num_rows:
                columns = [batch[c].to_numpy() for c in (*hashes, "doc_id", "salt", "place", "n", "from_place")]
                if last is not None:
                    columns = [np.concatenate([a, b]) for a, b in zip(last, columns, strict=True)]
                *edge, doc, salt, place, times, stride = columns
                head = np.maximum.accumulate(np.where(_firsts(*edge), np.arange(len(doc)), 0))
                last = [c[head[-1]:head[-1] + 1] for c in columns]
                repeated = np.flatnonzero(doc > doc[head])
                # All places of an edge in the document.
                count = times[repeated]
                repeated = np.repeat(repeated, count)
                number = np.arange(len(repeated)) - np.repeat(np.cumsum(count) - count, count)
                source = head[repeated]
                held.append(pa.RecordBatch.from_arrays(
                    [pa.array(doc[repeated]), pa.array(salt[repeated]), pa.array((place[repeated] + stride[repeated] * number).astype(np.int32)),
                     pa.array(np.ones(len(repeated), np.int32)), pa.array(doc[source]), pa.array(salt[source]), pa.array(place[source])], names))
            if sum(b.num_rows for b in held) > HELD_ROWS:
                yield ordered(held)
                held = []
        if held:
            yield ordered(held)

    return sourced


_READ = "doc_id long, salt long, place int, n int, from_id long, from_salt long, from_place int, digest binary, n_words long, n_removed long, kept_sha256 string"


def _spans_read(size: int):
    """Digests of the words of the spans asked for, and of the words left when the document's own paths are out."""
    names = [c.split()[0] for c in _READ.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, salts, spans = (batch[c].to_pylist() for c in ("doc_id", "salt", "spans"))
            out: list[tuple] = []
            for begin, end, data, offsets in pieces(batch["text"], TOGETHER):
                starts, ends, first = word_ranges(data, offsets)
                for i in range(begin, end):
                    lo, hi, base = first[i - begin], first[i - begin + 1], offsets[i - begin]
                    text = data[base:offsets[i - begin + 1]].tobytes()
                    words = [text[a:b] for a, b in zip((starts[lo:hi] - base).tolist(), (ends[lo:hi] - base).tolist(), strict=True)]
                    lost = np.zeros(len(words) + 1, np.int64)
                    for span in spans[i]:
                        place, n = span["place"], span["n"]
                        digest = hashlib.md5(b" ".join(words[place:place + n + size - 1])).digest()
                        out.append((ids[i], salts[i], place, n, span["from_id"], span["from_salt"], span["from_place"], digest, None, None, None))
                        if span["from_id"] is not None:
                            lost[place] += 1
                            lost[place + n + size - 1] -= 1
                    kept = [w for w, gone in zip(words, np.cumsum(lost)[:-1].tolist(), strict=True) if not gone]
                    if len(kept) < len(words):
                        kept_sha = hashlib.sha256(b" ".join(kept)).hexdigest()
                        out.append((ids[i], salts[i], *[None] * 6, len(words), len(words) - len(kept), kept_sha))
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return read


class PassageDedup:
    """Repeated paths of a corpus, and what is left of the documents without them."""

    def __init__(self, docs: DataFrame, size: int = SIZE, gram: int = GRAM, edge_bits: int = 64):
        self.size, self.gram, self.edge_bits = size, min(gram, size), edge_bits
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        # Rows of a repeated doc_id are told apart by their text.
        again = written(rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "ids-again")
        if again.isEmpty():
            self.rows = rows.select("doc_id", F.lit(0).cast("long").alias("salt"), "text")
        else:
            marked = rows.join(again.withColumn("again", F.lit(True)), "doc_id", "left")
            self.rows = marked.select("doc_id", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0)).alias("salt"), "text")
        self.texts = self.rows.where("doc_id IS NOT NULL")
        if not again.isEmpty():
            copies = self.texts.where("salt <> 0").dropDuplicates(["doc_id", "salt"])
            self.texts = self.texts.where("salt = 0").unionByName(copies)
        self._read: DataFrame | None = None

    def _candidates(self) -> DataFrame:
        """doc_id, salt, seeds: seeds that other documents have, too."""
        seeds = self.texts.mapInArrow(_seeded(self.size, self.gram), _SEEDS)
        several = seeds.repartition("route").sortWithinPartitions("route").mapInArrow(_several, "doc_id long, salt long, seed long")
        return written(several.groupBy("doc_id", "salt").agg(F.collect_list("seed").alias("seeds")), "seeds-of-texts")

    def _compacted(self, candidates: DataFrame, wide: bool) -> DataFrame:
        """Paths: edges that follow each other in the document as their sources do."""
        hashes = ["e1", "e2"] if wide else ["e1"]
        rows = self.texts.join(candidates, ["doc_id", "salt"]).mapInArrow(
            _edge_rows(self.size, self.gram, wide, self.edge_bits), "".join(f"{h} long, " for h in hashes) + _PATH)
        steps = rows.repartition(*hashes).sortWithinPartitions(*hashes, "doc_id", "salt", "place").mapInArrow(_sourced(hashes), _PATH)
        document = Window.partitionBy("doc_id", "salt").orderBy("place", "from_id", "from_salt", "from_place")
        before = F.lag(F.struct(F.expr("place + n"), F.expr("from_place + n"), "from_id", "from_salt")).over(document)
        here = F.struct("place", "from_place", "from_id", "from_salt")
        marked = steps.withColumn("branch", F.when(before.eqNullSafe(here), 0).otherwise(1))
        numbered = marked.withColumn("path", F.sum("branch").over(document.rowsBetween(Window.unboundedPreceding, 0)))
        return numbered.groupBy("doc_id", "salt", "path").agg(
            F.min("place").alias("place"), F.sum("n").cast("int").alias("n"), F.first("from_id").alias("from_id"),
            F.first("from_salt").alias("from_salt"), F.min("from_place").alias("from_place")).drop("path")

    def _verifiable(self, paths: DataFrame) -> DataFrame:
        """Paths and their sources with digests of their words, and what is left of the texts that lose any. One job from the
        texts on: they are shuffled by document once, for their edges and for these spans."""
        each = """inline(array(
          struct(doc_id, salt, place, n, from_id, from_salt, from_place),
          struct(from_id AS doc_id, from_salt AS salt, from_place AS place, n, NULL AS from_id, NULL AS from_salt, NULL AS from_place)))"""
        span = F.struct("place", "n", "from_id", "from_salt", "from_place")
        asked = paths.selectExpr(each).groupBy("doc_id", "salt").agg(F.collect_set(span).alias("spans"))
        return written(self.texts.join(asked, ["doc_id", "salt"]).mapInArrow(_spans_read(self.size), _READ), "spans-read")

    @staticmethod
    def _verified(read: DataFrame) -> bool:
        """Whether all paths hold the words of their sources."""
        place = ["from_id", "from_salt", "from_place", "n"]
        claimed = read.where("from_id IS NOT NULL").select(*place, "digest").distinct()
        source = read.where("digest IS NOT NULL AND from_id IS NULL").select(
            F.col("doc_id").alias("from_id"), F.col("salt").alias("from_salt"), F.col("place").alias("from_place"), "n",
            F.col("digest").alias("true_digest")).distinct()
        return claimed.join(source, place, "left").where("NOT digest <=> true_digest").isEmpty()

    def _resolved(self) -> DataFrame:
        if self._read is None:
            candidates = self._candidates()
            for wide in (False, True):
                self._read = self._verifiable(self._compacted(candidates, wide))
                if self._verified(self._read):
                    return self._read
            raise RuntimeError("spans differ although 128-bit hashes of all their edges agree")
        return self._read

    def paths(self) -> DataFrame:
        """doc_id, salt, place, n, from_id, from_salt, from_place: `n` edges from word `place` on are those of the document
        from_id from word from_place on. `salt` tells rows of one doc_id apart. Which of several sources is named can
        depend on how rows are read; what is repeated does not."""
        return self._resolved().where("from_id IS NOT NULL").select(*(c.split()[0] for c in _PATH.split(", ")))

    def unitigs(self) -> DataFrame:
        """from_id, from_salt, place, n, copies: the paths of each source cut wherever one begins or ends, with the number of
        paths over each part."""
        ends = self.paths().select("from_id", "from_salt", F.explode(F.array(
            F.struct(F.col("from_place").alias("at"), F.lit(1).alias("change")),
            F.struct(F.expr("from_place + n").alias("at"), F.lit(-1).alias("change")))).alias("end"))
        ends = ends.groupBy("from_id", "from_salt", "end.at").agg(F.sum("end.change").alias("change"))
        source = Window.partitionBy("from_id", "from_salt").orderBy("at")
        cut = ends.select("from_id", "from_salt", F.col("at").alias("place"), (F.lead("at").over(source) - F.col("at")).alias("n"),
                          F.sum("change").over(source).alias("copies"))
        return cut.where("copies > 0")

    def documents(self) -> DataFrame:
        """doc_id, n_words, n_removed, kept_sha256 of every row: sha256 of the words left, joined by spaces."""
        changed = self._resolved().where("n_removed > 0").select(
            "doc_id", "salt", "n_removed", F.col("kept_sha256").alias("kept")).distinct()
        plain = F.array_join(F.regexp_extract_all("text", F.lit(WORD_REGEX), F.lit(0)), " ")
        rows = self.rows.select(
            "doc_id", "salt", F.regexp_count("text", F.lit(WORD_REGEX)).cast("long").alias("n_words"), F.sha2(plain, 256).alias("whole"))
        return rows.join(changed, ["doc_id", "salt"], "left").select(
            "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("kept", "whole").alias("kept_sha256"))
