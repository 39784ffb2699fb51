"""Removal of byte strings that occur more than once, by common-prefix interval trees of enhanced suffix arrays.

Every string of `length` bytes that starts anywhere else too, in whatever text, is removed wherever it stands. All
occurrences are judged on the input.

* Seeds. Of each window of `length` bytes the 64-byte gram with the lowest hash is chosen (the last one of equals). Two
  equal strings choose the same gram at the same place, so every repeated string lies around grams with equal hashes. A
  seed is a chosen gram with the run of windows that chose it. Only grams that occur twice go on, about one position in
  170 at first and far fewer after the count.
* Groups. The occurrences of a gram, each with the bytes of the windows that chose it, are one group. Its suffixes from the gram on are sorted into a suffix array with common-prefix lengths. One scan with a stack
  gives the tree of common-prefix intervals. Within an interval the texts to the left are compared the same way, from the
  gram backwards: occurrences that differ in the byte before their common part are the left-diverse, maximal repeats. They
  are reported with all their occurrences, so that each byte of each occurrence is covered and not just neighbours.
* Hot groups. A gram with more than `GROUP_ROWS` occurrences is never brought together. There, every string of `length`
  bytes around each occurrence is counted by its 128-bit hash instead: first within a task's batch, which sends one row per
  distinct string, then over all batches. The result is the same.
* Texts that are copies of each other as a whole stand in for each other: one goes through the steps above, and all are
  removed if they are long enough.

Equality in groups is of bytes; grams, whole texts and hot strings are compared by hashes (64, 128 and 128 bits).

Cases: a null text is empty and nothing of it is removed; rows that repeat a text, with the same doc_id or not, are
occurrences of their own; an empty table gives no rows; other columns are ignored. A cut can fall within a character:
what is kept is bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aduana.llm.common import mix, pieces, prefix_hash, powers, signed, written

LENGTH = 400
GRAM = 64
#: Occurrences of a gram that are brought together at most; with their surroundings, about 60 MB.
GROUP_ROWS = 1 << 16
#: Bytes of a text handled at once.
SEGMENT = 1 << 23
_U = np.uint64
_PLACE = _U((1 << 24) - 1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes at each position."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(data)
    return mix((prefix[size:] - prefix[:-size]) * powers(len(data), True)[:len(data) - size + 1])


def seeds(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, segment: int = SEGMENT) -> tuple[np.ndarray, ...]:
    """Chosen grams of consecutive texts: places, hashes, and the first and last start of the windows that chose them.
    Windows lie within one text. Bytes are handled by segments; a gram that windows on both sides of a cut chose is there
    twice, with the windows of each side."""
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    width = length - gram + 1
    begin = 0
    while begin + length <= len(data):
        part = data[begin:begin + segment]
        h = gram_hashes(part, gram)
        ranked = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=np.uint64))
        padded = np.full(-(-len(ranked) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(ranked)] = ranked
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(blocks, 1).ravel()
        lowest = np.minimum(ahead[:len(part) - length + 1], behind[width - 1:width + len(part) - length])
        # Windows that run into the next text do not count.
        starts = np.arange(begin, begin + len(lowest))
        inside = starts + length <= offsets[np.searchsorted(offsets, starts, "right").clip(max=len(offsets) - 1)]
        starts, chosen = starts[inside], (_PLACE - (lowest[inside] & _PLACE)).astype(np.int64)
        if len(starts):
            heads = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)))
            tails = np.append(heads[1:], len(starts)) - 1
            for column, value in zip(found, (chosen[heads] + begin, h[chosen[heads]], starts[heads], starts[tails]), strict=True):
                column.append(value)
        begin += segment - length + 1
    return tuple(np.concatenate(column) for column in found)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    low = 0
    while low < n:  # halve the part that holds the first difference
        half = (n - low + 1) // 2
        if a[low:low + half] == b[low:low + half]:
            low += half
        elif half == 1:
            return low
        else:
            n = low + half
    return low


def interval_tree(shared: Sequence[int]) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of sorted strings, in one scan with a stack. `shared[i]` is the
    common prefix of strings i - 1 and i."""
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    for i in range(1, len(shared) + 1):
        now, left = shared[i] if i < len(shared) else -1, i - 1
        while stack and stack[-1][0] > now:
            size, left = stack.pop()
            found.append((size, left, i - 1))
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, left))
    return found


def suffix_array(strings: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """Order of the strings, and the common prefix of each with the one before it."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    return np.array(order), [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]


class RangeMinimum:
    """Minima of ranges of an array by doubling."""

    def __init__(self, values: Sequence[int]):
        self.rows = [np.array(values)]
        while 2 << len(self.rows) - 1 <= len(values):
            last, half = self.rows[-1], 1 << len(self.rows) - 1
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][first[at]], self.rows[k][last[at] - (1 << int(k)) + 1])
        return out


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least `length` bytes through a point: bytes to its left, bytes to its right, occurrences.
    `lefts` run backwards from the point, `rights` forwards."""
    order, shared = suffix_array(rights)
    left_order, left_shared = suffix_array(lefts)
    left_rank = np.empty(len(left_order), np.int64)
    left_rank[left_order] = np.arange(len(left_order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    left_minimum, right_minimum = RangeMinimum(left_shared), RangeMinimum(shared)
    for right, first, last in interval_tree(shared):
        # The interval's members, in the order of what stands to their left.
        ranks = np.sort(left_rank[order[first:last + 1]])
        between = left_minimum(ranks[:-1] + 1, ranks[1:])
        if between.max() + right < length:
            continue
        for left, a, b in interval_tree([0, *between.tolist()]):
            if left + right < length:
                continue
            group = left_order[ranks[a:b + 1]]
            places = rank[group]
            # Longer to the right for all of them: the inner interval reports it.
            if right_minimum(places.min(keepdims=True) + 1, places.max(keepdims=True))[0] == right:
                yield left, right, group.tolist()


def _seeded(length: int, gram: int, segment: int):
    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch["t1"].to_numpy(), batch["t2"].to_numpy()
            for row, _, data, offsets in pieces(batch["text"].cast(pa.large_binary())):
                places, hashes, first, last = seeds(data, offsets, length, gram, segment)
                owner = np.searchsorted(offsets, places, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(hashes)), pa.array(t1[row + owner]), pa.array(t2[row + owner]), pa.array(places - offsets[owner]),
                     pa.array((places - first).astype(np.int32)), pa.array((last - places).astype(np.int32))],
                    ["gram", "t1", "t2", "place", "back", "ahead"])

    return seed


_SEED = "gram long, t1 long, t2 long, place long, back int, ahead int"


def _surroundings(length: int):
    """Around each seed the bytes of its windows: those to the left, and those from the seed on."""
    kinds = [pa.int64()] * 4 + [pa.binary()] * 2

    def record(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(rows, kinds, strict=True)], ["gram", "t1", "t2", "place", "before", "after"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in kinds]
            for i in range(batch.num_rows):
                text, t1, t2 = batch["text"][i].as_buffer(), batch["t1"][i].as_py(), batch["t2"][i].as_py()
                for seed in batch["seeds"][i].as_py():
                    p = seed["place"]
                    before, after = text[p - seed["back"]:p].to_pybytes(), text[p:p + seed["ahead"] + length].to_pybytes()
                    for column, value in zip(rows, (seed["gram"], t1, t2, p, before, after), strict=True):
                        column.append(value)
                if len(rows[0]) > 10_000:
                    yield record(rows)
                    rows = [[] for _ in kinds]
            yield record(rows)

    return cut


def _repeats(length: int, merged: bool):
    """Maximal repeats of the groups, which come sorted by gram. `merged`: one row per occurrence of a gram instead, from
    the first to the last byte of all its repeats, which overlap as all of them hold the gram."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["gram", "number", "t1", "t2", "begin", "end"])

    def repeats_of(gram: int, group: dict[tuple, tuple[bytes, bytes]]) -> Iterator[tuple]:
        members = list(group)
        lefts, rights = [group[m][0][::-1] for m in members], [group[m][1] for m in members]
        reach: dict[int, tuple[int, int]] = {}
        for number, (left, right, occurrences) in enumerate(maximal_repeats(lefts, rights, length)):
            for m in occurrences:
                if merged:
                    most_left, most_right = reach.get(m, (0, 0))
                    reach[m] = max(left, most_left), max(right, most_right)
                else:
                    t1, t2, place = members[m]
                    yield gram, number, t1, t2, place - left, place + right
        for m, (left, right) in reach.items():
            t1, t2, place = members[m]
            yield gram, 0, t1, t2, place - left, place + right

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[tuple, tuple[bytes, bytes]] = {}
        current, out = None, []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("gram", "t1", "t2", "place", "before", "after")), strict=True):
                if row[0] != current:
                    if len(group) > 1:
                        out += repeats_of(current, group)
                    current, group = row[0], {}
                # Windows on both sides of a cut chose the gram: what stands around it reaches as far as either saw.
                before, after = group.get(row[1:4], (b"", b""))
                group[row[1:4]] = max(before, row[4], key=len), max(after, row[5], key=len)
            if len(out) > 10_000:
                yield spans(out)
                out = []
        if len(group) > 1:
            out += repeats_of(current, group)
        yield spans(out)

    return scan


def _hot_strings(length: int):
    """Every string whose window chose a hot gram: one row per distinct string of a batch (lone: it occurs once there);
    occurrences that a batch holds twice are spans at once."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in range(5)]
            for i, runs in enumerate(batch["runs"].to_pylist()):
                data = np.frombuffer(batch["text"][i].as_buffer(), np.uint8)
                wanted = np.zeros(max(0, len(data) - length + 1), bool)
                for run in runs:
                    wanted[run["place"] - run["back"]:run["place"] + run["ahead"] + 1] = True
                starts = np.flatnonzero(wanted)
                if not len(starts):
                    continue
                prefix = prefix_hash(data)
                g1 = mix((prefix[starts + length] - prefix[starts]) * powers(len(data), True)[starts])
                other = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(mix(data.astype(np.uint64) + _U(977)) * powers(len(data)), out=other[1:])
                g2 = mix((other[starts + length] - other[starts]) * powers(len(data), True)[starts])
                for column, value in zip(found, (g1, g2, np.full(len(starts), batch["t1"][i].as_py(), np.int64),
                                                 np.full(len(starts), batch["t2"][i].as_py(), np.int64), starts), strict=True):
                    column.append(value)
            if not found[0]:
                continue
            g1, g2, t1, t2, starts = (np.concatenate(c) for c in found)
            order = np.lexsort((g2, g1))
            g1, g2, t1, t2, starts = g1[order], g2[order], t1[order], t2[order], starts[order]
            new = np.append(True, (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1]))
            times = np.diff(np.append(np.flatnonzero(new), len(new)))
            several = np.repeat(times > 1, times)
            # One row for the string of several occurrences, and one for each of its occurrences, which count no more.
            rows = np.concatenate([np.flatnonzero(new), np.flatnonzero(several)])
            counted = np.arange(len(rows)) < new.sum()
            votes = np.where(counted, np.where(several[rows], 2, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(g1[rows])), pa.array(signed(g2[rows])), pa.array(t1[rows]), pa.array(t2[rows]),
                 pa.array(starts[rows]), pa.array(votes)], ["g1", "g2", "t1", "t2", "begin", "votes"])

    return strings


class SuffixDedup:
    """Repeats of a corpus and what is left without them."""

    def __init__(
        self, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS, segment: int = SEGMENT
    ):
        self.length, self.gram, self.group_rows, self.segment = length, gram, group_rows, segment
        text = F.coalesce("text", F.lit(""))
        self.texts = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"),
            F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))

    def _copies(self) -> DataFrame:
        """t1, t2 of texts that several rows hold as a whole, with the smallest doc_id among them."""
        return written(
            self.texts.where(F.octet_length("text") >= self.length).groupBy("t1", "t2").agg(
                F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
            .where("n > 1").select("t1", "t2", "first_id", F.lit(True).alias("copied")), "copies")

    def _hits(self, copies: DataFrame) -> DataFrame:
        """t1, t2, text of texts with grams that occur elsewhere, too, and these: `seeds`, and `runs` of hot grams."""
        once = self.texts.where(F.octet_length("text") >= self.length)
        found = written(once.select("t1", "t2", "text").mapInArrow(_seeded(self.length, self.gram, self.segment), _SEED), "seeds")
        # Copies of a text bring the same occurrence again, which alone makes no repeat.
        mark = F.xxhash64("t1", "t2", "place")
        times = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min(mark).alias("low"), F.max(mark).alias("high"))
        times = written(times.where("low != high").select("gram", (F.col("n") > self.group_rows).alias("hot")), "grams")
        found = found.join(times, "gram")
        # Copies send their seeds once.
        of_text = found.groupBy("t1", "t2").agg(
            F.collect_set(F.when(~F.col("hot"), F.struct("gram", "place", "back", "ahead"))).alias("seeds"),
            F.collect_set(F.when(F.col("hot"), F.struct("place", "back", "ahead"))).alias("runs"))
        # Of whole copies only rows with the smallest doc_id stand for the text.
        of_text = of_text.join(copies, ["t1", "t2"], "left").withColumnsRenamed({"t1": "s1", "t2": "s2"})
        hits = once.join(
            written(of_text, "seeds-of-texts"),
            (F.col("t1") == F.col("s1")) & (F.col("t2") == F.col("s2"))
            & (F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id"))))
        return written(hits.select("t1", "t2", "copied", "seeds", "runs", "text"), "hits")

    def _repeats_of(self, hits: DataFrame, merged: bool = False) -> DataFrame:
        around = hits.where(F.size("seeds") > 0).select("t1", "t2", "seeds", "text").mapInArrow(
            _surroundings(self.length), "gram long, t1 long, t2 long, place long, before binary, after binary")
        spans = around.repartition("gram").sortWithinPartitions("gram").mapInArrow(
            _repeats(self.length, merged), "gram long, number int, t1 long, t2 long, begin long, end long")
        strings = written(
            hits.where(F.size("runs") > 0).select("t1", "t2", "runs", "text").mapInArrow(
                _hot_strings(self.length), "g1 long, g2 long, t1 long, t2 long, begin long, votes long"), "hot-strings")
        several = strings.groupBy("g1", "g2").agg(F.sum("votes").alias("n")).where("n > 1").select("g1", "g2")
        hot = strings.where("votes != 2").join(written(several, "hot-several"), ["g1", "g2"]).select(
            F.col("g1").alias("gram"), F.lit(None).cast("int").alias("number"), "t1", "t2", "begin",
            (F.col("begin") + self.length).alias("end"))
        return spans.unionByName(hot)

    def repeats(self) -> DataFrame:
        """gram, number, t1, t2, begin, end: occurrences of maximal repeats, where (gram, number) is the repeat, in the text
        with these hashes; a text that several rows hold is named once. Repeats are seen through the windows around
        their gram; a longer one appears as several that overlap. Strings of hot grams have a null number."""
        return self._repeats_of(self._hits(self._copies()))

    def changed_texts(self) -> tuple[DataFrame, DataFrame]:
        """Texts that lose bytes: (t1, t2, kept, n_removed, n_spans) of texts that one row holds, and the t1, t2 of those that
        several rows hold, which lose all."""
        copies = self._copies()
        hits = self._hits(copies)
        spans = self._repeats_of(hits, merged=True).groupBy("t1", "t2").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
        spans = written(spans.withColumnsRenamed({"t1": "s1", "t2": "s2"}), "spans")
        own = hits.where("copied IS NULL").join(spans, (F.col("t1") == F.col("s1")) & (F.col("t2") == F.col("s2")))
        kept = own.select("t1", "t2", "text", "spans").mapInArrow(_kept, "t1 long, t2 long, kept binary, n_removed long, n_spans long")
        return kept, copies.select("t1", "t2")

    def documents(self) -> DataFrame:
        """doc_id, kept (bytes), n_removed, n_spans of every row."""
        kept, copies = self.changed_texts()
        none = F.unhex(F.lit(""))
        lost = copies.select("t1", "t2", none.alias("kept"), F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"))
        rows = self.texts.join(kept.unionByName(lost), ["t1", "t2"], "left")
        return rows.select(
            "doc_id", F.coalesce("kept", "text").alias("kept"),
            F.when(F.col("kept").isNull(), 0).otherwise(F.coalesce("n_removed", F.octet_length("text"))).cast("long").alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"))

    def digests(self) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans, kept_sha256, changed of every row: `documents` without moving unchanged texts."""
        kept, copies = self.changed_texts()
        kept = kept.select("t1", "t2", F.sha2("kept", 256).alias("sha"), "n_removed", "n_spans")
        nothing = F.sha2(F.unhex(F.lit("")), 256)
        lost = copies.select("t1", "t2", nothing.alias("sha"), F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"))
        changed = written(kept.unionByName(lost), "changed")
        rows = self.texts.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
        rows = rows.join(changed, ["t1", "t2"], "left")
        return rows.select(
            "doc_id", "n_bytes", F.when(F.col("sha").isNull(), 0).otherwise(F.coalesce("n_removed", "n_bytes")).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"),
            (F.coalesce("n_spans", F.lit(0)) > 0).alias("changed"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, runs = [], [], []
        for i, spans in enumerate(batch["spans"].to_pylist()):
            text = batch["text"][i].as_buffer().to_pybytes()
            parts, at, n = [], 0, 0
            for begin, end in sorted((s["begin"], s["end"]) for s in spans):
                if begin > at or n == 0:
                    parts.append(text[at:begin])
                    n += 1
                at = max(at, end)
            kept.append(b"".join([*parts, text[at:]]))
            removed.append(len(text) - len(kept[-1]))
            runs.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch["t1"], batch["t2"], pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
            ["t1", "t2", "kept", "n_removed", "n_spans"])
