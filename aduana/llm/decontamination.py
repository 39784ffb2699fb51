"""Benchmark decontamination: random walks that turn edits into few differences, bit-sampled keys of item-sized windows, and
exact edit verification.

Texts are sequences of words, lower-cased (A-Z). An item of n words matches within `floor(MAX_EDITS * n)` edits.

* Walks. A walk reads a window from its first word on; at each step a coin of the word and the step decides whether it goes
  on to the next word. Two walks over windows that differ by few edits soon stand at equal words again, so their steps
  differ in few places (the embedding of Chakraborty, Goldenberg and Koucky).
* Keys. Of the steps a few are sampled; the words there are one key, if enough of them differ to say something. `WALKS` has,
  by the items' size, the window's size, steps, samples and the number of repetitions, each with coins and samples of its own. Items give keys of the windows at
  all their words, documents at every `STRIDE`-th word: a passage holds several such windows, more the longer it is.
  The numbers are those with which, measured, at least 95% of passages with a fifth of edits are found (the tests
  measure it, for edits at random and spread evenly).
* Shorter items than `SHORT` words are looked up by runs of words, one more than the edits they allow: one of them stands
  there unedited, so none is missed.
* Documents are read once, whatever the number of items: keys go through a bit table of the items' keys of bounded size,
  and what passes is joined with the items by key. The table only saves rows; if it fills up, the join sees more of them.
* A candidate is verified exactly: the item against the words around the place, free at both ends, by bit-parallel edit
  distance. Texts that several rows hold are looked up and verified once.

Cases: null and empty texts and items match nothing; null item ids are allowed; repeated items and documents each match; empty
tables give no matches; `clean_documents` keeps all columns of the rows, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from aduana.functions.frames import quoted
from aduana.llm.common import bounded_batches, mix, pieces, shingle_hashes, signed, word_hashes, written

MAX_EDITS = 0.2
#: Documents' windows begin at every so many words.
STRIDE = 4
#: Bits per key of the table of keys, and its most bits (16 MB).
KEY_BITS = 64
TABLE_BITS = 1 << 27
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


class Walk(NamedTuple):
    """Windows of items of at least `least` words."""

    least: int
    size: int
    steps: int
    samples: int
    #: Different words that the samples of a key must have.
    words: int
    repetitions: int


WALKS = (Walk(10, 6, 8, 4, 3, 12), Walk(24, 8, 12, 4, 4, 12), Walk(60, 12, 16, 4, 4, 8))
SHORT = WALKS[0].least


def allowed_edits(n_words: int) -> int:
    return int(MAX_EDITS * n_words)


def walk_of(n_words: int) -> int:
    """Number of the walk of an item."""
    return max(k for k, walk in enumerate(WALKS) if n_words >= walk.least)


def sampled_steps(walk: Walk, repetition: int) -> list[int]:
    return sorted(np.random.default_rng([walk.size, repetition]).choice(walk.steps, walk.samples, replace=False).tolist())


def walk_keys(words: np.ndarray, starts: np.ndarray, limits: np.ndarray, walk: Walk) -> Iterator[np.ndarray]:
    """Per repetition a key for each start; 0 where the walk had left its window, or its text at `limits`, at a sampled step:
    blanks say nothing about the text."""
    padded = np.append(words, np.zeros(walk.steps + 1, np.uint64))
    ends = np.minimum(starts + walk.size, limits)
    turns = 64 // walk.steps
    for repetition in range(walk.repetitions):
        if repetition % turns == 0:
            # One draw has the coins of several repetitions.
            coins = mix(padded + _U(((walk.size << 32) + repetition + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))
        sampled = sampled_steps(walk, repetition)
        at, keys, left = starts.copy(), np.full(len(starts), walk.size * 1000 + repetition, np.uint64), np.zeros(len(starts), bool)
        seen: list[np.ndarray] = []
        fresh = np.zeros(len(starts), np.int8)
        for step in range(sampled[-1] + 1):
            if step in sampled:
                left |= at >= ends
                word = padded[at]
                keys = mix(keys * _U(_STEP) + word)
                fresh += ~np.logical_or.reduce([word == other for other in seen]) if seen else np.int8(1)
                seen.append(word)
            if step < sampled[-1]:
                at += ((coins[at] >> _U(repetition % turns * walk.steps + step)) & _U(1)).astype(at.dtype)
        keys[left | (fresh < walk.words)] = 0
        yield keys


def run_bounds(n_words: int) -> np.ndarray:
    """Bounds of the runs of a short item: one run more than the edits it allows, so that one run at least has no edit."""
    runs = allowed_edits(n_words) + 1
    return np.arange(runs + 1) * n_words // runs


def run_keys(words: np.ndarray, length: int) -> np.ndarray:
    """Keys of the runs of `length` words."""
    return mix(shingle_hashes(words, length) + _U(length))


def item_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of an item, and the word that each belongs to."""
    if len(words) < SHORT:
        bounds = run_bounds(len(words))
        parts = [(run_keys(words[a:b], int(b - a)), np.array([a])) for a, b in zip(bounds, bounds[1:], strict=False)]
    else:
        starts = np.arange(len(words))
        walk = WALKS[walk_of(len(words))]
        parts = [(keys, starts) for keys in walk_keys(words, starts, np.full(len(words), len(words)), walk)]
    keys, places = (np.concatenate(x) for x in zip(*parts, strict=True))
    return keys[keys != 0], places[keys != 0]


def document_keys(words: np.ndarray, first: np.ndarray, walks: list[int], runs: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of consecutive texts by the walks and run lengths in use, and the words that they belong to."""
    counts = np.diff(first)
    windows = -(-counts // STRIDE)
    starts = np.repeat(first[:-1], windows) + STRIDE * (np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows))
    limits = np.repeat(first[1:], windows)
    for number in walks:
        for keys in walk_keys(words, starts, limits, WALKS[number]):
            yield keys[keys != 0], starts[keys != 0]
    for length in runs:
        keys = run_keys(words, length)
        at = np.arange(len(keys))
        inside = at + length <= first[np.searchsorted(first, at, "right").clip(max=len(first) - 1)]
        yield keys[inside], at[inside]


def best_match(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the pattern to a part of the text, with begin and end of the first such part."""
    def distances(p: list[int], t: list[int], free: bool) -> list[int]:
        masks: dict[int, int] = {}
        for k, w in enumerate(p):
            masks[w] = masks.get(w, 0) | 1 << k
        full, top = (1 << len(p)) - 1, 1 << (len(p) - 1)
        plus, minus, score, out = full, 0, len(p), [len(p)]
        for w in t:
            equal = masks.get(w, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up, down = (minus | ~(horizontal | plus)) & full, plus & horizontal
            score += bool(up & top) - bool(down & top)
            up = (up << 1) | (0 if free else 1)
            down <<= 1
            plus, minus = (down | ~(vertical | up)) & full, up & vertical & full
            out.append(score)
        return out

    p, t = pattern.tolist(), text.tolist()
    ends = distances(p, t, True)
    least = min(ends)
    end = ends.index(least)
    starts = distances(p[::-1], t[:end][::-1], False)
    return least, end - starts.index(min(starts)), end


def matches_around(words: np.ndarray, pattern: np.ndarray, begins: list[int]) -> list[tuple[int, int, int]]:
    """(distance, first word, last word + 1) of the parts of a text that match an item which would begin at one of `begins`,
    give or take its edits. Parts do not overlap."""
    allowed, n = allowed_edits(len(pattern)), len(pattern)
    spans: list[tuple[int, int]] = []
    for begin in sorted(begins):
        low, high = max(0, begin - 2 * allowed), min(len(words), begin + n + 2 * allowed)
        if spans and begin <= spans[-1][2] + allowed:
            spans[-1] = (spans[-1][0], high, spans[-1][2])
        else:
            spans.append((low, high, begin))
    found: set[tuple[int, int, int]] = set()
    open_ = [span[:2] for span in spans]
    while open_:
        low, high = open_.pop()
        # Each word of the item that the document lacks here costs an edit.
        if high - low < n - allowed or np.isin(words[low:high], pattern).sum() < n - allowed:
            continue
        distance, a, b = best_match(pattern, words[low:high])
        if distance <= allowed:
            found.add((distance, low + a, low + b))
            # A candidate of several places has room for a further match.
            open_ += [(low, low + a), (low + b, high)]
    taken: list[tuple[int, int, int]] = []
    for match in sorted(found):
        if all(match[2] <= a or b <= match[1] for _, a, b in taken):
            taken.append(match)
    return taken


# --- Spark -----------------------------------------------------------------------------------------------------------

def _hashed_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = []
        for _, _, data, offsets in pieces(batch["text"]):
            hashed, first = word_hashes(data, offsets)
            words += [hashed[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(words, pa.binary())], ["item_id", "words"])


def _keys_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, words in zip(batch["item"].to_pylist(), batch["words"].to_pylist(), strict=True):
            keys, places = item_keys(np.frombuffer(words, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(keys), pa.string()), pa.array(signed(keys)), pa.array(places.astype(np.int32))],
                ["item", "key", "offset"])


def _slots(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The two bits of a key in a table of `bits` bits, a power of two."""
    yield (keys & _U(bits - 1)).astype(np.int64)
    yield ((keys >> _U(32)) & _U(bits - 1)).astype(np.int64)


def key_table(keys: DataFrame) -> np.ndarray:
    """Bits of all keys of the items, at most `TABLE_BITS` of them, gathered as 64-bit words."""
    n = keys.count()
    bits = 64
    while bits < min(TABLE_BITS, KEY_BITS * n):
        bits *= 2
    low, high = f"key & {bits - 1}", f"shiftrightunsigned(key, 32) & {bits - 1}"
    slots = keys.selectExpr(f"explode(array({low}, {high})) AS slot")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(slot & 63)))").alias("bits"))
    found = words.toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def _windows(table: np.ndarray, walks: list[int], runs: list[int]):
    """Windows of texts whose key is in the table; a text that a batch holds several times counts once."""
    bits = 64 * len(table)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch["t1"].to_numpy(), batch["t2"].to_numpy()
            once = np.unique(np.stack([t1, t2], 1), axis=0, return_index=True)[1]
            t1, t2, texts = t1[once], t2[once], batch["text"].take(pa.array(once))
            for begin, _, data, offsets in pieces(texts):
                words, first = word_hashes(data, offsets)
                found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                for keys, at in document_keys(words, first, walks, runs):
                    known = np.ones(len(keys), bool)
                    for slot in _slots(keys, bits):
                        known &= (table[slot >> 6] >> (slot & 63).astype(np.uint64)) & _U(1) == 1
                    found.append((keys[known], at[known]))
                keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
                text = np.searchsorted(first, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(keys)), pa.array(t1[begin + text]), pa.array(t2[begin + text]), pa.array((at - first[text]).astype(np.int32))],
                    ["key", "t1", "t2", "place"])

    return windows


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, listed = [], batch["items"].to_pylist()
        for row, _, data, offsets in pieces(batch["text"]):
            hashed, first = word_hashes(data, offsets)
            for k, (a, b) in enumerate(zip(first, first[1:], strict=False), row):
                for item in listed[k]:
                    for distance, begin, end in matches_around(hashed[a:b], np.frombuffer(item["words"], np.uint64), item["begins"]):
                        rows.append((batch["t1"][k].as_py(), batch["t2"][k].as_py(), item["item"], distance, begin, end - 1))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["t1", "t2", "item", "distance", "first_word", "last_word"])


_MATCH = "t1 long, t2 long, item string, distance int, first_word long, last_word long"


def _text_keys(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a text stand for it."""
    known = F.coalesce(text, F.lit(""))
    return F.xxhash64(known), F.xxhash64(F.lit(1), known)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, item (a digest of its words), words of every item that has any."""
    bounded_batches(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_hashed_items, "item_id long, words binary")
    return written(items.where("octet_length(words) > 0").select("item_id", F.md5("words").alias("item"), "words"), "items")


def text_matches(texts: DataFrame, items: DataFrame) -> DataFrame:
    """t1, t2, item, distance, first_word, last_word of each distinct text of (t1, t2, text) that matches an item."""
    distinct = items.select("item", "words").dropDuplicates(["item"])
    sizes = distinct.selectExpr("octet_length(words) div 8 AS n").selectExpr(
        f"least(n, {WALKS[-1].least}) AS n").distinct().collect()  # A few dozen numbers.
    walks = sorted({walk_of(r["n"]) for r in sizes if r["n"] >= SHORT})
    runs = sorted({int(x) for r in sizes if r["n"] < SHORT for x in np.diff(run_bounds(r["n"]))})
    if not sizes:
        return texts.sparkSession.createDataFrame([], _MATCH)
    keys = written(distinct.mapInArrow(_keys_of_items, "item string, key long, offset int"), "item-keys")
    windows = texts.mapInArrow(_windows(key_table(keys), walks, runs), "key long, t1 long, t2 long, place int").distinct()
    hits = windows.join(keys, "key").select("t1", "t2", "item", (F.col("place") - F.col("offset")).alias("begin"))
    begins = hits.groupBy("t1", "t2", "item").agg(F.collect_set("begin").alias("begins"))
    listed = begins.join(distinct, "item").groupBy("t1", "t2").agg(F.collect_list(F.struct("item", "words", "begins")).alias("items"))
    listed = written(listed, "candidates")
    near = texts.join(written(listed.select("t1", "t2"), "candidate-texts"), ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"])
    return near.join(listed, ["t1", "t2"]).mapInArrow(_verified, _MATCH)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, first_word, last_word of every match."""
    t1, t2 = _text_keys(F.col("text"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t1.alias("t1"), t2.alias("t2"), "text")
    items = benchmark_items(benchmark)
    matches = written(text_matches(texts.drop("doc_id"), items), "text-matches")
    return texts.select("doc_id", "t1", "t2").join(matches, ["t1", "t2"]).join(items.select("item_id", "item"), "item").select(
        "doc_id", "item_id", "distance", "first_word", "last_word")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that match no item, with all their columns."""
    t1, t2 = _text_keys(F.col("text"))
    matches = text_matches(docs.select(t1.alias("t1"), t2.alias("t2"), "text"), benchmark_items(benchmark))
    dirty = written(matches.select(F.struct("t1", "t2").alias("__dirty__")).distinct(), "dirty-texts")
    whole = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("__row__"))
    t1, t2 = _text_keys(F.col("__row__")["text"])
    kept = whole.join(dirty, (F.col("__dirty__")["t1"] == t1) & (F.col("__dirty__")["t2"] == t2), "left_anti")
    return kept.select("__row__.*")
