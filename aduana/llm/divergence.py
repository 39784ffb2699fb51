"""How the sources of a language differ in their terms, with strings kept out of the shuffles.

Terms are runs of letters (A-Z, a-z and all characters beyond ASCII), of which only A-Z are lower-cased. A language keeps the
terms that at least `min_docs` of its documents hold. A group (language, source) and a language give every kept term the
share p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two shares differ by floor((p - q)^2 / (p + q)).

* Late strings. Tasks count terms by 64-bit digests and combine the counts of many documents; the shuffle by digest moves
  digests and numbers only, with languages and groups as digests, too. The strings come afterwards and are kept for kept
  digests only: one more pass over the texts, in which a task has each term of a language once, gives the least and the
  greatest string of each digest. Reports join them to their last candidates.
* Collisions. Where least and greatest differ, one digest stands for several terms. Its counts are dropped and taken again
  by (digest, string), with the string in the shuffle; a term is kept or not by its own documents.
* Ranks of terms are cut by value first, ties included, before strings are joined that decide ties.
* Pairs of sources are compared in blocks of terms: a block holds the shares of all sources for its terms as a matrix and
  gives one sum per pair. A language has as many rows of pairs as the result has; terms are never paired with each other.
  Shares of terms that a source lacks are filled in within the block.

Cases: null language, source and text are ''; a group without terms is listed in pairs, and has no terms; if a language
keeps no term, its pairs have the value 0; repeated rows are documents of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from aduana.llm.common import pieces, prefix_hash, range_hash, signed, word_ranges, written

MIN_DOCS = 10
TOP = 10
#: Rows of distinct (group, term) that a task combines before it sends them on.
HELD_ROWS = 1 << 20
#: Kept (group, term) counts per block of terms, about; and cells of a matrix handled at once.
BLOCK_ROWS = 1 << 18
CELLS = 1 << 21

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_COUNTS = "l long, g long, digest long, docs long, n long"
_BILLION = "CAST(1000000000 AS DECIMAL(10, 0))"


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First index of each run of equal rows."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lower-cased byte ranges as a string array."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(_LOWER[data[at]]))).cast(pa.string())


def _combined(parts: list[tuple]) -> tuple:
    """Parts of (l, g, h1, h2, docs, n, terms or None) as one, with equal terms of a group added up."""
    columns = [np.concatenate(c) for c in list(zip(*parts, strict=True))[:6]]
    terms = None if parts[0][6] is None else pa.concat_arrays([p[6] for p in parts])
    order = np.lexsort((columns[3], columns[2], columns[1]))
    l, g, h1, h2, docs, n = (c[order] for c in columns)
    heads = _runs(g, h1, h2)
    if not len(heads):
        return l, g, h1, h2, docs, n, terms
    return (l[heads], g[heads], h1[heads], h2[heads], np.add.reduceat(docs, heads), np.add.reduceat(n, heads),
            None if terms is None else terms.take(pa.array(order[heads])))


def _counted(digest_bits: int, strings: bool):
    """(l, g, digest, docs, n[, term]): documents and occurrences of terms by group, combined over many documents."""
    shift = np.uint64(64 - digest_bits)

    def piece_counts(data: np.ndarray, offsets: np.ndarray, l: np.ndarray, g: np.ndarray) -> tuple:
        starts, ends, first = word_ranges(data, offsets, _LETTERS)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        h1, h2 = (range_hash(prefix_hash(data, True, seed), starts, ends) for seed in (0, 1))
        order = np.lexsort((row, h2, h1))
        row, h1, h2 = row[order], h1[order], h2[order]
        heads = _runs(h1, h2, row)
        n = np.diff(np.append(heads, len(row)))
        row, h1, h2 = row[heads], h1[heads], h2[heads]
        terms = _strings(data, starts[order[heads]], ends[order[heads]]) if strings else None
        return l[row], g[row], h1, h2, np.ones(len(heads), np.int64), n, terms

    def batch_of(part: tuple) -> pa.RecordBatch:
        l, g, h1, _, docs, n, terms = part
        columns = [pa.array(l), pa.array(g), pa.array(signed(h1 >> shift)), pa.array(docs), pa.array(n)]
        names = ["l", "g", "digest", "docs", "n"]
        if strings:
            columns, names = [*columns, terms], [*names, "term"]
        return pa.RecordBatch.from_arrays(columns, names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            l, g = (batch[c].to_numpy(zero_copy_only=False) for c in ("l", "g"))
            for begin, end, data, offsets in pieces(batch["text"]):
                held.append(_combined([piece_counts(data, offsets, l[begin:end], g[begin:end])]))
                if sum(len(p[0]) for p in held) > HELD_ROWS:
                    held = [_combined(held)]
                    if len(held[0][0]) > HELD_ROWS // 2:
                        yield batch_of(held.pop())
        if held:
            yield batch_of(_combined(held))

    return counted


def _pair_sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of one block of a language: `left` has the shares (g, digest, split, p), `right` all its groups with p0, the
    share of a term that the group lacks."""
    groups = right["g"].to_numpy()
    order = np.argsort(groups)
    groups, absent = groups[order], right["p0"].to_numpy()[order]
    size = len(groups)
    sums = np.zeros((size, size), np.int64)
    if left.num_rows and size > 1:
        digest, split = left["digest"].to_numpy(), left["split"].combine_chunks().dictionary_encode().indices.to_numpy()
        by_term = np.lexsort((split, digest))
        new = np.zeros(len(by_term), np.int64)
        new[_runs(digest[by_term], split[by_term])[1:]] = 1
        term = np.cumsum(new)
        source, p = np.searchsorted(groups, left["g"].to_numpy()[by_term]), left["p"].to_numpy()[by_term]
        width = max(1, CELLS // size)
        for low in range(0, int(term[-1]) + 1, width):
            a, b = np.searchsorted(term, [low, low + width])
            shares = np.repeat(absent[:, None], min(width, int(term[-1]) + 1 - low), 1)
            shares[source[a:b], term[a:b] - low] = p[a:b]
            for k in range(size - 1):
                gap = shares[k + 1:] - shares[k]
                gap *= gap
                gap //= shares[k + 1:] + shares[k]
                sums[k, k + 1:] += gap.sum(1)
    one, other = np.triu_indices(size, 1)
    return pa.table({
        "l": pa.array(np.full(len(one), right["l"][0].as_py(), np.int64)), "g": pa.array(groups[one]),
        "h": pa.array(groups[other]), "value": pa.array(sums[one, other])})


def _share(count: str, total: str) -> str:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact beyond 64 bits."""
    return f"1 + ({_BILLION} * CAST({count} + 2 AS DECIMAL(20, 0))) div CAST({total} + 2 * terms AS DECIMAL(20, 0))"


_DIFFERENCE = "((p - q) * (p - q)) div (p + q)"


class SourceDivergence:
    """Kept terms of each language, and how its sources differ in them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, digest_bits: int = 64):
        self.min_docs, self.digest_bits = min_docs, digest_bits
        self.docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
        self.groups, self.seed = self._groups()
        self.dictionary: DataFrame | None = None
        self.kept = self._kept()

    def _keys(self, seed: int) -> tuple[Column, Column]:
        return F.xxhash64(F.lit(seed), "lang").alias("l"), F.xxhash64(F.lit(seed), "lang", "source").alias("g")

    def _groups(self) -> tuple[DataFrame, int]:
        """lang, source, l, g of every group: two strings become two fixed-width keys, under a seed without collisions."""
        names = written(self.docs.select("lang", "source").distinct(), "source-groups")
        seed = 0
        while True:
            groups = names.select("lang", "source", *self._keys(seed))
            by_lang = groups.groupBy("l").agg(F.min("lang").alias("low"), F.max("lang").alias("high")).where("low <> high")
            by_group = groups.groupBy("g").count().where("count > 1")
            if by_lang.isEmpty() and by_group.isEmpty():
                return groups, seed
            seed += 1

    def _counts(self, strings: bool = False, by_lang: bool = False) -> DataFrame:
        """Counts of terms by group (or by language, with `by_lang`), as far as tasks combine them."""
        l, g = self._keys(self.seed)
        return self.docs.select(l, l.alias("g") if by_lang else g, "text").mapInArrow(
            _counted(self.digest_bits, strings), _COUNTS + (", term string" if strings else ""))

    def _enough(self, counts: DataFrame, key: list[str]) -> DataFrame:
        """Counts by term and group, of terms in enough documents of the language, with the language's count. `first` marks
        one row of each term. One shuffle, by term."""
        summed = counts.repartition(*key).groupBy(*key, "g").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
        term = Window.partitionBy(*key)
        found = summed.select(
            "*", F.sum("docs").over(term).alias("holders"), F.sum("n").over(term).alias("all_n"),
            (F.min("g").over(term) == F.col("g")).alias("first"))
        return found.where(F.col("holders") >= self.min_docs).drop("docs", "holders")

    def _kept(self) -> DataFrame:
        """l, digest, split, g, n, all_n, first: occurrences of kept terms by group. `split` is '' or, for a digest of several
        terms, the term. Sets `dictionary`: l, digest, split, term."""
        key, plain = ["l", "digest"], F.lit("").alias("split")
        pooled = written(self._enough(self._counts(), key), "term-counts")
        digests = written(pooled.where("first").select(*key), "term-digests")
        ends = self._counts(strings=True, by_lang=True).join(digests, key, "left_semi").groupBy(*key).agg(
            F.min("term").alias("term"), F.max("term").alias("last"))
        ends = written(ends, "term-strings")
        single, several = ends.where("term = last"), ends.where("term <> last").select(*key)
        self.dictionary = single.select(*key, plain, "term")
        if several.isEmpty():
            return pooled.withColumn("split", plain)
        counts = self._counts(strings=True).join(several, key, "left_semi").withColumnRenamed("term", "split")
        apart = written(self._enough(counts, [*key, "split"]), "terms-apart")
        self.dictionary = self.dictionary.unionByName(apart.where("first").select(*key, "split", F.col("split").alias("term")))
        return pooled.join(several, key, "left_anti").withColumn("split", plain).unionByName(apart)

    def shares(self) -> tuple[DataFrame, DataFrame]:
        """Groups with totals and the share of a term they lack (null where no term is kept), and terms with p and q."""
        totals = self.kept.groupBy("g").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
        groups = self.groups.join(totals, "g", "left").na.fill(0, ["total", "firsts"])
        langs = groups.groupBy("l").agg(F.sum("firsts").alias("terms"), F.sum("total").alias("lang_total"))
        groups = groups.join(langs, "l").withColumn("p0", F.expr(f"if(terms = 0, NULL, {_share('0', 'total')})"))
        groups = written(groups, "group-shares")
        terms = self.kept.join(groups.select("g", "total", "terms", "lang_total"), "g").selectExpr(
            "l", "digest", "split", "g", f"{_share('n', 'total')} AS p", f"{_share('all_n', 'lang_total')} AS q")
        return groups, written(terms, "term-shares")

    def term_ranks(self, terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
        """lang, source, item, value, rank: the `top` terms by which a group exceeds its language."""
        above = terms.where("p > q").selectExpr("l", "digest", "split", "g", f"{_DIFFERENCE} AS value")
        # Ties stay until the strings are there that decide them.
        by_value = Window.partitionBy("g").orderBy(F.desc("value"))
        ahead = above.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top).drop("place")
        named = ahead.join(self.dictionary, ["l", "digest", "split"])
        order = Window.partitionBy("g").orderBy(F.desc("value"), "term")
        best = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        return best.join(groups.select("g", "lang", "source"), "g").select(
            "lang", "source", F.col("term").alias("item"), "value", "rank")

    def pair_ranks(self, terms: DataFrame, groups: DataFrame) -> DataFrame:
        """lang, source, item, value, rank: all other sources of the language, the most different one first."""
        blocks = terms.count() // BLOCK_ROWS + 1
        block = F.pmod(F.xxhash64("digest", "split"), F.lit(blocks)).alias("block")
        left = terms.select("l", block, "digest", "split", "g", "p")
        every = groups.select(
            "l", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "g",
            F.coalesce("p0", F.lit(0)).alias("p0"))
        sums = left.groupBy("l", "block").cogroup(every.groupBy("l", "block")).applyInArrow(
            _pair_sums, "l long, g long, h long, value long")
        sums = sums.groupBy("l", "g", "h").agg(F.sum("value").alias("value")).select("g", "h", "value")
        both = sums.unionByName(sums.selectExpr("h AS g", "g AS h", "value"))
        one = groups.select("g", "lang", "source")
        other = groups.selectExpr("g AS h", "source AS item")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return both.join(one, "g").join(other, "h").select(
            "lang", "source", "item", "value", F.row_number().over(order).alias("rank"))

    def report(self, top: int = TOP) -> DataFrame:
        """lang, source, part, item, value, rank: all pairs of sources, and the first terms of each group."""
        groups, terms = self.shares()
        pairs = self.pair_ranks(terms, groups).withColumn("part", F.lit("pair"))
        best = self.term_ranks(terms, groups, top).withColumn("part", F.lit("term"))
        return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
