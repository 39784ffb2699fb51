"""Scoring texts by a causal self-attention model on subword ids, beside a unigram base.

Tokens of the base are words, lower-cased (A-Z), and one end per text. Words are counted over all training texts; the base
gives a token log10((c + 1) / (N + V + 1)).

The model reads the same tokens as subword ids of a public tokenizer, the end being one more id. The `SYMBOLS` - 1 most
frequent ids are symbols of their own, the others share a symbol, within which an id has its add-one share. The attention
model gives each symbol a probability, given the ids before it, and so spells each token. A token's probability is a
mixture of its spelling's and, with weight `WORD_SHARE`, its share of the training tokens; a text's is the product.

* Counting. Each task counts its distinct words and sends one row per word; every distinct word is cut into subwords
  once. Counts of words and ids cover all training texts.
* Training. All training texts are cut into windows. The start is a model of a share of them, about `TRAIN_WINDOWS` times
  the root of the corpus in windows: each partition trains the model it is given on its windows; the models are averaged,
  for `ROUNDS` rounds. Unless that share was everything, each task then takes the start over all windows of its texts,
  once, as they come; the mean of these models, weighted by windows, scores. Training thus costs in proportion to the
  corpus, moves no texts and keeps `PARTITION_WINDOWS` windows at a time.
* Scoring. Texts are dealt into blocks of about `BLOCK_WORDS` words. The distinct words of a block meet their counts and
  ids in a join, which a frequent word enters once per block, and come back to the block. Windows of `CONTEXT` ids overlap;
  each id is scored once.

Cases: a null or empty text is its end alone; repeated rows get equal scores; a null doc_id is not held out; without
training texts the counts are zero and the model is uniform; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import importlib.util
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from aduana.llm import attention_model as attention
from aduana.llm.common import pieces, prefix_hash, range_hash, signed, word_ranges, written
from aduana.llm.quality_classifier import held_out

#: Folder of public tokenizer files and the file used; both are parameters.
TOKENIZER_FOLDER = "/opt/tokenizers"
TOKENIZER_FILE = "byte_bpe_multi_50k.tiktoken"
BLOCK_WORDS = 2_000_000
TRAIN_WINDOWS = 40
ROUNDS = 3
PARTITION_WINDOWS = 6000
RATE = 0.02
#: Windows of a step in the pass over all windows.
PASS_BATCH = 192
#: Part of a token's probability that is its share of the training tokens; the model spells the rest.
WORD_SHARE = 0.3
_LN10 = math.log(10)
_FLUSH = 1_000_000
_COUNT_PIECE = 1 << 22
_CUT_PIECE = 1 << 20
_CUT_WORDS = 1 << 14
_SUMS = "part int, n long, sums binary"


class Subwords:
    """Subword ids of single words; the end of a text is the id after the tokenizer's."""

    def __init__(self, folder: str, file: str):
        import tiktoken

        with open(f"{folder}/{file}", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        # Words hold no blank, so a blank and what follows it is a word, and an id that begins with a blank begins a word.
        self.encoding = tiktoken.Encoding(file, pat_str=r" [^ ]+", mergeable_ranks=ranks, special_tokens={})
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[rank for piece, rank in ranks.items() if piece.startswith(b" ")]] = True
        self.end = max(ranks.values()) + 1
        self.n_ids = self.end + 1

    def flat_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of each word's."""
        ids = [np.zeros(0, np.uint16)]
        for k in range(0, len(words), _CUT_WORDS):
            own = b" " + b" ".join(words[k:k + _CUT_WORDS])
            ids.append(np.array(self.encoding.encode_ordinary(own.decode("utf-8", "replace")), np.uint16))
        flat = np.concatenate(ids)
        return flat, np.diff(np.append(np.flatnonzero(self.opens[flat]), len(flat)))

    def ids(self, words: list[str]) -> list[list[int]]:
        flat, sizes = self.flat_ids([w.encode() for w in words])
        return [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] if words else []


_loaded: dict[tuple[str, str], Subwords] = {}


def subwords(folder: str, file: str) -> Subwords:
    """The tokenizer, read once per Python process."""
    if (folder, file) not in _loaded:
        _loaded[folder, file] = Subwords(folder, file)
    return _loaded[folder, file]


def cut_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a binary array, lower-cased."""
    sizes = ends - starts
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    flat = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n, word): distinct words of a task, with their number in training texts."""
    kept: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, pa.Array]:
        hashes, first, back = np.unique(np.concatenate([k[0] for k in kept]), return_index=True, return_inverse=True)
        counts = np.bincount(back, np.concatenate([k[1] for k in kept]), len(hashes)).astype(np.int64)
        return hashes, counts, pa.concat_arrays([k[2] for k in kept]).take(pa.array(first))

    def record(hashes: np.ndarray, counts: np.ndarray, words: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(counts), words], ["hash", "n", "word"])

    for batch in batches:
        training = ~np.array(batch["held_out"].to_pylist(), bool)
        for row, last_row, data, offsets in pieces(batch["text"], _COUNT_PIECE):
            starts, ends, first = word_ranges(data, offsets)
            hashed = range_hash(prefix_hash(data, lower=True), starts, ends)
            weight = np.repeat(training[row:last_row], np.diff(first))
            hashes, at, back = np.unique(hashed, return_index=True, return_inverse=True)
            kept.append((hashes, np.bincount(back, weight, len(hashes)).astype(np.int64), cut_out(data, starts[at], ends[at])))
        if sum(len(k[0]) for k in kept) > 2 * _FLUSH:
            kept = [merged()]
            if len(kept[0][0]) > _FLUSH:
                yield record(*kept[0])
                kept = []
    if kept:
        yield record(*merged())


def _binaries(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Two-byte values as a binary array of so many values each."""
    offsets = np.append(0, 2 * np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _with_ids(folder: str, file: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = subwords(folder, file)
        for batch in batches:
            flat, sizes = tokenizer.flat_ids(batch["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["hash"], batch["n"], _binaries(flat, sizes)], ["hash", "n", "ids"])

    return cut


def word_table(texts: DataFrame, folder: str = TOKENIZER_FOLDER, file: str = TOKENIZER_FILE) -> DataFrame:
    """hash, n, ids of every distinct word of texts (held_out, text); n counts training texts only."""
    words = texts.select("held_out", "text").mapInArrow(_counted_words, "hash long, n long, word binary")
    words = words.groupBy("hash").agg(F.sum("n").alias("n"), F.max("word").alias("word"))
    return written(words.mapInArrow(_with_ids(folder, file), "hash long, n long, ids binary"), "words")


def id_counts(words: DataFrame, n_ids: int) -> np.ndarray:
    """Occurrences of each subword id in training texts; the ids are as many as the tokenizer has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            sizes = np.array([len(x) // 2 for x in batch["ids"].to_pylist()], np.int64)
            ids = np.frombuffer(b"".join(batch["ids"].to_pylist()), np.uint16)
            total += np.bincount(ids, np.repeat(batch["n"].to_numpy(), sizes), n_ids).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    out = np.zeros(n_ids)
    for row in words.where("n > 0").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


class Symbols:
    """Symbol of each id, and log10 of the id's share of its symbol. Symbols are in the order of the ids' bytes, so that
    a group holds word starts or word parts that look alike; the shared symbol is the last but one, the end the last."""

    def __init__(self, counts: np.ndarray, token_bytes: Callable[[int], bytes]):
        n, end = attention.SYMBOLS, len(counts) - 1
        frequent = np.argsort(-counts[:end], kind="stable")[:n - 2]
        self.of_id = np.full(len(counts), n - 2, np.int32)
        self.of_id[sorted(frequent.tolist(), key=token_bytes)] = np.arange(n - 2)
        self.of_id[end] = n - 1
        others = self.of_id == n - 2
        self.share = np.where(others, np.log10((counts + 1) / (counts[others].sum() + others.sum())), 0.0)
        totals = np.bincount(self.of_id, counts, n) + 1
        self.totals = totals / totals.sum()


class WordSymbols:
    """Symbols of the distinct words that a task has met, found by the words' hashes; each is cut into subwords once."""

    def __init__(self, tokenizer: Subwords, symbols: Symbols):
        self.tokenizer, self.symbols = tokenizer, symbols
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words in the byte ranges, where their symbols start in `flat`, and how many they are."""
        distinct, at, back = np.unique(range_hash(prefix_hash(data, lower=True), starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > _FLUSH:
            self.clear()
        place = np.searchsorted(self.hashes, distinct)
        new = np.append(self.hashes, np.uint64(0))[place] != distinct
        new[place == len(self.hashes)] = True
        if new.any():
            flat, sizes = self.tokenizer.flat_ids(cut_out(data, starts[at[new]], ends[at[new]]).to_pylist())
            self.starts = np.insert(self.starts, place[new], len(self.flat) + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, place[new], sizes)
            self.hashes = np.insert(self.hashes, place[new], distinct[new])
            self.flat = np.append(self.flat, self.symbols.of_id[flat].astype(np.uint16))
        found = np.searchsorted(self.hashes, distinct)
        return self.starts[found][back], self.sizes[found][back]


def _sequences(folder: str, file: str, symbols: Symbols):
    """Windows of training texts: symbols from the one before the first on, CONTEXT + 1 in a row; 65535 after the end."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = subwords(folder, file)
        words = WordSymbols(tokenizer, symbols)
        for batch in batches:
            for _, _, data, offsets in pieces(batch["text"], _CUT_PIECE):
                starts, ends, first = word_ranges(data, offsets)
                start, size = words.of(data, starts, ends)
                # A text's line: the start, the symbols of its words, the end.
                last = np.append(0, np.cumsum(size))
                bounds = last[first] + 2 * np.arange(len(first))
                line, inner = np.empty(bounds[-1], np.uint16), np.ones(bounds[-1], bool)
                line[bounds[:-1]], line[bounds[1:] - 1] = attention.START, symbols.of_id[tokenizer.end]
                inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
                line[inner] = words.flat[np.repeat(start - last[:-1], size) + np.arange(last[-1])]
                # The last window of a text is filled up.
                count = -(-(np.diff(bounds) - 1) // attention.CONTEXT)
                own_end = np.repeat(bounds[1:], count)
                from_ = np.repeat(bounds[:-1] - attention.CONTEXT * (np.cumsum(count) - count), count) + attention.CONTEXT * np.arange(len(own_end))
                for k in range(0, len(own_end), PARTITION_WINDOWS):
                    place = from_[k:k + PARTITION_WINDOWS, None] + np.arange(attention.CONTEXT + 1)
                    rows = np.where(place < own_end[k:k + PARTITION_WINDOWS, None], line[np.minimum(place, len(line) - 1)], np.uint16(65535))
                    yield pa.RecordBatch.from_arrays([_binaries(rows, np.full(len(rows), attention.CONTEXT + 1))], ["window"])

    return cut


def train(texts: DataFrame, words: DataFrame, symbols: Symbols, n_windows: int, folder: str, file: str) -> attention.Parameters:
    """The attention model, from all training texts of (row_hash, held_out, text), about `n_windows` windows."""
    model = attention.initial(symbols.totals)
    if not n_windows:
        return model
    share = min(1.0, TRAIN_WINDOWS * math.sqrt(n_windows) / n_windows)
    chosen = texts.where(~F.col("held_out") & (F.pmod(F.xxhash64(F.lit(5), "row_hash"), F.lit(1_000_000)) < int(share * 1_000_000)))
    cut = chosen.select("text").mapInArrow(_sequences(folder, file, symbols), "window binary")
    # Enough windows for each partition to train on by itself.
    parts = max(1, int(share * n_windows / PARTITION_WINDOWS))
    windows = written(cut.select(F.pmod(F.xxhash64("window"), F.lit(parts)).cast("int").alias("part"), "window"), "windows")
    for round_number in range(ROUNDS):
        model = _averaged(windows, model, round_number)
    return model if share == 1 else _passed(texts, model, symbols, n_windows, folder, file)


def _examples(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, targets and weights of windows."""
    line = np.frombuffer(b"".join(rows), np.uint16).reshape(-1, attention.CONTEXT + 1).astype(np.int64)
    weight = (line[:, 1:] != 65535).astype(np.float32)
    line = np.where(line == 65535, 0, line)
    return line[:, :-1], line[:, 1:], weight


def _summed(part: int, fitted: attention.Parameters, n: int) -> pa.RecordBatch:
    sums = attention.packed(fitted).astype(np.float64) * n
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([sums.tobytes()], pa.binary())], ["part", "n", "sums"])


def _mean(sums: DataFrame, model: attention.Parameters) -> attention.Parameters:
    """The mean of models (part, n, sums), added by part and then in all; `model` if there are none."""
    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in group["sums"])
        n = sum(group["n"].to_pylist())
        return pa.table({"part": pa.array([0], pa.int32()), "n": pa.array([n], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    row = sums.groupBy("part").applyInArrow(added, _SUMS).groupBy().applyInArrow(added, _SUMS).first()
    return model if row is None else attention.unpacked((np.frombuffer(row["sums"]) / row["n"]).astype(np.float32))


def _passed(texts: DataFrame, model: attention.Parameters, symbols: Symbols, n_windows: int, folder: str, file: str) -> attention.Parameters:
    """The mean of the models that tasks make of `model` in one pass over all windows of their training texts."""
    start, cut = attention.packed(model), _sequences(folder, file, symbols)
    groups = max(32, math.isqrt(n_windows // PARTITION_WINDOWS))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, n, rows = attention.unpacked(start), 0, []

        def taken(fitted: attention.Parameters, rows: list[bytes]) -> attention.Parameters:
            steps = -(-len(rows) // PASS_BATCH)
            return attention.train_locally(fitted, *_examples(rows), RATE * 0.6 ** ROUNDS, n + 1, steps, PASS_BATCH)

        for batch in cut(batches):
            rows += batch["window"].to_pylist()
            while len(rows) >= PARTITION_WINDOWS:
                fitted, n, rows = taken(fitted, rows[:PARTITION_WINDOWS]), n + PARTITION_WINDOWS, rows[PARTITION_WINDOWS:]
        if rows:
            fitted, n = taken(fitted, rows), n + len(rows)
        if n:
            yield _summed(TaskContext.get().partitionId() % groups, fitted, n)

    return _mean(texts.where(~F.col("held_out")).select("text").mapInArrow(fit, _SUMS), model)


def _averaged(windows: DataFrame, model: attention.Parameters, round_number: int) -> attention.Parameters:
    """One round: the mean of the models that the partitions make of `model`, weighted by their windows."""
    start = attention.packed(model)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[bytes] = []
        part = 0
        for batch in batches:
            rows += batch["window"].to_pylist()
            part = batch["part"][0].as_py() if batch.num_rows else part
        if rows:
            steps = max(150, len(rows) // 48)
            fitted = attention.train_locally(
                attention.unpacked(start), *_examples(sorted(rows)), RATE * 0.6 ** round_number, round_number + 1, steps)
            yield _summed(part % 32, fitted, len(rows))

    return _mean(windows.repartition("part").mapInArrow(_per_part(fit), _SUMS), model)


def _per_part(fit):
    """A task may hold several parts: each trains a model of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("part", pa.int32()), ("window", pa.binary())]))
        for part in np.unique(table["part"].to_numpy()):
            yield from fit(table.filter(pa.array(table["part"].to_numpy() == part)).to_batches())

    return run


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (block, hash) of a task."""
    kept: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        blocks = batch["block"].to_numpy()
        for row, last_row, data, offsets in pieces(batch["text"], _COUNT_PIECE):
            starts, ends, first = word_ranges(data, offsets)
            hashed = range_hash(prefix_hash(data, lower=True), starts, ends)
            block_of = np.repeat(blocks[row:last_row], np.diff(first))
            for block in np.unique(blocks[row:last_row]):
                own = kept.setdefault(int(block), [])
                own.append(np.unique(hashed[block_of == block]))
                if sum(map(len, own)) > 2 * _FLUSH:
                    kept[int(block)] = [np.unique(np.concatenate(own))]
    for block, parts in kept.items():
        hashes = np.unique(np.concatenate(parts))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), block, np.int32)), pa.array(signed(hashes))], ["block", "hash"])


def _score_block(model: attention.Parameters, symbols: Symbols, end: int, n_tokens: int, n_distinct: int, n_texts: int):
    def score(texts: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(words["hash"].to_numpy(), kind="stable")
        hashes = words["hash"].to_numpy()[order]
        counts = words["n"].to_numpy()[order]
        packed = words["ids"].combine_chunks().take(pa.array(order)) if len(order) else pa.array([], pa.binary())
        packed = packed.cast(pa.binary())
        sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        ids = np.frombuffer(b"".join(packed.to_pylist()), np.uint16).astype(np.int64)
        id_start = np.cumsum(sizes) - sizes
        id_symbol, id_share = symbols.of_id[ids], symbols.share[ids]
        word_share = np.append(0, np.cumsum(id_share))
        word_share = word_share[id_start + sizes] - word_share[id_start]
        scorer, end_symbol = attention.Scorer(model), int(symbols.of_id[end])
        whole, end_log = n_tokens + n_distinct + 1, np.log10((n_texts + 1) / (n_tokens + n_distinct + 1))
        word_log = np.log10((counts + 1) / whole)
        with np.errstate(divide="ignore"):
            word_known = np.log(counts * (WORD_SHARE / max(n_tokens, 1)))
            end_known = np.log(n_texts * (WORD_SHARE / max(n_tokens, 1)))
        out = [[], [], [], []]
        for _, _, data, offsets in pieces(texts["text"]):
            starts, ends, first = word_ranges(data, offsets)
            found = np.searchsorted(hashes, signed(range_hash(prefix_hash(data, lower=True), starts, ends)))
            n_words = np.diff(first)

            def per_text(values: np.ndarray, first: np.ndarray = first) -> np.ndarray:
                return np.diff(np.append(0, np.cumsum(values))[first])

            # Symbols of the words, with the end symbol after each text.
            size = sizes[found]
            last = np.append(0, np.cumsum(size))
            bounds = last[first] + np.arange(len(first))
            line = np.full(bounds[-1], end_symbol, np.int32)
            inner = np.ones(len(line), bool)
            inner[bounds[1:] - 1] = False
            line[inner] = id_symbol[np.repeat(id_start[found] - last[:-1], size) + np.arange(last[-1])]
            logs = scorer.log_probabilities(line, bounds) / np.log(10)
            out[0].append(n_words + 1)
            out[1].append(per_text((counts[found] > 0).astype(np.int64)) + (n_texts > 0))
            out[2].append(per_text(word_log[found]) + end_log)
            inner_logs = np.append(0, np.cumsum(logs[inner]))
            spelled = inner_logs[last[1:]] - inner_logs[last[:-1]] + word_share[found]
            mixed = np.logaddexp(spelled * _LN10 + np.log(1 - WORD_SHARE), word_known[found]) / _LN10
            end_mixed = np.logaddexp(logs[~inner] * _LN10 + np.log(1 - WORD_SHARE), end_known) / _LN10
            out[3].append(per_text(mixed) + end_mixed)
        values = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table([
            texts["doc_id"], texts["held_out"], pa.array(values[0].astype(np.int64)), pa.array(values[1].astype(np.int64)),
            pa.array(np.full(len(values[0]), n_tokens, np.int64)), pa.array(values[2].astype(np.float64)), pa.array(values[3].astype(np.float64))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def lm_scores(docs: DataFrame, folder: str = TOKENIZER_FOLDER, file: str = TOKENIZER_FILE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    if importlib.util.find_spec("tiktoken") is None:
        raise ImportError("lm_scores needs the tiktoken library")
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 7).alias("held_out"), text.alias("text"),
        F.xxhash64("doc_id", text).alias("row_hash"))
    words = word_table(texts, folder, file)
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") > 0).alias("distinct")).first()
    n_texts = texts.where(~F.col("held_out")).count()
    n_tokens, n_distinct = totals["tokens"] + n_texts, totals["distinct"] + (n_texts > 0)
    tokenizer = subwords(folder, file)
    counts = id_counts(words, tokenizer.n_ids)
    counts[tokenizer.end] = n_texts
    symbols = Symbols(counts, tokenizer.encoding.decode_single_token_bytes)
    model = train(texts, words, symbols, int(counts.sum() // attention.CONTEXT), folder, file)
    blocks = int(totals["tokens"] * 7 // 6 // BLOCK_WORDS) + 1
    dealt = texts.select(F.pmod("row_hash", F.lit(blocks)).cast("int").alias("block"), "doc_id", "held_out", "text").repartition("block")
    # All columns, though two are used: texts are then moved once for both uses.
    known = dealt.mapInArrow(_block_words, "block int, hash long").join(words, "hash")
    return dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _score_block(model, symbols, tokenizer.end, n_tokens, n_distinct, n_texts),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
