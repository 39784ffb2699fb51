"""Mixing, sharding, quality rules, quality classifier and decontamination."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import edit_distance_within, held_out, rule_counts, targets, words
from conftest import bag, edge_rows, pairs_of, prose

from aduana.llm import decontamination, mixing, quality_classifier, quality_rules, sharding
from aduana.llm.common import filtered_rows, pieces, word_hashes

# --- mixing ----------------------------------------------------------------------------------------------------------


def sizes_of(docs) -> list[tuple]:
    return [(r.doc_id, r.source, len(words(r.text))) for r in docs.select("doc_id", "source", "text").collect()]


def check_mix(rows, docs) -> dict:
    sizes = sizes_of(docs)
    by_source = defaultdict(int)
    for _, source, size in sizes:
        by_source[source] += size
    wanted, taken = targets(by_source), defaultdict(int)
    assert bag((r.doc_id, r.source, r.size) for r in rows) == bag(sizes)
    for r in rows:
        assert r.source_size == by_source[r.source] and r.target == pytest.approx(wanted[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    return {s: (taken[s], wanted[s]) for s in by_source}


def test_mix(documents, edge):
    for docs in (documents, edge):
        rows = mixing.mixed_sizes(docs).collect()
        # Equal rows of one id are one unit, so a source's units are not larger than twice its largest document here.
        largest = defaultdict(int)
        for _, source, size in sizes_of(docs):
            largest[source] = max(largest[source], 2 * size)
        for source, (taken, wanted) in check_mix(rows, docs).items():
            assert abs(taken - wanted) <= largest[source]


def test_mix_repeats_and_depends_on_the_seed(documents):
    first = bag(mixing.mixed_sizes(documents).collect())
    assert first == bag(mixing.mixed_sizes(documents.repartition(7)).collect())
    assert first != bag(mixing.mixed_sizes(documents, seed=12).collect())


def test_mix_of_a_hot_source_over_several_levels(spark):
    rng = random.Random(4)
    rows = [(k, " ".join("w" * rng.randrange(1, 30)), "a" if k % 10 else "b") for k in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = mixing.mixed_sizes(docs).collect()
    assert all(abs(taken - wanted) <= 29 for taken, wanted in check_mix(found, docs).values())
    # Extra copies are spread evenly over sizes: a half of the documents of a source by any size.
    extra = Counter((r.size, r.taken // r.size) for r in found if r.source == "a" and r.size)
    share = [extra[s, 2] / (extra[s, 2] + extra[s, 1]) for s in range(1, 29)]
    mean = sum(share) / len(share)
    assert max(abs(x - mean) for x in share) < 0.2


def test_rounding_keeps_expectations(spark):
    """Over many seeds each of a few documents is taken as often as its fraction says."""
    rows = [(k, " ".join(["w"] * (3 * k + 5)), "a" if k < 8 else "b") for k in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).cache()
    times, mean = Counter(), {}
    for seed in range(0, 800, 100):
        for r in mixing.mixed_sizes(docs, seed).collect():
            times[r.doc_id] += r.taken // r.size
            mean[r.doc_id] = r.target / r.source_size
    assert all(abs(times[d] / 8 - mean[d]) < 0.7 for d in mean)


def test_repeated_rows_are_rounded_by_their_number(spark):
    """Of many equal rows as many get a further copy as the target asks for, and so of equal ids and sizes with other texts."""
    rows = [(k, " ".join(f"w{k}" for _ in range(k % 300 + 1)), "a") for k in range(300)]
    rows += [(1000, " ".join(["same"] * 100), "a")] * 200 + [(2000, " ".join([f"t{k % 7}"] * 40), "a") for k in range(90)]
    rows += [(5000 + k, " ".join(["x"] * 50), s) for s in "bc" for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mixed_sizes(docs).collect()
    assert all(abs(taken - wanted) <= 300 for taken, wanted in check_mix(found, docs).values())
    taken = Counter()
    for r in found:
        taken[r.doc_id, r.source, r.size] += r.taken
    assert any(0 < taken[d, "a", s] % (n * s) for d, s, n in ((1000, 100, 200), (2000, 40, 90)))
    mixed = Counter()
    for r in mixing.mixture(docs).collect():
        mixed[r.doc_id, r.source, len(words(r.text))] += len(words(r.text))
    assert +mixed == +taken


def test_mixture_takes_whole_rows(edge, nothing):
    taken = Counter()
    for r in mixing.mixed_sizes(edge).collect():
        taken[r.doc_id, r.source, r.size] += r.taken
    rows = mixing.mixture(edge)
    assert rows.columns == edge.columns
    found = Counter()
    for r in rows.collect():
        found[r.doc_id, r.source, len(words(r.text))] += len(words(r.text))
    assert +found == +taken
    assert mixing.mixture(nothing).collect() == mixing.mixed_sizes(nothing).collect() == []


# --- sharding --------------------------------------------------------------------------------------------------------


def filled_by_hand(n_shards: int, size: int) -> list[int]:
    """Each shard writes its whole order down first; in turn they take their first slot not yet taken."""
    orders = []
    for s in range(n_shards):
        start, step = sharding._number(f"start:{s}") % size, sharding._number(f"step:{s}") % (size - 1) + 1
        orders.append([(start + j * step) % size for j in range(size)])
    table = {}
    while len(table) < size:
        shard = len(table) % n_shards
        table[next(slot for slot in orders[shard] if slot not in table)] = shard
    return [table[k] for k in range(size)]


def test_table():
    for n, size in ((1, 2), (3, 7), (7, 101), (32, 1009)):
        table = sharding.lookup_table(n, size)
        assert table == filled_by_hand(n, size)
        counts = Counter(table)
        assert len(counts) == n and max(counts.values()) - min(counts.values()) <= 1
    one_more = sharding.lookup_table(33, 4099)
    moved = sum(a != b for a, b in zip(sharding.lookup_table(32, 4099), one_more, strict=True))
    assert moved < 4099 * 0.25
    for n, size in ((0, 7), (9, 7), (3, 9), (3, 1)):
        with pytest.raises(ValueError, match="prime"):
            sharding.lookup_table(n, size)


def test_place(spark, edge, nothing, documents):
    docs = edge.drop("slot", "shard_id")
    table = sharding.lookup_table(5, 101)
    placed = sharding.place(spark, docs, 5, 101)
    assert placed.columns == [*docs.columns, "slot", "shard_id"]
    for r in placed.collect():
        assert r.slot == sharding._number("" if r.doc_id is None else str(r.doc_id)) % 101 and r.shard_id == table[r.slot]
    assert placed.count() == len(edge_rows())
    assert sharding.place(spark, nothing.drop("slot", "shard_id")).collect() == []
    with pytest.raises(ValueError, match="slot"):
        sharding.place(spark, edge)


# --- quality rules ---------------------------------------------------------------------------------------------------


def test_rule_counts(edge, documents):
    for docs in (edge, documents):
        found = quality_rules.quality_verdicts(docs, None).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept").collect()
        expected = []
        for doc_id, text in pairs_of(docs):
            counts = rule_counts(text)
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            expected.append((doc_id, *counts, failed, not failed))
        assert bag(found) == bag(expected)


@pytest.mark.parametrize("seed", range(30))
def test_rule_counts_of_random_texts(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(["a", "b", " ", "\n", "é", "#", "👍", "\t", "the "]) for _ in range(rng.randrange(60))) for _ in range(20)]
    counts = np.concatenate([quality_rules.piece_counts(d, o) for _, _, d, o in pieces(pa.array(texts), 50)])
    assert [tuple(r) for r in counts] == [rule_counts(t) for t in texts]


def test_rules_learn_from_labels(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    learned, tested = labels.where("doc_id % 3 != 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    model = quality_rules.train(docs, learned)
    rows = [r for r in quality_rules.quality_verdicts(docs, model).collect() if r.doc_id in tested and not r.base_failed]
    assert np.mean([r.kept == (tested[r.doc_id] == 1) for r in rows]) > 0.97
    assert model.tobytes() == quality_rules.train(docs.repartition(5), learned).tobytes()
    kept = quality_rules.keep_good(docs, model)
    assert kept.schema == docs.schema
    verdicts = {r.doc_id for r in quality_rules.quality_verdicts(docs, model).where("kept").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == verdicts


def test_rules_without_labels(spark, edge, nothing):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_rules.train(edge, labels) is None and quality_rules.train(nothing, labels) is None
    assert quality_rules.keep_good(edge, None).columns == edge.columns
    assert quality_rules.keep_good(nothing, None).collect() == []


def test_quality_fit_makes_no_second_copy_of_the_features():
    rng = np.random.default_rng(3)
    n, dense = 1200, 1200 * quality_rules.FEATURES * 4
    labels = np.arange(n) % 2
    bins = [np.sort(rng.choice(quality_rules.FEATURES, 400, replace=False)).astype(np.uint16) for _ in range(n)]
    weights = [np.full(400, 0.05, np.float32) + np.float32(0.01 * label) * (b < 4000) for b, label in zip(bins, labels, strict=True)]
    rows = pa.table({"doc_id": np.arange(n), "label": labels, "bins": [b.tobytes() for b in bins],
                     "weights": [w.astype(np.float32).tobytes() for w in weights]})
    tracemalloc.start()
    try:
        model = quality_rules._fit(rows)["model"][0].as_py()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * dense
    # The margins are those of one product over all rows.
    features = rng.normal(size=(600, 8)).astype(np.float32)
    fitted, fold = rng.normal(size=(9, 4)), np.arange(600) % 3
    whole = (features @ fitted[:-1] + fitted[-1])[np.arange(600), fold]
    assert np.allclose(quality_rules._own_margins(features, fitted, fold), whole, rtol=1e-12)
    assert len(model) == 8 * (quality_rules.FEATURES + 2)


def _feature_rows(n: int, seed: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Labels, and of each row 400 bins with weights that depend on the label; one row has none."""
    rng = np.random.default_rng(seed)
    labels = np.arange(n) % 2
    bins = [np.sort(rng.choice(quality_rules.FEATURES, 400, replace=False)).astype(np.uint16) for _ in range(n)]
    weights = [(0.05 + 0.01 * label * (b < 4000)).astype(np.float32) for b, label in zip(bins, labels, strict=True)]
    bins[5], weights[5] = bins[5][:0], weights[5][:0]
    return labels, bins, weights


def test_quality_fit_holds_some_rows_dense_at_a_time():
    n = 1200
    labels, bins, weights = _feature_rows(n, 4)
    rows = pa.table({"doc_id": np.arange(n), "label": labels, "bins": [b.tobytes() for b in bins],
                     "weights": [w.tobytes() for w in weights]})
    tracemalloc.start()
    try:
        quality_rules._fit(rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < n * quality_rules.FEATURES * 4 / 4


def test_quality_fit_by_blocks_takes_the_steps_of_all_rows():
    n = 3 * 64 + 7
    labels, bins, weights = _feature_rows(n, 5)
    dense = np.zeros((n, quality_rules.FEATURES))
    for row, b, w in zip(dense, bins, weights, strict=True):
        row[b] = w
    members = np.stack([np.arange(n) % 3 != 0, np.ones(n, bool)], 1)
    at = before = np.zeros((quality_rules.FEATURES + 1, 2))
    for t in range(20):
        ahead = at + t / (t + 3) * (at - before)
        error = (1 / (1 + np.exp(-(dense @ ahead[:-1] + ahead[-1]))) - labels[:, None]) * members / members.sum(0)
        step = np.concatenate([dense.T @ error + 1e-4 * ahead[:-1], error.sum(0, keepdims=True)])
        before, at = at, ahead - step / (0.5 + 1e-4)
    fitted = quality_rules.fit_logistic(quality_rules.FeatureRows(bins, weights), labels, members, 20)
    assert np.allclose(fitted, at, rtol=1e-3, atol=1e-6)


def test_quality_rows_reach_workers_in_bounded_batches(spark):
    # 40 rows of 1 MB: the default batch holds 64 MB.
    docs = spark.range(40).coalesce(1).selectExpr("id AS doc_id", "repeat('abcdefg ', 131072) AS text")

    rows = filtered_rows(docs.select("doc_id", "text"), lambda batches: batches)
    assert rows.count() == 40
    counted = [r["n"] for r in docs.mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long").collect()]
    assert sum(counted) == 40 and max(counted) <= 5


# --- quality classifier ----------------------------------------------------------------------------------------------


def test_classifier(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_classifier.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == held_out(r.doc_id, 4) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    tested = [(r.score, quality[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = [s for s, y, _ in tested if y], [s for s, y, _ in tested if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9 and np.mean([p == y for _, y, p in tested]) > 0.95
    # Held-out labels have no part in the scores.
    flipped = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 4 = 2, 1 - quality, quality) AS quality", "toxic")
    again = {r.doc_id: r.score for r in quality_classifier.quality_scores(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in rows)


def test_classifier_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, None, 0), (12, 0, 0), (101, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_classifier.quality_scores(edge, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality_classifier.quality_scores(edge, labels.where("false")).collect()} == {0.5}
    assert quality_classifier.quality_scores(nothing, labels).collect() == []


def test_isotonic():
    rng = np.random.default_rng(0)
    for _ in range(50):
        counts, totals = rng.integers(1, 9, 12).astype(float), rng.random(12)
        fitted = quality_classifier.isotonic(counts, totals * counts)
        assert (np.diff(fitted) >= -1e-12).all() and (fitted * counts).sum() == pytest.approx((totals * counts).sum())
        # The max-min formula of the same fit.
        means = lambda a, b: (totals[a:b + 1] * counts[a:b + 1]).sum() / counts[a:b + 1].sum()
        assert fitted == pytest.approx([max(min(means(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)])


# --- decontamination -------------------------------------------------------------------------------------------------


def items_and_documents(edits: float = 0.1, seed: int = 1):
    rng = random.Random(seed)
    items = [(k, prose(rng.randrange(12, 70), 500 + k)) for k in range(60)]
    docs = []
    for k, text in items:
        w = text.split()
        for _ in range(int(edits * len(w))):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], ["edited"], [w[at], "added"]])
        around = prose(120, 900 + k).split()
        docs.append((k, " ".join([*around[:rng.randrange(60)], *w, *around[60:]])))
    return items, docs + [(1000 + k, prose(150, 2000 + k)) for k in range(40)]


@pytest.mark.parametrize(("edits", "recall"), [(0.0, 1.0), (0.1, 0.95)])
def test_passages_are_found(spark, edits, recall):
    items, docs = items_and_documents(edits)
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all(r.doc_id == r.item_id for r in found)
    assert len({r.doc_id for r in found}) >= recall * len(items)
    texts = dict(docs)
    for r in found:
        pattern = words(items[r.item_id][1])
        assert r.distance == edit_distance_within(pattern, words(texts[r.doc_id])) <= 0.2 * len(pattern)
        assert r.distance == edit_distance_within(pattern, words(texts[r.doc_id])[r.first_word:r.last_word + 1])


def test_all_matches_of_brute_force(spark, documents, sf_dir):
    """Every document against every item by the full distance: nothing missed, nothing added."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents, benchmark).collect()}
    expected = set()
    docs = [(d, words(t)) for d, t in pairs_of(documents)]
    for item in benchmark.collect():
        pattern = words(item.text)
        for doc_id, w in docs:
            # Without most of its words the item cannot be there.
            if sum((Counter(pattern) & Counter(w)).values()) >= 0.8 * len(pattern) and (
                    edit_distance_within(pattern, w) <= int(0.2 * len(pattern))):
                expected.add((doc_id, item.item_id))
    assert found == expected


def passages_with_all_edits(n: int, spread: bool):
    """Items of n words, and texts that hold them with as many edits as they allow, spread evenly or at random."""
    rng, allowed = random.Random(n), int(0.2 * n)
    items, texts = [[rng.getrandbits(64) for _ in range(n)] for _ in range(200)], []
    for words_ in items:
        w = list(words_)
        at = [int((k + 0.5) * n / allowed) for k in range(allowed)] if spread else rng.sample(range(n), allowed)
        for place in sorted(at, reverse=True):
            w[place:place + 1] = rng.choice([[], [rng.getrandbits(64)], [w[place], rng.getrandbits(64)]])
        texts.append([*(rng.getrandbits(64) for _ in range(rng.randrange(90))), *w, *(rng.getrandbits(64) for _ in range(50))])
    return items, texts


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("n", [10, 15, 23, 24, 30, 59, 60, 120, 240])
def test_recall_at_a_fifth_of_edits(n, spread):
    """Keys of item and document meet, at a place that the edits allow, for at least 95% of passages of each size."""
    items, texts = passages_with_all_edits(n, spread)
    words_of = np.array([w for t in texts for w in t], np.uint64)
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    keys, at = (np.concatenate(x) for x in zip(*decontamination.document_keys(words_of, first, [decontamination.walk_of(n)], []), strict=True))
    text = np.searchsorted(first, at, "right") - 1
    found = 0
    for k, item in enumerate(items):
        own, _ = decontamination.item_keys(np.array(item, np.uint64))
        found += bool(np.isin(keys[text == k], own).any())
    assert found >= 0.95 * len(items)


@pytest.mark.parametrize("n", range(1, 10))
def test_short_items_are_never_missed(spark, documents, n):
    items, texts = passages_with_all_edits(n, spread=False)
    items = [(k, " ".join(map(str, w))) for k, w in enumerate(items[:20])]
    docs = [(k, " ".join(map(str, w))) for k, w in enumerate(texts[:20])] + [(20, items[0][1].split()[0])]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(k, k) for k in range(20)} <= {(r.doc_id, r.item_id) for r in found} <= {(k, k) for k in range(20)} | {(20, 0)}


def test_two_passages_of_one_document_both_match(spark):
    item, apart = prose(40, 1), prose(3, 2)
    docs = spark.createDataFrame([(1, f"{item} {apart} {item}"), (2, f"{item} {item}")], "doc_id long, text string")
    found = decontamination.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert bag(found) == [(1, 7, 0, 0, 39), (1, 7, 0, 43, 82), (2, 7, 0, 0, 39), (2, 7, 0, 40, 79)]


def test_best_match_is_the_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        pattern = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 20))]
        distance, a, b = decontamination.best_match(np.array(pattern), np.array(text, np.int64))
        assert distance == edit_distance_within(pattern, text) == edit_distance_within(pattern, text[a:b])


def test_walks_turn_edits_into_few_differences():
    """Windows with an edit have equal keys far more often than the share of words that it leaves in place would let them."""
    rng, walk = random.Random(3), decontamination.WALKS[1]
    for kind in ("replace", "insert", "delete"):
        agree = total = 0
        for _ in range(200):
            w = [rng.getrandbits(64) for _ in range(2 * walk.size)]
            v, place = list(w), rng.randrange(walk.size)
            v[place:place + 1] = {"replace": [rng.getrandbits(64)], "insert": [rng.getrandbits(64), w[place]], "delete": []}[kind]
            a, b = (list(decontamination.walk_keys(np.array(x, np.uint64), np.array([0]), np.array([len(x)]), walk)) for x in (w, v))
            both = [(x[0], y[0]) for x, y in zip(a, b, strict=True) if x[0] and y[0]]
            agree, total = agree + sum(x == y for x, y in both), total + len(both)
        assert agree / total > 0.15


def test_a_full_key_table_gives_the_same(spark, monkeypatch):
    items, docs = items_and_documents()
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = bag(decontamination.contaminated(docs, items).collect())
    monkeypatch.setattr(decontamination, "TABLE_BITS", 256)
    assert bag(decontamination.contaminated(docs, items).collect()) == whole
    dirty = {r[0] for r in whole}
    assert {r.doc_id for r in decontamination.clean_documents(docs, items).collect()} == {
        r.doc_id for r in docs.collect()} - dirty


def test_documents_are_read_once_whatever_the_items(spark, tmp_path):
    """The look-up of windows is one scan; the second one takes the few texts to be verified."""
    items, docs = items_and_documents()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs"))
    t1, t2 = decontamination._text_keys(read["text"])
    items = decontamination.benchmark_items(spark.createDataFrame(items, "item_id long, text string"))
    plan = decontamination.text_matches(read.select(t1.alias("t1"), t2.alias("t2"), "text"), items)
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [text") == 1


def test_decontamination_edges(spark, edge, nothing):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "one two"), (None, prose(300, 1)), (5, prose(30000, 2)), (5, prose(30000, 2))], "item_id long, text string")
    found = decontamination.contaminated(edge, items).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.item_id != 3} == {(1, None), (2, None), (3, None), (4, None), (11, 5), (16, None)} - {
        (16, None)} | {(r.doc_id, r.item_id) for r in found if r.doc_id == 16}
    assert {r.doc_id for r in found if r.item_id == 3} == {9, 10}
    clean = decontamination.clean_documents(edge, items)
    assert clean.columns == edge.columns and not {1, 2, 3, 4, 9, 10, 11} & {r.doc_id for r in clean.select("doc_id").collect()}
    assert decontamination.contaminated(nothing, items).collect() == decontamination.clean_documents(nothing, items).collect() == []
    assert decontamination.contaminated(edge, items.where("false")).collect() == []
    assert decontamination.clean_documents(edge, items.where("false")).count() == len(edge_rows())


def test_word_hashes_tell_words_apart():
    texts = [None, "", " a\tB\nb  é ", "Ab aB ab"]
    (_, _, data, offsets), = pieces(pa.array(texts))
    hashed, first = word_hashes(data, offsets)
    assert first.tolist() == [0, 0, 0, 4, 7]
    assert hashed[1] == hashed[2] != hashed[0] and hashed[4] == hashed[5] == hashed[6] and len(set(hashed[[0, 1, 3, 4]].tolist())) == 4
