"""Line dedup, shingle join and suffix dedup against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import jaccard_components, line_dedup as lines_by_hand, repeats
from conftest import DOCUMENTS, bag, edge_rows, pairs_of, prose

from aduana.llm import line_dedup, suffix_dedup
from aduana.llm.components import connected_components
from aduana.llm.jaccard_join import JaccardJoin, allowed_difference, block_keys, parity_sketch
from aduana.llm.suffix_dedup import SuffixDedup


def deduped(index, docs):
    return bag(line_dedup.dedup_lines(index, docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())


def test_lines(spark, edge, documents):
    for docs in (edge, documents):
        index = line_dedup.insert_documents(line_dedup.empty_index(spark), docs)
        assert deduped(index, docs) == bag(lines_by_hand(pairs_of(docs)))


def test_lines_are_reversible(spark, documents):
    whole = line_dedup.insert_documents(line_dedup.empty_index(spark, n_shards=4), documents.where("doc_id % 2 = 0"))
    whole = line_dedup.insert_documents(whole, documents.where("doc_id % 2 = 1"))
    left = documents.where("doc_id % 3 != 0")
    less = line_dedup.delete_documents(whole, documents.where("doc_id % 3 = 0").select("doc_id"))
    assert deduped(whole, documents) == bag(lines_by_hand(pairs_of(documents)))
    assert deduped(less, left) == bag(lines_by_hand(pairs_of(left)))
    again = line_dedup.insert_documents(less, documents.where("doc_id % 3 = 0"))
    assert bag(again.counts.collect()) == bag(whole.counts.collect())
    assert {r.shard: r.n_keys for r in again.filters.collect()} == {r.shard: r.n_keys for r in whole.filters.collect()}


def test_no_lines(spark, nothing):
    index = line_dedup.insert_documents(line_dedup.empty_index(spark), nothing)
    assert deduped(index, nothing) == []


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    table, overflow = np.zeros((1024, line_dedup.SLOTS), np.uint16), np.zeros(0, np.uint64)
    overflow = line_dedup.cuckoo_insert(table, overflow, keys)
    assert line_dedup.cuckoo_contains(table, overflow, keys).all()
    others = rng.integers(0, 2**63, 20000, dtype=np.uint64)
    assert line_dedup.cuckoo_contains(table, overflow, others).mean() < 0.002
    overflow = line_dedup.cuckoo_delete(table, overflow, keys[:1500])
    assert line_dedup.cuckoo_contains(table, overflow, keys[1500:]).all()
    assert line_dedup.cuckoo_contains(table, overflow, keys[:1500]).mean() < 0.002
    overflow = line_dedup.cuckoo_delete(table, overflow, keys[1500:])
    assert not table.any() and not len(overflow)
    # More keys than places: what finds none is kept aside.
    small, aside = np.zeros((16, line_dedup.SLOTS), np.uint16), np.zeros(0, np.uint64)
    aside = line_dedup.cuckoo_insert(small, aside, keys[:100])
    assert line_dedup.cuckoo_contains(small, aside, keys[:100]).all() and len(aside) == 100 - np.count_nonzero(small)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_components(edge, documents, n, percent):
    for docs in (edge, documents):
        found = JaccardJoin(docs, n, percent).documents().select("doc_id", "n_shingles", "component_id").collect()
        assert bag(found) == bag(jaccard_components(pairs_of(docs), n, percent))


def test_chains_and_clouds_of_near_copies(spark):
    """Copies at every distance around the threshold, so that links, hubs and components disagree."""
    rng, base = random.Random(3), prose(80, 9).split()
    rows = []
    for k in range(120):
        text = list(base if k % 3 else rows[rng.randrange(len(rows))][1].split() if rows else base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = JaccardJoin(docs, 4, 85).documents().select("doc_id", "n_shingles", "component_id").collect()
    assert bag(found) == bag(jaccard_components(rows, 4, 85))


def test_linked_sets_share_a_block():
    rng = np.random.default_rng(5)
    for size in (1, 2, 5, 8, 9, 20, 26, 27, 80, 81, 242, 700):
        for _ in range(40):
            common = rng.integers(0, 2**63, size, dtype=np.uint64)
            for extra in {0, 1, size // 12, size * 15 // 100}:
                other = np.unique(np.concatenate([common, rng.integers(0, 2**63, extra, dtype=np.uint64)]))
                one = np.unique(common[rng.integers(0, 3):]) if rng.integers(0, 2) else np.unique(common)
                both = len(np.intersect1d(one, other))
                if not len(one) or 100 * both < 85 * (len(one) + len(other) - both):
                    continue
                assert len(np.intersect1d(block_keys(one, 85), block_keys(other, 85)))
                apart = np.unpackbits((parity_sketch(one) ^ parity_sketch(other)).view(np.uint8)).sum()
                assert apart <= len(one) + len(other) - 2 * both <= allowed_difference(len(one), len(other), 85)


def test_no_components(nothing):
    assert JaccardJoin(nothing).documents().collect() == []


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (103, 101), (7, 7), (200, 200)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 103: 100}


@pytest.mark.parametrize("group_rows", [suffix_dedup.GROUP_ROWS, 2])
def test_repeats(spark, edge, group_rows):
    """With two rows to a group nearly all grams are hot: both ways give the same."""
    small = [r for r in edge_rows() if r[0] != 11]
    docs = spark.createDataFrame(small, DOCUMENTS).repartition(3)
    for length, gram in ((60, 16), (400, 64)):
        found = SuffixDedup(docs, length, gram, group_rows)
        expected = bag(repeats([r[:2] for r in small], length))
        assert bag(found.digests().select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == expected
    assert bag((r.doc_id, len(r.kept) + r.n_removed, r.n_removed, r.n_spans) for r in found.documents().collect()) == bag(
        r[:4] for r in expected)


def test_repeats_of_documents(documents, edge, nothing):
    found = SuffixDedup(documents).digests().drop("changed")
    assert bag(found.collect()) == bag(repeats(pairs_of(documents), 400))
    assert len(SuffixDedup(edge).digests().drop("changed").collect()) == len(edge_rows())
    assert SuffixDedup(nothing).digests().drop("changed").collect() == [] == SuffixDedup(nothing).documents().collect()


def test_repeats_cover_what_is_removed(documents):
    """The occurrences of all maximal repeats, put together, are the bytes that go."""
    found = SuffixDedup(documents)
    sizes = {(r.t1, r.t2): 0 for r in found.texts.collect()}
    spans = {}
    for r in found.repeats().collect():
        spans.setdefault((r.t1, r.t2), set()).update(range(r.begin, r.end))
    assert {k: len(v) for k, v in spans.items()} == {(r.t1, r.t2): r.n_removed for r in found.changed_texts()[0].collect()} | {
        k: len(v) for k, v in spans.items() if k in {(r.t1, r.t2) for r in found.changed_texts()[1].collect()}}
    assert set(spans) <= set(sizes)


def test_maximal_repeats_report_all_occurrences():
    texts = [b"xxABCDEFyy", b"zzABCDEFww", b"qqABCDEFyy", b"BCDE"]
    point = [t.index(b"CD") for t in texts]
    found = suffix_dedup.maximal_repeats([t[:p][::-1] for t, p in zip(texts, point, strict=True)], [t[p:] for t, p in zip(texts, point, strict=True)], 4)
    named = {(texts[o[0]][point[o[0]] - a:point[o[0]] + b], tuple(sorted(o))) for a, b, o in found}
    assert named == {(b"BCDE", (0, 1, 2, 3)), (b"ABCDEF", (0, 1, 2)), (b"ABCDEFyy", (0, 2))}


def test_long_texts_are_cut_into_segments():
    rng = np.random.default_rng(2)
    data, offsets = rng.integers(0, 256, 5000, dtype=np.uint8), np.array([0, 700, 700, 5000])
    whole = suffix_dedup.seeds(data, offsets, 100, 16)
    parts = suffix_dedup.seeds(data, offsets, 100, 16, segment=300)

    def chosen(found):
        return {(int(s), int(p)) for p, _, a, b in zip(*found, strict=True) for s in range(a, b + 1)}

    assert chosen(whole) == chosen(parts) and len(chosen(whole)) == 700 - 99 + 4300 - 99


@pytest.mark.parametrize("group_rows", [1 << 16, 1])
def test_repeats_across_the_cuts_of_a_text(spark, documents, group_rows):
    """Passages of all lengths at all distances from the cuts, in texts of many segments."""
    rng = random.Random(6)

    def noise(n):
        return "".join(rng.choices("abcdefghij", k=n))

    passages = [noise(rng.randrange(60, 260)) for _ in range(40)]
    texts = ["".join(x for p in rng.sample(passages, 20) for x in (noise(rng.randrange(10, 200)), p)) for _ in range(6)]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in enumerate(texts)], DOCUMENTS)
    found = SuffixDedup(docs, length=50, gram=16, group_rows=group_rows, segment=300).digests()
    assert found.where("changed <> (n_removed > 0)").isEmpty()
    assert bag(found.drop("changed").collect()) == bag(repeats(pairs_of(docs), 50))
