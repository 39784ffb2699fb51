"""Passage dedup, divergence audit and manifest against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from brute import divergence, manifest, passages
from conftest import DOCUMENTS, bag, pairs_of, prose

from aduana.llm import debruijn, merkle
from aduana.llm.debruijn import PassageDedup
from aduana.llm.divergence import SourceDivergence
from aduana.llm.merkle import Manifest


def removed(docs, **options) -> list[tuple]:
    return bag(PassageDedup(docs, **options).documents().collect())


# --- passages --------------------------------------------------------------------------------------------------------

def test_passages(edge, documents):
    for docs in (edge, documents):
        assert removed(docs) == bag(passages(pairs_of(docs), 13))


def test_no_passages(nothing):
    assert removed(nothing) == []


def woven(n: int = 60, words: int = 9) -> list[tuple]:
    """Texts over few words, which branch and loop all the time, of runs that others hold, too."""
    rng = random.Random(4)
    runs = [[f"w{rng.randrange(words)}" for _ in range(rng.randrange(3, 30))] for _ in range(12)]
    texts = [" ".join(w for _ in range(rng.randrange(1, 6)) for w in rng.choice(runs)) for _ in range(n)]
    return [(k * 7 % n, t, "en", "a", 1) for k, t in enumerate(texts)]


@pytest.mark.parametrize("size", [3, 13])
def test_passages_in_a_graph_full_of_branches_and_loops(spark, documents, size):
    docs = spark.createDataFrame(woven(), DOCUMENTS)
    assert removed(docs, size=size) == bag(passages(pairs_of(docs), size))


def test_edges_whose_hashes_lie(spark, documents):
    """With four bits nearly all edges have the same hash: verification finds out and takes wider ones."""
    docs = spark.createDataFrame(woven(), DOCUMENTS)
    found = PassageDedup(docs, edge_bits=4)
    assert bag(found.documents().collect()) == bag(passages(pairs_of(docs), 13))
    assert not found._verified(found._verifiable(found._compacted(found._candidates(), wide=False)))


def test_paths_name_equal_spans(spark, documents):
    docs = spark.createDataFrame(woven(), DOCUMENTS)
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    found = PassageDedup(docs)
    paths = found.paths().collect()
    assert paths
    for p in paths:
        assert p.from_id < p.doc_id
        assert texts[p.doc_id][p.place:p.place + p.n + 12] == texts[p.from_id][p.from_place:p.from_place + p.n + 12]
    cover = {}
    for p in paths:
        for k in range(p.n):
            cover[p.from_id, p.from_place + k] = cover.get((p.from_id, p.from_place + k), 0) + 1
    assert cover == {(u.from_id, u.place + k): u.copies for u in found.unitigs().collect() for k in range(u.n)}


def test_texts_are_shuffled_once(spark, documents, monkeypatch):
    """Edges and spans are read from the same shuffle of the texts."""
    found = PassageDedup(documents)
    candidates = found._candidates()
    monkeypatch.setattr(debruijn, "written", lambda df, name: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = found._verifiable(found._compacted(candidates, wide=False))
        assert read.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    done = read._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"ReusedExchange \[doc_id#[^]]*text#", done)


def test_many_copies_of_a_passage_and_of_a_document(spark, documents):
    same, passage = prose(200, 9).replace("\n", " "), prose(30, 10).replace("\n", " ")
    rows = [(k, same if k % 3 == 0 else f"{prose(20, 100 + k)} {passage} {prose(15, 900 + k)}", "en", "a", 1) for k in range(300)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(7)
    assert removed(docs) == bag(passages(pairs_of(docs), 13))


def test_seeds_in_a_stream(spark):
    """Only rows of routes with company or known to have some leave the stream, wherever batches end."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    route = np.sort(rng.integers(0, 40, 60))
    known = rng.random(60) < 0.1
    rows = pa.RecordBatch.from_pydict({"route": route, "seed": route, "doc_id": np.arange(60), "salt": np.zeros(60, int), "known": known})
    times = np.bincount(route, minlength=40)
    for step in (1, 2, 7, 60):
        out = debruijn._several(iter([rows.slice(k, step) for k in range(0, 60, step)]))
        found = sorted(x for b in out for x in b["doc_id"].to_pylist())
        assert found == [k for k in range(60) if times[route[k]] > 1 or known[k]]


# --- divergence ------------------------------------------------------------------------------------------------------

def reported(docs, **options) -> list[tuple]:
    return bag(SourceDivergence(docs, **options).report().collect())


def audited(docs, min_docs: int) -> list[tuple]:
    return bag(divergence([tuple(r) for r in docs.select("lang", "source", "text").collect()], min_docs))


def test_divergence(edge, documents, nothing):
    assert reported(documents) == audited(documents, 10)
    assert reported(edge, min_docs=2) == audited(edge, 2)
    assert reported(edge, min_docs=1000) == audited(edge, 1000)
    assert reported(nothing) == []


def test_divergence_when_digests_collide(documents, edge):
    """With six bits all digests stand for several terms, which are told apart by their strings."""
    assert reported(documents, digest_bits=6) == audited(documents, 10)
    assert reported(edge, min_docs=2, digest_bits=3) == audited(edge, 2)


def test_divergence_ties(spark, documents):
    """More equal values than ranks: the strings decide, in the order of their bytes."""
    letters = [chr(97 + k) for k in range(20)] + ["Z", "é", "日本", "Straße"]
    rows = [(k, " ".join(letters) if k % 2 else "plain Text", "en", "ab"[k % 2], 1) for k in range(24)]
    rows += [(50, None, "en", None, 1), (51, "1 2 3", None, "x", 1), (52, "", None, "y", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    assert reported(docs) == audited(docs, 10)


# --- manifest --------------------------------------------------------------------------------------------------------

def proven(docs) -> list[tuple]:
    return bag(Manifest(docs).documents().collect())


def by_hand(docs) -> list[tuple]:
    return bag(manifest([tuple(r) for r in docs.select(*merkle.COLUMNS).collect()]))


def test_manifest(edge, documents):
    for docs in (edge, documents):
        assert proven(docs) == by_hand(docs)


def test_no_manifest(nothing):
    assert Manifest(nothing).root is None and proven(nothing) == []


def test_manifest_of_sources_beyond_one_slot_array(spark, documents):
    """One source fills several arrays and a last one of a single leaf, others stay within the first."""
    rows = [(k * 3 - 900, f"text\n{k}", "en", "big", k) for k in range(2 * merkle.BLOCK + 1)]
    rows += [(k, f"{k}", None, f"s{k % 7}", None) for k in range(40)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    assert proven(docs) == by_hand(docs)


def test_manifest_of_scattered_and_repeated_ids(spark, documents):
    edges = [-(1 << 63), -(1 << 63) + 1, -4097, -4096, -1, 0, 1, 4095, 4096, (1 << 45) - 1, 1 << 45, (1 << 62) + 5, (1 << 63) - 1, None]
    rng = random.Random(2)
    rows = [(i, f"a\nb{n}", "en", s, n) for i in edges for s in (None, "", "é") for n in range(rng.randrange(1, 4))]
    rows += [(rng.randrange(-(1 << 63), 1 << 63), "x\n", "de", "é", 1) for _ in range(200)]
    rows += [(77, f"of one id {k % 50}\n", "en", "hot", 1) for k in range(400)] + [(None, f"{k}", "en", "hot", 1) for k in range(90)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(6)
    assert proven(docs) == by_hand(docs)


def test_bitmaps_keep_their_ids():
    rng = np.random.default_rng(5)
    for n in (0, 1, merkle.CHUNK // 16 - 1, merkle.CHUNK // 16, merkle.CHUNK // 16 + 1, merkle.CHUNK):
        ids = np.sort(rng.choice(merkle.CHUNK, n, replace=False))
        assert (merkle.unpacked(merkle.packed(ids)) == ids).all()
        assert len(merkle.packed(ids)) == min(2 * n, merkle.CHUNK // 8)


@pytest.mark.parametrize("n, height", [(1, 0), (2, 1), (3, 1), (4, 2), (9, 2), (10, 3), (2187, 7), (2188, 8)])
def test_levels(n, height):
    assert merkle.levels(n) == height
