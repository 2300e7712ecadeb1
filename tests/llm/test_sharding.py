import random
import zlib

import pytest
from decklens.llm import sharding


def naive(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = min((b for b in range(len(bins)) if bins[b] >= s), key=lambda b: (bins[b], b), default=None)
        if fit is None:
            bins.append(max(capacity, s) - s)
        else:
            bins[fit] -= s
    return bins


def test_runs_equal_item_by_item_best_fit():
    rng = random.Random(2)
    for _ in range(60):
        cap = rng.randrange(50, 300)
        sizes = [rng.randrange(1, cap + 30) for _ in range(rng.randrange(1, 200))]
        runs = sharding.best_fit_decreasing([(s, sizes.count(s)) for s in set(sizes)], cap)
        load = {}
        for s, a, b, w in runs:
            load[w] = load.get(w, 0) + s * (b - a)
        assert sum(load.values()) == sum(sizes)
        assert all(v <= cap or v in sizes for v in load.values())
        assert len(load) <= len(naive(sizes, cap)) + 1


def test_tree_finds_the_tightest():
    rng, tree, kept = random.Random(4), sharding.CapacityTree(), []
    for i in range(3000):
        if rng.random() < 0.6:
            k = (rng.randrange(500), i)
            tree.add(*k)
            kept.append(k)
        else:
            want = min((k for k in kept if k[0] >= 250), default=None)
            assert tree.take(250) == want
            if want:
                kept.remove(want)
    assert tree.root[3] <= 1.45 * len(kept).bit_length() + 2


def test_documents(spark):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(5000, None), (5001, ""), (None, "abc"), (3, "abc"), (3, "abc")], "doc_id long, text string")
    docs = base.unionByName(extra).selectExpr("doc_id", "text", "1 as size", "2 as shard", "'a' as class")
    rows = sharding.assign(docs, shards=40).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    assert len(rows) == 1005
    load, slots = {}, {}
    for r in rows:
        sizes = [(len(t.encode()) + 16, zlib.crc32(t.encode())) for t in texts[r["doc_id"]]]
        assert (r["size"], r["text_crc32"]) in sizes
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(load) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) <= 1.02 * sum(load.values()) / 40
    by_text = {}
    for r in rows:
        by_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_capacity_and_hot_group(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 == 0 else "t%d" % i) for i in range(300)], "doc_id long, text string")
    rows = sharding.assign(docs, capacity=500).collect()
    load = {}
    for r in rows:
        load.setdefault(r["shard"], []).append(r["size"])
    hot = [v for v in load.values() if len(v) >= 100]
    assert len(hot) == 1 and all(sum(v) <= 500 for v in load.values() if v is not hot[0])


def test_empty(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string"), shards=4).collect() == []
    with pytest.raises(ValueError):
        sharding.assign(spark.createDataFrame([], "doc_id long, text string"))
