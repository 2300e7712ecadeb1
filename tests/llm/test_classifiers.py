"""Held-out accuracy of the trained scorers, brute-force versions of their arithmetic, and odd inputs."""
import zlib

import numpy as np
import pytest
from decklens.llm import langid, quality, queries, toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
ODD = [(9001, None), (9002, ""), (9003, " 12 .. \n"), (9003, " 12 .. \n"), (None, "The and of that " * 3), (9004, "word and other " * 90_000)]


def odd(spark):
    return spark.createDataFrame([(d, t, "x", 3.0, None) for d, t in ODD], "doc_id long, text string, lang string, score double, source string")


def labels(spark, name):
    return {r["doc_id"]: r[name] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize("name,column,mod,rest", [("op3_toxicity", "toxic", 5, 0), ("op5_quality", "quality", 3, 1)])
def test_held_out_accuracy(spark, name, column, mod, rest):
    truth = labels(spark, column)
    rows = queries.REGISTRY[name][0](spark, SF).collect()
    assert len(rows) == 1000
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in truth:
            right.append(r["predicted"] == truth[r["doc_id"]])
    assert np.mean(right) >= 0.95


def test_language_held_out_accuracy(spark):
    rows = queries.op6_langid(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == 1000
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]) >= 0.98


def brute_vector(text, dims):
    s = "".join(c if c.isalpha() else " " for c in " " + text.lower() + " ")
    while "  " in s:
        s = s.replace("  ", " ")
    total = np.zeros(dims)
    for a, b, c in zip(s, s[1:], s[2:]):
        total += np.roll(langid.letter(ord(a), dims), 2).astype(int) * np.roll(langid.letter(ord(b), dims), 1) * langid.letter(ord(c), dims)
    return total


def test_bundles_equal_brute_force(monkeypatch):
    texts = ["Hello, World! ÀÉ ß 漢字かな", "a", "", None, "12", "x  y\n\nz" * 40, "".join(chr(0x4E00 + i) for i in range(300)) * 2, "\U0001F600 b"]
    want = np.array([brute_vector(t or "", 64) if any(c.isalpha() for c in t or "") else np.zeros(64) for t in texts])
    assert np.allclose(langid.vectors(texts, 64), want)
    monkeypatch.setattr(langid, "SLICE", 16)
    monkeypatch.setattr(langid, "BLOCK", 20)
    assert np.allclose(langid.vectors(texts, 64), want)
    joined = np.sum([langid._bundle([(0, s)], out := np.zeros((1, 64), np.float32)) or out[0] for s in langid.symbols(texts[5], 7)], axis=0)
    assert np.allclose(joined, want[5])


def test_language_odd_rows(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict(odd(spark), model).collect()}
    assert {g[0] for g in got if g[1] == "und"} == {9001, 9002, 9003} and (None, "en") in got
    kept = langid.known_language(odd(spark), model)
    assert kept.columns == odd(spark).columns and kept.count() == 2
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predict(empty, langid.fit(empty)).collect() == []
    assert {r["lang_pred"] for r in langid.predict(odd(spark), langid.fit(empty)).collect()} == {"und"}


@pytest.mark.parametrize("op,column", [(toxicity, "toxic"), (quality, "quality")])
def test_scorers_odd_rows(spark, op, column):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    bad = spark.createDataFrame([(None, 1, 1), (5, None, None), (12345, 1, 0), (6, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    model = op.fit(docs, lab.unionByName(bad).withColumn("text", F.lit("clash")))
    rows = op.score(odd(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    empty = spark.createDataFrame([], "doc_id long, text string, quality int, toxic int")
    assert op.score(empty, model).collect() == []
    assert len(op.score(odd(spark), op.fit(docs, empty)).collect()) == len(ODD)
    assert len(op.score(odd(spark), op.fit(empty, lab)).collect()) == len(ODD)


def test_toxic_features_in_parts_equal_the_whole(monkeypatch):
    text = " ".join("w%d" % (i * 31 % 101) for i in range(140_000))
    got = np.unique(np.concatenate(list(toxicity.features(text))))
    h = toxicity.word_hashes(toxicity._WORDS.findall(text.encode()))
    want = {int((h[i] * toxicity._MULT[0]) >> np.uint64(64 - toxicity.BITS)) for i in range(len(h))}
    for n in toxicity.STEMS:
        stems = toxicity.word_hashes([w[:n] for w in text.encode().split() if len(w) > n])
        want |= set(((stems * toxicity._MULT[n % 4]) >> np.uint64(64 - toxicity.BITS)).astype(np.int64).tolist())
    for gap in (1, 2, 3):
        want |= set((((h[:-gap] * toxicity._MULT[gap] ^ (h[gap:] >> np.uint64(7))) * toxicity._MULT[0]) >> np.uint64(64 - toxicity.BITS)).astype(np.int64).tolist())
    assert set(got.tolist()) == want


def test_vote_equals_brute_force():
    rng = np.random.default_rng(1)
    near = quality._unit(rng.standard_normal((40, 6)).astype(np.float32))
    model = {"vectors": near, "labels": rng.integers(0, 2, 40).astype(np.float32), "prior": 0.3}
    v = np.vstack([rng.standard_normal((300, 6)), np.zeros((1, 6))]).astype(np.float32)
    got = quality.vote(v, model)
    assert got[-1] == 0.3
    for x, s in zip(v[:-1], got):
        cos = near @ (x / np.linalg.norm(x))
        top = np.argsort(-cos)[:quality.NEIGHBOURS]
        w = np.maximum(cos[top], 0).astype(float) ** 8
        assert s == pytest.approx((w * model["labels"][top]).sum() / w.sum(), abs=1e-4)


def test_many_language_labels(spark):
    from decklens.llm import langid
    words = ["the cat", "der hund", "le chat"]
    df = spark.createDataFrame([(i, f"{words[i % 3]} {i}", f"l{i % 1500}") for i in range(3000)] + [(9000, None, "l0")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model[0]) == 1500
    rows = langid.predict(df, model).collect()
    unit = langid._unit(langid.vectors([r["text"] for r in df.collect()]))
    best = (unit @ model[1].T).max(axis=1)
    assert len(rows) == 3001 and {r["doc_id"]: r["lang_pred"] for r in rows}[9000] == "und"
    assert all(abs(r["score"] - max(0.0, best[i])) < 1e-5 for i, r in enumerate(sorted(rows, key=lambda r: r["doc_id"])))
