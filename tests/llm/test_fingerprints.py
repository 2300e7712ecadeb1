import hashlib

import numpy as np
import pytest
from decklens.llm import fingerprints as fp


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)} or ({b" ".join(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edits_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-4, None), (1001, ""), (1002, "one two three"), (None, "last é row of all " * 3)]
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in rows], "doc_id long, text string, bucket int, hash int").repartition(5)
    got = {r["doc_id"]: r for r in fp.edits(df).collect()}
    order = sorted(rows, key=lambda r: -r[0] if r[0] is not None else float("inf"))
    assert len(got) == len(rows)
    errors = []
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt, m = t or "", nxt or "", len(t or "") // 2
        want = t[:len(t) - m] + nxt[:m]
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        errors += [abs(r["near_edited"] - jaccard(t, want)), abs(r["near_next"] - jaccard(t, nxt))]
        assert fp.write(fp.sketch(t)) == r["fingerprint"] and fp.write(fp.sketch(want)) == r["edited_fingerprint"]
    assert np.mean(errors) < 0.015 and max(errors) < 0.2


def test_repeated_ids_follow_each_other(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "x y"), (1, "p q")]
    assert sorted(r["doc_id"] for r in fp.edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [1, 5, 5, 5]
    one = fp.edits(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert fp.edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sketches_merge_and_estimate(spark):
    parts = [" ".join("w%d" % (i * 7919 % 20011) for i in range(a, a + 3000)) for a in (0, 2500, 5000)]
    df = spark.createDataFrame([(1, p) for p in parts] + [(2, parts[0]), (None, "z")], "g long, text string")
    prints = fp.fingerprints(df, id_col="g")
    got = {r["doc_id"]: fp.read(r["fingerprint"]) for r in fp.merged(prints, "doc_id").collect()}
    assert (got[1] == fp.merge([fp.sketch(p) for p in parts])).all()
    true = len(set.union(*map(shingles, parts)))
    assert fp.distinct(got[1]) == pytest.approx(true, rel=0.3)
    a, b = fp.sketch(parts[0]), got[1]
    assert fp.containment(a, b) > 0.75 and fp.resemblance(a, b) == pytest.approx(len(shingles(parts[0])) / true, abs=0.12)
    assert (fp.read(fp.write(a)) == a).all() and fp.resemblance(fp.sketch(""), fp.sketch(None)) == 1.0 and fp.containment(fp.sketch(""), a) == 1.0


def test_very_long_text_is_read_whole():
    words = ["w%d" % (i * i % 9973) for i in range(300_000)]
    h = fp.window_hashes(fp.word_hashes([w.encode() for w in words]), 5) >> np.uint64(16)
    assert (fp.sketch(" ".join(words)) == np.unique(h)[:fp.K]).all()


def test_successors_of_large_ids(spark):
    """Neighbouring ids beyond 2**53, around 0 and at both ends of the longs, each beside the next smaller one."""
    for base in (1 << 53, 1 << 60, 1 << 62, -(1 << 53), -(1 << 63) + 1, -50):
        ids = [base + i for i in range(200)] + [3 * i + 7 for i in range(20)]
        rows = sorted({d: f"text of {k} and some words" for k, d in enumerate(ids)}.items(), reverse=True)
        got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in fp.edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
        want = {d: (len(t), hashlib.sha256(fp.edited(t, rows[(k + 1) % len(rows)][1]).encode()).hexdigest()) for k, (d, t) in enumerate(rows)}
        assert got == want
