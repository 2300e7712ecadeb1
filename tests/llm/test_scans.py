"""Decontamination and secret scan against brute force and on odd rows."""
import re

import duckdb
import pytest
from decklens.llm import decontam, queries, secrets
from decklens.llm.common import Scratch
from pyspark.sql import functions as F

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def shingles(text):
    w = (text or "").lower().split()
    return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)} or ({" ".join(w)} if w else set())


def test_containment_equals_brute_force(spark):
    filler = " ".join("f%d" % i for i in range(3000))
    near = ITEM.replace("mu", "nu")
    docs = [(1, filler + " " + ITEM.upper() + "\n" + filler), (2, filler), (3, near), (4, "gamma " + ITEM.replace("zeta", "x")), (5, None), (5, ""), (None, ITEM),
            (6, "two words"), (7, ITEM), (7, ITEM), (7, filler), (8, " ".join([ITEM] * 40))]
    items = [(10, ITEM), (11, "two words"), (12, None), (13, ""), (14, " ".join("f%d" % i for i in range(40, 140))), (None, "q r s t u v"), (15, "alpha beta gamma delta epsilon")]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, hash int, gram string")
    d = d.withColumn("_d", F.lit(1)).withColumn("_h", F.lit(1))
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, q int")
    got = {(r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in decontam.contained(d, b).collect()}
    want = set()
    for i, t in docs:
        for j, u in items:
            q = shingles(u)
            if q and len(q & shingles(t)) >= 0.8 * len(q) - 1e-9:
                want.add((i, j, round(len(q & shingles(t)) / len(q), 9)))
    assert got == want and (3, 10, 0.875) in want
    kept = decontam.clean(d, b)
    bad = {(i, shingles(docs[k][1]) and docs[k][1]) for k, (i, _) in enumerate(docs) for (x, _, _) in want if x == i}
    assert kept.columns == d.columns
    assert sorted((str(r["doc_id"]), len(r["text"] or "")) for r in kept.collect()) == sorted((str(i), len(t or "")) for i, t in [(2, filler), (4, docs[3][1]), (5, None), (5, ""), (7, filler)]
                                                                                         if t is None or not any(u and len(shingles(u) & shingles(t)) >= 0.8 * len(shingles(u)) - 1e-9 for _, u in items))


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(f"SELECT doc_id, item_id, containment, shared, item_shingles FROM ({decontam.ORACLE})").fetchall()
    rows = queries.op1_decontam(spark, "/root/testdata/sf0.001").select("doc_id", "item_id", "containment", "shared", "item_shingles").collect()
    assert sorted(map(tuple, rows)) == sorted(want) and want


@pytest.mark.parametrize("broadcast", [10, 500_000])
def test_both_join_forms(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", broadcast)
    d = spark.createDataFrame([(1, "x " + ITEM), (2, "y")], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert [r["doc_id"] for r in decontam.clean(d, b).collect()] == [2]


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert decontam.contained(d, b).collect() == [] and decontam.clean(full, b).count() == 1 and secrets.scan(d).collect() == []


def test_candidates_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = [(9000, "é aaaaaaaaaaaaaaaa1 bbbb key=abcdefghij0123456789/Z1234567890abcdefgh\n1234567890123456"), (9001, None), (9002, ""), (None, "1234567890123456"),
           (9003, "x" * 200_000 + " " + "y1" * 100_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), r["start"], r["value"]) for r in secrets.candidates(Scratch(spark, "t"), docs).collect())
    want = []
    for r in docs.collect():
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", r["text"] or ""):
            if len(m.group()) >= secrets.MIN_LENGTH and re.search("[0-9]", m.group()):
                want.append((str(r["doc_id"]), m.start(), m.group()))
    assert got == sorted(want)


def test_forest_tells_secrets_from_numbers(spark):
    rows = queries.op9_secrets(spark, "/root/testdata/sf0.1").collect()
    held = [r for r in rows if r["held_out"] and r["label"] is not None]
    assert {r["label"] for r in held} == {0, 1} and sum(r["is_secret"] == r["label"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_dictionary_and_one_label(spark):
    text = "path /usr/share/correcthorse1234567890 token = correcthorse-battery99"
    d = spark.createDataFrame([(1, text), (2, "correcthorse battery"), (3, "correcthorse battery"), (1, text)], "doc_id long, text string")
    rows = secrets.scan(d, labelled=F.lit(0)).collect()
    assert len(rows) == 4 and {r["score"] for r in rows} == {0.0}
    s = Scratch(spark, "t")
    got, names = secrets.features(s, d, s.table(secrets.candidates(s, d)))
    by = {r["value"]: r for r in got.collect()}
    assert by["correcthorse-battery99"]["f_covered"] == pytest.approx(19 / 22) and by["correcthorse-battery99"]["f_keyword"] == 1.0
    assert any("f_left" in n for n in names) and by["/usr/share/correcthorse1234567890"]["f_slashes"] == 3.0
