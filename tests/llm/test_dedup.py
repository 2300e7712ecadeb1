import hashlib
import re

from decklens.llm import dedup
from pyspark.sql import functions as F


def brute(rows, longest):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or "") if longest else 0, d is None, d or 0, i))
    out = []
    for norm, members in groups.items():
        keep = rows[min(members)[3]][0]
        out += [(rows[m[3]][0], keep, len(members), m == min(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


ROWS = [(5, "a b"), (3, "ab"), (9, "a\nb  "), (4, " a b  "), (7, None), (6, ""), (8, "\t \x0b\x0c\r"), (None, "ab"), (None, "only"), (3, "ab"), (3, "other"),
        (11, "É x"), (10, "É  x"), (12, "Éx"), (13, "long text " * 50000), (14, "long text" * 50000), (15, "AB")]


def _got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def _free(rows):
    """Rows that repeat an id and a text are alike but for which of them is kept."""
    return sorted(str(r) for r in rows)


def test_groups_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = ROWS + [(r["doc_id"] + 1000, r["text"]) for r in docs.collect()]
    df = spark.createDataFrame([(d, t, b"x", 1) for d, t in rows], "doc_id long, text string, hash binary, group_size int").repartition(5)
    for longest in (False, True):
        assert _free(_got(dedup.duplicates(df, longest=longest))) == _free(brute(rows, longest))


def test_collisions_are_told_apart_by_bytes(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    weak = lambda c: F.unhex(F.substring(F.md5(c.cast("binary")), 1, 1))
    one = lambda c: F.lit(b"same")
    for content in (weak, one):
        assert _free(_got(dedup.duplicates(df, longest=True, content=content))) == _free(brute(ROWS, True))


def test_a_hot_group_and_the_rows_that_stay(spark):
    df = spark.createDataFrame([(i, "same  text" if i % 3 == 0 else f"t{i // 2}", i) for i in range(3000)], "doc_id long, text string, _sha int")
    got = dedup.deduplicate(df)
    assert got.columns == df.columns
    want = {}
    for r in df.collect():
        want.setdefault(r["text"], r["doc_id"])
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want.values())


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.duplicates(empty).collect() == [] and dedup.deduplicate(empty).collect() == []
