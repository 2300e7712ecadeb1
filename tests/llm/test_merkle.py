import hashlib
import zlib

import pytest
from decklens.llm import merkle
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def reduced(nodes):
    """(root, for each node its list of (left, right) siblings)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for leaf, i in enumerate(at):
            run = runs[i // 3]
            paths[leaf].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        nodes, at = [H(*r) for r in runs], [i // 3 for i in at]
    return nodes[0], paths


def brute(rows):
    """{position in rows: (leaf, subroot, root, proof, folded, verified)} for rows of COLUMNS."""
    leaves = [H(*map(field, r)) for r in rows]
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append(i)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
    tops = [reduced([leaves[i] for i in groups[s]]) for s in order]
    root, up = reduced([t[0] for t in tops])
    out = []
    for s, (sub, paths), above in zip(order, tops, up):
        for i, path in zip(groups[s], paths):
            path = path + above
            d, *rest, text = rows[i]
            if text is not None and zlib.crc32(("" if d is None else str(d)).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = H(*map(field, [d, *rest, text]))
            for a, b in path:
                h = H(a, h, b)
            out.append((d, leaves[i], sub, root, H(*[x for p in path for x in p]), h, h == root))
    return sorted(out, key=str)


def got(docs):
    changed = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(docs, COLUMNS, changed={"text": changed}).withColumn("folded", merkle.folded(F.col("changed_leaf"), F.col("path")))
    rows = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"), "folded", F.col("folded") == F.col("root")).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS)
    odd = spark.createDataFrame([(None, None, None, None, None), (7000, None, "en", 3, "a\nb"), (7001, "", "", 0, ""), (7001, "", "", 0, ""), (-5, "src0", "é", None, "x" * 100000 + "\n"),
                                 (7002, "é", "en", 1, "\n"), (7003, "zz", None, 1, None), (None, "src0", "x", 2, "\n\n")], docs.schema)
    docs = docs.unionByName(odd)
    want = brute([tuple(r) for r in docs.collect()])
    extra = docs.selectExpr("*", "1 as pos", "'x' as path", "2 as g", "3 as block", "'r' as root").repartition(6)
    rows = got(extra)
    assert rows == want and {r[-1] for r in rows} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [28, 1, 9, 10, 82], [27, 81, 3, 300]])
def test_several_stages(spark, sizes, monkeypatch):
    """Blocks of nine leaves: trees of up to three stages."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(100 * k + i, f"s{k}", "en", i, f"text\n{i}") for k, n in enumerate(sizes) for i in range(n)]
    assert got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)) == brute(rows)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(i, f"g{i % 100}" if i % 3 else "hot", None, 1, "t") for i in range(600)]
    assert got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == brute(rows)


def test_a_changed_leaf_changes_the_root(spark):
    df = spark.createDataFrame([(i, "a", str(i)) for i in range(40)], "doc_id long, source string, text string")
    found = merkle.manifest(df, ["doc_id", "text"], changed={"text": F.lit("other")})
    rows = found.select(merkle.folded(F.col("leaf"), F.col("path")) == F.col("root"), merkle.folded(F.col("changed_leaf"), F.col("path")) == F.col("root")).collect()
    assert {tuple(r) for r in rows} == {(True, False)}


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], "doc_id long, source string, text string"), ["text"]).collect() == []
