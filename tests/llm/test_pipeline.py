"""The pipeline's stages hold against what their operators and brute force say of each stage's own input."""
import corpus_pipeline
from decklens.llm import langid, pii
from pyspark.sql import functions as F
from test_packing import check
from test_pii import brute
from test_scans import shingles
from test_simhash import brute_components, brute_print


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, None, None, None), (9001, "", "en", "s", 0), (9002, "12 34", "en", None, 5), (0, "again another text", "en", "s", 18)], docs.schema)
    docs, inputs = docs.unionByName(odd), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(str(tmp_path / name))
        inputs.append([r.asDict() for r in docs.collect()])
        docs = spark.read.parquet(str(tmp_path / name))
    final = [r.asDict() for r in docs.collect()]
    start, known, single, clean, private = inputs
    assert {r["doc_id"] for r in start} - {r["doc_id"] for r in known} == {9000, 9001, 9002}
    # components of rows, not of ids: an id may come twice with different texts
    comp = brute_components(list(range(len(known))), [brute_print(r["text"]) for r in known])
    members = {c: [r for r, k in zip(known, comp) if k == c] for c in set(comp)}
    stays = [min(((r["doc_id"], r["text"]) for r in rows if r["doc_id"] == min(x["doc_id"] for x in rows))) for rows in members.values()]
    assert sorted((r["doc_id"], r["text"]) for r in single) == sorted(stays)
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [r["doc_id"] for r in single if not any(len(q & shingles(r["text"])) >= 0.8 * len(q) - 1e-9 for q in items)]
    assert sorted(r["doc_id"] for r in clean) == sorted(want)
    assert [r["doc_id"] for r in sorted(clean, key=lambda r: r["doc_id"])] == [r["doc_id"] for r in sorted(private, key=lambda r: r["doc_id"])]
    before = {}
    for r in clean:
        before.setdefault(r["doc_id"], []).append(r["text"])
    for r in private:
        assert r["n_chars"] == len(r["text"])
        assert r["text"] in before[r["doc_id"]] or any(map(brute, before[r["doc_id"]])) or "[" in r["text"]
        assert not any(k == 0 for _, k, _ in pii.base_spans(r["text"]))
    assert {r["doc_id"] for r in final} == {r["doc_id"] for r in private} and check(final) > 0


def test_unlabelled_documents_stay(spark):
    rows = [(1, "some words"), (2, "日本語"), (3, None), (4, ""), (5, "12 - 34"), (6, "x")]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, lang string")
    stage = dict(corpus_pipeline.STAGES)["language"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, "").collect()) == [1, 2, 6]
    # a label may be ``und`` itself: the text decides
    named = docs.withColumn("lang", F.when(F.col("doc_id") == 2, "und").when(F.col("doc_id") == 1, "en"))
    assert sorted(r["doc_id"] for r in stage(spark, named, "").collect()) == [1, 2, 6]
    assert sorted(r["doc_id"] for r in langid.known_language(named, langid.fit(named), wanted={"en"}).collect()) == [1, 6]
    assert langid.known_language(docs, langid.fit(docs), wanted={"en"}).count() == 3


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.agg(F.count(F.lit(1))).first()[0] > 0 and "sequence_id" in out.columns


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
