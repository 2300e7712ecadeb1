"""Benchmark decontamination: short test items inside long documents.

Texts are lowered and split at ASCII white space into five-word shingles (a
shorter text is one shingle; an empty one has none).  An item is contained in
a document if the document has at least ``threshold`` of its distinct
shingles.

Search.  Under a random order of all shingles (their hash), the chance that
an item's minimum lies in a document is the containment itself, and if a
document holds at least ``need`` of the ``q`` shingles, then at most
``q - need`` of the item's minima can be missing.  So every item keeps that
many minima and one more, and each document that contains it meets at least
one of them: the candidates are complete.  Items are partitioned by size (one
partition for each number of shingles, which sets the depth of the sketch);
a document is only tried for partitions whose ``need`` it is large enough to
hold.  All shingles of all documents are probed, so a passage is found
wherever it stands.

Check.  The candidates are verified with the shingles themselves, not their
hashes.  Everything is DataFrame expressions; the minima and the items'
shingles are broadcast only if their counted size is below ``BROADCAST_ROWS``,
otherwise the joins are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch

SHINGLE = 5
BROADCAST_ROWS = 500_000
_BLANK = " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    body = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_BLANK))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def _starts(n: Column, shingle: int) -> Column:
    """First word of every shingle, from 0; none for an empty text."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column, shingle: int) -> Column:
    # words beyond the end are null, which the hash skips
    return F.transform(_starts(F.size(words), shingle), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]))


def _grams(words: Column, shingle: int) -> Column:
    return F.array_distinct(F.transform(_starts(F.size(words), shingle), lambda i: F.concat_ws(" ", F.slice(words, i + 1, F.lit(shingle)))))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", shingle: int = SHINGLE, threshold: float = 0.8) -> DataFrame:
    """(doc_id, hash, item_id, containment, shared, item_shingles) for every item that a document contains.

    ``hash`` is the hash of the document's text.  Rows that repeat both id and
    text count once; rows that repeat only an id are told apart by ``hash``.
    Null ids stay null; null and empty texts contain nothing and are contained
    in nothing; repeated items with one id are united by their text (each text
    is judged for itself and the highest containment is kept).  Empty tables
    give no rows.  Only the named columns are read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    tests = (items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("t")).distinct()
             .withColumn("key", F.xxhash64("item_id", "t")).withColumn("w", _words(F.col("t"))))
    tests = scratch.table(tests.select("item_id", "key", _grams(F.col("w"), shingle).alias("grams"), F.array_distinct(_hashes(F.col("w"), shingle)).alias("h"))
                          .withColumn("q", F.size("grams")).filter("q > 0").withColumn("need", F.ceil(F.col("q") * threshold - 1e-9).cast("int")))
    sizes = tests.agg(F.sum("q").alias("grams"), F.sum(F.col("q") - F.col("need") + 1).alias("minima")).first()
    minima = tests.select("key", "need", F.explode(F.slice(F.sort_array("h"), F.lit(1), F.col("q") - F.col("need") + 1)).alias("h"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    probes = (rows.select("doc_id", F.xxhash64("t").alias("hash"), _words(F.col("t")).alias("w"))
              .select("doc_id", "hash", F.size("w").alias("n"), F.explode(_hashes(F.col("w"), shingle)).alias("h")))
    large_enough = F.greatest(F.col("n") - shingle + 1, F.lit(1)) >= F.col("need")
    found = scratch.table(probes.join(_sized(minima, sizes["minima"] or 0), "h").filter(large_enough).select("doc_id", "hash", "key").distinct())
    n = found.count()
    suspects = found.select(F.col("doc_id").alias("_d"), F.col("hash").alias("_h")).distinct()
    texts = (rows.withColumn("hash", F.xxhash64("t")).join(_sized(suspects, n), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("hash") == F.col("_h")), "left_semi"))
    # the words are a column of their own: inside the shingle expression they would be split anew for every shingle
    grams = texts.select("doc_id", "hash", _words(F.col("t")).alias("w")).select("doc_id", "hash", F.explode(_grams(F.col("w"), shingle)).alias("gram"))
    wanted = tests.select("key", F.explode("grams").alias("gram"))
    # rows that repeat id and text repeat all their shingles alike
    shared = (grams.join(_sized(wanted, sizes["grams"] or 0), "gram").groupBy("doc_id", "hash", "key")
              .agg(F.countDistinct("gram").alias("shared")))
    pair = [shared["doc_id"].eqNullSafe(found["doc_id"]), shared["hash"] == found["hash"], shared["key"] == found["key"]]
    sure = shared.join(found, pair, "left_semi").join(_sized(tests.select("key", "item_id", "q", "need"), sizes["grams"] or 0), "key").filter("shared >= need")
    best = F.max(F.struct((F.col("shared") / F.col("q")).alias("containment"), F.col("shared"), F.col("q").cast("long").alias("item_shingles"))).alias("b")
    return sure.groupBy("doc_id", "hash", "item_id").agg(best).select("doc_id", "hash", "item_id", "b.containment", "b.shared", "b.item_shingles")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that contain no item."""
    scratch = Scratch(docs.sparkSession, "clean")
    bad = scratch.table(contained(docs, items, id_col, text_col, **options).select("doc_id", "hash").distinct())
    bad = _sized(bad, bad.count())
    same = docs[id_col].cast("long").eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs[text_col].cast("string")) == bad["hash"])
    return docs.join(bad, same, "left_anti")


#: DuckDB: every document against every item, shingle by shingle.
ORACLE = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, string_split_regex(trim(lower(coalesce(text, '')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, string_split_regex(trim(lower(coalesce(text, '')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') FROM benchmark),
g AS (SELECT DISTINCT side, id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS gram FROM w WHERE w <> ['']),
q AS (SELECT id, count(*) AS q FROM g WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) / q.q AS containment, count(*) AS shared, q.q AS item_shingles
FROM g d JOIN g i ON d.gram = i.gram AND d.side = 'd' AND i.side = 'i' JOIN q ON q.id = i.id
GROUP BY d.id, i.id, q.q HAVING count(*) >= ceil(q.q * 0.8 - 1e-9)
"""
