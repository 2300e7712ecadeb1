"""Exact duplicates: groups by a 128-bit content hash, compared byte by byte.

Rows are grouped by the MD5 of their normalised text; a group is counted, and
its best row found, with a map-side combine, so a group that holds a third of
all rows reaches the shuffle as one row for each task.  Whether a group is
really one text is decided by its bytes: the distinct (hash, text) pairs are
made the same way (copies merge before the shuffle), and a hash that has two
texts has collided.  Only the rows of collided hashes carry their text as a
second key, so that each text of such a hash is a group of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, free_name

#: ASCII white space, which the normalised text is without.
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, "")


def content_hash(text: Column) -> Column:
    """128 bits of a text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: bool = False,
               normal: Callable[[Column], Column] = normalised, content: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each input row.

    Rows whose normalised texts are equal form a group.  The row with the
    smallest id stays, with ``longest`` the smallest id among the rows with the
    most code points in their original text.  A null id comes after all
    others; of rows that repeat the id that stays, exactly one is kept.  Null
    texts are empty, and all empty texts are one group.  An empty table gives
    no rows.  Only the two named columns are read, so others cannot clash.
    """
    scratch = Scratch(docs.sparkSession, "dedup")
    text = F.col(text_col).cast("string")
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).alias("chars"), normal(text).alias("_text"))
    rows = scratch.table(read.select("doc_id", "chars", content(F.col("_text")).alias("hash"), F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("sha"))
                         .withColumn("uid", F.monotonically_increasing_id()))
    texts = read.select(content(F.col("_text")).alias("hash"), "_text").distinct()
    collided = scratch.table(texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("hash"), 1)
    if collided.isEmpty():
        rows = rows.withColumn("exact", F.lit(None).cast("binary"))
    else:
        # the normalised text itself tells the rows of a collided hash apart; the row numbers are made as above
        again = read.select("doc_id", "chars", content(F.col("_text")).alias("hash"), F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("sha"),
                            F.monotonically_increasing_id().alias("uid"), F.col("_text").cast("binary").alias("exact"))
        rows = scratch.table(again.join(collided.withColumn("hit", F.lit(True)), "hash", "left")
                             .select("doc_id", "chars", "hash", "sha", "uid", F.when(F.col("hit"), F.col("exact")).alias("exact")))
    order = F.struct((-F.col("chars") if longest else F.lit(0)).alias("c"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    groups = (rows.groupBy("hash", "exact").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best"))
              .select(F.col("hash").alias("_hash"), F.col("exact").alias("_exact"), "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.uid").alias("keep_uid")))
    # written, so that the join shuffles both sides for itself and the rows of a hot group can be split
    groups = scratch.table(groups)
    same = (F.col("hash") == F.col("_hash")) & F.col("exact").eqNullSafe(F.col("_exact"))
    return (rows.join(groups, same)
            .select("doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: bool = False) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay, see ``duplicates``; of rows that repeat id and normalised text, any one."""
    tag = free_name(docs, "_sha")
    keep = duplicates(docs, id_col, text_col, longest).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_keep"))
    tagged = docs.withColumn(tag, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    same = tagged[id_col].cast("long").eqNullSafe(keep["_id"]) & (tagged[tag] == keep["_keep"])
    return tagged.join(keep, same, "left_semi").dropDuplicates([id_col, tag]).drop(tag)


#: DuckDB SQL of the query ``op12_dedup``.
ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS place FROM t)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, place = 1 AS kept, sha256(norm) AS text_sha256
FROM r WINDOW w AS (PARTITION BY norm ORDER BY place)
"""
