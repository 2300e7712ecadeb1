"""Merkle manifest of a dataset by lag and lead windows.

A row is a leaf; the leaves of a group (a source) ascend by id, and every
``FAN`` consecutive nodes become their parent's hash until one node remains.
The groups' roots, ordered by group, are joined in the same way.

Leaves are numbered within their group in a distributed way and cut into
blocks of ``FAN ** LEVELS`` consecutive leaves, which no parent crosses below
the block's top.  Inside a block, with one sort, each level is a set of lag
and lead columns: the nodes of level ``l`` live in the rows whose place is a
multiple of ``FAN ** l`` (the first child of each), so a node's siblings are
the rows at fixed offsets of ``FAN ** l`` and twice that, masked by the
node's slot and by the length of its run.  First-child rows hash the parent;
the siblings reach every leaf below by ``last`` over the rows so far.  The
tops of the blocks are the leaves of the next stage, so a group of any size is
hashed by as many tasks as it has blocks, and each stage divides the rows by
``FAN ** LEVELS``.

A path holds, for each level with more than one node, the hashes of the
siblings to the left and to the right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, shuffle_partitions

FAN = 3
LEVELS = 7
_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(scratch: Scratch, df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with pos (from 0 within the column ``g``, by ``order``) and n, the number of rows of ``g``.

    Range-sorted and written once; a group that spans partitions gets its
    places from the row counts of the earlier partitions, so no task holds
    more than its range.
    """
    at = (df.repartitionByRange(shuffle_partitions(scratch.spark), "g", *order).sortWithinPartitions("g", *order)
          .withColumn("_place", F.monotonically_increasing_id()))
    at = scratch.table(at.withColumn("_part", F.shiftright("_place", 33).cast("int")).withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))))
    # one row for each (group, partition that it spans): at most groups + partitions rows
    runs = at.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    by_group = Window.partitionBy("g")
    before = F.coalesce(F.sum("_n").over(by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("g", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(by_group).alias("n"))
    return at.join(runs, ["g", "_part"]).withColumn("pos", F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")


def _stage(nodes: DataFrame) -> DataFrame:
    """``nodes`` (g, pos, n, h, ...) with block, top (the hash at the block's top, in its first row) and path."""
    size = FAN ** LEVELS
    out = nodes.withColumn("block", F.floor(F.col("pos") / size)).withColumn("_at", F.col("pos") % size)
    w = Window.partitionBy("g", "block").orderBy("pos")
    node, empty = F.col("h"), F.lit("")
    for level in range(LEVELS):
        step = FAN ** level
        first, slot = F.col("_at") % step == 0, F.floor(F.col("_at") / step) % FAN
        many = F.col("n") > step  # more than one node at this level
        here = f"_h{level}"
        near = {f"_{side}{k}": F.coalesce(move(here, k * step).over(w), empty)
                for side, move in (("lag", F.lag), ("lead", F.lead)) for k in range(1, FAN)}
        out = out.withColumn(here, node).withColumns(near)
        left = F.concat(*[F.when(slot >= k, F.col(f"_lag{k}")).otherwise(empty) for k in range(FAN - 1, 0, -1)])
        right = F.concat(*[F.when(slot + k < FAN, F.col(f"_lead{k}")).otherwise(empty) for k in range(1, FAN)])
        out = out.withColumn(f"_s{level}", F.when(first & many, F.struct(left.alias("left"), right.alias("right")))).drop(*near)
        parent = F.when(many, digest(F.col(here), F.col(f"_s{level}.right"))).otherwise(F.col(here))
        node = F.when(F.col("_at") % (step * FAN) == 0, parent)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = F.array(*[F.last(f"_s{level}", ignorenulls=True).over(so_far) for level in range(LEVELS)])
    out = out.withColumn("top", node).withColumn("path", F.array_compact(steps).cast(_PATH))
    return out.drop("_at", *[f"_{kind}{level}" for kind in "hs" for level in range(LEVELS)])


def _tops(stage: DataFrame) -> DataFrame:
    return stage.filter(F.col("top").isNotNull())


def climb(scratch: Scratch, leaves: DataFrame) -> list[DataFrame]:
    """The stages over ``leaves`` (g not null, pos, n, h, ...); in the last one every group has a single block."""
    stages, most = [_stage(leaves)], leaves.agg(F.max("n")).first()[0] or 0
    while most > FAN ** LEVELS:
        most = -(-most // FAN ** LEVELS)
        tops = _tops(stages[-1]).select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / FAN ** LEVELS).alias("n"), F.col("top").alias("h"))
        stages.append(scratch.table(_stage(scratch.table(tops))))
    return stages


def descend(stages: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves of ``climb`` with the columns of ``above`` and path; ``above`` (g, up, ...): the path over each group's root.

    Every stage is joined by (group, block), at most ``FAN ** LEVELS`` rows a key.
    """
    above = above.withColumn("block", F.lit(0).cast("long"))
    more = [c for c in above.columns if c not in ("g", "block", "up")]
    for stage in reversed(stages):
        whole = stage.join(above, ["g", "block"]).withColumn("path", F.concat("path", "up"))
        above = whole.select("g", F.col("pos").alias("block"), F.col("path").alias("up"), *more)
    return whole.drop("block", "top", "up")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", changed: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path[, changed_leaf]): one row for each input row.

    A leaf is the hash of ``columns``, in this order.  Groups ascend by their
    UTF-8 bytes, null first (a null group is not the empty one); leaves by
    id, a null id first; rows that repeat an id by their leaf, and rows that
    are equal in all columns take neighbouring places.  A group of one leaf
    has that leaf as subroot; a table of one group has its subroot as root; an
    empty table gives no rows.  ``changed`` replaces columns for a second leaf
    of the same place.  Columns that are not named are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    group = F.col(group_col).cast("string")
    out = {"doc_id": F.col(id_col).cast("long"), "g": F.coalesce(F.concat(F.lit("+"), group), F.lit("")), "h": digest(*[field(F.col(c)) for c in columns])}
    if changed is not None:
        out["changed_leaf"] = digest(*[field(changed.get(c, F.col(c))) for c in columns])
    stages = climb(scratch, numbered(scratch, docs.select(*[c.alias(name) for name, c in out.items()]), ["doc_id", "h"]))
    # one row for each group, numbered in their order
    groups = scratch.table(_tops(stages[-1]).select(F.lit("").alias("g"), F.col("g").alias("group"), F.col("top").alias("h")))
    upper = climb(scratch, numbered(scratch, groups, ["group"]))
    root = _tops(upper[-1]).select("g", F.col("top").alias("root"), F.expr(f"cast(array() as {_PATH})").alias("up"))
    above = descend(upper, root).select(F.col("group").alias("g"), F.col("h").alias("subroot"), "root", F.col("path").alias("up"))
    whole = descend(stages, scratch.table(above))
    source = F.when(F.col("g") != "", F.expr("substring(g, 2)")).alias("source")
    return whole.select("doc_id", source, F.col("h").alias("leaf"), "subroot", "root", "path", *(["changed_leaf"] if changed is not None else []))


#: DuckDB SQL of the query ``op13_merkle``: each tree level by level, then each leaf folded up with the nodes beside it.
ORACLE = """
WITH RECURSIVE
bits AS (SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i::BIGINT) ORDER BY i) AS tb FROM range(256) r(i)),
t AS (SELECT *, CASE WHEN list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255) + 1]), 4294967295::BIGINT) % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents, bits),
w AS (SELECT doc_id, source, changed, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM t),
leaves AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS changed_leaf FROM w),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes(level, source, i, n, h) AS (
    SELECT 0, source, pos, n, leaf FROM placed
    UNION ALL SELECT level + 1, source, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY level, source, i // 3, n),
tops AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper(level, i, n, h) AS (
    SELECT 0, pos, n, subroot FROM tops
    UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, i // 3, n),
up(level, source, start, pos, h, beside) AS (
    SELECT 0, source, pos, pos, changed_leaf, '' FROM placed
    UNION ALL SELECT up.level + 1, up.source, start, up.pos // 3, sha256(string_agg(CASE WHEN nodes.i = up.pos THEN up.h ELSE nodes.h END, '' ORDER BY nodes.i)),
        beside || coalesce(string_agg(nodes.h, '' ORDER BY nodes.i) FILTER (WHERE nodes.i <> up.pos), '')
    FROM up JOIN nodes ON up.level = nodes.level AND up.source IS NOT DISTINCT FROM nodes.source AND up.pos // 3 = nodes.i // 3 AND nodes.n > 1
    GROUP BY up.level, up.source, start, up.pos, up.h, beside),
inner_done AS (SELECT source, start, h, beside FROM (SELECT *, max(level) OVER (PARTITION BY source) AS last FROM up) WHERE level = last),
over(level, source, start, pos, h, beside) AS (
    SELECT 0, d.source, start, tops.pos, h, beside FROM inner_done d JOIN tops ON d.source IS NOT DISTINCT FROM tops.source
    UNION ALL SELECT over.level + 1, source, start, over.pos // 3, sha256(string_agg(CASE WHEN upper.i = over.pos THEN over.h ELSE upper.h END, '' ORDER BY upper.i)),
        beside || coalesce(string_agg(upper.h, '' ORDER BY upper.i) FILTER (WHERE upper.i <> over.pos), '')
    FROM over JOIN upper ON over.level = upper.level AND over.pos // 3 = upper.i // 3 AND upper.n > 1
    GROUP BY over.level, source, start, over.pos, over.h, beside),
done AS (SELECT * FROM over WHERE level = (SELECT max(level) FROM over))
SELECT p.doc_id, p.leaf, tops.subroot, (SELECT h FROM upper WHERE n = 1) AS root, sha256(done.beside) AS proof_sha256, done.h AS folded_root,
    done.h = (SELECT h FROM upper WHERE n = 1) AS verified
FROM placed p JOIN tops ON p.source IS NOT DISTINCT FROM tops.source JOIN done ON p.source IS NOT DISTINCT FROM done.source AND p.pos = done.start
"""
