"""Train/test splits and cross-validation folds.

Spark has no row order, so every assignment is a keyed hash of a unique row
key: reproducible, independent of partitioning and free of shuffles.  The
stratified variants use a separate salt per purpose; in expectation each
class is split in the requested proportion (no per-class window, so a class
holding most rows is never pulled into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


TEST_SIZE = 0.25   # fixed values of the reference configuration
SEED = 42
CV_FOLDS = 5


def split_flag(df: DataFrame, key: str, test_size: float = TEST_SIZE, seed: int = SEED,
               purpose: str = "cls", stratify: str | None = None) -> DataFrame:
    """Adds ``is_test`` (test share ``test_size``).

    With ``stratify`` the hash salt includes the class value, so the draw is
    independent per class (stratified in expectation)."""
    salt = F.concat(F.lit(f"split-{purpose}-{seed}"),
                    F.lit(":"), F.col(stratify).cast("string")) if stratify else F.lit(f"split-{purpose}-{seed}")
    u = _uniform(F.col(key), salt)
    return df.withColumn("is_test", u < test_size)


def fold_column(df: DataFrame, key: str, k: int = CV_FOLDS, seed: int = SEED, purpose: str = "cls",
                stratify: str | None = None, name: str = "fold") -> DataFrame:
    """``fold`` in 0..k-1 from a keyed uniform (usable as ``foldCol``)."""
    salt = F.concat(F.lit(f"fold-{purpose}-{seed}"),
                    F.lit(":"), F.col(stratify).cast("string")) if stratify else F.lit(f"fold-{purpose}-{seed}")
    u = _uniform(F.col(key), salt)
    return df.withColumn(name, F.floor(u * k).cast("int"))


def _uniform(key, salt):
    k = F.concat(key.cast("string"), F.lit(":"), salt)
    h = F.conv(F.substr(F.md5(k), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(4294967296.0)


def fold_exact(df: DataFrame, key: str, k: int = CV_FOLDS, seed: int = SEED, purpose: str = "cls",
               stratify: str | None = None, name: str = "fold") -> DataFrame:
    """G4/G5 exact mode: the rows of a class (of all, without ``stratify``) are
    dealt in turn to the k folds by the order of a keyed hash, so the fold
    sizes of every class differ by at most one.

    As in ``split_exact`` no window spans a class: a row's rank is the count of
    its class in the lower hash buckets plus its rank in its own bucket.  The
    key must be unique."""
    cls = F.col(stratify).cast("string") if stratify else F.lit("")
    h = F.conv(F.substr(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":deal-{purpose}-{seed}"))), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    d = df.select("*", cls.alias("_c"), h.alias("_h"), F.floor(h / (4294967296 // EXACT_BUCKETS)).cast("int").alias("_b"))
    per = d.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))       # classes x buckets
    lower = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(F.col("_c").alias("_c2"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_c", "_b").orderBy("_h", key)
    ranked = d.withColumn("_r", F.row_number().over(inside) - 1)
    out = ranked.join(before, F.col("_c").eqNullSafe(F.col("_c2")) & (F.col("_b") == F.col("_b2")))
    return out.select(*df.columns, F.pmod(F.col("_before") + F.col("_r"), F.lit(k)).cast("int").alias(name))


def xy_views(df: DataFrame, features: list[str], target: str, key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """X (key + features, targets excluded) and y (key + target) views."""
    return df.select(key, *features), df.select(key, target)




EXACT_BUCKETS = 1 << 16


def split_exact(df: DataFrame, key: str, stratify: str | None = None, test_size: float = TEST_SIZE,
                seed: int = SEED, purpose: str = "cls") -> DataFrame:
    """G1 exact mode: exactly ceil(test_size * n) test rows, allocated to the
    classes in proportion (floor, then the largest remainders, ties by class
    value); within a class the rows with the smallest keyed hash go to test.

    No window spans a class: the 32-bit hash is cut into 65,536 buckets, the
    per-(class, bucket) counts give each class's boundary bucket, and only
    the rows of boundary buckets are ranked, partitioned by (class, bucket).
    """
    cls = F.col(stratify).cast("string") if stratify else F.lit("")
    k = F.concat(F.col(key).cast("string"), F.lit(f":exact-{purpose}-{seed}"))
    h = F.conv(F.substr(F.md5(k), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    d = df.select("*", cls.alias("_c"), h.alias("_h"),
                  F.floor(h / (4294967296 // EXACT_BUCKETS)).cast("int").alias("_b"))
    per = d.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("nb"))          # classes x buckets
    sizes = per.groupBy("_c").agg(F.sum("nb").alias("nc"))                   # one row per class
    n = sizes.agg(F.sum("nc")).scalar()
    n_test = F.ceil(n * F.lit(test_size))
    raw = F.col("nc") * n_test / n
    alloc = sizes.select("_c", F.floor(raw).alias("base"), (raw - F.floor(raw)).alias("frac"))
    short = n_test - alloc.agg(F.sum("base")).scalar()
    order = Window.orderBy(F.desc("frac"), F.asc("_c"))                      # one row per class
    alloc = alloc.select("_c", (F.col("base") + (F.row_number().over(order) <= short).cast("long"))
                         .alias("tc"))
    wcum = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = per.select("_c", "_b", "nb", F.sum("nb").over(wcum).alias("cum")).join(alloc, "_c")
    # boundary bucket: first bucket whose cumulative count reaches tc
    bnd = (cum.where(F.col("cum") >= F.col("tc")).groupBy("_c").agg(F.min("_b").alias("bb"))
           .join(cum.select("_c", "_b", (F.col("cum") - F.col("nb")).alias("before"), "tc"), "_c")
           .where(F.col("_b") == F.col("bb")).select("_c", "bb", "before", "tc"))
    j = d.join(F.broadcast(bnd), "_c", "left")   # bnd: one row per class
    decided = (j.where(F.col("bb").isNull() | (F.col("_b") != F.col("bb")))
               .select(*df.columns, F.coalesce(F.col("_b") < F.col("bb"), F.lit(False)).alias("is_test")))
    # only boundary buckets are ranked (about n_class / 65,536 rows each; the
    # key must be unique so that the hash spreads the rows)
    inside = Window.partitionBy("_c", "_b").orderBy("_h", key)
    edge = (j.where(F.col("_b") == F.col("bb"))
            .select(*df.columns, (F.col("before") + F.row_number().over(inside) <= F.col("tc")).alias("is_test")))
    return decided.unionByName(edge)


__all__ = ["split_flag", "split_exact", "fold_column", "fold_exact", "xy_views"]
