"""Helpers shared by the corpus operators: scratch tables, words, gapless numbering."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow scratch table that share a file.
ROWS_PER_FILE = 250_000

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
SLAB = 1 << 20


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as make it unlike every column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, shared by driver and executors.

    A temporary folder is made only for a local master (tests); on a cluster
    an unset folder is an error, since a machine-local path would lose rows.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="decklens-llm-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


class Scratch:
    """Parquet tables in the shared folder; ``drop`` deletes those no longer read.

    A written table cuts the lineage: a lost executor costs a re-read of its
    files, never a recomputation of what led to them.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Write and read again; ``rows``, about how many narrow rows there are, keeps small tables in few files."""
        self.count += 1
        if rows is not None:
            df = df.coalesce(rows // ROWS_PER_FILE + 1)
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            path = self.paths.pop(id(t), None) if t is not None else None
            if path:
                jvm = self.spark._jvm
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def lower_slabs(text: str | None) -> Iterator[list[bytes]]:
    """Words (maximal runs of anything but ASCII white space) with A-Z lowered, in slabs of about 1 MB."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(raw) <= SLAB:
        yield raw.split()
        return
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, min(at + SLAB, len(raw)))
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()
        at = end


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch, so that only a few texts at a time become Python objects."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


_WORD = xxhash.xxh3_64_intdigest


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORD, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, element by element."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive 64-bit hash of each run of ``size`` word hashes; of the whole sequence if it is shorter."""
    n = len(h)
    if n == 0:
        return h
    size = min(size, n)
    out = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:n - size + 1 + i])
    return out


def crc32_text(col: Column) -> Column:
    """Unsigned CRC-32 of the value written as text (0 for null)."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")), F.lit(0).cast("long"))


def number_rows(scratch: Scratch, df: DataFrame, group: str, order: list[str], name: str, rows: int) -> DataFrame:
    """``df`` (of about ``rows`` narrow rows) with a gapless long ``name`` from 0 within each ``group``, ordered by ``order``.

    The rows are range-sorted by (group, order) and written once with their
    place in their partition; the places of a group that spans partitions are
    joined by the row counts of the earlier partitions, so a group of any size
    is numbered by as many tasks as it spans.
    """
    spark = scratch.spark
    parts = shuffle_partitions(spark)
    at = (df.repartitionByRange(parts, F.col(group), *[F.col(c) for c in order])
          .sortWithinPartitions(group, *order)
          .withColumn("_place", F.monotonically_increasing_id()))
    at = scratch.table(at.withColumn("_part", F.shiftright("_place", 33).cast("int"))
                       .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))), rows)
    runs = at.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # one row for each (group, partition it spans): at most groups + partitions rows, a window of at most `parts` rows
    before = F.expr(f"coalesce(sum(_n) over (partition by `{group}` order by _part rows between unbounded preceding and 1 preceding), 0L)")
    runs = runs.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), (before - F.col("_first")).alias("_shift"))
    return (at.join(runs, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn(name, F.col("_place") + F.col("_shift")).drop("_g", "_p", "_part", "_place", "_shift"))


