"""Secret scan with a random forest that removes false positives.

Candidates are tokens of at least ``MIN_LENGTH`` characters of the base64 or
hexadecimal alphabets that hold a digit.  Each is described by its length and
character classes, the transitions between neighbouring characters, the share
covered by dictionary words, signs of a path, and its neighbouring words.  A
forest trained on labelled findings gives the probability that a candidate is
a secret.

The dictionary is the corpus itself: a run of letters inside a candidate is a
dictionary word if it occurs as a word of its own in at least ``MIN_DOCS``
documents, counted over all documents.

Everything is DataFrame expressions and Spark ML; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch

MIN_LENGTH = 16
MIN_DOCS = 2
BROADCAST_ROWS = 500_000
_SET = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{_SET}])(?=[A-Za-z+/_=-]*+[0-9])[{_SET}]{{{MIN_LENGTH},}}+"
CONTEXT = 48
HASH_BITS = 6
KEYWORDS = r"(?i)(secret|token|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer)"


def candidates(scratch: Scratch, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, start, value, left, right): every candidate with the text beside it; start in code points.

    The text between matches is split off with the same expression, so the
    starts are running sums over one document's parts.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .filter(F.col("text").rlike(CANDIDATE)))
    parts = rows.select("doc_id", F.monotonically_increasing_id().alias("uid"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("v"),
                        F.split("text", CANDIDATE, -1).alias("gap"))
    each = scratch.table(parts.select("doc_id", "uid", "gap", F.posexplode("v").alias("place", "value"))
                         .select("doc_id", "uid", "place", "value", F.length(F.get("gap", F.col("place"))).alias("skip"),
                                 F.right(F.get("gap", F.col("place")), F.lit(CONTEXT)).alias("left"), F.left(F.get("gap", F.col("place") + 1), F.lit(CONTEXT)).alias("right")))
    start = "sum(skip + length(value)) over (partition by uid order by place rows between unbounded preceding and current row) - length(value)"
    return each.select("uid", "doc_id", F.expr(start).cast("long").alias("start"), "value", "left", "right")


def _dictionary(scratch: Scratch, docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """(word): letter runs of candidates that are words of their own in enough documents."""
    runs = scratch.table(found.select(F.explode(F.split(F.lower("value"), "[^a-z]+")).alias("word")).filter("length(word) >= 4").distinct())
    n = runs.count()
    small = F.broadcast(runs) if n <= BROADCAST_ROWS else runs
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col(text_col).cast("string")), r"[\s.,;:!?\"'()|]+"))).alias("word"))
    return words.join(small, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS).select("word")


def _share(value: Column, chars: str) -> Column:
    return F.regexp_count(value, F.lit(chars)) / F.length(value)


def _bits(word: Column, name: str) -> list[Column]:
    h = F.xxhash64(word)
    return [F.when(word == "", 0.0).otherwise(F.shiftright(h, k).bitwiseAND(F.lit(1)).cast("double")).alias(f"{name}{k}") for k in range(HASH_BITS)]


def features(scratch: Scratch, docs: DataFrame, found: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``found`` with a numeric column for each feature, and the names of those columns."""
    word = _dictionary(scratch, docs, found, text_col)
    runs = (found.select("uid", "start", F.explode(F.split(F.lower("value"), "[^a-z]+")).alias("word")).filter("length(word) >= 4")
            .join(word, "word").groupBy("uid", "start").agg(F.sum(F.length("word")).alias("_covered")))
    v, n = F.col("value"), F.length("value").cast("double")
    chars = F.split(F.col("value"), "")
    spread = F.aggregate(F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n), F.lit(0.0),
                         lambda a, p: a - p * F.log2(p))
    last, first = F.element_at(F.split(F.rtrim(F.regexp_replace("left", r"[\s\"'=:>(]+$", "")), r"\s+"), -1), F.get(F.split(F.ltrim("right"), r"\s+"), F.lit(0))
    cols = {
        "length": n, "digits": _share(v, "[0-9]"), "upper": _share(v, "[A-Z]"), "lower": _share(v, "[a-z]"), "signs": _share(v, "[^A-Za-z0-9]"),
        "vowels": _share(v, "(?i)[aeiou]"), "hex": F.when(v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 1.0).otherwise(0.0), "spread": spread,
        "letter_digit": _share(v, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), "case": _share(v, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "same": _share(v, r"(.)(?=\1)"), "vowel_pairs": _share(v, "(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"),
        "covered": F.coalesce(F.col("_covered"), F.lit(0)) / n,
        "slashes": F.regexp_count(v, F.lit("/")).cast("double"), "path_left": F.when(F.col("left").rlike(r"(?:[/\\.@]|://\S*)$"), 1.0).otherwise(0.0),
        "path_right": F.when(F.col("right").rlike(r"^[/\\.@][A-Za-z0-9]"), 1.0).otherwise(0.0),
        "assigned": F.when(F.col("left").rlike(r"[=:]\s*[\"']?$"), 1.0).otherwise(0.0), "quoted": F.when(F.col("left").rlike("[\"']$"), 1.0).otherwise(0.0),
        "keyword": F.when(F.regexp_replace("left", r".*\s(?=\S+\s+\S+\s*$)", "").rlike(KEYWORDS), 1.0).otherwise(0.0),
    }
    out = found.join(runs, ["uid", "start"], "left")
    out = out.select(*found.columns, *[c.cast("double").alias(f"f_{k}") for k, c in cols.items()], *_bits(F.coalesce(last, F.lit("")), "f_left"), *_bits(F.coalesce(first, F.lit("")), "f_right"))
    return out, [c for c in out.columns if c.startswith("f_")]


def rule_labels(found: DataFrame) -> Column:
    """Label of a finding that fixed rules settle, else null.

    1: a 32-, 40- or 64-digit hexadecimal value or a value with a known key
    prefix, assigned to a name of the KEYWORDS.  0: a plain number, a value
    behind a path sign, or one with no sign of assignment.
    """
    v, left = F.col("value"), F.col("left")
    form = v.rlike(r"^(?:(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})|(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk[-_][A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,})$")
    named = left.rlike(KEYWORDS + r"[A-Za-z0-9_-]*[\"']?\s*[=:]\s*[\"']?$")
    return (F.when(v.rlike("^[0-9]+$"), 0).when(form & named, 1).when(left.rlike(r"[/\\@]$"), 0).when(~left.rlike(r"[=:\"']\s*$") & ~form, 0))


def scan(docs: DataFrame, labelled: Column | None = None, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
         max_rows: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 7) -> DataFrame:
    """(doc_id, start, stop, value, label, score): every candidate of every document with the forest's probability.

    ``labelled``: a column over candidates (value, left, right, doc_id) with 0,
    1 or null, by default ``rule_labels``; ``train``: which candidates may be
    learned from (default: all).  About ``max_rows`` labelled candidates,
    chosen by hash, are learned from.  If they do not hold both labels, the
    score is their mean (0.5 without any).  Null texts have no candidates;
    null and repeated ids keep theirs; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.table(candidates(scratch, docs, id_col, text_col).transform(lambda d: d.withColumn("label", (labelled if labelled is not None else rule_labels(d)).cast("int"))))
    rows, names = features(scratch, docs, found, text_col)
    rows = scratch.table(rows)
    known = rows.filter(F.col("label").isNotNull() & (train if train is not None else F.lit(True)))
    n, ones = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or not 0 < ones < n:
        scored = rows.withColumn("score", F.lit(ones / n if n else 0.5).cast("double"))
    else:
        part = known.filter(F.pmod(F.xxhash64("doc_id", "start", "value"), F.lit(1 << 30)) < int(min(1.0, max_rows / n) * (1 << 30)) + 1)
        assemble = VectorAssembler(inputCols=names, outputCol="_x")
        forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, predictionCol="_p", rawPredictionCol="_r", probabilityCol="_q")
        model = forest.fit(assemble.transform(scratch.table(part.select("label", *names))))
        scored = model.transform(assemble.transform(rows)).withColumn("score", F.get(vector_to_array("_q"), F.lit(1)))
    return scored.select("doc_id", "start", (F.col("start") + F.length("value")).alias("stop"), "value", "label", "score")
