"""Personal data: base expressions and bootstrapped contextual extraction.

The base expressions find e-mail addresses, IP addresses, card numbers and
phone numbers.  What they find are the seed entities.  The words beside every
entity, and beside every token or run of digit groups that only looks like an
identifier (enough digits, or an ``@``), form lexical patterns: two words to the left, two to the
right, or one on each side.  Spark scores the graph of patterns and instances
in rounds: a pattern's confidence in a kind is the share of trusted instances
of that kind among the distinct instances it extracts; a pattern with enough
of them is accepted; an instance is trusted once the accepted patterns that
extract it make it likely enough (noisy or).  Accepted patterns finally mark
the look-alikes beside them as identifiers of their kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, free_name, slices

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS, MIN_CONFIDENCE, MIN_TRUST = 3, 0.8, 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Any address, card or phone match lies inside one such run.
_REGION = re.compile(r"[0-9+][0-9 ().+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOK = re.compile(r"[0-9@]\S*")
#: Digit groups joined by a single blank, dot or hyphen or by brackets: the other forms of cards and phones.
_RUN = re.compile(r"(?<![\w@])(?:\+?\([0-9]++\)[ .-]?|\+)?[0-9]++(?:(?:[ .-]|[ .-]?\([0-9]++\)[ .-]?)[0-9]++)*+")
_EDGE = ".,;:!?\"'()[]{}<>|"
_WINDOW = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) <= 3 and int(p or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) sorted by start, then kind; leftmost non-overlapping per kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > last and _LOCAL.match(text[s - 1]):
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for r in _REGION.finditer(text):
        a, b = r.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(map(_small, m.group().split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text, a, b):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _fits(token: str) -> list[int]:
    """The kinds that a look-alike token could be."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = any(c.isalpha() for c in token)
    kinds = [0] if "@" in token and not token.startswith("@") and not token.endswith("@") else []
    if not letters and "@" not in token:
        kinds += [1] * (token.count(".") == 3 and digits >= 4) + [2] * (13 <= digits <= 19) + [3] * (7 <= digits <= 15)
    return kinds


def _overlaps(taken: list[tuple[int, int]], s: int, e: int) -> bool:
    """``taken``, the sorted spans from the first that ends behind ``s``, overlap (s, e)."""
    return any(a < e and s < b for a, b in taken)


def _spaced(text: str, base: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """Runs of digit groups that together have the digits of a card or phone number.

    A run that holds a complete number (a card's digits in one token, or an
    address) is left to the tokens.
    """
    out, k = [], 0
    for m in _RUN.finditer(text):
        run, s = m.group(), m.start()
        if re.match(r"[\w@]", text[m.end():m.end() + 1]):
            run = run.rstrip("0123456789").rstrip(" .-(")  # the last group belongs to a word
        e = s + len(run)
        if e - s < 7 or " " not in run and "(" not in run:
            continue
        kinds = [x for x in _fits(run) if x > 1]
        if kinds and not any(x in (1, 2) for w in run.split() for x in _fits(w) if " " in run):
            while k < len(base) and base[k][1] <= s:
                k += 1
            if not _overlaps(base[k:k + 3], s, e):
                out.append((s, e, kinds))
    return out


def _lookalikes(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, list[int]]]:
    taken, k = sorted((s, e) for s, _, e in base), 0
    out = _spaced(text, taken)
    taken = sorted(taken + [(s, e) for s, e, _ in out])
    for m in _LOOK.finditer(text):
        s, e = m.span()
        while s > 0 and not text[s - 1].isspace():  # one match a token: each is walked once
            s -= 1
        while e > s and text[e - 1] in _EDGE:
            e -= 1
        while s < e and text[s] in _EDGE:
            s += 1
        kinds = _fits(text[s:e])
        if kinds:
            while k < len(taken) and taken[k][1] <= s:
                k += 1
            if not _overlaps(taken[k:k + 3], s, e):
                out.append((s, e, kinds))
    return out


def _beside(text: str, at: int, step: int) -> list[str]:
    """The two words before (``step`` -1) or after (1) a place, in reading order; a part of a word that touches it is a word.

    Words come whole up to ``_WINDOW`` code points; of a longer one, those nearest to the place.
    """
    cut = text[max(0, at - _WINDOW):at] if step < 0 else text[at:at + _WINDOW]
    words = cut.split()
    if len(words) > 2 or len(cut) < _WINDOW or len(words) == 2 and (cut[0] if step < 0 else cut[-1]).isspace():
        return words[-2:] if step < 0 else words[:2]
    words, i, stop = [], at, 0 if step < 0 else len(text)
    here = -1 if step < 0 else 0  # text[i + here] is the next code point
    while i != stop and len(words) < 2:
        while i != stop and text[i + here].isspace():
            i += step
        start, n = i, 0
        while i != stop and n < _WINDOW and not text[i + here].isspace():
            i, n = i + step, n + 1
        if n:
            words.append(text[min(start, i):max(start, i)])
        if n == _WINDOW and i != stop and not text[i + here].isspace():
            break  # a longer word: what lies beyond it is no neighbour
    return words[::step]


def _patterns(text: str, s: int, e: int) -> list[str]:
    def mask(w: str) -> str:
        return "".join("0" if c.isdigit() else c for c in w.lower())

    left, right = [mask(w) for w in _beside(text, s, -1)], [mask(w) for w in _beside(text, e, 1)]
    out = ["L " + " ".join(left)] if len(left) == 2 else []
    if left and right:
        out.append(f"M {left[-1]} _ {right[0]}")
    if len(right) == 2:
        out.append("R " + " ".join(right))
    return out


def _instance(value: str) -> str:
    """What tells a mention from others: the value, or a hash of a long one."""
    value = value.lower()
    return value if len(value) <= 256 else "#" + hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


_MENTION = "array<struct<start:long,stop:long,kinds:array<int>,seed:boolean,instance:string,patterns:array<string>>>"
_SPANS = "array<struct<start:long,kind:int,stop:long>>"


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, hash of the text, base, mentions): one pass over the texts."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]))
    mention = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kinds", pa.list_(pa.int32())), ("seed", pa.bool_()),
                                  ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for batch in batches for s in slices(batch)):
            spans, mentions = [], []
            for t in b.column(2):
                t = t.as_py() or ""
                base = base_spans(t)
                found = [(s, e, [k], True) for s, k, e in base] + [(s, e, k, False) for s, e, k in _lookalikes(t, base)]
                spans.append([{"start": s, "kind": k, "stop": e} for s, k, e in base])
                mentions.append([{"start": s, "stop": e, "kinds": k, "seed": seed, "instance": _instance(t[s:e]), "patterns": _patterns(t, s, e)} for s, e, k, seed in found])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, span), pa.array(mentions, mention)], ["doc_id", "hash", "base", "mentions"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(run, f"doc_id long, hash long, base {_SPANS}, mentions {_MENTION}")


def learn_patterns(scratch: Scratch, mentions: DataFrame, rounds: int | None = None) -> DataFrame:
    """(pattern, kind, confidence) accepted over (kinds, seed, instance, patterns).

    Rounds go on until one trusts no further instance (trust is never taken
    back, so this ends), or for at most ``rounds`` if given.
    """
    edges = (mentions.select(F.explode("kinds").alias("kind"), "seed", "instance", "patterns")
             .select("kind", "seed", "instance", F.explode("patterns").alias("pattern"))
             .groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed")))
    n = 3 * mentions.count()  # a mention has at most three patterns
    edges = scratch.table(edges, n)
    trusted = scratch.table(edges.filter("seed").select("instance", "kind").distinct(), n)
    size, done = trusted.count(), 0
    while True:
        marked = edges.join(trusted.withColumn("good", F.lit(1)), ["instance", "kind"], "left")
        # an instance counts once for each pattern, whatever the kinds it could be; a pattern is judged for the kind it meets
        by = marked.groupBy("pattern", "kind").agg(F.count("good").alias("good"), F.count(F.lit(1)).alias("n"))
        other = by.groupBy("pattern").agg(F.sum("good").alias("all_good"))
        scored = (by.filter(F.col("good") >= MIN_SEEDS).join(other, "pattern")
                  .withColumn("confidence", F.col("good") / (F.col("n") + F.col("all_good") - F.col("good"))))
        accepted = scratch.table(scored.filter(F.col("confidence") >= MIN_CONFIDENCE).select("pattern", "kind", "confidence"), n)
        done += 1
        if done == rounds:
            return accepted
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
        likely = (edges.join(accepted, ["pattern", "kind"]).groupBy("instance", "kind").agg(doubt.alias("doubt"))
                  .filter(F.col("doubt") <= F.log(F.lit(1 - MIN_TRUST))).select("instance", "kind"))
        more = scratch.table(trusted.unionByName(likely).distinct(), n)
        scratch.drop(trusted)
        trusted, before, size = more, size, more.count()
        if size == before:
            return accepted
        scratch.drop(accepted)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, base, spans): one row for each input row.

    ``base`` and ``spans`` are arrays of (start, kind, stop) in code points,
    sorted by start, then kind (the place in KINDS); ``spans`` holds the base
    spans and those that accepted patterns add.  ``hash`` is the hash of the
    text.  Null texts are empty; null and repeated ids keep their rows; an
    empty table gives no rows.  Only the two named columns are read.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    rows = scratch.table(_read(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()))
    mentions = rows.filter(F.size("mentions") > 0).select("uid", F.explode("mentions").alias("m")).select("uid", "m.*")
    accepted = learn_patterns(scratch, mentions)
    added = (mentions.filter(~F.col("seed")).select("uid", "start", "stop", F.explode("kinds").alias("kind"), "patterns")
             .select("uid", "start", "stop", "kind", F.explode("patterns").alias("pattern")).join(accepted, ["pattern", "kind"])
             .groupBy("uid", "start", "stop").agg(F.min(F.struct(-F.col("confidence"), F.col("kind"))).alias("best"))
             .select("uid", F.struct("start", F.col("best.kind").alias("kind"), "stop").alias("span"))
             .groupBy("uid").agg(F.collect_list("span").alias("added")))  # the spans of one document
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return rows.join(added, "uid", "left").select("doc_id", "hash", "base", spans.alias("spans"))


def written(spans: str) -> str:
    """SQL of ``kind:start:end`` of each span, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.stop)), ',')"


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns, one row for each input row) with every span replaced by its kind in brackets.

    Null texts stay null.  Spans that overlap are replaced together.
    """
    names, extra = docs.columns, free_name(docs, "_spans")
    found = find(docs, id_col, text_col).filter(F.size("spans") > 0).groupBy("doc_id", "hash").agg(F.first("spans").alias(extra))
    at, types = names.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, spans in zip(b.column(at), b.column(b.num_columns - 1)):
                t, spans = t.as_py(), spans.as_py()
                if t is not None and spans:
                    parts, end = [], 0
                    for s in spans:
                        if s["start"] >= end:
                            parts += [t[end:s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                        end = max(end, s["stop"])
                    t = "".join(parts) + t[end:]
                out.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(out, b.schema.field(k).type) if k == at else b.column(k) for k in range(len(names))], names)

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    same = docs[id_col].cast("long").eqNullSafe(found["doc_id"]) & (F.xxhash64(text) == found["hash"])
    return docs.join(found, same, "left").select(*[docs[n] for n in names], found[extra]).mapInArrow(run, types)
