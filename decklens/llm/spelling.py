"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

Words are runs of ASCII and Latin-1 letters.  One inserted or deleted letter
changes a word's letter counts by one in one letter, one replaced letter by
one up and one down, so near words lie within L1 distance two.  For each
length there is a k-d tree over the letter-count vectors; a split asks whether
a letter occurs at least so many times.  The upper part of each tree is grown
over all words, by one count a level in Spark, until no node holds more than
``NODE_WORDS`` words; a node's words then meet in one task, which grows the
rest down to leaves of ``LEAF`` words.  A word of length L searches the trees
of L - 1, L and L + 1: a box is pruned as soon as the letters it needs more
(or fewer) than the word has exceed what the pair of lengths allows.  What is
left is compared by its whole vector, then by the order of its letters.

A vector is kept in unary (a bit for each letter and count), so that sums of
differences, also those to a box, are bit counts of a few 64-bit numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, shuffle_partitions, slices

NODE_WORDS = 16384
LEAF = 64
#: Pairs of words compared at once.
PAIRS = 1 << 18
#: Distinct words that a task holds before it hands on its counts.
HELD = 200_000

#: Latin-1 byte -> the lower-cased ASCII letter, a letter from U+00C0 as it is, a blank for anything else.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF as Latin-1 bytes, only A-Z lowered."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def spoiled(doc_id: int | None, words: list[bytes], every: int) -> list[bytes]:
    """``words`` with one letter deleted where ``every`` divides the CRC-32 of ``doc_id:word``, at its place modulo the length."""
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    plain = np.fromiter(map(zlib.crc32, words, repeat(begin)), dtype=np.uint64, count=len(words))
    for i in [i for i, w in enumerate(words) if not w.isascii()] if not b"".join(words).isascii() else []:
        plain[i] = zlib.crc32(words[i].decode("latin-1").encode(), begin)
    for i in np.flatnonzero(plain % np.uint64(every) == 0):
        w = words[i]
        at = int(plain[i]) % len(w)
        words[i] = w[:at] + w[at + 1:]
    return words


def word_counts(docs: DataFrame, deleted: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): occurrences of each word over all texts; ``deleted`` spoils one in so many, see ``spoiled``.

    Null texts hold no words; a null id counts as an empty one; repeated rows
    count again.  Only the two named columns are read.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return b

        for b in (s for batch in batches for s in slices(batch)):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = runs(text.as_py())
                held.update(spoiled(doc, words, deleted) if deleted else words)
                if len(held) > HELD:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").filter("word != ''").groupBy("word").agg(F.sum("n").alias("n"))


# --- letter-count vectors ------------------------------------------------------------------------

def letters(words: list[bytes], length: int) -> np.ndarray:
    """Letter counts (words x 256) of words of one length."""
    flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
    return np.bincount(np.repeat(np.arange(len(words)) * 256, length) + flat, minlength=len(words) * 256).reshape(len(words), 256)


def unary(counts: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Vectors in unary: bit (letter, c) is set if the letter occurs at least c times, c up to ``most`` of the letter."""
    bits = np.concatenate([counts[:, [x]] >= np.arange(1, m + 1) for x, m in enumerate(most) if m] + [np.zeros((len(counts), 1), bool)], axis=1)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1).view(np.uint64)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


#: How many more and how many fewer letters a word may need to be near one that is longer by the key.
ALLOWED = {1: (1, 0), 0: (1, 1), -1: (0, 1)}


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (letters of words; b's are as long or one longer) differ by one replaced or inserted letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    stop = np.zeros((len(a), 1), dtype=bool)
    before = np.concatenate([a == b[:, :-1], stop], axis=1).argmin(axis=1)
    behind = np.concatenate([(a == b[:, 1:])[:, ::-1], stop], axis=1).argmin(axis=1)
    return before + behind >= a.shape[1]


class Leafy:
    """The k-d tree over one node's words, which all have ``length`` letters; words are sorted by falling n, then by letters."""

    def __init__(self, words: list[bytes], n: np.ndarray, length: int):
        order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        self.words, self.n, self.length = [words[i] for i in order], n[order], length
        counts = letters(self.words, length)
        # one more than any count: what a query has beyond it adds the same to every distance and is seen by its length
        self.most = counts.max(axis=0) + 1
        self.most[counts.max(axis=0) == 0] = 0
        self.vectors = unary(counts, self.most)
        self.raw = np.frombuffer(b"".join(self.words), dtype=np.uint8).reshape(len(words), length)
        self.leaves: list = []
        self.root = self._grow(np.arange(len(words)))

    def _grow(self, rows: np.ndarray):
        v = self.vectors[rows]
        low, high = np.bitwise_and.reduce(v, axis=0), np.bitwise_or.reduce(v, axis=0)
        if len(rows) <= LEAF or (low == high).all():
            return low, high, rows, None
        bits = np.unpackbits(v.view(np.uint8), axis=1)
        split = np.abs(2 * bits.sum(axis=0, dtype=np.int64) - len(rows)).argmin()
        yes = bits[:, split] == 1
        return low, high, None, (self._grow(rows[~yes]), self._grow(rows[yes]))

    def search(self, queries: list[bytes], longer: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, words) that are near, as places; the queries' words have ``length - longer`` letters."""
        if not self.length - longer:
            return (np.repeat(np.arange(len(queries)), len(self.words)), np.tile(np.arange(len(self.words)), len(queries)))
        counts = letters(queries, self.length - longer)
        q, raw = unary(counts, self.most), np.frombuffer(b"".join(queries), dtype=np.uint8).reshape(len(queries), -1)
        other = np.maximum(counts - self.most, 0).sum(axis=1)  # letters that no vector here can show
        up, down = ALLOWED[longer]
        found: list = []

        def visit(node, ask: np.ndarray) -> None:
            low, high, rows, below = node
            ask = ask[(_bits(low & ~q[ask]) <= up) & (_bits(q[ask] & ~high) + other[ask] <= down)]
            if not len(ask):
                return
            if below:
                visit(below[0], ask)
                visit(below[1], ask)
                return
            step = max(1, PAIRS // len(rows))
            for at in range(0, len(ask), step):
                part = ask[at:at + step]
                i, j = np.nonzero(_bits(q[part][:, None] ^ self.vectors[rows][None]) + other[part][:, None] == up + down)
                step_in = max(1, PAIRS * 8 // self.length)
                for k in range(0, len(i), step_in):
                    x, y = part[i[k:k + step_in]], rows[j[k:k + step_in]]
                    a, b = raw[x], self.raw[y]
                    same = near(b, a) if longer < 0 else near(a, b)
                    found.append((x[same], y[same]))

        visit(self.root, np.flatnonzero(other <= down))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


# --- the upper part of the trees -----------------------------------------------------------------

#: length -> splits of its tree: node -> (letter, count); node k has the children 2k (fewer) and 2k + 1.
Top = dict[int, dict[int, tuple[int, int]]]


def _own(top: Top, counts: np.ndarray, length: int) -> np.ndarray:
    """The node of each vector in the tree of its length."""
    at = np.ones(len(counts), dtype=np.int64)
    splits = top.get(length, {})
    while True:
        held = [k for k in np.unique(at).tolist() if k in splits]
        if not held:
            return at
        for k in held:
            rows = np.flatnonzero(at == k)
            letter, c = splits[k]
            at[rows] = 2 * k + (counts[rows, letter] >= c)


def _visited(splits: dict[int, tuple[int, int]], counts: np.ndarray, longer: int) -> list[tuple[int, np.ndarray]]:
    """(node, places of the vectors whose near words may be there) of a tree whose words are longer by ``longer``."""
    out: list = []

    def visit(node: int, rows: np.ndarray, box: dict[int, tuple[int, int]]) -> None:
        if not len(rows):
            return
        if node not in splits:
            out.append((node, rows))
            return
        letter, c = splits[node]
        low, high = box.get(letter, (0, 1 << 40))
        for child, side in ((2 * node, (low, min(high, c - 1))), (2 * node + 1, (max(low, c), high))):
            inner = box | {letter: side}
            need = sum(np.maximum(a - counts[rows, x], 0) for x, (a, _) in inner.items())
            over = sum(np.maximum(counts[rows, x] - b, 0) for x, (_, b) in inner.items())
            visit(child, rows[(need <= ALLOWED[longer][0]) & (over <= ALLOWED[longer][1])], inner)

    visit(1, np.arange(len(counts)), {})
    return out


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(length, words, n) of the rows of a batch (word, n)."""
    words, n = [w.encode("latin-1") for w in b.column(0).to_pylist()], b.column(1).to_numpy(zero_copy_only=False)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(size).tolist():
        for rows in np.array_split(np.flatnonzero(size == length), 1 + (size == length).sum() // 4096):
            yield length, [words[i] for i in rows], n[rows]


def upper_trees(words: DataFrame, node_words: int = NODE_WORDS) -> Top:
    """Splits until no node of a tree holds more than ``node_words`` words, or a node's vectors are all alike.

    One job a level: the counts of each (letter, count) of the nodes that are
    too large are added up in Spark, which also picks the split that comes
    nearest to the half; the driver reads one row for each of these nodes.
    """
    spark, top = words.sparkSession, {}
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > node_words)
    large = {(r["length"], 1) for r in sizes.collect()}  # one row for each length with so many words
    while large:
        shared = spark.sparkContext.broadcast((top, large))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops, wanted = shared.value
            total: Counter = Counter()
            for b in batches:
                for length, part, _ in _by_length(b):
                    if all(x != length for x, _ in wanted):
                        continue
                    vectors = letters(part, length)
                    at = _own(tops, vectors, length)
                    for node in np.unique(at).tolist():
                        if (length, node) in wanted:
                            mine = vectors[at == node]
                            total[length, node, -1, 0] += len(mine)
                            for x in np.flatnonzero(mine.any(axis=0)).tolist():
                                at_least = np.bincount(mine[:, x])[::-1].cumsum()[::-1]
                                for c in range(1, len(at_least)):
                                    total[length, node, x, c] += int(at_least[c])
            cols = list(zip(*[(*k, v) for k, v in total.items()])) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["length", "node", "letter", "c", "n"])

        counted = (words.select("word", "n").mapInArrow(count, "length long, node long, letter long, c long, n long")
                   .groupBy("length", "node", "letter", "c").agg(F.sum("n").alias("n")))
        whole = counted.filter("letter < 0").select("length", "node", F.col("n").alias("size"))
        best = (counted.filter("letter >= 0").join(whole, ["length", "node"]).filter("n < size")
                .groupBy("length", "node").agg(F.min(F.struct(F.abs(2 * F.col("n") - F.col("size")).alias("off"), "letter", "c", "n", "size")).alias("best")).select("length", "node", "best.*"))
        large = set()
        for r in best.collect():  # one row for each node that is too large
            top.setdefault(r["length"], {})[r["node"]] = (r["letter"], r["c"])
            large |= {(r["length"], 2 * r["node"] + side) for side, n in enumerate((r["size"] - r["n"], r["n"])) if n > node_words}
    return top


_LINKS = "word string, n_near long, best_n long, best string"


def near_words(scratch: Scratch, words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``words`` (word, n; written) that have near words; best: of largest n, then first."""
    spark = scratch.spark
    shared = spark.sparkContext.broadcast(upper_trees(words, node_words))  # one split for each ``node_words`` words or so

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every word as a member of its own node (longer is null) and as a query of each node that its search visits."""
        top = shared.value
        for b in batches:
            for length, part, n in _by_length(b):
                vectors, text = letters(part, length), np.array([w.decode("latin-1") for w in part], dtype=object)
                out = [(length, node, None, np.flatnonzero(own == node)) for own in [_own(top, vectors, length)] for node in np.unique(own).tolist()]
                for longer in (-1, 0, 1):
                    out += [(length + longer, node, longer, rows) for node, rows in _visited(top.get(length + longer, {}), vectors, longer)]
                rows, size = np.concatenate([o[3] for o in out]), [len(o[3]) for o in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([o[0] for o in out], size), pa.int64()), pa.array(np.repeat([o[1] for o in out], size), pa.int64()),
                     pa.array([o[2] for o, k in zip(out, size) for _ in range(k)], pa.int32()), pa.array(text[rows], pa.string()), pa.array(n[rows], pa.int64())],
                    ["length", "node", "longer", "word", "n"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order (length, node, longer): a node's members (null first), then its queries."""
        at, members, count, index = None, [], [], None
        for b in batches:
            length, node, longer = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            kind = np.nan_to_num(longer.astype(np.float64), nan=-9).astype(np.int64)
            cuts = np.flatnonzero((np.diff(length) != 0) | (np.diff(node) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                part = [w.encode("latin-1") for w in b.column(3).slice(lo, hi - lo).to_pylist()]
                if (length[lo], node[lo]) != at:
                    at, members, count, index = (length[lo], node[lo]), [], [], None
                if kind[lo] == -9:
                    members += part
                    count.append(b.column(4).slice(lo, hi - lo).to_numpy())
                    continue
                if not members:
                    continue
                index = index or Leafy(members, np.concatenate(count), int(at[0]))
                x, y = index.search(part, int(kind[lo]))
                if len(x):
                    best = np.full(len(part), len(members))
                    np.minimum.at(best, x, y)
                    has = np.unique(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part[i].decode("latin-1") for i in has], pa.string()), pa.array(np.bincount(x)[has], pa.int64()),
                         pa.array(index.n[best[has]], pa.int64()), pa.array([index.words[j].decode("latin-1") for j in best[has]], pa.string())],
                        ["word", "n_near", "best_n", "best"])

    # spread over the tasks: a file of few words would be one of them
    dealt = words.select("word", "n").repartition(shuffle_partitions(spark)).mapInArrow(deal, "length long, node long, longer int, word string, n long")
    order = ["length", "node", F.col("longer").asc_nulls_first()]
    parts = dealt.repartition(shuffle_partitions(spark), "length", "node").sortWithinPartitions(*order).mapInArrow(search, _LINKS)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), "b.best")


def variants(counts: DataFrame, min_count: int = 5, min_length: int = 6, ratio: float = 5, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words of ``counts`` (word, n) with enough letters and occurrences.

    Words are near if they differ by exactly one inserted, deleted or replaced
    letter.  form: the near word of largest n (ties: first in code-point
    order) if that n is at least ``ratio`` times the word's, else null.  root:
    the end of the chain of forms, the word itself without a form.  No words
    give no rows.
    """
    scratch = Scratch(counts.sparkSession, "spelling")
    words = scratch.table(counts.filter((F.length("word") >= min_length) & (F.col("n") >= min_count)).select("word", "n"))
    links = near_words(scratch, words, node_words)
    has = F.col("best_n") >= ratio * F.col("n")
    rows = scratch.table(words.join(links, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")))
    # pointer doubling over the words that have a form; n grows by ``ratio`` a step, so chains are short
    jump = scratch.table(rows.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = jump.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        further = scratch.table(jump.join(on, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        scratch.drop(jump)
        jump = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return rows.join(jump, "word", "left").withColumn("root", F.coalesce("root", "word"))


#: DuckDB SQL of the query ``op11_spelling``: near words share what is left of them when a letter is taken out.
ORACLE = r"""
WITH RECURSIVE
bits AS (SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i::BIGINT) ORDER BY i) AS tb FROM range(256) r(i)),
found AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS k FROM found GROUP BY doc_id, run),
hashed AS (SELECT run, k, xor(list_reduce(flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)),
    lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM each, bits),
edited AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM edited GROUP BY word HAVING length(word) >= 6 AND sum(k) >= 5),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, length(word) + 1) r(i)),
links AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM links),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND place = 1),
chain(word, target, step) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT chain.word, form, step + 1 FROM chain JOIN forms ON chain.target = forms.word WHERE form IS NOT NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(target, step) AS root FROM chain GROUP BY word) r ON forms.word = r.word
"""
