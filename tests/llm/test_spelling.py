import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from decklens.llm import spelling


def brute_counts(rows, every=199):
    out = Counter()
    for d, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if d is None else d}:{r}".encode())
            if every and h % every == 0:
                at = h % len(r)
                r = r[:at] + r[at + 1:]
            out[r] += bool(r)
    return {w: n for w, n in out.items() if n}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, min_count=5, min_length=6, ratio=5):
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    # near words share what is left of them without one letter
    cut, out = {}, {}
    for w in words:
        for i in range(len(w)):
            cut.setdefault(w[:i] + w[i + 1:], set()).add((w, i))
    for w, n in words.items():
        near = {x for i in range(len(w)) for x, j in cut[w[:i] + w[i + 1:]] if i == j and x != w}
        near |= {w[:i] + w[i + 1:] for i in range(len(w))} & words.keys() | {x for x, _ in cut.get(w, ())}
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if near and words[best] >= ratio * n else None, len(near))
    rows = []
    for w, (form, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, words[w], k, words[form] if form else None))
    return sorted(rows)


def got(counts, **options):
    return sorted(tuple(r) for r in spelling.variants(counts, **options).select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_counts_and_variants_match_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(None, "null id words " * 9), (7, None), (7, ""), (8, "ÀÉ×ß÷ÿ Ābc x×y naïveté NAÏVETÉ naivete " * 40), (9, "a" * 5000), (9, ("Z" * 70000 + " é ") * 2), (10, "a b c")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    for every in (3, 199):
        counts = spelling.word_counts(df, deleted=every)
        want = brute_counts(docs, every)
        assert {r["word"]: r["n"] for r in counts.collect()} == want
    # brute force cuts every letter out of every word: not of the longest ones
    counts, want = counts.filter("length(word) < 100"), {w: n for w, n in want.items() if len(w) < 100}
    for length in (1, 6):
        rows = got(counts, min_count=2, min_length=length)
        assert rows == brute(want, 2, length) and any(r[1] for r in rows)


def _vocabulary(seed, size=1500, letters="abcdé"):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([5, 6, 6, 7, 8]))) for _ in range(size)}
    return {w: rng.choice([1, 5, 5, 30, 200, 1000, 5000, 30000]) for w in sorted(words)}


@pytest.mark.parametrize("node_words", [40, 200, 100000])
def test_dense_words_in_many_nodes(spark, node_words):
    counts = _vocabulary(node_words)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert got(df, min_count=1, min_length=1, node_words=node_words) == brute(counts, 1, 1)


def test_upper_trees_bound_their_nodes(spark):
    counts = {w: 9 for w in _vocabulary(5, 3000)} | {"".join(p): 9 for p in ["abcabc", "acbabc", "cababc"]}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    top = spelling.upper_trees(df, 50)
    for length in {len(w) for w in counts}:
        mine = [w.encode("latin-1") for w in counts if len(w) == length]
        vectors = spelling.letters(mine, length)
        at = spelling._own(top, vectors, length)
        for node in set(at.tolist()):
            inside = vectors[at == node]
            assert len(inside) <= 50 or (inside == inside[0]).all()


def test_anagrams_alone_cannot_be_split(spark):
    import itertools
    words = {"".join(p): 5 for p in itertools.permutations("abcdef")}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = got(df, node_words=50)
    assert len(rows) == 720 and all(r[4] == 0 and r[2] == r[0] for r in rows)


def test_near_by_letters():
    rng = random.Random(1)
    for _ in range(3000):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 6)))
        b = bytes(rng.choice(b"ab") for _ in range(len(a) + rng.randrange(2)))
        x, y = (np.frombuffer(w, np.uint8)[None] for w in (a, b))
        assert bool(spelling.near(x, y)[0]) == one_edit(a, b), (a, b)


def test_long_words_and_ties(spark):
    long = "x" * 900
    words = {long: 5, long + "y": 5, "x" * 899 + "y": 30, "aaaaab": 10, "aaaaac": 10, "aaaaaa": 2, "aaaaad": 10, "zzzzzz": 1, "aaaaaaa": 50}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(df, min_count=1) == brute(words, 1)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(empty, deleted=199)).collect() == []
    assert spelling.upper_trees(spelling.word_counts(empty)) == {}


def test_brute_force_knows_one_edit():
    words = {w: 1 for w in _vocabulary(3, 300, "ab")}
    assert [(r[0], r[4]) for r in brute(words, 1, 1)] == sorted((w, sum(one_edit(w, x) for x in words)) for w in words)
