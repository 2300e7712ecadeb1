import random

import xxhash
from decklens.llm import simhash
from decklens.llm.common import Scratch


def brute_print(text, k=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, codes, distance=2):
    at = list(range(len(ids)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= distance:
                at[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[root(i)] for i in range(len(ids))]


def test_documents_match_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    extra = [(1000, None), (1001, ""), (1002, " \t "), (1003, "one two"), (1003, "one two"), (None, "one two"), (1005, "É A-Z b\nC d e " * 400)]
    rows = [(r[0], r[1]) for r in rows] + extra
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, code int, component_id string")
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["code"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    codes = [brute_print(t) for _, t in rows]
    want = sorted(((d is None, d, c, k) for (d, _), c, k in zip(rows, codes, brute_components([d for d, _ in rows], codes))), key=str)
    assert got == want


def test_long_text_is_read_whole():
    rng = random.Random(3)
    text = " ".join("w%d" % rng.randrange(50) for _ in range(400_000))
    assert len(text) > 1 << 20
    assert simhash.fingerprint(text) == brute_print(text)


def test_dense_and_random_codes(spark):
    rng = random.Random(5)
    codes = {rng.getrandbits(64) for _ in range(3000)}
    base = rng.getrandbits(64)
    codes |= {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(900)}
    chain = rng.getrandbits(64)
    for b in range(0, 60, 2):
        chain ^= 3 << b
        codes.add(chain)
    codes = sorted(codes)
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    s = Scratch(spark, "t")
    edges = simhash.links(s, spark.createDataFrame([(c,) for c in signed], "code long"), 2)
    roots = {r[0]: r[1] for r in simhash.components(s, edges).collect()}
    want = brute_components(signed, codes)
    groups = {}
    for c, k in zip(signed, want):
        groups.setdefault(k, set()).add(roots.get(c, c))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.one_of_each(df).collect() == []


def test_one_of_each(spark):
    rows = [(2, "a b c d", "k"), (1, "a b c d", "l"), (1, "a b c d", "m"), (7, "other words here now", None), (None, "a b c d", "n"),
            (None, "null id of its own", "o"), (None, "null id of its own", "p"), (None, "yet another null id text", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _hash string")
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((str(r[0]), r[1]) for r in out.collect()) == [("1", "a b c d"), ("7", "other words here now"), ("None", "null id of its own"), ("None", "yet another null id text")]
