import random
import re

import pytest
from decklens.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for i, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(c) * (1 + j % 2) for j, c in enumerate(digits[::-1])]
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def test_base_spans_match_the_expressions(spark):
    rng = random.Random(9)
    pieces = ["@", "a", "b.c", ".", "-", "+", "1", "23", "255", "256", "4111111111111111", " ", "(", ")", "é", "@x.y", "1.2.3.4", "+1 (487) 555-7209", "%", "\n", "0004.", "٣"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30))) for _ in range(6000)]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for t in texts:
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("7" * 300_000) == [] and pii.base_spans("+" * 200_000 + "@" * 200_000) == []


def corpus(spark):
    valid = ["4%015d" % (i * 7919) for i in range(400)]
    valid = [v for v in valid if pii.luhn(v)][:8]
    broken = [v[:-1] + str((int(v[-1]) + 1) % 10) for v in valid]
    rows = [(i, f"please bill card number {v} before noon") for i, v in enumerate(valid)]
    rows += [(100, f"then bill card number {broken[0]} before noon"), (101, f"serial {broken[1]} of the part"), (102, None), (103, ""), (None, "mail a@b.cd"), (103, "")]
    return spark.createDataFrame([(d, t, "s", 1, 2) for d, t in rows], "doc_id long, text string, spans string, hash int, _spans int"), broken


def test_contexts_find_unseen_identifiers(spark):
    df, broken = corpus(spark)
    rows = pii.find(df).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == df.count()
    assert [s["kind"] for s in got[100]["spans"]] == [2] and got[100]["base"] == []
    assert got[101]["spans"] == [] and got[102]["spans"] == []
    assert [(s["start"], s["kind"], s["stop"]) for s in got[None]["spans"]] == [(5, 0, 11)]


def test_redaction(spark):
    df, broken = corpus(spark)
    out = pii.redact(df)
    assert out.columns == df.columns and out.count() == df.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[100] == "then bill card number [CARD] before noon" and texts[102] is None and texts[None] == "mail [EMAIL]"
    assert broken[1] in texts[101]


def test_base_stays_and_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.find(docs).collect():
        assert [tuple(s) for s in r["base"]] == brute(texts[r["doc_id"]])
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(empty).collect() == [] and pii.redact(empty).collect() == []


@pytest.mark.parametrize("token,kinds", [("555-1234", [3]), ("4111111111111112", [2]), ("a@", []), ("x(at)y@z", [0]), ("1.2.3.999", [1]), ("abc123456789", [])])
def test_kinds_of_lookalikes(token, kinds):
    assert pii._fits(token) == kinds


@pytest.mark.parametrize("text,found", [
    ("4111 1111 1111 1112", [("4111 1111 1111 1112", [2])]), ("0049 30 1234567", [("0049 30 1234567", [2, 3])]),
    ("call (487) 555-7209, or", [("(487) 555-7209", [3])]), ("(487)555.7209", [("(487)555.7209", [3])]), ("(0049 30 123456)", [("0049 30 123456", [3])]),
    ("tel: 030 (0) 12 34 56.", [("030 (0) 12 34 56", [3])]), ("4111-1111-1111-1112", [("4111-1111-1111-1112", [2])]),
    ("5 4111111111111112", [("4111111111111112", [2])]), ("1.2.3.999 80", [("1.2.3.999", [1])]), ("12 34 and 5  678901", []), ("a12 3456789", [("3456789", [3])]),
    ("(487) 555-7209 2nd", [("(487) 555-7209", [3])]), ("12 " * 40, []), ("1 " * 100_000 + "1x", []), ("+1 (487) 555-7209", []), ("555-1234 5551234567 5551234567", [("555-1234", [3]), ("5551234567", [3]), ("5551234567", [3])])])
def test_spaced_lookalikes(text, found):
    assert [(text[s:e], k) for s, e, k in pii._lookalikes(text, pii.base_spans(text))] == found


def test_contexts_find_spaced_identifiers(spark):
    valid = [v for v in ("4%015d" % (i * 7919) for i in range(400)) if pii.luhn(v)][:8]
    spaced = [" ".join(v[i:i + 4] for i in range(0, 16, 4)) for v in valid]
    rows = [(i, f"please bill card number {v} before noon") for i, v in enumerate(spaced)]
    rows += [(20 + i, f"or ring my phone +1 (487) 555-72{i:02d} after six") for i in range(8)]
    rows += [(100, "please bill card number 4111 1111 1111 1112 before noon"), (101, "or ring my phone (487) 555-7309 after six"), (102, "or ring my phone 0049 30 1234567 after six"),
             (103, "the part 4111 1111 1111 1112 was sold")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert texts[100] == "please bill card number [CARD] before noon"
    assert texts[101] == texts[102] == "or ring my phone [PHONE] after six" and texts[103] == rows[-1][1]


def test_spaced_lookalikes_count_against_a_pattern(spark):
    valid = [v for v in ("4%015d" % (i * 7919) for i in range(400)) if pii.luhn(v)][:4]
    rows = [(i, f"the serial number {v} was read") for i, v in enumerate(valid)]
    broken = [n for n in ("9111 1111 1111 %04d" % i for i in range(40)) if not pii.luhn(n.replace(" ", ""))][:12]
    rows += [(100 + i, f"the serial number {n} was read") for i, n in enumerate(broken)]
    rows += [(200, "the serial number 4111111111111112 was read")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[200] == [] and got[100] == []


def test_long_logins_and_runs_are_taken_whole(spark):
    seeds = [(i, f"please write to login user{i}@example.org before noon") for i in range(8)]
    login = "x" * 300 + "(at)y@z"
    df = spark.createDataFrame(seeds + [(50, f"then write to login {login} before noon")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(df).collect()}
    assert [(s["start"], s["kind"], s["stop"]) for s in got[50]["spans"]] == [(20, 0, 20 + len(login))]
    texts = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert texts[50] == "then write to login [EMAIL] before noon"
    run = "0 (0) " + " ".join(["(1)"] * 16) + " 2"
    assert len(run) > 64 and [(s, e) for s, e, _ in pii._spaced(run, [])] == [m.span() for m in pii._RUN.finditer(run) if pii._fits(m.group())]


@pytest.mark.parametrize("left,words", [("a b c ", ["b", "c"]), ("", []), ("c ", ["c"]), ("x" * 70 + " ", ["x" * 64]), ("w " + "y" * 40 + " " + "z" * 50 + " ", ["y" * 40, "z" * 50]),
                                        ("one two" + " " * 200, ["one", "two"]), ("q " * 3 + "k=", ["q", "k="])])
def test_neighbour_words_are_whole(left, words):
    assert pii._beside(left + "@", len(left), -1) == words
    right = left[::-1]
    assert pii._beside("@" + right, 1, 1) == [w[::-1] for w in words[::-1]]


def test_rounds_go_on_until_nothing_new_is_trusted(spark):
    """A chain: each context is learned from the instances that the one before made trusted."""
    valid = [v for v in ("4%015d" % (i * 7919) for i in range(16000)) if pii.luhn(v)][:1364]
    unseen, sizes, rows, at = [v[:-1] + str((int(v[-1]) + 1) % 10) for v in valid], (256, 64, 16, 4), [], 0
    held = valid[:1024]
    for depth, size in enumerate(sizes):
        new, at = unseen[at:at + size], at + size
        rows += [f"x left{'abcd'[depth]} mid {v} end tail{'abcd'[depth]} x" for v in held + new]
        held = new
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert all([s["kind"] for s in r["spans"]] == [2] for r in pii.find(df).collect())
