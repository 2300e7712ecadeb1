"""Hand-computed cases for the scalar expressions (C1-C17) and parsing."""

import pytest
from pyspark.sql import functions as F

from decklens.functions import expressions as X
from decklens.operators import text as T


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_parse_plain_and_rejected_lines(spark):
    text = "4 Lightning Bolt\n4x Bolt\nSideboard\nSB: 2 Foo\n3\n\n  2\tA  B\r\n0 zero"
    df = spark.createDataFrame([(1, text), (2, None)], "id int, txt string")
    rows = sorted((r.card_name, r.quantity) for r in T.parse_decklist(df, "txt", keep=["id"]).collect())
    assert rows == [("a  b", 2), ("lightning bolt", 4), ("zero", 0)]


def test_null_list_gives_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "id int, txt string")
    assert T.parse_decklist(df, "txt", keep=["id"]).count() == 0


def test_normalize_key_strips_tabs_and_unicode_space(spark):
    assert one_col(spark, [" \tAbC ", "x"], X.normalize_key) == ["abc", "x"]


def test_numeric_coerce_star_power(spark):
    assert one_col(spark, ["*", "1+*", "½", "1d", " 2 ", None], X.numeric_coerce) == [0.0, None, None, None, 2.0, None]


def test_color_count(spark):
    assert one_col(spark, ["[]", "['W']", "['W', 'U']", None, "W,U,B"], X.color_count) == [1, 1, 2, 1, 3]


def test_color_category(spark):
    got = one_col(spark, [0, 1, 2, 3, 10, 11], X.color_category, "int")
    assert got == ["mono", "mono", "two_color", "three_plus", "three_plus", "nan"]


def test_tier_multiclass(spark):
    assert one_col(spark, [1, 7, None], lambda c: X.tier_numeric(c).cast("int"), "int") == [1, 5, 3]


def test_competitive_label(spark):
    assert one_col(spark, ["1", "2", "10", "3", None], X.competitive_label) == [1, 1, 0, 0, 0]


def test_type_bonus(spark):
    got = one_col(spark, ["Creature", "Instant", "Planeswalker Creature", "Land", None], X.type_bonus)
    assert got == [0.3, 0.5, 2.0, 0.0, 0.0]


def test_rarity_value(spark):
    assert one_col(spark, ["Common", "MYTHIC", "Special", None], X.rarity_value) == [1.0, 4.0, None, None]


def test_card_power_score_of_missing_card(spark):
    n = F.lit(None).cast("string")
    v = spark.range(1).select(X.card_power_score(X.numeric_coerce(n), X.numeric_coerce(n), X.cmc_value(n),
                                                 X.rarity_value(n), n)).first()[0]
    assert v == pytest.approx(0.2)


def test_creature_efficiency_branches(spark):
    df = spark.createDataFrame([(2.0, 3.0, 5.0), (2.0, 3.0, 0.0), (2.0, None, 5.0), (2.0, 2.0, None)],
                               "p double, t double, c double")
    got = [r[0] for r in df.select(X.creature_efficiency("p", "t", "c")).collect()]
    assert got == pytest.approx([0.5, 1.5, 0.0, 2.0])


def test_keyed_uniform_is_partition_independent(spark):
    df = spark.range(1000)
    a = {r.id: r.u for r in df.select("id", X.keyed_uniform(F.col("id"), 42).alias("u")).collect()}
    b = {r.id: r.u for r in df.repartition(7).select("id", X.keyed_uniform(F.col("id"), 42).alias("u")).collect()}
    assert a == b and all(0 <= v < 1 for v in a.values())
