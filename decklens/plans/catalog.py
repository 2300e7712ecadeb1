"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each Spark callable takes (spark, sf_dir) and returns a DataFrame over the
whole driver tables.  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from decklens.operators import features as FT
from decklens.plans import oracle as O
from decklens.plans.prepare import deck_features
from decklens.sources import driver_tables as D

SparkQuery = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[SparkQuery, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: SparkQuery) -> SparkQuery:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column (floats widened to double)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sql_rounded(inner: str, doubles: list[str], others: list[str]) -> str:
    sel = [f'"{c}"' for c in others] + [f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in doubles]
    return f"SELECT {', '.join(sel)} FROM ({inner}) AS _r"


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return D.load_inputs(spark, sf_dir)


# --------------------------------------------------------------------------
# Flagship: the feature table
# --------------------------------------------------------------------------
_FEATURE_DOUBLES = [c for c in FT.FEATURE_COLUMNS if c not in ("total_cards", "unique_types")] + \
    ["competitiveness_score"]
_FEATURE_OTHERS = ["deck_name", "row_id", "tier", "year", "total_cards", "unique_types",
                   "competitive", "tier_multiclass"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = inputs(spark, sf_dir)
    # the fragments are built from the orders, so every list has its deck
    return rounded(deck_features(i["cards"], i["deck_lists"], i["decks"], lists_from_decks=True))


register("deck_features", sql_rounded(O.with_ctes(*O.FEATURES_CTES) + "SELECT * FROM final",
                                      _FEATURE_DOUBLES, _FEATURE_OTHERS))(flagship)


# --------------------------------------------------------------------------
# helpers shared by several queries
# --------------------------------------------------------------------------
from decklens.functions import expressions as X  # noqa: E402
from decklens.operators import metrics as M  # noqa: E402
from decklens.operators import profile as P  # noqa: E402
from decklens.operators import split as S  # noqa: E402
from decklens.operators import text as T  # noqa: E402
from decklens.operators.joins import attach_deck_attributes, merge_cards, prune_card_columns  # noqa: E402


def _cards(spark, sf_dir):
    return D.cards_from_part(D.read_table(spark, sf_dir, "part"))


def _cards_n(spark, sf_dir):
    c = _cards(spark, sf_dir)
    return c.withColumn("name", X.normalize_key("name"))


def _decks_n(spark, sf_dir):
    d = D.decks_from_orders(D.read_table(spark, sf_dir, "orders"))
    return d.withColumn("Name", X.normalize_key("Name"))


def _deck_cards(spark, sf_dir):
    i = inputs(spark, sf_dir)
    _, lists = T.normalize_frames(i["cards"], i["deck_lists"])
    return T.expand_decks(lists, extra=["row_id"])


def _features_only(spark, sf_dir):
    i = inputs(spark, sf_dir)
    cards_n, lists_n = T.normalize_frames(i["cards"], i["deck_lists"])
    return FT.deck_aggregates(T.expand_decks(lists_n), cards_n)


def _sql(body: str, ctes=None) -> str:
    return O.with_ctes(*(ctes or O.BASE)) + body


def _both(name, spark_fn, sql_body, doubles=(), others=(), ctes=None):
    """Register a query whose doubles are rounded on both sides."""
    sql = None if sql_body is None else sql_rounded(_sql(sql_body, ctes), list(doubles), list(others))
    register(name, sql)(lambda spark, sf_dir: rounded(spark_fn(spark, sf_dir)))


CARD_COLS = ["name", "cmc", "rarity", "color_identity", "type", "power", "toughness", "text"]

# --------------------------------------------------------------------------
# B: normalisation, parsing, expansion
# --------------------------------------------------------------------------
_both("normalize_names",
      lambda s, d: _cards(s, d).select(F.col("name").alias("raw_name"),
                                       X.normalize_key("name").alias("name")),
      f"SELECT name AS raw_name, lower({O.strip('name')}) AS name FROM cards_raw",
      others=["raw_name", "name"])

_both("parse_decklist",
      lambda s, d: T.parse_decklist(inputs(s, d)["deck_lists"], "Deck list", keep=["row_id"]),
      "SELECT row_id, card_name, quantity FROM deck_cards",
      others=["row_id", "card_name", "quantity"])

_both("expand_decks", _deck_cards,
      "SELECT row_id, deck_name, tier, year, card_name, quantity FROM deck_cards",
      others=["row_id", "deck_name", "tier", "year", "card_name", "quantity"])

_both("prune_columns", lambda s, d: prune_card_columns(_cards_n(s, d)),
      "SELECT * FROM cards", doubles=["cmc"],
      others=["name", "rarity", "color_identity", "type", "power", "toughness", "text"])

_both("fill_string",
      lambda s, d: _cards(s, d).select(
          "name", F.when(F.col("type").contains("Planeswalker"), F.length("name") % 5)
          .alias("loyalty")).select("name", F.coalesce(F.col("loyalty").cast("string"), F.lit(""))
                                    .alias("loyalty")),
      "SELECT name, coalesce(CAST(CASE WHEN contains(type, 'Planeswalker') THEN length(name) % 5 END"
      " AS VARCHAR), '') AS loyalty FROM cards_raw",
      others=["name", "loyalty"])


def _shape(spark, sf_dir):
    c = _cards(spark, sf_dir)
    dk = D.decks_from_orders(D.read_table(spark, sf_dir, "orders"))
    dc = _deck_cards(spark, sf_dir)
    return P.shape(c, "cards").unionByName(P.shape(dk, "decks")).unionByName(P.shape(dc, "deck_cards"))


_both("profile_shape", _shape,
      "SELECT 'cards' AS \"table\", CAST(count(*) AS BIGINT) AS n_rows, CAST(8 AS BIGINT) AS n_cols FROM cards_raw"
      " UNION ALL SELECT 'decks', count(*), 4 FROM decks"
      " UNION ALL SELECT 'deck_cards', count(*), 6 FROM deck_cards",
      others=["table", "n_rows", "n_cols"])

# --------------------------------------------------------------------------
# C: scalar expressions over the card catalogue / decks
# --------------------------------------------------------------------------
_VALS_SQL = ("vals AS (SELECT *, {rar} AS rarity_v,"
             " TRY_CAST(replace(power, '*', '0') AS DOUBLE) AS p,"
             " TRY_CAST(replace(toughness, '*', '0') AS DOUBLE) AS t,"
             " coalesce(CAST(CAST(cmc AS FLOAT) AS DOUBLE), 1.0::DOUBLE) AS cmc1,"
             " lower(coalesce(type, 'nan')) AS tl, lower(coalesce(text, 'nan')) AS xl,"
             " len(string_split(regexp_replace(coalesce(color_identity, 'nan'), '[\\[\\]]', '', 'g'), ','))"
             " AS cc FROM cards)").format(rar=O._rarity_case("rarity"))
_CARD_CTES = O.BASE + [_VALS_SQL]
_EFF = ("CASE WHEN p IS NOT NULL AND t IS NOT NULL AND cmc1 > 0 THEN (p + t) / cmc1 * 0.5::DOUBLE"
        " WHEN p IS NOT NULL AND t IS NOT NULL AND cmc1 <= 0 THEN (p + t) * 0.3::DOUBLE ELSE 0.0::DOUBLE END")
_BONUS = ("CASE WHEN contains(tl, 'planeswalker') THEN 2.0::DOUBLE WHEN regexp_matches(tl, 'instant|sorcery')"
          " THEN 0.5::DOUBLE WHEN contains(tl, 'creature') THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END")


def _card_expr(*cols):
    def fn(spark, sf_dir):
        c = _cards_n(spark, sf_dir)
        return c.select("name", *[e(c).alias(n) for n, e in cols])
    return fn


def _p(c):
    return X.numeric_coerce(c.power)


def _t(c):
    return X.numeric_coerce(c.toughness)


_both("rarity_value", _card_expr(("rarity", lambda c: c.rarity), ("rarity_value", lambda c: X.rarity_value(c.rarity))),
      "SELECT name, rarity, rarity_v AS rarity_value FROM vals", doubles=["rarity_value"],
      others=["name", "rarity"], ctes=_CARD_CTES)
_both("numeric_coerce", _card_expr(("power", lambda c: c.power), ("toughness", lambda c: c.toughness),
                                   ("power_num", _p), ("toughness_num", _t)),
      "SELECT name, power, toughness, p AS power_num, t AS toughness_num FROM vals",
      doubles=["power_num", "toughness_num"], others=["name", "power", "toughness"], ctes=_CARD_CTES)
_both("creature_efficiency",
      _card_expr(("creature_efficiency", lambda c: X.creature_efficiency(_p(c), _t(c), X.cmc_value(c.cmc)))),
      f"SELECT name, {_EFF} AS creature_efficiency FROM vals", doubles=["creature_efficiency"],
      others=["name"], ctes=_CARD_CTES)
_both("type_bonus", _card_expr(("type", lambda c: c.type), ("type_bonus", lambda c: X.type_bonus(c.type))),
      f"SELECT name, type, {_BONUS} AS type_bonus FROM vals", doubles=["type_bonus"],
      others=["name", "type"], ctes=_CARD_CTES)
_both("card_power_score",
      _card_expr(("card_power_score", lambda c: X.card_power_score(
          _p(c), _t(c), X.cmc_value(c.cmc), X.rarity_value(c.rarity), c.type))),
      f"SELECT name, {_EFF} + coalesce(rarity_v, 1.0::DOUBLE) * 0.2::DOUBLE + {_BONUS} AS card_power_score"
      " FROM vals", doubles=["card_power_score"], others=["name"], ctes=_CARD_CTES)
_both("type_flags", _card_expr(*[(f"is_{w}", (lambda w: lambda c: X.type_flag(c.type, w))(w))
                                 for w in X.TYPE_WORDS]),
      "SELECT name, " + ", ".join(f"CAST(contains(tl, '{w}') AS INTEGER) AS is_{w}" for w in X.TYPE_WORDS)
      + " FROM vals", others=["name"] + [f"is_{w}" for w in X.TYPE_WORDS], ctes=_CARD_CTES)
_both("keyword_flags", _card_expr(*[(f"has_{k}", (lambda k: lambda c: X.keyword_flag(c.text, k))(k))
                                    for k in FT.KEYWORDS]),
      "SELECT name, " + ", ".join(f"CAST(({cond}) AS INTEGER) AS has_{k}" for k, cond in O._KW.items())
      + " FROM vals", others=["name"] + [f"has_{k}" for k in FT.KEYWORDS], ctes=_CARD_CTES)
_both("color_count", _card_expr(("color_identity", lambda c: c.color_identity),
                                ("color_count", lambda c: X.color_count(c.color_identity))),
      "SELECT name, color_identity, CAST(cc AS INTEGER) AS color_count FROM vals",
      others=["name", "color_identity", "color_count"], ctes=_CARD_CTES)
_both("color_category", _card_expr(("color_category", lambda c: X.color_category(X.color_count(c.color_identity)))),
      "SELECT name, CASE WHEN cc <= 1 THEN 'mono' WHEN cc <= 2 THEN 'two_color' WHEN cc <= 10 THEN 'three_plus'"
      " ELSE 'nan' END AS color_category FROM vals", others=["name", "color_category"], ctes=_CARD_CTES)


def _deck_expr(*cols):
    def fn(spark, sf_dir):
        d = _decks_n(spark, sf_dir)
        return d.select("row_id", *[e(d).alias(n) for n, e in cols])
    return fn


_both("clip_values", _deck_expr(("tier_clipped", lambda d: X.clip(d.Tier - 1, 1, 3, 3)),
                                ("year_clipped", lambda d: X.clip(d.Year, 1996, 2000))),
      "SELECT row_id, least(greatest(coalesce(Tier - 1, 3), 1), 3) AS tier_clipped,"
      " CASE WHEN Year IS NOT NULL THEN least(greatest(Year, 1996), 2000) END AS year_clipped FROM decks",
      others=["row_id", "tier_clipped", "year_clipped"])
_both("competitive_label", _deck_expr(("tier", lambda d: d.Tier), ("competitive", lambda d: X.competitive_label(d.Tier))),
      "SELECT row_id, Tier AS tier, CASE WHEN regexp_matches(CAST(Tier AS VARCHAR), '^[12]$') THEN 1 ELSE 0 END"
      " AS competitive FROM decks", others=["row_id", "tier", "competitive"])
_both("competitiveness_base",
      _deck_expr(("base_score", lambda d: X.competitiveness_base(X.tier_numeric(d.Tier)))),
      "SELECT row_id, " + O.BASE_CASE.replace("tier_num", "least(greatest(coalesce(CAST(Tier AS DOUBLE), 3.0), 1.0), 5.0)")
      + " AS base_score FROM decks", doubles=["base_score"], others=["row_id"])


def _targets(spark, sf_dir):
    d = _decks_n(spark, sf_dir).withColumnRenamed("Tier", "tier")
    return FT.add_targets(d).select("row_id", "tier", *FT.TARGET_COLUMNS)


_both("competitiveness_score",
      lambda s, d: _targets(s, d).select("row_id", "competitiveness_score"),
      "SELECT row_id, competitiveness_score FROM final",
      doubles=["competitiveness_score"], others=["row_id"],
      ctes=O.BASE + ["features AS (SELECT DISTINCT Name AS deck_name FROM decks)", O.TARGETS])
_both("targets", _targets,
      "SELECT row_id, tier, competitive, tier_multiclass, competitiveness_score FROM final",
      doubles=["competitiveness_score"], others=["row_id", "tier", "competitive", "tier_multiclass"],
      ctes=O.BASE + ["features AS (SELECT DISTINCT Name AS deck_name FROM decks)", O.TARGETS])

# --------------------------------------------------------------------------
# E: joins
# --------------------------------------------------------------------------
_MERGED_OUT = ["deck_name", "tier", "year", "card_name", "quantity", "rarity", "color_identity",
               "type", "power", "toughness", "text"]
_both("merge_cards",
      lambda s, d: merge_cards(T.expand_decks(T.normalize_frames(_cards(s, d), inputs(s, d)["deck_lists"])[1]),
                               _cards_n(s, d)),
      "SELECT * FROM merged", doubles=["cmc"], others=_MERGED_OUT, ctes=O.BASE + [O.MERGED])


def _deck_attrs(spark, sf_dir):
    f = _features_only(spark, sf_dir).select("deck_name")
    return attach_deck_attributes(f, _decks_n(spark, sf_dir), complete=True)  # the fragments are built from the orders


_both("deck_attributes", _deck_attrs,
      "SELECT f.deck_name, d.row_id, d.Tier AS tier, d.Year AS year FROM"
      " (SELECT DISTINCT deck_name FROM deck_cards WHERE deck_name IS NOT NULL) f"
      " LEFT JOIN decks d ON f.deck_name = d.Name",
      others=["deck_name", "row_id", "tier", "year"])

# --------------------------------------------------------------------------
# D: per-deck aggregates (subsets of the fused aggregate)
# --------------------------------------------------------------------------
_AGG_CTES = O.BASE + [O.MERGED, O.VALUES, O.AGG]
_DECK_GROUPS = {
    "power_score": ["power_score"],
    "cmc_curve": ["avg_cmc", "std_cmc", "var_cmc"],
    "rarity_weighted": ["total_cards", "avg_rarity_weighted"],
    "type_percentages": X.TYPE_PCT_COLUMNS,
    "keyword_percentages": FT.KEYWORD_PCT_COLUMNS,
    "board_presence": ["avg_power", "avg_toughness"],
    "mana_efficiency": ["mana_efficiency"],
    "color_percentages": FT.COLOR_PCT_COLUMNS + ["avg_colors"],
    "unique_types": ["unique_types"],
}
for _name, _cols in _DECK_GROUPS.items():
    _ints = [c for c in _cols if c in ("total_cards", "unique_types")]
    _dbl = [c for c in _cols if c not in _ints]
    _both(_name, (lambda cols: lambda s, d: _features_only(s, d).select("deck_name", *cols))(_cols),
          f"SELECT deck_name, {', '.join(_cols)} FROM features", doubles=_dbl,
          others=["deck_name"] + _ints, ctes=_AGG_CTES)


def _color_pivot(spark, sf_dir):
    i = inputs(spark, sf_dir)
    cards_n, lists_n = T.normalize_frames(i["cards"], i["deck_lists"])
    return FT.color_pivot(T.expand_decks(lists_n), cards_n)


_both("color_pivot", _color_pivot,
      "SELECT deck_name, " + ", ".join(
          f"CAST(sum(CASE WHEN color_category = '{c}' THEN quantity ELSE 0 END) AS BIGINT) AS {c}"
          for c in X.COLOR_LABELS) + " FROM vals WHERE deck_name IS NOT NULL GROUP BY deck_name",
      others=["deck_name"] + X.COLOR_LABELS, ctes=O.BASE + [O.MERGED, O.VALUES])


def _baseline(spark, sf_dir):
    i = inputs(spark, sf_dir)
    cards_n, lists_n = T.normalize_frames(i["cards"], i["deck_lists"])
    _, decks_n = T.normalize_frames(i["cards"], i["decks"])
    b = FT.baseline_features(T.expand_decks(lists_n), cards_n)
    return attach_deck_attributes(b, decks_n, complete=True)


_both("baseline_features", _baseline,
      "SELECT a.deck_name, a.avg_cmc, a.avg_rarity, a.total_cards, a.avg_colors, f.unique_types,"
      " d.row_id, d.Tier AS tier, d.Year AS year FROM"
      " (SELECT deck_name, avg(cmc) AS avg_cmc, avg(rarity_v) AS avg_rarity,"
      "  CAST(sum(quantity) AS BIGINT) AS total_cards, avg(cc) AS avg_colors"
      "  FROM vals WHERE deck_name IS NOT NULL GROUP BY deck_name) a"
      " JOIN features f ON a.deck_name = f.deck_name LEFT JOIN decks d ON a.deck_name = d.Name",
      doubles=["avg_cmc", "avg_rarity", "avg_colors"],
      others=["deck_name", "total_cards", "unique_types", "row_id", "tier", "year"], ctes=_AGG_CTES)


_DISTINCT_COLS = ["deck_name", "card_name", "tier", "year", "quantity"]
_both("distinct_values", lambda s, d: P.distinct_values(_deck_cards(s, d), _DISTINCT_COLS),
      " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct"
                         " FROM deck_cards" for c in _DISTINCT_COLS),
      others=["column", "n_distinct"])

_both("deck_features_view",
      lambda s, d: flagship(s, d).select(*FT.FEATURE_COLUMNS, *FT.TARGET_COLUMNS),
      "SELECT " + ", ".join(FT.FEATURE_COLUMNS + FT.TARGET_COLUMNS) + " FROM final",
      doubles=_FEATURE_DOUBLES, others=["total_cards", "unique_types", "competitive", "tier_multiclass"],
      ctes=O.FEATURES_CTES)

# --------------------------------------------------------------------------
# A: sources and sinks (scratch output under spark.checkpoint.dir)
# --------------------------------------------------------------------------
from decklens.sources import io as IO  # noqa: E402

_both("csv_roundtrip", lambda s, d: IO.csv_roundtrip(inputs(s, d)["deck_lists"], "deck_lists"),
      'SELECT f.row_id, \' Deck \' || CAST(o.o_custkey AS VARCHAR) || chr(9) AS Name, f.Tier, f.Year,'
      ' f.deck_list AS "Deck list" FROM fragments f JOIN orders o ON f.row_id = o.o_orderkey',
      others=["row_id", "Name", "Tier", "Year", "Deck list"])
_both("csv_cards_na", lambda s, d: IO.csv_roundtrip(_cards(s, d), "cards"),
      "SELECT name, cmc, rarity, color_identity, type, power, toughness, nullif(text, '') AS text FROM cards_raw",
      doubles=["cmc"], others=["name", "rarity", "color_identity", "type", "power", "toughness", "text"])
_both("parquet_roundtrip", lambda s, d: IO.parquet_roundtrip(_deck_cards(s, d), "deck_cards"),
      "SELECT row_id, deck_name, tier, year, card_name, quantity FROM deck_cards",
      others=["row_id", "deck_name", "tier", "year", "card_name", "quantity"])

# --------------------------------------------------------------------------
# F: profiling
# --------------------------------------------------------------------------


def _value_counts(spark, sf_dir):
    c, dk = _cards(spark, sf_dir), _decks_n(spark, sf_dir)
    return (P.value_counts(c, "rarity").unionByName(P.value_counts(c, "color_identity"))
            .unionByName(P.value_counts(dk, "Tier")))


_both("value_counts", _value_counts,
      " UNION ALL ".join(
          f"SELECT '{col}' AS \"column\", CAST({col} AS VARCHAR) AS value, count(*) AS n,"
          f" count(*) / (SELECT count(*) FROM {t})::DOUBLE AS share FROM {t} GROUP BY {col}"
          for col, t in [("rarity", "cards_raw"), ("color_identity", "cards_raw"), ("Tier", "decks")]),
      doubles=["share"], others=["column", "value", "n"])

_both("null_fraction", lambda s, d: P.null_fraction(IO.na_to_null(_cards(s, d))),
      "SELECT \"column\", null_fraction FROM (UNPIVOT (SELECT "
      + ", ".join(f"avg(CAST(nullif({c}, '') IS NULL AS DOUBLE)) AS {c}" if c != "cmc"
                  else f"avg(CAST({c} IS NULL AS DOUBLE)) AS {c}" for c in CARD_COLS)
      + " FROM cards_raw) ON COLUMNS(*) INTO NAME \"column\" VALUE null_fraction)"
      " ORDER BY null_fraction DESC, \"column\" LIMIT 10",
      doubles=["null_fraction"], others=["column"])

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li(spark, sf_dir):
    return D.read_table(spark, sf_dir, "lineitem")


_both("describe", lambda s, d: P.describe(_li(s, d), _LI_NUM),
      " UNION ALL ".join(
          f"SELECT '{c}' AS \"column\", count({c}) AS count,"
          f" avg({c}) AS mean, stddev_samp({c}) AS std,"
          f" min({c})::DOUBLE AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,"
          f" quantile_cont({c}, 0.75) AS p75, max({c})::DOUBLE AS max FROM lineitem" for c in _LI_NUM),
      doubles=["mean", "std", "min", "p25", "p50", "p75", "max"], others=["column", "count"])

_both("histogram", lambda s, d: P.histogram(_li(s, d), "l_extendedprice", 15),
      "SELECT bin, lo + (bin - 1) * ((hi - lo) / 15) AS bin_lo, lo + bin * ((hi - lo) / 15) AS bin_hi,"
      " count(*) AS n FROM (SELECT CASE WHEN hi = lo THEN 1 ELSE"
      " least(CAST(floor(15 * (x - lo) / (hi - lo)) AS BIGINT) + 1, 15) END AS bin, lo, hi FROM"
      " (SELECT l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),"
      " (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)) GROUP BY bin, lo, hi",
      doubles=["bin_lo", "bin_hi"], others=["bin", "n"])

_both("kde", lambda s, d: P.kde(_cards(s, d), "cmc", 100),
      "SELECT g, lo + (hi - lo) * g / 99 AS x,"
      " sum(c * exp(-0.5 * ((lo + (hi - lo) * g / 99 - v) / h) * ((lo + (hi - lo) * g / 99 - v) / h)))"
      " / (n * h * sqrt(2 * pi())) AS density FROM"
      " (SELECT cmc AS v, count(*) AS c FROM cards_raw WHERE cmc IS NOT NULL GROUP BY cmc),"
      " (SELECT count(cmc)::DOUBLE AS n, min(cmc) AS lo, max(cmc) AS hi,"
      "  stddev_samp(cmc) * pow(count(cmc)::DOUBLE, -0.2) AS h FROM cards_raw),"
      " (SELECT CAST(range AS INTEGER) AS g FROM range(100)) GROUP BY g, lo, hi, n, h",
      doubles=["x", "density"], others=["g"])

_PAIR_COLS = ["avg_cmc", "avg_rarity_weighted", "avg_colors", "unique_types", "total_cards"]
_both("pairwise_corr", lambda s, d: P.pairwise_corr(_features_only(s, d), _PAIR_COLS),
      " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM features"
                         for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]),
      doubles=["corr"], others=["feature_a", "feature_b"], ctes=_AGG_CTES)
_both("pair_sample", lambda s, d: P.pair_sample(_features_only(s, d), _PAIR_COLS, "deck_name", 500),
      " UNION ALL ".join(f"SELECT deck_name, '{a}' AS feature_a, '{b}' AS feature_b, {a} AS a, {b} AS b FROM"
                         " (SELECT * FROM features ORDER BY md5(deck_name || ':pairs-42'), deck_name LIMIT 500)"
                         for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]),
      doubles=["a", "b"], others=["deck_name", "feature_a", "feature_b"], ctes=_AGG_CTES)

_DC_TYPES = [("row_id", "bigint"), ("deck_name", "string"), ("tier", "int"), ("year", "int"),
             ("card_name", "string"), ("quantity", "int")]
_both("column_info", lambda s, d: P.column_info(_deck_cards(s, d)),
      " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS non_null, '{t}' AS dtype FROM deck_cards"
                         for c, t in _DC_TYPES),
      others=["column", "non_null", "dtype"])


def _top_k(spark, sf_dir):
    f = attach_deck_attributes(_features_only(spark, sf_dir), _decks_n(spark, sf_dir), complete=True)
    f = FT.add_targets(f)
    imp = f.agg(*[F.abs(P.correlation(c, "competitive")).alias(c) for c in FT.FEATURE_COLUMNS])
    long = imp.unpivot([], FT.FEATURE_COLUMNS, "feature", "importance")
    return P.top_k(long, "importance", 20, "feature")


_both("top_k", _top_k,
      "SELECT feature, importance FROM (UNPIVOT (SELECT "
      + ", ".join(f"abs(corr(CAST({c} AS DOUBLE), CAST(competitive AS DOUBLE))) AS {c}" for c in FT.FEATURE_COLUMNS)
      + " FROM final) ON COLUMNS(*) INTO NAME feature VALUE importance)"
      " ORDER BY importance DESC NULLS LAST, feature LIMIT 20",
      doubles=["importance"], others=["feature"], ctes=O.FEATURES_CTES)

# --------------------------------------------------------------------------
# G: splits and folds
# --------------------------------------------------------------------------


def _u_sql(key: str, salt_sql: str) -> str:
    return (f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':' || {salt_sql}), 1, 8) AS BIGINT)"
            " / 4294967296.0e0)")


_TGT_CTES = O.BASE + ["features AS (SELECT DISTINCT Name AS deck_name FROM decks)", O.TARGETS]


def _split_q(kind):
    def fn(spark, sf_dir):
        t = _targets(spark, sf_dir)
        if kind == "split_stratified":
            out = S.split_flag(t, "row_id", purpose="cls", stratify="competitive").select(
                "row_id", "competitive", "is_test")
        elif kind == "split_random":
            out = S.split_flag(t, "row_id", purpose="reg").select("row_id", "competitiveness_score", "is_test")
        elif kind == "kfold_stratified":
            out = S.fold_column(t, "row_id", purpose="cls", stratify="competitive").select(
                "row_id", "competitive", "fold")
        else:
            out = S.fold_column(t, "row_id", purpose="reg").select("row_id", "fold")
        return out
    return fn


_both("split_stratified", _split_q("split_stratified"),
      f"SELECT row_id, competitive, {_u_sql('row_id', chr(39) + 'split-cls-42:' + chr(39) + ' || competitive')}"
      " < 0.25 AS is_test FROM final", others=["row_id", "competitive", "is_test"], ctes=_TGT_CTES)
_both("split_random", _split_q("split_random"),
      f"SELECT row_id, competitiveness_score, {_u_sql('row_id', chr(39) + 'split-reg-42' + chr(39))} < 0.25 AS is_test"
      " FROM final", doubles=["competitiveness_score"], others=["row_id", "is_test"], ctes=_TGT_CTES)
_both("kfold_stratified", _split_q("kfold_stratified"),
      f"SELECT row_id, competitive, CAST(floor({_u_sql('row_id', chr(39) + 'fold-cls-42:' + chr(39) + ' || competitive')}"
      " * 5) AS INTEGER) AS fold FROM final", others=["row_id", "competitive", "fold"], ctes=_TGT_CTES)
_both("kfold", _split_q("kfold"),
      f"SELECT row_id, CAST(floor({_u_sql('row_id', chr(39) + 'fold-reg-42' + chr(39))} * 5) AS INTEGER) AS fold"
      " FROM final", others=["row_id", "fold"], ctes=_TGT_CTES)

# --------------------------------------------------------------------------
# H: metrics over deterministic stand-in predictions
# --------------------------------------------------------------------------
_U0 = _u_sql("o_orderkey", "''")
_PRED_CTES = [
    "cls_pred AS (SELECT model, row_id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM ("
    " SELECT m.model, o_orderkey AS row_id,"
    " CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) IN (1, 2) AS INTEGER) AS label,"
    f" round(0.7::DOUBLE * {_U0} + 0.3::DOUBLE *"
    " CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) IN (1, 2) AS INTEGER), 2) AS score"
    " FROM orders, (VALUES " + ", ".join(f"('{m}')" for m in D.CLS_MODELS) + ") m(model)))",
    "reg_pred AS (SELECT model, row_id, y AS label, y + (ue - 0.5) * 0.2 * (i + 1) / 5.0::DOUBLE AS prediction"
    " FROM (SELECT m.model, m.i, o_orderkey AS row_id,"
    " CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) / 5.0::DOUBLE"
    f" + ({_u_sql('o_orderkey', chr(39) + 'y' + chr(39))} - 0.5) * 0.1::DOUBLE AS y,"
    f" {_u_sql('o_orderkey', chr(39) + 'e' + chr(39))} AS ue"
    " FROM orders, (VALUES " + ", ".join(f"({i}, '{m}')" for i, m in enumerate(D.REG_MODELS)) + ") m(i, model)))",
]
_MET_CTES = _PRED_CTES + [
    "cm AS (SELECT model, count(*) AS n,"
    " sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,"
    " sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,"
    " sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn,"
    " sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn FROM cls_pred GROUP BY model)",
    "cls_m AS (SELECT model, coalesce((tp + tn) / nullif(n, 0)::DOUBLE, 0.0) AS accuracy,"
    " coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0.0) AS precision,"
    " coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0.0) AS recall,"
    " coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0.0) AS f1 FROM cm)",
    # AUC: for each positive, negatives with a lower score + half the ties
    "sc AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM cls_pred GROUP BY model, score)",
    "sc2 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,"
    " coalesce(sum(pos) OVER (PARTITION BY model ORDER BY score"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below FROM sc)",
    "auc AS (SELECT model, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN"
    " sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg))::DOUBLE END AS roc_auc FROM sc2 GROUP BY model)",
    "results AS (SELECT c.model, c.accuracy, c.f1, a.roc_auc FROM cls_m c LEFT JOIN auc a ON c.model = a.model)",
    "reg_m AS (SELECT model, 1 - sum((label - prediction) ^ 2) / (var_pop(label) * count(*)) AS r2,"
    " avg(abs(label - prediction)) AS mae, sqrt(avg((label - prediction) ^ 2)) AS rmse FROM reg_pred GROUP BY model)",
]


def _orders(spark, sf_dir):
    return D.read_table(spark, sf_dir, "orders")


def _cls_pred(spark, sf_dir):
    return D.pseudo_classification(_orders(spark, sf_dir))


def _reg_pred(spark, sf_dir):
    return D.pseudo_regression(_orders(spark, sf_dir))


def _results(spark, sf_dir):
    return M.model_results(_cls_pred(spark, sf_dir))


_both("metrics_classification", lambda s, d: M.classification_metrics(_cls_pred(s, d)),
      "SELECT * FROM cls_m", doubles=["accuracy", "precision", "recall", "f1"], others=["model"], ctes=_MET_CTES)
_both("metrics_auc", lambda s, d: M.roc_auc(_cls_pred(s, d)),
      "SELECT * FROM auc", doubles=["roc_auc"], others=["model"], ctes=_MET_CTES)
_both("metrics_regression", lambda s, d: M.regression_metrics(_reg_pred(s, d)),
      "SELECT * FROM reg_m", doubles=["r2", "mae", "rmse"], others=["model"], ctes=_MET_CTES)
_both("confusion_matrix", lambda s, d: M.confusion_matrix(_cls_pred(s, d)),
      "SELECT model, label, count(*) FILTER (WHERE prediction = 0) AS pred_0,"
      " count(*) FILTER (WHERE prediction = 1) AS pred_1 FROM cls_pred GROUP BY model, label",
      others=["model", "label", "pred_0", "pred_1"], ctes=_MET_CTES)
_REPORT_CTE = ("r AS (SELECT model,"
               " coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0.0) AS p0, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0.0) AS r0,"
               " coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0.0) AS f0, CAST(tn + fp AS BIGINT) AS s0,"
               " coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0.0) AS p1, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0.0) AS r1,"
               " coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0.0) AS f1, CAST(tp + fn AS BIGINT) AS s1 FROM cm)")
_both("classification_report", lambda s, d: M.classification_report(_cls_pred(s, d)),
      "SELECT model, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, CAST(s0 AS BIGINT) AS support FROM r"
      " UNION ALL SELECT model, '1', p1, r1, f1, s1 FROM r"
      " UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM r"
      " UNION ALL SELECT model, 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),"
      " (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM r",
      doubles=["precision", "recall", "f1"], others=["model", "class", "support"], ctes=_MET_CTES + [_REPORT_CTE])
_both("roc_curve", lambda s, d: M.roc_curve(_cls_pred(s, d)),
      "SELECT model, score AS threshold, (N - neg_below) / N::DOUBLE AS fpr, (P - pos_below) / P::DOUBLE AS tpr"
      " FROM sc2 JOIN (SELECT model AS m2, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY model) t"
      " ON sc2.model = t.m2",
      doubles=["threshold", "fpr", "tpr"], others=["model"], ctes=_MET_CTES)
_both("metrics_unpivot", lambda s, d: P.unpivot_metrics(_results(s, d), "model", ["accuracy", "f1", "roc_auc"]),
      "SELECT model, metric, score FROM (UNPIVOT results ON accuracy, f1, roc_auc INTO NAME metric VALUE score)",
      doubles=["score"], others=["model", "metric"], ctes=_MET_CTES)
_both("rank_models", lambda s, d: P.rank_rows(_results(s, d), "f1", "model"),
      "SELECT *, CAST(row_number() OVER (ORDER BY f1 DESC NULLS LAST, model) AS INTEGER) AS rank FROM results",
      doubles=["accuracy", "f1", "roc_auc"], others=["model", "rank"], ctes=_MET_CTES)
_both("best_model", lambda s, d: P.top_k(_results(s, d), "f1", 1, "model"),
      "SELECT * FROM results ORDER BY f1 DESC NULLS LAST, model LIMIT 1",
      doubles=["accuracy", "f1", "roc_auc"], others=["model"], ctes=_MET_CTES)
_both("metrics_summary", lambda s, d: M.metrics_summary(_results(s, d)),
      "SELECT b.model AS best_model, b.accuracy AS best_accuracy, b.f1 AS best_f1, b.roc_auc AS best_roc_auc,"
      " (SELECT string_agg(model || ':' || coalesce(printf('%.6f', accuracy), 'null') || ':'"
      " || coalesce(printf('%.6f', f1), 'null') || ':' || coalesce(printf('%.6f', roc_auc), 'null'), ';'"
      " ORDER BY model) FROM results) AS all_models"
      " FROM (SELECT * FROM results ORDER BY f1 DESC NULLS LAST, model LIMIT 1) b",
      doubles=["best_accuracy", "best_f1", "best_roc_auc"], others=["best_model", "all_models"], ctes=_MET_CTES)
_both("chart_series", lambda s, d: M.chart_series(_results(s, d), ["accuracy", "f1", "roc_auc"]),
      "SELECT model, metric, coalesce(value, 0.0) AS value, printf('%.3f', coalesce(value, 0.0)) AS label"
      " FROM (UNPIVOT results ON accuracy, f1, roc_auc INTO NAME metric VALUE value)",
      doubles=["value"], others=["model", "metric", "label"], ctes=_MET_CTES)


def _pred_vs_actual(spark, sf_dir):
    rp = _reg_pred(spark, sf_dir)
    best = P.top_k(M.regression_metrics(rp), "r2", 1, "model").select("model")
    p = rp.join(F.broadcast(best), "model", "left_semi")  # best: one row
    lo = p.agg(F.least(F.min("label"), F.min("prediction"))).scalar()
    hi = p.agg(F.greatest(F.max("label"), F.max("prediction"))).scalar()
    return p.select("model", "row_id", F.col("label").alias("actual"), F.col("prediction").alias("predicted"),
                    lo.alias("line_lo"), hi.alias("line_hi"))


_both("pred_vs_actual", _pred_vs_actual,
      "SELECT model, row_id, label AS actual, prediction AS predicted,"
      " (SELECT least(min(label), min(prediction)) FROM reg_pred WHERE model = b.m) AS line_lo,"
      " (SELECT greatest(max(label), max(prediction)) FROM reg_pred WHERE model = b.m) AS line_hi"
      " FROM reg_pred JOIN (SELECT model AS m FROM reg_m ORDER BY r2 DESC NULLS LAST, model LIMIT 1) b"
      " ON reg_pred.model = b.m",
      doubles=["actual", "predicted", "line_lo", "line_hi"], others=["model", "row_id"], ctes=_MET_CTES)
_both("predictions_long",
      lambda s, d: IO.parquet_roundtrip(_cls_pred(s, d), "predictions", partition_by=["model"]),
      "SELECT * FROM cls_pred", doubles=["score"], others=["model", "row_id", "label", "prediction"],
      ctes=_MET_CTES)

# --------------------------------------------------------------------------
# H: model training (rows-only checks) and kNN / standardisation / OLS (SQL)
# --------------------------------------------------------------------------
from decklens.operators import knn as KNN  # noqa: E402
from decklens.operators import ml as ML  # noqa: E402

# The training queries search the reference's whole grids (``ML.CLS_GRID`` /
# ``ML.REG_GRID``) with 5 folds on one written feature table; the README gives times.


def _feature_table(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return deck_features(i["cards"], i["deck_lists"], i["decks"], lists_from_decks=True)


def _written_split(spark, sf_dir, task):
    """(training rows, test rows, label) of the feature table, written once for all folds and settings."""
    label = "competitive" if task == "cls" else "competitiveness_score"
    f = ML.cut_lineage(_feature_table(spark, sf_dir))
    d = ML.cut_lineage(S.split_exact(f, "row_id", stratify=label if task == "cls" else None, purpose=task))
    return d.where(~F.col("is_test")), d.where(F.col("is_test")), label


def _train_one(name, task):
    def fn(spark, sf_dir):
        train, test, label = _written_split(spark, sf_dir, task)
        grid = (ML.CLS_GRID if task == "cls" else ML.REG_GRID)[name]
        t = ML.grid_search(train, FT.FEATURE_COLUMNS, label, name, grid, task)
        return ML.predict(t, test, FT.FEATURE_COLUMNS, label, task)
    return fn


for _n, _task, _key in [("logreg", "cls", "clf_logistic"), ("svm", "cls", "clf_svm"), ("knn", "cls", "clf_knn_decks"),
                        ("rf", "cls", "clf_forest"), ("xgb", "cls", "clf_boosted"),
                        ("ridge", "reg", "reg_ridge"), ("svr", "reg", "reg_svr"),
                        ("rf_reg", "reg", "reg_forest"), ("xgb_reg", "reg", "reg_boosted")]:
    register(_key, None)((lambda n, t: lambda s, d: rounded(_train_one(n, t)(s, d)))(_n, _task))


def _grid_search(spark, sf_dir):
    train, _, label = _written_split(spark, sf_dir, "cls")
    grid = ML.CLS_GRID["logreg"]
    t = ML.grid_search(train, FT.FEATURE_COLUMNS, label, "logreg", grid, "cls")
    return spark.createDataFrame([(float(c), float(m)) for c, m in zip(grid["C"], t.cv_metrics)],
                                 "C double, mean_cv_f1 double")


register("grid_search", None)(lambda s, d: rounded(_grid_search(s, d)))


def _compare(task):
    def fn(spark, sf_dir):
        f = _feature_table(spark, sf_dir)
        label = "competitive" if task == "cls" else "competitiveness_score"
        res, _, _ = ML.compare_models(f, FT.FEATURE_COLUMNS, label, ML.CLS_GRID if task == "cls" else ML.REG_GRID, task)
        return res.withColumn("best_params", F.to_json("best_params"))
    return fn


register("compare_classifiers", None)(lambda s, d: rounded(_compare("cls")(s, d)))
register("compare_regressors", None)(lambda s, d: rounded(_compare("reg")(s, d)))


def _importance(spark, sf_dir):
    train, _, label = _written_split(spark, sf_dir, "cls")
    t = ML.grid_search(train, FT.FEATURE_COLUMNS, label, "rf", ML.CLS_GRID["rf"], "cls")
    return P.top_k(ML.feature_importance(t, FT.FEATURE_COLUMNS), "importance", 20, "feature")


register("feature_importance", None)(lambda s, d: rounded(_importance(s, d)))


def _score_new(spark, sf_dir, compare=False):
    from pyspark.ml import PipelineModel
    train, test, label = _written_split(spark, sf_dir, "cls")
    t = ML.grid_search(train, FT.FEATURE_COLUMNS, label, "logreg", ML.CLS_GRID["logreg"], "cls")
    path = IO.scratch_path(spark, "model")
    t.model.write().overwrite().save(path)                       # A5: save
    loaded = PipelineModel.load(path)                            # A5: load
    new = test.select("row_id", *FT.FEATURE_COLUMNS)
    out = loaded.transform(new).select("row_id", F.col("prediction").cast("int").alias("prediction"),
                                       vector_to_array("probability")[1].alias("score"))
    if compare:
        before = t.model.transform(new).select("row_id", F.col("prediction").cast("int").alias("pred_before"))
        out = out.join(before, "row_id").select("row_id", (F.col("prediction") == F.col("pred_before")).alias("same"))
    return out


def _one_feature(model, setting):
    """The registry pipeline (assembler, scaler, penalised fit) on one feature, where the optimum has a closed form."""
    def fn(spark, sf_dir):
        f = _feature_table(spark, sf_dir)
        t = ML.fit_single(f, ["power_score"], "competitiveness_score", model, setting, "reg")
        return ML.predict(t, f, ["power_score"], "competitiveness_score", "reg").select("row_id", "label", "prediction")
    return fn


from pyspark.ml.functions import vector_to_array  # noqa: E402

register("score_new_decks", None)(lambda s, d: rounded(_score_new(s, d)))

_STD_COLS = ["avg_cmc", "power_score", "avg_colors", "unique_types", "total_cards"]


def _standardize(spark, sf_dir):
    f = ML.cut_lineage(_features_only(spark, sf_dir).select("deck_name", *_STD_COLS))  # read once for the scalars and once for the rows
    return f.select("deck_name", *[ML.standardize_column(f, c).alias(c) for c in _STD_COLS])


_both("standardize", _standardize,
      "SELECT deck_name, " + ", ".join(
          f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1.0"
          f" ELSE stddev_pop({c}) OVER () END AS {c}" for c in _STD_COLS) + " FROM features",
      doubles=_STD_COLS, others=["deck_name"], ctes=_AGG_CTES)


def _ols(spark, sf_dir):
    f = attach_deck_attributes(_features_only(spark, sf_dir), _decks_n(spark, sf_dir), complete=True)
    f = FT.add_targets(f)
    return ML.simple_ols(f, "power_score", "competitiveness_score")


_both("reg_linear", _ols,
      "SELECT regr_slope(competitiveness_score, power_score) AS slope,"
      " regr_intercept(competitiveness_score, power_score) AS intercept, count(*) AS n FROM final",
      doubles=["slope", "intercept"], others=["n"], ctes=O.FEATURES_CTES)


def _emb_split(spark, sf_dir):
    e = D.read_table(spark, sf_dir, "embeddings")
    return S.split_flag(e, "vec_id", purpose="knn")


def _knn(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    return KNN.knn_predict(e.where(~F.col("is_test")), e.where(F.col("is_test")), k=5).select(
        "vec_id", "prediction")


def _knn_nn(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    return KNN.nearest_neighbours(e.where(~F.col("is_test")), e.where(F.col("is_test")), k=5)


_KNN_CTES = O.BASE + [
    f"e AS (SELECT vec_id, embedding, label, {_u_sql('vec_id', chr(39) + 'split-knn-42' + chr(39))} < 0.25 AS is_test"
    " FROM embeddings)",
    "pairs AS (SELECT q.vec_id AS qid, t.vec_id AS nid, t.label AS nlabel,"
    " sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1),"
    " lambda i: (q.embedding[i]::DOUBLE - t.embedding[i]::DOUBLE) * (q.embedding[i]::DOUBLE - t.embedding[i]::DOUBLE))))"
    " AS dist FROM e q, e t WHERE q.is_test AND NOT t.is_test)",
    "nn AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY dist, nid) AS INTEGER)"
    " AS rank FROM pairs)"
    " WHERE rank <= 5)",
]
_both("knn_neighbours", _knn_nn, "SELECT qid, nid, dist, rank FROM nn",
      doubles=["dist"], others=["qid", "nid", "rank"], ctes=_KNN_CTES)
_both("clf_knn", _knn,
      "SELECT qid AS vec_id, nlabel AS prediction FROM (SELECT qid, nlabel, row_number() OVER"
      " (PARTITION BY qid ORDER BY count(*) DESC, nlabel) AS r FROM nn GROUP BY qid, nlabel) WHERE r = 1",
      others=["vec_id", "prediction"], ctes=_KNN_CTES)
REGISTRY["knn_embeddings"] = REGISTRY["clf_knn"]


def _metrics_json(spark, sf_dir):
    summary = M.metrics_summary(_results(spark, sf_dir))
    path = IO.scratch_path(spark, "metrics_json")
    IO.write_json(summary, path)                                  # A4
    return spark.read.schema(summary.schema).json(path)


_both("metrics_json", _metrics_json,
      "SELECT b.model AS best_model, b.accuracy AS best_accuracy, b.f1 AS best_f1, b.roc_auc AS best_roc_auc,"
      " (SELECT string_agg(model || ':' || coalesce(printf('%.6f', accuracy), 'null') || ':'"
      " || coalesce(printf('%.6f', f1), 'null') || ':' || coalesce(printf('%.6f', roc_auc), 'null'), ';'"
      " ORDER BY model) FROM results) AS all_models"
      " FROM (SELECT * FROM results ORDER BY f1 DESC NULLS LAST, model LIMIT 1) b",
      doubles=["best_accuracy", "best_f1", "best_roc_auc"], others=["best_model", "all_models"], ctes=_MET_CTES)


def _xy(spark, sf_dir):
    x, _ = S.xy_views(_feature_table(spark, sf_dir), FT.FEATURE_COLUMNS, "competitive")
    return x


_both("xy_views", _xy, "SELECT row_id, " + ", ".join(FT.FEATURE_COLUMNS) + " FROM final",
      doubles=[c for c in FT.FEATURE_COLUMNS if c not in ("total_cards", "unique_types")],
      others=["row_id", "total_cards", "unique_types"], ctes=O.FEATURES_CTES)


def _split_exact(spark, sf_dir):
    t = _targets(spark, sf_dir)
    return S.split_exact(t, "row_id", stratify="competitive").select("row_id", "competitive", "is_test")


_EXACT = [
          "sb AS (SELECT row_id, competitive, CAST(competitive AS VARCHAR) AS c,"
          " CAST('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':exact-cls-42'), 1, 8) AS BIGINT) AS h FROM final)",
          "sizes AS (SELECT c, count(*) AS nc FROM sb GROUP BY c)",
          "tot AS (SELECT sum(nc) AS n, ceil(sum(nc) * 0.25) AS nt FROM sizes)",
          "alloc0 AS (SELECT c, floor(nc * nt / n) AS base, nc * nt / n - floor(nc * nt / n) AS frac FROM sizes, tot)",
          "alloc AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, c)"
          " <= (SELECT nt FROM tot) - (SELECT sum(base) FROM alloc0) THEN 1 ELSE 0 END AS tc FROM alloc0)",
          "ranked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY h, row_id) AS rn FROM sb)"]
_both("split_exact", _split_exact,
      "SELECT row_id, competitive, rn <= tc AS is_test FROM ranked JOIN alloc USING (c)",
      others=["row_id", "competitive", "is_test"], ctes=_TGT_CTES + _EXACT)
_both("model_roundtrip", lambda s, d: _score_new(s, d, compare=True),
      "SELECT row_id, TRUE AS same FROM ranked JOIN alloc USING (c) WHERE rn <= tc", others=["row_id", "same"], ctes=O.FEATURES_CTES + _EXACT)
for _key, _model, _setting, _alpha in [("reg_linear_closed_form", "linear_reg", {}, 0), ("reg_ridge_closed_form", "ridge", {"alpha": 100, "max_iter": 1000}, 100)]:
    _both(_key, _one_feature(_model, _setting),
          "SELECT row_id, competitiveness_score AS label, yb + covar / s * n / (n + %d) * (power_score - m) / s AS prediction FROM final,"
          " (SELECT avg(power_score) AS m, stddev_pop(power_score) AS s, avg(competitiveness_score) AS yb,"
          " covar_pop(competitiveness_score, power_score) AS covar, count(*) AS n FROM final)" % _alpha,
          doubles=["label", "prediction"], others=["row_id"], ctes=O.FEATURES_CTES)


def _kfold_exact(spark, sf_dir):
    return S.fold_exact(_targets(spark, sf_dir), "row_id", stratify="competitive").select("row_id", "competitive", "fold")


_both("kfold_exact", _kfold_exact,
      "SELECT row_id, competitive, CAST((row_number() OVER (PARTITION BY competitive ORDER BY"
      " CAST('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':deal-cls-42'), 1, 8) AS BIGINT), row_id) - 1) % 5 AS INTEGER) AS fold FROM final",
      others=["row_id", "competitive", "fold"], ctes=_TGT_CTES)


def _multi_line(spark, sf_dir):
    """B2 on texts of several lines with headers, Unicode spaces and digits: the lines of an order in up to four texts."""
    li, part = D.read_table(spark, sf_dir, "lineitem"), D.read_table(spark, sf_dir, "part")
    k = F.col("l_partkey")
    count = F.col("l_quantity").cast("int").cast("string")
    count = F.when(k % 5 == 0, F.translate(count, "0123456789", "".join(chr(0xFF10 + i) for i in range(10)))).otherwise(count)
    gap = F.element_at(F.array(*map(F.lit, [" ", "\u00a0", "\u2003", "\t", "\u3000 "])), (k % 5 + 1).cast("int"))
    line = F.concat(F.lit(" "), count, gap, F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit("\r"))
    texts = (li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey", (k % 4).alias("piece"))
             .agg(F.concat_ws("\n", F.lit("Main deck"), F.array_join(F.sort_array(F.collect_list(line)), "\n"), F.lit("4x not a line")).alias("text")))
    return T.parse_decklist(texts, "text", keep=["l_orderkey"])


_both("parse_multi_line", _multi_line,
      "SELECT l_orderkey, lower(p_name || ' ' || p_brand) AS card_name, CAST(l_quantity AS INTEGER) AS quantity"
      " FROM lineitem JOIN part ON l_partkey = p_partkey",
      others=["l_orderkey", "card_name", "quantity"])


def _describe_spread(spark, sf_dir):
    """F9 on values far outside any fixed decimal range."""
    x = _li(spark, sf_dir).select((F.col("l_quantity") * F.pow(F.lit(10.0), (F.col("l_partkey") % 41 - 20).cast("double"))).alias("x"))
    return P.describe(x, ["x"]).select("column", "count", (F.col("mean") / 1e18).alias("mean"), (F.col("max") / 1e18).alias("max"))


_both("describe_spread", _describe_spread,
      "SELECT 'x' AS \"column\", count(*) AS count, avg(x) / 1e18 AS mean, max(x) / 1e18 AS max"
      " FROM (SELECT l_quantity * pow(10.0::DOUBLE, (l_partkey % 41 - 20)::DOUBLE) AS x FROM lineitem)",
      doubles=["mean", "max"], others=["column", "count"])


def _records(spark, results, by, metrics):
    """The summary through the JSON sink (A4, H21), its records as rows."""
    summary = M.metrics_records(results, by, metrics)
    path = IO.scratch_path(spark, "metrics_records")
    IO.write_json(summary, path)
    return spark.read.schema(summary.schema).json(path).select("best_model", F.explode("all_models").alias("r")).select("best_model", "r.*")


_both("metrics_records", lambda s, d: _records(s, _results(s, d), "f1", ["accuracy", "f1", "roc_auc"]),
      "SELECT (SELECT model FROM results ORDER BY f1 DESC NULLS LAST, model LIMIT 1) AS best_model, * FROM results",
      doubles=["accuracy", "f1", "roc_auc"], others=["best_model", "model"], ctes=_MET_CTES)
_both("regression_records", lambda s, d: _records(s, M.regression_metrics(_reg_pred(s, d)), "r2", ["r2", "mae", "rmse"]),
      "SELECT (SELECT model FROM reg_m ORDER BY r2 DESC NULLS LAST, model LIMIT 1) AS best_model, * FROM reg_m",
      doubles=["r2", "mae", "rmse"], others=["best_model", "model"], ctes=_MET_CTES)


def _results_csv(spark, sf_dir):
    """A3: the result table with its parameter map through the CSV sink; the map comes back as JSON text."""
    results = _results(spark, sf_dir).withColumn("best_params", F.create_map(F.lit("model"), "model"))
    path = IO.scratch_path(spark, "results_csv")
    IO.write_csv(results, path)
    return IO.read_csv(spark, path, "model string, accuracy double, f1 double, roc_auc double, best_params string")


_both("results_csv", _results_csv, "SELECT *, '{\"model\":\"' || model || '\"}' AS best_params FROM results",
      doubles=["accuracy", "f1", "roc_auc"], others=["model", "best_params"], ctes=_MET_CTES)
_both("target_profile", lambda s, d: P.target_profile(_targets(s, d), ["competitive", "tier_multiclass"]),
      " UNION ALL ".join(f"SELECT '{t}' AS \"column\", CAST({t} AS VARCHAR) AS value, count(*) AS n, count(*) / (SELECT count(*) FROM final)::DOUBLE AS share"
                         f" FROM final GROUP BY {t}" for t in ("competitive", "tier_multiclass")),
      doubles=["share"], others=["column", "value", "n"], ctes=_TGT_CTES)
_both("preview", lambda s, d: P.preview(_targets(s, d).select("row_id", "tier", "competitive", "tier_multiclass"), ["row_id"]),
      "SELECT row_id, tier, competitive, tier_multiclass FROM final ORDER BY row_id LIMIT 5",
      others=["row_id", "tier", "competitive", "tier_multiclass"], ctes=_TGT_CTES)


# D5/C7 over the documents table: the reference's keywords never occur in the
# invented prose, so the dictionary holds words that do (FIXTURES section 3).
DOC_KEYWORDS = {
    "article": ["the|der|die|la|le"],
    "conjunction": ["and|und|que"],
    "preposition": ["of|de|to|in"],
    "pronoun": ["it|that"],
    "separator": ["\\|"],
}


def _doc_keywords(spark, sf_dir):
    docs = D.read_table(spark, sf_dir, "documents")
    return FT.keyword_percentages(docs, "lang", "text", DOC_KEYWORDS)


_both("document_keywords", _doc_keywords,
      "SELECT lang, " + ", ".join(
          f"coalesce(CAST(sum(CASE WHEN regexp_matches(lower(text), '{pats[0]}') THEN 1 ELSE 0 END) AS DOUBLE)"
          f" / nullif(count(*), 0) * 100, 0.0) AS pct_{k}" for k, pats in DOC_KEYWORDS.items())
      + " FROM documents GROUP BY lang",
      doubles=[f"pct_{k}" for k in DOC_KEYWORDS], others=["lang"])
