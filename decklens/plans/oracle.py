"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark plans: the oracle joins every printing
(the reference's fan-out) and uses DuckDB's own aggregates (stddev_samp, ...),
whereas the Spark side aggregates the catalogue per name before the join.
Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from decklens.functions import expressions as X
from decklens.sources import driver_tables as D


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(vals) -> str:
    return "[" + ", ".join(_q(v) for v in vals) + "]"


STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def _type_case() -> str:
    return "CASE p_type " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in D.CARD_TYPES.items()) + " END"


def _text_expr() -> str:
    parts = ", ".join(f"CASE WHEN p_partkey % {m} = 0 THEN {_q(s)} END" for m, s in D.CARD_TEXT_PARTS)
    return f"concat_ws(' ', {parts})"


CARDS_RAW = f"""cards_raw AS (
  SELECT p_name || ' ' || p_brand AS name,
         CAST(p_size % 8 AS DOUBLE) AS cmc,
         ({_list(D.RARITIES)})[CAST(p_partkey % 5 AS INTEGER) + 1] AS rarity,
         ({_list(D.COLOR_IDENTITIES)})[CAST(p_partkey % 4 AS INTEGER) + 1] AS color_identity,
         {_type_case()} AS type,
         CASE WHEN p_size % 9 = 0 THEN '*' WHEN p_size % 9 = 1 THEN '1+*'
              ELSE CAST(p_size % 9 AS VARCHAR) END AS power,
         CASE WHEN p_partkey % 7 = 0 THEN '*' ELSE CAST(p_partkey % 7 + 1 AS VARCHAR) END AS toughness,
         {_text_expr()} AS text
  FROM part)"""

CARDS = f"""cards AS (
  SELECT lower({strip('name')}) AS name, cmc, rarity, color_identity, type, power, toughness, text
  FROM cards_raw)"""

DECKS = f"""decks AS (
  SELECT o_orderkey AS row_id,
         lower({strip("' Deck ' || CAST(o_custkey AS VARCHAR) || chr(9)")}) AS Name,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS Tier,
         CAST(year(o_orderdate) AS INTEGER) AS Year
  FROM orders)"""

FRAGMENTS = """fragments AS (
  SELECT d.row_id, d.Name, d.Tier, d.Year,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || ' ' || p.p_name || ' ' || p.p_brand || chr(10)
           AS deck_list
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN decks d ON l.l_orderkey = d.row_id)"""

LINE_RE = "^([0-9]+)\\s+(.+)$"

DECK_CARDS = f"""raw_lines AS (
  SELECT row_id, Name, Tier, Year, {strip('unnest(string_split(deck_list, chr(10)))')} AS line
  FROM fragments),
deck_cards AS (
  SELECT row_id, Name AS deck_name, Tier AS tier, Year AS year,
         lower({strip(f"regexp_extract(line, '{LINE_RE}', 2)")}) AS card_name,
         TRY_CAST(regexp_extract(line, '{LINE_RE}', 1) AS INTEGER) AS quantity
  FROM raw_lines WHERE regexp_matches(line, '{LINE_RE}'))"""

MERGED = """merged AS (
  SELECT dc.deck_name, dc.tier, dc.year, dc.card_name, dc.quantity,
         CAST(c.cmc AS FLOAT) AS cmc, c.rarity, c.color_identity, c.type, c.power, c.toughness, c.text
  FROM deck_cards dc LEFT JOIN cards c ON dc.card_name = c.name)"""


def _rarity_case(x: str) -> str:
    return ("CASE lower(coalesce(" + x + ", 'nan')) "
            + " ".join(f"WHEN {_q(k)} THEN {float(v)}::DOUBLE" for k, v in X.RARITY_VALUES.items())
            + " END")


VALUES = f"""vals AS (
  SELECT *,
    CASE WHEN p IS NOT NULL AND t IS NOT NULL AND cmc1 > 0 THEN (p + t) / cmc1 * 0.5::DOUBLE
         WHEN p IS NOT NULL AND t IS NOT NULL AND cmc1 <= 0 THEN (p + t) * 0.3::DOUBLE
         ELSE 0.0::DOUBLE END
      + coalesce(rarity_v, 1.0::DOUBLE) * 0.2::DOUBLE
      + CASE WHEN contains(tl, 'planeswalker') THEN 2.0::DOUBLE
             WHEN regexp_matches(tl, 'instant|sorcery') THEN 0.5::DOUBLE
             WHEN contains(tl, 'creature') THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS card_power_score,
    CASE WHEN p IS NOT NULL AND t IS NOT NULL AND cmc1 > 0 THEN (p + t) / cmc1
         ELSE 0.0::DOUBLE END AS meff,
    CASE WHEN cc <= 1 THEN 'mono' WHEN cc <= 2 THEN 'two_color' WHEN cc <= 10 THEN 'three_plus'
         ELSE 'nan' END AS color_category
  FROM (
    SELECT *,
      {_rarity_case('rarity')} AS rarity_v,
      TRY_CAST(replace(power, '*', '0') AS DOUBLE) AS p,
      TRY_CAST(replace(toughness, '*', '0') AS DOUBLE) AS t,
      coalesce(CAST(cmc AS DOUBLE), 1.0::DOUBLE) AS cmc1,
      lower(coalesce(type, 'nan')) AS tl,
      lower(coalesce(text, 'nan')) AS xl,
      len(string_split(regexp_replace(coalesce(color_identity, 'nan'), '[\\[\\]]', '', 'g'), ','))
        AS cc
    FROM merged))"""


def _ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif({den}, 0), 0.0)"


def _pct(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif({den}, 0) * 100, 0.0)"


_TYPE_PCT = ",\n    ".join(
    _pct(f"sum(CASE WHEN contains(tl, '{w}') THEN quantity ELSE 0 END)", "sum(quantity)") + f" AS {c}"
    for w, c in zip(X.TYPE_WORDS, X.TYPE_PCT_COLUMNS))
_KW = {
    "removal": "regexp_matches(xl, 'destroy|exile|sacrifice|shuffle') OR contains(xl, 'damage')",
    "draw": "contains(xl, 'draw')",
    "ramp": "regexp_matches(xl, 'land|mana')",
    "counter": "contains(xl, 'counter')",
    "lifegain": "regexp_matches(xl, 'life|gain')",
}
_KW_PCT = ",\n    ".join(
    _pct(f"sum(CASE WHEN {cond} THEN quantity ELSE 0 END)", "sum(quantity)") + f" AS pct_{k}"
    for k, cond in _KW.items())
_COLOR_TOTAL = "sum(CASE WHEN color_category IN ('mono', 'two_color', 'three_plus') THEN quantity ELSE 0 END)"
_COLOR_PCT = ",\n    ".join(
    _pct(f"sum(CASE WHEN color_category = '{c}' THEN quantity ELSE 0 END)", _COLOR_TOTAL) + f" AS pct_{c}"
    for c in X.COLOR_LABELS)

AGG = f"""agg AS (
  SELECT deck_name,
    avg(cmc) AS avg_cmc,
    coalesce(stddev_samp(cmc), 0.0) AS std_cmc,
    coalesce(var_samp(cmc), 0.0) AS var_cmc,
    CAST(sum(quantity) AS BIGINT) AS total_cards,
    {_ratio('coalesce(sum(rarity_v * quantity), 0)', 'sum(quantity)')} AS avg_rarity_weighted,
    {_ratio('sum(card_power_score * quantity)', 'sum(quantity)')} AS power_score,
    {_TYPE_PCT},
    {_KW_PCT},
    {_ratio("coalesce(sum(CASE WHEN contains(tl, 'creature') THEN p * quantity ELSE 0 END), 0)",
            "sum(CASE WHEN contains(tl, 'creature') THEN quantity ELSE 0 END)")} AS avg_power,
    {_ratio("coalesce(sum(CASE WHEN contains(tl, 'creature') THEN t * quantity ELSE 0 END), 0)",
            "sum(CASE WHEN contains(tl, 'creature') THEN quantity ELSE 0 END)")} AS avg_toughness,
    {_ratio('sum(meff * quantity)', 'sum(quantity)')} AS mana_efficiency,
    {_COLOR_PCT},
    avg(cc) AS avg_colors
  FROM vals WHERE deck_name IS NOT NULL GROUP BY deck_name),
tokens AS (
  SELECT deck_name, count(DISTINCT tok) AS unique_types FROM (
    SELECT deck_name, unnest(regexp_split_to_array({strip('type')}, '\\s+')) AS tok
    FROM merged WHERE type IS NOT NULL AND lower(type) <> 'nan' AND deck_name IS NOT NULL)
  WHERE tok <> '' GROUP BY deck_name),
features AS (
  SELECT a.*, CAST(coalesce(k.unique_types, 0) AS BIGINT) AS unique_types
  FROM agg a LEFT JOIN tokens k ON a.deck_name = k.deck_name)"""

NOISE = ("(CAST('0x' || substr(md5(CAST({k} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT) "
         "/ 4294967296.0e0) * 0.1::DOUBLE - 0.05::DOUBLE")

BASE_CASE = ("CASE tier_num " + " ".join(f"WHEN {float(k)} THEN {v}::DOUBLE"
                                         for k, v in X.TIER_BASE_SCORE.items()) + " END")

TARGETS = f"""with_decks AS (
  SELECT f.*, d.row_id, d.Tier AS tier, d.Year AS year,
         least(greatest(coalesce(CAST(d.Tier AS DOUBLE), 3.0), 1.0), 5.0) AS tier_num
  FROM features f LEFT JOIN decks d ON f.deck_name = d.Name),
final AS (
  SELECT * EXCLUDE (tier_num),
    CASE WHEN regexp_matches(CAST(tier AS VARCHAR), '^[12]$') THEN 1 ELSE 0 END AS competitive,
    CAST(trunc(tier_num) AS INTEGER) AS tier_multiclass,
    least(greatest({BASE_CASE} + {NOISE.format(k='row_id', seed=X.NOISE_SEED)}, 0.0), 1.0)
      AS competitiveness_score
  FROM with_decks)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [CARDS_RAW, CARDS, DECKS, FRAGMENTS, DECK_CARDS]
FEATURES_CTES = BASE + [MERGED, VALUES, AGG, TARGETS]
