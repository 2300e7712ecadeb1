"""Scalar column expressions (card and deck level).

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen and
Catalyst can constant-fold them (the "unmatched card" defaults are obtained by
evaluating the same expressions on NULL inputs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
RARITY_VALUES = {"common": 1, "uncommon": 2, "rare": 3, "mythic": 4}
MISSING_RARITY_VALUE = 1.0
RARITY_WEIGHT = 0.2
MISSING_CMC = 1.0
EFFICIENCY_FACTOR = 0.5          # (P+T)/cmc * 0.5 when cmc > 0
ZERO_CMC_FACTOR = 0.3            # (P+T) * 0.3 when cmc <= 0
TYPE_BONUS_PLANESWALKER = 2.0
TYPE_BONUS_SPELL = 0.5           # instant or sorcery
TYPE_BONUS_CREATURE = 0.3
TYPE_WORDS = ["creature", "instant", "sorcery", "planeswalker", "enchantment", "artifact"]
TYPE_PCT_COLUMNS = ["pct_creatures", "pct_instants", "pct_sorceries",
                    "pct_planeswalkers", "pct_enchantments", "pct_artifacts"]
KEYWORD_PATTERNS = {
    "removal": ["destroy|exile|sacrifice|shuffle", "damage"],
    "draw": ["draw"],
    "ramp": ["land|mana"],
    "counter": ["counter"],
    "lifegain": ["life|gain"],
}
COLOR_BINS = [0, 1, 2, 10]
COLOR_LABELS = ["mono", "two_color", "three_plus"]
COLOR_OUT_OF_RANGE = "nan"
TIER_POSITIVE_REGEX = "^[12]$"
TIER_BASE_SCORE = {1: 0.2, 2: 0.4, 3: 0.6, 4: 0.8, 5: 1.0}
TIER_MIN, TIER_MAX, TIER_MISSING = 1, 5, 3
NOISE_HALF_WIDTH = 0.05
NOISE_SEED = 42
# ---------------------------------------------------------------------------

# Python's whitespace set for str.strip(), derived by rule (str.isspace).
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_NUMERIC = "^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Python ``str.strip()``: removes leading/trailing Unicode whitespace
    (a character-set trim, no regular expression)."""
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


def normalize_key(x) -> Column:
    """B1: strip + lower-case a join key."""
    return F.lower(strip(x))


def as_text(x) -> Column:
    """pandas ``astype(str)`` for substring tests: missing becomes 'nan'."""
    return F.coalesce(_c(x).cast("string"), F.lit("nan"))


def rarity_value(rarity) -> Column:
    """Rarity name -> 1..4, case-insensitive; anything else NULL."""
    r = F.lower(as_text(rarity))
    out = F.lit(None).cast("double")
    for name, v in reversed(list(RARITY_VALUES.items())):
        out = F.when(r == name, F.lit(float(v))).otherwise(out)
    return out


def numeric_coerce(x) -> Column:
    """Replace every '*' by '0' then numeric or NULL (pandas to_numeric).

    Guarded by a decimal-number pattern because Spark would also accept
    '1d'/'1f' suffixes that pandas rejects.
    """
    s = F.replace(as_text(x), F.lit("*"), F.lit("0"))
    return F.when(s.rlike(_NUMERIC), strip(s).try_cast("double"))


def cmc_value(cmc) -> Column:
    """Cmc coerced to FLOAT (reference keeps float32), widened to double."""
    s = _c(cmc).cast("string")
    return F.when(s.rlike(_NUMERIC), strip(s).try_cast("float")).cast("double")


def creature_efficiency(power_num, toughness_num, cmc) -> Column:
    """(P+T)/cmc*0.5 if cmc>0, (P+T)*0.3 if cmc<=0, else 0; NULL cmc = 1."""
    p, t = _c(power_num), _c(toughness_num)
    c = F.coalesce(_c(cmc), F.lit(MISSING_CMC))
    valid = p.isNotNull() & t.isNotNull()
    return (F.when(valid & (c > 0), (p + t) / c * EFFICIENCY_FACTOR)
             .when(valid & (c <= 0), (p + t) * ZERO_CMC_FACTOR)
             .otherwise(F.lit(0.0)))


def mana_efficiency_term(power_num, toughness_num, cmc) -> Column:
    """D7 per-card term: (P+T)/cmc when both numeric and cmc>0, else 0."""
    p, t = _c(power_num), _c(toughness_num)
    c = F.coalesce(_c(cmc), F.lit(MISSING_CMC))
    return F.when(p.isNotNull() & t.isNotNull() & (c > 0), (p + t) / c).otherwise(F.lit(0.0))


def type_bonus(type_) -> Column:
    """C4: planeswalker 2.0 > instant/sorcery 0.5 > creature 0.3 > 0."""
    t = F.lower(as_text(type_))
    return (F.when(t.contains("planeswalker"), F.lit(TYPE_BONUS_PLANESWALKER))
             .when(t.rlike("instant|sorcery"), F.lit(TYPE_BONUS_SPELL))
             .when(t.contains("creature"), F.lit(TYPE_BONUS_CREATURE))
             .otherwise(F.lit(0.0)))


def card_power_score(power_num, toughness_num, cmc, rarity_val, type_) -> Column:
    """Creature efficiency + 0.2 * rarity (missing = 1) + type bonus."""
    return (creature_efficiency(power_num, toughness_num, cmc)
            + F.coalesce(_c(rarity_val), F.lit(MISSING_RARITY_VALUE)) * RARITY_WEIGHT
            + type_bonus(type_))


def type_flag(type_, word: str) -> Column:
    """1 when ``word`` occurs in lower(type), else 0."""
    return F.lower(as_text(type_)).contains(word).cast("int")


def keyword_flag(text, name: str, patterns: dict | None = None) -> Column:
    """1 when any pattern of keyword ``name`` matches lower(text)
    (substring / regex search over the whole text, like pandas
    ``str.contains``).  ``patterns`` defaults to the reference's keywords."""
    t = F.lower(as_text(text))
    cond = None
    for pat in (patterns or KEYWORD_PATTERNS)[name]:
        c = t.rlike(pat)
        cond = c if cond is None else (cond | c)
    return cond.cast("int")


def color_count(color_identity) -> Column:
    """C11: strip '[' and ']', split on ',', count pieces ('[]'/''/NULL -> 1)."""
    s = F.regexp_replace(as_text(color_identity), "[\\[\\]]", "")
    return F.size(F.split(s, ","))


def color_category(count) -> Column:
    """Right-closed bins [0,1] (1,2] (2,10]; above 10 -> 'nan'."""
    c = _c(count)
    lo, b1, b2, hi = COLOR_BINS
    return (F.when((c >= lo) & (c <= b1), F.lit(COLOR_LABELS[0]))
             .when((c > b1) & (c <= b2), F.lit(COLOR_LABELS[1]))
             .when((c > b2) & (c <= hi), F.lit(COLOR_LABELS[2]))
             .otherwise(F.lit(COLOR_OUT_OF_RANGE)))


def type_tokens(type_) -> Column:
    """Whitespace tokens of ``type`` (case kept); NULL/'nan' -> empty."""
    t = _c(type_)
    toks = F.split(strip(t), "(?U)\\s+")
    ok = t.isNotNull() & (F.lower(t) != "nan")
    return F.when(ok, F.filter(toks, lambda x: x != "")).otherwise(
        F.array().cast("array<string>"))


def clip(x, lo, hi, missing=None) -> Column:
    """C14: clip to [lo, hi]; the NULL fill goes *inside* greatest/least."""
    v = _c(x)
    if missing is not None:
        return F.least(F.greatest(F.coalesce(v, F.lit(missing)), F.lit(lo)), F.lit(hi))
    # greatest/least skip NULL; pandas' clip keeps it missing
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def competitive_label(tier, regex: str = TIER_POSITIVE_REGEX) -> Column:
    """Anchored regex over the tier's text form -> 0/1."""
    return F.coalesce(_c(tier).cast("string").rlike(regex), F.lit(False)).cast("int")


def tier_numeric(tier) -> Column:
    """Tier coerced, clipped to 1..5, missing -> 3 (as double)."""
    t = _c(tier).cast("string").try_cast("double")
    return clip(t, float(TIER_MIN), float(TIER_MAX), float(TIER_MISSING))


def competitiveness_base(tier_num) -> Column:
    """Tier -> base score; non-integer tiers map to NULL."""
    t = _c(tier_num)
    out = F.lit(None).cast("double")
    for k, v in reversed(list(TIER_BASE_SCORE.items())):
        out = F.when(t == float(k), F.lit(v)).otherwise(out)
    return out


def keyed_uniform(key, salt) -> Column:
    """C17: uniform [0,1) from md5 of 'key:salt' (order- and partition-free).

    Same value in DuckDB: cast('0x'||substr(md5(k),1,8) as bigint)/4294967296.
    """
    k = F.concat(_c(key).cast("string"), F.lit(":"), F.lit(str(salt)))
    h = F.conv(F.substr(F.md5(k), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(4294967296.0)


def seeded_noise(key, seed: int = NOISE_SEED, half_width: float = NOISE_HALF_WIDTH) -> Column:
    """Uniform noise in [-half_width, half_width) keyed by ``key``."""
    return keyed_uniform(key, seed) * (2 * half_width) - half_width


def pct(num, den) -> Column:
    """100 * num / den, written (num / den) * 100 like the reference; 0 when
    the denominator is 0 (pandas NaN then fillna(0))."""
    d = _c(den)
    return F.coalesce(F.when(d != 0, _c(num) / d * 100), F.lit(0.0))


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """num/den, 0 when the denominator is 0 or the result missing."""
    d = _c(den)
    return F.coalesce(F.when(d != 0, _c(num) / d), F.lit(default))
