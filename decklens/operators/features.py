"""Per-deck feature table (D1-D14) and targets.

Plan (see README, "Feature plan"):

1. Card side, aggregated *before* the join ("eager aggregation"): every
   printing gets its derived values (power score, flags, colour bucket, ...)
   and these are summed per card name.  All deck features are sums or counts
   over the joined (line x printing) rows, so joining each line to one row of
   per-name sums gives exactly the reference's fan-out result without ever
   materialising the fan-out (13x rows at sf0.1, growing with the catalogue).
2. Lines are pre-aggregated to (deck_name, card_name): sum of quantities and
   number of lines.  This map-side-combined shuffle also splits a hot deck
   across card names; a deck holding a third of all lines shrinks to at most
   one row per distinct card before the per-deck aggregate.
3. Up to ``BROADCAST_NAMES`` card names, the narrow pairs are moved to their
   deck's partition before the wide per-name sums are attached (a broadcast of
   checked size), and one fused ``groupBy(deck_name).agg`` without a further
   exchange computes all sums, the cost spread and the set of type tokens.
   Beyond that the join is the planner's, and the distinct tokens are rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decklens.functions import expressions as X
from decklens.operators.joins import prune_card_columns

KEYWORDS = list(X.KEYWORD_PATTERNS)
KEYWORD_PCT_COLUMNS = [f"pct_{k}" for k in KEYWORDS]
COLOR_PCT_COLUMNS = [f"pct_{c}" for c in X.COLOR_LABELS]

FEATURE_COLUMNS = (["avg_cmc", "std_cmc", "var_cmc", "total_cards", "avg_rarity_weighted",
                    "power_score"] + X.TYPE_PCT_COLUMNS + KEYWORD_PCT_COLUMNS
                   + ["avg_power", "avg_toughness", "mana_efficiency"] + COLOR_PCT_COLUMNS
                   + ["avg_colors", "unique_types"])
TARGET_COLUMNS = ["competitive", "tier_multiclass", "competitiveness_score"]


def _col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _derive(cmc: Column, rarity: Column, type_: Column, power: Column, toughness: Column,
            text: Column, color_identity: Column) -> dict[str, Column]:
    """Per-printing derived values (C1-C12); the keys are summed per name."""
    cmc_d = X.cmc_value(cmc)
    rar = X.rarity_value(rarity)
    p, t = X.numeric_coerce(power), X.numeric_coerce(toughness)
    creature = X.type_flag(type_, "creature")
    cc = X.color_count(color_identity)
    cat = X.color_category(cc)
    out = {
        "n_cmc": F.when(cmc_d.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
        "s_cmc": cmc_d,
        "s_cps": X.card_power_score(p, t, cmc_d, rar, type_),
        "s_rar": rar,
        "n_rar": F.when(rar.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
        "n_creat": creature,
        "s_pow": F.when(creature == 1, p).otherwise(F.lit(0.0)),
        "s_tou": F.when(creature == 1, t).otherwise(F.lit(0.0)),
        "s_meff": X.mana_efficiency_term(p, t, cmc_d),
        "s_cc": cc.cast("double"),
    }
    for w in X.TYPE_WORDS:
        out[f"t_{w}"] = X.type_flag(type_, w)
    for k in KEYWORDS:
        out[f"k_{k}"] = X.keyword_flag(text, k)
    for lab in X.COLOR_LABELS:
        out[f"c_{lab}"] = (cat == lab).cast("int")
    return out


#: Card names up to which their statistics are sent to the tasks, and type tokens up to which a deck's set of them is a few bit masks.
BROADCAST_NAMES, MASK_TOKENS, MASK_BITS = 100_000, 960, 60

_CARD_INPUTS = ("cmc", "rarity", "type", "power", "toughness", "text", "color_identity")
# Column trees are plain (unresolved) expressions: built once per session and
# column layout, then reused by every plan (each node is a JVM round trip).
_EXPR_CACHE: dict = {}


def _session_key(df: DataFrame | None = None) -> str:
    from pyspark.sql import SparkSession
    spark = df.sparkSession if df is not None else SparkSession.getActiveSession()
    return spark.sparkContext.applicationId


def _card_derived(c: DataFrame) -> dict[str, Column]:
    present = tuple(n in c.columns for n in _CARD_INPUTS)
    key = ("derived", _session_key(c), present)
    if key not in _EXPR_CACHE:
        _EXPR_CACHE[key] = _derive(*[_col_or_null(c, n) for n in _CARD_INPUTS])
    return _EXPR_CACHE[key]


def dedupe_printings(cards: DataFrame) -> DataFrame:
    """S3 opt-in: keep one printing per name (the smallest by its columns),
    instead of letting every printing multiply the line."""
    c = prune_card_columns(cards).where(F.col("name").isNotNull())
    rest = [x for x in c.columns if x != "name"]
    if not rest:
        return c.distinct()
    return c.groupBy("name").agg(F.min(F.struct(*rest)).alias("_p")).select("name", "_p.*")


def card_stats(cards: DataFrame, dedupe: str = "none") -> DataFrame:
    """Per-name sums over all printings (NULLs skipped, as pandas sums do).
    ``dedupe='first'`` keeps one printing per name (S3)."""
    if dedupe == "first":
        cards = dedupe_printings(cards)
    c = prune_card_columns(cards).where(F.col("name").isNotNull())
    d = _card_derived(c)
    return c.select("name", *[e.alias(k) for k, e in d.items()]).groupBy("name").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in d],
        F.coalesce(F.var_pop("s_cmc") * F.count("s_cmc"), F.lit(0.0)).alias("m2_cmc"))


def _miss_defaults() -> dict[str, Column]:
    """Statistics of a line whose card is missing: one all-NULL row.

    Obtained by evaluating the same expressions on NULL inputs; Catalyst folds
    them to constants."""
    key = ("miss", _session_key())
    if key not in _EXPR_CACHE:
        n = F.lit(None).cast("string")
        d = _derive(n, n, n, n, n, n, n)
        out = {k: F.coalesce(v, F.lit(0)) for k, v in d.items()}
        out |= {"n_rows": F.lit(1), "m2_cmc": F.lit(0.0)}
        _EXPR_CACHE[key] = out
    return _EXPR_CACHE[key]


def card_type_tokens(cards: DataFrame) -> DataFrame:
    """Distinct (name, token) pairs of the card catalogue (D10 input)."""
    c = prune_card_columns(cards)
    t = _col_or_null(c, "type")
    return (c.where(F.col("name").isNotNull())
             .select("name", F.explode(X.type_tokens(t)).alias("token")).distinct())


def deck_card_pairs(deck_cards: DataFrame) -> DataFrame:
    """(deck_name, card_name) -> total quantity and number of lines."""
    return (deck_cards.where(F.col("deck_name").isNotNull())
            .groupBy("deck_name", "card_name")
            .agg(F.sum("quantity").alias("q"), F.count(F.lit(1)).alias("n_lines")))


def unique_types(pairs: DataFrame, cards: DataFrame, dedupe: str = "none") -> DataFrame:
    """Distinct type tokens per deck over its (deck, card) pairs.

    Tokens are de-duplicated per name before the join and per (deck, token)
    with a map-side combine after it; no vocabulary is numbered and no state
    grows with it."""
    tokens = card_type_tokens(dedupe_printings(cards) if dedupe == "first" else cards)
    seen = pairs.join(tokens, pairs.card_name == tokens.name).select("deck_name", "token").distinct()
    return seen.groupBy("deck_name").agg(F.count(F.lit(1)).alias("unique_types"))


def cmc_spread(centre: float) -> Column:
    """A deck's sum of squared cmc deviations from its mean, as an aggregate over its pairs joined to the names' statistics.

    A name's own second moment is centred on its mean mu.  The names' part,
    sum(w mu^2) - sum(w mu)^2 / sum(w), is taken from covariances, which Spark
    merges about their means, so that no large squares are subtracted:
    n cov(w mu, mu) - sum(w mu) n cov(w, mu) / sum(w), with mu counted from
    ``centre``.  A missing card has no cmc."""
    has = F.col("n_cmc") > 0
    w = F.when(has, (F.col("n_lines") * F.col("n_cmc")).cast("double"))
    mu = F.when(has, F.col("s_cmc") / F.col("n_cmc") - F.lit(centre))
    own = F.sum(F.when(has, F.col("n_lines") * F.col("m2_cmc")))
    between = F.count(w) * (F.covar_pop(w * mu, mu) - F.sum(w * mu) * F.try_divide(F.covar_pop(w, mu), F.sum(w)))
    return own + F.greatest(between, F.lit(0.0))


def _token_masks(cards: DataFrame, words: list) -> DataFrame:
    """Per card name the set of its type tokens as bits of the columns mask0, mask1, ..."""
    known = cards.sparkSession.createDataFrame([(t, i // MASK_BITS, i % MASK_BITS) for i, t in enumerate(words)], "word string, part int, bit int")
    tokens = card_type_tokens(cards).join(F.broadcast(known), F.col("token").eqNullSafe(F.col("word")))
    bit = F.expr("shiftleft(1L, bit)")
    return tokens.groupBy(F.col("name").alias("mask_name")).agg(*[F.bit_or(F.when(F.col("part") == i, bit)).alias(f"mask{i}") for i in range(-(-len(words) // MASK_BITS))])


def _deck_sums(deck_cards: DataFrame, cards: DataFrame, dedupe: str = "none", with_types: bool = True, with_spread: bool = False) -> DataFrame:
    """Per-deck sums over the (line x printing) rows, via per-name statistics.

    ``w_<stat>`` are copy-weighted sums, ``u_<stat>`` unweighted ones.  One
    job reads the number of card names and their mean cost."""
    pairs = deck_card_pairs(deck_cards)
    if dedupe == "first":
        cards = dedupe_printings(cards)
    stats = card_stats(cards)
    names, centre = cards.agg(F.count_distinct("name"), F.avg(X.cmc_value(_col_or_null(cards, "cmc")))).first()
    masks = 0
    if names <= BROADCAST_NAMES:
        if with_types:
            words = [r["token"] for r in card_type_tokens(cards).select("token").distinct().limit(MASK_TOKENS + 1).collect()]
            if len(words) <= MASK_TOKENS:
                masks = -(-len(words) // MASK_BITS)
                stats = stats.join(_token_masks(cards, words), F.col("name") == F.col("mask_name"), "left") if masks else stats
        by_deck = pairs.repartition("deck_name")
        j = by_deck.join(F.broadcast(stats), by_deck.card_name == stats.name, "left")
    else:
        j = pairs.join(stats, pairs.card_name == stats.name, "left")
    miss = _miss_defaults()
    q = F.col("q")
    nl = F.col("n_lines")

    def v(k):  # per-line statistic, missing card -> NULL-row defaults
        return F.coalesce(F.col(k), miss[k])

    weighted = ["n_rows", "s_cps", "s_rar", "n_creat", "s_pow", "s_tou", "s_meff"] + \
        [f"t_{w}" for w in X.TYPE_WORDS] + [f"k_{k}" for k in KEYWORDS] + \
        [f"c_{c}" for c in X.COLOR_LABELS]
    unweighted = ["n_rows", "n_cmc", "s_cmc", "s_cc", "s_rar", "n_rar"]
    aggs = [F.sum(q * v(k)).alias(f"w_{k}") for k in weighted] + [F.sum(nl * v(k)).alias(f"u_{k}") for k in unweighted]
    if with_spread:
        aggs.append(cmc_spread(centre if centre is not None and math.isfinite(centre) else 0.0).alias("u_m2_cmc"))
    if masks:
        seen = [F.bit_count(F.coalesce(F.bit_or(f"mask{i}"), F.lit(0))).cast("bigint") for i in range(masks)]
        aggs.append(sum(seen[1:], seen[0]).alias("unique_types"))
    agg = j.groupBy("deck_name").agg(*aggs)
    if not with_types or masks:
        return agg
    return agg.join(unique_types(pairs, cards), "deck_name", "left").fillna(0, ["unique_types"])


def deck_aggregates(deck_cards: DataFrame, cards: DataFrame, dedupe: str = "none") -> DataFrame:
    """D1-D10 fused: one row per deck_name with the 25 features.
    ``dedupe``: 'none' (every printing counts, as the reference) or 'first'."""
    agg = _deck_sums(deck_cards, cards, dedupe, with_spread=True)
    Q = F.col("w_n_rows")
    n, s = F.col("u_n_cmc"), F.col("u_s_cmc")
    var = F.when(n > 1, F.coalesce("u_m2_cmc", F.lit(0.0)) / (n - 1)).otherwise(F.lit(0.0))
    color_total = sum((F.col(f"w_c_{c}") for c in X.COLOR_LABELS), F.lit(0))

    cols = {
        "avg_cmc": F.when(n > 0, s / n),
        "std_cmc": F.sqrt(var),
        "var_cmc": var,
        "total_cards": Q.cast("bigint"),
        "avg_rarity_weighted": X.safe_ratio(F.col("w_s_rar"), Q),
        "power_score": X.safe_ratio(F.col("w_s_cps"), Q),
    }
    for w, name in zip(X.TYPE_WORDS, X.TYPE_PCT_COLUMNS):
        cols[name] = X.pct(F.col(f"w_t_{w}"), Q)
    for k, name in zip(KEYWORDS, KEYWORD_PCT_COLUMNS):
        cols[name] = X.pct(F.col(f"w_k_{k}"), Q)
    cols["avg_power"] = X.safe_ratio(F.col("w_s_pow"), F.col("w_n_creat"))
    cols["avg_toughness"] = X.safe_ratio(F.col("w_s_tou"), F.col("w_n_creat"))
    cols["mana_efficiency"] = X.safe_ratio(F.col("w_s_meff"), Q)
    for c, name in zip(X.COLOR_LABELS, COLOR_PCT_COLUMNS):
        cols[name] = X.pct(F.col(f"w_c_{c}"), color_total)
    cols["avg_colors"] = F.col("u_s_cc") / F.col("u_n_rows")
    cols["unique_types"] = F.col("unique_types")
    return agg.select("deck_name", *[e.alias(k) for k, e in cols.items()]).select("deck_name", *FEATURE_COLUMNS)


def baseline_features(deck_cards: DataFrame, cards: DataFrame) -> DataFrame:
    """Unweighted avg_cmc and avg_rarity, total_cards, avg_colors,
    unique_types (the exploratory feature set)."""
    agg = _deck_sums(deck_cards, cards)
    n, nr = F.col("u_n_cmc"), F.col("u_n_rar")
    return agg.select(
        "deck_name", F.when(n > 0, F.col("u_s_cmc") / n).alias("avg_cmc"),
        F.when(nr > 0, F.col("u_s_rar") / nr).alias("avg_rarity"),
        F.col("w_n_rows").cast("bigint").alias("total_cards"),
        (F.col("u_s_cc") / F.col("u_n_rows")).alias("avg_colors"), "unique_types")


def color_pivot(deck_cards: DataFrame, cards: DataFrame) -> DataFrame:
    """Copies per (deck, colour bucket) as a pivot with 0 fill: one conditional sum per bucket."""
    agg = _deck_sums(deck_cards, cards, with_types=False)
    return agg.select("deck_name", *[F.coalesce(F.col(f"w_c_{c}"), F.lit(0)).cast("bigint").alias(c) for c in X.COLOR_LABELS])


def add_targets(df: DataFrame, tier_col: str = "tier", key_col: str = "row_id",
                positive_regex: str = X.TIER_POSITIVE_REGEX, seed: int = X.NOISE_SEED) -> DataFrame:
    """Competitive (0/1), tier_multiclass (1..5), competitiveness_score.

    The noise is a keyed hash of the unique row key, so it does not depend on
    row order or partitioning."""
    t = F.col(tier_col)
    tn = X.tier_numeric(t)
    score = X.competitiveness_base(tn) + X.seeded_noise(F.col(key_col), seed)
    return df.select(
        "*",
        X.competitive_label(t, positive_regex).alias("competitive"),
        tn.cast("int").alias("tier_multiclass"),
        X.clip(score, 0.0, 1.0).alias("competitiveness_score"))


def keyword_percentages(df: DataFrame, group: str, text_col: str, patterns: dict,
                        weight: str | None = None) -> DataFrame:
    """D5 for any text table: per group, 100 * (weighted) share of rows whose
    text matches each keyword; every text is searched whole."""
    w = F.col(weight) if weight else F.lit(1)
    flags = [X.keyword_flag(F.col(text_col), k, patterns) for k in patterns]
    return df.groupBy(group).agg(*[X.pct(F.sum(f * w), F.sum(w)).alias(f"pct_{k}")
                                   for k, f in zip(patterns, flags)])
