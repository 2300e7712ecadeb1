"""Adapters from the TPC-H-like driver tables to the deck data model.

* cards  <- ``part``   (one row per printing; names repeat like printings)
* decks  <- ``orders`` (deck name = customer, so names repeat across rows)
* deck-list fragments <- ``lineitem`` JOIN ``part``: every order line becomes
  one small deck-list text ``"<qty> <name> <brand>\\n"``.  A deck is the union
  of its fragments.  Fragments keep every text bounded even if one order held
  a third of all lines (a whole-order text would have to be built in one task).

The same mapping is written in DuckDB SQL in ``decklens.plans.oracle``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# ---------------------------------------------------------------------------
# Fixed values of the stand-in mapping (shared with the DuckDB oracle).
# ---------------------------------------------------------------------------
RARITIES = ["Common", "Uncommon", "Rare", "Mythic", "Special"]          # p_partkey % 5
COLOR_IDENTITIES = ["[]", "['W']", "['W', 'U']", "['W', 'U', 'B']"]   # p_partkey % 4
CARD_TYPES = {                                                         # by p_type
    "ECONOMY": "Creature — Elf Warrior",
    "LARGE": "Artifact Creature — Golem",
    "MEDIUM": "Instant",
    "PROMO": "Sorcery",
    "SMALL": "Legendary Planeswalker — Jace",
    "STANDARD": "Enchantment — Aura",
}
CARD_TEXT_PARTS = [  # (p_partkey modulus, sentence)
    (2, "Destroy target creature."),
    (3, "Draw a card."),
    (5, "Add one mana of any color."),
    (7, "Counter target spell."),
    (11, "You gain 3 life."),
    (13, "It deals 2 damage to any target."),
]
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; the scan's splits (``spark.sql.files.maxPartitionBytes``) set its parallelism."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def cards_from_part(part: DataFrame) -> DataFrame:
    """Raw card catalogue: name, cmc, rarity, color_identity, type, power,
    toughness, text (names not yet normalised)."""
    k = F.col("p_partkey")
    size = F.col("p_size")
    type_map = F.create_map(*[x for kv in CARD_TYPES.items() for x in map(F.lit, kv)])
    text_parts = [F.when(k % m == 0, F.lit(s)) for m, s in CARD_TEXT_PARTS]
    pw = size % 9
    tg = k % 7
    return part.select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("name"),
        (size % 8).cast("double").alias("cmc"),
        F.element_at(F.array(*map(F.lit, RARITIES)), (k % 5 + 1).cast("int")).alias("rarity"),
        F.element_at(F.array(*map(F.lit, COLOR_IDENTITIES)), (k % 4 + 1).cast("int"))
         .alias("color_identity"),
        type_map[F.col("p_type")].alias("type"),
        F.when(pw == 0, F.lit("*")).when(pw == 1, F.lit("1+*"))
         .otherwise(pw.cast("string")).alias("power"),
        F.when(tg == 0, F.lit("*")).otherwise((tg + 1).cast("string")).alias("toughness"),
        F.concat_ws(" ", *text_parts).alias("text"),
    )


def decks_from_orders(orders: DataFrame) -> DataFrame:
    """Deck attributes: row_id (unique), Name (repeats), Tier, Year."""
    return orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.concat(F.lit(" Deck "), F.col("o_custkey").cast("string"), F.lit("\t")).alias("Name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("Tier"),
        F.year("o_orderdate").alias("Year"),
    )


def deck_list_fragments(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    """Decks with deck-list text: one fragment per order line.

    l_quantity is a double; it is printed as an integer, otherwise the line
    ('23.0 name') would not parse.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    p = part.select("p_partkey", "p_name", "p_brand")
    frag = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey",
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" "),
                 F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit("\n")).alias("deck_list"))
    d = decks_from_orders(orders)
    return frag.join(d, frag.l_orderkey == d.row_id).select(
        "row_id", "Name", "Tier", "Year", F.col("deck_list").alias("Deck list"))


def load_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    return {
        "cards": cards_from_part(part),
        "decks": decks_from_orders(orders),
        "deck_lists": deck_list_fragments(lineitem, part, orders),
    }


# ---------------------------------------------------------------------------
# Deterministic stand-in predictions for the metric operators (no training):
# label/score/prediction per model from keyed hashes of the order key.
# ---------------------------------------------------------------------------
CLS_MODELS = ["logreg", "svm", "rf", "xgb", "knn"]
REG_MODELS = ["linear_reg", "ridge", "svr", "rf_reg", "xgb_reg"]


def _u(key, salt: str):
    k = F.concat(key.cast("string"), F.lit(":" + salt))
    return F.conv(F.substr(F.md5(k), F.lit(1), F.lit(8)), 16, 10).cast("bigint").cast("double") / 4294967296.0


def pseudo_classification(orders: DataFrame) -> DataFrame:
    """(model, row_id, label, score, prediction): label = tier 1-2; the score
    leans towards the label and is rounded to 2 places so ties occur."""
    tier = F.substring("o_orderpriority", 1, 1).cast("int")
    base = orders.select(F.col("o_orderkey").alias("row_id"),
                         tier.isin(1, 2).cast("int").alias("label"),
                         F.explode(F.array(*map(F.lit, CLS_MODELS))).alias("model"))
    score = F.round(0.7 * _u(F.col("row_id"), "") + 0.3 * F.col("label"), 2)
    return base.select("model", "row_id", "label", score.alias("score"),
                       (score >= 0.5).cast("int").alias("prediction"))


def pseudo_regression(orders: DataFrame) -> DataFrame:
    """(model, row_id, label, prediction): label = tier/5 with keyed noise."""
    tier = F.substring("o_orderpriority", 1, 1).cast("double")
    base = orders.select(F.col("o_orderkey").alias("row_id"), tier.alias("tier"),
                         F.posexplode(F.array(*map(F.lit, REG_MODELS))).alias("i", "model"))
    y = F.col("tier") / 5.0 + (_u(F.col("row_id"), "y") - 0.5) * 0.1
    err = (_u(F.col("row_id"), "e") - 0.5) * 0.2 * (F.col("i") + 1) / 5.0
    return base.select("model", "row_id", y.alias("label"), (y + err).alias("prediction"))
