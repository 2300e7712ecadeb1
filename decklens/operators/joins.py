"""Joins: cards onto deck lines (E1) and deck attributes onto features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.functions import expressions as X

CARD_COLUMNS = ["name", "cmc", "rarity", "color_identity", "type", "power", "toughness", "text"]


def prune_card_columns(cards: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Keep the required columns that exist; ``name`` is mandatory."""
    required = required or CARD_COLUMNS
    present = [c for c in required if c in cards.columns]
    if "name" not in present:
        raise ValueError("column 'name' is required in the card table")
    return cards.select(*present)


def merge_cards(deck_cards: DataFrame, cards: DataFrame) -> DataFrame:
    """Left outer join ``card_name = name``; every printing of a name
    multiplies the line (reference semantics).  cmc becomes FLOAT.

    This materialises the fan-out; the feature builder does not use it (it
    joins per-name statistics instead, see ``features.card_stats``)."""
    c = prune_card_columns(cards)
    if "cmc" in c.columns:  # coerced once per printing, before the fan-out
        c = c.withColumn("cmc", X.cmc_value("cmc").cast("float"))
    return deck_cards.join(c, deck_cards.card_name == c.name, "left").drop("name")


def attach_deck_attributes(features: DataFrame, decks: DataFrame, name_col: str = "Name",
                           keep: list[str] | None = None, complete: bool = False) -> DataFrame:
    """Features LEFT JOIN deck attributes on the deck name; repeated
    names fan out.

    Written as decks INNER JOIN features, decks on the streamed side: a name
    shared by a third of all decks streams through one task against a single
    buffered feature row, and AQE may split it (inner joins are skew-splittable;
    the null-supplying side of an outer join is not).  Features whose name has
    no deck are added by an anti join against the *distinct* deck names,
    unless ``complete`` says every feature name comes from ``decks``."""
    keep = keep or [c for c in ("row_id", "Tier", "Year") if c in decks.columns]
    d = decks.select(F.col(name_col).alias("deck_name"), *keep)
    out = d.join(features, "deck_name").select(*features.columns, *keep)
    if not complete:
        names = d.select("deck_name").distinct()
        unmatched = features.join(names, "deck_name", "left_anti").select(
            "*", *[F.lit(None).cast(d.schema[c].dataType).alias(c) for c in keep])
        out = out.unionByName(unmatched)
    return out.withColumnsRenamed({"Tier": "tier", "Year": "year"})
