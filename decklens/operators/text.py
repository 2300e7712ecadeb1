"""Deck-list text operators: key normalisation, parsing, expansion.

Parsing is a generator (``explode``) over each deck row: no shuffle, no
Python, and a deck list is processed whole, line by line.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.functions import expressions as X

# Line grammar: count, whitespace, card name (Python ``re.match`` on the
# stripped line, so anchored at the start only).  (?s): Python's '.' matches
# '\r', Java's does not by default.  (?U): digits and white space are Unicode's,
# and Python also counts the four separators U+001C to U+001F as white space.
LINE_PATTERN = "(?sU)^(\\d+)[\\s\\x1c-\\x1f]+(.+)"
# Unicode decimal digits beyond ASCII and their ASCII values, derived by rule.
_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
_ASCII_DIGITS = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def normalize_frames(cards: DataFrame, decks: DataFrame, card_key: str = "name",
                     deck_key: str = "Name") -> tuple[DataFrame, DataFrame]:
    """B1: strip + lower the join keys of both frames."""
    return (cards.withColumn(card_key, X.normalize_key(card_key)),
            decks.withColumn(deck_key, X.normalize_key(deck_key)))


def parse_decklist(df: DataFrame, text_col: str = "Deck list", keep: list[str] | None = None) -> DataFrame:
    """B2: one row per valid line: ``keep`` columns + card_name, quantity.

    Lines that do not match (``4x Bolt``, ``SB: 2 Foo``, headers, blanks) are
    dropped silently; decks with no valid line vanish (``explode``).  The text
    is split in place (a generator), so no shuffle and no Python is involved.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    lines = F.split(X.as_text(text_col), "\n")
    exploded = (df.select(*keep, F.explode(lines).alias("_raw"))
                  .select(*keep, X.strip("_raw").alias("_line")))
    # One regex evaluation per line: group 1 is empty exactly when the line
    # does not match.  On a match the name (group 2) is the rest of the line
    # after the count with its leading whitespace removed.
    count = F.regexp_extract("_line", LINE_PATTERN, 1)
    rest = F.expr("substring(_line, length(_n) + 1)")
    return (exploded.select(*keep, "_line", count.alias("_n")).where(F.col("_n") != "")
            .select(*keep, F.lower(X.strip(rest)).alias("card_name"),
                    F.translate("_n", "".join(_DIGITS), _ASCII_DIGITS).try_cast("int").alias("quantity")))


def expand_decks(decks: DataFrame, text_col: str = "Deck list", name_col: str = "Name",
                 tier_col: str = "Tier", year_col: str = "Year",
                 extra: list[str] | None = None) -> DataFrame:
    """deck_name, tier, year, card_name, quantity (+ ``extra``)."""
    extra = [c for c in (extra or []) if c in decks.columns]
    d = decks.select(
        *extra,
        F.col(name_col).alias("deck_name"),
        F.col(tier_col).cast("string").try_cast("int").alias("tier"),
        F.col(year_col).cast("string").try_cast("int").alias("year"),
        F.col(text_col).alias("_text"))
    return parse_decklist(d, "_text", keep=[*extra, "deck_name", "tier", "year"])
