"""Feature preparation end to end: raw cards + decks -> feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from decklens.functions import expressions as X
from decklens.operators import features as FT
from decklens.operators import joins as J
from decklens.operators import text as T


def deck_features(cards: DataFrame, deck_lists: DataFrame, decks: DataFrame | None = None,
                  positive_regex: str = X.TIER_POSITIVE_REGEX, seed: int = X.NOISE_SEED,
                  lists_from_decks: bool = False, dedupe: str = "none") -> DataFrame:
    """Normalise -> expand -> per-deck features -> deck attributes -> targets.

    ``deck_lists`` holds Name/Tier/Year/``Deck list`` (several rows may share a
    deck); ``decks`` holds one row per deck (row_id, Name, Tier, Year) and
    defaults to ``deck_lists`` itself.  ``lists_from_decks`` states that every
    deck-list name occurs in ``decks`` (true when the lists were derived from
    them), which saves the anti join for orphan lists.  Output: deck_name,
    row_id, tier, year, the 25 features and the 3 targets.  ``dedupe='first'``
    counts one printing per card name instead of all (S3, opt-in).
    """
    complete = lists_from_decks or decks is None
    decks = deck_lists if decks is None else decks
    cards_n, lists_n = T.normalize_frames(cards, deck_lists)
    _, decks_n = T.normalize_frames(cards, decks)
    lines = T.expand_decks(lists_n)
    feats = FT.deck_aggregates(lines, cards_n, dedupe)
    joined = J.attach_deck_attributes(feats, decks_n, complete=complete)
    return FT.add_targets(joined, positive_regex=positive_regex, seed=seed)


def feature_view(features: DataFrame) -> DataFrame:
    """The reference's feature frame: keys dropped, features + targets."""
    return features.select(*FT.FEATURE_COLUMNS, *FT.TARGET_COLUMNS)
