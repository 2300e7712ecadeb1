"""Per-deck features on hand-written decks (FIXTURES section 2 cases)."""

import pytest

from decklens.operators import features as FT
from decklens.plans.prepare import deck_features

CARD_SCHEMA = ("name string, cmc double, rarity string, color_identity string, type string, "
               "power string, toughness string, text string")
DECK_SCHEMA = "row_id long, Name string, Tier int, Year int, `Deck list` string"


def run(spark, cards, decks):
    c = spark.createDataFrame(cards, CARD_SCHEMA)
    d = spark.createDataFrame(decks, DECK_SCHEMA)
    return {(r.deck_name, r.row_id): r.asDict() for r in deck_features(c, d).collect()}


CARDS = [
    ("Bolt", 1.0, "common", "['R']", "Instant", None, None, "Bolt deals 3 damage to any target."),
    ("Bear", 2.0, "uncommon", "['G']", "Creature — Bear", "2", "2", None),
    ("Star", 3.0, "Special", "['W', 'U']", "Creature — Avatar", "*", "1+*", "Draw a card."),
    ("Twin", 2.0, "rare", "[]", "Artifact", "1", "1", None),
    ("Twin", 4.0, "mythic", "['W', 'U', 'B']", "Artifact Creature", "3", "3", None),
]


def test_one_line_deck_has_zero_spread(spark):
    out = run(spark, CARDS, [(1, "Solo", 1, 2020, "4 Bolt")])
    r = out[("solo", 1)]
    assert r["std_cmc"] == 0.0 and r["var_cmc"] == 0.0 and r["total_cards"] == 4
    assert r["pct_instants"] == 100.0 and r["pct_removal"] == 100.0 and r["competitive"] == 1


def test_unmatched_card_defaults(spark):
    r = run(spark, CARDS, [(1, "Miss", 3, 2020, "2 Nothing")])[("miss", 1)]
    assert r["avg_cmc"] is None
    assert r["power_score"] == pytest.approx(0.2)
    assert r["avg_colors"] == 1.0 and r["pct_mono"] == 100.0 and r["unique_types"] == 0


def test_two_printings_fan_out(spark):
    r = run(spark, CARDS, [(1, "T", 2, 2020, "3 Twin")])[("t", 1)]
    assert r["total_cards"] == 6                       # the line counts once per printing
    assert r["avg_cmc"] == pytest.approx(3.0)
    assert r["std_cmc"] == pytest.approx(2 ** 0.5)
    assert r["pct_creatures"] == pytest.approx(50.0)
    assert r["avg_power"] == pytest.approx(3.0)
    assert r["unique_types"] == 2                      # Artifact, Creature


def test_repeated_deck_name_pools_lines(spark):
    decks = [(1, "Same", 1, 2019, "1 Bear"), (2, " same ", 4, 2020, "3 Bolt")]
    out = run(spark, CARDS, decks)
    assert set(out) == {("same", 1), ("same", 2)}
    for r in out.values():
        assert r["total_cards"] == 4
    assert out[("same", 1)]["competitive"] == 1 and out[("same", 2)]["competitive"] == 0


def test_unknown_rarity_and_star_power(spark):
    r = run(spark, CARDS, [(1, "S", 5, 2020, "2 Star\n2 Bear")])[("s", 1)]
    # Special rarity adds 0 to the weighted sum but counts in the denominator
    assert r["avg_rarity_weighted"] == pytest.approx(2 * 2 / 4)
    # '*' -> 0, '1+*' -> missing: Star's power sum counts 0, copies count
    assert r["avg_power"] == pytest.approx((0 * 2 + 2 * 2) / 4)
    assert r["avg_toughness"] == pytest.approx((2 * 2) / 4)
    assert r["pct_two_color"] == pytest.approx(50.0)


def test_percentages_bounded_and_colours_sum_to_100(spark):
    decks = [(1, "A", 1, 2020, "1 Bolt\n2 Bear\n3 Star\n1 Twin"), (2, "B", 2, 2020, "0 Bolt")]
    for r in run(spark, CARDS, decks).values():
        for c in FT.FEATURE_COLUMNS:
            if c.startswith("pct_"):
                assert 0.0 <= r[c] <= 100.0
        tot = r["pct_mono"] + r["pct_two_color"] + r["pct_three_plus"]
        assert tot == pytest.approx(100.0) or tot == 0.0


def test_deck_without_valid_lines_vanishes(spark):
    out = run(spark, CARDS, [(1, "Empty", 1, 2020, "Sideboard\n4x Bolt"), (2, "Ok", 1, 2020, "1 Bolt")])
    assert set(out) == {("ok", 2)}


def test_dedupe_first_counts_one_printing(spark):
    c = spark.createDataFrame(CARDS, CARD_SCHEMA)
    d = spark.createDataFrame([(1, "T", 2, 2020, "3 Twin")], DECK_SCHEMA)
    r = deck_features(c, d, dedupe="first").first()
    assert r["total_cards"] == 3 and r["avg_cmc"] == 2.0       # the smaller printing ('Twin', 2.0, ...)


def test_variance_far_from_zero(spark):
    cards = [(f"c{i}", 16777000.0 + i % 2, "common", "[]", "Instant", None, None, None) for i in range(2000)]
    cards += [("twice", 16777000.0, "common", "[]", "Instant", None, None, None), ("twice", 16777001.0, "common", "[]", "Instant", None, None, None)]
    decks = [(1, "Far", 1, 2020, "\n".join(f"1 c{i}" for i in range(2000))), (2, "Pair", 1, 2020, "1 twice\n1 twice"), (3, "Gone", 1, 2020, "1 nothing")]
    out = run(spark, cards, decks)
    assert out[("far", 1)]["var_cmc"] == pytest.approx(2000 / 1999 / 4, rel=1e-9)
    assert out[("pair", 2)]["var_cmc"] == pytest.approx(1 / 3, rel=1e-9)
    assert out[("gone", 3)]["var_cmc"] == 0.0


def _features(spark, seed=5, names=70):
    import numpy as np
    rng = np.random.default_rng(seed)
    cards = [(f"c{i % names}", float(rng.integers(0, 9)) if i % 11 else None, "rare", "['W', 'U']", f"Type{i} Kind{i % 7} — Sort{i % 3}", "2", "*", "Draw a card.") for i in range(3 * names)]
    decks = [(d, f"Deck {d % 9}", 1, 2020, "\n".join(f"{rng.integers(1, 5)} c{rng.integers(0, names + 5)}" for _ in range(12))) for d in range(40)]
    return run(spark, cards, decks)


def test_features_do_not_depend_on_how_the_names_are_joined(spark, monkeypatch):
    small = _features(spark)
    monkeypatch.setattr(FT, "MASK_TOKENS", 20)
    rows = _features(spark)
    monkeypatch.setattr(FT, "BROADCAST_NAMES", 10)
    large = _features(spark)
    assert len(small) == 40 and max(r["unique_types"] for r in small.values()) > 60
    for other in (rows, large):
        assert set(other) == set(small)
        for key, r in small.items():
            assert all(other[key][c] == (v if v is None or isinstance(v, str) else pytest.approx(v, abs=1e-9)) for c, v in r.items())


def test_lines_are_read_once(spark):
    """One scan of the deck lines feeds sums, cost spread and type tokens; the wide sums are not moved."""
    c, d = spark.createDataFrame(CARDS, CARD_SCHEMA), spark.createDataFrame([(1, "A", 1, 2020, "1 Bolt\n2 Bear")], DECK_SCHEMA)
    from decklens.operators import text as T
    cards, lists = T.normalize_frames(c, d)
    plan = FT.deck_aggregates(T.expand_decks(lists), cards)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") - plan.count("Generate explode(word") <= 2 and plan.count("hashpartitioning(deck_name") == 2
