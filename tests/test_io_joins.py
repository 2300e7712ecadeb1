"""IO round trips and join helpers on hand-written rows."""


from decklens.operators.joins import attach_deck_attributes, merge_cards
from decklens.sources import io as IO


def test_csv_roundtrip_keeps_newlines_and_maps_na(spark):
    rows = [(1, " Deck A\t", "4 Bolt\n2 Bear\n", "x"), (2, "B", "", "NA"), (3, "C", "1 \"Quoted\" card", None)]
    df = spark.createDataFrame(rows, "row_id long, Name string, `Deck list` string, note string")
    back = {r.row_id: r for r in IO.csv_roundtrip(df, "t").collect()}
    assert back[1].Name == " Deck A\t" and back[1]["Deck list"] == "4 Bolt\n2 Bear\n"
    assert back[2]["Deck list"] is None and back[2].note is None       # '' and 'NA' are missing
    assert back[3]["Deck list"] == '1 "Quoted" card' and back[3].note is None


def test_parquet_roundtrip_partitioned(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.25)], "model string, row_id long, score double")
    back = IO.parquet_roundtrip(df, "p", partition_by=["model"])
    assert sorted(back.collect()) == sorted(df.collect()) and back.columns == df.columns


def test_attach_deck_attributes_keeps_orphan_features(spark):
    f = spark.createDataFrame([("a", 1.0), ("c", 3.0)], "deck_name string, x double")
    d = spark.createDataFrame([(1, "a", 1, 2020), (2, "a", 2, 2021), (3, "z", 3, 2022)],
                              "row_id long, Name string, Tier int, Year int")
    out = sorted((r.deck_name, r.row_id, r.tier) for r in attach_deck_attributes(f, d).collect())
    assert out == [("a", 1, 1), ("a", 2, 2), ("c", None, None)]
    complete = sorted(r.row_id for r in attach_deck_attributes(f, d, complete=True).collect())
    assert complete == [1, 2]


def test_merge_cards_fans_out_printings(spark):
    lines = spark.createDataFrame([("d", "x", 2), ("d", "y", 1)], "deck_name string, card_name string, quantity int")
    cards = spark.createDataFrame([("x", "1"), ("x", "2"), ("z", "3")], "name string, cmc string")
    out = merge_cards(lines, cards)
    got = sorted((r.card_name, r.cmc) for r in out.collect())
    assert got == [("x", 1.0), ("x", 2.0), ("y", None)]
    assert dict(out.dtypes)["cmc"] == "float"
