"""Streaming scorer: deck lists arriving as files are scored with a saved model."""

import os
import tempfile

from pyspark.sql import functions as F

from decklens.operators import features as FT
from decklens.operators import ml as ML
from decklens.plans import catalog as C
from decklens.streaming.scoring import start_scoring

SF_SMALL = "/root/testdata/sf0.001"


def test_stream_scores_arriving_decks(spark):
    feats = C._feature_table(spark, SF_SMALL)
    t = ML.fit_single(feats, FT.FEATURE_COLUMNS, "competitive", "logreg", {"C": 1.0, "max_iter": 20}, "cls")
    base = tempfile.mkdtemp(prefix="decklens-stream-")
    model_path = os.path.join(base, "model")
    t.model.write().overwrite().save(model_path)
    src = os.path.join(base, "in")
    frags = C.inputs(spark, SF_SMALL)["deck_lists"].where(F.col("row_id") % 7 == 0)
    # one row per deck with its whole list, as in the reference's deck table
    lists = frags.groupBy("row_id", "Name", "Tier", "Year").agg(
        F.concat_ws("", F.collect_list("Deck list")).alias("Deck list"))
    lists.write.parquet(src)
    cards = C._cards(spark, SF_SMALL)
    q = start_scoring(spark, src, cards, model_path, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(300)
    out = spark.read.parquet(os.path.join(base, "out"))
    assert out.count() == lists.count()
    assert set(r.prediction for r in out.select("prediction").distinct().collect()) <= {0, 1}
