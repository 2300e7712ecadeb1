"""Score deck lists as they arrive (H22 on Structured Streaming).

The reference is batch only.  This re-uses the batch feature plan per
micro-batch through ``foreachBatch``: every arriving file of deck lists is
parsed, joined to the (static) card catalogue, aggregated per deck and scored
with a saved ``PipelineModel``; each batch writes its own
``epoch=`` folder of the Parquet sink.  A
deck is expected to arrive whole within one file (as a CSV row of the
reference's deck table).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from decklens.operators import features as FT
from decklens.plans.prepare import deck_features

DECK_SCHEMA = "row_id long, Name string, Tier int, Year int, `Deck list` string"


def start_scoring(spark: SparkSession, source_dir: str, cards: DataFrame, model_path: str,
                  sink_dir: str, checkpoint: str, fmt: str = "parquet"):
    """Start a streaming query; returns the ``StreamingQuery``."""
    model = PipelineModel.load(model_path)
    stream = spark.readStream.schema(DECK_SCHEMA).format(fmt).load(source_dir)

    def score(batch: DataFrame, epoch: int) -> None:
        feats = deck_features(cards, batch)
        out = model.transform(feats.select("deck_name", "row_id", *FT.FEATURE_COLUMNS)).select(
            "deck_name", "row_id", F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("score"))
        # a replayed batch replaces its own folder, so its rows are never doubled
        out.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch}")

    return (stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
