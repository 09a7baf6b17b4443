"""The stateless stages over a stream of conversation records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionloom.operators.clean import clean
from sessionloom.operators.format import format_for_training, keep_scored
from sessionloom.operators.score import evaluate
from sessionloom.schema import CONVERSATION


def read_records(spark: SparkSession, folder: str, schema: str = CONVERSATION, max_files: int = 100) -> DataFrame:
    """A stream of JSON-lines records as files arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


def score_stream(records: DataFrame, min_score: float = 0.5, min_turns: int = 2, min_tokens: int = 1000) -> DataFrame:
    """Clean, score, filter and format; no state is kept, so late files are as good as early ones."""
    return format_for_training(keep_scored(evaluate(clean(records), min_turns, min_tokens), min_score))


def write_stream(df: DataFrame, folder: str, checkpoint: str):
    return df.writeStream.format("json").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
