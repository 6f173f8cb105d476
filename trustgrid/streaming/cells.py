"""Parse survey and admin cells on a stream.

The cell parsers are stateless column expressions, so the same functions
run on ``readStream`` frames. Progress (offsets and sink commits) lives in
a checkpoint under the session's shared ``spark.checkpoint.dir``, so a
restarted or rescheduled query resumes exactly where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trustgrid.functions import cells, text
from trustgrid.session import CHECKPOINT_CONF

SURVEY_CELL_SCHEMA = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("indicator", T.StringType()),
    T.StructField("raw_value", T.StringType()),
])


def parse_survey_cells(df: DataFrame) -> DataFrame:
    """Batch or streaming: raw survey cells -> keyed, parsed, flagged cells."""
    raw = F.col("raw_value")
    return df.select(
        F.col("state").alias("state_name"), F.col("district").alias("district_name"),
        text.place_key("state").alias("state_key"), text.place_key("district").alias("district_key"),
        "indicator", "raw_value",
        cells.survey_value(raw).alias("value"),
        cells.is_suppressed(raw).alias("is_suppressed"),
        cells.is_low_sample(raw).alias("is_low_sample_estimate"),
        cells.is_unparsed(raw).alias("is_unparsed"),
    )


def checkpoint_location(spark: SparkSession, query_name: str) -> str:
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        raise ValueError(f"{CHECKPOINT_CONF} is not set; streaming progress needs a shared folder")
    return os.path.join(base, "streams", query_name)


def start_survey_cell_stream(spark: SparkSession, source_dir: str, sink_dir: str, query_name: str = "survey_cells",
                             available_now: bool = True) -> StreamingQuery:
    """Parquet files of raw cells -> parsed cells appended to a Parquet sink."""
    stream = spark.readStream.schema(SURVEY_CELL_SCHEMA).parquet(source_dir)
    writer = (parse_survey_cells(stream).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_location(spark, query_name)).queryName(query_name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(sink_dir)
