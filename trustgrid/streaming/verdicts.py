"""Facility trust verdicts maintained on a stream of facility files.

The state is the batch operator's first half: counts and sums per (state,
spelling), which Structured Streaming holds in its checkpointed state store.
In ``complete`` mode each micro-batch yields that whole table; ``foreachBatch``
derives the verdicts from it with the second half and overwrites the sink
folder, so a retried batch rewrites the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trustgrid.plans.gold import state_spellings, verdicts_of_spellings
from trustgrid.plans.silver import FACILITY_COLUMNS, facility_geo
from trustgrid.streaming.cells import checkpoint_location

FACILITY_SCHEMA = T.StructType(
    [T.StructField("unique_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in FACILITY_COLUMNS if c != "unique_id"]
)


def start_facility_verdict_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                                  query_name: str = "facility_verdicts",
                                  available_now: bool = True) -> StreamingQuery:
    stream = spark.readStream.schema(FACILITY_SCHEMA).parquet(source_dir)
    spellings = state_spellings(facility_geo(stream))

    def publish(batch: DataFrame, _batch_id: int) -> None:
        verdicts_of_spellings(batch).write.mode("overwrite").parquet(sink_dir)

    writer = (spellings.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint_location(spark, query_name)).queryName(query_name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
