"""ST1: the fitted scoring bundle applied to a stream of raw rows.

Scoring is a stateless projection plus stream-static lookups, so no
watermark or state store is involved. The sink is exactly-once (file sink +
checkpoint), and ``availableNow`` processes everything present and stops,
which is also how tests compare stream output with batch output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scored_stream(spark: SparkSession, bundle, source_dir: str, schema: StructType,
                  fmt: str = "parquet") -> DataFrame:
    """Streaming DataFrame of (key, prediction, price) over files arriving in ``source_dir``."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    return bundle.score(stream)


def score_available_now(spark: SparkSession, bundle, source_dir: str, schema: StructType,
                        sink_dir: str, checkpoint_dir: str, fmt: str = "parquet") -> DataFrame:
    """Run the stream over everything available, wait for it, return the sink as a table."""
    q = (scored_stream(spark, bundle, source_dir, schema, fmt).writeStream
         .format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start(sink_dir))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink_dir)
