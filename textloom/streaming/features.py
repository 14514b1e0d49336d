"""Features of texts as they arrive: an extension, as features of a document need no other document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import documents as D
from ..profiles import JAPANESE, Profile

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def arriving(spark: SparkSession, path: str, schema: str = DOCUMENTS, files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def statistics(stream: DataFrame, profile: Profile = JAPANESE) -> DataFrame:
    """STATS of each arriving document: a projection, so no state and no watermark."""
    return D.statistics(D.parsed(stream, profile), profile)


def store(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table once for each file; the sink's log makes restarts safe."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
