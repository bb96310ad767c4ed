"""Sensor on each port and its rate, kept up to date while log files arrive.

The last line that says so wins, by the time stamped on the line. That order does not depend on when a
file arrives, so after any order of arrival the tables equal those of one batch over all files. State is
one row per session, port and fact, kept by Spark's state store; a restart goes on from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surveypulse import SESSION_KEYS
from surveypulse.operators import events
from surveypulse.sources.lines import file_globs, scan_columns, session_files, split_log_lines

FACTS = "dataset STRING, session INT, fact STRING, port STRING, said STRING, ts STRING"


def log_stream(spark: SparkSession, folder: str, levels: int = 1, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the event logs of a folder, as a stream: the columns of ``sources.lines.log_lines``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else spark.readStream
    scan = session_files(reader.text(file_globs(folder, "EVT")[0]), "EVT", None)
    return split_log_lines(scan.select(*scan_columns(levels)[:3], F.lit(0).cast("bigint").alias("mid"), "value"))


def told(lines: DataFrame) -> DataFrame:
    """Facts that lines state, one per row, stateless: ``dataset, session, fact, port, said, ts``."""
    fields = events.log_fields(lines)
    facts = F.array(
        F.struct(F.lit("sensor").alias("fact"), F.col("port").alias("port"), F.col("sensor").alias("said")),
        F.struct(F.lit("rate").alias("fact"), F.col("rate_port").alias("port"), F.col("rate").cast("string").alias("said")))
    return fields.select(*SESSION_KEYS, "ts", F.inline(facts)).where("port IS NOT NULL AND ts IS NOT NULL")


def latest(facts: DataFrame) -> DataFrame:
    """The fact of the latest stamp per session and port; of equal stamps the greater text. Works on batches
    and streams alike."""
    last = F.max(F.struct("ts", "said")).alias("_last")
    return facts.groupBy(*SESSION_KEYS, "fact", "port").agg(last).select(*SESSION_KEYS, "fact", "port", "_last.said", "_last.ts")


def keep_latest(spark: SparkSession, folder: str, table: str, checkpoint: str, levels: int = 1, files_per_trigger: int | None = None) -> StreamingQuery:
    """Work through the files there are, and leave the facts at path ``table``: each batch replaces them whole."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(table)

    stream = latest(told(log_stream(spark, folder, levels, files_per_trigger)))
    return stream.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
