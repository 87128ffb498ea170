"""Structured Streaming scorer (J1): score request records as they arrive.

One query reads the source once. Lines that are no JSON object are told apart by the
parser's corrupt-record column and become rejections; requests whose id was seen before
are dropped, by a state store that forgets an id ``repeats_within`` after its arrival.
Each micro-batch is held once while its two tables are written: validation (H1), rate
features (H3), the fitted model (G7), the interval and band columns (H4, H7–H9) for
valid rows, and one row per failing field for rejected ones.

A batch's tables lie in folders named by the batch's number and are replaced whole, so a
batch that is run again after a failure, between its two writes too, writes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.scoring import rejection_rows, require_ready, score_valid, scoring_frame, validate_requests
from ..sources.readers import existing_paths

CORRUPT = "_corrupt_record"
#: Fixed value: what a line that can't be read is rejected with.
UNREADABLE = ("body", "Request must be one JSON object")
SCORED_COLUMNS = ["pred_log", "predicted_value_eur", "ci_lower", "ci_upper", "interval_coverage", "valuation_band",
                  "uncertainty_level", "confidence_note", "summary", "key_positives", "key_risks", "score_error"]


def request_stream(spark: SparkSession, source_dir: str, schema: StructType, key: str = "request_id",
                   repeats_within: str = "24 hours", max_files_per_trigger: int = 1000) -> DataFrame:
    """Requests of JSON-lines files as they appear, with the text of unreadable lines in
    ``_corrupt_record``. A repeated id counts once; so does an unreadable line without an
    id that stands in a file several times. Arrival, not the files' age, sets the watermark,
    so that no request is too late."""
    fields = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    lines = (spark.readStream.schema(fields).option("maxFilesPerTrigger", max_files_per_trigger)
             .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", False).json(source_dir))
    unnamed = F.concat_ws("|", F.lit("unreadable"), F.col("_metadata.file_path"), F.sha2(F.col(CORRUPT), 256))
    no_id = F.when(F.col(CORRUPT).isNotNull(), unnamed).otherwise(F.concat_ws("|", F.lit("no id"), F.to_json(F.struct(*schema.names))))
    named = lines.withColumn("__seen", F.coalesce(F.concat(F.lit("id|"), F.col(key).cast("string")), no_id))
    return (named.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", repeats_within)
            .dropDuplicatesWithinWatermark(["__seen"]).drop("__seen", "__arrived"))


def split_batch(batch: DataFrame, score: Callable[[DataFrame], DataFrame], key: str, age_limits) -> tuple[DataFrame, DataFrame]:
    """(scored rows, one row per rejection) of a micro-batch. A line of which not even the id
    could be read is one rejection; one with an unreadable field is judged by its fields."""
    unreadable = F.col(CORRUPT).isNotNull() & F.col(key).isNull()
    valid, rejected = validate_requests(batch.where(~unreadable).drop(CORRUPT), age_limits=age_limits)
    field, message = UNREADABLE
    lost = batch.where(unreadable).select(F.col(key).cast("string").alias(key), F.lit(field).alias("field"), F.lit(message).alias("message"))
    rejections = rejection_rows(rejected, key).withColumn(key, F.col(key).cast("string"))
    return score(valid).select(key, *SCORED_COLUMNS), rejections.unionByName(lost)


def start_scoring(spark: SparkSession, source_dir: str, schema: StructType, model, q_low: float, q_high: float,
                  sink_dir: str, checkpoint_dir: str, *, coverage_label: str = "80%", key: str = "request_id",
                  age_limits=(16.0, 50.0), link: str = "exp", missing: str = "pipeline", interval_coverage: float = 0.8,
                  available_now: bool = True, max_files_per_trigger: int = 1000,
                  repeats_within: str = "24 hours") -> list[StreamingQuery]:
    """Start the scorer, after the readiness check (H16); ``available_now`` drains what is
    there and stops. Read the tables with :func:`sink_table`."""
    require_ready(spark, model, q_low, q_high, interval_coverage, age_limits, missing)

    def score(valid: DataFrame) -> DataFrame:
        return score_valid(valid, model, q_low, q_high, scout=True, coverage=coverage_label, link=link, missing=missing,
                           interval_coverage=interval_coverage)

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for name, table in zip(("scored", "rejected"), split_batch(held, score, key, age_limits)):
                table.write.mode("overwrite").parquet(f"{sink_dir}/{name}/batch={number}")
        finally:
            held.unpersist()

    source = request_stream(spark, source_dir, schema, key, repeats_within, max_files_per_trigger)
    w = source.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint_dir}/scoring")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return [w.start()]


def sink_table(spark: SparkSession, sink_dir: str, name: str) -> DataFrame:
    """All batches of the sink ``scored`` or ``rejected``."""
    return spark.read.option("basePath", f"{sink_dir}/{name}").parquet(*existing_paths(spark, f"{sink_dir}/{name}", "batch=")).drop("batch")


def drain(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait until all queries have ended. With ``timeout_s`` a query that still runs then is
    stopped, with all others, and the call fails: a sink is complete or there is an error."""
    try:
        for q in queries:
            ended = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
            if timeout_s is not None and not ended:
                raise TimeoutError(f"stream {q.id} still runs after {timeout_s} s; its sink is not complete")
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def requests_as_json(df: DataFrame, key: str) -> DataFrame:
    """Requests serialised to one JSON object per line (the stream's input format)."""
    return df.select(F.to_json(F.struct(F.col(key).cast("string").alias(key),
                                        *[c for c in df.columns if c != key])).alias("value"))
