"""Run audit rows, alert rows and log line classes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
    ]
)

# Event types, priorities, subjects and the subject length limit.
QUALITY_EVENTS = ("DATA_QUALITY_ALERT", "WARNING")
SUBJECT_LENGTH = 100
SUCCESS_SUBJECT = "✅ [PIPELINE SUCCESS] Banking DWH Ingestion Batch Completed (%s)"
QUALITY_SUBJECT = "⚠️ [DATA QUALITY WARNING] Banking DWH QA Suite Failed (%d tests failed)"
FAILURE_SUBJECT = "🚨 [CRITICAL ALERT] Banking DWH Pipeline FAILED at Stage: %s"
DEFAULT_STAGE = "UNKNOWN_STAGE"
DEFAULT_ERROR = "Unknown error occurred during pipeline execution."
DEFAULT_TEST, DEFAULT_REASON = "Test", "Check failed"
TOTAL_TESTS = 7

_FAILED_TEST = T.StructType([T.StructField("name", T.StringType()), T.StructField("reason", T.StringType())])
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("alert_type", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("total_tests", T.LongType()),
        T.StructField("failed_tests", T.ArrayType(_FAILED_TEST)),
        T.StructField("stack_trace", T.StringType()),
    ]
)


def run_rows(spark: SparkSession, records: list[dict]) -> DataFrame:
    """The few stage records of one run as a frame."""

    def entry(record: dict) -> Column:
        return F.struct(*[F.lit(record.get(f.name)).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA.fields])

    one = spark.range(1, numPartitions=1)
    return one.select(F.explode(F.array(*[entry(r) for r in records])).alias("x")).select("x.*")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table."""
    parts = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, t in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def events_from_run(runs: DataFrame, report: DataFrame, ingest_date: date) -> DataFrame:
    """The notifications one run gives rise to.

    Failed quality parts give a quality event; a failed stage (which a failed
    suite is too) gives a failure event; a run without either gives a success
    event with the rows loaded into staging. ``runs`` and ``report`` are the
    stage rows of one run and the at most seven suite parts.
    """
    failed = F.col("status") != "PASSED"
    named = F.struct(F.col("part").alias("name"), F.col("reason").alias("reason"))
    total_tests = report.agg(F.count("*")).scalar()
    failed_tests = report.agg(F.array_sort(F.collect_list(F.when(failed, named)))).scalar()
    stages = runs.agg(
        F.count_if(F.col("status") == "FAILED").alias("failed_stages"),
        F.sum("duration_seconds").alias("duration_seconds"),
        F.sum(F.when(F.col("stage") == "staging", F.col("rows"))).alias("records_loaded"),
        F.min_by(F.col("stage"), F.when(F.col("status") == "FAILED", F.col("started_at"))).alias("failed_stage"),
        F.min_by(F.col("error"), F.when(F.col("status") == "FAILED", F.col("started_at"))).alias("failed_error"),
        F.min_by(F.col("stack_trace"), F.when(F.col("status") == "FAILED", F.col("started_at"))).alias("failed_trace"),
    )
    both = stages.withColumn("total_tests", total_tests).withColumn("failed_tests", failed_tests)
    none = F.lit(None)
    common = ["duration_seconds", "records_loaded", F.lit(ingest_date).alias("ingest_date"), "total_tests", "failed_tests"]

    def events(kind: str, when, stage, error, trace=none) -> DataFrame:
        return both.filter(when).select(
            F.lit(kind).alias("alert_type"),
            stage.cast("string").alias("stage"),
            error.cast("string").alias("error"),
            *common,
            trace.cast("string").alias("stack_trace"),
        )

    bad_suite = F.size("failed_tests") > 0
    bad_stage = F.col("failed_stages") > 0
    return (
        events("SUCCESS", ~bad_suite & ~bad_stage, none, none)
        .unionByName(events("DATA_QUALITY_ALERT", bad_suite, F.lit("Data Quality Suite"), none))
        .unionByName(events("FAILURE", bad_stage, F.col("failed_stage"), F.col("failed_error"), F.col("failed_trace")))
    )


def alert_rows(events: DataFrame) -> DataFrame:
    """Priority, cut subject and message of each event (see ``EVENT_SCHEMA``), and a failure's stack trace."""
    kind = F.upper(F.coalesce("alert_type", F.lit("FAILURE")))
    failed = F.coalesce("failed_tests", F.array())
    n_failed = F.size(failed)
    total = F.coalesce("total_tests", F.lit(TOTAL_TESTS))
    stage = F.coalesce("stage", F.lit(DEFAULT_STAGE))
    is_ok = kind == "SUCCESS"
    is_quality = kind.isin(*QUALITY_EVENTS)
    failed_list = F.array_join(
        F.transform(
            failed,
            lambda t: F.concat(
                F.lit("- "),
                F.coalesce(t["name"], F.lit(DEFAULT_TEST)),
                F.lit(": "),
                F.coalesce(t["reason"], F.lit(DEFAULT_REASON)),
            ),
        ),
        "\n",
    )
    subject = (
        F.when(is_ok, F.format_string(SUCCESS_SUBJECT, F.col("ingest_date").cast("string")))
        .when(is_quality, F.format_string(QUALITY_SUBJECT, n_failed))
        .otherwise(F.format_string(FAILURE_SUBJECT, stage))
    )
    message = (
        F.when(
            is_ok,
            F.format_string(
                "%d rows loaded in %.2f seconds, %d/%d tests passed",
                F.coalesce("records_loaded", F.lit(0)),
                F.coalesce("duration_seconds", F.lit(0.0)),
                total - n_failed,
                total,
            ),
        )
        .when(
            is_quality,
            F.concat(F.format_string("%d/%d Tests Passed (%d Failed)\n", total - n_failed, total, n_failed), failed_list),
        )
        .otherwise(F.coalesce("error", F.lit(DEFAULT_ERROR)))
    )
    return events.select(
        kind.alias("alert_type"),
        F.when(is_ok, "P3").when(is_quality, "P2").otherwise("P1").alias("priority"),
        stage.alias("stage"),
        F.substring(subject, 1, SUBJECT_LENGTH).alias("subject"),
        message.alias("message"),
        F.when(~is_ok & ~is_quality, F.col("stack_trace")).alias("stack_trace"),
    )


def classify_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Drop start and end lines, mark the rest as metric, error or info."""
    line = F.regexp_replace(F.col(column), r"\s+\z", "")
    skipped = line.startswith("INIT_START") | line.startswith("START") | line.startswith("END")
    kind = (
        F.when(line.startswith("REPORT"), "metric")
        .when(line.contains("ERROR") | line.contains("Exception"), "error")
        .otherwise("info")
    )
    return lines.filter(~skipped).select(line.alias("line"), kind.alias("kind"))
