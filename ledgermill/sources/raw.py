"""Dated raw CSV files: landing, discovery, manifest and typed reads.

Layout: ``<base>/<table>/ingest_date=YYYY-MM-DD/*.csv``.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.operators.staging import clean_staging

# One set for batch and stream: headers must match the layout, and a record of another length fails the read.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "enforceSchema": False,
    "mode": "FAILFAST",
    "columnPruning": False,
}

RECORDS_PER_FILE = 1_000_000
CHECKSUM_BYTES = 1 << 27
"""Larger files are not hashed as one value, which takes one task's memory; their ``content_digest`` is taken all the same."""

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("checksum_sha256", T.StringType()),
        T.StructField("line_digest", T.StringType()),
        T.StructField("content_digest", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def land(
    rows: DataFrame,
    base: str,
    table: str,
    ingest_date: date | Column,
    records_per_file: int = RECORDS_PER_FILE,
    multiline: bool = False,
) -> None:
    """Write rows under the table's dated folder; landing a date again replaces only that date.

    ``records_per_file`` bounds the files, so that each can be checksummed in one
    task. A text with a line break fails the write unless ``multiline`` says that
    readers will look for such records.
    """
    if not multiline:
        texts = [f.name for f in rows.schema.fields if f.dataType == T.StringType()]
        rows = rows.withColumns({c: _one_line(c) for c in texts})
    day = ingest_date if isinstance(ingest_date, Column) else F.lit(ingest_date)
    (
        rows.withColumn("ingest_date", day.cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", records_per_file)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("ingest_date")
        .csv(f"{base}/{table}")
    )


def _one_line(column: str) -> Column:
    text = F.col(column)
    broken = text.contains("\n") | text.contains("\r")
    return F.when(broken, F.raise_error(F.lit(f"{column} holds a line break; land it with multiline=True"))).otherwise(text)


def csv_options(multiline: bool = False) -> dict:
    """``multiline`` allows quoted line breaks, at the price of unsplittable files."""
    return _CSV | {"multiLine": multiline}


def read_raw(spark: SparkSession, base: str, table: str, multiline: bool = False) -> DataFrame:
    """All dates of a raw table as text columns plus ``ingest_date``.

    A record with too many or too few fields, or a file with other headers, fails the read.
    """
    schema = schemas.raw_schema(table).add("ingest_date", T.DateType())
    return spark.read.schema(schema).options(**csv_options(multiline)).csv(f"{base}/{table}")


def landed_dates(spark: SparkSession, base: str, table: str) -> DataFrame:
    """(ingest_date) per landed file, from the file listing alone: no file is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{base}/{table}")
    return files.select(F.col("ingest_date").cast("date").alias("ingest_date"))


def latest_date(spark: SparkSession, base: str, table: str) -> Column:
    """The newest ``ingest_date`` as a scalar subquery: a filter on it prunes folders."""
    return landed_dates(spark, base, table).agg(F.max("ingest_date")).scalar()


def read_partition(
    spark: SparkSession, base: str, table: str, ingest_date: date | None = None, multiline: bool = False
) -> DataFrame:
    """Text rows of the given date, or else of the table's newest one."""
    wanted = F.lit(ingest_date) if ingest_date else latest_date(spark, base, table)
    raw = read_raw(spark, base, table, multiline)
    return raw.filter(F.col("ingest_date") == wanted).drop("ingest_date")


def latest_dates(spark: SparkSession, base: str, tables: tuple[str, ...] = tuple(schemas.STAGING)) -> DataFrame:
    """(table_name, ingest_date): the newest date of each table."""
    parts = [
        landed_dates(spark, base, t).agg(F.max("ingest_date").alias("ingest_date")).select(
            F.lit(t).alias("table_name"), "ingest_date"
        )
        for t in tables
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def resolve_date(
    spark: SparkSession, base: str, ingest_date: date | None = None, tables: tuple[str, ...] = tuple(schemas.STAGING)
) -> date:
    """The explicit date, or the newest date all tables agree on; anything else is an error."""
    if ingest_date is not None:
        return ingest_date
    found = {r.table_name: r.ingest_date for r in latest_dates(spark, base, tables).collect()}
    dates = set(found.values())
    if len(dates) != 1 or None in dates:
        raise ValueError(f"tables do not share one newest ingest_date: {found}")
    return dates.pop()


def read_typed(
    spark: SparkSession, base: str, table: str, ingest_date: date | None = None, multiline: bool = False
) -> DataFrame:
    """One date of a raw table, cleaned and typed."""
    return clean_staging(read_partition(spark, base, table, ingest_date, multiline), table)


def read_divided(
    spark: SparkSession, base: str, table: str, ingest_date: date | None = None, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """One date of a raw table, cleaned and typed, and the records :func:`read_typed` would fail on.

    The latter as ``table_name, file, first_field, record, reason``: records
    whose fields are more or fewer than the layout's. Every record is in one of
    the two. A file with other headers fails the read all the same.
    """
    layout = schemas.raw_schema(table)
    schema = T.StructType([*layout.fields, T.StructField("_record", T.StringType()), T.StructField("ingest_date", T.DateType())])
    options = csv_options(multiline) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
    wanted = F.lit(ingest_date) if ingest_date else latest_date(spark, base, table)
    rows = spark.read.schema(schema).options(**options).csv(f"{base}/{table}").filter(F.col("ingest_date") == wanted)
    kept = rows.filter("_record is null").select(*layout.names)
    rejected = rows.filter("_record is not null").select(
        F.lit(table).alias("table_name"),
        _file_path().alias("file"),
        F.col(layout.names[0]).alias("first_field"),
        F.col("_record").alias("record"),
        F.lit(f"not the {len(layout)} fields of {', '.join(layout.names)}").alias("reason"),
    )
    return clean_staging(kept, table), rejected


def _table_of(path: Column) -> Column:
    """File stem in lower case; a part file is named after the folder of its table."""
    stem = F.lower(F.regexp_extract(path, r"([^/]+)\.csv\z", 1))
    folder = F.lower(F.regexp_extract(path, r"([^/]+)(?:/[^/=]+=[^/]*)*/[^/]+\z", 1))
    return F.when(stem.rlike(r"\Apart-\d"), folder).otherwise(stem)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .format("binaryFile")
        .load(folder)
    )


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files anywhere below a folder: (table_name, file_name, path, file_size_bytes, file).

    File contents are not read. Files of zero bytes are left out, as by every
    Spark scan. No file at all is an error.
    """
    found = _files(spark, folder).select(
        _table_of(F.col("path")).alias("table_name"),
        F.regexp_extract("path", r"([^/]+)\z", 1).alias("file_name"),
        "path",
        F.col("length").alias("file_size_bytes"),
        _file_path().alias("file"),
    )
    if found.isEmpty():
        raise FileNotFoundError(f"no CSV file below {folder}")
    return found


def _file_path() -> Column:
    """The scanned file as it is named, not as its URI spells it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def count_records(spark: SparkSession, folder: str, multiline: bool = False) -> DataFrame:
    """CSV records per file, the header left out: (file, record_count).

    ``multiline`` counts a record with quoted line breaks as one; files are not split then.
    """
    records = (
        spark.read.schema("first string")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .options(**(csv_options(multiline) | {"header": False, "enforceSchema": True, "mode": "PERMISSIVE"}))
        .csv(folder)
        .select(_file_path().alias("file"))
    )
    return records.groupBy("file").agg((F.count("*") - 1).alias("record_count"))


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-256 of each file of at most ``CHECKSUM_BYTES``; larger ones are not read."""
    small = _files(spark, folder).filter(F.col("length") <= CHECKSUM_BYTES)
    return small.select(_file_path().alias("file"), F.sha2("content", 256).alias("checksum_sha256"))


# hexadecimal digits of a line's SHA-256 in each of three sums: times a line's number, they stay below 38 decimal digits
_DIGITS = 12
_IN_TASK = (1 << 33) - 1


def line_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each file's lines, whatever its size: ``file, line_digest, ordered``.

    ``line_digest`` is the number of lines and the sum of their SHA-256's first
    15 digits; the order of the lines does not count. In ``ordered`` it does:
    the number of lines, and for each 12 of the first 36 digits the sum of
    these times the line's number, counted from 1. Files are split as usual
    and read once: a block gives its number of lines, and its sums with lines
    counted from the block's start, which the lines of the blocks before shift.
    Lines end at line feeds only, so no other byte is lost.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("lineSep", "\n")
        .text(folder)
        .select(
            _file_path().alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)).alias("place"),
            F.sha2("value", 256).alias("hash"),
        )
    )
    number = lambda at, size, digits: F.conv(F.substring("hash", at, size), 16, 10).cast(f"decimal({digits},0)")
    parts = range(3)
    hashed = lines.select(
        "file", "start", F.col("place").cast("decimal(10,0)").alias("place"), number(1, 15, 20).alias("h"),
        *(number(1 + k * _DIGITS, _DIGITS, 15).alias(f"h{k}") for k in parts),
    )
    blocks = hashed.groupBy("file", "start").agg(
        F.count("*").alias("n"),
        F.min("place").alias("first"),
        F.sum("h").alias("h"),
        *(F.sum(f"h{k}").alias(f"s{k}") for k in parts),
        *(F.sum(F.col("place") * F.col(f"h{k}")).alias(f"w{k}") for k in parts),
    )
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifted = blocks.withColumn("shift", before.cast("decimal(13,0)") + 1 - F.col("first"))
    summed = shifted.groupBy("file").agg(
        F.sum("n").alias("n"),
        F.sum("h").alias("h"),
        *(F.sum((F.col(f"w{k}") + F.col("shift") * F.col(f"s{k}")).cast("decimal(38,0)")).alias(f"w{k}") for k in parts),
    )
    joined = lambda *columns: F.concat_ws(":", *(F.col(c).cast("string") for c in columns))
    return summed.select("file", joined("n", "h").alias("line_digest"), joined("n", *(f"w{k}" for k in parts)).alias("ordered"))


def manifest_tables(spark: SparkSession, folder: str, with_checksum: bool = True, multiline: bool = False) -> DataFrame:
    """One manifest row per landed file, with a checksum of the whole (see ``CHECKSUM_BYTES``) and digests of its lines.

    ``content_digest`` is the SHA-256 of size and ``ordered`` digest, so any
    changed, moved, added or lost byte of a file of any size tells; it is taken
    block by block.
    A file whose records were not counted fails the manifest.
    """
    files = discover(spark, folder).join(count_records(spark, folder, multiline), "file", "left")
    if with_checksum:
        files = files.join(checksums(spark, folder), "file", "left").join(line_digests(spark, folder), "file", "left")
    else:
        none = F.lit(None).cast("string")
        files = files.withColumns({"checksum_sha256": none, "line_digest": none, "ordered": none})
    missed = F.raise_error(F.concat(F.lit("records not counted: "), F.col("file")))
    return files.select(
        "table_name",
        F.col("file_name").alias("source_file"),
        "path",
        F.when(F.col("record_count").isNull(), missed.cast("bigint")).otherwise(F.col("record_count")).alias("record_count"),
        "file_size_bytes",
        "checksum_sha256",
        "line_digest",
        F.sha2(F.concat(F.col("file_size_bytes").cast("string"), F.lit(":"), F.col("ordered")), 256).alias("content_digest"),
        F.lit("SUCCESS").alias("status"),
    )


def manifest(
    files: DataFrame | None,
    spark: SparkSession,
    batch_id: str,
    source: str,
    ingest_date: date,
    started_at: datetime,
    completed_at: datetime | None,
    error: str | None = None,
) -> DataFrame:
    """One document per batch with a record per table nested: SUCCESS, FAILED with the error, or RUNNING until it ends.

    A table of one file carries that file's checksum; with more files the
    checksums are in the file records (:func:`manifest_tables`).
    """
    record = F.struct("table_name", "files", "record_count", "file_size_bytes", "checksum_sha256", "status")
    kind = "array<struct<table_name:string,files:bigint,record_count:bigint,file_size_bytes:bigint,checksum_sha256:string,status:string>>"
    if files is None:
        records = spark.range(1, numPartitions=1).select(F.array().cast(kind).alias("tables"))
    else:
        per_table = files.groupBy("table_name").agg(
            F.count("*").alias("files"),
            F.sum("record_count").alias("record_count"),
            F.sum("file_size_bytes").alias("file_size_bytes"),
            F.when(F.count("*") == 1, F.min("checksum_sha256")).alias("checksum_sha256"),
            F.min("status").alias("status"),
        )
        records = per_table.agg(F.array_sort(F.collect_list(record)).cast(kind).alias("tables"))
    return records.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(source).alias("source"),
        F.lit(ingest_date).alias("ingest_date"),
        F.lit(started_at.isoformat()).alias("ingestion_timestamp"),
        F.lit("FAILED" if error else "SUCCESS" if completed_at else "RUNNING").alias("status"),
        "tables",
        F.lit(error).cast("string").alias("error"),
        F.lit(completed_at and completed_at.isoformat()).cast("string").alias("completed_at"),
    )


def write_manifest(document: DataFrame, base: str, batch_id: str, files: DataFrame | None = None) -> None:
    """Write the document, and the file records beside it."""
    document.coalesce(1).write.mode("overwrite").json(f"{base}/manifests/manifest_{batch_id}")
    if files is not None:
        files.write.mode("overwrite").json(f"{base}/manifest_files/manifest_{batch_id}")


def ingest(
    spark: SparkSession,
    source: str,
    base: str,
    ingest_date: date,
    batch_id: str,
    multiline: bool = False,
    tables: tuple[str, ...] = tuple(schemas.STAGING),
) -> DataFrame:
    """Find the tables' CSV files below ``source``, land them under a date, and write the batch's manifest.

    Returns a record per landed file. The manifest says RUNNING from the start
    and then SUCCESS, or FAILED with the error that is raised. A table without
    a file is an error; several files of a table are landed together. What
    meets the driver is the listing of the source's files.
    """
    started = datetime.now(timezone.utc).replace(tzinfo=None)

    def note(files: DataFrame | None, completed: datetime | None, error: str | None = None) -> None:
        write_manifest(manifest(files, spark, batch_id, source, ingest_date, started, completed, error), base, batch_id, files)

    note(None, None)
    try:
        paths: dict[str, list[str]] = {}
        for r in discover(spark, source).filter(F.col("table_name").isin(*tables)).select("table_name", "path").collect():
            paths.setdefault(r.table_name, []).append(r.path)
        if missing := sorted(set(tables) - set(paths)):
            raise FileNotFoundError(f"no CSV file below {source} for {', '.join(missing)}")
        files = []
        for table in tables:
            rows = spark.read.schema(schemas.raw_schema(table)).options(**csv_options(multiline)).csv(sorted(paths[table]))
            land(rows, base, table, ingest_date, multiline=multiline)
            files.append(manifest_tables(spark, f"{base}/{table}/ingest_date={ingest_date}", multiline=multiline))
        landed = files[0]
        for more in files[1:]:
            landed = landed.unionByName(more)
        note(landed, datetime.now(timezone.utc).replace(tzinfo=None))
    except Exception as failure:
        note(None, datetime.now(timezone.utc).replace(tzinfo=None), f"{type(failure).__name__}: {failure}")
        raise
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{base}/manifest_files/manifest_{batch_id}")
