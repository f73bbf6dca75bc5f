"""CSV fee files under a fixed schema."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feeloom.schemas import FEE_COLUMNS, FEE_SCHEMA
from feeloom.sources.files import hadoop_path

CORRUPT = "_corrupt_record"


def has_quoted_newlines(spark: SparkSession, glob: str) -> bool:
    """Whether any physical line ends inside quotes: such a line holds an odd number of quote characters.

    Reads the files as splittable text, so it parallelises even over one huge file.
    """
    lines = spark.read.text(glob)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).isEmpty()


def _read(spark: SparkSession, glob: str, schema: StructType, quoted_newlines: bool, **options) -> DataFrame:
    """Rows of ``schema`` and their source_file."""
    if not quoted_newlines and has_quoted_newlines(spark, glob):
        raise ValueError(f"a line of {glob} ends inside quotes; read it with quoted_newlines=True")
    reader = spark.read.schema(schema).options(
        header=True,
        enforceSchema=False,  # a header whose names do not match is an error
        multiLine=quoted_newlines,
        escape='"',
        columnPruning=False,  # split whole records, so a short or long row is seen whatever is selected
        **options,
    )
    return reader.csv(glob).withColumn("source_file", F.col("_metadata.file_path"))


def read_fees_csv(
    spark: SparkSession,
    glob: str,
    schema: StructType = FEE_SCHEMA,
    quoted_newlines: bool = True,
) -> DataFrame:
    """All rows of the files matching ``glob``. Short rows, extra columns and unparsable values fail the job.

    A value is parsed when its column is used: a load that writes every column sees every bad value, a bare
    count() sees only short and long rows.

    ``quoted_newlines``: with True (the default, whatever the size of a file) quoted cells may hold newlines, and each
    file is parsed in one task, so many moderate files spread better than a few huge ones. With False files are split
    at newlines and read in parallel; a file in which any line ends inside quotes is refused first, by a scan of the
    lines, and lines of blanks are skipped.
    """
    names = schema.fieldNames()
    return _read(spark, glob, schema, quoted_newlines, mode="FAILFAST").select(*names)


SOURCE_COLUMNS = ["source_file", "source_id"]


def read_fees_csv_traced(
    spark: SparkSession,
    glob: str,
    schema: StructType = FEE_SCHEMA,
) -> DataFrame:
    """As read_fees_csv(), with two columns to carry into the raw table: source_file, and source_id, which rises by one
    from record to record of a file (each file is parsed by one task). Write the rows before using source_id: it is drawn
    anew whenever the files are read. ``monitoring.trace_to_file`` turns it into the record's number.
    """
    rows = _read(spark, glob, schema, True, mode="FAILFAST")
    return rows.select(*schema.fieldNames(), "source_file", F.monotonically_increasing_id().alias("source_id"))


def header_contract(spark: SparkSession, glob: str, schema: StructType = FEE_SCHEMA) -> DataFrame:
    """(source_file, column_name, drift, position) for every file whose header is not that of ``schema``; no rows if all are.

    drift: "missing", "extra", "moved" (at another place; position is its own, from 1), "renamed" (an unknown name where a
    missing column belongs; column_name is the declared one) or "empty file" (no header at all). Case counts; blanks around a name
    and its quotes do not. The files are scanned once as splittable text, of which one line for each file and task is kept,
    so a contract is checked before the columns of a load are trusted.
    """
    declared = schema.fieldNames()
    lines = spark.read.text(glob).select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    first = lines.where("block = 0").groupBy("source_file").agg(F.min_by("value", "id").alias("header"))
    # Spark's scans pass over files without a byte; the listing has them.
    fs, pattern = hadoop_path(spark, glob)
    listed = [status.getPath() for status in fs.globStatus(pattern) or [] if status.isFile() and status.getLen() == 0]
    listed = spark.createDataFrame([(p.toUri().toString(),) for p in listed], "source_file string")
    cells = F.transform(F.split(F.regexp_replace("header", "^\ufeff|\r$", ""), ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    found = first.withColumn("names", cells)
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(i).alias("place")) for i, n in enumerate(declared, 1)])

    def of_declared(x):
        at = F.array_position("names", x["name"]).cast("int")
        here = F.get("names", x["place"] - 1)
        stranger = here.isNotNull() & ~F.array_contains(F.lit(declared), here)
        drift = F.when((at == 0) & stranger, "renamed").when(at == 0, "missing").when(at != x["place"], "moved")
        return F.struct(x["name"].alias("column_name"), drift.alias("drift"), F.when(at == 0, x["place"]).otherwise(at).alias("position"))

    def of_extra(name, i):
        stands_for = F.get(F.lit(declared), i)
        replaces = stands_for.isNotNull() & ~F.array_contains("names", stands_for)
        drift = F.when(~F.array_contains(F.lit(declared), name) & ~F.coalesce(replaces, F.lit(False)), "extra")
        return F.struct(name.alias("column_name"), drift.alias("drift"), (i + 1).alias("position"))

    drifts = F.filter(F.concat(F.transform(wanted, of_declared), F.transform("names", of_extra)), lambda x: x["drift"].isNotNull())
    empty = listed.select("source_file", F.lit(None).cast("string").alias("column_name"), F.lit("empty file").alias("drift"), F.lit(None).cast("int").alias("position"))
    return found.select("source_file", F.inline(drifts)).unionByName(empty)


# What a text must look like to be read as a number; a cast alone also takes words and suffixes.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def sort_out_fees_csv(spark: SparkSession, glob: str, schema: StructType = FEE_SCHEMA) -> DataFrame:
    """Every record of the files, in one scan: the columns of ``schema`` and source_file, outcome, reasons, record.

    outcome is "accepted" or "rejected". reasons (an array) has an entry for each bad column of a rejected record: "<column>: missing"
    for a NULL where one is required, "<column>: not a date" or "not a number" for a text that cannot be read as its type; or the
    one entry "wrong number of columns". record is the text of a rejected record of the wrong length, its cells
    joined by commas otherwise, and NULL if accepted. A cell that cannot be read is NULL. Quoted cells may hold newlines.
    Write the rows once, partitioned by outcome.
    """
    texts = StructType([*(StructField(f.name, StringType()) for f in schema.fields), StructField(CORRUPT, StringType())])
    rows = _read(spark, glob, texts, True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    cells, reasons = {}, []
    for field in schema.fields:
        name, kind = field.name, field.dataType.typeName()
        text = F.trim(F.col(name)) if kind != "string" else F.col(name)
        value = text.try_cast(field.dataType)
        if kind in ("double", "float", "integer", "long", "decimal"):
            value = F.when(text.rlike(NUMBER), value)
        cells[name] = value
        what = {"date": "not a date", "timestamp": "not a time"}.get(kind, "not a number")
        missing = F.lit(f"{name}: missing") if not field.nullable else F.lit(None).cast("string")
        reasons.append(F.when(F.col(name).isNull(), missing).when(value.isNull(), F.lit(f"{name}: {what}")))
    whole = F.col(CORRUPT).isNull()
    found = F.when(whole, F.array_compact(F.array(*reasons))).otherwise(F.array(F.lit("wrong number of columns")))
    names = schema.fieldNames()
    written = F.coalesce(CORRUPT, F.array_join(F.array(*[F.col(c) for c in names]), ",", ""))
    sorted_out = rows.withColumns({"reasons": found, "record": written}).withColumn(
        "outcome", F.when(F.size("reasons") == 0, F.lit("accepted")).otherwise(F.lit("rejected"))
    )
    record = F.when(F.col("outcome") == "rejected", F.col("record")).alias("record")
    return sorted_out.select(*[v.alias(n) for n, v in cells.items()], "source_file", "outcome", "reasons", record)


def file_freshness(spark: SparkSession, glob: str, max_age_days: int = 3) -> DataFrame:
    """One row on the files that ``glob`` matches: files, bytes, newest (modification time), age_days, stale.

    The files are listed, not opened. No files: 0, 0, NULLs and stale.
    """
    listed = spark.read.format("binaryFile").load(glob).select("modificationTime", "length")
    newest = F.max("modificationTime")
    age = F.date_diff(F.current_date(), newest.cast("date")).cast("bigint")
    return listed.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), newest.alias("newest"), age.alias("age_days"),
        F.coalesce(age > max_age_days, F.lit(True)).alias("stale"),
    )


def require_not_null(df: DataFrame, columns: list[str] = FEE_COLUMNS) -> DataFrame:
    """``df`` with a guard on each required column: a NULL fails the job that computes it.

    The guard runs inside the scan stage, so it costs no extra pass and holds under task retries.
    """
    guarded = {
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in required column {c}")).cast(df.schema[c].dataType))
        for c in columns
    }
    return df.withColumns(guarded)


def quarantine_fees_csv(
    spark: SparkSession,
    glob: str,
    schema: StructType = FEE_SCHEMA,
    quoted_newlines: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): bad records are set aside with their file and a reason instead of failing the load.

    Both frames scan the files; write each to its table.
    """
    permissive = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    rows = _read(
        spark,
        glob,
        permissive,
        quoted_newlines,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
    required = [f.name for f in schema.fields if not f.nullable]
    complete: Column = reduce(and_, [F.col(c).isNotNull() for c in required])
    parsed = F.col(CORRUPT).isNull()
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    reason = F.when(~parsed, F.lit("malformed record")).otherwise(
        F.concat(F.lit("missing required: "), missing)
    )
    accepted = rows.where(parsed & complete).select(*schema.fieldNames())
    rejected = rows.where(~(parsed & complete)).withColumn("reason", reason)
    return accepted, rejected
