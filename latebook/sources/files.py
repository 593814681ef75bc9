"""Landing folders and raw files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.operators.quarantine import error_records
from latebook.schemas import raw_schema

CORRUPT = "_corrupt_record"
FORMATS = ("parquet", "json")
# Path fragments that tell the entity of a file.
ENTITY_MARKS = {"transaction": "transactions", "payment": "payments"}


def list_files(spark: SparkSession, folder: str, extension: str | None = None) -> DataFrame:
    """Name, path, size and modification time of the files below a folder.

    The listing comes from Spark's file index; the contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extension:
        reader = reader.option("pathGlobFilter", f"*.{extension}")
    return reader.load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("file_path"), F.col("length").alias("file_size"),
        F.col("modificationTime").alias("last_modified"))


def latest_file(files: DataFrame) -> DataFrame:
    """The file modified last; of several, the one with the highest path."""
    newest = F.max(F.struct("last_modified", "file_path", "file_name", "file_size"))
    return files.agg(newest.alias("f")).select("f.*")


def route_entity(path: Column, marks: Mapping[str, str] = ENTITY_MARKS) -> Column:
    """The entity a path belongs to, by fragment, ignoring case; null if none."""
    expr = F.lit(None).cast("string")
    for mark, entity in reversed(list(marks.items())):
        expr = F.when(F.lower(path).contains(mark), entity).otherwise(expr)
    return expr


def landing_formats(spark: SparkSession, folder: str) -> list[str]:
    """The formats that a folder holds files of, Parquet first."""
    return [fmt for fmt in FORMATS if not list_files(spark, folder, fmt).isEmpty()]


def landing_format(spark: SparkSession, folder: str) -> str | None:
    """The preferred format of a folder: Parquet if there is any, else JSON, else none."""
    return next(iter(landing_formats(spark, folder)), None)


def array_chunks(reader):
    """A reader of the text between opening braces, which Spark splits like lines: a file of one
    long array is read by as many tasks as its size asks for."""
    return reader.format("text").option("lineSep", "{")


def array_records(chunks: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of arrays of flat objects, out of ``array_chunks``, plus a corrupt-record column.

    A chunk holds one record if it ends in a closing brace, apart from commas, white space and
    the array's end. Texts with braces, nested objects and records cut short do not; they come
    as corrupt. What lies before the first record of a file is none.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    complete = F.col("value").rlike(r"\}[\s,\]]*$")
    record = F.regexp_replace(F.concat(F.lit("{"), F.col("value")), r"[\s,\]]*$", "")
    read = F.when(complete, F.from_json(record, whole, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    rows = (chunks.select("value", "_metadata").filter(~F.col("value").rlike(r"^[\s\[\],\x{FEFF}]*$"))
            .withColumn("_read", read))
    broken = F.when(~complete, F.col("value")).otherwise(F.col(f"_read.{CORRUPT}"))
    return rows.select(*[F.col(f"_read.{c}").alias(c) for c in schema.names],
                       broken.alias(CORRUPT), "_metadata")


def with_source(raw: DataFrame) -> DataFrame:
    """The file a record comes from, and when it was written."""
    return raw.withColumns({"source_file": F.col("_metadata.file_path"),
                            "source_modified": F.col("_metadata.file_modification_time")}
                           ).drop("_metadata")


def read_json(spark: SparkSession, path: str, entity: str, multi_line: bool = True) -> DataFrame:
    """Raw records of JSON files under the entity's schema, plus a corrupt-record column.

    ``multi_line`` reads arrays of flat objects, pretty-printed or not; without it a file has one
    record per line. Spark splits both.
    """
    schema = raw_schema(entity)
    if multi_line:
        return array_records(array_chunks(spark.read).load(path), schema)
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(whole).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_whole_where_broken(raw: DataFrame, entity: str) -> DataFrame:
    """The records, those of files with corrupt ones read again file by file.

    A file whose texts hold braces is one that only a parser of the whole file can read. What it
    finds replaces the file's records if it finds no fewer and nothing corrupt.
    """
    spark = raw.sparkSession
    broken = (raw.groupBy("source_file", "source_modified").agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("n"), F.count(CORRUPT).alias("bad"))
        .filter("bad > 0").drop("bad").collect())  # one row per broken file
    if not broken:
        return raw
    whole = T.StructType([*raw_schema(entity).fields, T.StructField(CORRUPT, T.StringType())])
    again = with_source(spark.read.schema(whole).option("multiLine", True)
                        .option("columnNameOfCorruptRecord", CORRUPT)
                        .json([r["source_file"] for r in broken])).select(*raw.columns)
    # Spark wants more than the corrupt column to be read
    record = F.when(F.col(CORRUPT).isNull(), F.struct(*raw_schema(entity).names))
    found = {r["source_file"]: r for r in again.groupBy("source_file").agg(
        F.count(record).alias("n"), F.count(CORRUPT).alias("bad")).collect()}
    mended = [r["source_file"] for r in broken if r["source_file"] in found
              and found[r["source_file"]]["bad"] == 0 and found[r["source_file"]]["n"] >= r["n"]]
    inside = F.col("source_file").isin(mended)
    return raw.filter(~inside).unionByName(again.filter(inside))


def read_raw(spark: SparkSession, folder: str, entity: str, *, newest_only: bool = False,
             multi_line: bool = True, fallback: str | None = None) -> DataFrame | None:
    """Raw records of a landing folder with their source file, or None without files.

    ``fallback`` is a JSON file or folder to read when the landing folder has no files.
    """
    schema, fmt, path = raw_schema(entity), landing_format(spark, folder), folder
    if fmt is None:
        if fallback is None:
            return None
        fmt, path = "json", fallback
    elif newest_only:
        path = latest_file(list_files(spark, folder, fmt)).first()["file_path"]
    if fmt == "json":
        raw = read_json(spark, path, entity, multi_line)
    else:
        raw = spark.read.schema(schema).parquet(path).withColumn(
            CORRUPT, F.lit(None).cast("string"))
    return with_source(raw)


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed records, and the rest."""
    bad = F.col(CORRUPT).isNotNull()
    return raw.filter(~bad).drop(CORRUPT), raw.filter(bad)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType, *, entity: str,
                 process_id: str, error_time: str) -> tuple[DataFrame, DataFrame | None]:
    """A Parquet table under an expected schema.

    If the files hold other columns or types, the table is read as it is and the second
    result is an error record that names both schemas.
    """
    actual = spark.read.parquet(path)
    wanted = {f.name: f.dataType for f in schema.fields}
    found = {f.name: f.dataType for f in actual.schema.fields}
    if all(found.get(n) == t for n, t in wanted.items()):
        return spark.read.schema(schema).parquet(path), None
    mismatch = spark.createDataFrame(
        [(schema.simpleString(), actual.schema.simpleString())],
        "expected string, found string")
    return actual, error_records(
        mismatch, error_type="SCHEMA_MISMATCH", entity=entity, process_id=process_id,
        error_time=error_time, source_file=path, message="Esquema diferente do esperado")


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalog table, or its Parquet files where the catalog does not know it."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.read.parquet(path)


def json_valid(text: Column) -> Column:
    """Whether a text is one well-formed JSON value; null for null."""
    return F.when(text.isNotNull(), F.try_parse_json(text).isNotNull())


def json_lines_by_file(spark: SparkSession, path: str) -> DataFrame:
    """Lines, broken lines and validity of each JSON-lines file; lines are checked in parallel."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), json_valid(F.col("value")).alias("ok"))
    return lines.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(~F.col("ok")).alias("n_broken"),
        F.bool_and("ok").alias("valid"))
