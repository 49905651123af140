"""Typed readers and writers for report pages, tables, result folders and text reports."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import schemas

_CSV = {
    "header": True,
    "escape": '"',
    "lineSep": "\n",
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_CSV_READ = {**_CSV, "multiLine": True}


# ---- case-report pages and JSON result folders


def read_report_pages(spark, path):
    """One row per raw case report from files holding {"results": [...]}."""
    pages = spark.read.schema(schemas.REPORT_PAGE).option("multiLine", True).json(path)
    return pages.select(F.explode("results").alias("report")).select("report.*")


def read_json_results(spark, path, schema, per_file=True):
    """Strict scan of a result folder: one unreadable document fails the job.

    per_file: one JSON document per file; otherwise one per line.
    """
    return (
        spark.read.schema(schema)
        .options(mode="FAILFAST", multiLine=per_file, pathGlobFilter="*.json")
        .json(path)
    )


def read_json_results_tolerant(spark, path, schema, per_file=True, glob="*.json"):
    """Split scan of a result folder: (readable rows, file name and text of skipped documents)."""
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = (
        spark.read.schema(with_corrupt)
        .options(
            mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", multiLine=per_file, pathGlobFilter=glob
        )
        .json(path)
        .withColumn("_file", F.col("_metadata.file_name"))
    )
    # Spark refuses a query on the corrupt-record column alone, so the data columns take part.
    read = F.to_json(F.struct(*schema.names)).isNotNull()
    good = rows.filter(F.col("_corrupt").isNull() & read).select(*schema.names)
    skipped = rows.filter(F.col("_corrupt").isNotNull() & read).select(
        F.col("_file").alias("file_name"), F.col("_corrupt").alias("content")
    )
    return good, skipped


def done_ids_from_names(spark, path):
    """Ids encoded in the file names of a result folder; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("id")).distinct()


# ---- CSV


def read_csv(spark, path, schema):
    """Typed CSV scan; array columns are stored as JSON text and parsed back."""
    flat = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
            for f in schema.fields
        ]
    )
    df = spark.read.schema(flat).options(**_CSV_READ).csv(path)
    return df.select(
        *[
            F.from_json(f.name, f.dataType).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def read_csv_as_strings(spark, path, schema, blank_nulls=True):
    """All columns as text; missing values become empty strings unless told otherwise."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = spark.read.schema(text).options(**_CSV_READ).csv(path)
    return df.fillna("") if blank_nulls else df


def _flat_for_csv(df):
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df, path, partition_by=None, mode="errorifexists"):
    """CSV with arrays as JSON text. Empty text and null are the same in the file.

    With partition_by, rows of one value are brought together first, so a folder gets few
    files; adaptive execution still splits a value with very many rows.
    """
    flat = _flat_for_csv(df)
    if partition_by:
        flat = flat.hint("rebalance", partition_by)
    writer = flat.write.mode(mode).options(**_CSV)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


# ---- Parquet, JSON and text sinks


def write_parquet(df, path, partition_by=None, mode="errorifexists"):
    """partition_by: rows of a value meet in tasks of about equal size first, so that folders get few large files."""
    writer = (df.hint("rebalance", partition_by) if partition_by else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def append_results(df, path):
    """Append finished rows; the folder is the resume state of an incremental run."""
    df.write.mode("append").parquet(path)


def write_text_report(lines, path, mode="errorifexists"):
    """lines: (line_no, line) rows of a report with a bounded number of lines."""
    lines.coalesce(1).sortWithinPartitions("line_no").select(F.col("line").alias("value")).write.mode(
        mode
    ).text(path)


# ---- optional inputs


def _exists(spark, path):
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def optional_parquet(spark, path, schema):
    """The table, or an empty one of the same schema when nothing was written yet."""
    if _exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def required_parquet(spark, path, schema, hint):
    if not _exists(spark, path):
        raise FileNotFoundError(f"{path} not found. {hint}")
    return spark.read.schema(schema).parquet(path)


# ---- folders of any file system that Spark can reach


def _path(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark, folder):
    """Names of the files and folders right below a folder; none where it does not exist."""
    path, system = _path(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def remove(spark, folder):
    """Deletes a folder that the engine itself wrote, with all it holds."""
    path, system = _path(spark, folder)
    system.delete(path, True)
