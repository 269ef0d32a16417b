"""Scans with declared schemas: catalog tables, parquet, CSV files, JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.model import TABLES
from millrace.operators.dedupe import keep_latest

FILE_ORDER = ("_file", "_offset", "_line")


def read_table(spark: SparkSession, name: str, namespace: str | None = None) -> DataFrame:
    """Catalog table in its declared columns; audit columns and others stay behind."""
    full = f"{namespace}.{name}" if namespace else name
    table = spark.table(full)
    declared = TABLES.get(name)
    if declared is None:
        return table
    return table.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields))


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def csv_options(null_text: str = "", multi_line: bool = False) -> dict[str, object]:
    """A header and values as they stand: padding is kept, a quote within quotes is doubled. An
    empty field is NULL, unless another text stands for NULL; then it is empty text.

    A header in another order than the schema and a record with more or fewer fields raise.
    ``multi_line`` allows line breaks within quotes; a file is then read by one task.
    """
    return {
        "header": True,
        "enforceSchema": False,
        "columnPruning": False,
        "mode": "FAILFAST",
        "escape": '"',
        "multiLine": multi_line,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "nullValue": null_text,
    }


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: StructType, null_text: str = "", multi_line: bool = False
) -> DataFrame:
    """CSV files, by a glob or a list, with columns taken by the names in their header.

    All files have the header of the first; a file with another one raises. Columns that the
    schema does not have are left out, those that the files do not have are NULL.
    """
    options = csv_options(null_text, multi_line)
    header = spark.read.options(**options).csv(paths).columns
    declared = {f.name: f for f in schema.fields}
    found = StructType([declared.get(name, StructField(name, StringType())) for name in header])
    rows = spark.read.schema(found).options(**options).csv(paths)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in header}
    return rows.withColumns(absent).select(*schema.names)


def with_file_order(df: DataFrame) -> DataFrame:
    """Columns that order rows as if the files were read one after the other by name.

    A split of a file is read in order by one task, so the row counter of the task orders
    its lines; the split's start offset orders the splits. Files are numbered, as rows that
    carry a path are mostly path. How many slashes follow a scheme differs between the list and the rows.
    """

    def same(path: str) -> Column:
        return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")

    numbers = df.sparkSession.createDataFrame(list(enumerate(sorted(df.inputFiles()))), "_number int, _name string")
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.monotonically_increasing_id().alias("_line"),
    )
    unlisted = F.raise_error(F.concat(F.lit("not among the files listed: "), F.col("_path"))).cast("int")
    numbered = placed.join(F.broadcast(numbers), same("_path") == same("_name"), "left")
    return numbered.withColumn("_file", F.coalesce("_number", unlisted)).select(*df.columns, *FILE_ORDER)


def import_csv(spark: SparkSession, paths: str | list[str], schema: StructType, key: str, multi_line: bool = False) -> DataFrame:
    """All files together, one row per key: the last one in file order."""
    ordered = with_file_order(read_csv(spark, paths, schema, multi_line=multi_line))
    return keep_latest(ordered, key, FILE_ORDER).drop(*FILE_ORDER)


@dataclass(frozen=True)
class JdbcSplit:
    """How a table scan is cut into parallel range queries."""

    column: str
    lower: int
    upper: int
    partitions: int


def jdbc_options(url: str, table: str, split: JdbcSplit | None = None, fetch_rows: int = 10_000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def row_id_split(spark: SparkSession, url: str, table: str, partitions: int, column: str = "bronze_row_id") -> JdbcSplit:
    """Split on the surrogate row id; its range is asked from the database, one row comes back."""
    query = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) bounds"
    low, high = spark.read.format("jdbc").options(**jdbc_options(url, query)).load().first()
    return JdbcSplit(column, low or 0, (high or 0) + 1, partitions)


def read_jdbc(spark: SparkSession, url: str, table: str, split: JdbcSplit | None = None) -> DataFrame:
    """Whole-table scan of a database. Filters and columns of the query are pushed to it."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, split)).load()
