"""Readers and writers. Workbook sheets are landed as folders ``sheet=<name>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import cp1252_from_latin1
from plumbline.sources.ordinals import ORDINAL, with_ordinal

SHEET = "sheet"
YEAR = "fy"


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    header: bool = True,
    encoding: str = "utf-8",
    sep: str = ",",
    multiline: bool = False,
    escape: str = '"',
) -> DataFrame:
    """CSV with declared types. ``schema`` names the columns by position. A
    quote inside a quoted cell is doubled.

    Windows-1252 files are decoded as ISO-8859-1, which splits across tasks
    like UTF-8 does, and their differing characters are then mapped.
    """
    cp1252 = encoding.lower() in ("cp1252", "windows-1252")
    schema = _as_schema(schema)
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("encoding", "iso-8859-1" if cp1252 else encoding)
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("escape", escape)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if cp1252:
        strings = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
        df = df.select(
            *[cp1252_from_latin1(F.col(f"`{c}`")).alias(c) if c in strings else F.col(f"`{c}`") for c in df.columns]
        )
    return df


def write_sheets(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Land rows that carry a ``sheet`` column, one folder per sheet."""
    writer = df.write.mode("overwrite").partitionBy(SHEET)
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))


def _landed(spark: SparkSession, path: str, schema: T.StructType | str | None, fmt: str) -> DataFrame:
    reader = spark.read
    if schema is not None:
        schema = _as_schema(schema)
        if SHEET not in schema.names:
            schema = T.StructType(schema.fields + [T.StructField(SHEET, T.StringType())])
        reader = reader.schema(schema)
    reader = reader.option("header", True).option("mode", "FAILFAST")
    read = reader.csv if fmt == "csv" else reader.parquet
    df = read(path)
    if schema is None and df.schema[SHEET].dataType != T.StringType():
        # Sheet names of digits would be read as numbers, and 07 as 7.
        fields = [T.StructField(f.name, T.StringType()) if f.name == SHEET else f for f in df.schema]
        df = (spark.read.schema(T.StructType(fields)).option("header", True).option("mode", "FAILFAST").csv if fmt == "csv"
              else spark.read.schema(T.StructType(fields)).parquet)(path)
    return df


def read_sheet(
    spark: SparkSession,
    path: str,
    sheet: str | int,
    schema: T.StructType | str | None = None,
    *,
    order: list[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """One landed sheet, by name, or by position within ``order``."""
    if isinstance(sheet, int):
        if order is None:
            raise ValueError("a sheet number needs the sheet order")
        sheet = order[sheet]
    return read_sheets(spark, path, [sheet], schema, fmt=fmt).drop(SHEET)


def read_sheets(
    spark: SparkSession,
    path: str,
    sheets: list[str] | None = None,
    schema: T.StructType | str | None = None,
    *,
    fmt: str = "parquet",
) -> DataFrame:
    """Several landed sheets in one scan; other sheets' folders are skipped."""
    df = _landed(spark, path, schema, fmt)
    return df if sheets is None else df.filter(F.col(SHEET).isin(*sheets))


def list_sheets(df: DataFrame) -> DataFrame:
    return df.select(SHEET).distinct()


def read_mapping(spark: SparkSession, path: str, *, sep: str = ":") -> DataFrame:
    """Text lines ``wrong:right``. A repeated key takes its last line; a line
    without exactly one separator fails the job."""
    parts = F.split(F.col("value"), sep, -1)
    lines = with_ordinal(spark.read.text(path)).withColumn(
        "parts",
        F.when(F.size(parts) == 2, parts).otherwise(
            F.raise_error(F.concat(F.lit("not one pair: "), F.col("value")))
        ),
    )
    last = F.max_by(F.col("parts")[1], F.col(ORDINAL)).alias("right")
    return lines.groupBy(F.col("parts")[0].alias("wrong")).agg(last)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """One value per line."""
    return spark.read.text(path)


def write_year(df: DataFrame, path: str, fy: str | None = None) -> None:
    """Write one fiscal year, leaving the other years of the table as they are."""
    if fy is not None:
        df = df.withColumn(YEAR, F.lit(fy))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """All years of a year table. Columns a year lacks are null, and the label
    stays text even where it is all digits."""
    merged = spark.read.option("mergeSchema", True).parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == YEAR else f for f in merged]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def conform(df: DataFrame, renames: dict[str, str], schema: T.StructType | str) -> DataFrame:
    """Bring a year's headers and types to one declared schema.

    ``renames`` maps that year's headers; columns outside the schema go, and
    a declared column that is missing is an error.
    """
    df = df.withColumnsRenamed(renames)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in _as_schema(schema)])

