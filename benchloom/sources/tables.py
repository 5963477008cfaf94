"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from benchloom.functions.columns import col, nan_to_null
from benchloom.operators.project import display_types

# Separators and decimal marks on offer, and the two presets (separator, first column is an index).
SEPARATORS = (",", ";", "\t", "|")
DECIMALS = (".", ",")
PRESETS = {1: (",", True), 2: (";", False)}


def clean_names(df: DataFrame) -> DataFrame:
    """Column names as text without surrounding blanks."""
    return df.toDF(*[str(c).strip() for c in df.columns])


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    decimal: str = ".",
    index_column: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """CSV with a header.  ``index_column``: None, 'drop' or 'keep' for a first column that holds row names.

    Pass a schema for large inputs: inference costs a further pass over the file.
    """
    if sep not in SEPARATORS or decimal not in DECIMALS:
        raise ValueError(f"separator must be one of {SEPARATORS} and decimal one of {DECIMALS}")
    if index_column not in (None, "drop", "keep"):
        raise ValueError("index_column is None, 'drop' or 'keep'")
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None and decimal == ",":
        df = _with_schema(reader, path, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    elif schema is not None:
        df = reader.schema(schema).csv(path)
    elif decimal == ",":
        # no option turns a decimal comma into a number: read text, then convert the columns that parse as a whole
        text = reader.option("inferSchema", False).csv(path)
        df = _decimal_comma(text)
    else:
        df = reader.option("inferSchema", True).csv(path)
    df = clean_names(df)
    if index_column == "drop":
        df = df.drop(df.columns[0])
    elif index_column == "keep":
        df = df.withColumnRenamed(df.columns[0], "row_id")
    return nan_to_null(df)


def _with_schema(reader, path: str, schema: T.StructType) -> DataFrame:
    """Decimal commas under a given schema: fractional columns are read as text; what is no number raises when read."""
    fractional = (T.DoubleType, T.FloatType, T.DecimalType)
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, fractional) else f.dataType) for f in schema])
    number = lambda f: F.nullif(F.trim(F.regexp_replace(col(f.name), ",", ".")), F.lit("")).cast(f.dataType)
    return reader.schema(text).csv(path).select(
        *[number(f).alias(f.name) if isinstance(f.dataType, fractional) else col(f.name) for f in schema]
    )


def _decimal_comma(text: DataFrame) -> DataFrame:
    pointed = text.select(*[F.regexp_replace(col(c), ",", ".").alias(c) for c in text.columns])
    kinds = dict(display_types(pointed).dtypes)
    return text.select(
        *[F.regexp_replace(col(c), ",", ".").try_cast("double").alias(c) if kinds[c] == "double" else col(c) for c in text.columns]
    )


def read_csv_preset(spark: SparkSession, path: str, preset: int) -> DataFrame:
    """Preset 1: comma, first column is an index.  Preset 2: semicolon, no index."""
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; use one of {sorted(PRESETS)}")
    sep, index = PRESETS[preset]
    return read_csv(spark, path, sep, index_column="drop" if index else None)


def read_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One JSON document per file (an array of records), or JSON lines with ``multi_line=False`` (splittable)."""
    return nan_to_null(clean_names(spark.read.json(path, multiLine=multi_line)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def default_target(df: DataFrame) -> str:
    return df.columns[-1]


def split_target(df: DataFrame, target: str | None = None) -> tuple[list[str], str]:
    """(feature names, target name); the target is the last column unless given."""
    target = target or default_target(df)
    if target not in df.columns:
        raise KeyError(f"no column {target!r}")
    return [c for c in df.columns if c != target], target


def write_result(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)
