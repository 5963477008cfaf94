"""Category and label encoding: codes follow the sorted order of the values, unseen values get -1."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from benchloom.functions.columns import col, string_columns
from benchloom.operators.ordering import BROADCAST_ROWS, ROWS_PER_CHUNK, positions
from benchloom.session import checkpointed

# Fixed value: the text under which a missing category is encoded.
MISSING_CATEGORY = "nan"
UNSEEN_CODE = -1


def category_text(column: str) -> Column:
    return F.coalesce(col(column).cast("string"), F.lit(MISSING_CATEGORY))


def category_dictionaries(df: DataFrame, columns: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> dict[str, DataFrame]:
    """column -> (value, code): codes 0, 1, ... in sorted order of the distinct texts.

    All columns are read in one scan.  A dictionary is broadcast when its counted size is small.
    """
    if not columns:
        return {}
    items = F.array(*[F.struct(F.lit(c).alias("column"), category_text(c).alias("value")) for c in columns])
    values = checkpointed(df.select(F.explode(items).alias("r")).select("r.*").distinct())
    sizes = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.count("*").alias("n")).collect()}
    ranked = positions(values, ["column"], ["value"], "pos", rows_per_chunk, sum(sizes.values()))
    if len(columns) > 1:
        ranked = checkpointed(ranked)
    out = {}
    for c in columns:
        codes = ranked.filter(F.col("column") == c).select("value", (F.col("pos") - 1).cast("int").alias("code"))
        out[c] = F.broadcast(codes) if sizes.get(c, 0) <= BROADCAST_ROWS else codes
    return out


@dataclass
class CategoryEncoder:
    """Dictionaries learned on one table and applied to others by an equi-join."""

    columns: Sequence[str] | None = None
    include_bool: bool = True
    rows_per_chunk: int = ROWS_PER_CHUNK
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> "CategoryEncoder":
        columns = list(self.columns) if self.columns is not None else string_columns(train, self.include_bool)
        self.dictionaries = category_dictionaries(train, columns, self.rows_per_chunk)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, d in self.dictionaries.items():
            if c not in df.columns:
                continue
            coded = out.withColumn("_text", category_text(c)).join(d.withColumnRenamed("value", "_text"), "_text", "left")
            out = coded.withColumn(c, F.coalesce("code", F.lit(UNSEEN_CODE)).cast("double")).drop("_text", "code")
        return out.select(*[col(c) for c in df.columns])


def encode_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, CategoryEncoder]:
    """Label-encode the string columns of one table; also returns the encoder."""
    encoder = CategoryEncoder(columns, include_bool=False).fit(df)
    return encoder.transform(df), encoder


def encode_train_test(train: DataFrame, test: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    encoder = CategoryEncoder(columns).fit(train)
    return encoder.transform(train), encoder.transform(test)


def encode_target(train: DataFrame, test: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Encode a text label (unseen -> -1); a numeric label is only cast to DOUBLE."""
    if isinstance(train.schema[label].dataType, (T.StringType, T.BooleanType)):
        return encode_train_test(train, test, [label])
    return train.withColumn(label, col(label).cast("double")), test.withColumn(label, col(label).cast("double"))
