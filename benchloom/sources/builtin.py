"""Built-in datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from benchloom.functions.columns import col
from benchloom.functions.hashing import normal
from benchloom.operators.ordering import mark_smallest

# Monthly airline passengers (thousands), 1949-01 to 1960-12.
AIRLINE_PASSENGERS = [
    112, 118, 132, 129, 121, 135, 148, 148, 136, 119, 104, 118,
    115, 126, 141, 135, 125, 149, 170, 170, 158, 133, 114, 140,
    145, 150, 178, 163, 172, 178, 199, 199, 184, 162, 146, 166,
    171, 180, 193, 181, 183, 218, 230, 242, 209, 191, 172, 194,
    196, 196, 236, 235, 229, 243, 264, 272, 237, 211, 180, 201,
    204, 188, 235, 227, 234, 264, 302, 293, 259, 229, 203, 229,
    242, 233, 267, 269, 270, 315, 364, 347, 312, 274, 237, 278,
    284, 277, 317, 313, 318, 374, 413, 405, 355, 306, 271, 306,
    315, 301, 356, 348, 355, 422, 465, 467, 404, 347, 305, 336,
    340, 318, 362, 348, 363, 435, 491, 505, 404, 359, 310, 337,
    360, 342, 406, 396, 420, 472, 548, 559, 463, 407, 362, 405,
    417, 391, 419, 461, 472, 535, 622, 606, 508, 461, 390, 432,
]
# The simulated fraud table.
FRAUD_ROWS, FRAUD_FEATURES, FRAUD_SHARE, FRAUD_SHIFT = 10_000, 20, 0.02, 2.5


def airline_passengers(spark: SparkSession) -> DataFrame:
    """(key, t, y): 144 monthly values, season 12."""
    rows = [("airline", i + 1, float(v)) for i, v in enumerate(AIRLINE_PASSENGERS)]
    return spark.createDataFrame(rows, "key string, t bigint, y double")


def synthetic_imbalanced(
    ids: DataFrame, row_id: str, features: int = FRAUD_FEATURES, share: float = FRAUD_SHARE, shift: float = FRAUD_SHIFT, seed: int = 42
) -> DataFrame:
    """(row_id, feature_0 ..., fraud): normal features for the given row keys, the positives shifted.

    The positives are the ceil(share * rows) rows that come first in hash order.
    """
    keys = ids.select(col(row_id).cast("bigint").alias("row_id"))
    n = keys.count()
    marked = mark_smallest(keys, ["row_id"], seed, "fraud", -int(-share * n // 1), n, name="_positive")
    label = F.col("_positive").cast("int")
    return marked.select(
        "row_id",
        *[(normal(seed, f"f{j}", F.col("row_id")) + label * F.lit(float(shift))).alias(f"feature_{j}") for j in range(features)],
        label.alias("fraud"),
    )


def simulated_fraud(spark: SparkSession, rows: int = FRAUD_ROWS, seed: int = 42) -> DataFrame:
    """The simulated fraud table: 20 features, 2 % positives."""
    return synthetic_imbalanced(spark.range(rows), "id", seed=seed)
