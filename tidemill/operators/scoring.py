"""Purchase-probability scoring: logistic in age and income."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The model's weights.
AGE_WEIGHT = 0.03
INCOME_WEIGHT = 0.04
BIAS = -4.0


def probability_in_batches(age: str, income_k: str) -> Column:
    """The score over Arrow batches, for models that only exist in Python.

    The function is made here, so that it travels to the executors whole and
    they need no copy of this package.
    """

    @F.pandas_udf(T.DoubleType())
    def score(ages: pd.Series, incomes: pd.Series) -> pd.Series:
        return 1.0 / (1.0 + np.exp(-(AGE_WEIGHT * ages + INCOME_WEIGHT * incomes + BIAS)))

    return score(age, income_k)


def probability(age: str, income_k: str) -> Column:
    """The same score from built-in functions; it stays inside generated code."""
    z = F.lit(AGE_WEIGHT) * F.col(age) + F.lit(INCOME_WEIGHT) * F.col(income_k) + F.lit(BIAS)
    return 1.0 / (1.0 + F.exp(-z))


def score_vectorized(df: DataFrame) -> DataFrame:
    return df.withColumn("p_buy", probability_in_batches("age", "income_k"))


def score_builtin(df: DataFrame) -> DataFrame:
    return df.withColumn("p_buy", probability("age", "income_k"))


def top_scored(scored: DataFrame, key: str, k: int = 20) -> DataFrame:
    """The most likely buyers."""
    return scored.orderBy(F.desc("p_buy"), key).limit(k)


def score_by_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Score after spreading the rows over a number of tasks; total score and tasks used."""
    return (
        score_vectorized(df.repartition(partitions))
        .groupBy(F.spark_partition_id().alias("pid"))
        .agg(F.count("*").alias("n"), F.sum("p_buy").alias("p"))
        .agg(F.sum("n").alias("rows"), F.sum("p").alias("total_prob"), F.count("*").alias("partitions_used"))
    )
