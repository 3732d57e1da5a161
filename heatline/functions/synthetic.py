"""Series with a known shape, for trying out forecasts and filters."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _series(spark: SparkSession, name: str, n: int, y: Column) -> DataFrame:
    return spark.range(n).select(F.lit(name).alias("series"), F.col("id").alias("idx"),
                                 y.cast("double").alias("y"))


def linear(spark: SparkSession, n: int) -> DataFrame:
    return _series(spark, "linear", n, F.col("id"))


def uniform(spark: SparkSession, n: int, seed=1) -> DataFrame:
    return _series(spark, "uniform", n, F.rand(seed) * 100)


def sine(spark: SparkSession, n: int, periods=5) -> DataFrame:
    return _series(spark, "sine", n, F.sin(F.col("id") * (2 * F.pi() * periods / n)))


def noisy_parabola(spark: SparkSession, n: int, seed=1) -> DataFrame:
    """-(x^2 + 2x - 2) for x evenly spaced from -10 to 10, with normal noise of deviation 2."""
    x = F.col("id") * (20.0 / (n - 1)) - 10
    return _series(spark, "parabola", n, -(x * x + 2 * x - 2) + 2 * F.randn(seed))
