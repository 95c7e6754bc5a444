"""Scores of classifier output against a gold set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _or_one(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(1.0))


def precision_recall(pairs: DataFrame) -> DataFrame:
    """Micro precision and recall of aspect sets; 1 where a denominator is 0. pairs: gold, pred (arrays)."""
    hit = F.sum(F.size(F.array_intersect("gold", "pred")))
    return pairs.agg(_or_one(hit, F.sum(F.size(F.array_distinct("pred")))).alias("precision"), _or_one(hit, F.sum(F.size(F.array_distinct("gold")))).alias("recall"))


def accuracy(pairs: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Mean agreement per field; 1 without rows."""
    return pairs.agg(*[F.coalesce(F.avg(F.col(a).eqNullSafe(F.col(b)).cast("double")), F.lit(1.0)).alias(name) for name, (a, b) in fields.items()])


def omission(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """omission_rate and coverage of the expected ids."""
    missing = expected.select(key).distinct().join(actual.select(key).distinct().withColumn("_there", F.lit(True)), key, "left")
    lost = missing.agg(F.count_if(F.col("_there").isNull()).alias("missing"), F.count(F.lit(1)).alias("expected"))
    rate = F.coalesce(F.try_divide(F.col("missing").cast("double"), F.col("expected").cast("double")), F.lit(0.0))
    return lost.select("missing", "expected", rate.alias("omission_rate"), (1 - rate).alias("coverage"))


def contamination(answers: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Per batch: answers to ids that were not asked, and repeated answers."""
    known = asked.select("batch", key).distinct().withColumn("_asked", F.lit(True))
    per_id = answers.groupBy("batch", key).agg(F.count(F.lit(1)).alias("n")).join(known, ["batch", key], "left")
    return per_id.groupBy("batch").agg((F.sum(F.when(F.col("_asked").isNull(), F.col("n")).otherwise(0)) + F.sum("n") - F.count(F.lit(1))).alias("contamination"))
