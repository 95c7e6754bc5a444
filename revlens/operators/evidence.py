"""Evidence quotes: scored candidates, and a bounded, diversified selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EvidenceLimits
from ..functions.text import normalized_quote, stripped, unit_hash
from .classify import aspects

ORDER = [F.desc, "score"], [F.asc, "appid"], [F.asc, "recommendationid"], [F.asc, "taxonomy_id"], [F.asc, "evidence"]


def candidates(current: DataFrame, project_id: str, limits: EvidenceLimits = EvidenceLimits()) -> DataFrame:
    rows = aspects(current).withColumn("evidence", stripped(F.col("evidence")))
    rows = rows.filter((F.col("evidence") != "") & (F.length("evidence") <= limits.max_chars))
    seed = F.concat_ws(":", F.lit(project_id), F.col("appid").cast("string"), "recommendationid", "taxonomy_id", "evidence")
    direction = F.when(F.col("sentiment") == F.col("overall_sentiment"), "confirming").otherwise("counterevidence")
    return rows.select("appid", "recommendationid", "language", "taxonomy_id", "evidence", direction.alias("direction"), (unit_hash(seed) + F.coalesce("confidence", F.lit(0.0))).alias("score"), F.substring(F.sha2(seed, 256), 1, 24).alias("selection_id"), "source_hash")


def ordering() -> list:
    return [how(name) for how, name in ORDER]


def bounded_candidates(rows: DataFrame, limits: EvidenceLimits) -> DataFrame:
    """All that the greedy choice can need: per language the first distinct quotes, cap + limit of them."""
    quotes = rows.withColumn("_quote", normalized_quote(F.col("evidence")))
    first = Window.partitionBy("language", "_quote").orderBy(*ordering())
    quotes = quotes.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1")
    best = Window.partitionBy("language").orderBy(*ordering())
    return quotes.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= limits.per_language + limits.limit).drop("_rn")


def select(rows: DataFrame, limits: EvidenceLimits = EvidenceLimits()) -> DataFrame:
    """Greedy selection in score order: at most ``per_language`` quotes a language, no quote twice, ``limit`` in all.

    The remainder that the greedy walk sees is at most (cap + limit) rows a language, so it runs on the driver.
    """
    taken, per, quotes = [], {}, set()
    for r in bounded_candidates(rows, limits).orderBy(*ordering()).collect():
        if len(taken) < limits.limit and per.get(r["language"], 0) < limits.per_language and r["_quote"] not in quotes:
            per[r["language"]] = per.get(r["language"], 0) + 1
            quotes.add(r["_quote"])
            taken.append(r)
    spark = rows.sparkSession
    schema = rows.schema
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in taken], schema).withColumn("selection_reason", F.lit("confidence_then_stable_diversity"))
