"""Usage of requests, tokens and cost, and admission under several ceilings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .state import shared_folder


@dataclass(frozen=True)
class Ceilings:
    """0: no ceiling. Cost in millionths, so that sums are exact in any order."""

    requests: int = 0
    tokens: int = 0
    cost: int = 0


def sums_before(rows: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each name of ``sums``, the sum over all rows that come before in ``order``.

    Rows are sorted into ranges and written once; each range's total, a row a range, goes to the driver, which adds them up;
    within its range a row is summed by a window of that range. No task holds more than a range. Rows that ``order`` does not
    tell apart are in some order among themselves, the same for all sums.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    named = rows.withColumns({f"_sum_{n}": F.coalesce(c.cast("long"), F.lit(0)) for n, c in sums.items()})
    dealt = named.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    totals = dealt.groupBy("_range").agg(*[F.sum(f"_sum_{n}").alias(n) for n in sums]).orderBy("_range").collect()
    at, before = dict.fromkeys(sums, 0), []
    for t in totals:
        before.append((t["_range"], *at.values()))
        at = {n: v + t[n] for n, v in at.items()}
    first = spark.createDataFrame(before, "_range int, " + ", ".join(f"_before_{n} long" for n in sums))
    inside = Window.partitionBy("_range").orderBy(*order, "_place").rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(first), "_range")  # a row a range
    return out.select(*rows.columns, *[(F.coalesce(F.sum(f"_sum_{n}").over(inside), F.lit(0)) + F.col(f"_before_{n}")).alias(n) for n in sums])


def admitted(batches: DataFrame, order: list[str], ceilings: Ceilings, max_output_tokens: int = 0) -> DataFrame:
    """Batches with ``requests_before``, ``tokens_before``, ``cost_before``, ``refused`` and ``admitted``.

    batches: the columns of ``order`` (which tell batches apart), estimated_tokens, and what each used: requests, tokens, cost.
    In order, a batch is refused if a ceiling is reached before it, or if its estimate and output allowance would pass the
    token ceiling; behind the first refused one nothing is admitted. ``refused`` is the reason by itself.
    """
    used = {f"{n}_before": F.col(n) for n in ("requests", "tokens", "cost")}
    rows = sums_before(batches, order, used)

    def reached(name: str) -> Column:
        most = getattr(ceilings, name)
        return F.lit(most > 0) & (F.col(f"{name}_before") >= most)

    beyond = F.lit(ceilings.tokens > 0) & (F.col("tokens_before") + F.col("estimated_tokens") + max_output_tokens > ceilings.tokens)
    refused = F.when(reached("requests"), "requests").when(reached("tokens") | beyond, "tokens").when(reached("cost"), "cost")
    rows = rows.withColumn("refused", refused)
    first = rows.filter("refused is not null").agg(F.min(F.struct(*order)).alias("first"))  # one row
    rows = rows.crossJoin(F.broadcast(first))
    return rows.withColumn("admitted", F.col("first").isNull() | (F.struct(*order) < F.col("first"))).drop("first")


def usage(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Requests, tokens and cost of all attempts, failed ones too, per key. attempts: keys, tokens, cost."""
    return attempts.groupBy(*keys).agg(F.count(F.lit(1)).alias("requests"), F.sum("tokens").cast("long").alias("tokens"), F.sum("cost").cast("long").alias("cost"))
