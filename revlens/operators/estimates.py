"""Weighted estimates from the stratified sample: Horvitz-Thompson totals and rates with their variance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inclusion(population: DataFrame, sample: DataFrame, strata: list[str]) -> DataFrame:
    """Strata with ``size``, ``drawn`` and ``probability``: how many of a stratum's rows the sample has."""
    sizes = population.groupBy(*strata).agg(F.count(F.lit(1)).alias("size"))
    drawn = sample.groupBy(*strata).agg(F.count(F.lit(1)).alias("drawn"))
    same = [sizes[k].eqNullSafe(drawn[k]) for k in strata]
    joined = sizes.join(drawn, same, "left").select(*[sizes[k] for k in strata], "size", F.coalesce("drawn", F.lit(0)).alias("drawn"))
    return joined.withColumn("probability", F.col("drawn") / F.col("size"))


def totals(population: DataFrame, sample: DataFrame, strata: list[str], by: list[str], marks: dict[str, Column]) -> DataFrame:
    """Estimated number of the population's reviews with each mark, for each value of ``by`` (columns among ``strata``).

    by, mark, total, variance, low, high (95 %), population, rate, drawn. A sampled review stands for size / drawn of its stratum.
    Within a stratum the sample is the lowest hashes, a simple random sample, so a mark's variance is
    size² (1 - probability) s² / drawn, s² being that of the sampled reviews; where one review is drawn of several, s² is that of
    all sampled reviews of the same ``by``. Strata of which nothing is drawn are in ``population`` but in no total; a sample with
    a review of each stratum, as :func:`selection.stratified` takes it, has none.
    """
    counts = inclusion(population, sample, strata)
    zero_one = [F.coalesce(c, F.lit(False)).cast("int").cast("double").alias(f"_m{k}") for k, c in enumerate(marks.values())]
    sums = sample.select(*strata, *zero_one).groupBy(*strata).agg(*[F.sum(f"_m{k}").alias(f"_m{k}") for k in range(len(marks))])
    joined = counts.join(sums, [counts[c].eqNullSafe(sums[c]) for c in strata], "left").select(*[counts[c] for c in strata], "size", "drawn", "probability", *[F.coalesce(f"_m{k}", F.lit(0.0)).alias(f"_m{k}") for k in range(len(marks))])
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("mark"), F.col(f"_m{k}").alias("hits")) for k, name in enumerate(marks)]))
    rows = joined.select(*strata, "size", "drawn", "probability", each)
    n, hits = F.col("drawn"), F.col("hits")

    def spread(drawn: Column, found: Column) -> Column:
        """Sample variance of zeros and ones."""
        return F.when(drawn > 1, found * (drawn - found) / (drawn * (drawn - 1)))

    group = Window.partitionBy(*by, "mark")
    pooled = F.coalesce(spread(F.sum(n).over(group), F.sum(hits).over(group)), F.lit(0.0))
    rows = rows.withColumn("_s2", F.coalesce(spread(n, hits), pooled))
    weight = F.when(n > 0, F.col("size") / n).otherwise(0.0)
    variance = F.when(n > 0, F.pow("size", F.lit(2)) * (1 - F.col("probability")) * F.col("_s2") / n).otherwise(0.0)
    out = rows.groupBy(*by, "mark").agg(F.sum(hits * weight).alias("total"), F.sum(variance).alias("variance"), F.sum("size").alias("population"), F.sum("drawn").alias("drawn"))
    error = 1.96 * F.sqrt("variance")
    return out.select(*by, "mark", "total", "variance", F.greatest(F.lit(0.0), F.col("total") - error).alias("low"), F.least(F.col("population").cast("double"), F.col("total") + error).alias("high"), "population", (F.col("total") / F.col("population")).alias("rate"), "drawn")
