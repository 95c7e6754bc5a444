"""Dense, zero-filled rate metrics with numerator, denominator and a null-safe value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COHORT_NAMES, FRICTION, POSTURES, SENTIMENTS, Cohorts
from ..functions.text import json_string, rate

GRAIN = ["appid", "language", "polarity"]


def cohort(playtime: Column, limits: Cohorts = Cohorts()) -> Column:
    return F.when(playtime.isNull(), "unknown").when(playtime < limits.early_below, "early").when(playtime < limits.established_below, "established").otherwise("long")


def with_polarity(current: DataFrame) -> DataFrame:
    return current.withColumn("appid", F.col("appid").cast("string")).withColumn("polarity", F.when(F.col("voted_up"), "positive").otherwise("negative"))


#: What the metrics read of the current view.
NO_PAIR = "array<struct<taxonomy_id:string,sentiment:string>>"


def counted(current: DataFrame, limits: Cohorts = Cohorts(), aspects: bool = True) -> DataFrame:
    """One scan of the current view, reduced to counts; every family reads this.

    Each review gives a row for its posture and cohort and, with ``aspects``, one per different (taxonomy id, sentiment) of
    its aspects. Aspects without a taxonomy id are left out.
    """
    pairs = F.array_distinct(F.transform("result.aspects", lambda a: F.struct(a["taxonomy_id"].alias("taxonomy_id"), a["sentiment"].alias("sentiment"))))
    named = F.coalesce(F.filter(pairs, lambda a: a["taxonomy_id"].isNotNull()), F.array().cast(NO_PAIR)) if aspects else F.array().cast(NO_PAIR)
    none = F.array(F.struct(F.lit(None).cast("string").alias("taxonomy_id"), F.lit(None).cast("string").alias("sentiment")))
    rows = with_polarity(current).select(
        *GRAIN,
        F.col("result.engagement_posture").alias("posture"),
        cohort(F.col("playtime_at_review"), limits).alias("cohort"),
        F.col("refunded").cast("long").alias("refunded"),
        "votes_up",
        F.coalesce(F.col("result.self_reported_abandonment.mentioned"), F.lit(False)).alias("mentioned"),
        F.inline(F.concat(none, named)),
    )
    own = F.col("taxonomy_id").isNull()
    rows = rows.withColumn("posture", F.when(own, F.col("posture"))).withColumn("cohort", F.when(own, F.col("cohort")))
    return rows.groupBy(*GRAIN, "posture", "cohort", "taxonomy_id", "sentiment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("refunded").alias("refunded"), F.sum("votes_up").alias("votes"), F.count_if("mentioned").alias("mentioned")
    )


def dense(cells: DataFrame) -> DataFrame:
    """One row per (app, language, polarity) with every count the families need. Both polarities come from conditional
    sums over the same cells, so the rows are dense and filled with 0 without a join. ``aspects`` has the counts of each
    taxonomy id and sentiment (as many as the taxonomy has)."""
    own = F.col("taxonomy_id").isNull()

    def total(column: str, where: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(column))), F.lit(0)).alias(name)

    def counts(polarity: str) -> Column:
        mine = (F.col("polarity") == polarity) & own
        friction = mine & F.col("posture").isin(*FRICTION)
        aspect = F.struct("taxonomy_id", "sentiment", "n")
        return F.struct(
            F.lit(polarity).alias("polarity"),
            *[total(c, mine, c) for c in ("n", "refunded", "votes", "mentioned")],
            *[total("n", mine & (F.col("posture") == p), f"posture_{p}") for p in POSTURES],
            *[total("n", mine & (F.col("cohort") == c), f"cohort_{c}") for c in COHORT_NAMES],
            *[total("n", friction & (F.col("cohort") == c), f"friction_{c}") for c in COHORT_NAMES],
            F.collect_list(F.when(~own & (F.col("polarity") == polarity), aspect)).alias("aspects"),
        )

    rows = cells.groupBy("appid", "language").agg(total("n", own, "all"), F.array(counts("positive"), counts("negative")).alias("by_polarity"))
    return rows.select("appid", "language", "all", F.inline("by_polarity"))


#: What each family's denominator is, and what has to be said with its numbers.
POPULATION = {
    "review_count": "eligible classified reviews",
    "posture_rate": "classified reviews of polarity",
    "aspect_rate": "classified reviews of polarity",
    "refunded_rate": "classified reviews of polarity",
    "abandonment_mention_rate": "classified reviews of polarity",
    "helpfulness_visibility": "up-vote visibility among classified reviews of polarity",
    "friction_rate": "classified reviews in playtime cohort",
}
CAVEATS = {
    "refunded_rate": "API refund fact is distinct from textual abandonment evidence",
    "abandonment_mention_rate": "self-reported abandonment is unverified text evidence",
    "helpfulness_visibility": "visibility weighting is separate from unweighted prevalence",
    "friction_rate": "low playtime indicates early friction, not verified churn",
}


#: Dimensions of a metric, in the order of their names; the last four are those of single families.
DIMENSIONS = ("appid", "cohort", "language", "polarity", "posture", "sentiment", "taxonomy_id")


def entry(name: str, numerator: Column | str, denominator: str, **extra: Column) -> Column:
    """One metric of a row: name, its family's own dimensions, numerator, denominator."""
    own = [extra.get(k, F.lit(None)).cast("string").alias(k) for k in DIMENSIONS if k not in GRAIN]
    return F.struct(F.lit(name).alias("metric_name"), *own, (F.col(numerator) if isinstance(numerator, str) else numerator).cast("long").alias("numerator"), F.col(denominator).cast("long").alias("denominator"))


def review_count() -> list[Column]:
    return [entry("review_count", "n", "all")]


def posture_rate() -> list[Column]:
    return [entry("posture_rate", f"posture_{p}", "n", posture=F.lit(p)) for p in POSTURES]


def refunded_rate() -> list[Column]:
    return [entry("refunded_rate", "refunded", "n")]


def abandonment_mention_rate() -> list[Column]:
    return [entry("abandonment_mention_rate", "mentioned", "n")]


def helpfulness_visibility() -> list[Column]:
    return [entry("helpfulness_visibility", "votes", "votes")]


def friction_rate() -> list[Column]:
    return [entry("friction_rate", f"friction_{c}", f"cohort_{c}", cohort=F.lit(c)) for c in COHORT_NAMES]


#: Families with a fixed number of rows per (app, language, polarity).
FIXED = (review_count, posture_rate, refunded_rate, abandonment_mention_rate, helpfulness_visibility, friction_rate)


def aspect_entries() -> Column:
    """Four sentiments of each taxonomy id that the row's aspects have."""
    ids = F.array_distinct(F.transform("aspects", lambda a: a["taxonomy_id"]))

    def of(taxonomy: Column) -> Column:
        def hits(sentiment: str) -> Column:
            return F.aggregate(F.filter("aspects", lambda a: (a["taxonomy_id"] == taxonomy) & (a["sentiment"] == sentiment)), F.lit(0).cast("long"), lambda n, a: n + a["n"])

        return F.array(*[entry("aspect_rate", hits(s), "n", taxonomy_id=taxonomy, sentiment=F.lit(s)) for s in SENTIMENTS])

    return F.flatten(F.transform(ids, of))


def dimensions(spaced: bool = False) -> Column:
    """The dimensions that a metric has as a JSON object in the order of their names, compact or as they are stored."""
    comma, colon = (", ", ": ") if spaced else (",", ":")
    parts = {k: F.concat(F.lit(f'"{k}"{colon}'), json_string(F.col(k))) for k in DIMENSIONS}
    return F.concat(F.lit("{"), F.concat_ws(comma, *[p if k in GRAIN else F.when(F.col(k).isNotNull(), p) for k, p in parts.items()]), F.lit("}"))


def finished(entries: DataFrame) -> DataFrame:
    """Adds the dimensions as text, the id (a hash of name and dimensions), the rate, and what has to be said with it."""
    name = F.col("metric_name")
    population, caveat = (F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in values.items()]) for values in (POPULATION, CAVEATS))
    caveats = F.when((name != "friction_rate") | (F.col("cohort") == "early"), F.to_json(F.array(caveat)))
    named = entries.withColumns({"dimensions_json": dimensions(), "dimensions_spaced": dimensions(spaced=True), "population_definition": population, "caveats_json": F.when(caveat.isNotNull(), caveats)})
    named = named.select("metric_name", "dimensions_json", "dimensions_spaced", "numerator", "denominator", "population_definition", F.coalesce("caveats_json", F.lit("[]")).alias("caveats_json"))
    ident = F.substring(F.sha2(F.concat(F.lit('["'), "metric_name", F.lit('",'), "dimensions_json", F.lit("]")), 256), 1, 24)
    return named.select(ident.alias("metric_id"), "*", rate(F.col("numerator"), F.col("denominator")).alias("value"))


def fixed_metrics(current: DataFrame, limits: Cohorts = Cohorts(), families: tuple = FIXED) -> DataFrame:
    """The given families from one pass over the current view."""
    return finished(dense(counted(current, limits, aspects=False)).select(*GRAIN, F.inline(F.array(*[e for f in families for e in f()]))))


def aspect_rate(current: DataFrame) -> DataFrame:
    """Share of reviews with at least one matching aspect; several equal aspects of a review count once."""
    return finished(dense(counted(current)).select(*GRAIN, F.inline(aspect_entries())))


def all_metrics(current: DataFrame, limits: Cohorts = Cohorts()) -> DataFrame:
    """All families from one pass over the current view."""
    fixed = F.array(*[e for f in FIXED for e in f()])
    return finished(dense(counted(current, limits)).select(*GRAIN, F.inline(F.concat(fixed, aspect_entries()))))


def stored(metrics: DataFrame, run_id: str, source_count: Column, classified_count: Column) -> DataFrame:
    """Metrics as an append-only run keeps them, with the run's coverage (see :func:`coverage`)."""
    rate_text = F.when(source_count > 0, (classified_count / source_count).cast("string")).otherwise("null")
    numbers = {"classified_count": classified_count.cast("string"), "coverage_rate": rate_text, "source_count": source_count.cast("string"), "unclassified_count": F.greatest(F.lit(0), source_count - classified_count).cast("string")}
    text = F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), v) for k, v in numbers.items()]), F.lit("}"))
    return metrics.select(
        F.lit(run_id).alias("run_id"), "metric_id", "metric_name", F.col("dimensions_spaced").alias("dimensions_json"), "numerator", "denominator", "value", "population_definition", text.alias("coverage_json"), "caveats_json"
    )


def coverage(source: DataFrame, current: DataFrame) -> DataFrame:
    """source_count, classified_count, unclassified_count, coverage_rate, over everything."""
    counts = source.agg(F.count(F.lit(1)).alias("source_count")).crossJoin(current.agg(F.count(F.lit(1)).alias("classified_count")))  # one row each
    return counts.withColumn("unclassified_count", F.greatest(F.lit(0), F.col("source_count") - F.col("classified_count"))).withColumn("coverage_rate", rate(F.col("classified_count"), F.col("source_count")))


def lineage(current: DataFrame) -> DataFrame:
    """Number of different texts and the sorted run ids behind the current view, which are few: for sets of any size there are
    :func:`lineage_values` and :func:`lineage_hash`."""
    runs = current.select("run_id").distinct()
    return current.agg(F.countDistinct("source_hash").alias("source_hashes")).crossJoin(runs.agg(F.array_join(F.array_sort(F.collect_list("run_id")), ",").alias("run_ids")))


def lineage_values(current: DataFrame) -> DataFrame:
    """kind, value: every text hash, run and policy behind the current view, one row each, however many there are."""
    kinds = {"source_hash": "source_hash", "classification_run_id": "run_id", "eligibility_policy_hash": "policy_hash"}
    values = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds.items()])
    return current.select(F.inline(values)).distinct()


#: Values below one leaf of a lineage tree, about, and the levels that a tree may have: enough for 10^12 values.
LEAF_VALUES, LINEAGE_DEPTH = 256, 8


def lineage_hash(values: DataFrame, leaf_values: int = LEAF_VALUES) -> DataFrame:
    """kind, n, hash of the set of values of each kind: a tree of SHA-256 over sorted ranges, whatever the partitioning.

    A value's place is its own hash. Leaves are the values whose hashes begin alike, by so many digits that a leaf has about
    ``leaf_values``; a node is the hash of its children's in order. So no row gathers more than a leaf or 16 children, and two
    runs whose hashes differ can be compared branch by branch. Nulls are left out; repeated values count once.
    """
    rows = values.filter("value is not null").select("kind", F.sha2("value", 256).alias("h")).distinct()
    sizes = rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    depth = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n") / leaf_values))).cast("int")
    nodes = rows.join(F.broadcast(sizes.withColumn("depth", F.least(depth, F.lit(LINEAGE_DEPTH)))), "kind")  # a row a kind
    nodes = nodes.groupBy("kind", "n", "depth", F.expr("left(h, depth)").alias("prefix")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    for level in range(LINEAGE_DEPTH - 1, -1, -1):
        above = F.col("depth") > level
        prefix = F.when(above, F.left("prefix", F.lit(level))).otherwise(F.col("prefix"))
        child = F.struct("prefix", "h")
        nodes = nodes.groupBy("kind", "n", "depth", prefix.alias("up")).agg(F.array_sort(F.collect_list(child)).alias("c"))
        folded = F.sha2(F.array_join(F.transform("c", lambda x: x["h"]), ""), 256)
        nodes = nodes.select("kind", "n", "depth", F.col("up").alias("prefix"), F.when(above, folded).otherwise(F.col("c")[0]["h"]).alias("h"))
    return nodes.select("kind", "n", F.col("h").alias("hash"))


#: Analytical labels of reviews, not verified behaviour.
RETENTION = ("early_rejection", "early_dissatisfaction", "established_dissatisfaction", "long_use_dissatisfaction", "invested_frustration", "qualified_retention", "strong_advocacy")


def retention_labels(limits: Cohorts = Cohorts(), strong: int = 4) -> Column:
    """The labels that a review of the current view has (an array, often empty).

    Dissatisfaction needs an actionable negative review, rejection a posture of friction; invested frustration needs long or
    substantial (established) playtime; retention is qualified by a negative aspect; advocacy is strong with a positive
    sentiment of at least ``strong`` of 5.
    """
    age, posture, up = cohort(F.col("playtime_at_review"), limits), F.col("result.engagement_posture"), F.col("voted_up")
    unhappy = ~up & F.col("result.is_actionable")
    negative = F.exists("result.aspects", lambda a: a["sentiment"] == "negative")
    rules = (
        ~up & (age == "early") & posture.isin(*FRICTION),
        unhappy & (age == "early"),
        unhappy & (age == "established"),
        unhappy & (age == "long"),
        age.isin("established", "long") & (posture == "frustrated_but_engaged"),
        up & negative,
        up & (posture == "advocacy") & (F.col("result.overall_sentiment") == "positive") & (F.col("result.sentiment_intensity") >= strong),
    )
    return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in zip(RETENTION, rules, strict=True)]))


#: Levels at which retention labels are counted: all, by app and language, and these by one more dimension each.
LEVELS = ([], ["appid"], ["appid", "language"], ["appid", "language", "updated_period"], ["appid", "language", "steam_purchase"], ["appid", "language", "received_for_free"], ["appid", "language", "cohort"])


def retention_levels(current: DataFrame, limits: Cohorts = Cohorts(), strong: int = 4, period: str = "quarter") -> DataFrame:
    """Counts of each retention label at all of ``LEVELS`` from one aggregation: level (``grouping_id``), the dimensions (null
    where the level has none of it), label, numerator, denominator, value; dense over the labels of values that are there.

    The current view needs timestamp_updated, steam_purchase and received_for_free beside its own columns. A dimension's null
    is a value of its own, which ``level`` tells from a level without it.
    """
    dims = ["appid", "language", "updated_period", "steam_purchase", "received_for_free", "cohort"]
    updated = F.date_format(F.date_trunc(period, F.timestamp_seconds("timestamp_updated")), "yyyy-MM")
    rows = current.withColumn("updated_period", updated).withColumn("cohort", cohort(F.col("playtime_at_review"), limits)).withColumn("_labels", retention_labels(limits, strong))
    cells = rows.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.array_contains("_labels", name)).alias(name) for name in RETENTION])
    sums = [F.sum(c).alias(c) for c in ("n", *RETENTION)]
    levels = cells.groupingSets([[F.col(d) for d in level] for level in LEVELS], *dims).agg(F.grouping_id(*dims).alias("level"), *sums)
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("label"), F.col(name).alias("numerator")) for name in RETENTION]))
    out = levels.select("level", *dims, F.col("n").alias("denominator"), each)
    return out.withColumn("value", rate(F.col("numerator"), F.col("denominator")))
