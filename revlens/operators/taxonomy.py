"""Taxonomies as tables: merging, checks as rows, the closure over parents, and rates rolled up to ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SENTIMENTS
from ..functions.text import rate, stripped
from .state import shared_folder

def merged(core: DataFrame, extension: DataFrame) -> DataFrame:
    """Nodes (id, parent_id, name) of both, equal ones once; what they disagree on is a problem (:func:`problems`)."""
    columns = ["id", "parent_id", "name"]
    return core.select(*columns).unionByName(extension.select(*columns)).distinct()


def links(nodes: DataFrame) -> DataFrame:
    """id, parent_id, each once, of the nodes whose parent is known. Parents are looked up once each, however many children they have."""
    edges = nodes.filter("id is not null and parent_id is not null").select("id", "parent_id").distinct()
    found = edges.select("parent_id").distinct().join(nodes.select(F.col("id").alias("parent_id")).distinct(), "parent_id", "left_semi")
    return edges.join(found, "parent_id", "left_semi").select("id", "parent_id")


def ways_up(nodes: DataFrame) -> DataFrame:
    """id, ancestor, distance: each node with all that is above it, itself at distance 0, each once at its least distance.

    Distances double: a round puts what is above the ancestors at the last distance that a round reached on top of these, so a
    taxonomy of depth d takes log2(d) rounds of joins, whatever its number of rows. A cycle ends where nothing new is found.
    """
    shared_folder(nodes.sparkSession)
    pair = ["id", "ancestor"]
    known = nodes.filter("id is not null").select("id", F.col("id").alias("ancestor")).distinct().withColumn("distance", F.lit(0))
    above = known.unionByName(links(nodes).select("id", F.col("parent_id").alias("ancestor"), F.lit(1).alias("distance")))
    known, reach = above.groupBy(*pair).agg(F.min("distance").alias("distance")).checkpoint(), 1
    while not (edge := known.filter(F.col("distance") == reach)).isEmpty():
        through = edge.select(F.col("ancestor").alias("id")).distinct()  # few, if many nodes share them
        steps = known.filter("distance > 0").join(through, "id", "left_semi").select(F.col("id").alias("_mid"), F.col("ancestor").alias("_top"), F.col("distance").alias("_more"))
        found = edge.join(steps, F.col("ancestor") == F.col("_mid")).select("id", F.col("_top").alias("ancestor"), (F.col("distance") + F.col("_more")).alias("distance"))
        known, reach = known.unionByName(found).groupBy(*pair).agg(F.min("distance").alias("distance")).checkpoint(), 2 * reach
    return known


def problems(nodes: DataFrame) -> DataFrame:
    """id, problem: ``blank`` (no id or name), ``conflict`` (several definitions), ``unknown_parent``, ``cycle`` (the node lies
    on one, or its way up leads into one). No rows: the taxonomy is sound."""
    text = lambda c: stripped(F.coalesce(F.col(c).cast("string"), F.lit("")))
    blank = nodes.filter((text("id") == "") | (text("name") == "")).select("id", F.lit("blank").alias("problem"))
    several = nodes.distinct().groupBy("id").count().filter("count > 1 and id is not null").select("id", F.lit("conflict").alias("problem"))
    parents = nodes.filter("parent_id is not null").select("id", F.col("parent_id").alias("known"))
    unknown = parents.join(nodes.select(F.col("id").alias("known")).distinct(), "known", "left_anti").select("id", F.lit("unknown_parent").alias("problem"))
    ways = ways_up(nodes)
    back = links(nodes).select(F.col("id").alias("ancestor"), F.col("parent_id").alias("id"))
    closed = ways.join(back, ["id", "ancestor"], "left_semi").select("ancestor").distinct()  # what is above its own parent
    cycles = ways.join(closed, "ancestor", "left_semi").select("id", F.lit("cycle").alias("problem"))
    return blank.unionByName(several).unionByName(unknown).unionByName(cycles).distinct()


def closure(nodes: DataFrame) -> DataFrame:
    """id, ancestor, distance of a sound taxonomy; nodes in a cycle get each ancestor once, at its least distance."""
    return ways_up(nodes)


def rolled_up(current: DataFrame, nodes: DataFrame, grain: list[str]) -> DataFrame:
    """Share of reviews with an aspect of a sentiment in the subtree of a taxonomy id: grain, taxonomy_id, sentiment, depth,
    numerator, denominator, value; dense over the sentiments of each id that the grain's reviews have below them.

    Reviews with several aspects below an ancestor count once. Ancestors are looked up in a map of the taxonomy, which is
    small by what it is, within the review's row; only counts are shuffled. Aspects of unknown ids count as their own root.
    """
    table = closure(nodes)
    lists = table.groupBy("id").agg(F.collect_list("ancestor").alias("up"))
    ancestors = lists.agg(F.map_from_entries(F.collect_list(F.struct("id", "up")))).scalar()
    current = current.withColumn("_up", ancestors)
    up = lambda a: F.coalesce(F.try_element_at("_up", a["taxonomy_id"]), F.array(a["taxonomy_id"]))
    named = F.filter("result.aspects", lambda a: a["taxonomy_id"].isNotNull())
    pairs = F.array_distinct(F.flatten(F.transform(named, lambda a: F.transform(up(a), lambda t: F.struct(t.alias("taxonomy_id"), a["sentiment"].alias("sentiment"))))))
    none = F.array(F.struct(F.lit(None).cast("string").alias("taxonomy_id"), F.lit(None).cast("string").alias("sentiment")))
    cells = current.select(*grain, F.inline(F.concat(none, F.coalesce(pairs, F.array().cast("array<struct<taxonomy_id:string,sentiment:string>>")))))
    cells = cells.groupBy(*grain, "taxonomy_id", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    counts = [F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("n"))), F.lit(0)).alias(s) for s in SENTIMENTS]
    by_id = cells.filter("taxonomy_id is not null").groupBy(*grain, "taxonomy_id").agg(*counts)
    whole = cells.filter("taxonomy_id is null").select(*grain, F.col("n").alias("denominator"))
    depth = table.groupBy(F.col("id").alias("taxonomy_id")).agg(F.max("distance").alias("depth"))
    each = F.inline(F.array(*[F.struct(F.lit(s).alias("sentiment"), F.col(s).alias("numerator")) for s in SENTIMENTS]))
    rows = by_id.join(whole, grain).join(depth, "taxonomy_id", "left")
    rows = rows.select(*grain, "taxonomy_id", F.coalesce("depth", F.lit(0)).alias("depth"), "denominator", each)
    return rows.withColumn("value", rate(F.col("numerator"), F.col("denominator")))
