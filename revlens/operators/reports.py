"""What a report shows: cited recommendations, tables in the order of their groups, active competitors, snapshots in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .state import latest
from .usage import sums_before

#: How a report writes what it cites, and what it says without a citation.
METRIC_REF, REVIEW_REF, NO_REF = "`metric:%s` (%d/%d)", "`review:%s` (`selection:%s`)", "No direct citation"


def store_url(appid: Column) -> Column:
    """Canonical address of an app's store page (a fixed value)."""
    return F.format_string("https://store.steampowered.com/app/%d/", appid.cast("long"))


def bullets(items: Column) -> Column:
    """One line an item; a list without items says so."""
    return F.coalesce(F.nullif(F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit("")), F.lit("- None reported."))


def citations(recommendations: DataFrame, metrics: DataFrame, evidence: DataFrame) -> DataFrame:
    """brief_id, rank, heading and citation of every recommendation: its metrics, then its reviews, each in the order of its list.

    recommendations: brief_id, rank (unique in a brief), title, metric_ids, review_ids. metrics: metric_id, numerator,
    denominator. evidence: review_id, selection_id. All references of all briefs are looked up in two joins and regathered in
    one exchange by recommendation. What is not found is left out here; reference checks report it. Null lists are empty.
    """
    own = [F.col(c) for c in ("brief_id", "rank", "title")]

    def listed(name: str, kind: int) -> DataFrame:
        return recommendations.select(*own, F.lit(kind).alias("_kind"), F.posexplode(name).alias("_pos", "_id"))

    m = listed("metric_ids", 1).join(metrics.select(F.col("metric_id").alias("_id"), F.format_string(METRIC_REF, F.col("metric_id").cast("string"), F.col("numerator").cast("long"), F.col("denominator").cast("long")).alias("_text")), "_id")
    r = listed("review_ids", 2).join(evidence.select(F.col("review_id").alias("_id"), F.format_string(REVIEW_REF, F.col("review_id").cast("string"), F.col("selection_id").cast("string")).alias("_text")), "_id")
    bare = recommendations.select(*own, F.lit(0).alias("_kind"), F.lit(0).alias("_pos"), F.lit(None).cast("string").alias("_text"))
    every = bare.unionByName(m.drop("_id")).unionByName(r.drop("_id"))
    refs = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_kind", "_pos", "_text"))))  # as long as the row's own lists
    out = every.groupBy("brief_id", "rank").agg(F.max("title").alias("title"), F.transform(refs, lambda x: x["_text"]).alias("_refs"))
    heading = F.format_string("### %d. %s", F.col("rank").cast("long"), F.coalesce("title", F.lit("")))
    return out.select("brief_id", "rank", heading.alias("heading"), F.when(F.size("_refs") > 0, F.array_join("_refs", "; ")).otherwise(NO_REF).alias("citation"))


def in_order(rows: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """``rows`` with their place (from 1) in the order of all rows, by sums over ranges: no task sorts all of them."""
    counted = sums_before(rows, order, {name: F.lit(1)})
    return counted.withColumn(name, F.col(name) + 1)


def group_lines(groups: DataFrame, cells: list[Column]) -> DataFrame:
    """appid, language, place and line of each group: a table row with the given cells, groups ordered by appid as text, then
    language."""
    named = groups.withColumns({"appid": F.col("appid").cast("string"), "line": F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]), F.lit(" |"))})
    return in_order(named.select("appid", "language", "line"), ["appid", "language"])


def first_seen(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Each key's different values with their place by first appearance. Repeats are folded before rows are exchanged by key, so
    a key's task holds its different values only."""
    first = rows.groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_first"))
    return first.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("_first", value))).drop("_first")


def active_competitors(log: DataFrame, order: list[str]) -> DataFrame:
    """project_id, place by appid, appid and store_url of the competitors whose last entry of the log says that they are active.

    log: project_id, appid, active, and the columns of ``order``, the last of which decides. Null ``active`` is not active.
    """
    last = latest(log, ["project_id", "appid"], *[F.desc(c) for c in order]).filter("active")
    place = F.row_number().over(Window.partitionBy("project_id").orderBy("appid"))
    return last.select("project_id", place.alias("place"), "appid", store_url(F.col("appid")).alias("store_url"))


def snapshot_id(fetched_at: str = "fetched_at") -> Column:
    """Id of a store snapshot: project, app and time, of which there is one."""
    return F.concat_ws(":", "project_id", F.col("appid").cast("string"), F.col(fetched_at).cast("string"))


def snapshot_log(snapshots: DataFrame) -> DataFrame:
    """Snapshots with their id and their place by project, time, then app, however many a project has.

    snapshots: project_id, appid, fetched_at (text), which tell rows apart; of rows that they do not, one counts.
    """
    once = snapshots.dropDuplicates(["project_id", "appid", "fetched_at"])
    return in_order(once.withColumn("snapshot_id", snapshot_id()), ["project_id", "fetched_at", "appid"])
