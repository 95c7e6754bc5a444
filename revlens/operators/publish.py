"""Published forms: Parquet datasets with a manifest, bounded synthesis payload, integrity checks, Markdown brief."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import BriefLimits, canonical_hash
from ..functions.text import claims_geography
from .classify import aspects


def shaped(df: DataFrame, dataset: str) -> DataFrame:
    """The dataset's public columns in order; those that ``df`` lacks are null."""
    return df.select(*[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in schemas.columns(schemas.EXPORTS[dataset])])


def export_parquet(datasets: dict[str, DataFrame], path: str, lineage: dict, *, project_id: str = "", rows_per_file: int = 5_000_000, rows_per_group: int = 100_000) -> dict:
    """Write the datasets in their global order, with zstd, and return the manifest.

    The files of a dataset, in the order of their names, are sorted as one. A file has about ``rows_per_file`` rows, a row group
    at most ``rows_per_group``. Each dataset is computed once and laid aside, so that counting it and finding the ranges
    reads stored columns. The manifest has each file's rows and range; per dataset, a row a file comes to the driver.
    """
    spark: SparkSession | None = None
    told = {}
    for name, df in datasets.items():
        spark = df.sparkSession
        order = list(schemas.EXPORT_ORDER[name])
        aside = f"{path}/_aside/{name}"
        shaped(df, name).write.mode("overwrite").parquet(aside)
        rows = spark.read.schema(schemas.EXPORTS[name]).parquet(aside)
        files = max(1, -(-rows.count() // rows_per_file))
        rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
        rows.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", rows_per_group).parquet(f"{path}/{name}")
        told[name] = {"path": name, "files": file_ranges(spark, f"{path}/{name}", name)}
        told[name]["rows"] = sum(f["rows"] for f in told[name]["files"])
    manifest = {
        "export_schema_version": schemas.SCHEMA_VERSION,
        "project_id": project_id,
        "lineage": lineage,
        "lineage_hash": canonical_hash(lineage),
        "datasets": told,
        "partition_policy": "one folder a dataset; its files, in the order of their names, are sorted by the dataset's order",
    }
    if spark is not None:
        spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_aside")
        files.getFileSystem(spark._jsc.hadoopConfiguration()).delete(files, True)
    return manifest


def file_ranges(spark: SparkSession, folder: str, dataset: str) -> list[dict]:
    """name, rows, first and last key of each file of an exported dataset, in the order of their names."""
    order = [F.col(c) for c in schemas.EXPORT_ORDER[dataset]]
    key = F.struct(*order)
    rows = spark.read.schema(schemas.EXPORTS[dataset]).parquet(folder).groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"))
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.to_json(F.min(key)).alias("first"), F.to_json(F.max(key)).alias("last")).collect()  # a row a file
    return [{"name": r["name"], "rows": r["rows"], "first": json.loads(r["first"]), "last": json.loads(r["last"])} for r in sorted(found)]


def classification_rows(current: DataFrame, project_id: str) -> DataFrame:
    """The exported classifications of the current view."""
    r = F.col("result")
    named = {"overall_sentiment": r["overall_sentiment"], "engagement_posture": r["engagement_posture"], "actionable": r["is_actionable"], "self_reported_abandonment": r["self_reported_abandonment"]["mentioned"]}
    return shaped(current.withColumn("project_id", F.lit(project_id)).withColumns(named), "classifications")


def aspect_rows(current: DataFrame, project_id: str) -> DataFrame:
    return shaped(aspects(current).withColumn("project_id", F.lit(project_id)), "aspects")


def quote_rows(selected: DataFrame, project_id: str, run_id: str) -> DataFrame:
    """The exported quotes of a run, from :func:`evidence.select`."""
    return shaped(selected.withColumn("project_id", F.lit(project_id)).withColumn("run_id", F.lit(run_id)), "quotes")


def metric_error() -> Column:
    """Why a metric cannot be referred to, or null. Columns: metric_id, metric_name, numerator, denominator, value,
    population_definition and dimensions (a map)."""
    empty = F.lit(False)
    for name in ("metric_id", "metric_name", "population_definition"):
        empty = empty | (F.coalesce(F.col(name), F.lit("")) == "")
    places = F.exists(F.map_keys("dimensions"), lambda k: F.lower(k).isin("country", "region", "geography"))
    return (
        F.when(empty, "identity")
        .when(~F.coalesce((F.col("numerator") >= 0) & (F.col("denominator") > 0), F.lit(False)), "denominator")
        .when(F.col("value").isNotNull() & ~F.col("value").between(0, 1), "value")
        .when(places, "geography")
    )


LEVELS = ("high", "medium", "low")


def recommendation_error(known_metrics: Column, known_reviews: Column) -> Column:
    """Why a recommendation is refused, or null: rank, title, action, impact, effort, validation_step, confidence, and the
    ids that it refers to, all of which must be among the known (arrays of the bounded payload)."""
    blank = F.lit(False)
    for name in ("title", "action", "impact", "effort", "validation_step"):
        blank = blank | (F.coalesce(F.col(name), F.lit("")) == "")
    unknown = (F.size(F.array_except("evidence_metric_ids", known_metrics)) > 0) | (F.size(F.array_except("evidence_review_ids", known_reviews)) > 0)
    return (
        F.when((F.coalesce("rank", F.lit(0)) < 1) | blank, "required")
        .when(~F.col("impact").isin(*LEVELS) | ~F.col("effort").isin(*LEVELS, "unknown"), "impact_or_effort")
        .when(~F.coalesce(F.col("confidence").isin(*LEVELS), F.lit(False)), "confidence")
        .when(unknown, "unknown_evidence")
        .when(claims_geography(F.concat_ws(" ", "title", "action", "validation_step")), "geography")
    )


def brief_error(limits: BriefLimits = BriefLimits()) -> Column:
    """Why a whole brief is refused for its form: status, and more items than a list may have. Columns: status,
    findings, priorities, risks, vulnerabilities, caveats (arrays of text)."""
    out = F.when(~F.coalesce(F.col("status").isin("complete", "insufficient_evidence"), F.lit(False)), "status")
    for name in ("findings", "priorities", "risks", "vulnerabilities"):
        out = out.when(F.size(name) > getattr(limits, name), f"too_many_{name}")
    out = out.when((F.col("status") == "insufficient_evidence") & (F.size("caveats") == 0), "caveat")
    return out.when(claims_geography(F.array_join(F.concat("findings", "risks", "vulnerabilities"), " ")), "geography")


#: The version of the brief's and payload's form, the lists of a brief with the limit that each has, and what a
#: payload's competitors must not carry.
BRIEF_VERSION = "stage2-v1"
BRIEF_LISTS = {
    "findings": "findings", "recommendations": "priorities", "risks": "risks", "market_expectations": "priorities", "vulnerabilities": "vulnerabilities", "positioning": "priorities", "store_recommendations": "priorities",
}
RAW_FIELDS = ("review_text", "raw_json")


def brief_table_errors(briefs: DataFrame, items: DataFrame, limits: BriefLimits = BriefLimits(), version: str = BRIEF_VERSION) -> DataFrame:
    """brief_id, error (null: none) of whole briefs, by the first rule that one breaks.

    briefs: brief_id, status, schema_version. items: brief_id, list (of ``BRIEF_LISTS``, or ``caveats``), text. The rules: status and
    version, each list's limit in order, a caveat where evidence is insufficient, and no geography in any list but the
    recommendations, which are checked by themselves. Items are counted, not gathered.
    """
    listed = F.col("list")
    counts = [F.count_if(listed == name).alias(f"_{name}") for name in (*BRIEF_LISTS, "caveats")]
    places = F.bool_or(listed.isin(*[k for k in BRIEF_LISTS if k != "recommendations"]) & claims_geography(F.coalesce("text", F.lit("")))).alias("_places")
    rows = briefs.join(items.groupBy("brief_id").agg(*counts, places), "brief_id", "left")
    out = F.when(~F.coalesce(F.col("status").isin("complete", "insufficient_evidence") & (F.col("schema_version") == version), F.lit(False)), "status_or_version")
    for name, limit in BRIEF_LISTS.items():
        out = out.when(F.coalesce(f"_{name}", F.lit(0)) > getattr(limits, limit), f"too_many_{name}")
    out = out.when((F.col("status") == "insufficient_evidence") & (F.coalesce("_caveats", F.lit(0)) == 0), "caveat").when(F.col("_places"), "geography")
    return rows.select("brief_id", out.alias("error"))


def payload_errors(payloads: DataFrame, metrics: DataFrame, evidence: DataFrame, competitors: DataFrame, limits: BriefLimits = BriefLimits(), version: str = BRIEF_VERSION) -> DataFrame:
    """payload_id, error (null: none) of synthesis payloads, by the first rule that one breaks.

    payloads: payload_id, project_id, run_id, schema_version. metrics: payload_id, metric_id. evidence: payload_id. competitors:
    payload_id, fields (a JSON object). The rules: identity, version, at most ``limits`` metrics and evidence, no raw review
    fields, and no metric twice.
    """
    m = metrics.groupBy("payload_id", "metric_id").count().groupBy("payload_id").agg(F.sum("count").alias("_metrics"), F.max("count").alias("_most"))
    e = evidence.groupBy("payload_id").agg(F.count(F.lit(1)).alias("_evidence"))
    raw = F.arrays_overlap(F.json_object_keys("fields"), F.array(*[F.lit(x) for x in RAW_FIELDS]))
    c = competitors.groupBy("payload_id").agg(F.bool_or(F.coalesce(raw, F.lit(False))).alias("_raw"))
    rows = payloads.join(m, "payload_id", "left").join(e, "payload_id", "left").join(c, "payload_id", "left")
    empty = (F.coalesce("project_id", F.lit("")) == "") | (F.coalesce("run_id", F.lit("")) == "")
    error = (
        F.when(empty, "identity")
        .when(~F.coalesce(F.col("schema_version") == version, F.lit(False)), "version")
        .when((F.coalesce("_metrics", F.lit(0)) > limits.metrics) | (F.coalesce("_evidence", F.lit(0)) > limits.evidence), "too_many")
        .when(F.col("_raw"), "raw_fields")
        .when(F.col("_most") > 1, "duplicate_metric")
    )
    return rows.select("payload_id", error.alias("error"))


def payload_rows(metrics: DataFrame, quotes: DataFrame, competitors: DataFrame, limits: BriefLimits = BriefLimits()) -> DataFrame:
    """What a synthesis payload holds, a row each: kind, id, body (JSON). The first metrics with a denominator by id, the first quotes
    by score, then id, and the active competitors (appid, title) by id; texts of reviews beyond the quotes are never in it."""
    chosen = quotes.orderBy(F.desc("score"), "selection_id").limit(limits.evidence)
    parts = (
        payload_metrics(metrics, limits.metrics).select(F.lit("metric").alias("kind"), F.col("metric_id").alias("id"), F.to_json(F.struct("metric_name", "numerator", "denominator")).alias("body")),
        chosen.select(F.lit("evidence").alias("kind"), F.col("selection_id").alias("id"), F.to_json(F.struct("appid", "recommendationid", "language", "evidence")).alias("body")),
        competitors.select(F.lit("competitor").alias("kind"), F.format_string("%012d", "appid").alias("id"), F.to_json(F.struct("appid", "title")).alias("body")),
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def payload_metrics(metrics: DataFrame, most: int = 120) -> DataFrame:
    """Metrics with a denominator, the first by id."""
    return metrics.filter("denominator > 0").orderBy("metric_id").limit(most)


def dangling(references: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """References to ids that do not exist; empty if all is well."""
    return references.join(known.select(key).distinct(), key, "left_anti")


def render_report(title: str, priorities: list[dict], metrics: list[dict], evidence: list[dict], *, least: int = 1500, most: int = 3000, pad: str = "") -> str:
    """Markdown brief from bounded inputs: priorities by rank, each with its citations. Never cut: too long or too short is an error."""
    lines = [f"# {title}", "", "## Priorities", ""]
    by_metric, by_quote = {m["metric_id"]: m for m in metrics}, {e["selection_id"]: e for e in evidence}
    for p in sorted(priorities, key=lambda x: x["rank"]):
        lines.append(f"{p['rank']}. {p['text']}")
        lines += [f"   - metric:{k} ({by_metric[k]['numerator']}/{by_metric[k]['denominator']})" for k in p.get("metrics", ())]
        lines += [f"   - review:{by_quote[k]['recommendationid']} (selection:{k})" for k in p.get("evidence", ())]
    lines += ["", "## Notes", "", pad]
    text = "\n".join(lines)
    words = len(re.findall(r"\b[\w][\w'-]*\b", text))
    if not least <= words <= most:
        raise ValueError(f"the report has {words} words, not {least} to {most}")
    return text
