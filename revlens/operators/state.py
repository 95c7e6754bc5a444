"""Review state: upserts with change detection, current views, crawl state."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import redact


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all machines share. Only on a single machine may it be unset: then a temporary
    folder is set, for checkpoints too."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="revlens-shared-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row per key in the given order (append-only history to current view)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def change_kind(stored_hash: Column, new_hash: Column) -> Column:
    return F.when(stored_hash.isNull(), "new").when(stored_hash != new_hash, "changed").otherwise("unchanged")


def upsert_kinds(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows with ``kind``; the stored side is reduced to key and hash before the join."""
    known = stored.select(*keys, F.col("source_hash").alias("_stored"))
    return incoming.join(known, keys, "left").withColumn("kind", change_kind(F.col("_stored"), F.col("source_hash"))).drop("_stored")


def merged(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The table after the upsert; ``first_seen_at`` of a known key is kept, everything else is overwritten."""
    first = stored.select(*keys, F.col("first_seen_at").alias("_first"))
    updated = incoming.join(first, keys, "left").withColumn("first_seen_at", F.coalesce("_first", "first_seen_at")).drop("_first")
    return stored.join(incoming.select(*keys), keys, "left_anti").unionByName(updated)


def high_water(rows: DataFrame, keys: list[str], previous: Column | None = None) -> DataFrame:
    """Largest update time per stream, never below the previous one; 0 counts as none."""
    now = F.max("timestamp_updated")
    return rows.groupBy(*keys).agg(F.nullif(F.greatest(F.coalesce(now, F.lit(0)), previous if previous is not None else F.lit(0)), F.lit(0)).alias("high_water"))


def fully_known_pages(pages: DataFrame, stored: DataFrame, keys: list[str], high: Column, overlap_seconds: int) -> DataFrame:
    """page_id, known: whether every row is older than the overlap window and stored with the same time and hash."""
    same = stored.select(*keys, "timestamp_updated", "source_hash").withColumn("_there", F.lit(True))
    found = pages.join(same, [*keys, "timestamp_updated", "source_hash"], "left")
    ok = F.col("_there").isNotNull() & (F.col("timestamp_updated") < high - overlap_seconds)
    return found.groupBy("page_id").agg(F.bool_and(ok).alias("known"))


def query_reviews(
    reviews: DataFrame, *, project_id: str, appids: list[int] | None = None, language: str | None = None, voted_up: bool | None = None, created_after: int | None = None, created_before: int | None = None, playtime_min: int | None = None, playtime_max: int | None = None
) -> DataFrame:
    """Reviews of a project by any of the filters; all bounds are inclusive. Sort by REVIEW_ORDER where order matters."""
    rules = [F.col("project_id") == project_id]
    rules += [F.col("appid").isin(appids)] if appids is not None else []
    rules += [F.col(c) == v for c, v in (("language", language), ("voted_up", voted_up)) if v is not None]
    rules += [F.col(c) >= v for c, v in (("timestamp_created", created_after), ("playtime_at_review", playtime_min)) if v is not None]
    rules += [F.col(c) <= v for c, v in (("timestamp_created", created_before), ("playtime_at_review", playtime_max)) if v is not None]
    for rule in rules:
        reviews = reviews.filter(rule)
    return reviews


REVIEW_ORDER = ("timestamp_created", "recommendationid")


def reconcile(configured: DataFrame, stored: DataFrame) -> DataFrame:
    """appid, action for configured ids against stored (appid, active)."""
    both = configured.select("appid", F.lit(True).alias("_c")).join(stored.select("appid", F.col("active")), "appid", "full")
    action = F.when(F.col("active").isNull(), "add").when(F.col("_c").isNull() & F.col("active"), "deactivate").when(F.col("_c").isNotNull() & ~F.col("active"), "activate").otherwise("keep")
    return both.select("appid", action.alias("action"))


#: Allowed run transitions.
TRANSITIONS = {"pending": ("running", "cancelled"), "running": ("completed", "partial", "failed", "cancelled")}


def transition_allowed(before: Column, after: Column) -> Column:
    out = F.lit(False)
    for state, targets in TRANSITIONS.items():
        out = out | ((before == state) & after.isin(*targets))
    return out


def decided(log: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The decision log after a policy's decisions came in: at most one row per key and policy hash.

    A key's decisions under other policies become obsolete at the new decision's time, unless they already are; the same
    policy's row is replaced and counts again. Keys without a new decision stay as they are.
    """
    at = new.select(*keys, F.col("policy_hash").alias("_policy"), F.col("decided_at").alias("_at"))
    old = log.join(at, keys, "left").filter(F.col("_policy").isNull() | (F.col("policy_hash") != F.col("_policy")))
    old = old.withColumn("obsolete_at", F.coalesce("obsolete_at", "_at")).drop("_policy", "_at")
    return old.unionByName(new.withColumn("obsolete_at", F.lit(None).cast(log.schema["obsolete_at"].dataType)))


def diagnostic_rows(raw: DataFrame, secrets: tuple[str, ...] = ()) -> DataFrame:
    """Diagnostics as they are stored: redacted, the stage and error to 80 characters, the message to 500; empty is null."""

    def short(name: str, n: int) -> Column:
        return F.nullif(F.left(redact(F.coalesce(name, F.lit("")), secrets), F.lit(n)), F.lit(""))

    return raw.withColumns({"stage": F.left(redact(F.col("stage"), secrets), F.lit(80)), "error_classification": short("error_classification", 80), "message": short("message", 500)})


def status_view(runs: DataFrame, units: DataFrame, diagnostics: DataFrame, last: int = 100) -> DataFrame:
    """Runs with their units and their last diagnostics, both in order, and the redacted error.

    runs: run_id, started (its order), status, error_summary. units: run_id, unit_key, status, attempt, position.
    diagnostics: run_id, sequence, stage, message. At most ``last`` diagnostics of a run are gathered; newest runs first is
    a matter of sorting the few rows that are shown by ``started``.
    """
    per_unit = F.transform(F.array_sort(F.collect_list(F.struct("position", "unit_key", "status", "attempt"))), lambda u: F.struct(u["unit_key"].alias("unit_key"), u["status"].alias("status"), u["attempt"].alias("attempt")))
    counts = units.groupBy("run_id").agg(F.count(F.lit(1)).alias("units"), F.count_if(F.col("status") == "failed").alias("failed_units"), per_unit.alias("unit_list"))
    w = Window.partitionBy("run_id").orderBy(F.desc("sequence"))
    tail = diagnostics.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last)
    tail = tail.groupBy("run_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sequence", "message"))), lambda d: d["message"]).alias("diagnostics"))  # at most `last` a run
    runs = runs.withColumn("error_summary", F.nullif(redact(F.coalesce("error_summary", F.lit(""))), F.lit("")))
    return runs.join(counts, "run_id", "left").join(tail, "run_id", "left").withColumns({"units": F.coalesce("units", F.lit(0)), "failed_units": F.coalesce("failed_units", F.lit(0))})


def latest_completed(runs: DataFrame, keys: list[str]) -> DataFrame:
    """The last completed run per key, by creation time, then id."""
    return latest(runs.filter("status = 'completed'"), keys, F.desc("created_at"), F.desc("run_id"))


def append_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Keep a run's rows under its own folder. Runs are only added: one that is there already is an error."""
    rows.drop("run_id").write.mode("error").parquet(f"{path}/run_id={run_id}")


def run_rows(spark: SparkSession, path: str, runs: DataFrame) -> DataFrame:
    """The stored rows of the given runs (run_id), however many. Spark prunes the folders by the runs' ids where it can broadcast
    them, which it decides by their size."""
    return spark.read.parquet(path).join(runs.select("run_id").distinct(), "run_id", "left_semi")


def snapshot_order(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """Store snapshots with their place per key, newest first, and whether the content changed from the one before."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("fetched_at"), F.desc("snapshot_id"))
    oldest = Window.partitionBy(*keys).orderBy("fetched_at", "snapshot_id")
    changed = F.coalesce(F.lag("source_hash").over(oldest) != F.col("source_hash"), F.lit(True))
    return snapshots.withColumn("place", F.row_number().over(newest)).withColumn("changed", changed)
