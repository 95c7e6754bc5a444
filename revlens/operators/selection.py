"""Selection of reviews for classification, token estimates and batch plans."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BatchLimits, Selection
from ..functions.text import token_estimate, unit_hash
from .state import shared_folder

STRATUM = ["appid", "language", "voted_up", "playtime_bucket", "signal"]


def stable_score(seed: int, project_id: str) -> Column:
    return unit_hash(F.concat_ws(":", F.lit(str(seed)), F.lit(project_id), F.col("appid").cast("string"), F.col("recommendationid")))


def with_strata(reviews: DataFrame) -> DataFrame:
    play = F.coalesce("playtime_at_review", F.lit(0))
    bucket = F.when(play < 60, "early").when(play < 600, "established").otherwise("long")
    signal = F.concat(F.when(F.col("timestamp_created") >= 1_700_000_000, "recent").otherwise("older"), F.lit(":"), F.when(F.col("votes_up") >= 10, "helpful").otherwise("ordinary"))
    return reviews.withColumn("playtime_bucket", bucket).withColumn("signal", signal)


#: Buckets of the score's histogram, of which the driver gets a count each.
BUCKETS = 4096


def top_by_score(rows: DataFrame, n: int) -> DataFrame:
    """The n rows of the smallest score (within 0 to 1); ties by key.

    A histogram gives the bucket in which the n-th row lies. All rows of the buckets before it are taken where they are;
    only that bucket's rows are ranked.
    """
    bucket = F.least(F.floor(F.col("score") * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    rows = rows.withColumn("_bucket", bucket)
    sizes = {r["_bucket"]: r["count"] for r in rows.groupBy("_bucket").count().collect()}
    edge, before = BUCKETS, 0
    for k in sorted(sizes):
        if before + sizes[k] >= n:
            edge = k
            break
        before += sizes[k]
    if edge == BUCKETS:  # there are no more than n
        return rows.drop("_bucket")
    order = Window.partitionBy("_bucket").orderBy("score", "appid", "recommendationid")
    last = rows.filter(F.col("_bucket") == edge).withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n - before).drop("_rn")
    return rows.filter(F.col("_bucket") < edge).unionByName(last).drop("_bucket")


def stratified(reviews: DataFrame, choice: Selection, project_id: str) -> DataFrame:
    """One review per stratum, filled up by score to the ceiling or a tenth of all; then cut to the ceiling."""
    rows = with_strata(reviews).withColumn("score", stable_score(choice.seed, project_id))
    keys = rows.select("appid", "recommendationid", "score", *STRATUM[1:])
    first = Window.partitionBy(*STRATUM).orderBy("score", "appid", "recommendationid")
    chosen = keys.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").select("appid", "recommendationid", "score")  # one row a stratum leaves each task
    counted = {"n": rows.count(), "strata": chosen.count()}
    target = choice.ceiling or max(counted["strata"], math.ceil(0.1 * counted["n"]))
    if target > counted["strata"]:
        rest = keys.select("appid", "recommendationid", "score").join(chosen.select("appid", "recommendationid"), ["appid", "recommendationid"], "left_anti")
        chosen = chosen.unionByName(top_by_score(rest, target - counted["strata"]))
    if choice.ceiling:
        chosen = top_by_score(chosen, choice.ceiling)
    n = max(1, min(target, counted["n"]))
    rows = rows.join(chosen.select("appid", "recommendationid"), ["appid", "recommendationid"], "left_semi")
    return rows.withColumn("sampling_weight", F.lit(counted["n"] / n))


def select_inputs(reviews: DataFrame, choice: Selection, project_id: str) -> DataFrame:
    """By scope: ``all`` and ``unclassified-only`` take every row given, ``stratified`` a sample, ``progressive`` a sample
    of a corpus above the threshold."""
    if choice.scope not in ("all", "unclassified-only", "stratified", "progressive"):
        raise ValueError(f"unknown scope {choice.scope}")
    whole = choice.scope in ("all", "unclassified-only") or (choice.scope == "progressive" and reviews.count() <= choice.full_corpus_threshold)
    if whole:
        return with_strata(reviews).withColumn("score", stable_score(choice.seed, project_id)).withColumn("sampling_weight", F.lit(1.0))
    return stratified(reviews, choice, project_id)


def estimated(reviews: DataFrame) -> DataFrame:
    """Adds ``tokens`` of the seven-field projection that a provider gets."""
    projection = F.struct("appid", "recommendationid", "language", "voted_up", "playtime_at_review", "review_text", "source_hash")
    return reviews.withColumn("tokens", token_estimate(F.to_json(projection, {"ignoreNullFields": "false"}), 13))


#: Items of a block of the batch plan.
BLOCK = 20_000


def numbered(items: DataFrame) -> DataFrame:
    """appid, recommendationid, tokens and ``i``, the item's place in its app by id, from 0.

    Items are range-partitioned by app and id; a place is that within the app's part of a partition plus the sizes of its
    parts in the partitions before, of which there is one row each.
    """
    rows = items.select("appid", "recommendationid", "tokens").repartitionByRange("appid", "recommendationid")
    shared_folder(items.sparkSession)
    rows = rows.withColumn("_part", F.spark_partition_id()).checkpoint()  # read twice: one set of bounds for both, also after a lost executor
    inside = Window.partitionBy("appid", "_part").orderBy("recommendationid")
    before = Window.partitionBy("appid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy("appid", "_part").count().select("appid", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    placed = rows.withColumn("_i", F.row_number().over(inside) - 1).join(first, ["appid", "_part"])
    return placed.select("appid", "recommendationid", "tokens", (F.col("_i") + F.col("_first")).cast("long").alias("i"))


def plan_batches(items: DataFrame, limits: BatchLimits = BatchLimits(), block: int = BLOCK) -> DataFrame:
    """Pack the items of an app, in id order, into batches: appid, recommendationid, tokens, batch (from 0 per app).

    A batch is closed by the item that would be one too many or would pass the token limit, whatever the app's size. Items
    are cut to blocks of ``block`` places; a batch has at most ``max_items`` items, so a block is entered at one of its
    first ``max_items`` places. Each block first says, for all of them, where the next block is entered and how many
    batches start in it; these short rows are followed through an app's blocks in order; then each block marks its own
    batches. An item above the token limit gets a null batch and is not counted.
    """
    shared_folder(items.sparkSession)
    items = items.select("appid", "recommendationid", "tokens").checkpoint()  # texts are measured once
    fits = F.col("tokens") <= limits.max_tokens
    good = numbered(items.filter(fits))
    reach = limits.max_items
    block = max(block, reach)  # so that a batch lies in two blocks at most
    k = F.floor(F.col("i") / block).cast("long")
    rows = good.withColumn("_k", k).withColumn("_own", F.lit(True))
    ahead = rows.filter((F.col("i") % block < reach) & (F.col("_k") > 0)).withColumn("_k", F.col("_k") - 1).withColumn("_own", F.lit(False))  # the next block's first items, to end batches
    blocks = rows.unionByName(ahead)

    def following(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int]:
        """Sorted items, the start of the batch after one that starts at each of the block's own, number of these."""
        frame = frame.sort_values("i")
        total = np.concatenate([[0], np.cumsum(frame["tokens"].to_numpy("int64"))])
        n = int(frame["_own"].sum())
        upto = np.searchsorted(total, total[:n] + limits.max_tokens, side="right") - 1
        return frame, np.minimum(np.minimum(upto, np.arange(n) + reach), len(frame)), n

    def exits(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame, after, n = following(frame)
        out, seen = [], {}
        for entry in range(min(reach, n)):
            at, starts, path = entry, 0, []
            while at < n and at not in seen:
                path.append(at)
                at = int(after[at])
            end, starts = seen[at] if at < n else (at - n, 0)
            for place in reversed(path):
                starts += 1
                seen[place] = (end, starts)
            out.append((key[0], key[1], entry, *seen[entry]))
        return pd.DataFrame(out, columns=["appid", "_k", "entry", "leaves", "starts"])

    def entries(frame: pd.DataFrame) -> pd.DataFrame:
        known = {(k, e): (leaves, starts) for k, e, leaves, starts in zip(frame["_k"], frame["entry"], frame["leaves"], frame["starts"], strict=True)}
        out, at, batch = [], 0, 0
        for k in sorted(set(frame["_k"])):
            out.append((frame["appid"].iloc[0], k, at, batch))
            if (k, at) not in known:  # the last batch takes all there is
                break
            at, starts = known[k, at]
            batch += starts
        return pd.DataFrame(out, columns=["appid", "_k", "entry", "first"])

    found = blocks.groupBy("appid", "_k").applyInPandas(exits, "appid long, _k long, entry long, leaves long, starts long")
    entered = found.groupBy("appid").applyInPandas(entries, "appid long, _k long, entry long, first long")  # max_items rows a block

    def mark(key, frame: pd.DataFrame, where: pd.DataFrame) -> pd.DataFrame:
        frame, after, n = following(frame)
        start = np.zeros(n, np.int64)
        entry, first = (int(where["entry"].iloc[0]), int(where["first"].iloc[0])) if len(where) else (n, 0)
        at = entry
        while at < n:
            start[at] = 1
            at = int(after[at])
        own = frame.iloc[:n]
        return pd.DataFrame({"appid": own["appid"], "recommendationid": own["recommendationid"], "tokens": own["tokens"], "batch": np.cumsum(start) - 1 + first})

    marked = blocks.groupBy("appid", "_k").cogroup(entered.groupBy("appid", "_k")).applyInPandas(mark, "appid long, recommendationid string, tokens long, batch long")
    return marked.unionByName(items.filter(~fits).select("appid", "recommendationid", "tokens", F.lit(None).cast("long").alias("batch")))


def admitted(batches: DataFrame, limits: BatchLimits, token_ceiling: int, slice_batches: int = 10_000) -> DataFrame:
    """Batches in order (app, batch) until estimate and output allowance would pass the ceiling (0: no ceiling).

    batches: appid, batch, tokens. Running sums go by slices of an app; only the slices' sums are added up in one task.
    """
    cost = F.col("tokens") + limits.max_output_tokens
    batches = batches.withColumn("_slice", F.floor(F.col("batch") / slice_batches).cast("long"))
    groups = batches.groupBy("appid", "_slice").agg(F.sum(cost).alias("_all"))
    before = Window.orderBy("appid", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("appid", "_slice", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    running = F.col("_before") + F.sum(cost).over(Window.partitionBy("appid", "_slice").orderBy("batch"))
    batches = batches.join(groups, ["appid", "_slice"])
    return batches.withColumn("running", running).drop("_before", "_slice").withColumn("admitted", F.lit(token_ceiling == 0) | (F.col("running") <= token_ceiling))
