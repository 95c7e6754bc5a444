"""What was current at a time: validity intervals of logged decisions, and joins to the last log row at or before a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a key, of both sides, that one task puts in order.
MANY = 100_000


def intervals(log: DataFrame, keys: list[str], at: str, ties: list[str] | None = None) -> DataFrame:
    """The log with ``valid_from`` and ``valid_to`` (null: still valid): a row is valid until the key's next row, in order of
    time and ``ties``. Of rows of equal time all but the last are valid for no time."""
    order = Window.partitionBy(*keys).orderBy(at, *(ties or []))
    return log.withColumn("valid_from", F.col(at)).withColumn("valid_to", F.lead(at).over(order))


def as_of(asked: DataFrame, log: DataFrame, keys: list[str], asked_at: str, log_at: str, columns: list[str], *, width: float, ties: list[str] | None = None) -> DataFrame:
    """``asked`` with the log's ``columns`` of the key's last row at or before ``asked_at`` (null if there is none).

    A key's rows meet in the order of time. Of keys with more than ``MANY`` rows, and of null keys, times are cut into buckets of
    ``width`` and rows meet within (keys, bucket), so such a key is spread over its buckets. What an earlier bucket leaves to a
    later one is its last row; only these, one a key and bucket, are followed through such a key's time. Rows with a null key or
    time, on either side, match nothing. Of log rows of equal time the last by ``ties`` counts.
    """
    names = [f"_l{k}" for k in range(len(columns))]
    value = F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    large = log.select(*keys).unionByName(asked.select(*keys)).groupBy(*keys).count().filter(F.col("count") > MANY).select(*keys, F.lit(True).alias("_large"))

    def dealt(df: DataFrame, at: str) -> DataFrame:
        bucket = F.floor(F.col(at) / width).cast("long")
        return df.join(F.broadcast(large), keys, "left").withColumn("_b", F.when(null_key | F.col("_large"), bucket).otherwise(F.lit(0)))  # at most a MANY-th of the rows

    after = F.struct(*[F.col(c).alias(f"t{k}") for k, c in enumerate(ties or [])], F.lit(0).alias("end"))
    whole = F.col(log_at).isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    rows = dealt(log.filter(whole), log_at).select(*keys, "_large", "_b", F.col(log_at).alias("_at"), after.alias("_tie"), value.alias("_value"))
    asks = dealt(asked, asked_at).withColumn("_ask", F.struct(*[F.col(c) for c in asked.columns]))

    last = rows.filter("_large").groupBy(*keys, "_b").agg(F.max_by("_value", F.struct("_at", "_tie")).alias("_last"))
    wanted = asks.filter("_large").select(*keys, "_b").distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType))
    places = last.unionByName(wanted).groupBy(*keys, "_b").agg(F.max_by("_last", F.col("_last").isNotNull()).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.select(*keys, "_b", F.last("_last", ignorenulls=True).over(earlier).alias("_value")).filter("_value is not null")

    def part(df: DataFrame, kind: int, at: Column, tie: Column, found: Column, ask: Column) -> DataFrame:
        return df.select(*keys, "_b", F.lit(kind).alias("_kind"), at.cast(log.schema[log_at].dataType).alias("_at"), tie.alias("_tie"), found.alias("_value"), ask.alias("_ask"))

    def nothing(like: DataFrame, name: str) -> Column:
        return F.lit(None).cast(like.schema[name].dataType)

    stream = part(carried, 0, F.lit(None), nothing(rows, "_tie"), F.col("_value"), nothing(asks, "_ask"))
    stream = stream.unionByName(part(rows, 1, F.col("_at"), F.col("_tie"), F.col("_value"), nothing(asks, "_ask")))
    stream = stream.unionByName(part(asks, 2, F.col(asked_at), nothing(rows, "_tie"), nothing(rows, "_value"), F.col("_ask")))
    upto = Window.partitionBy(*keys, "_b").orderBy(F.asc_nulls_first("_at"), "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("_at").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    found = stream.withColumn("_found", F.last("_value", ignorenulls=True).over(upto)).filter("_kind = 2")
    return found.select("_ask.*", *[F.when(known, F.col(f"_found.{n}")).alias(c) for c, n in zip(columns, names, strict=True)])


def current_at(asked: DataFrame, decisions: DataFrame, successes: DataFrame, review: list[str], identity: list[str], *, at: str, width: float) -> DataFrame:
    """Whether a classification was current at a time: ``asked`` with ``decision``, ``decided_under``, ``run_id`` and ``current``.

    asked: review keys, the whole identity that is asked for (text, policy, prompt, schema, taxonomy, model: whatever columns
    ``identity`` names, ``policy_hash`` among them) and the time. decisions: review keys, policy_hash, decision, decided_at.
    successes: review keys, identity, run_id, finished_at. Current is a success of exactly that identity that was there, for a
    review whose last decision then was that policy's and eligible.
    """
    decided = decisions.withColumnRenamed("policy_hash", "decided_under")
    out = as_of(asked, decided, review, at, "decided_at", ["decision", "decided_under"], width=width, ties=["decided_under"])
    out = as_of(out, successes, [*review, *identity], at, "finished_at", ["run_id"], width=width, ties=["run_id"])
    return out.withColumn("current", F.coalesce((F.col("decision") == "eligible") & (F.col("decided_under") == F.col("policy_hash")) & F.col("run_id").isNotNull(), F.lit(False)))
