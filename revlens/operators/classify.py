"""Classification: the offline rule provider, currency, validation and provider-driven batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..config import ABANDONMENT_TYPES, POSTURES, SENTIMENTS
from ..functions.text import stripped
from .state import latest

KEYS = ["appid", "recommendationid"]


def parsed(rows: DataFrame) -> DataFrame:
    """Adds the typed ``result`` of ``result_json``."""
    return rows.withColumn("result", F.from_json("result_json", schemas.RESULT))


def latest_success(rows: DataFrame) -> DataFrame:
    """One successful classification per review, parsed: the latest by update time, then run."""
    return parsed(latest(rows.filter("status = 'success'"), KEYS, F.desc("updated_at"), F.desc("run_id")))


def current(reviews: DataFrame, decisions: DataFrame, classifications: DataFrame) -> DataFrame:
    """Eligible reviews with their latest success for the same text, and the policy that admitted them. The one current
    view that all readers share."""
    eligible = decisions.filter("decision = 'eligible' and obsolete_at is null").select(*KEYS, "policy_hash")
    labelled = latest_success(classifications).select(*KEYS, "source_hash", "run_id", "result")
    return reviews.join(eligible, KEYS).join(labelled, [*KEYS, "source_hash"])


def unclassified(reviews: DataFrame, classifications: DataFrame, identity: list[str]) -> DataFrame:
    """Reviews without a successful classification of the same identity (text hash, policy, prompt, schema, model...)."""
    done = classifications.filter("status = 'success'").select(*KEYS, *identity).distinct()
    return reviews.join(done, [*KEYS, *identity], "left_anti")


def classified_flag(reviews: DataFrame, classifications: DataFrame) -> DataFrame:
    done = classifications.filter("status = 'success'").select(*KEYS, "source_hash").distinct().withColumn("_done", F.lit(True))
    return reviews.join(done, [*KEYS, "source_hash"], "left").withColumn("classified", F.coalesce("_done", F.lit(False))).drop("_done")


def aspects(current_rows: DataFrame) -> DataFrame:
    """One row per aspect; reviews without aspects have none."""
    return current_rows.withColumn("aspect", F.explode("result.aspects")).select(*[c for c in current_rows.columns if c != "result"], "aspect.*", F.col("result.overall_sentiment").alias("overall_sentiment"))


RESULT_KEYS = ("review_id", "is_actionable", "engagement_posture", "overall_sentiment", "sentiment_intensity", "aspects", "use_cases", "self_reported_abandonment", "summary")
ASPECT_KEYS = ("taxonomy_id", "sentiment", "intensity", "evidence", "feature_request", "confidence")


def _kind(v: Column, path: str) -> Column:
    """Type of what stands at a path: VOID for null, SQL null where there is nothing."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _text(v: Column, path: str) -> Column:
    return F.when(_kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def _outside(v: Column, path: str, least: float, most: float) -> Column:
    """Whether a value is no number (true and false are none) or out of its range."""
    number = _kind(v, path).rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return ~F.coalesce(number & F.try_variant_get(v, path, "double").between(least, most), F.lit(False))


def _missing(v: Column, keys: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | _kind(v, f"$.{key}").isNull()
    return found


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def validation_error(result_json: Column, review_text: Column, taxonomy: list[str]) -> Column:
    """Code of the first rule that a result's JSON text breaks, or null.

    The rules stand in the order in which a result is read: the object, its keys, labels and intensity, then each aspect,
    then the statement of abandonment. ``review_text`` is null for an ``input_id`` that was not asked for.
    """
    v = F.try_parse_json(result_json)
    aspects = F.coalesce(F.try_variant_get(v, "$.aspects", "array<variant>"), F.array().cast("array<variant>"))

    def any_aspect(rule: Callable[[Column], Column]) -> Column:
        return F.exists(aspects, rule)

    def not_in(x: Column, values) -> Column:
        return ~F.coalesce(x.isin(*values), F.lit(False))

    def no_evidence(a: Column) -> Column:
        quote = _text(a, "$.evidence")
        return ~F.coalesce((stripped(quote) != "") & F.contains(review_text, quote), F.lit(False))

    abandonment = F.try_variant_get(v, "$.self_reported_abandonment", "variant")
    return (
        F.when(~_is_object(v), "not_an_object")
        .when(_text(v, "$.input_id").isNull() | review_text.isNull(), "unknown_input")
        .when(_missing(v, RESULT_KEYS), "missing_field")
        .when(not_in(_text(v, "$.engagement_posture"), POSTURES), "posture")
        .when(not_in(_text(v, "$.overall_sentiment"), SENTIMENTS), "sentiment")
        .when(_outside(v, "$.sentiment_intensity", 1, 5), "intensity")
        .when(~F.coalesce(_kind(v, "$.aspects").startswith("ARRAY"), F.lit(False)), "aspects")
        .when(any_aspect(lambda a: ~_is_object(a)), "aspect_not_an_object")
        .when(any_aspect(lambda a: _missing(a, ASPECT_KEYS)), "aspect_missing_field")
        .when(any_aspect(lambda a: not_in(_text(a, "$.taxonomy_id"), taxonomy)), "taxonomy")
        .when(any_aspect(lambda a: not_in(_text(a, "$.sentiment"), SENTIMENTS)), "aspect_sentiment")
        .when(any_aspect(lambda a: _outside(a, "$.intensity", 1, 5)), "aspect_intensity")
        .when(any_aspect(lambda a: _outside(a, "$.confidence", 0, 1)), "confidence")
        .when(any_aspect(no_evidence), "evidence")
        .when(~_is_object(abandonment), "abandonment_not_an_object")
        .when(~F.coalesce((_kind(abandonment, "$.verified") == "BOOLEAN") & ~F.try_variant_get(abandonment, "$.verified", "boolean"), F.lit(False)), "verified")
        .when(~F.coalesce(_kind(abandonment, "$.statement_type") == "VOID", F.lit(True)) & not_in(_text(abandonment, "$.statement_type"), ABANDONMENT_TYPES), "statement_type")
    )


def batch_errors(answers: DataFrame, asked: DataFrame, taxonomy: list[str]) -> DataFrame:
    """One row per asked batch: batch, error (null: every asked id has one valid result and there are no others).

    answers: batch, position, result_json. asked: batch, input_id, review_text. The first broken result of a batch gives
    its code; an id that is answered twice is ``duplicate_input``, one without an answer ``missing_ids``.
    """
    named = answers.withColumn("input_id", F.get_json_object("result_json", "$.input_id"))
    nth = F.row_number().over(Window.partitionBy("batch", "input_id").orderBy("position"))
    rows = named.withColumn("_nth", nth).join(asked.select("batch", "input_id", "review_text"), ["batch", "input_id"], "left")
    code = F.when(F.col("review_text").isNotNull() & (F.col("_nth") > 1), "duplicate_input").otherwise(validation_error(F.col("result_json"), F.col("review_text"), taxonomy))
    judged = rows.withColumn("code", code)
    first = judged.filter("code is not null").groupBy("batch").agg(F.min_by("code", "position").alias("first"))
    answered = judged.filter("review_text is not null").select("batch", "input_id").distinct().withColumn("_there", F.lit(True))
    missing = asked.join(answered, ["batch", "input_id"], "left").groupBy("batch").agg(F.count_if(F.col("_there").isNull()).alias("missing"))
    return missing.join(first, "batch", "left").select("batch", F.coalesce("first", F.when(F.col("missing") > 0, "missing_ids")).alias("error"))


def run_batches(planned: DataFrame, provider: Callable[[list[dict]], list[dict]], *, min_split: int = 1) -> DataFrame:
    """Call a provider per planned batch: batch, input_id, status, result_json.

    An answer that does not cover exactly the asked ids is asked for once more, then the batch is halved down to
    ``min_split`` items and what still fails is quarantined. A provider error fails its items without a repair.
    planned: appid, batch, input_id, payload.
    """
    import json

    def ask(items: list[dict], again: bool = True) -> list[tuple[str, str, str | None]]:
        try:
            answer = provider(items)
        except Exception:  # noqa: BLE001  the provider's own errors end here
            return [(x["input_id"], "failed", None) for x in items]
        got = {a.get("input_id"): a for a in answer if isinstance(a, dict)} if isinstance(answer, list) else {}
        if set(got) == {x["input_id"] for x in items} and len(answer) == len(items):
            return [(k, "success", json.dumps(v, sort_keys=True)) for k, v in got.items()]
        if again:
            return ask(items, False)
        if len(items) // 2 < min_split or len(items) == 1:
            return [(x["input_id"], "quarantined", None) for x in items]
        half = len(items) // 2
        return ask(items[:half]) + ask(items[half:])

    def run(key, frames: Iterator[pd.DataFrame] | pd.DataFrame) -> pd.DataFrame:
        frame = frames.sort_values("input_id")
        out = ask(frame[["input_id", "payload"]].to_dict("records"))
        return pd.DataFrame([(int(key[0]), int(key[1]), *row) for row in out], columns=["appid", "batch", "input_id", "status", "result_json"])

    return planned.groupBy("appid", "batch").applyInPandas(run, "appid long, batch long, input_id string, status string, result_json string")
