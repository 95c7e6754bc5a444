"""Explicit schemas; nothing in the engine infers one."""

from __future__ import annotations

SCHEMA_VERSION = "parquet-v1"
KEY = ("project_id", "appid", "recommendationid")

#: Nested classification result, as stored in ``result_json``.
RESULT = (
    "input_id string, review_id string, is_actionable boolean, engagement_posture string, overall_sentiment string, sentiment_intensity int, "
    "aspects array<struct<taxonomy_id:string,sentiment:string,intensity:int,evidence:string,feature_request:string,confidence:double>>, "
    "use_cases array<string>, self_reported_abandonment struct<mentioned:boolean,statement_type:string,evidence:string,verified:boolean>, summary string"
)
REVIEW_PAGE = (
    "success int, cursor string, reviews array<struct<recommendationid:string,language:string,review:string,voted_up:boolean,votes_up:bigint,votes_funny:bigint,"
    "timestamp_created:bigint,timestamp_updated:bigint,steam_purchase:boolean,received_for_free:boolean,refunded:boolean,written_during_early_access:boolean>>"
)
FIXTURE = "apps array<struct<appid:bigint,name:string,reviews:array<struct<recommendationid:string,language:string,review:string,voted_up:boolean,votes_up:bigint,timestamp_created:bigint,timestamp_updated:bigint>>>>"
GOLD = (
    "version string, provenance string, records array<struct<input_id:string,review_id:string,language:string,voted_up:boolean,playtime_at_review:bigint,review_text:string,"
    "eligible:boolean,annotation:struct<actionable:boolean,overall_sentiment:string,engagement_posture:string,aspects:array<string>,eligibility_reason:string>>>"
)

#: Public columns of the exported datasets (fixed values).
EXPORTS = {
    "reviews": "project_id string, appid bigint, recommendationid string, language string, voted_up boolean, votes_up bigint, votes_funny bigint, weighted_vote_score double, comment_count bigint, steam_purchase boolean, received_for_free boolean, refunded boolean, written_during_early_access boolean, primarily_steam_deck boolean, playtime_at_review bigint, playtime_forever bigint, playtime_last_two_weeks bigint, last_played bigint, timestamp_created bigint, timestamp_updated bigint, review_text string, source_review_type string, source_hash string, eligibility_decision string, eligibility_policy_hash string",
    "classifications": "project_id string, appid bigint, recommendationid string, source_hash string, run_id string, prompt_version string, taxonomy_version string, schema_version string, model_policy string, overall_sentiment string, engagement_posture string, actionable boolean, self_reported_abandonment boolean",
    "aspects": "project_id string, appid bigint, recommendationid string, source_hash string, run_id string, taxonomy_id string, sentiment string, confidence double, evidence string",
    "aggregates": "run_id string, metric_id string, metric_name string, dimensions_json string, numerator bigint, denominator bigint, value double, population_definition string, coverage_json string, caveats_json string",
    "quotes": "run_id string, selection_id string, project_id string, appid bigint, recommendationid string, taxonomy_id string, evidence string, selection_reason string, score double, direction string, language string, source_hash string",
}
EXPORT_ORDER = {
    "reviews": ("appid", "recommendationid"),
    "classifications": ("appid", "recommendationid"),
    "aspects": ("appid", "recommendationid", "taxonomy_id"),
    "aggregates": ("run_id", "metric_id"),
    "quotes": ("run_id", "selection_id"),
}


def columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(", ")]
