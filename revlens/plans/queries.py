"""Registered queries over the given tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BatchLimits, EvidenceLimits, Selection
from ..functions import text as X
from ..operators import classify, evaluation, evidence, metrics, publish, selection, state
from ..sources import readers
from . import fixtures
from . import reviews as R

KEYS = ["appid", "recommendationid"]


def eligibility_decisions(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.spread(R.edge_reviews(spark, sf), ["doc_id"])
    return X.with_eligibility(rows, "review_text", R.corpus_size(rows), R.POLICY).select("doc_id", "source", "decision")


def eligibility_summary(spark, sf):
    return eligibility_decisions(spark, sf).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


def eligibility_current_view(spark, sf):
    """Two policies decided each review; only the latest decision per review counts, history stays."""
    rows = R.reviews(spark, sf)
    old = rows.select(*KEYS, F.lit("old").alias("policy"), F.lit("eligible").alias("decision"), F.lit(1).cast("long").alias("decided_at"))
    new = R.decisions(rows).select(*KEYS, F.lit("new").alias("policy"), "decision", F.lit(2).cast("long").alias("decided_at"))
    view = state.latest(old.unionByName(new), KEYS, F.desc("decided_at"))
    return view.groupBy("policy", "decision").agg(F.count(F.lit(1)).alias("n"))


def eligibility_transitions(spark, sf):
    """Every review was decided under an old policy; a new one then decided the even ids, and the old one again those
    divisible by four."""
    rows = R.table(spark, sf, "documents").select("doc_id")

    def log(ids, policy, at):
        return ids.select("doc_id", F.lit(policy).alias("policy_hash"), F.lit("eligible").alias("decision"), F.lit(at).alias("decided_at"))

    first = log(rows, "old", "t1").withColumn("obsolete_at", F.lit(None).cast("string"))
    second = state.decided(first, log(rows.filter("doc_id % 2 = 0"), "new", "t2"), ["doc_id"])
    return state.decided(second, log(rows.filter("doc_id % 4 = 0"), "old", "t3"), ["doc_id"])


def review_filter_range(spark, sf):
    r = state.query_reviews(R.reviews(spark, sf), project_id=R.PROJECT, language="en", voted_up=True, created_after=1_699_999_950, created_before=1_700_000_600, playtime_min=100, playtime_max=1000)
    return r.select("appid", "recommendationid", "timestamp_created", "playtime_at_review")


def review_order(spark, sf):
    """The reviews of two apps in their listed order, by place."""
    r = state.query_reviews(R.reviews(spark, sf), project_id=R.PROJECT, appids=[1, 2])
    place = F.row_number().over(Window.partitionBy("appid").orderBy(*state.REVIEW_ORDER))
    return r.select("appid", "recommendationid", place.alias("place"))


def language_polarity_counts(spark, sf):
    return R.reviews(spark, sf).groupBy("language", "voted_up").agg(F.count(F.lit(1)).alias("n"))


def _incoming(stored: DataFrame) -> DataFrame:
    """The next crawl: every third text edited, ids shifted for every seventh (those are new)."""
    edited = F.when(F.col("doc_id") % 3 == 0, F.sha2(F.concat("review_text", F.lit("!")), 256)).otherwise(F.col("source_hash"))
    key = F.when(F.col("doc_id") % 7 == 0, F.concat("recommendationid", F.lit("-n"))).otherwise(F.col("recommendationid"))
    return stored.select("appid", key.alias("recommendationid"), edited.alias("source_hash"), "timestamp_updated", "doc_id")


def upsert_change_kinds(spark, sf):
    stored = R.reviews(spark, sf)
    return state.upsert_kinds(stored, _incoming(stored), KEYS).select("appid", "recommendationid", "kind")


def upsert_counts(spark, sf):
    return upsert_change_kinds(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def upsert_merged(spark, sf):
    stored = R.reviews(spark, sf)
    table = stored.select(*KEYS, "source_hash", F.lit("t0").alias("first_seen_at"))
    new = _incoming(stored).select(*KEYS, "source_hash", F.lit("t1").alias("first_seen_at"))
    return state.merged(table, new, KEYS)


def stream_high_water(spark, sf):
    """High water per user and event type over the event stream."""
    ev = R.table(spark, sf, "events").select("user_id", "event_type", F.unix_timestamp("ts").alias("timestamp_updated"))
    return state.high_water(ev, ["user_id", "event_type"])


def overlap_fully_known(spark, sf):
    stored = R.reviews(spark, sf)
    pages = _incoming(stored).withColumn("page_id", F.floor(F.col("doc_id") / 2).cast("long"))
    return state.fully_known_pages(pages, stored, KEYS, F.lit(1_700_100_000), 86_400)


def reconcile_competitors(spark, sf):
    """Configured apps: those of customers' nations; stored: supplier keys, of which the even are active."""
    configured = R.table(spark, sf, "customer").select((F.col("c_nationkey").cast("long")).alias("appid")).distinct()
    stored = R.table(spark, sf, "supplier").select((F.col("s_suppkey") + 10).alias("appid"), (F.col("s_suppkey") % 2 == 0).alias("active"))
    return state.reconcile(configured, stored)


def latest_classification(spark, sf):
    rows = classify.latest_success(R.classifications(R.reviews(spark, sf)))
    return rows.select(*KEYS, "run_id", "updated_at", F.col("result.engagement_posture").alias("posture"))


def unclassified_anti_join(spark, sf):
    rows = R.reviews(spark, sf)
    return classify.unclassified(rows, R.classifications(rows), ["source_hash"]).select(*KEYS)


def classified_flag(spark, sf):
    rows = R.reviews(spark, sf)
    return classify.classified_flag(rows, R.classifications(rows)).select(*KEYS, "classified")


def aspects_explode(spark, sf):
    return classify.aspects(R.current(spark, sf)).select(*KEYS, "run_id", "taxonomy_id", "sentiment", "confidence", "evidence")


def _picked(values, index: Column, word: Column) -> Column:
    """One of the fixture texts by turns, with the word put in."""
    return F.replace(F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1), F.lit("@@"), word)


def stage1_validation_errors(spark, sf):
    """Results broken in every way, against each review's text, and the code that each gets."""
    rows = R.reviews(spark, sf)
    result = _picked(fixtures.RESULTS, F.col("doc_id"), F.regexp_extract("review_text", "[A-Za-z]+", 0))
    error = classify.validation_error(result, F.col("review_text"), [f"core.c{i}" for i in range(12)])
    return rows.select(*KEYS, F.coalesce(error, F.lit("ok")).alias("error"))


def stage1_batch_errors(spark, sf):
    """Batches of five reviews: some answers are missing, doubled, or for ids that nobody asked for."""
    docs = R.table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 5).cast("long").alias("batch"), "text")
    asked = docs.select("batch", F.col("doc_id").cast("string").alias("input_id"), F.col("text").alias("review_text"))
    times = F.when(F.col("doc_id") % 13 == 0, 0).when(F.col("doc_id") % 17 == 0, 2).otherwise(1)
    answers = docs.filter(times > 0).withColumn("n", F.explode(F.sequence(F.lit(1), times)))
    ident = F.when(F.col("doc_id") % 19 == 0, F.lit("other")).otherwise(F.col("doc_id").cast("string"))
    result = F.replace(F.replace(F.lit(json.dumps(fixtures.RESULT | {"aspects": []})), F.lit('"input_id": "id"'), F.concat(F.lit('"input_id": "'), ident, F.lit('"'))), F.lit("@@"), F.lit(""))
    answers = answers.select("batch", (F.col("doc_id") * 2 + F.col("n")).alias("position"), result.alias("result_json"))
    return classify.batch_errors(answers, asked, ["core.c1"]).select("batch", F.coalesce("error", F.lit("ok")).alias("error"))


def _metric(family):
    def run(spark, sf):
        now = R.current(spark, sf)
        out = metrics.aspect_rate(now) if family is metrics.aspect_rate else metrics.fixed_metrics(now, families=(family,))
        return out.select("metric_name", "dimensions_json", "numerator", "denominator", "value")

    return run


def metric_all_ids(spark, sf):
    return metrics.all_metrics(R.current(spark, sf)).select("metric_id", "numerator", "denominator")


def lineage_values(spark, sf):
    return metrics.lineage_values(R.current(spark, sf))


def coverage_summary(spark, sf):
    return metrics.coverage(R.project(spark, sf).decisions.filter("decision = 'eligible'"), R.current(spark, sf))


def lineage_sets(spark, sf):
    return metrics.lineage(R.current(spark, sf))


def evidence_candidates(spark, sf):
    rows = evidence.candidates(R.current(spark, sf), R.PROJECT).distinct()
    return rows.select(*KEYS, "taxonomy_id", "evidence", "direction", "selection_id")


def evidence_scores(spark, sf):
    rows = evidence.candidates(R.current(spark, sf), R.PROJECT).distinct()
    return rows.select("selection_id", F.round("score", 12).alias("score"))


def evidence_selected(spark, sf):
    return evidence.select(evidence.candidates(R.current(spark, sf), R.PROJECT), EvidenceLimits()).select(*KEYS, "language", "evidence", "selection_id")


def stable_score(spark, sf):
    return R.reviews(spark, sf).select(*KEYS, selection.stable_score(7, R.PROJECT).alias("score"))


def strata_sizes(spark, sf):
    return selection.with_strata(R.reviews(spark, sf)).groupBy(*selection.STRATUM).agg(F.count(F.lit(1)).alias("n"))


def stratified_sample(spark, sf):
    return selection.select_inputs(R.reviews(spark, sf), Selection("stratified", 7), R.PROJECT).select(*KEYS, "sampling_weight")


def progressive_scope(spark, sf):
    return selection.select_inputs(R.reviews(spark, sf), Selection("progressive", 7, full_corpus_threshold=500), R.PROJECT).groupBy("language").agg(F.count(F.lit(1)).alias("n"))


def token_estimates(spark, sf):
    return selection.estimated(R.reviews(spark, sf)).select(*KEYS, "tokens")


LIMITS = BatchLimits(max_tokens=40_000)


def batch_plan(spark, sf):
    return selection.plan_batches(selection.estimated(R.reviews(spark, sf)), LIMITS).select(*KEYS, "tokens", "batch")


def ceiling_admission(spark, sf):
    plan = selection.plan_batches(selection.estimated(R.reviews(spark, sf)), LIMITS)
    sums = plan.groupBy("appid", "batch").agg(F.sum("tokens").alias("tokens"))
    return selection.admitted(sums, LIMITS, 400_000).select("appid", "batch", "tokens", "running", "admitted")


def _pairs(spark, sf):
    """Labels against a rule's guess: aspect sets, sentiment and posture."""
    d = R.table(spark, sf, "labels").join(R.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    gold = F.when(F.col("quality") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("c")))
    pred = F.when(F.col("n_chars") % 2 == 0, F.array(F.lit("a"), F.lit("c"))).otherwise(F.array(F.lit("b")))
    return d.select("doc_id", gold.alias("gold"), pred.alias("pred"), F.col("quality").alias("truth"), (F.col("n_chars") % 2).cast("int").alias("guess"), "toxic")


def eval_precision_recall(spark, sf):
    return evaluation.precision_recall(_pairs(spark, sf))


def eval_accuracy(spark, sf):
    return evaluation.accuracy(_pairs(spark, sf), {"quality_accuracy": ("truth", "guess"), "toxic_accuracy": ("toxic", "guess")})


def eval_omission(spark, sf):
    return evaluation.omission(R.table(spark, sf, "documents"), R.table(spark, sf, "labels"), "doc_id")


def eval_contamination(spark, sf):
    """Answers: turns of the conversations; asked: those of even conversations."""
    turns = R.table(spark, sf, "conversations").select(F.col("conv_id").alias("batch"), (F.floor(F.col("turn") / 2)).cast("long").alias("id"))
    return evaluation.contamination(turns, turns.filter("batch % 2 = 0"), "id")


def page_title_meta(spark, sf):
    return readers.store_pages(R.table(spark, sf, "pages")).select("page_id", "title", "heading", "advert")


def page_clean_text(spark, sf):
    return R.table(spark, sf, "pages").select("page_id", X.clean_html(F.col("html")).alias("clean"))


def store_warnings(spark, sf):
    return readers.store_pages(R.table(spark, sf, "pages")).groupBy("warnings").agg(F.count(F.lit(1)).alias("n"))


def store_snapshots(spark, sf):
    """Pages with details by turns, invalid and missing ones among them, and with what a store page's HTML has."""
    k, ident = F.col("page_id"), F.col("page_id").cast("string")
    pages = R.table(spark, sf, "pages").select("page_id", F.concat(_picked(fixtures.SNIPPETS, F.floor(k / 4).cast("long"), ident), F.lit("<p>rest</p>")).alias("html"), _picked(fixtures.DETAILS, k, ident).alias("details"))
    found = readers.store_snapshots(pages)
    shown = ["page_id", "title", "description_short", "caption_image_url", "review_count", "review_summary", "release_raw", "release_date", "description"]
    lists = [F.array_join(c, "|").alias(c) for c in ("developers", "publishers", "tags", "languages", "platforms", "warnings")]
    origin = F.array_join(F.array_sort(F.transform(F.map_entries("provenance"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "|").alias("provenance")
    return found.select(*shown, *lists, F.size("screenshots").alias("screenshots"), "price.display", "price.final", "price.currency", origin)


def app_details_gate(spark, sf):
    """Details of the apps whose answer says that it was a success."""
    ident = F.col("page_id").cast("string")
    ok = F.when(F.col("page_id") % 3 == 0, "true").when(F.col("page_id") % 3 == 1, "false").otherwise('"true"')
    envelope = F.concat(F.lit('{"'), ident, F.lit('": {"success": '), ok, F.lit(', "data": {"name": "N'), ident, F.lit('"}}}'))
    details = readers.app_details(envelope, F.col("page_id") + F.when(F.col("page_id") % 5 == 0, 1).otherwise(0))
    return R.table(spark, sf, "pages").select("page_id", F.get_json_object(details, "$.name").alias("name"))


def _pages(spark, sf):
    return R.table(spark, sf, "documents").select("doc_id", _picked(fixtures.PAGES, F.col("doc_id"), F.col("doc_id").cast("string")).alias("raw"))


def review_page_errors(spark, sf):
    return _pages(spark, sf).select("doc_id", F.coalesce(readers.page_error(F.col("raw")), F.lit("ok")).alias("error"))


def review_page_items(spark, sf):
    rows = readers.page_reviews(_pages(spark, sf), R.PROJECT, F.col("doc_id"))
    return rows.select("appid", "recommendationid", "review_text", "votes_up", "refunded", "timestamp_updated", "source_hash")


def app_ids(spark, sf):
    return R.table(spark, sf, "customer").select("c_custkey", X.app_id(_picked(fixtures.ADDRESSES, F.col("c_custkey"), F.lit(""))).alias("appid"))


def utc_times(spark, sf):
    return R.table(spark, sf, "customer").select("c_custkey", X.utc(_picked(fixtures.TIMES, F.col("c_custkey"), F.lit(""))).alias("utc"))


def json_validity(spark, sf):
    return R.table(spark, sf, "customer").select("c_custkey", X.json_valid(_picked(fixtures.JSONS, F.col("c_custkey"), F.lit(""))).alias("valid"))


def prompt_estimates(spark, sf):
    return R.table(spark, sf, "conversations").select("conv_id", "turn", X.floor_estimate(F.col("text"), 4096).alias("tokens"))


def release_date_normalize(spark, sf):
    o = R.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = F.element_at(F.array(*[F.lit(x) for x in fixtures.DATES]), (F.floor(k / 13) % len(fixtures.DATES)).cast("int") + 1)
    month = F.element_at(F.array(*[F.lit(x) for x in fixtures.MONTHS]), (k % 13).cast("int") + 1)
    for name, value in (("{d}", F.dayofmonth("o_orderdate").cast("string")), ("{m}", month), ("{y}", F.year("o_orderdate").cast("string"))):
        text = F.replace(text, F.lit(name), value)
    return o.select("o_orderkey", X.release_date(text).alias("released"))


def http_error_classes(spark, sf):
    status = (F.col("event_id") % 500 + 150).cast("int")
    code = X.http_error(status)
    return R.table(spark, sf, "events").select(code.alias("code"), X.retryable(code).alias("retryable")).groupBy("code", "retryable").agg(F.count(F.lit(1)).alias("n"))


def redaction(spark, sf):
    return R.table(spark, sf, "documents").select("doc_id", F.sha2(X.redact(F.col("text")), 256).alias("redacted_sha256"))


def geography_flags(spark, sf):
    return R.table(spark, sf, "conversations").select("conv_id", "turn", X.claims_geography(F.concat("text", F.when(F.col("turn") % 3 == 0, F.lit(" in France.")).otherwise(F.lit("")))).alias("flag"))


def diagnostics_stored(spark, sf):
    """Messages with credentials in them, redacted and cut."""
    raw = R.table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("stage "), "role").alias("stage"), F.when(F.col("turn") % 2 == 0, "").otherwise("api_key: abc").alias("error_classification"), F.concat(F.lit("hunter2 https://me:pw@host/ Bearer abc.def "), "text").alias("message"))
    return state.diagnostic_rows(raw, ("hunter2",))


def json_redaction(spark, sf):
    """Nested values and whole values under secret keys."""
    doc = F.to_json(F.struct(F.col("text").alias("note"), F.struct(F.lit("x1").alias("api_key"), F.lit("token=abc").alias("say")).alias("deep"), F.array(F.lit("password: abc"), F.lit("fine")).alias("list")))
    rows = R.table(spark, sf, "conversations").select("conv_id", "turn", X.redact_json(doc).alias("j"))
    return rows.select("conv_id", "turn", *[F.get_json_object("j", p).alias(n) for p, n in (("$.note", "note"), ("$.deep.api_key", "secret"), ("$.deep.say", "say"), ("$.list[0]", "first"), ("$.list[1]", "second"))])


def manifest_keys(spark, sf):
    """Manifests lose what stands under keys that name credentials."""
    doc = F.concat(F.lit('{"user": '), F.col("user_id").cast("string"), F.lit(', "Token": 1, "deep": [{"apiKey": 2, "kept": "'), "event_type", F.lit('"}], "my_password": {"x": 1}}'))
    return R.table(spark, sf, "events").select("event_id", X.without_secret_keys(doc).alias("manifest"))


def status_view(spark, sf):
    """Runs: customers; units: their orders; diagnostics: the events of that number."""
    runs = R.table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("status"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("token=abc failed "), "c_name")).alias("error_summary"))
    status = F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed")
    units = R.table(spark, sf, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").cast("string").alias("unit_key"), status.alias("status"), F.lit(1).alias("attempt"), F.col("o_orderkey").alias("position"))
    notes = R.table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("sequence"), F.concat_ws(" ", F.col("event_id").cast("string"), "event_type").alias("message"))
    view = state.status_view(runs, units, notes, last=3)
    listed = F.array_join(F.transform("unit_list", lambda u: F.concat_ws(":", u["unit_key"], u["status"])), "|").alias("unit_list")
    return view.select("run_id", "status", "error_summary", "units", "failed_units", listed, F.array_join("diagnostics", "|").alias("diagnostics"))


def latest_completed_runs(spark, sf):
    """The last completed run per project (orders of a customer)."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running")
    runs = R.table(spark, sf, "orders").select(F.col("o_custkey").alias("project_id"), F.col("o_orderkey").alias("run_id"), status.alias("status"), F.col("o_orderdate").alias("created_at"))
    return state.latest_completed(runs, ["project_id"]).select("project_id", "run_id")


def snapshot_history(spark, sf):
    """Snapshots of an app (a part), newest first, and where the content (the supplier's parity) changed."""
    rows = R.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("appid"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("snapshot_id"), F.col("l_shipdate").alias("fetched_at"), (F.col("l_suppkey") % 2).alias("source_hash"), "l_quantity")
    rows = rows.groupBy("appid", "snapshot_id").agg(F.max("fetched_at").alias("fetched_at"), F.max("source_hash").alias("source_hash"))
    return state.snapshot_order(rows, ["appid"]).select("appid", "snapshot_id", "place", "changed")


def export_reviews(spark, sf):
    d = R.project(spark, sf).decisions.select(*KEYS, F.col("decision").alias("eligibility_decision"), F.col("policy_hash").alias("eligibility_policy_hash"))
    return publish.shaped(R.reviews(spark, sf).join(d, KEYS, "left"), "reviews")


def export_classifications(spark, sf):
    """The current view: eligible reviews with their latest success for the same text."""
    return publish.classification_rows(R.current(spark, sf), R.PROJECT).select("project_id", *KEYS, "source_hash", "run_id", "overall_sentiment", "engagement_posture", "actionable", "self_reported_abandonment")


def export_aspects(spark, sf):
    return publish.aspect_rows(R.current(spark, sf), R.PROJECT)


def export_aggregates(spark, sf):
    now, eligible = R.current(spark, sf), R.project(spark, sf).decisions.filter("decision = 'eligible'")
    every = metrics.stored(metrics.all_metrics(now), "run-a", R.corpus_size(eligible), R.corpus_size(now))
    return publish.shaped(every, "aggregates")


def export_quotes(spark, sf):
    now = R.current(spark, sf)
    return publish.quote_rows(evidence.select(evidence.candidates(now, R.PROJECT), EvidenceLimits()), R.PROJECT, "run-a").drop("score")


def metric_reference_errors(spark, sf):
    """Metric references with one thing wrong by turns."""
    k = F.col("doc_id")
    rows = R.table(spark, sf, "documents").select(
        k,
        F.when(k % 7 == 0, "").otherwise("m").alias("metric_id"),
        F.lit("rate").alias("metric_name"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise("reviews").alias("population_definition"),
        (k % 5 - 1).alias("numerator"),
        (k % 4).alias("denominator"),
        F.when(k % 3 != 0, (k % 13) / 10).alias("value"),
        F.create_map(F.when(k % 17 == 0, "Region").otherwise("language"), F.lit("x")).alias("dimensions"),
    )
    return rows.select("doc_id", F.coalesce(publish.metric_error(), F.lit("ok")).alias("error"))


def recommendation_errors(spark, sf):
    """Recommendations with one thing wrong by turns."""
    k = F.col("doc_id")

    def level(m: int, r: int) -> Column:
        return F.when(k % m == r, "huge").otherwise("low")

    rows = R.table(spark, sf, "documents").select(
        "doc_id", (k % 9).alias("rank"), F.when(k % 10 == 3, "").otherwise("title").alias("title"), F.when(k % 11 == 4, "sell in Japan now").otherwise("act").alias("action"), level(12, 5).alias("impact"), F.when(k % 2 == 0, "unknown").otherwise(level(13, 6)).alias("effort"),
        F.lit("test").alias("validation_step"), F.when(k % 14 == 7, F.lit(None).cast("string")).otherwise("high").alias("confidence"), F.array(F.lit("m1"), F.when(k % 15 == 8, "m9").otherwise("m2")).alias("evidence_metric_ids"), F.array(F.when(k % 16 == 9, "r9").otherwise("r1")).alias("evidence_review_ids"),
    )
    known = [F.array(*[F.lit(x) for x in names]) for names in (("m1", "m2"), ("r1",))]
    return rows.select("doc_id", F.coalesce(publish.recommendation_error(*known), F.lit("ok")).alias("error"))


def brief_errors(spark, sf):
    """Briefs with lists of different lengths."""
    k = F.col("doc_id")

    def some(n: Column, text: str = "x") -> Column:
        return F.array_repeat(F.lit(text), n.cast("int"))

    status = F.when(k % 7 == 0, "done").when(k % 7 == 1, "insufficient_evidence").otherwise("complete")
    rows = R.table(spark, sf, "documents").select("doc_id", status.alias("status"), some(k % 10).alias("findings"), some(k % 12).alias("priorities"), F.when(k % 13 == 0, some(k % 3, "Europe buys")).otherwise(some(k % 11)).alias("risks"), some(k % 9).alias("vulnerabilities"), some(k % 2).alias("caveats"))
    return rows.select("doc_id", F.coalesce(publish.brief_error(), F.lit("ok")).alias("error"))


def payload_top_metrics(spark, sf):
    return publish.payload_metrics(metrics.all_metrics(R.current(spark, sf))).select("metric_id", "metric_name", "numerator", "denominator")


def reference_integrity(spark, sf):
    """Orders whose customer does not exist, after every tenth customer is taken away."""
    customers = R.table(spark, sf, "customer").filter("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("custkey"))
    orders = R.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    return publish.dangling(orders, customers, "custkey").select("o_orderkey", "custkey")


def report_word_count(spark, sf):
    return R.table(spark, sf, "benchmark").select("item_id", X.word_count(F.col("text")).cast("long").alias("words"))


def priority_order(spark, sf):
    """Per order, its parts by quantity, largest first, as one list."""
    li = R.table(spark, sf, "lineitem")
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("l_quantity")).alias("q"), F.col("l_linenumber").alias("k"))))
    return li.groupBy("l_orderkey").agg(F.array_join(F.transform(ranked, lambda x: x["k"].cast("string")), ",").alias("priorities"))


QUERIES = {
    f.__name__: f
    for f in (
        eligibility_decisions, eligibility_summary, eligibility_current_view, review_filter_range, language_polarity_counts, upsert_change_kinds, upsert_counts,
        upsert_merged, stream_high_water, overlap_fully_known, reconcile_competitors, latest_classification, unclassified_anti_join, classified_flag, aspects_explode,
        stage1_validation_errors, metric_all_ids, coverage_summary, lineage_sets, evidence_candidates, evidence_scores, evidence_selected, stable_score, strata_sizes,
        stratified_sample, progressive_scope, token_estimates, batch_plan, ceiling_admission, eval_precision_recall, eval_accuracy, eval_omission, eval_contamination,
        page_title_meta, page_clean_text, store_warnings, release_date_normalize, http_error_classes, redaction, geography_flags, export_reviews,
        export_classifications, payload_top_metrics, reference_integrity, report_word_count, priority_order,
        eligibility_transitions, review_order, stage1_batch_errors, lineage_values, store_snapshots, app_details_gate, review_page_errors, review_page_items, app_ids, utc_times, json_validity,
        prompt_estimates, diagnostics_stored, json_redaction, manifest_keys, status_view, latest_completed_runs, snapshot_history, export_aspects, export_aggregates, export_quotes,
        metric_reference_errors, recommendation_errors, brief_errors,
    )
}
for _f in (*metrics.FIXED, metrics.aspect_rate):
    QUERIES[f"metric_{_f.__name__}"] = _metric(_f)
