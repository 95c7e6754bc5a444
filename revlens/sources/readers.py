"""Readers of pages, fixtures and gold sets, all with explicit schemas."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X


def review_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored page: raw."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw")


#: What every review of a page has to have.
REQUIRED = ("recommendationid", "language", "review", "voted_up", "timestamp_created", "timestamp_updated")
NUMBERS, FLAGS = ("votes_up", "votes_funny"), ("steam_purchase", "received_for_free", "refunded", "written_during_early_access")


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _items(page: Column) -> Column:
    return F.coalesce(F.try_variant_get(page, "$.reviews", "array<variant>"), F.array().cast("array<variant>"))


def page_error(raw: Column) -> Column:
    """Why a page is refused, or null: not successful, no cursor (text) or list of reviews, or an item that is no object,
    lacks a key, or has a number that is none."""
    page = F.try_parse_json(raw)

    def any_item(rule) -> Column:
        return F.exists(_items(page), lambda r: F.coalesce(rule(r), F.lit(True)))

    def lacks(r: Column) -> Column:
        found = F.lit(False)
        for key in REQUIRED:
            found = found | _kind(r, f"$.{key}").isNull()
        return found

    def no_number(r: Column) -> Column:
        found = F.lit(False)
        for key in ("timestamp_created", "timestamp_updated"):
            found = found | F.try_variant_get(r, f"$.{key}", "long").isNull()
        for key in NUMBERS:
            found = found | (_kind(r, f"$.{key}").isNotNull() & F.try_variant_get(r, f"$.{key}", "long").isNull())
        return found

    return (
        F.when(~F.coalesce(F.schema_of_variant(page).startswith("OBJECT"), F.lit(False)), "not_an_object")
        .when(~F.coalesce(F.try_variant_get(page, "$.success", "long") == 1, F.lit(False)), "not_successful")
        .when(~F.coalesce(_kind(page, "$.cursor") == "STRING", F.lit(False)), "cursor")
        .when(~F.coalesce(_kind(page, "$.reviews").startswith("ARRAY"), F.lit(False)), "reviews")
        .when(any_item(lambda r: ~F.schema_of_variant(r).startswith("OBJECT")), "item_not_an_object")
        .when(any_item(lacks), "item_fields")
        .when(any_item(no_number), "item_value")
    )


def page_reviews(pages: DataFrame, project_id: str, appid: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Review rows of the pages that are accepted; counters default to 0, flags to false. ``keep``: the page's columns to keep.

    ``source_hash`` is that of the item as it came, with sorted keys, so a change in any field of it changes the hash.
    """
    items = pages.filter(page_error(F.col("raw")).isNull()).select(*keep, appid.alias("appid"), F.explode(_items(F.try_parse_json("raw"))).alias("r"))

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("r", f"$.{name}", kind)

    texts = [field(c, "string").alias(a) for c, a in (("recommendationid", "recommendationid"), ("language", "language"), ("review", "review_text"))]
    numbers = [F.coalesce(field(c, "long"), F.lit(0)).alias(c) for c in NUMBERS]
    flags = [F.coalesce(field(c, "boolean"), F.lit(False)).alias(c) for c in FLAGS]
    times = [field(c, "long").alias(c) for c in ("timestamp_created", "timestamp_updated")]
    digest = F.sha2(X.ascii_json(F.to_json("r")), 256)
    return items.select(*keep, F.lit(project_id).alias("project_id"), "appid", *texts, F.coalesce(field("voted_up", "boolean"), F.lit(False)).alias("voted_up"), *numbers, *flags, *times, digest.alias("source_hash"))


#: The largest fixture that is read, and the version of gold sets.
FIXTURE_BYTES, GOLD_VERSION = 10_000_000, "stage1-gold-v1"


def local_fixture(path: str) -> str:
    """``path`` if it is a regular file of at most FIXTURE_BYTES, and no link; an error otherwise."""
    if os.path.islink(path) or not os.path.isfile(path):
        raise ValueError("a fixture must be a regular file")
    if os.path.getsize(path) > FIXTURE_BYTES:
        raise ValueError("a fixture must not exceed 10 MB")
    return path


def fixture_error(raw: Column) -> Column:
    """Why a fixture's text is refused, or null: no JSON, no list of apps, an app that is no object or has no whole number as its
    id, or a review that is no object."""
    v = F.try_parse_json(raw)
    apps = F.coalesce(F.try_variant_get(v, "$.apps", "array<variant>"), F.array().cast("array<variant>"))

    def is_object(x: Column) -> Column:
        return F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))

    def reviews(app: Column) -> Column:
        return F.coalesce(F.try_variant_get(app, "$.reviews", "array<variant>"), F.array().cast("array<variant>"))

    return (
        F.when(v.isNull(), "not_json")
        .when(~is_object(v) | ~F.coalesce(_kind(v, "$.apps").startswith("ARRAY"), F.lit(False)), "apps")
        .when(F.exists(apps, lambda a: ~is_object(a) | ~F.coalesce(_kind(a, "$.appid") == "BIGINT", F.lit(False))), "appid")
        .when(F.exists(apps, lambda a: F.exists(reviews(a), lambda r: ~is_object(r))), "review_not_an_object")
    )


def fixture_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Offline fixture: apps with reviews, missing fields filled in by position from 1. A fixture that breaks a rule is an error."""
    found = spark.read.text(local_fixture(path), wholetext=True).select(fixture_error(F.col("value")).alias("error")).first()
    if found is None or found["error"]:
        raise ValueError(f"fixture: {found['error'] if found else 'not_json'}")
    apps = spark.read.schema(schemas.FIXTURE).json(path, multiLine=True).select(F.explode("apps").alias("a"))
    rows = apps.select("a.appid", F.posexplode("a.reviews").alias("i", "r")).withColumn("i", F.col("i") + 1)
    name = F.concat_ws("-", F.col("appid").cast("string"), F.col("i").cast("string"))
    at = F.lit(1_700_000_000) + F.col("i")
    return rows.select("appid", F.coalesce("r.recommendationid", name).alias("recommendationid"), F.coalesce("r.language", F.lit("english")).alias("language"), F.coalesce("r.review", F.lit("Fixture review")).alias("review_text"), F.coalesce("r.voted_up", F.lit(True)).alias("voted_up"), F.coalesce("r.votes_up", F.lit(1)).alias("votes_up"), F.coalesce("r.timestamp_created", at).alias("timestamp_created"), F.coalesce("r.timestamp_updated", at).alias("timestamp_updated"))


def gold_record_error(v: Column) -> Column:
    """Code of the first rule that a gold record (a variant) breaks by itself, or null."""

    def kind_of(path: str) -> Column:
        return F.coalesce(_kind(v, path), F.lit("VOID"))

    def no_text(path: str) -> Column:
        return (kind_of(path) != "STRING") | (F.try_variant_get(v, path, "string") == "")

    aspects = F.coalesce(F.try_variant_get(v, "$.annotation.aspects", "array<variant>"), F.array().cast("array<variant>"))
    out = F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "not_an_object").when(~kind_of("$.annotation").startswith("OBJECT"), "annotation").when(no_text("$.input_id"), "input_id")
    out = out.when(~kind_of("$.annotation.aspects").startswith("ARRAY") | F.exists(aspects, lambda a: F.coalesce(F.schema_of_variant(a) != "STRING", F.lit(True))), "aspects")
    rules = [(no_text, "review_id"), (no_text, "language"), ("BOOLEAN", "voted_up"), ("BIGINT", "playtime_at_review"), (no_text, "review_text"), ("BOOLEAN", "eligible"), ("BOOLEAN", "annotation.actionable"), (no_text, "annotation.overall_sentiment"), (no_text, "annotation.engagement_posture")]
    for rule, name in rules:
        out = out.when(rule(f"$.{name}") if callable(rule) else kind_of(f"$.{name}") != rule, name.split(".")[-1])
    return out


def gold_errors(records: DataFrame) -> DataFrame:
    """set_id, position and error (null: none) of every record of every gold set. records: set_id, position, raw (JSON text).

    An id that an earlier record of the set has is ``duplicate_input``, unless the record breaks an earlier rule; the first place
    of every id comes from one aggregation, so an id however often repeated meets in no task as rows.
    """
    v = F.try_parse_json("raw")
    rows = records.select("set_id", "position", gold_record_error(v).alias("_own"), F.try_variant_get(v, "$.input_id", "string").alias("_input"))
    named = rows.filter(~F.coalesce(F.col("_own").isin("not_an_object", "annotation", "input_id"), F.lit(False)))
    first = named.groupBy("set_id", F.col("_input")).agg(F.min("position").alias("_first"))
    joined = rows.join(first, ["set_id", "_input"], "left")
    early = F.coalesce(F.col("_own").isin("not_an_object", "annotation", "input_id"), F.lit(False))
    error = F.when(early, F.col("_own")).when(F.col("position") > F.col("_first"), "duplicate_input").otherwise(F.col("_own"))
    return joined.select("set_id", "position", error.alias("error"))


def gold_set(spark: SparkSession, path: str) -> DataFrame:
    """Gold records. Another version, no records, or a record that breaks a rule is an error that names it."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    head = whole.select(F.try_variant_get("v", "$.version", "string").alias("version")).first()
    if head is None or head["version"] != GOLD_VERSION:
        raise ValueError("gold set: version")
    records = whole.select(F.lit(0).alias("set_id"), F.posexplode(F.try_variant_get("v", "$.records", "array<variant>")).alias("position", "r"))
    checked = gold_errors(records.select("set_id", "position", F.to_json("r").alias("raw"))).groupBy().agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("error").isNotNull(), F.struct("position", "error"))).alias("first")).first()
    if not checked["n"]:
        raise ValueError("gold set: no records")
    if checked["first"]:
        raise ValueError(f"gold set: record {checked['first']['position']}: {checked['first']['error']}")
    rows = spark.read.schema(schemas.GOLD).json(path, multiLine=True)
    return rows.select(F.explode("records").alias("r")).select("r.*")


def store_pages(pages: DataFrame) -> DataFrame:
    """What a page says of itself: title, heading, an advert's text, warnings (page_id, url, html in)."""
    html = F.coalesce("html", F.lit(""))
    title = F.coalesce(X.meta_content(html, "og:title"), X.clean_html(X.first_match(html, "(?is)<title>(.*?)</title>")))
    heading = X.clean_html(X.first_match(html, "(?is)<h1[^>]*>(.*?)</h1>"))
    advert = X.class_text(html, "ad")
    warnings = F.array_compact(F.array(F.when(F.coalesce(title, F.lit("")) == "", "missing_title"), F.when(X.meta_content(html, "og:image").isNull(), "missing_image"), F.when(heading.isNull(), "missing_heading")))
    return pages.select("page_id", title.alias("title"), heading.alias("heading"), advert.alias("advert"), F.array_join(warnings, ",").alias("warnings"))


def app_details(envelope: Column, appid: Column) -> Column:
    """JSON text of an app's details in the answer of the details service; null unless that app was a success."""
    item = F.call_function("get_json_object", envelope, F.concat(F.lit("$['"), appid.cast("string"), F.lit("']")))
    v = F.try_parse_json(item)
    success = (_kind(v, "$.success") == "BOOLEAN") & F.try_variant_get(v, "$.success", "boolean")
    return F.when(success, F.to_json(F.try_variant_get(v, "$.data", "variant")))


def store_snapshots(pages: DataFrame) -> DataFrame:
    """Normalised store pages: structured details first, then what the page's HTML has.

    pages: page_id, html, details (JSON text, may be null or invalid). Returns page_id and title, description_short,
    caption_image_url, screenshots, review_count, review_summary, release_raw, release_date, developers, publishers, tags,
    price, description, languages, platforms; ``warnings`` (missing_optional:<field>, in field order) and ``provenance``
    (field to appdetails or html, of the fields that were found).
    """
    html, d = F.coalesce("html", F.lit("")), F.try_parse_json("details")

    def text(name: str) -> Column:
        return F.nullif(F.try_variant_get(d, f"$.{name}", "string"), F.lit(""))

    def texts(name: str) -> Column:
        return F.coalesce(F.try_variant_get(d, f"$.{name}", "array<string>"), F.array().cast("array<string>"))

    def objects(name: str) -> Column:
        return F.coalesce(F.try_variant_get(d, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))

    def described(name: str) -> Column:
        found = F.transform(objects(name), lambda x: F.try_variant_get(x, "$.description", "string"))
        return F.filter(found, lambda x: F.coalesce(x, F.lit("")) != "")

    structured = {
        "title": F.coalesce(text("title"), text("name")),
        "description_short": F.coalesce(text("description_short"), text("short_description")),
        "caption_image_url": F.coalesce(text("caption_image_url"), text("header_image")),
        "detailed_description": text("detailed_description"),
    }
    fallback = {
        "title": X.meta_content(html, "og:title"),
        "description_short": X.class_text(html, "game_description_snippet"),
        "caption_image_url": X.meta_content(html, "og:image"),
        "detailed_description": X.class_text(html, "game_area_description"),
    }
    summary = F.nullif(X.class_text(html, "user_reviews_summary_row"), F.lit(""))
    shots = F.filter(F.transform(objects("screenshots"), lambda x: F.struct(F.try_variant_get(x, "$.path_full", "string").alias("full"), F.try_variant_get(x, "$.path_thumbnail", "string").alias("thumbnail"))), lambda x: F.coalesce(x["full"], F.lit("")) != "")
    plain = F.transform(F.filter(objects("categories"), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    price = F.struct(
        F.try_variant_get(d, "$.price_overview.final_formatted", "string").alias("display"),
        *[F.try_variant_get(d, f"$.price_overview.{k}", "long").alias(k) for k in ("initial", "final", "discount_percent")],
        F.try_variant_get(d, "$.price_overview.currency", "string").alias("currency"),
    )
    platforms = F.array_compact(F.array(*[F.when(F.try_variant_get(d, f"$.platforms.{k}", "boolean"), k) for k in ("windows", "mac", "linux")]))
    languages = F.filter(F.transform(F.split(F.coalesce(text("supported_languages"), F.lit("")), ","), X.stripped), lambda x: x != "")
    released = F.try_variant_get(d, "$.release_date.date", "string")
    rows = pages.select(
        "page_id",
        *[F.coalesce(structured[k], F.nullif(fallback[k], F.lit(""))).alias(k) for k in structured],
        *[structured[k].isNotNull().alias(f"_{k}") for k in structured],
        shots.alias("screenshots"),
        F.try_variant_get(d, "$.reviews", "long").alias("review_count"),
        summary.alias("review_summary"),
        released.alias("release_raw"),
        X.release_date(released).alias("release_date"),
        texts("developers").alias("developers"),
        texts("publishers").alias("publishers"),
        F.when(F.size(plain) > 0, plain).otherwise(F.concat(described("genres"), described("categories"))).alias("tags"),
        price.alias("price"),
        languages.alias("languages"),
        platforms.alias("platforms"),
    ).withColumn("description", X.clean_html(F.col("detailed_description")))

    lists = ("developers", "publishers", "screenshots")
    there = {k: F.col(k).isNotNull() for k in structured} | {k: F.size(k) > 0 for k in lists} | {"price": F.col("price.display").isNotNull(), "review_summary": F.col("review_summary").isNotNull()}
    order = ("title", "description_short", "caption_image_url", *lists, "price", "detailed_description", "review_summary")
    warnings = F.array_compact(F.array(*[F.when(~there[k], f"missing_optional:{k}") for k in order]))
    source = {k: F.when(F.col(f"_{k}"), "appdetails").otherwise("html") for k in structured} | {k: F.lit("appdetails") for k in lists} | {"review_summary": F.lit("html")}
    provenance = F.map_from_entries(F.array_compact(F.array(*[F.when(there[k], F.struct(F.lit(k).alias("key"), source[k].alias("value"))) for k in order if k in source])))
    return rows.withColumn("warnings", warnings).withColumn("provenance", provenance).drop("detailed_description", *[f"_{k}" for k in structured])
