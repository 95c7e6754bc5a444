"""Queries over what changes with time: crawls, decisions, taxonomies, usage and estimates; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SENTIMENTS, BriefLimits, EvidenceLimits, Selection
from ..functions import text as X
from ..operators import asof, estimates, evidence, metrics, publish, reports, selection, taxonomy, usage
from ..sources import readers
from ..streaming import crawl
from . import oracle
from . import reviews as R
from .oracle import CURRENT, POLICY_HASH, SAMPLE, quoted

KEYS = ["appid", "recommendationid"]


def crawl_pages(spark, sf) -> DataFrame:
    """Page logs of the event stream: an app is a user, its streams are two groups of event types. A crawl begins at every sixth
    event and lists the newest twelve, three a page; what events say decides where cursors stand still, a call fails, or an
    event was edited."""
    kind = F.when(F.col("event_type").isin("click", "view", "purchase"), "positive").otherwise("negative")
    ev = R.table(spark, sf, "events").select(F.col("user_id").alias("appid"), kind.alias("review_type"), "event_id", F.unix_timestamp("ts").alias("t"), "event_type")
    stream = Window.partitionBy("appid", "review_type")
    ev = ev.withColumn("i", F.row_number().over(stream.orderBy("event_id")) - 1)
    ev = ev.withColumn("own", F.floor(F.col("i") / 6).cast("long")).withColumn("last", F.max("own").over(stream))
    listed = ev.withColumn("crawl", F.explode(F.sequence("own", F.least(F.col("own") + 1, F.col("last")))))
    place = F.row_number().over(Window.partitionBy("appid", "review_type", "crawl").orderBy(F.desc("i"))) - 1
    listed = listed.withColumn("place", place).withColumn("p", F.floor(F.col("place") / 3).cast("long"))
    edited = F.when((F.col("event_type") == "error") & (F.col("event_id") % 4 == 0), F.concat("event_type", F.col("crawl").cast("string"))).otherwise(F.col("event_type"))
    review = F.struct("place", F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("recommendationid"), F.col("t").alias("timestamp_updated"), edited.alias("source_hash"))
    pages = listed.groupBy("appid", "review_type", "crawl", "p").agg(F.array_sort(F.collect_list(review)).alias("rows"), F.min("event_id").alias("low"))  # three a page
    number = F.row_number().over(stream.orderBy("crawl", "p")) - 1
    before = F.when(F.col("p") == 0, "*").otherwise(F.concat(F.lit("c"), F.col("p").cast("string")))
    after = F.when(F.col("low") % 29 == 0, before).when(F.col("low") % 31 == 0, "").otherwise(F.concat(F.lit("c"), (F.col("p") + 1).cast("string")))
    error = F.when(F.col("low") % 37 == 0, "timeout").when(F.col("low") % 41 == 0, "cancelled")
    rows = F.transform("rows", lambda r: F.struct(r["recommendationid"].alias("recommendationid"), r["timestamp_updated"].alias("timestamp_updated"), r["source_hash"].alias("source_hash")))
    return pages.select("appid", "review_type", number.cast("long").alias("page_no"), "crawl", before.alias("cursor_in"), after.alias("cursor_out"), error.alias("error"), rows.alias("reviews"), F.lit(None).cast("string").alias("raw"))


def stream_stops(spark, sf):
    """What becomes of each page of the logs: stop reasons, cursors and high water."""
    return crawl.follow_pages(crawl_pages(spark, sf)).drop("raw")


CRAWL_SQL = """
WITH RECURSIVE ev AS (SELECT user_id AS appid, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'positive' ELSE 'negative' END AS review_type, event_id, floor(epoch(ts))::BIGINT AS t, event_type FROM events),
numbered AS (SELECT *, row_number() OVER (PARTITION BY appid, review_type ORDER BY event_id) - 1 AS i FROM ev),
owned AS (SELECT *, i // 6 AS own, max(i // 6) OVER (PARTITION BY appid, review_type) AS last FROM numbered),
listed AS (SELECT *, unnest(range(own, least(own + 1, last) + 1)) AS crawl FROM owned),
placed AS (SELECT *, (row_number() OVER (PARTITION BY appid, review_type, crawl ORDER BY i DESC) - 1) AS place FROM listed),
grouped AS (SELECT appid, review_type, crawl, place // 3 AS p, min(event_id) AS low,
    list({'r': 'e' || event_id, 't': t, 'h': CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN event_type || crawl ELSE event_type END} ORDER BY place) AS listing FROM placed GROUP BY ALL),
pages AS (SELECT *, (row_number() OVER (PARTITION BY appid, review_type ORDER BY crawl, p) - 1) AS page_no, CASE WHEN p = 0 THEN '*' ELSE 'c' || p END AS cursor_in,
    CASE WHEN low % 29 = 0 THEN CASE WHEN p = 0 THEN '*' ELSE 'c' || p END WHEN low % 31 = 0 THEN '' ELSE 'c' || (p + 1) END AS cursor_out,
    CASE WHEN low % 37 = 0 THEN 'timeout' WHEN low % 41 = 0 THEN 'cancelled' END AS error FROM grouped),
run AS (
    SELECT DISTINCT appid, review_type, -1::BIGINT AS page_no, NULL::BIGINT AS crawl, false AS consumed, 'partial' AS status, NULL::VARCHAR AS stop_reason, '*' AS cursor, NULL::BIGINT AS high_water,
        NULL::BIGINT AS running, 0::BIGINT AS pages, 0::BIGINT AS reviews, 0::BIGINT AS new, 0::BIGINT AS changed, MAP {}::MAP(VARCHAR, STRUCT(t BIGINT, h VARCHAR)) AS known FROM pages
    UNION ALL
    SELECT appid, review_type, page_no, crawl, took, CASE WHEN took THEN CASE WHEN why IS NULL THEN 'partial' ELSE 'complete' END WHEN halted IS NULL AND error <> 'cancelled' THEN 'failed' WHEN halted IS NULL THEN 'partial' ELSE old_status END,
        why, CASE WHEN took THEN cursor_out ELSE cursor END, CASE WHEN took AND why IS NOT NULL THEN greatest(coalesce(high_water, 0), coalesce(newest, 0)) ELSE high_water END,
        newest, n_pages + took::INT, n_reviews + CASE WHEN took THEN len(listing) ELSE 0 END,
        CASE WHEN took THEN len(list_filter(listing, lambda x: known[x.r] IS NULL)) ELSE 0 END, CASE WHEN took THEN len(list_filter(listing, lambda x: known[x.r] IS NOT NULL AND known[x.r].h <> x.h)) ELSE 0 END,
        CASE WHEN took THEN map_concat(known, map_from_entries(list_transform(listing, lambda x: {'k': x.r, 'v': {'t': x.t, 'h': x.h}}))) ELSE known END
    FROM (
        SELECT *, CASE WHEN halted IS NOT NULL THEN halted WHEN error = 'cancelled' THEN 'cancelled' WHEN error IS NOT NULL THEN 'retry_exhausted:' || error WHEN cursor_out = cursor_in THEN 'repeated_cursor' WHEN cursor_out IN ('', '*') THEN 'non_progressing_cursor'
            WHEN high_water IS NOT NULL AND len(list_filter(listing, lambda x: x.t < high_water - 86400 AND known[x.r] IS NOT NULL AND known[x.r].t = x.t AND known[x.r].h = x.h)) = len(listing) THEN 'fully_known_overlap' END AS why,
            halted IS NULL AND error IS NULL AS took, CASE WHEN halted IS NULL AND error IS NULL THEN greatest(coalesce(top, 0), list_max(list_transform(listing, lambda x: x.t))) ELSE top END AS newest
        FROM (
            SELECT p.*, r.cursor, r.high_water, r.known, CASE WHEN p.crawl IS DISTINCT FROM r.crawl THEN NULL ELSE r.stop_reason END AS halted, CASE WHEN p.crawl IS DISTINCT FROM r.crawl THEN 'partial' ELSE r.status END AS old_status,
                CASE WHEN p.crawl IS DISTINCT FROM r.crawl THEN NULL ELSE r.running END AS top, CASE WHEN p.crawl IS DISTINCT FROM r.crawl THEN 0 ELSE r.pages END AS n_pages, CASE WHEN p.crawl IS DISTINCT FROM r.crawl THEN 0 ELSE r.reviews END AS n_reviews
            FROM run r JOIN pages p ON p.appid = r.appid AND p.review_type = r.review_type AND p.page_no = r.page_no + 1)))
SELECT appid, review_type, page_no, crawl, consumed, status, stop_reason, cursor, high_water, pages, reviews, new, changed FROM run WHERE page_no >= 0
"""


def _day(c: str):
    return F.unix_date(F.to_date(c)).cast("long")


def policy_intervals(spark, sf):
    """Decisions (events) of a user are valid until the next."""
    log = R.table(spark, sf, "events").select("user_id", "event_id", F.col("event_type").alias("policy"), F.unix_timestamp("ts").alias("decided_at"))
    return asof.intervals(log, ["user_id"], "decided_at", ["event_id"]).select("user_id", "event_id", "policy", "valid_from", "valid_to")


def current_as_of(spark, sf):
    """What was current for a part when each order line asks, 30 days and more behind its own shipment. Decisions: the lines of the part,
    by policy (flag); classifications: the discounted lines, some days later, under a policy and a model (status)."""
    li = R.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("policy_hash"), F.col("l_linestatus").alias("model"), "l_quantity", "l_discount", _day("l_shipdate").alias("day"))
    decisions = li.groupBy("l_partkey", "policy_hash", F.col("day").alias("decided_at")).agg(F.min(F.when(F.col("l_quantity") > 10, "eligible").otherwise("excluded")).alias("decision"))
    run = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    successes = li.filter("l_discount >= 0.03").select("l_partkey", "policy_hash", "model", run.alias("run_id"), (F.col("day") + F.col("l_linenumber")).alias("finished_at"))
    asked = li.select("l_orderkey", "l_linenumber", "l_partkey", "policy_hash", "model", (F.col("day") + 30 + F.col("l_linenumber") * 5).alias("asked_at"))
    return asof.current_at(asked, decisions, successes, ["l_partkey"], ["policy_hash", "model"], at="asked_at", width=90)


ASOF_SQL = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS policy_hash, l_linestatus AS model, l_quantity, l_discount, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS day FROM lineitem),
decisions AS (SELECT l_partkey, policy_hash, day AS decided_at, min(CASE WHEN l_quantity > 10 THEN 'eligible' ELSE 'excluded' END) AS decision FROM li GROUP BY ALL),
successes AS (SELECT l_partkey, policy_hash, model, l_orderkey || '-' || l_linenumber AS run_id, day + l_linenumber AS finished_at FROM li WHERE l_discount >= 0.03),
asked AS (SELECT row_number() OVER () AS n, l_orderkey, l_linenumber, l_partkey, policy_hash, model, day + 30 + l_linenumber * 5 AS asked_at FROM li),
d AS (SELECT n, max({'t': decided_at, 'p': d.policy_hash, 'd': decision}) AS found FROM asked a JOIN decisions d ON d.l_partkey = a.l_partkey AND decided_at <= asked_at GROUP BY n),
s AS (SELECT n, max({'t': finished_at, 'r': run_id}) AS done FROM asked a JOIN successes s ON s.l_partkey = a.l_partkey AND s.policy_hash = a.policy_hash AND s.model = a.model AND finished_at <= asked_at GROUP BY n)
SELECT l_orderkey, l_linenumber, l_partkey, policy_hash, model, asked_at, found.d AS decision, found.p AS decided_under, done.r AS run_id, coalesce(found.d = 'eligible' AND found.p = policy_hash AND done.r IS NOT NULL, false) AS current
FROM asked LEFT JOIN d USING (n) LEFT JOIN s USING (n)
"""


def part_nodes(spark, sf) -> DataFrame:
    """Parts under the part of their size's number: roots, unknown parents and cycles among them; and some defined twice."""
    part = R.table(spark, sf, "part")
    key = F.col("p_partkey")
    parent = F.when(key % 5 == 0, None).when(key % 97 == 1, F.concat(F.lit("x"), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    core = part.select(key.cast("string").alias("id"), parent.alias("parent_id"), F.when(key % 89 == 3, " ").otherwise(F.col("p_name")).alias("name"))
    extension = part.filter("p_partkey % 31 = 2 or p_partkey % 37 = 4").select(key.cast("string").alias("id"), parent.alias("parent_id"), F.when(key % 31 == 2, F.col("p_brand")).when(key % 89 == 3, " ").otherwise(F.col("p_name")).alias("name"))
    return taxonomy.merged(core, extension)


def taxonomy_closure(spark, sf):
    return taxonomy.closure(part_nodes(spark, sf))


def taxonomy_problems(spark, sf):
    return taxonomy.problems(part_nodes(spark, sf))


NODES_SQL = """core AS (SELECT p_partkey, p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 97 = 1 THEN 'x' || p_size ELSE p_size::VARCHAR END AS parent_id, CASE WHEN p_partkey % 89 = 3 THEN ' ' ELSE p_name END AS name, p_brand FROM part),
nodes AS (SELECT id, parent_id, name FROM core UNION SELECT id, parent_id, CASE WHEN p_partkey % 31 = 2 THEN p_brand ELSE name END FROM core WHERE p_partkey % 31 = 2 OR p_partkey % 37 = 4),
edges AS (SELECT DISTINCT n.id, n.parent_id FROM nodes n JOIN nodes k ON k.id = n.parent_id),
up AS (SELECT DISTINCT id, id AS ancestor, 0 AS distance, [id] AS path, false AS again FROM nodes
    UNION ALL SELECT u.id, e.parent_id, distance + 1, list_append(path, e.parent_id), list_contains(path, e.parent_id) FROM up u JOIN edges e ON e.id = u.ancestor WHERE NOT again)"""


def aspect_rollup(spark, sf):
    """Aspect rates by taxonomy ids and their ancestors: nations under regions under one root."""
    nation, region = R.table(spark, sf, "nation"), R.table(spark, sf, "region")
    leaf = nation.select(F.concat(F.lit("core.c"), F.col("n_nationkey").cast("string")).alias("id"), F.concat(F.lit("region."), F.col("n_regionkey").cast("string")).alias("parent_id"), F.col("n_name").alias("name"))
    above = region.select(F.concat(F.lit("region."), F.col("r_regionkey").cast("string")).alias("id"), F.lit("all").alias("parent_id"), F.col("r_name").alias("name"))
    root = region.limit(1).select(F.lit("all").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.lit("all").alias("name"))  # the root is one row
    return taxonomy.rolled_up(metrics.with_polarity(R.current(spark, sf)), leaf.unionByName(above).unionByName(root), metrics.GRAIN)


ROLLUP_SQL = f"""
WITH {CURRENT}, ways AS (SELECT 'core.c' || n_nationkey AS id, unnest(['core.c' || n_nationkey, 'region.' || n_regionkey, 'all']) AS taxonomy_id, unnest([2, 1, 0]) AS depth FROM nation),
hits AS (SELECT DISTINCT c.appid, c.language, c.polarity, c.recommendationid, w.taxonomy_id, w.depth, c.sentiment FROM cur c JOIN ways w ON w.id = c.taxonomy_id),
ids AS (SELECT DISTINCT appid, language, polarity, taxonomy_id, depth FROM hits),
every AS (SELECT appid, language, polarity, count(*) AS denominator FROM cur GROUP BY ALL)
SELECT appid::VARCHAR AS appid, language, polarity, taxonomy_id, depth, sentiment, numerator, denominator, numerator::DOUBLE / denominator AS value FROM (
    SELECT i.appid, i.language, i.polarity, i.taxonomy_id, i.depth, s.sentiment, count(h.recommendationid) AS numerator, e.denominator
    FROM ids i CROSS JOIN (SELECT unnest({quoted(SENTIMENTS)}) AS sentiment) s JOIN every e ON e.appid = i.appid AND e.language = i.language AND e.polarity = i.polarity
    LEFT JOIN hits h ON h.appid = i.appid AND h.language = i.language AND h.polarity = i.polarity AND h.taxonomy_id = i.taxonomy_id AND h.sentiment = s.sentiment GROUP BY ALL)
"""

CEILINGS = usage.Ceilings(requests=5000, tokens=100_000, cost=15_000_000_000)


def usage_ceilings(spark, sf):
    """Orders as batches of calls (their lines), admitted in their order."""
    calls = R.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").alias("tokens"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cost"))
    batches = usage.usage(calls, ["l_orderkey"]).withColumn("estimated_tokens", F.col("tokens") + 2 * F.col("requests"))
    return usage.admitted(batches, ["l_orderkey"], CEILINGS, 50)


USAGE_SQL = f"""
WITH b AS (SELECT l_orderkey, count(*) AS requests, sum(l_quantity)::BIGINT AS tokens, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cost FROM lineitem GROUP BY 1),
s AS (SELECT *, tokens + 2 * requests AS estimated_tokens, {", ".join(f"coalesce(sum({c}) OVER (ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS {c}_before" for c in ("requests", "tokens", "cost"))} FROM b),
r AS (SELECT *, CASE WHEN requests_before >= {CEILINGS.requests} THEN 'requests' WHEN tokens_before >= {CEILINGS.tokens} OR tokens_before + estimated_tokens + 50 > {CEILINGS.tokens} THEN 'tokens' WHEN cost_before >= {CEILINGS.cost} THEN 'cost' END AS refused FROM s)
SELECT *, count(refused) OVER (ORDER BY l_orderkey ROWS UNBOUNDED PRECEDING) = 0 AS admitted FROM r
"""


def weighted_estimates(spark, sf):
    """Totals of each language estimated from the stratified sample."""
    rows = R.reviews(spark, sf)
    sample = selection.select_inputs(rows, Selection("stratified", 7), R.PROJECT)
    marks = {"refunded": F.col("refunded"), "positive": F.col("voted_up"), "odd": F.col("votes_up") % 2 == 1, "short": F.length("review_text") < 500}
    out = estimates.totals(selection.with_strata(rows), sample, selection.STRATUM, ["language"], marks)
    return out.select("language", "mark", *[F.round(c, 6).alias(c) for c in ("total", "variance", "low", "high", "rate")], "population", "drawn")


ESTIMATE_SQL = f"""
WITH {SAMPLE}, sizes2 AS (SELECT appid, language, voted_up, playtime_bucket, signal, count(*) AS size FROM strata GROUP BY ALL),
marked AS (SELECT appid, language, voted_up, playtime_bucket, signal, m.mark, (CASE m.mark WHEN 'refunded' THEN refunded WHEN 'positive' THEN voted_up WHEN 'odd' THEN votes_up % 2 = 1 ELSE length(review_text) < 500 END)::INT AS y
    FROM chosen CROSS JOIN (SELECT unnest(['refunded', 'positive', 'odd', 'short']) AS mark) m),
h AS (SELECT appid, language, voted_up, playtime_bucket, signal, mark, count(*) AS n, sum(y) AS hits, var_samp(y) AS s2 FROM marked GROUP BY ALL),
pool AS (SELECT language, mark, coalesce(var_samp(y), 0) AS s2 FROM marked GROUP BY ALL),
j AS (SELECT s.language, h.mark, s.size, h.n, h.hits, CASE WHEN h.n > 1 THEN h.s2 ELSE pool.s2 END AS s2 FROM sizes2 s JOIN h USING (appid, language, voted_up, playtime_bucket, signal) JOIN pool ON pool.language = s.language AND pool.mark = h.mark),
t AS (SELECT language, mark, sum(hits * size::DOUBLE / n) AS total, sum(size::DOUBLE * size * (1 - n::DOUBLE / size) * s2 / n) AS variance, sum(size)::BIGINT AS population, sum(n)::BIGINT AS drawn FROM j GROUP BY ALL)
SELECT language, mark, round(total, 6) AS total, round(variance, 6) AS variance, round(greatest(0, total - 1.96 * sqrt(variance)), 6) AS low, round(least(population, total + 1.96 * sqrt(variance)), 6) AS high, round(total / population, 6) AS rate, population, drawn FROM t
"""


def retention_levels(spark, sf):
    """Retention labels at every level; reviews are updated over some months, bought and given away."""
    now = R.current(spark, sf).withColumns({"timestamp_updated": F.col("timestamp_updated") + F.col("votes_up") * 2_592_000, "steam_purchase": F.col("votes_up") % 3 != 0, "received_for_free": F.col("playtime_at_review") % 7 == 0})
    return metrics.retention_levels(now, strong=3)


LABEL_SQL = {
    "early_rejection": "NOT voted_up AND cohort = 'early' AND posture IN ('rejection', 'frustrated_but_engaged')",
    "early_dissatisfaction": "NOT voted_up AND cohort = 'early'",
    "established_dissatisfaction": "NOT voted_up AND cohort = 'established'",
    "long_use_dissatisfaction": "NOT voted_up AND cohort = 'long'",
    "invested_frustration": "cohort IN ('established', 'long') AND posture = 'frustrated_but_engaged'",
    "qualified_retention": "voted_up AND sentiment = 'negative'",
    "strong_advocacy": "voted_up AND posture = 'advocacy' AND overall = 'positive'",
}
DIMENSIONS = ("appid", "language", "updated_period", "steam_purchase", "received_for_free", "cohort")
RETENTION_SQL = f"""
WITH {CURRENT}, facts AS (SELECT appid, language, cohort, strftime(date_trunc('quarter', make_timestamp((timestamp_updated + votes_up * 2592000) * 1000000)), '%Y-%m') AS updated_period, votes_up % 3 <> 0 AS steam_purchase, playtime_at_review % 7 = 0 AS received_for_free,
    {", ".join(f"({rule}) AS {name}" for name, rule in LABEL_SQL.items())} FROM cur),
levels AS ({" UNION ALL ".join(f"SELECT {sum(1 << (5 - k) for k, d in enumerate(DIMENSIONS) if d not in level)}::BIGINT AS level, " + ", ".join(d if d in level else f"NULL AS {d}" for d in DIMENSIONS) + ", count(*) AS n, " + ", ".join(f"count(*) FILTER ({name}) AS {name}" for name in LABEL_SQL) + " FROM facts" + (f" GROUP BY {', '.join(level)}" if level else "") for level in metrics.LEVELS)})
{" UNION ALL ".join(f"SELECT level, {', '.join(DIMENSIONS)}, n AS denominator, '{name}' AS label, {name} AS numerator, {name}::DOUBLE / n AS value FROM levels WHERE n > 0" for name in LABEL_SQL)}
"""

def lineage_hashes(spark, sf):
    """One hash for all texts, runs and policies behind the current view, and for the order keys."""
    keys = R.table(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").cast("string").alias("value"))
    return metrics.lineage_hash(metrics.lineage_values(R.current(spark, sf)).unionByName(keys), leaf_values=16)


def _levels() -> str:
    """Each level's nodes: leaves of this depth, or what the level below folds to."""
    out = []
    for k in range(metrics.LINEAGE_DEPTH, -1, -1):
        leaves = f"SELECT kind, n, depth, left(h, {k}) AS prefix, sha256(string_agg(h, '' ORDER BY h)) AS h FROM placed WHERE depth = {k} GROUP BY ALL"
        folded = f" UNION ALL SELECT kind, n, depth, left(prefix, {k}), sha256(string_agg(h, '' ORDER BY prefix)) FROM level{k + 1} GROUP BY kind, n, depth, left(prefix, {k})"
        out.append(f"level{k} AS ({leaves}{folded if k < metrics.LINEAGE_DEPTH else ''})")
    return ", ".join(out)


LINEAGE_SQL = f"""
WITH {CURRENT}, vals AS (SELECT 'source_hash' AS kind, source_hash AS value FROM cur UNION SELECT 'classification_run_id', run_id FROM cur UNION SELECT 'eligibility_policy_hash', {POLICY_HASH} FROM cur UNION SELECT 'order', o_orderkey::VARCHAR FROM orders),
hashed AS (SELECT kind, sha256(value) AS h FROM vals), counted AS (SELECT kind, count(*) AS n FROM hashed GROUP BY 1),
placed AS (SELECT *, greatest(0, ceil(ln(n / 16.0) / ln(16)))::INT AS depth FROM hashed JOIN counted USING (kind)), {_levels()}
SELECT kind, n, h AS hash FROM level0
"""

SMALL = BriefLimits(metrics=12, evidence=45, findings=1, priorities=1, risks=1, vulnerabilities=1)
LISTS = (*publish.BRIEF_LISTS, "caveats")


def brief_table_errors(spark, sf):
    """Conversations as briefs: turns are items of the lists by turns, so lengths and texts are the table's."""
    turns = R.table(spark, sf, "conversations")
    name = F.element_at(F.array(*[F.lit(x) for x in LISTS]), (F.col("turn") % len(LISTS)).cast("int") + 1)
    items = turns.select(F.col("conv_id").alias("brief_id"), name.alias("list"), F.concat("text", F.when(F.col("role") == "system", " in Germany").otherwise("")).alias("text"))
    size = F.max(F.length("text"))
    briefs = turns.groupBy(F.col("conv_id").alias("brief_id")).agg(F.when(size % 5 == 0, "done").when(size % 5 == 1, "insufficient_evidence").otherwise("complete").alias("status"), F.when(size % 7 == 0, "old").otherwise(publish.BRIEF_VERSION).alias("schema_version"))
    return publish.brief_table_errors(briefs, items, SMALL).select("brief_id", F.coalesce("error", F.lit("ok")).alias("error"))


def _brief_sql() -> str:
    limits = {name: getattr(SMALL, limit) for name, limit in publish.BRIEF_LISTS.items()}
    many = " ".join(f"WHEN count(*) FILTER (turn % {len(LISTS)} = {k}) > {limits[name]} THEN 'too_many_{name}'" for k, name in enumerate(publish.BRIEF_LISTS))
    skipped = f"turn % {len(LISTS)} NOT IN ({LISTS.index('recommendations')}, {LISTS.index('caveats')})"
    return f"""WITH b AS (SELECT conv_id, max(length(text)) AS n FROM conversations GROUP BY 1)
SELECT conv_id AS brief_id, CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN 'status_or_version' {many} WHEN n % 5 = 1 AND count(*) FILTER (turn % {len(LISTS)} = {LISTS.index('caveats')}) = 0 THEN 'caveat'
    WHEN bool_or({skipped} AND role = 'system') THEN 'geography' ELSE 'ok' END AS error FROM conversations JOIN b USING (conv_id) GROUP BY conv_id, n"""


def payload_errors(spark, sf):
    """Customers as payloads: their orders' priorities and days are metrics, their order lines evidence, their orders competitors."""
    orders = R.table(spark, sf, "orders").withColumnRenamed("o_custkey", "payload_id")
    lines = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    customer = R.table(spark, sf, "customer")
    payloads = customer.select(F.col("c_custkey").alias("payload_id"), F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_name")).alias("project_id"), F.col("c_mktsegment").alias("run_id"), F.when(F.col("c_nationkey") == 5, None).otherwise(publish.BRIEF_VERSION).alias("schema_version"))
    named = orders.select("payload_id", F.concat_ws("/", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM")).alias("metric_id"))
    fields = F.when(F.col("o_orderstatus") == "P", F.to_json(F.struct(F.col("o_orderkey").alias("review_text")))).otherwise(F.to_json(F.struct("o_orderkey")))
    out = publish.payload_errors(payloads, named, lines.join(orders.select("payload_id", "o_orderkey"), "o_orderkey"), orders.select("payload_id", fields.alias("fields")), SMALL)
    return out.select("payload_id", F.coalesce("error", F.lit("ok")).alias("error"))


PAYLOAD_SQL = f"""
WITH m AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m')) AS d, bool_or(o_orderstatus = 'P') AS raw FROM orders GROUP BY 1),
e AS (SELECT o_custkey, count(*) AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey AS payload_id, CASE WHEN c_nationkey = 3 OR c_name = '' OR c_mktsegment = '' THEN 'identity' WHEN c_nationkey = 5 THEN 'version' WHEN n > {SMALL.metrics} OR k > {SMALL.evidence} THEN 'too_many' WHEN raw THEN 'raw_fields' WHEN d < n THEN 'duplicate_metric' ELSE 'ok' END AS error
FROM customer LEFT JOIN m ON m.o_custkey = c_custkey LEFT JOIN e ON e.o_custkey = c_custkey
"""


def payload_rows(spark, sf):
    """The bounded payload of a project: metrics, quotes and competitors (suppliers with an even key are active)."""
    now = R.current(spark, sf)
    quotes = evidence.select(evidence.candidates(now, R.PROJECT), EvidenceLimits())
    competitors = R.table(spark, sf, "supplier").filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("appid"), F.col("s_name").alias("title"))
    return publish.payload_rows(metrics.all_metrics(now), quotes, competitors, BriefLimits(evidence=5)).select("kind", "id")


ROWS_SQL = f"""SELECT 'metric' AS kind, metric_id AS id FROM ({oracle.SQL["payload_top_metrics"]}) UNION ALL
SELECT * FROM (SELECT 'evidence', selection_id FROM ({oracle.SQL["evidence_selected"]}) s JOIN (SELECT selection_id, score FROM ({oracle.SQL["evidence_scores"]})) USING (selection_id) ORDER BY score DESC, selection_id LIMIT 5) UNION ALL
SELECT 'competitor', printf('%012d', s_suppkey) FROM supplier WHERE s_suppkey % 2 = 0"""

def report_citations(spark, sf):
    """Customers as briefs, their orders as recommendations ranked by price; parts are the metrics and suppliers the reviews that
    an order's lines cite. Suppliers of every fifth nation are no evidence."""
    orders = R.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("brief_id"), F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("rank"), F.col("o_orderpriority").alias("title"))
    by_line = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    cited = R.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(by_line.alias("x"))
    recommendations = orders.join(cited, "o_orderkey", "left").select("brief_id", "rank", "title", F.transform("x", lambda x: x["l_partkey"]).alias("metric_ids"), F.transform("x", lambda x: x["l_suppkey"]).alias("review_ids"))
    parts = R.table(spark, sf, "part").filter("p_size % 2 = 0").select(F.col("p_partkey").alias("metric_id"), F.col("p_size").alias("numerator"), F.length("p_name").alias("denominator"))
    suppliers = R.table(spark, sf, "supplier").filter("s_nationkey % 5 <> 0").select(F.col("s_suppkey").alias("review_id"), F.col("s_name").alias("selection_id"))
    return reports.citations(recommendations, parts, suppliers)


CITATION_SQL = """WITH o AS (SELECT o_orderkey, o_custkey AS brief_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank, o_orderpriority AS title FROM orders),
refs AS (SELECT l_orderkey, 1 AS kind, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey) AS pos, printf('`metric:%d` (%d/%d)', p_partkey, p_size, length(p_name)) AS ref FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size % 2 = 0
    UNION ALL SELECT l_orderkey, 2, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey), printf('`review:%d` (`selection:%s`)', s_suppkey, s_name) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey % 5 <> 0)
SELECT brief_id, rank, '### ' || rank || '. ' || title AS heading, coalesce(string_agg(ref, '; ' ORDER BY kind, pos), 'No direct citation') AS citation FROM o LEFT JOIN refs ON l_orderkey = o_orderkey GROUP BY brief_id, rank, title"""


def report_groups(spark, sf):
    """A table row a group of reviews, in the order of the groups: app as text, then language."""
    groups = R.project(spark, sf).reviews.groupBy("appid", "language").agg(F.count(F.lit(1)).alias("n"), F.count_if("voted_up").alias("up"))
    return reports.group_lines(groups, [F.col("appid"), F.col("language"), F.format_string("%d/%d positive", "up", "n")])


def types_first_seen(spark, sf):
    """Every user's types of events in the order in which they first appear."""
    return reports.first_seen(R.table(spark, sf, "events"), ["user_id"], "event_type", ["ts", "event_id"])


def active_competitors(spark, sf):
    """Suppliers as projects, parts as competitors; an order line adds one, a returned one takes it away."""
    log = R.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("project_id"), F.col("l_partkey").alias("appid"), (F.col("l_returnflag") != "R").alias("active"), "l_shipdate", "l_orderkey", "l_linenumber")
    return reports.active_competitors(log, ["l_shipdate", "l_orderkey", "l_linenumber"])


def snapshot_log(spark, sf):
    """Snapshots of parts (apps) by suppliers (projects) at the days of their order lines, in order."""
    rows = R.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("project_id"), F.col("l_partkey").alias("appid"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("fetched_at"))
    return reports.snapshot_log(rows).select("project_id", "place", "snapshot_id")


def gold_errors(spark, sf):
    """Turns of conversations as gold records, a set a conversation; what a turn says decides which fields are of another kind."""
    n, text = F.length("text"), X.json_string(F.col("text"))
    name = X.json_string(F.concat_ws("-", F.col("conv_id").cast("string"), F.floor(n / 40).cast("string")))
    role = X.json_string(F.col("role"))
    voted = F.when(F.col("role") == "system", role).when(F.col("role") == "user", "true").otherwise("false")
    playtime = F.when(n % 11 == 0, text).otherwise(n.cast("string"))
    aspects = F.when(n % 13 == 0, F.concat(F.lit("["), n.cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("["), role, F.lit("]")))
    notes = F.concat(F.lit('{"actionable":'), F.when(n % 17 == 0, "1").otherwise("true"), F.lit(',"overall_sentiment":'), role, F.lit(',"engagement_posture":'), F.when(n % 19 == 0, "null").otherwise(role), F.lit(',"aspects":'), aspects, F.lit("}"))
    fields = {"input_id": name, "review_id": F.when(n % 23 == 0, '""').otherwise(name), "language": role, "voted_up": voted, "playtime_at_review": playtime, "review_text": text, "eligible": F.when(n > 300, "true").otherwise("false"), "annotation": F.when(n % 29 == 0, text).otherwise(notes)}
    raw = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in fields.items()]), F.lit("}"))
    records = R.table(spark, sf, "conversations").select(F.col("conv_id").alias("set_id"), F.col("turn").alias("position"), raw.alias("raw"))
    return readers.gold_errors(records).select("set_id", "position", F.coalesce("error", F.lit("ok")).alias("error"))


GOLD_SQL = """WITH r AS (SELECT conv_id AS set_id, turn AS position, role, text, length(text) AS n, length(text) // 40 AS id FROM conversations),
f AS (SELECT set_id, id, min(position) AS first FROM r WHERE n % 29 <> 0 GROUP BY ALL)
SELECT r.set_id, position, CASE WHEN n % 29 = 0 THEN 'annotation' WHEN position > first THEN 'duplicate_input' WHEN n % 13 = 0 THEN 'aspects' WHEN n % 23 = 0 THEN 'review_id' WHEN role = 'system' THEN 'voted_up'
    WHEN n % 11 = 0 THEN 'playtime_at_review' WHEN text = '' THEN 'review_text' WHEN n % 17 = 0 THEN 'actionable' WHEN n % 19 = 0 THEN 'engagement_posture' ELSE 'ok' END AS error
FROM r LEFT JOIN f ON f.set_id = r.set_id AND f.id = r.id"""

QUERIES = {f.__name__: f for f in (stream_stops, policy_intervals, current_as_of, taxonomy_closure, taxonomy_problems, aspect_rollup, usage_ceilings, weighted_estimates, retention_levels, lineage_hashes, brief_table_errors, payload_errors, payload_rows, report_citations, report_groups, types_first_seen, active_competitors, snapshot_log, gold_errors)}

SQL = {
    "stream_stops": CRAWL_SQL,
    "policy_intervals": "SELECT user_id, event_id, event_type AS policy, floor(epoch(ts))::BIGINT AS valid_from, lead(floor(epoch(ts))::BIGINT) OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS valid_to FROM events",
    "current_as_of": ASOF_SQL,
    "taxonomy_closure": f"WITH RECURSIVE {NODES_SQL} SELECT id, ancestor, min(distance) AS distance FROM up GROUP BY ALL",
    "taxonomy_problems": f"""WITH RECURSIVE {NODES_SQL} SELECT DISTINCT id, 'blank' AS problem FROM nodes WHERE trim(name) = '' UNION SELECT id, 'conflict' FROM nodes GROUP BY id HAVING count(*) > 1
        UNION SELECT id, 'unknown_parent' FROM nodes WHERE parent_id NOT IN (SELECT id FROM nodes) UNION SELECT id, 'cycle' FROM up WHERE again""",
    "aspect_rollup": ROLLUP_SQL,
    "usage_ceilings": USAGE_SQL,
    "weighted_estimates": ESTIMATE_SQL,
    "retention_levels": RETENTION_SQL,
    "lineage_hashes": LINEAGE_SQL,
    "brief_table_errors": _brief_sql(),
    "payload_errors": PAYLOAD_SQL,
    "payload_rows": ROWS_SQL,
    "report_citations": CITATION_SQL,
    "report_groups": f"WITH {oracle.REVIEWS} SELECT appid, language, row_number() OVER (ORDER BY appid, language) AS place, '| ' || appid || ' | ' || language || ' | ' || up || '/' || n || ' positive |' AS line FROM (SELECT appid::VARCHAR AS appid, language, count(*) AS n, count(*) FILTER (voted_up) AS up FROM reviews GROUP BY ALL)",
    "types_first_seen": "SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM (FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)",
    "active_competitors": "SELECT l_suppkey AS project_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS place, l_partkey AS appid, 'https://store.steampowered.com/app/' || l_partkey || '/' AS store_url FROM (SELECT l_suppkey, l_partkey, l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1) WHERE l_returnflag <> 'R'",
    "snapshot_log": "SELECT l_suppkey AS project_id, row_number() OVER (ORDER BY l_suppkey, day, l_partkey) AS place, l_suppkey || ':' || l_partkey || ':' || day AS snapshot_id FROM (SELECT DISTINCT l_suppkey, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem)",
    "gold_errors": GOLD_SQL,
}
