"""SQL that states each registered query's result independently, for DuckDB over the same tables."""

from __future__ import annotations

import json
from html.entities import html5

from ..config import COHORT_NAMES, POSTURES, SENTIMENTS, FilterPolicy
from . import fixtures
from .reviews import EDGE_TEXTS

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TERMS = FilterPolicy.high_signal_terms


def literal(value) -> str:
    return "NULL" if value is None else str(value).lower() if isinstance(value, bool) else "'" + value.replace("'", "''") + "'"


def quoted(values) -> str:
    return "[" + ", ".join(map(literal, values)) + "]"


def picked(values, index: str, word: str = "''") -> str:
    """One of the fixture texts by turns, with the word put in."""
    return f"replace({quoted(values)}[({index}) % {len(values)} + 1], '@@', {word})"


def joined(values: str, sep: str = "|") -> str:
    return f"array_to_string({values}, '{sep}')"


def decision(size: str) -> str:
    """CASE over columns t (text), m (without white space), w (tokens in lower case)."""
    signal = " OR ".join(f"contains(lower(t), '{x}')" for x in TERMS)
    return f"""CASE WHEN m = '' THEN 'excluded_empty'
    WHEN length(m) >= 4 AND regexp_matches(m, '[/\\\\|_\\-=+*#<>^~()\\[\\]{{}}]') AND length(regexp_replace(m, '[^\\p{{L}}]', '', 'g')) / length(m) < 0.2 THEN 'excluded_ascii_art'
    WHEN regexp_full_match(m, '[\\p{{P}}\\p{{S}}]+') THEN 'excluded_punctuation'
    WHEN CASE WHEN list_max(list_transform(list_distinct(string_split(m, '')), lambda c: length(m) - length(replace(m, c, '')))) / length(m) >= 0.8
        THEN length(m) >= 3 ELSE len(w) >= 3 AND len(list_distinct(w)) = 1 END THEN 'excluded_repetition'
    WHEN {size} > 100 AND length(m) < 10 AND len(w) < 3 AND NOT ({signal}) THEN 'excluded_low_information'
    ELSE 'eligible' END"""


PARTS = f"regexp_replace(t, '{WS}', '', 'g') AS m, list_transform(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+'), lambda x: lower(x)) AS w"

REVIEWS = """reviews AS (
    SELECT 'p1' AS project_id, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) + 1 AS appid, CAST(d.doc_id AS VARCHAR) AS recommendationid, lang AS language, text AS review_text,
        coalesce(quality, d.doc_id % 2) = 1 AS voted_up, coalesce(toxic, 0) = 1 AS refunded, n_chars % 31 AS votes_up,
        CASE WHEN d.doc_id % 11 <> 0 THEN n_chars % 1200 END AS playtime_at_review, d.doc_id + 1699999900 AS timestamp_created, d.doc_id + 1700000000 AS timestamp_updated,
        sha256(text) AS source_hash, d.doc_id
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

DECISIONS = f"""decisions AS (SELECT appid, recommendationid, {decision("(SELECT count(*) FROM reviews)")} AS decision
    FROM (SELECT *, {PARTS} FROM (SELECT appid, recommendationid, review_text AS t FROM reviews)))"""

HISTORY = f"""history AS (
    SELECT appid, recommendationid, CASE WHEN doc_id % 17 = 0 THEN 'stale' ELSE source_hash END AS source_hash, 'run-' || v AS run_id, timestamp_created + v * 1000 AS updated_at,
        CASE WHEN v = 1 AND doc_id % 13 = 0 THEN 'failed' ELSE 'success' END AS status, {quoted(POSTURES)}[(doc_id + v) % 7 + 1] AS posture,
        {quoted(SENTIMENTS)}[(doc_id // 2 + v) % 4 + 1] AS overall, CASE WHEN doc_id % 10 <> 0 THEN doc_id % 5 = 0 END AS mentioned,
        'core.c' || (doc_id // 20) % 12 AS taxonomy_id, {quoted(SENTIMENTS)}[doc_id % 4 + 1] AS sentiment, substr(review_text, 1, 20) AS evidence, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS copies
    FROM (SELECT *, unnest(CASE WHEN doc_id % 4 = 0 THEN [0, 1] ELSE [0] END) AS v FROM reviews)),
latest AS (SELECT * FROM history WHERE status = 'success' QUALIFY row_number() OVER (PARTITION BY appid, recommendationid ORDER BY updated_at DESC, run_id DESC) = 1)"""

CURRENT = f"""{REVIEWS}, {DECISIONS}, {HISTORY},
cur AS (SELECT r.*, h.* EXCLUDE (appid, recommendationid, source_hash), CASE WHEN voted_up THEN 'positive' ELSE 'negative' END AS polarity,
        CASE WHEN playtime_at_review IS NULL THEN 'unknown' WHEN playtime_at_review < 60 THEN 'early' WHEN playtime_at_review < 600 THEN 'established' ELSE 'long' END AS cohort
    FROM reviews r JOIN decisions d USING (appid, recommendationid) JOIN latest h USING (appid, recommendationid, source_hash) WHERE d.decision = 'eligible')"""

GRID = """groups AS (SELECT DISTINCT appid, language FROM cur),
grid AS (SELECT appid, language, polarity FROM groups, (VALUES ('positive'), ('negative')) p(polarity)),
tot AS (SELECT g.*, count(c.appid) AS n, coalesce(sum(c.refunded::INT), 0) AS refunded, coalesce(sum(c.votes_up), 0) AS votes, coalesce(sum(coalesce(c.mentioned, false)::INT), 0) AS mentioned
    FROM grid g LEFT JOIN cur c USING (appid, language, polarity) GROUP BY ALL)"""

BASE_DIMS = """'{"appid":"' || appid || '","language":"' || language || '","polarity":"' || polarity || '\"}'"""


def select_metric(name: str, source: str, num: str, den: str, dims: str = BASE_DIMS) -> str:
    return f"""SELECT '{name}' AS metric_name, {dims} AS dimensions_json, ({num})::BIGINT AS numerator, ({den})::BIGINT AS denominator,
        CASE WHEN ({den}) = 0 THEN NULL ELSE ({num})::DOUBLE / ({den})::DOUBLE END AS value FROM {source}"""


FAMILIES = {
    "review_count": select_metric("review_count", "(SELECT t.*, a.total FROM tot t JOIN (SELECT appid, language, count(*) AS total FROM cur GROUP BY ALL) a USING (appid, language))", "n", "total"),
    "posture_rate": select_metric(
        "posture_rate",
        f"(SELECT t.appid, t.language, t.polarity, t.n, p.posture, count(c.appid) AS hit FROM tot t, (SELECT unnest({quoted(POSTURES)}) AS posture) p LEFT JOIN cur c ON c.appid = t.appid AND c.language = t.language AND c.polarity = t.polarity AND c.posture = p.posture GROUP BY ALL)",
        "hit",
        "n",
        """'{"appid":"' || appid || '","language":"' || language || '","polarity":"' || polarity || '","posture":"' || posture || '"}'""",
    ),
    "aspect_rate": select_metric(
        "aspect_rate",
        f"(SELECT t.appid, t.language, t.polarity, t.n, k.taxonomy_id, s.sentiment, count(c.appid) AS hit FROM tot t JOIN (SELECT DISTINCT appid, language, polarity, taxonomy_id FROM cur) k USING (appid, language, polarity), (SELECT unnest({quoted(SENTIMENTS)}) AS sentiment) s LEFT JOIN cur c ON c.appid = t.appid AND c.language = t.language AND c.polarity = t.polarity AND c.taxonomy_id = k.taxonomy_id AND c.sentiment = s.sentiment GROUP BY ALL)",
        "hit",
        "n",
        """'{"appid":"' || appid || '","language":"' || language || '","polarity":"' || polarity || '","sentiment":"' || sentiment || '","taxonomy_id":"' || taxonomy_id || '"}'""",
    ),
    "refunded_rate": select_metric("refunded_rate", "tot", "refunded", "n"),
    "abandonment_mention_rate": select_metric("abandonment_mention_rate", "tot", "mentioned", "n"),
    "helpfulness_visibility": select_metric("helpfulness_visibility", "tot", "votes", "votes"),
    "friction_rate": select_metric(
        "friction_rate",
        f"(SELECT g.appid, g.language, g.polarity, k.cohort, count(c.appid) AS n, coalesce(sum((c.posture IN ('rejection', 'frustrated_but_engaged'))::INT), 0) AS hit FROM grid g, (SELECT unnest({quoted(COHORT_NAMES)}) AS cohort) k LEFT JOIN cur c ON c.appid = g.appid AND c.language = g.language AND c.polarity = g.polarity AND c.cohort = k.cohort GROUP BY ALL)",
        "hit",
        "n",
        """'{"appid":"' || appid || '","cohort":"' || cohort || '","language":"' || language || '","polarity":"' || polarity || '"}'""",
    ),
}
EVERY = " UNION ALL ".join(f"({x})" for x in FAMILIES.values())
METRIC_ID = "substr(sha256('[\"' || metric_name || '\",' || dimensions_json || ']'), 1, 24)"

SEED = "'p1:' || appid || ':' || recommendationid || ':' || taxonomy_id || ':' || evidence"
QUOTES = f"""quotes AS (SELECT DISTINCT *, {SEED} AS seed FROM (SELECT appid, recommendationid, language, taxonomy_id, regexp_replace(evidence, '^{WS}+|{WS}+$', '', 'g') AS evidence,
    CASE WHEN sentiment = overall THEN 'confirming' ELSE 'counterevidence' END AS direction FROM cur) WHERE evidence <> '' AND length(evidence) <= 280)"""


def unit(expression: str) -> str:
    return f"(('0x' || substr(sha256({expression}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


STRATA = f"""strata AS (SELECT *, CASE WHEN coalesce(playtime_at_review, 0) < 60 THEN 'early' WHEN playtime_at_review < 600 THEN 'established' ELSE 'long' END AS playtime_bucket,
    CASE WHEN timestamp_created >= 1700000000 THEN 'recent' ELSE 'older' END || ':' || CASE WHEN votes_up >= 10 THEN 'helpful' ELSE 'ordinary' END AS signal,
    {unit("'7:p1:' || appid || ':' || recommendationid")} AS score FROM reviews)"""
SAMPLE = f"""{REVIEWS}, {STRATA},
ranked AS (SELECT *, row_number() OVER (PARTITION BY appid, language, voted_up, playtime_bucket, signal ORDER BY score, appid, recommendationid) AS nth FROM strata),
sizes AS (SELECT count(*) AS n, count(*) FILTER (nth = 1) AS k, greatest(count(*) FILTER (nth = 1), ceil(0.1 * count(*)))::BIGINT AS target FROM ranked),
ordered AS (SELECT *, row_number() OVER (ORDER BY (nth > 1), score, appid, recommendationid) AS place FROM ranked),
chosen AS (SELECT o.*, n::DOUBLE / least(target, n) AS sampling_weight FROM ordered o, sizes WHERE nth = 1 OR place <= target)"""

#: Length of the projection's compact JSON: fixed keys, escaped text.
ESCAPED = "length(replace(replace(replace(replace(replace(review_text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t'))"
TOKENS = f"""tokens AS (SELECT appid, recommendationid, greatest(1, ceil((length('{{"appid":,"recommendationid":"","language":"","voted_up":,"playtime_at_review":,"review_text":"","source_hash":""}}')
    + length(appid::VARCHAR) + length(recommendationid) + length(language) + length(voted_up::VARCHAR) + length(coalesce(playtime_at_review::VARCHAR, 'null')) + {ESCAPED} + 64 + 13) / 4.0))::BIGINT AS tokens FROM reviews)"""
PLAN = f"""{REVIEWS}, {TOKENS},
line AS (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY recommendationid) AS i FROM tokens),
plan AS (SELECT appid, recommendationid, tokens, i, 0::BIGINT AS batch, 1::BIGINT AS k, tokens AS t FROM line WHERE i = 1
    UNION ALL SELECT l.appid, l.recommendationid, l.tokens, l.i, p.batch + (p.k >= 20 OR p.t + l.tokens > 40000)::BIGINT, CASE WHEN p.k >= 20 OR p.t + l.tokens > 40000 THEN 1 ELSE p.k + 1 END,
        CASE WHEN p.k >= 20 OR p.t + l.tokens > 40000 THEN l.tokens ELSE p.t + l.tokens END FROM plan p JOIN line l ON l.appid = p.appid AND l.i = p.i + 1)"""

INCOMING = """incoming AS (SELECT appid, CASE WHEN doc_id % 7 = 0 THEN recommendationid || '-n' ELSE recommendationid END AS recommendationid,
    CASE WHEN doc_id % 3 = 0 THEN sha256(review_text || '!') ELSE source_hash END AS source_hash, timestamp_updated, doc_id FROM reviews)"""
KINDS = f"""{REVIEWS}, {INCOMING}, kinds AS (SELECT i.appid, i.recommendationid, CASE WHEN r.source_hash IS NULL THEN 'new' WHEN r.source_hash <> i.source_hash THEN 'changed' ELSE 'unchanged' END AS kind
    FROM incoming i LEFT JOIN reviews r USING (appid, recommendationid))"""

EDGES = f"""docs AS (SELECT doc_id, text AS t, source FROM documents UNION ALL
    SELECT -i, {quoted(EDGE_TEXTS)}[i], source FROM (SELECT DISTINCT source FROM documents), range(1, {len(EDGE_TEXTS) + 1}) r(i)),
decided AS (SELECT doc_id, source, {decision("(SELECT count(*) FROM docs)")} AS decision FROM (SELECT *, {PARTS} FROM docs))"""

PAIRS = """pairs AS (SELECT l.doc_id, CASE WHEN quality = 1 THEN ['a', 'b'] ELSE ['c'] END AS gold, CASE WHEN n_chars % 2 = 0 THEN ['a', 'c'] ELSE ['b'] END AS pred, quality, toxic, n_chars % 2 AS guess
    FROM labels l JOIN documents d USING (doc_id))"""


#: What the standard says of character references: what is a reference, else text or a lone ampersand; names (those that may go
#: without a semicolon also count as the start of a longer name); numbers that stand for others, and those for nothing.
REFERENCES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
OPEN_NAMES = {k: v for k, v in html5.items() if not k.endswith(";")}
C1 = dict(zip(range(0x80, 0xA0), bytes(range(0x80, 0xA0)).decode("cp1252", "replace"), strict=True))
NUMBERS = {0: "\ufffd", 13: "\r"} | {k: chr(k) if v == "\ufffd" else v for k, v in C1.items()}
NOTHING = "n BETWEEN 1 AND 8 OR n BETWEEN 14 AND 31 OR n BETWEEN 127 AND 159 OR n BETWEEN 64976 AND 65007 OR n = 11 OR n % 65536 >= 65534"


def mapped(values: dict) -> str:
    return f"MAP {{{', '.join(f'{literal(k) if isinstance(k, str) else k}: {literal(v)}' for k, v in values.items())}}}"


def unescaped(x: str) -> str:
    """All character references of HTML, as the standard decodes them."""
    number = "CASE WHEN lower(r[3]) = 'x' THEN try_cast('0x' || regexp_extract(r, '^&#[xX]0*([0-9a-fA-F]+)', 1) AS UBIGINT) ELSE try_cast(regexp_extract(r, '^&#([0-9]+)', 1) AS UBIGINT) END"
    numeric = f"list_transform([{number}], lambda n: CASE WHEN {mapped(NUMBERS)}[n] IS NOT NULL THEN {mapped(NUMBERS)}[n] WHEN n IS NULL OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN '\ufffd' WHEN {NOTHING} THEN '' ELSE chr(n::INT) END)[1]"
    most = max(map(len, OPEN_NAMES))
    started = f"list_transform(list_filter(range({most}, 1, -1), lambda k: k < length(r) - 1 AND {mapped(OPEN_NAMES)}[r[2:k + 1]] IS NOT NULL)[1:1], lambda k: {mapped(OPEN_NAMES)}[r[2:k + 1]] || r[k + 2:])[1]"
    named = f"coalesce({mapped(html5)}[r[2:]], {started}, r)"
    decoded = f"CASE WHEN r[1] <> '&' OR r = '&' THEN r WHEN r[2] = '#' AND length(r) > 2 THEN {numeric} ELSE {named} END"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '{REFERENCES}'), lambda r: {decoded}), '')"


def cleaned(x: str) -> str:
    return f"trim(regexp_replace({unescaped(f'regexp_replace({x}, {chr(39)}<[^>]+>{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')}, '{WS}+', ' ', 'g'))"


TITLE = cleaned("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")
HEADING = cleaned("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")
ADVERT = cleaned("""regexp_extract(html, '(?is)<[^>]+class=["''][^"'']*ad[^"'']*["''][^>]*>(.*?)</', 1)""")
#: Credentials in messages, and what stands for them.
CREDENTIALS = (
    (r"(https?://)([^/@\s]+):([^/@\s]+)@", r"\1[redacted]@"),
    (r"(?i)(bearer\s+)[^\s,;]+", r"\1[redacted]"),
    (r"(?i)(api[_-]?key|token|secret|password|authorization|credential)(\s*[=:]\s*)[^\s,;]+", r"\1\2[redacted]"),
    (r"(?i)\b(secret|password|credential)\b", "[redacted]"),
)


def redacted(x: str) -> str:
    for pattern, by in CREDENTIALS:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    return x


REDACTED = redacted("text")
#: Rules of a result (j: its text, w: the review's), in order.
ASPECTS = "json_extract(j, '$.aspects[*]')"


def any_aspect(rule: str) -> str:
    return f"len(list_filter({ASPECTS}, lambda a: {rule})) > 0"


def not_number(path: str, least: int, most: int, j: str = "j") -> str:
    return f"NOT coalesce(json_type({j}, '{path}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND json_extract({j}, '{path}')::DOUBLE BETWEEN {least} AND {most}, false)"


def not_label(path: str, values, j: str = "j") -> str:
    return f"NOT coalesce(json_type({j}, '{path}') = 'VARCHAR' AND json_extract_string({j}, '{path}') IN ({', '.join(map(literal, values))}), false)"


def lacks(keys, j: str) -> str:
    return "(" + " OR ".join(f"json_type({j}, '$.{k}') IS NULL" for k in keys) + ")"


RESULT_RULES = f"""CASE WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object'
    WHEN coalesce(json_type(j, '$.input_id'), '') <> 'VARCHAR' THEN 'unknown_input'
    WHEN {lacks([k for k in fixtures.RESULT if k != "input_id"], "j")} THEN 'missing_field'
    WHEN {not_label('$.engagement_posture', POSTURES)} THEN 'posture' WHEN {not_label('$.overall_sentiment', SENTIMENTS)} THEN 'sentiment'
    WHEN {not_number('$.sentiment_intensity', 1, 5)} THEN 'intensity' WHEN json_type(j, '$.aspects') <> 'ARRAY' THEN 'aspects'
    WHEN {any_aspect("json_type(a) <> 'OBJECT'")} THEN 'aspect_not_an_object' WHEN {any_aspect(lacks(fixtures.RESULT['aspects'][0], 'a'))} THEN 'aspect_missing_field'
    WHEN {any_aspect(not_label('$.taxonomy_id', [f'core.c{i}' for i in range(12)], 'a'))} THEN 'taxonomy' WHEN {any_aspect(not_label('$.sentiment', SENTIMENTS, 'a'))} THEN 'aspect_sentiment'
    WHEN {any_aspect(not_number('$.intensity', 1, 5, 'a'))} THEN 'aspect_intensity' WHEN {any_aspect(not_number('$.confidence', 0, 1, 'a'))} THEN 'confidence'
    WHEN {any_aspect("trim(json_extract_string(a, '$.evidence')) = '' OR NOT contains(w, json_extract_string(a, '$.evidence'))")} THEN 'evidence'
    WHEN json_type(j, '$.self_reported_abandonment') <> 'OBJECT' THEN 'abandonment_not_an_object'
    WHEN coalesce(json_extract(j, '$.self_reported_abandonment.verified')::VARCHAR, '') <> 'false' THEN 'verified'
    WHEN json_extract_string(j, '$.self_reported_abandonment.statement_type') NOT IN ('refund', 'uninstall', 'stopped_playing', 'abandoned', 'other') THEN 'statement_type' ELSE 'ok' END"""
ITEMS = "json_extract(j, '$.reviews[*]')"


def any_item(rule: str) -> str:
    return f"len(list_filter({ITEMS}, lambda a: {rule})) > 0"


PAGE_RULES = f"""CASE WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object' WHEN json_extract_string(j, '$.success') <> '1' THEN 'not_successful'
    WHEN json_type(j, '$.cursor') <> 'VARCHAR' THEN 'cursor' WHEN json_type(j, '$.reviews') <> 'ARRAY' THEN 'reviews' WHEN {any_item("json_type(a) <> 'OBJECT'")} THEN 'item_not_an_object'
    WHEN {any_item(lacks(("recommendationid", "language", "review", "voted_up", "timestamp_created", "timestamp_updated"), "a"))} THEN 'item_fields'
    WHEN {any_item("TRY_CAST(json_extract_string(a, '$.timestamp_updated') AS BIGINT) IS NULL OR (json_type(a, '$.votes_up') IS NOT NULL AND TRY_CAST(json_extract_string(a, '$.votes_up') AS BIGINT) IS NULL)")} THEN 'item_value' ELSE 'ok' END"""
#: Canonical text (sorted keys, no spaces, ASCII) of the items of the accepted pages, by the page's number.
CANONICAL = [[json.dumps(item, sort_keys=True, separators=(",", ":")) for item in json.loads(page)["reviews"]] if k in (0, 1, 10) else [] for k, page in enumerate(fixtures.PAGES)]
PAGE_ITEMS = f"(SELECT doc_id, unnest({'[' + ', '.join(quoted(x) for x in CANONICAL) + ']'}[doc_id % {len(CANONICAL)} + 1]) AS c FROM documents)"


def detail(path: str) -> str:
    return f"nullif(json_extract_string(d, '{path}'), '')"


#: Store pages: d: details (null if invalid), h: the page's HTML, id. What the fixtures' HTML says is stated.
OG, SNIPPET, SUMMARY = "CASE WHEN s = 1 THEN 'T&C ’' || id END", "CASE WHEN s = 1 THEN 'From page' END", "CASE WHEN s = 2 THEN 'Mostly fine' END"
DESCRIBED = "list_filter(list_transform(coalesce(json_extract(d, '$.{}[*]'), []), lambda x: json_extract_string(x, '$.description')), lambda x: x IS NOT NULL)"
STORE = f"""store AS (SELECT page_id, {detail('$.name')} AS n, {detail('$.short_description')} AS sd, {detail('$.header_image')} AS hi, {detail('$.detailed_description')} AS dd, {OG} AS og, {SNIPPET} AS sn, {SUMMARY} AS su,
    coalesce(json_extract_string(d, '$.developers[*]'), []) AS dev, coalesce(json_extract_string(d, '$.publishers[*]'), []) AS pub,
    len(list_filter(coalesce(json_extract(d, '$.screenshots[*]'), []), lambda x: json_extract_string(x, '$.path_full') <> '')) AS shots,
    list_transform(list_filter(coalesce(json_extract(d, '$.categories[*]'), []), lambda x: json_type(x) = 'VARCHAR'), lambda x: json_extract_string(x, '$')) AS plain, {DESCRIBED.format('genres')} AS ge, {DESCRIBED.format('categories')} AS ca, d
    FROM (SELECT page_id, page_id::VARCHAR AS id, (page_id // 4) % 3 AS s, CASE WHEN page_id % 4 > 1 THEN {picked(fixtures.DETAILS, 'page_id', 'page_id::VARCHAR')} END AS d FROM pages))"""
MISSING = [("title", "coalesce(n, og) IS NULL"), ("description_short", "coalesce(sd, sn) IS NULL"), ("caption_image_url", "hi IS NULL"), ("developers", "len(dev) = 0"), ("publishers", "len(pub) = 0"), ("screenshots", "shots = 0"), ("price", "json_extract_string(d, '$.price_overview.final_formatted') IS NULL"), ("detailed_description", "dd IS NULL"), ("review_summary", "su IS NULL")]
ORIGIN = [("title", "n"), ("description_short", "sd"), ("caption_image_url", "hi"), ("detailed_description", "dd")]


def compact(parts: list[str]) -> str:
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


WARNINGS = joined(compact([f"CASE WHEN {rule} THEN 'missing_optional:{k}' END" for k, rule in MISSING]))
FOUND = [f"CASE WHEN NOT ({dict(MISSING)[k]}) THEN '{k}=' || CASE WHEN {c} IS NOT NULL THEN 'appdetails' ELSE 'html' END END" for k, c in ORIGIN]
FOUND += [f"CASE WHEN NOT ({dict(MISSING)[k]}) THEN '{k}=appdetails' END" for k in ("developers", "publishers", "screenshots")] + ["CASE WHEN su IS NOT NULL THEN 'review_summary=html' END"]
PROVENANCE = joined(f"list_sort({compact(FOUND)})")
SNAPSHOT_SQL = f"""WITH {STORE} SELECT page_id, coalesce(n, og) AS title, coalesce(sd, sn) AS description_short, hi AS caption_image_url, TRY_CAST(json_extract_string(d, '$.reviews') AS BIGINT) AS review_count, su AS review_summary,
    json_extract_string(d, '$.release_date.date') AS release_raw, CASE WHEN json_extract_string(d, '$.release_date.date') = 'Coming 12 Sep, 2024' THEN '2024-09-12' END AS release_date, CASE WHEN dd IS NOT NULL THEN 'A & B' END AS description,
    {joined('dev')} AS developers, {joined('pub')} AS publishers, {joined('CASE WHEN len(plain) > 0 THEN plain ELSE list_concat(ge, ca) END')} AS tags,
    {joined("list_filter(list_transform(string_split(coalesce(json_extract_string(d, '$.supported_languages'), ''), ','), lambda x: trim(x)), lambda x: x <> '')")} AS languages,
    CASE WHEN d LIKE '%"windows": true%' THEN 'windows|linux' ELSE '' END AS platforms, {WARNINGS} AS warnings, shots::INT AS screenshots, json_extract_string(d, '$.price_overview.final_formatted') AS display,
    json_extract(d, '$.price_overview.final')::BIGINT AS final, json_extract_string(d, '$.price_overview.currency') AS currency, {PROVENANCE} AS provenance FROM store"""
DATE_TEXT = f"replace(replace(replace({quoted(fixtures.DATES)}[(o_orderkey // 13) % {len(fixtures.DATES)} + 1], '{{d}}', day(o_orderdate)::VARCHAR), '{{m}}', {quoted(fixtures.MONTHS)}[o_orderkey % 13 + 1]), '{{y}}', year(o_orderdate)::VARCHAR)"
POLICY_HASH = f"sha256('{json.dumps({'high_signal_terms': sorted(t.casefold() for t in TERMS), 'large_corpus_threshold': 100, 'policy_version': 'eligibility-v1', 'repeated_character_ratio': 0.8, 'repeated_token_threshold': 3, 'short_character_threshold': 10, 'short_word_threshold': 3}, sort_keys=True, separators=(',', ':'))}')"
CAVEAT_TEXT = {
    "refunded_rate": "API refund fact is distinct from textual abandonment evidence",
    "abandonment_mention_rate": "self-reported abandonment is unverified text evidence",
    "helpfulness_visibility": "visibility weighting is separate from unweighted prevalence",
}
CAVEAT = "CASE " + " ".join(f"WHEN metric_name = '{k}' THEN '[\"{v}\"]'" for k, v in CAVEAT_TEXT.items()) + """ WHEN metric_name = 'friction_rate' AND contains(dimensions_json, '"cohort":"early"') THEN '["low playtime indicates early friction, not verified churn"]' ELSE '[]' END"""
COVERAGE_TEXT = """'{"classified_count": ' || c || ', "coverage_rate": ' || (c::DOUBLE / s) || ', "source_count": ' || s || ', "unclassified_count": ' || (s - c) || '}'"""
GREEDY = f"""{QUOTES}, scored AS (SELECT q.*, substr(sha256(seed), 1, 24) AS selection_id, {unit('seed')} + 0.8 AS score, trim(regexp_replace(lower(evidence), '{WS}+', ' ', 'g')) AS nq FROM quotes q),
best AS (SELECT *, row_number() OVER (ORDER BY score DESC, appid, recommendationid, taxonomy_id, evidence) AS i FROM scored),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS taken, []::VARCHAR[] AS seen, []::VARCHAR[] AS langs UNION ALL
    SELECT i, CASE WHEN ok THEN list_append(taken, i) ELSE taken END, CASE WHEN ok THEN list_append(seen, nq) ELSE seen END, CASE WHEN ok THEN list_append(langs, language) ELSE langs END
    FROM (SELECT b.i, w.taken, w.seen, w.langs, b.nq, b.language, NOT list_contains(w.seen, b.nq) AND len(list_filter(w.langs, lambda x: x = b.language)) < 3 AS ok FROM walk w JOIN best b ON b.i = w.i + 1 WHERE len(w.taken) < 12)),
selected AS (SELECT b.* FROM best b WHERE b.i IN (SELECT unnest(taken) FROM walk WHERE i = (SELECT max(i) FROM walk)))"""
STATUS_SQL = f"""WITH u AS (SELECT o_custkey AS run_id, count(*) AS units, count(*) FILTER (o_orderstatus = 'F') AS failed_units, string_agg(o_orderkey || ':' || CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'completed' END, '|' ORDER BY o_orderkey) AS unit_list FROM orders GROUP BY 1),
e AS (SELECT user_id AS run_id, string_agg(event_id || ' ' || event_type, '|' ORDER BY event_id) AS diagnostics FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n <= 3 GROUP BY 1)
SELECT c_custkey AS run_id, c_mktsegment AS status, CASE WHEN c_custkey % 3 = 0 THEN 'token=[redacted] failed ' || c_name END AS error_summary, coalesce(units, 0) AS units, coalesce(failed_units, 0) AS failed_units, unit_list, diagnostics
FROM customer LEFT JOIN u ON u.run_id = c_custkey LEFT JOIN e ON e.run_id = c_custkey"""

FIRST_WORD = "regexp_extract(review_text, '[A-Za-z]+')"

SQL: dict[str, str] = {
    "eligibility_decisions": f"WITH {EDGES} SELECT * FROM decided",
    "eligibility_summary": f"WITH {EDGES} SELECT decision, count(*) AS n FROM decided GROUP BY 1",
    "eligibility_current_view": f"WITH {REVIEWS}, {DECISIONS} SELECT 'new' AS policy, decision, count(*) AS n FROM decisions GROUP BY ALL",
    "review_filter_range": f"WITH {REVIEWS} SELECT appid, recommendationid, timestamp_created, playtime_at_review FROM reviews WHERE language = 'en' AND voted_up AND timestamp_created BETWEEN 1699999950 AND 1700000600 AND playtime_at_review BETWEEN 100 AND 1000",
    "language_polarity_counts": f"WITH {REVIEWS} SELECT language, voted_up, count(*) AS n FROM reviews GROUP BY ALL",
    "upsert_change_kinds": f"WITH {KINDS} SELECT * FROM kinds",
    "upsert_counts": f"WITH {KINDS} SELECT kind, count(*) AS n FROM kinds GROUP BY 1",
    "upsert_merged": f"WITH {REVIEWS}, {INCOMING} SELECT appid, recommendationid, coalesce(i.source_hash, r.source_hash) AS source_hash, CASE WHEN r.source_hash IS NULL THEN 't1' ELSE 't0' END AS first_seen_at FROM reviews r FULL JOIN incoming i USING (appid, recommendationid)",
    "stream_high_water": "SELECT user_id, event_type, floor(epoch(max(ts)))::BIGINT AS high_water FROM events GROUP BY ALL",
    "overlap_fully_known": f"WITH {REVIEWS}, {INCOMING} SELECT (i.doc_id // 2)::BIGINT AS page_id, bool_and(r.appid IS NOT NULL AND i.timestamp_updated < 1700100000 - 86400) AS known FROM incoming i LEFT JOIN reviews r ON i.appid = r.appid AND i.recommendationid = r.recommendationid AND i.timestamp_updated = r.timestamp_updated AND i.source_hash = r.source_hash GROUP BY 1",
    "reconcile_competitors": "SELECT appid, CASE WHEN active IS NULL THEN 'add' WHEN c IS NULL AND active THEN 'deactivate' WHEN c IS NOT NULL AND NOT active THEN 'activate' ELSE 'keep' END AS action FROM (SELECT DISTINCT c_nationkey::BIGINT AS appid, true AS c FROM customer) FULL JOIN (SELECT s_suppkey + 10 AS appid, s_suppkey % 2 = 0 AS active FROM supplier) USING (appid)",
    "latest_classification": f"WITH {REVIEWS}, {HISTORY} SELECT appid, recommendationid, run_id, updated_at, posture FROM latest",
    "unclassified_anti_join": f"WITH {REVIEWS}, {HISTORY} SELECT appid, recommendationid FROM reviews r WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.status = 'success' AND h.appid = r.appid AND h.recommendationid = r.recommendationid AND h.source_hash = r.source_hash)",
    "classified_flag": f"WITH {REVIEWS}, {HISTORY} SELECT appid, recommendationid, EXISTS (SELECT 1 FROM history h WHERE h.status = 'success' AND h.appid = r.appid AND h.recommendationid = r.recommendationid AND h.source_hash = r.source_hash) AS classified FROM reviews r",
    "aspects_explode": f"WITH {CURRENT} SELECT appid, recommendationid, run_id, taxonomy_id, sentiment, 0.8::DOUBLE AS confidence, evidence FROM (SELECT *, unnest(range(copies)) FROM cur)",
    "stage1_validation_errors": f"WITH {REVIEWS} SELECT appid, recommendationid, {RESULT_RULES} AS error FROM (SELECT *, review_text AS w, CASE WHEN json_valid(raw) THEN raw ELSE '0' END AS j FROM (SELECT *, {picked(fixtures.RESULTS, 'doc_id', FIRST_WORD)} AS raw FROM reviews))",
    "metric_all_ids": f"WITH {CURRENT}, {GRID} SELECT {METRIC_ID} AS metric_id, numerator, denominator FROM ({EVERY})",
    "coverage_summary": f"WITH {CURRENT} SELECT s AS source_count, c AS classified_count, greatest(0, s - c) AS unclassified_count, CASE WHEN s > 0 THEN c::DOUBLE / s END AS coverage_rate FROM (SELECT count(*) AS s FROM decisions WHERE decision = 'eligible'), (SELECT count(*) AS c FROM cur)",
    "lineage_sets": f"WITH {CURRENT} SELECT count(DISTINCT source_hash) AS source_hashes, array_to_string(list_sort(list(DISTINCT run_id)), ',') AS run_ids FROM cur",
    "evidence_candidates": f"WITH {CURRENT}, {QUOTES} SELECT appid, recommendationid, taxonomy_id, evidence, direction, substr(sha256(seed), 1, 24) AS selection_id FROM quotes",
    "evidence_scores": f"WITH {CURRENT}, {QUOTES} SELECT substr(sha256(seed), 1, 24) AS selection_id, round({unit('seed')} + 0.8, 12) AS score FROM quotes",
    "stable_score": f"WITH {REVIEWS}, {STRATA} SELECT appid, recommendationid, score FROM strata",
    "strata_sizes": f"WITH {REVIEWS}, {STRATA} SELECT appid, language, voted_up, playtime_bucket, signal, count(*) AS n FROM strata GROUP BY ALL",
    "stratified_sample": f"WITH {SAMPLE} SELECT appid, recommendationid, sampling_weight FROM chosen",
    "progressive_scope": f"WITH {SAMPLE} SELECT language, count(*) AS n FROM chosen WHERE (SELECT n FROM sizes) > 500 GROUP BY 1 UNION ALL SELECT language, count(*) FROM reviews WHERE (SELECT n FROM sizes) <= 500 GROUP BY 1",
    "token_estimates": f"WITH {REVIEWS}, {TOKENS} SELECT * FROM tokens",
    "batch_plan": f"WITH RECURSIVE {PLAN} SELECT appid, recommendationid, tokens, batch FROM plan",
    "ceiling_admission": f"WITH RECURSIVE {PLAN}, sums AS (SELECT appid, batch, sum(tokens)::BIGINT AS tokens FROM plan GROUP BY ALL), run AS (SELECT *, (sum(tokens + 4096) OVER (ORDER BY appid, batch))::BIGINT AS running FROM sums) SELECT *, running <= 400000 AS admitted FROM run",
    "eval_precision_recall": f"WITH {PAIRS} SELECT sum(len(list_intersect(gold, pred)))::DOUBLE / sum(len(pred)) AS precision, sum(len(list_intersect(gold, pred)))::DOUBLE / sum(len(gold)) AS recall FROM pairs",
    "eval_accuracy": f"WITH {PAIRS} SELECT avg((quality = guess)::INT::DOUBLE) AS quality_accuracy, avg((toxic = guess)::INT::DOUBLE) AS toxic_accuracy FROM pairs",
    "eval_omission": "SELECT m AS missing, e AS expected, m::DOUBLE / e AS omission_rate, 1 - m::DOUBLE / e AS coverage FROM (SELECT count(*) AS e, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS m FROM documents)",
    "eval_contamination": "SELECT conv_id AS batch, (count(*) FILTER (conv_id % 2 <> 0) + count(*) - count(DISTINCT turn // 2))::BIGINT AS contamination FROM conversations GROUP BY 1",
    "page_title_meta": f"SELECT page_id, {TITLE} AS title, {HEADING} AS heading, {ADVERT} AS advert FROM pages",
    "page_clean_text": f"SELECT page_id, {cleaned('html')} AS clean FROM pages",
    "store_warnings": f"SELECT array_to_string(list_filter([CASE WHEN {TITLE} = '' THEN 'missing_title' END, 'missing_image', CASE WHEN NOT regexp_matches(html, '(?is)<h1[^>]*>(.*?)</h1>') THEN 'missing_heading' END], lambda x: x IS NOT NULL), ',') AS warnings, count(*) AS n FROM pages GROUP BY 1",
    "release_date_normalize": f"SELECT o_orderkey, CASE WHEN (o_orderkey // 13) % {len(fixtures.DATES)} IN (0, 1, 3) AND o_orderkey % 13 < 12 THEN strftime(o_orderdate, '%Y') || '-' || lpad((o_orderkey % 13 + 1)::VARCHAR, 2, '0') || '-' || strftime(o_orderdate, '%d') END AS released FROM orders WHERE {DATE_TEXT} IS NOT NULL",
    "http_error_classes": "SELECT code, code IN ('rate_limited', 'server') AS retryable, count(*) AS n FROM (SELECT CASE WHEN s BETWEEN 200 AND 299 THEN NULL WHEN s = 429 THEN 'rate_limited' WHEN s IN (401, 403) THEN 'authentication' WHEN s = 404 THEN 'not_found' WHEN s BETWEEN 500 AND 599 THEN 'server' WHEN s BETWEEN 400 AND 499 THEN 'invalid_request' ELSE 'unknown' END AS code FROM (SELECT event_id % 500 + 150 AS s FROM events)) GROUP BY ALL",
    "redaction": f"SELECT doc_id, sha256({REDACTED}) AS redacted_sha256 FROM documents",
    "geography_flags": "SELECT conv_id, turn, regexp_matches(text || CASE WHEN turn % 3 = 0 THEN ' in France.' ELSE '' END, '(?i)\\b(country|countries|region|regional|located|geography|nationality|france|germany|japan|korea|spain|united states|america|europe)\\b') AS flag FROM conversations",
    "export_reviews": f"WITH {REVIEWS}, {DECISIONS} SELECT project_id, appid, recommendationid, language, voted_up, votes_up, NULL::BIGINT AS votes_funny, NULL::DOUBLE AS weighted_vote_score, NULL::BIGINT AS comment_count, NULL::BOOLEAN AS steam_purchase, NULL::BOOLEAN AS received_for_free, refunded, NULL::BOOLEAN AS written_during_early_access, NULL::BOOLEAN AS primarily_steam_deck, playtime_at_review, NULL::BIGINT AS playtime_forever, NULL::BIGINT AS playtime_last_two_weeks, NULL::BIGINT AS last_played, timestamp_created, timestamp_updated, review_text, NULL::VARCHAR AS source_review_type, source_hash, decision AS eligibility_decision, {POLICY_HASH} AS eligibility_policy_hash FROM reviews LEFT JOIN decisions USING (appid, recommendationid)",
    "export_classifications": f"WITH {CURRENT} SELECT 'p1' AS project_id, appid, recommendationid, source_hash, run_id, overall AS overall_sentiment, posture AS engagement_posture, true AS actionable, mentioned AS self_reported_abandonment FROM cur",
    "payload_top_metrics": f"WITH {CURRENT}, {GRID} SELECT {METRIC_ID} AS metric_id, metric_name, numerator, denominator FROM ({EVERY}) WHERE denominator > 0 ORDER BY 1 LIMIT 120",
    "reference_integrity": "SELECT o_orderkey, o_custkey AS custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)",
    "report_word_count": "SELECT item_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}_][\\p{L}\\p{N}_''-]*'))::BIGINT AS words FROM benchmark",
    "priority_order": "SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_quantity DESC, l_linenumber) AS priorities FROM lineitem GROUP BY 1",
    "eligibility_transitions": "SELECT doc_id, 'old' AS policy_hash, 'eligible' AS decision, CASE WHEN doc_id % 4 = 0 THEN 't3' ELSE 't1' END AS decided_at, CASE WHEN doc_id % 4 = 2 THEN 't2' END AS obsolete_at FROM documents UNION ALL SELECT doc_id, 'new', 'eligible', 't2', CASE WHEN doc_id % 4 = 0 THEN 't3' END FROM documents WHERE doc_id % 2 = 0",
    "review_order": f"WITH {REVIEWS} SELECT appid, recommendationid, row_number() OVER (PARTITION BY appid ORDER BY timestamp_created, recommendationid) AS place FROM reviews WHERE appid IN (1, 2)",
    "stage1_batch_errors": "SELECT doc_id // 5 AS batch, coalesce(arg_min(code, doc_id) FILTER (code IS NOT NULL), CASE WHEN bool_or(doc_id % 13 = 0) THEN 'missing_ids' ELSE 'ok' END) AS error FROM (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'unknown_input' WHEN doc_id % 17 = 0 THEN 'duplicate_input' END AS code FROM documents) GROUP BY 1",
    "lineage_values": f"WITH {CURRENT} SELECT DISTINCT 'source_hash' AS kind, source_hash AS value FROM cur UNION ALL SELECT DISTINCT 'classification_run_id', run_id FROM cur UNION ALL SELECT DISTINCT 'eligibility_policy_hash', {POLICY_HASH} FROM cur",
    "store_snapshots": SNAPSHOT_SQL,
    "app_details_gate": "SELECT page_id, CASE WHEN page_id % 3 = 0 AND page_id % 5 <> 0 THEN 'N' || page_id END AS name FROM pages",
    "review_page_errors": f"SELECT doc_id, {PAGE_RULES} AS error FROM (SELECT doc_id, {picked(fixtures.PAGES, 'doc_id', 'doc_id::VARCHAR')} AS j FROM documents)",
    "review_page_items": f"SELECT doc_id AS appid, doc_id::VARCHAR AS recommendationid, json_extract_string(c, '$.review') AS review_text, coalesce(json_extract_string(c, '$.votes_up')::BIGINT, 0) AS votes_up, coalesce(json_extract_string(c, '$.refunded')::BOOLEAN, false) AS refunded, 6::BIGINT AS timestamp_updated, sha256(replace(c, '@@', doc_id::VARCHAR)) AS source_hash FROM {PAGE_ITEMS}",
    "app_ids": f"SELECT c_custkey, [440, 12, NULL, NULL, NULL, 570, 7, NULL, NULL, NULL][c_custkey % {len(fixtures.ADDRESSES)} + 1]::BIGINT AS appid FROM customer",
    "utc_times": f"SELECT c_custkey, {quoted(fixtures.EXPECTED_TIMES)}[c_custkey % {len(fixtures.TIMES)} + 1] AS utc FROM customer",
    "json_validity": f"SELECT c_custkey, {quoted(fixtures.EXPECTED_VALID)}[c_custkey % {len(fixtures.JSONS)} + 1] AS valid FROM customer",
    "prompt_estimates": "SELECT conv_id, turn, greatest(1, length(text) // 4) + 4096 AS tokens FROM conversations",
    "diagnostics_stored": f"SELECT conv_id, turn, substr('stage ' || role, 1, 80) AS stage, CASE WHEN turn % 2 <> 0 THEN 'api_key: [redacted]' END AS error_classification, substr('[redacted] https://[redacted]@host/ Bearer [redacted] ' || {REDACTED}, 1, 500) AS message FROM conversations",
    "json_redaction": f"SELECT conv_id, turn, {REDACTED} AS note, '[redacted]' AS secret, 'token=[redacted]' AS say, '[redacted]: [redacted]' AS first, 'fine' AS second FROM conversations",
    "manifest_keys": """SELECT event_id, '{"deep":[{"kept":"' || event_type || '"}],"user":' || user_id || '}' AS manifest FROM events""",
    "status_view": STATUS_SQL,
    "latest_completed_runs": "SELECT o_custkey AS project_id, o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "snapshot_history": "WITH rows AS (SELECT l_partkey AS appid, l_orderkey || '-' || l_linenumber AS snapshot_id, max(l_shipdate) AS fetched_at, max(l_suppkey % 2) AS source_hash FROM lineitem GROUP BY ALL) SELECT appid, snapshot_id, row_number() OVER (PARTITION BY appid ORDER BY fetched_at DESC, snapshot_id DESC) AS place, coalesce(lag(source_hash) OVER (PARTITION BY appid ORDER BY fetched_at, snapshot_id) <> source_hash, true) AS changed FROM rows",
    "export_aspects": f"WITH {CURRENT} SELECT 'p1' AS project_id, appid, recommendationid, source_hash, run_id, taxonomy_id, sentiment, 0.8::DOUBLE AS confidence, evidence FROM (SELECT *, unnest(range(copies)) FROM cur)",
    "export_aggregates": f"WITH {CURRENT}, {GRID} SELECT 'run-a' AS run_id, {METRIC_ID} AS metric_id, metric_name, replace(replace(dimensions_json, '\":\"', '\": \"'), '\",\"', '\", \"') AS dimensions_json, numerator, denominator, value, CASE metric_name WHEN 'review_count' THEN 'eligible classified reviews' WHEN 'helpfulness_visibility' THEN 'up-vote visibility among classified reviews of polarity' WHEN 'friction_rate' THEN 'classified reviews in playtime cohort' ELSE 'classified reviews of polarity' END AS population_definition, {COVERAGE_TEXT} AS coverage_json, {CAVEAT} AS caveats_json FROM ({EVERY}), (SELECT (SELECT count(*) FROM decisions WHERE decision = 'eligible') AS s, (SELECT count(*) FROM cur) AS c)",
    "export_quotes": f"WITH RECURSIVE {CURRENT}, {GREEDY} SELECT 'run-a' AS run_id, selection_id, 'p1' AS project_id, s.appid, s.recommendationid, taxonomy_id, evidence, 'confidence_then_stable_diversity' AS selection_reason, direction, s.language, r.source_hash FROM selected s JOIN reviews r USING (appid, recommendationid)",
    "evidence_selected": f"WITH RECURSIVE {CURRENT}, {GREEDY} SELECT appid, recommendationid, language, evidence, selection_id FROM selected",
    "metric_reference_errors": "SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN 'identity' WHEN doc_id % 5 < 1 OR doc_id % 4 = 0 THEN 'denominator' WHEN doc_id % 3 <> 0 AND doc_id % 13 > 10 THEN 'value' WHEN doc_id % 17 = 0 THEN 'geography' ELSE 'ok' END AS error FROM documents",
    "recommendation_errors": "SELECT doc_id, CASE WHEN doc_id % 9 < 1 OR doc_id % 10 = 3 THEN 'required' WHEN doc_id % 12 = 5 OR (doc_id % 2 <> 0 AND doc_id % 13 = 6) THEN 'impact_or_effort' WHEN doc_id % 14 = 7 THEN 'confidence' WHEN doc_id % 15 = 8 OR doc_id % 16 = 9 THEN 'unknown_evidence' WHEN doc_id % 11 = 4 THEN 'geography' ELSE 'ok' END AS error FROM documents",
    "brief_errors": "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'status' WHEN doc_id % 10 > 8 THEN 'too_many_findings' WHEN doc_id % 12 > 10 THEN 'too_many_priorities' WHEN doc_id % 13 <> 0 AND doc_id % 11 > 8 THEN 'too_many_risks' WHEN doc_id % 9 > 8 THEN 'too_many_vulnerabilities' WHEN doc_id % 7 = 1 AND doc_id % 2 = 0 THEN 'caveat' WHEN doc_id % 13 = 0 AND doc_id % 3 > 0 THEN 'geography' ELSE 'ok' END AS error FROM documents",
}
for _name, _sql in FAMILIES.items():
    SQL[f"metric_{_name}"] = f"WITH {CURRENT}, {GRID} {_sql}"
