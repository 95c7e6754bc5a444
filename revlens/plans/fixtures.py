"""Inputs that the given tables lack, made from their rows in the same way by Spark and by the SQL that checks it."""

from __future__ import annotations

import json

#: A result as a provider gives it; "@@" stands for a word of the review.
RESULT = {
    "input_id": "id",
    "review_id": "id",
    "is_actionable": True,
    "engagement_posture": "mixed",
    "overall_sentiment": "negative",
    "sentiment_intensity": 3,
    "aspects": [{"taxonomy_id": "core.c1", "sentiment": "mixed", "intensity": 2, "evidence": "@@", "feature_request": None, "confidence": 0.5}],
    "use_cases": [],
    "self_reported_abandonment": {"mentioned": None, "statement_type": None, "evidence": None, "verified": False},
    "summary": "",
}


def _with(**fields) -> str:
    return json.dumps(RESULT | fields)


def _aspect(**fields) -> str:
    return json.dumps(RESULT | {"aspects": [RESULT["aspects"][0], RESULT["aspects"][0] | fields]})


#: Results, most of them broken in one way.
RESULTS = (
    json.dumps(RESULT), "[1]", "{", _with(input_id=7), json.dumps({k: v for k, v in RESULT.items() if k != "summary"}), _with(engagement_posture="happy"), _with(overall_sentiment=1), _with(sentiment_intensity="3"),
    _with(sentiment_intensity=True), _with(sentiment_intensity=3.5), _with(sentiment_intensity=6), _with(aspects=None), _with(aspects=[1]), _with(aspects=[{"sentiment": "mixed"}]), _aspect(taxonomy_id="none"),
    _aspect(sentiment="good"), _aspect(intensity=9), _aspect(confidence=1.5), _aspect(evidence=" "), _aspect(evidence="@@ not there"), _with(self_reported_abandonment=3),
    _with(self_reported_abandonment={"verified": True}), _with(self_reported_abandonment={"verified": False, "statement_type": "left"}), _with(self_reported_abandonment={"verified": False, "statement_type": "refund"}), _with(aspects=[]),
)

ITEM = {"voted_up": True, "recommendationid": "@@", "language": "english", "review": "fine é", "timestamp_created": 5, "timestamp_updated": 6}


def _page(item, **fields) -> str:
    return json.dumps({"success": 1, "cursor": "*", "reviews": [ITEM, item]} | fields, ensure_ascii=False)


#: Pages of reviews; "@@" stands for an id.
PAGES = (
    _page(ITEM), _page(ITEM | {"votes_up": 3, "extra": {"b": 1, "a": [2]}}), "[]", _page(ITEM, success=2), _page(ITEM, cursor=None), _page(ITEM, reviews={}), _page(4),
    _page({k: v for k, v in ITEM.items() if k != "language"}), _page(ITEM | {"timestamp_updated": "soon"}), _page(ITEM | {"votes_up": "many"}), _page(ITEM | {"votes_up": "7", "refunded": True}),
)

#: Details of an app; "@@" stands for an id.
DETAILS = (
    "", "{", json.dumps({"name": "App @@", "short_description": "", "developers": ["Dev A", "Dev B"], "publishers": [], "genres": [{"description": "Action"}, {"id": 3}], "categories": [{"description": "Co-op"}], "reviews": "17"}),
    json.dumps({"name": "App @@", "short_description": "Short.", "header_image": "http://x/@@.jpg", "detailed_description": "<p>A &amp; B</p>", "developers": ["Dev"], "publishers": ["Pub"], "screenshots": [{"path_full": "f1", "path_thumbnail": "t1"}, {"path_thumbnail": "t2"}],
                "categories": [{"description": "Co-op"}, "Plain", "Other"], "price_overview": {"final_formatted": "9,99", "initial": 1999, "final": 999, "discount_percent": 50, "currency": "EUR"}, "release_date": {"date": "Coming 12 Sep, 2024"},
                "platforms": {"windows": True, "mac": False, "linux": True}, "supported_languages": "English, French , "}),
)
SNIPPETS = ("", '<meta property="og:title" content="T&amp;C &#8217;@@"><div class="big_game_description_snippet x">From <b>page</b> &eacute;</div>', '<span class="user_reviews_summary_row">Mostly fine</span>')

ADDRESSES = ("440", " 12 ", "0", "-5", "x", "https://store.steampowered.com/app/570/Name/", "http://steampowered.com/app/7", "https://store.steampowered.com/app/0570/", "https://example.com/app/5/", "")
TIMES = ("2024-03-01T10:20:30Z", "2024-03-01T01:20:30+02:00", "2024-02-29T23:59:59-0130", "2024-03-01T10:20:30", "2024-13-01T10:20:30Z", "soon")
EXPECTED_TIMES = ("2024-03-01T10:20:30Z", "2024-02-29T23:20:30Z", "2024-03-01T01:29:59Z", None, None, None)
JSONS = ('{"a": [1, 2]}', "[1", "null", "", '"x"', "{'a': 1}", "1.5e3", "nope")
EXPECTED_VALID = (True, False, True, False, True, False, True, False)
DATES = ("Coming {d} {m}, {y}", "{d} {m} {y} (PC)", "Q4 {y}", "{d} {m}, {y}", "{m} {d}, {y}")
MONTHS = ("January", "Feb", "March", "Apr", "May", "June", "Jul", "Aug", "Sept", "Oct", "November", "Dec", "Soon")
