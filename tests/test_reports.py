"""Citations, places in a global order and competitors against loops, with ties, nulls, a hot key and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import reports

ORDER = ["at", "id"]


def test_citations_against_a_loop(spark):
    rng = random.Random(2)
    metrics, reviews = {f"m{k}": (k, k + 1) for k in range(9)}, {f"r{k}": f"s{k}" for k in range(5)}
    recs = [(b, rank, f"t{rank}" if rank % 4 else None, rng.choice([None, [], [f"m{rng.randrange(12)}" for _ in range(rng.randrange(6))]]), [f"r{rng.randrange(8)}" for _ in range(rng.randrange(4))]) for b in (1, 2, None) for rank in range(1, 15)]
    df = spark.createDataFrame(recs, "brief_id long, rank int, title string, metric_ids array<string>, review_ids array<string>")
    m = spark.createDataFrame([(k, *v) for k, v in metrics.items()], "metric_id string, numerator int, denominator int")
    e = spark.createDataFrame(list(reviews.items()), "review_id string, selection_id string")
    want = set()
    for b, rank, title, ms, rs in recs:
        refs = [f"`metric:{x}` ({metrics[x][0]}/{metrics[x][1]})" for x in ms or [] if x in metrics] + [f"`review:{x}` (`selection:{reviews[x]}`)" for x in rs if x in reviews]
        want.add((b, rank, f"### {rank}. {title or ''}", "; ".join(refs) or "No direct citation"))
    assert {tuple(r) for r in reports.citations(df, m, e).collect()} == want
    assert reports.citations(df.limit(0), m, e).count() == 0
    got = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>").select(reports.bullets(F.col("x"))).collect()
    assert [r[0] for r in got] == ["- a\n- b", "- None reported."]


@pytest.mark.parametrize("parts", [1, 9])
def test_places_do_not_depend_on_partitions(spark, parts):
    rng = random.Random(4)
    apps = [(k, lang) for k in range(1, 30) for lang in ("english", "french", "russian") if rng.random() < 0.8]
    df = spark.createDataFrame(apps, "appid long, language string").repartition(parts)
    got = [(r["appid"], r["language"], r["line"]) for r in sorted(reports.group_lines(df, [F.col("appid"), F.lit(None)]).collect(), key=lambda r: r["place"])]
    assert got == [(str(a), x, f"| {a} |  |") for a, x in sorted(apps, key=lambda t: (str(t[0]), t[1]))]
    rows = [("hot" if k % 3 else "p", k % 5, f"t{k % 40:02d}") for k in range(600)]
    out = reports.snapshot_log(spark.createDataFrame(rows, "project_id string, appid long, fetched_at string").repartition(parts))
    assert [r["snapshot_id"] for r in sorted(out.collect(), key=lambda r: r["place"])] == [f"{p}:{a}:{t}" for p, t, a in sorted({(p, t, a) for p, a, t in rows})]
    assert out.agg(F.max("place")).first()[0] == out.count()


def test_first_seen_and_active_competitors(spark):
    rng = random.Random(6)
    rows = [("hot" if k % 3 else None, rng.choice(["a", "b", "c", None]), rng.randrange(20), k) for k in range(300)]
    df = spark.createDataFrame(rows, "key string, value string, at int, id int")
    got = {(r["key"], r["place"]): r["value"] for r in reports.first_seen(df, ["key"], "value", ORDER).collect()}
    for key in ("hot", None):
        seen = list(dict.fromkeys(v for k, v, _, _ in sorted(rows, key=lambda r: r[2:]) if k == key))
        assert [got[key, i] for i in range(1, len(seen) + 1)] == seen
    log = [(k % 3, rng.randrange(6), rng.choice([True, False, None]), rng.randrange(9), k) for k in range(200)]
    df = spark.createDataFrame(log, "project_id long, appid long, active boolean, at int, id int")
    last = {}
    for p, a, active, *_ in sorted(log, key=lambda r: r[3:]):
        last[p, a] = active
    want = {(p, i, a, f"https://store.steampowered.com/app/{a}/") for p in range(3) for i, a in enumerate(sorted(a for q, a in last if q == p and last[q, a]), 1)}
    assert {tuple(r) for r in reports.active_competitors(df, ORDER).collect()} == want
