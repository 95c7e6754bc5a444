"""As-of joins, prefix sums under ceilings, estimates and taxonomies against brute force and seeded runs."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import asof, estimates, publish, selection, state, taxonomy, usage
from revlens.operators.metrics import RETENTION, retention_labels

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [7, 1000])
def test_as_of_against_brute_force(spark, width):
    """One key has most rows; times tie; keys and times are null; columns of both sides have the same names."""
    rng = random.Random(width)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    log = [(key(), rng.choice([None, *range(-20, 60)]), k, rng.choice(["a", "b", None])) for k in range(400)]
    asked = [(key(), rng.choice([None, *range(-25, 70)]), k, "own") for k in range(300)]
    left = spark.createDataFrame(asked, "k long, t long, n long, tie string")
    right = spark.createDataFrame(log, "k long, at long, tie long, v string")
    got = {r["n"]: (r["found"], r["v"], r["tie"]) for r in asof.as_of(left, right.withColumn("found", F.col("tie")), ["k"], "t", "at", ["found", "v"], width=width, ties=["tie"]).collect()}
    for k, t, n, own in asked:
        before = [(at, tie, v) for kk, at, tie, v in log if k is not None and t is not None and kk == k and at is not None and at <= t]
        best = max(before, key=lambda x: x[:2], default=(None, None, None))
        assert got[n] == (best[1], best[2], own)
    assert len(got) == len(asked)


def test_as_of_cuts_only_large_and_null_keys_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(asof, "MANY", 150)
    test_as_of_against_brute_force(spark, 7)
    small = spark.createDataFrame([(k % 50, k) for k in range(500)], "k long, t long")
    out = asof.as_of(small, small.select("k", F.col("t").alias("at"), F.col("t").alias("v")), ["k"], "t", "at", ["v"], width=1)
    out.collect()
    assert out.count() == 500 and out.filter("v = t").count() == 500


def test_as_of_has_no_cross_join_and_empty_tables_work(spark):
    left, right = spark.createDataFrame([], "k long, t long"), spark.createDataFrame([(1, 2, "x")], "k long, at long, v string")
    out = asof.as_of(left, right, ["k"], "t", "at", ["v"], width=10)
    assert out.collect() == []
    assert asof.as_of(right.select("k", F.col("at").alias("t")), right.limit(0), ["k"], "t", "at", ["v"], width=10).collect()[0]["v"] is None
    assert "Cartesian" not in plan_of(out) and "NestedLoop" not in plan_of(out)


def test_intervals_of_equal_times(spark):
    log = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 9, "c"), (2, 1, "d")], "k long, at long, policy string")
    got = sorted((r["k"], r["policy"], r["valid_from"], r["valid_to"]) for r in asof.intervals(log, ["k"], "at", ["policy"]).collect())
    assert got == [(1, "a", 5, 5), (1, "b", 5, 9), (1, "c", 9, None), (2, "d", 1, None)]


def test_ceilings_on_a_million_batches_against_a_loop(spark):
    n = 1_000_000
    rows = spark.range(0, n, 1, 12).select(F.col("id").alias("batch"), (F.xxhash64("id") % 50).alias("x")).select("batch", (F.col("x") + 60).alias("estimated_tokens"), (F.abs("x") % 3 + 1).alias("requests"), (F.abs("x") + 20).alias("tokens"), (F.abs("x") * 7 + 1).alias("cost"))
    ceilings = usage.Ceilings(requests=1_500_000, tokens=33_000_000, cost=150_000_000)
    out = usage.admitted(rows, ["batch"], ceilings, 100)
    plan = plan_of(out)
    for line in plan.splitlines():
        assert "SinglePartition" not in line or "partial_min" in plan  # only the first refused batch, a row a task
    assert "Window" in plan and "windowspecdefinition(batch" not in plan  # every window is partitioned
    got = out.select("batch", "requests_before", "tokens_before", "cost_before", "admitted").toPandas().sort_values("batch").reset_index(drop=True)
    have = rows.toPandas().sort_values("batch").reset_index(drop=True)
    used, stopped, want = [0, 0, 0], False, []
    for estimate, requests, tokens, cost in have[["estimated_tokens", "requests", "tokens", "cost"]].itertuples(index=False):
        stopped = stopped or used[0] >= ceilings.requests or used[1] >= ceilings.tokens or used[2] >= ceilings.cost or used[1] + estimate + 100 > ceilings.tokens
        want.append((*used, not stopped))
        used = [used[0] + requests, used[1] + tokens, used[2] + cost]
    assert list(got[["requests_before", "tokens_before", "cost_before", "admitted"]].itertuples(index=False, name=None)) == want
    assert 0 < got["admitted"].sum() < n


def test_no_ceiling_and_no_batches(spark):
    rows = spark.createDataFrame([(1, 5, 1, 5, 1), (2, 5, 1, 5, None)], "b long, estimated_tokens long, requests long, tokens long, cost long")
    assert [r["admitted"] for r in usage.admitted(rows, ["b"], usage.Ceilings()).collect()] == [True, True]
    assert usage.admitted(rows.limit(0), ["b"], usage.Ceilings(requests=1)).collect() == []


def test_estimates_cover_the_full_count(spark):
    """Over many seeds, the intervals of 95 % hold the true number about that often, and the estimates are right on average."""
    people = spark.range(1500).select(F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("language"), (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(5)) % 4).alias("stratum"), "id", (F.pmod(F.xxhash64("id"), F.lit(10)) < 3).alias("y")).cache()
    true = {r["language"]: r["n"] for r in people.groupBy("language").agg(F.count_if("y").alias("n")).collect()}
    covered, sums, seeds = 0, dict.fromkeys(true, 0.0), 8
    for seed in range(seeds):
        sample = people.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(100)) < 15)
        out = estimates.totals(people, sample, ["language", "stratum"], ["language"], {"y": F.col("y")}).collect()
        covered += sum(r["low"] <= true[r["language"]] <= r["high"] for r in out)
        for r in out:
            sums[r["language"]] += r["total"] / seeds
    assert covered >= 0.85 * 3 * seeds
    assert all(abs(sums[k] - true[k]) < 0.1 * true[k] for k in true)


def test_a_whole_sample_has_no_variance_and_single_draws_have_one(spark):
    rows = spark.createDataFrame([("a", 1, True), ("a", 1, None), ("a", 2, True), ("a", 2, False), (None, 3, True)], "language string, s long, y boolean")
    whole = {r["language"]: r for r in estimates.totals(rows, rows, ["language", "s"], ["language"], {"y": F.col("y")}).collect()}
    assert whole["a"]["total"] == 2 and whole["a"]["variance"] == 0 and whole[None]["total"] == 1
    one = rows.filter("s = 1 and y or s = 2 and not y")
    out = estimates.totals(rows, one, ["language", "s"], ["language"], {"y": F.col("y")}).filter("language = 'a'").collect()[0]
    assert out["total"] == 2 and out["variance"] == pytest.approx(2 * (4 * 0.5 * 0.5 / 1))
    assert selection.STRATUM[1] == "language"


NODES = "id string, parent_id string, name string"


def test_taxonomy_problems_and_merging(spark):
    core = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "b", "C")], NODES)
    fine = taxonomy.merged(core, spark.createDataFrame([("c", "b", "C"), ("d", "c", "D")], NODES))
    assert taxonomy.problems(fine).collect() == [] and fine.count() == 4
    assert {(r["id"], r["ancestor"], r["distance"]) for r in taxonomy.closure(fine).filter("id = 'd'").collect()} == {("d", "d", 0), ("d", "c", 1), ("d", "b", 2), ("d", "a", 3)}
    bad = taxonomy.merged(core, spark.createDataFrame([("c", "a", "C"), ("e", "nobody", "E"), ("f", "g", "F"), ("g", "f", "G"), ("h", "f", "H"), ("i", "i", "I"), (None, None, "x"), ("k", None, " ")], NODES))
    got = {(r["id"], r["problem"]) for r in taxonomy.problems(bad).collect()}
    assert got == {("c", "conflict"), ("e", "unknown_parent"), ("f", "cycle"), ("g", "cycle"), ("h", "cycle"), ("i", "cycle"), (None, "blank"), ("k", "blank")}
    assert taxonomy.closure(core.limit(0)).collect() == []


def test_deep_taxonomies_and_joined_ways(spark):
    deep = spark.range(300).selectExpr("cast(id as string) as id", "if(id = 0, null, cast(id - 1 as string)) as parent_id", "'n' as name")
    assert taxonomy.closure(deep).agg(F.count("*"), F.max("distance"), F.sum("distance")).collect()[0] == (300 * 301 // 2, 299, sum(k * (k + 1) // 2 for k in range(300)))
    assert taxonomy.problems(deep).collect() == []
    rows = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("d", "a"), ("e", "d"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "e"), ("w", "x"), ("v", "w"), ("u", "nobody")]
    mixed = spark.createDataFrame([(i, p, "n") for i, p in rows], NODES)
    up: dict = {(i, i): 0 for i, _ in rows}
    known = {i for i, _ in rows}
    for _ in range(20):
        for (i, a), n in list(up.items()):
            for j, p in rows:
                if j == a and p in known:
                    up[i, p] = min(up.get((i, p), n + 1), n + 1)
    assert {(r["id"], r["ancestor"]): r["distance"] for r in taxonomy.closure(mixed).collect()} == up
    assert {r["id"] for r in taxonomy.problems(mixed).filter("problem = 'cycle'").collect()} == {"x", "y", "z", "w", "v"}


def test_reviews_count_once_below_an_ancestor(spark):
    nodes = spark.createDataFrame([("root", None, "r"), ("x", "root", "x"), ("y", "root", "y")], NODES)
    aspects = "array<struct<taxonomy_id:string,sentiment:string>>"
    rows = spark.createDataFrame([("en", ([("x", "positive"), ("y", "positive"), ("x", "negative")],)), ("en", ([("z", "mixed"), (None, "mixed")],)), ("en", (None,)), ("de", ([],))], f"language string, result struct<aspects:{aspects}>")
    got = {(r["taxonomy_id"], r["sentiment"]): (r["numerator"], r["denominator"], r["depth"]) for r in taxonomy.rolled_up(rows, nodes, ["language"]).collect()}
    assert got["root", "positive"] == (1, 3, 0) and got["root", "negative"] == (1, 3, 0) and got["x", "positive"] == (1, 3, 1)
    assert got["z", "mixed"] == (1, 3, 0) and got["root", "mixed"] == (0, 3, 0) and len(got) == 16


def test_retention_labels_of_unknown_playtime_and_missing_results(spark):
    result = "struct<engagement_posture:string,is_actionable:boolean,overall_sentiment:string,sentiment_intensity:int,aspects:array<struct<sentiment:string>>>"
    rows = [(None, False, ("rejection", True, "negative", 5, [])), (10, False, ("rejection", False, "negative", 5, [])), (700, True, ("frustrated_but_engaged", True, "mixed", 2, [("negative",)])), (5, True, ("advocacy", True, "positive", 4, None)), (5, True, None)]
    got = [r["l"] for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k int, playtime_at_review long, voted_up boolean, result {result}").select("k", retention_labels().alias("l")).orderBy("k").collect()]
    assert got == [[], ["early_rejection"], ["invested_frustration", "qualified_retention"], ["strong_advocacy"], []]
    assert len(RETENTION) == 7


def test_briefs_break_each_rule_in_order(spark):
    lists = list(publish.BRIEF_LISTS)
    cases = {"fine": [(x, "t", 8) for x in lists], "none": [], "bare": [], "status": [(lists[0], "t", 20)], "version": []}
    cases |= {f"many_{x}": [(x, "t", 11), (lists[-1], "in Germany", 1)] for x in lists}
    cases |= {f"place_{x}": [(x, "sell in Germany", 1), (x, None, 1)] for x in (*lists, "caveats")}
    items = spark.createDataFrame([(k, x, t) for k, v in cases.items() for x, t, n in v for _ in range(n)], "brief_id string, list string, text string")
    briefs = spark.createDataFrame([(k, "done" if k == "status" else "insufficient_evidence" if k == "bare" else "complete", None if k == "version" else publish.BRIEF_VERSION) for k in cases], "brief_id string, status string, schema_version string")
    got = {r["brief_id"]: r["error"] for r in publish.brief_table_errors(briefs, items).collect()}
    want = {"fine": None, "none": None, "bare": "caveat", "status": "status_or_version", "version": "status_or_version"} | {f"many_{x}": f"too_many_{x}" for x in lists}
    want |= {f"place_{x}": None if x in ("recommendations", "caveats") else "geography" for x in (*lists, "caveats")}
    assert got == want


def test_payloads_break_each_rule_in_order(spark):
    ids = ["fine", "identity", "version", "metrics", "evidence", "raw", "twice"]
    payloads = spark.createDataFrame([(k, "" if k == "identity" else "p", "r", "v0" if k == "version" else publish.BRIEF_VERSION) for k in ids], "payload_id string, project_id string, run_id string, schema_version string")
    named = spark.createDataFrame([("metrics", f"m{n}") for n in range(121)] + [("fine", f"m{n}") for n in range(120)] + [("twice", "m"), ("twice", "m"), ("raw", "m"), ("raw", "m")], "payload_id string, metric_id string")
    proof = spark.createDataFrame([("evidence",)] * 25 + [("fine",)] * 24, "payload_id string")
    rivals = spark.createDataFrame([("raw", '{"raw_json": 1}'), ("fine", '{"title": "review_text"}'), ("fine", None), ("fine", "no json")], "payload_id string, fields string")
    got = {r["payload_id"]: r["error"] for r in publish.payload_errors(payloads, named, proof, rivals).collect()}
    assert got == {"fine": None, "identity": "identity", "version": "version", "metrics": "too_many", "evidence": "too_many", "raw": "raw_fields", "twice": "duplicate_metric"}


def test_rows_of_all_given_runs_are_read(spark, tmp_path):
    """More runs than once were read; rows are stored for three of them."""
    ids = spark.range(10_005).select(F.format_string("r%05d", "id").alias("run_id"))
    ids.filter("run_id in ('r00000', 'r07000', 'r10004')").withColumn("x", F.lit(1)).write.partitionBy("run_id").parquet(str(tmp_path / "runs"))
    assert state.run_rows(spark, str(tmp_path / "runs"), ids).count() == 3
    assert state.run_rows(spark, str(tmp_path / "runs"), ids.filter("run_id = 'r10004'")).count() == 1
