"""Operators that SQL does not state: greedy evidence, batches with a provider, streaming upserts, export."""

import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens import config
from revlens.config import BatchLimits, EvidenceLimits, FilterPolicy, Selection
from revlens.functions import text as X
from revlens.operators import classify, evidence, metrics, publish, selection, state
from revlens.plans import reviews as R
from revlens.sources import readers
from revlens.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_eligibility_rules(spark):
    want = {"": "excluded_empty", " \t": "excluded_empty", "!!!...": "excluded_punctuation", "！？。。": "excluded_punctuation", "ha ha ha ha": "excluded_repetition", "/\\|_-=+*#": "excluded_ascii_art", "crash": "eligible", "ошибка": "eligible", "a fine long review": "eligible"}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    for size, ok in ((10_000, "eligible"), (10_001, "excluded_low_information")):
        got = {r["t"]: r["d"] for r in df.unionByName(spark.createDataFrame([("ok",)], "t string")).select("t", X.eligibility(F.col("t"), size, FilterPolicy()).alias("d")).collect()}
        assert got == want | {"ok": ok}


def test_repetition_against_brute_force(spark):
    """Random texts over few characters, with runs, one-token texts and marks that join tokens."""
    draw = random.Random(3)
    units = ("ab", "a ", "Aa b", "a！ é", "aß-s ", "a.", "_1 ", "A ")
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(1, 40))) for some in (draw.choices(units, k=draw.randrange(1, 5)) for _ in range(1500))]
    texts += [w * k for w in ("ha ", "Ha, hA! ", "a！a ", "- ", "aaaab", "aaab") for k in (1, 2, 3, 7, 40)] + ["a" * 79 + "b" * 20, "a" * 80 + "b" * 20]

    def repeats(text):
        m = "".join(c for c in text if not c.isspace())
        if m and max(Counter(m).values()) / len(m) >= 0.8:
            return len(m) >= 3
        words = [w.replace("ß", "ss").lower() for w in re.findall("\\b[\\w\u0080-\uffff]+\\b", text)]
        return len(words) >= 3 and len(set(words)) == 1

    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string").filter(X.meaningful(t) != "")
    got = df.select("t", X.is_repetition(t, X.meaningful(t), FilterPolicy()).alias("r")).collect()
    assert [(r["t"], r["r"]) for r in got if r["r"] != repeats(r["t"])] == []
    assert sum(r["r"] for r in got) > 50


def test_evidence_is_greedy(spark):
    rows = evidence.candidates(R.current(spark, SF), R.PROJECT)
    limits = EvidenceLimits(limit=6, per_language=2)
    every = sorted(rows.withColumn("q", X.normalized_quote(F.col("evidence"))).collect(), key=lambda r: (-r["score"], r["appid"], r["recommendationid"], r["taxonomy_id"], r["evidence"]))
    taken, per, seen = [], {}, set()
    for r in every:
        if len(taken) < 6 and per.get(r["language"], 0) < 2 and r["q"] not in seen:
            taken.append(r["selection_id"])
            per[r["language"]] = per.get(r["language"], 0) + 1
            seen.add(r["q"])
    assert [r["selection_id"] for r in evidence.select(rows, limits).orderBy(*evidence.ordering()).collect()] == taken


def test_provider_batches(spark):
    planned = spark.createDataFrame([(1, k // 4, f"i{k}", "{}") for k in range(12)], "appid long, batch long, input_id string, payload string")

    def provider(items):
        ids = [x["input_id"] for x in items]
        if "i9" in ids and len(ids) > 1:
            return [{"input_id": "other"}]
        if "i5" in ids:
            raise RuntimeError("refused")
        return [{"input_id": x} for x in ids]

    got = {r["input_id"]: r["status"] for r in classify.run_batches(planned, provider).collect()}
    assert got == {f"i{k}": "failed" if 4 <= k < 8 else "success" for k in range(12)}


def test_streaming_upsert(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()

    def drop(name, rows):
        (source / name).write_text("\n".join(json.dumps({"appid": 1, "recommendationid": k, "voted_up": v, "timestamp_updated": t, "source_hash": h}) for k, v, t, h in rows))

    drop("a.json", [("1", True, 10, "x"), ("2", True, 11, "y")])
    ingest.ingest(spark, str(source), out, str(tmp_path / "cp")).awaitTermination()
    drop("b.json", [("1", False, 20, "z"), ("2", True, 11, "y"), ("3", True, 5, "late")])
    ingest.ingest(spark, str(source), out, str(tmp_path / "cp")).awaitTermination()
    got = {r["recommendationid"]: (r["voted_up"], r["kind"], r["first_seen_at"]) for r in ingest.current(spark, out).collect()}
    assert got == {"1": (False, "changed", 10), "2": (True, "new", 11), "3": (True, "new", 5)}
    assert ingest.history(spark, out).count() == 4


def test_export_and_report(spark, tmp_path):
    rows = R.reviews(spark, SF)
    manifest = publish.export_parquet({"reviews": rows}, str(tmp_path), {"run": "r1"})
    back = spark.read.parquet(str(tmp_path / "reviews"))
    assert manifest["datasets"]["reviews"]["rows"] == rows.count() and len(back.columns) == 25
    assert not (tmp_path / "_aside").exists()
    report = publish.render_report("Brief", [{"rank": 2, "text": "b"}, {"rank": 1, "text": "a", "metrics": ["m"]}], [{"metric_id": "m", "numerator": 1, "denominator": 2}], [], least=1, most=100)
    assert report.index("1. a") < report.index("metric:m (1/2)") < report.index("2. b")
    with pytest.raises(ValueError):
        publish.render_report("Brief", [], [], [])


def test_pages_and_limits(spark, tmp_path):
    item = {"recommendationid": "1", "language": "english", "review": "r", "voted_up": True, "timestamp_created": 1, "timestamp_updated": 2}
    pages = [{"success": 1, "cursor": "*", "reviews": [item]}, {"success": 1, "cursor": "*", "reviews": [{"recommendationid": "2"}]}, {"success": 2}, {"success": 1, "reviews": []}]
    for k, page in enumerate(pages):
        (tmp_path / f"{k}.json").write_text(json.dumps(page))
    got = readers.review_pages(spark, str(tmp_path)).withColumn("error", readers.page_error(F.col("raw")))
    assert sorted(r["error"] or "" for r in got.collect()) == ["", "cursor", "item_fields", "not_successful"]
    (row,) = readers.page_reviews(got, "p", F.lit(5)).collect()
    assert (row["votes_up"], row["refunded"], row["appid"]) == (0, False, 5)
    for broken in (lambda: BatchLimits(max_items=0), lambda: EvidenceLimits(limit=0)):
        with pytest.raises(ValueError):
            broken()
    with pytest.raises(ValueError):
        selection.select_inputs(R.reviews(spark, SF), Selection("some"), "p")
    states = spark.createDataFrame([("pending", "running"), ("running", "pending"), ("running", "partial"), ("completed", "running")], "a string, b string")
    assert [r[0] for r in states.select(state.transition_allowed(F.col("a"), F.col("b"))).collect()] == [True, False, True, False]


def slow_plan(items, limits):
    """Greedy batches in id order: the item that would be one too many or pass the token limit opens the next."""
    out, state = {}, {}
    for app, ident, tokens in sorted(items):
        if tokens > limits.max_tokens:
            out[app, ident] = None
            continue
        batch, n, total = state.get(app, (0, 0, 0))
        if n and (n >= limits.max_items or total + tokens > limits.max_tokens):
            batch, n, total = batch + 1, 0, 0
        state[app] = (batch, n + 1, total + tokens)
        out[app, ident] = batch
    return out


@pytest.mark.parametrize("block", [3, 7, 50, 20_000])
def test_batches_against_brute_force(spark, block):
    """The plan is the same whatever the block's size; items that are too large get no batch."""
    draw = random.Random(block)
    items = [(app, f"{k:04d}", draw.choice((1, 5, 30, 90, 101))) for app, n in ((1, 400), (2, 1), (3, 7), (4, 60)) for k in range(n)]
    df = spark.createDataFrame(items, "appid long, recommendationid string, tokens long").repartition(5)
    limits = BatchLimits(max_items=draw.choice((1, 4, 20)), max_tokens=100)
    got = {(r["appid"], r["recommendationid"]): r["batch"] for r in selection.plan_batches(df, limits, block).collect()}
    assert got == slow_plan(items, limits)


def test_top_by_score(spark):
    draw = random.Random(1)
    rows = [(1, f"{k}", draw.choice((0.0, 0.25, 0.2500001, 1.0, draw.random()))) for k in range(500)]
    df = spark.createDataFrame(rows, "appid long, recommendationid string, score double")
    for n in (1, 100, 250, 499, 500, 900):
        want = {r[1] for r in sorted(rows, key=lambda r: (r[2], r[0], r[1]))[:n]}
        assert {r["recommendationid"] for r in selection.top_by_score(df, n).collect()} == want


def test_policy_and_redaction(spark):
    one, other = FilterPolicy(high_signal_terms=("Crash", "lag")), FilterPolicy(high_signal_terms=("LAG", "crash"))
    assert one.hash() == other.hash() != FilterPolicy().hash()
    df = spark.createDataFrame([("CRASH", "a\0b hunter2 password: x"), ("meh", "fine")], "t string, m string")
    got = df.select(X.has_signal(F.col("t"), one).alias("s"), X.redact(F.col("m"), ("hunter2", "")).alias("m"), X.json_string(F.concat("t", F.lit("é\U0001f600\""))).alias("j")).collect()
    assert [r["s"] for r in got] == [True, False] and got[0]["m"] == "a\ufffdb [redacted] [redacted]: [redacted]"
    assert [r["j"] for r in got] == [json.dumps(x + "é\U0001f600\"") for x in ("CRASH", "meh")]


def test_decision_table_agrees_with_expression(spark):
    texts = ["", "ok", "/\\|_-=+*#" + "x" * 3, "fine - text", "- " * 30 + "abc" * 20, "a" * 30 + "-/" * 100, "!!!", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = X.with_eligibility(df, "t", 20_000, FilterPolicy()).withColumn("other", X.eligibility(F.col("t"), 20_000, FilterPolicy()))
    assert both.filter("decision <> other").count() == 0

    def art(text):
        m = "".join((text or "").split())
        return len(m) >= 4 and bool(re.search(r"[/\\|_\-=+*#<>^~()\[\]{}]", m)) and sum(c.isalpha() for c in m) / len(m) < 0.2

    assert {r["t"] for r in both.filter("decision = 'excluded_ascii_art'").collect()} == {t for t in texts if t and art(t)}


def test_fixture_gold_and_runs(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"apps": [{"appid": 5, "reviews": [{"review": "a"}, {"recommendationid": "x", "review": "b", "language": "french"}]}]}))
    got = {r["recommendationid"]: (r["language"], r["voted_up"], r["timestamp_created"]) for r in readers.fixture_reviews(spark, str(tmp_path / "f.json")).collect()}
    assert got == {"5-1": ("english", True, 1_700_000_001), "x": ("french", True, 1_700_000_002)}
    for text, error in (("no", "not_json"), ('{"apps": 1}', "apps"), ('{"apps": [{"appid": "1"}]}', "appid"), ('{"apps": [{"appid": 1, "reviews": ["x"]}]}', "review_not_an_object")):
        (tmp_path / "f2.json").write_text(text)
        with pytest.raises(ValueError, match=error):
            readers.fixture_reviews(spark, str(tmp_path / "f2.json"))
    (tmp_path / "big.json").write_text(" " * 10_000_001)
    (tmp_path / "link.json").symlink_to(tmp_path / "f.json")
    for name in ("big", "link", "missing"):
        with pytest.raises(ValueError, match="fixture"):
            readers.fixture_reviews(spark, str(tmp_path / f"{name}.json"))

    def gold(ids, version="stage1-gold-v1", **other):
        notes = {"actionable": True, "overall_sentiment": "mixed", "engagement_posture": "mixed", "aspects": ["core.a"]}
        records = [{"input_id": k, "review_id": k, "language": "english", "voted_up": True, "playtime_at_review": 3, "review_text": "t", "eligible": True, "annotation": notes} | other for k in ids]
        (tmp_path / "g.json").write_text(json.dumps({"version": version, "records": records}))
        return readers.gold_set(spark, str(tmp_path / "g.json"))

    assert gold(["1", "2"]).count() == 2
    broken = {"duplicate_input": (["1", "1"], {}), "version": (["1"], {"version": "1"}), "no records": ([], {}), "annotation": (["1"], {"annotation": None}), "aspects": (["1"], {"annotation": {"aspects": [1]}})}
    broken |= {"input_id": ([""], {}), "playtime_at_review": (["1"], {"playtime_at_review": True}), "voted_up": (["1"], {"voted_up": 1}), "review_text": (["1"], {"review_text": None})}
    for error, (ids, other) in broken.items():
        with pytest.raises(ValueError, match=error):
            gold(ids, **other)
    out = str(tmp_path / "aggregates")
    for run, n in (("a", 3), ("b", 2)):
        state.append_run(spark.range(n).withColumn("run_id", F.lit(run)), out, run)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        state.append_run(spark.range(1).withColumn("run_id", F.lit("a")), out, "a")
    runs = spark.createDataFrame([("a", "p", "completed", 1), ("b", "p", "completed", 2), ("c", "p", "failed", 3)], "run_id string, project_id string, status string, created_at long")
    assert state.run_rows(spark, out, state.latest_completed(runs, ["project_id"])).count() == 2


def test_export_is_sorted_as_one_and_row_groups_are_bounded(spark, tmp_path):
    """Files joined in the order of their names are in order; footers show the bound; the manifest has each file's range."""
    import pyarrow.parquet as pq

    rows = R.reviews(spark, SF).repartition(7)
    manifest = publish.export_parquet({"reviews": rows}, str(tmp_path), {}, rows_per_file=60, rows_per_group=25)
    told = manifest["datasets"]["reviews"]["files"]
    names = sorted(p.name for p in (tmp_path / "reviews").glob("*.parquet"))
    assert [f["name"] for f in told] == names and len(names) >= 3
    keys, after = [], None
    for file in told:
        found = pq.ParquetFile(tmp_path / "reviews" / file["name"])
        assert all(found.metadata.row_group(k).num_rows <= 25 for k in range(found.num_row_groups))
        own = [(r["appid"], r["recommendationid"]) for r in found.read(["appid", "recommendationid"]).to_pylist()]
        assert len(own) == file["rows"] and own[0] == tuple(file["first"].values()) and own[-1] == tuple(file["last"].values())
        keys += own
    assert keys == sorted(keys) and len(keys) == rows.count() == manifest["datasets"]["reviews"]["rows"]
    assert publish.export_parquet({"reviews": rows.limit(0)}, str(tmp_path / "none"), {})["datasets"]["reviews"]["rows"] == 0


def test_casefold_of_every_code_point(spark):
    points = [c for c in map(chr, range(1, 0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(points[k : k + 997]) for k in range(0, len(points), 997)] + ["Straße ΑΣ İSTANBUL ǅ ﬁ", "PLAIN ascii", ""] + points
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").select("k", X.casefold(F.col("t")).alias("f")).collect()
    assert [r["k"] for r in got if r["f"] != texts[r["k"]].casefold()] == []


def test_lineage_hash_does_not_depend_on_partitions(spark):
    values = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"), F.when(F.col("id") != 7, F.col("id").cast("string")).alias("value"))
    values = values.unionByName(values.limit(100))
    hashes = [sorted(map(tuple, metrics.lineage_hash(values.repartition(n), leaf_values=8).collect())) for n in (1, 7, 200)]
    assert hashes[0] == hashes[1] == hashes[2] and [h[1] for h in hashes[0]] == [1667, 1666, 1666]
    other = metrics.lineage_hash(values.filter("value <> '4'"), leaf_values=8).collect()
    assert {r["kind"]: r["hash"] for r in other}["k1"] != hashes[0][1][2] and {r["kind"]: r["hash"] for r in other}["k2"] == hashes[0][2][2]
    assert metrics.lineage_hash(values.limit(0)).collect() == []
    assert config.configuration_hash(Selection(), BatchLimits()) == config.configuration_hash(BatchLimits(), Selection()) != config.configuration_hash(BatchLimits(max_items=3), Selection())
    assert config.prompt_hash("v1", "a \nb\n") == config.prompt_hash("v1", "a\nb") != config.prompt_hash("v2", "a\nb")
