"""Commits: upserts against a dict, replaced batches, readers of an old version, and the work of a commit."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import commits

SCHEMA = "appid long, recommendationid string, source_hash string, first_seen_at long"
KEYS = ["appid", "recommendationid"]


def test_upserts_against_a_dict(spark, tmp_path):
    store, rng, want = commits.Store(spark, str(tmp_path / "s"), leaf_rows=40), random.Random(1), {}
    for batch in range(5):
        keys = {(rng.randrange(5), f"r{rng.randrange(120)}") for _ in range(60)}
        rows = [(*k, f"h{batch}", batch) for k in keys]
        assert store.commit("w", batch, upserts={"reviews": (spark.createDataFrame(rows, SCHEMA), KEYS)})
        for a, r, h, t in rows:
            want[a, r] = (h, want.get((a, r), (h, t))[1])
        assert {tuple(r[:2]): tuple(r[2:]) for r in store.read("reviews").collect()} == want
    leaves = store.state().tables["reviews"].leaves
    assert max(x.rows for x in leaves) <= 80 and sum(x.rows for x in leaves) == len(want) and len(leaves) > 4
    some = list(want)[::17]
    found = store.lookup("reviews", spark.createDataFrame([*some, (99, "none")], "appid long, recommendationid string"))
    assert {tuple(r[:2]): tuple(r[2:]) for r in found.collect()} == {k: want[k] for k in some}


def test_a_repeated_batch_changes_nothing_and_old_versions_stay_readable(spark, tmp_path):
    store = commits.Store(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([(1, "a", "h", 1)], SCHEMA)
    two = spark.createDataFrame([(1, "a", "h2", 2)], SCHEMA)
    assert store.commit("w", 0, upserts={"t": (one, KEYS)}, appends={"log": one})
    before = store.state()
    assert store.commit("w", 1, upserts={"t": (two, KEYS)}, appends={"log": two})
    assert not store.commit("w", 1, upserts={"t": (one, KEYS)}, appends={"log": one})
    assert not store.commit("w", 0, upserts={"t": (one, KEYS)})
    assert [r["source_hash"] for r in store.read("t").collect()] == ["h2"]
    assert [r["source_hash"] for r in store.read("t", before).collect()] == ["h"]
    assert sorted(r["commit_id"] for r in store.read("log").collect()) == ["w-0", "w-1"]
    with pytest.raises(ValueError, match="keys"):
        store.commit("w", 2, upserts={"t": (one, ["appid"])})
    stale = store.state()
    store.append("runs", "run-1", one)
    with pytest.raises(ValueError, match="already"):
        store.append("runs", "run-1", one)
    stale.version += 1
    with pytest.raises(RuntimeError, match="another writer"):
        store.publish(stale)


def test_quotes_are_replaced_on_run_and_selection(spark, tmp_path):
    store, keys = commits.Store(spark, str(tmp_path / "s")), ["run_id", "selection_id"]
    rows = lambda *x: spark.createDataFrame(x, "run_id string, selection_id string, evidence string")
    store.commit("quotes", 0, upserts={"quotes": (rows(("r1", "s1", "a"), ("r1", "s2", "b")), keys)})
    store.commit("quotes", 1, upserts={"quotes": (rows(("r1", "s2", "c"), ("r2", "s1", "d")), keys)})
    assert sorted(map(tuple, store.read("quotes").collect())) == [("r1", "s1", "a"), ("r1", "s2", "c"), ("r2", "s1", "d")]


def test_a_commit_of_few_keys_reads_and_writes_few_rows_of_a_long_history(spark, tmp_path):
    store = commits.Store(spark, str(tmp_path / "s"), leaf_rows=500)
    many = spark.range(40_000).select((F.col("id") % 7).alias("appid"), F.col("id").cast("string").alias("recommendationid"), F.lit("h").alias("source_hash"), F.lit(0).cast("long").alias("first_seen_at"))
    store.commit("w", 0, upserts={"t": (many, KEYS)})
    before = {x.folder for x in store.state().tables["t"].leaves}
    store.commit("w", 1, upserts={"t": (many.limit(2).withColumn("source_hash", F.lit("x")), KEYS)})
    table = store.state().tables["t"]
    rewritten = [x for x in table.leaves if x.folder not in before]
    assert len(rewritten) <= 2 and sum(x.rows for x in rewritten) <= 1000 < sum(x.rows for x in table.leaves) == 40_000
    assert store.read("t").filter("source_hash = 'x'").count() == 2
