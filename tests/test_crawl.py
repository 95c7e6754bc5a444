"""Stop rules as stream state and the page source: any batches give what one pass gives, and nothing is lost or repeated."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import commits
from revlens.sources import pages
from revlens.streaming import crawl

DAY = 86_400


def random_pages(seed, streams=4, crawls=4):
    """Page logs with every way to stop, repeated pages among them."""
    rng = random.Random(seed)
    out = []
    for appid in range(streams):
        kind, number, stored = rng.choice(["positive", "negative"]), 0, []
        for c in range(crawls):
            stored = [(f"r{appid}-{c}-{k}", 1_700_000_000 + c * 3 * DAY + k * 1000) for k in range(rng.randrange(0, 7))][::-1] + stored
            listed = [(r, t + (10 * DAY if rng.random() < 0.05 else 0), f"h{r}" if rng.random() < 0.95 else f"h{r}{c}") for r, t in stored]
            cuts = [listed[k : k + 3] for k in range(0, len(listed), 3)] + [[]] * rng.randrange(2)
            for p, rows in enumerate(cuts):
                before = "*" if p == 0 else f"c{p}"
                after = rng.choices([f"c{p + 1}", before, "", "*"], [20, 1, 1, 1])[0]
                error = rng.choices([None, "timeout", "cancelled"], [30, 1, 1])[0]
                out.append((appid, kind, number, c, before, after, error, rows))
                number += 1
    return out


def brute(log, incremental, most):
    """One pass over each stream's pages in order, by plain loops."""
    rows, streams = [], {}
    for appid, kind, number, c, before, after, error, listed in sorted(log, key=lambda p: (p[0], p[1], p[2])):
        s = streams.setdefault((appid, kind), {"crawl": None, "high": None, "db": {}, "cursor": "*"})
        if s["crawl"] != c:
            s.update(crawl=c, stop=None, status="partial", pages=0, reviews=0, top=0)
        took, new, changed = False, 0, 0
        if s["stop"] is None:
            if most and s["reviews"] >= most:
                s["status"], s["stop"] = "complete", "configured_limit"
            elif error:
                s["status"], s["stop"] = ("partial", "cancelled") if error == "cancelled" else ("failed", "retry_exhausted:" + error)
            else:
                took = True
                old = incremental and s["high"] and listed and all(t < s["high"] - DAY and s["db"].get(r) == (t, h) for r, t, h in listed)
                s["stop"] = "empty_page" if not listed else "repeated_cursor" if after == before else "non_progressing_cursor" if after in ("", "*") else "fully_known_overlap" if old else None
                for r, t, h in listed:
                    new += r not in s["db"]
                    changed += r in s["db"] and s["db"][r][1] != h
                    s["db"][r] = (t, h)
                    s["top"] = max(s["top"], t)
                s["pages"] += 1
                s["reviews"] += len(listed)
                s["cursor"] = after
                s["status"] = "complete" if s["stop"] else "partial"
                if s["stop"] or not incremental:
                    s["high"] = max(s["high"] or 0, s["top"]) or None
        rows.append((appid, kind, number, c, took, s["status"], s["stop"], s["cursor"], s["high"], s["pages"], s["reviews"], new, changed))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.drop("raw").collect()), key=str)


@pytest.mark.parametrize(("incremental", "most"), [(True, 0), (False, 0), (True, 5)])
def test_one_pass_in_any_order_against_brute_force(spark, incremental, most):
    log = random_pages(1, streams=8)
    reasons = {r[6] for r in brute(log, incremental, most)}
    assert len(reasons) >= 5
    mixed = [*log, *log[::5]]
    random.Random(2).shuffle(mixed)
    got = crawl.follow_pages(spark.createDataFrame([(*p, None) for p in mixed], crawl.PAGE), incremental=incremental, most_reviews=most)
    assert rows_of(got) == brute(log, incremental, most)


def write_page(folder, page):
    appid, kind, number, c, before, after, error, rows = page
    path = f"{folder}/{appid}/{kind}"
    os.makedirs(path, exist_ok=True)
    body = {"success": 1, "crawl": c, "cursor_in": before, "cursor": after, "error": error, "reviews": [{"recommendationid": r, "language": "en", "voted_up": True, "timestamp_created": t, "timestamp_updated": t, "review": h} for r, t, h in rows]}
    with open(f"{path}/.{number}.tmp", "w") as file:
        file.write(json.dumps(body))
    os.rename(f"{path}/.{number}.tmp", f"{path}/{number:09d}.json")


def run_stream(spark, folder, out, checkpoint, most, fail_at=None):
    """Process what there is; ``fail_at``: the batch that dies after half of its rows are written."""

    def write(batch, number):
        if number == fail_at:
            batch.limit(1).write.mode("overwrite").parquet(f"{out}/batch={number}")
            raise RuntimeError("killed")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    rows = crawl.follow_pages(pages.crawled(pages.stream_pages(spark, folder, most=most, offsets=checkpoint + "-pages.json" if most else None)))
    query = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_stream_of_stored_pages_survives_a_killed_batch(spark, tmp_path):
    folder, out, checkpoint = str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    log = random_pages(3, streams=3, crawls=6)
    for page in log[: len(log) // 2]:
        write_page(folder, page)
    with pytest.raises(Exception, match="killed"):
        run_stream(spark, folder, out, checkpoint, most=2, fail_at=1)
    for page in log[len(log) // 2 :]:
        write_page(folder, page)
    run_stream(spark, folder, out, checkpoint, most=2)
    assert spark.read.parquet(out).select("batch").distinct().count() > 4
    once = crawl.follow_pages(pages.crawled(pages.read_pages(spark, folder)))
    streamed = spark.read.parquet(out).drop("batch")
    assert rows_of(streamed) == rows_of(once)
    drop = lambda rows: [r[:11] for r in rows]  # noqa: E731  the hash of a review is that of its JSON here
    assert drop(rows_of(once)) == drop(brute(log, True, 0))


def test_pages_are_counted_by_their_names(spark, tmp_path):
    for number in range(37):
        write_page(str(tmp_path), (5, "positive", number, 0, "*", "c", None, []))
    write_page(str(tmp_path), (5, "negative", 0, 0, "*", "c", None, []))
    os.makedirs(tmp_path / "x" / "positive")
    folder = pages.Folder({"path": str(tmp_path), "pagesPerTask": "10"})
    assert folder.streams() == ["5/negative", "5/positive"]
    assert [folder.count("5/positive", k) for k in (0, 1, 36, 37)] == [37] * 4
    assert [(p.first, p.end) for p in folder.ranges({"5/positive": 5}, {"5/positive": 27, "5/negative": 0})] == [(5, 15), (15, 25), (25, 27)]
    assert pages.read_pages(spark, str(tmp_path)).agg(F.count("*"), F.max("page_no")).collect()[0] == (38, 36)
    assert pages.read_pages(spark, str(tmp_path / "none")).count() == 0


def test_rows_cursor_and_high_water_become_visible_together(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "pages"), str(tmp_path / "checkpoint")
    log = [p for p in random_pages(5, streams=2, crawls=4)]
    for page in log:
        write_page(folder, page)
    store = commits.Store(spark, str(tmp_path / "store"), leaf_rows=5)
    seen = []

    class Dying(commits.Store):
        """Dies once when all rows of the second commit are written, right before it is published."""

        def publish(self, state):
            if state.version == 2 and not seen:
                seen.append({name: rows_of(store.read(name)) for name in ("reviews", "streams", "pages")})
                raise RuntimeError("killed")
            super().publish(state)

    def run(into):
        stream = pages.stream_pages(spark, folder, most=2, offsets=checkpoint + "-pages.json")
        rows = crawl.follow_pages(pages.crawled(stream))
        query = rows.writeStream.outputMode("update").foreachBatch(crawl.commit_pages(into, "p")).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="killed"):
        run(Dying(spark, store.path, leaf_rows=5))
    assert {name: rows_of(store.read(name)) for name in ("reviews", "streams", "pages")} == seen[0]
    run(store)
    want = brute(log, True, 0)
    last = {}
    for r in sorted(want, key=lambda r: r[2]):
        last[r[0], r[1]] = (r[2], r[3], r[7], r[8], r[5], r[6])
    assert {tuple(r[:2]): tuple(r[2:]) for r in store.read("streams").collect()} == last
    assert store.read("pages").count() == len(log)
    taken = {r[:3] for r in want if r[4]}
    newest = {}
    for appid, kind, number, *_, rows in log:
        for r, t, h in rows if (appid, kind, number) in taken else []:
            newest[appid, r] = max(newest.get((appid, r), (0, 0, "")), (t, number, h))
    got = {(r["appid"], r["recommendationid"]): (r["timestamp_updated"], r["review_text"]) for r in store.read("reviews").collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in newest.items()}
    assert store.vacuum() > 0 and store.read("pages").count() == len(log)


@pytest.mark.parametrize("held", [0, 50_000])
def test_a_new_stream_asks_the_state_for_nothing_that_it_holds(monkeypatch, held):
    """A review of a new stream is written once and never read, unless more are held than may be; the results are the same."""
    from types import SimpleNamespace

    monkeypatch.setattr(crawl, "HELD", held)
    values, calls = {}, {"get": 0, "put": 0}

    def get(key):
        calls["get"] += 1
        return values.get(key)

    def put(key, value):
        calls["put"] += 1
        values[key] = value

    rules = crawl.StopRules(incremental=False)
    rules.known = SimpleNamespace(getValue=get, updateValue=put)
    rules.stream = SimpleNamespace(exists=lambda: False, update=lambda x: None)
    rules.early = SimpleNamespace(containsKey=lambda k: False)
    review = lambda k, h: {"recommendationid": k, "timestamp_updated": 1, "source_hash": h}
    pages = [[review("a", "1"), review("b", "1"), review("a", "2")], [review("a", "2"), review("b", "1")], [review("a", "3"), review("c", "1")]]
    rows = [{"page_no": k, "crawl": k, "cursor_in": "*", "cursor_out": "c1", "error": None, "reviews": p, "raw": None} for k, p in enumerate(pages)]
    out = list(rules.handleInputRows((1, "positive"), iter([SimpleNamespace(asDict=lambda recursive, r=r: r) for r in rows]), None))
    assert [(r["new"], r["changed"]) for r in out] == [(2, 1), (0, 0), (1, 1)]
    assert values == {("a",): (1, "3"), ("b",): (1, "1"), ("c",): (1, "1")}
    assert calls["put"] == 5 and (calls["get"] == 0) == (held > 0)
