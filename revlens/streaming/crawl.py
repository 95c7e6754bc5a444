"""Stop rules and high water of review crawls as keyed stream state.

A stream is an app's reviews of one polarity, listed newest first, page by page; each crawl lists it anew. Stored pages are
numbered through all crawls of a stream. The state of a stream is its high water, where its current crawl stands, the reviews
it has seen, and pages that came before their turn; all of it lies in the state store, so a stream's size is not bounded by
memory, and pages give the same result in whatever batches and order they come.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.commits import Store
from ..operators.state import latest
from ..sources import readers

STREAM = ["appid", "review_type"]
PAGE = "appid long, review_type string, page_no long, crawl long, cursor_in string, cursor_out string, error string, reviews array<struct<recommendationid:string,timestamp_updated:long,source_hash:string>>, raw string"
RESULT = "appid long, review_type string, page_no long, crawl long, consumed boolean, status string, stop_reason string, cursor string, high_water long, pages long, reviews long, new long, changed long, raw string"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Fields of a stream's state between pages.
FIELDS = {"page_no": -1, "crawl": None, "cursor": "*", "high": None, "running": None, "pages": 0, "reviews": 0, "status": "partial", "reason": None}


#: Reviews that a call remembers of those that it has put in the state.
HELD = 50_000


class StopRules(StatefulProcessor):
    """Follows a stream's pages in their order; a row for each page, whether it was asked for or came behind the stop.

    A crawl stops at an empty page, at a cursor that does not move or leads back to the start, at a page all of whose reviews
    are stored as they are and older than the overlap window (``incremental``), at a failure, and before a page when it has
    ``most_reviews`` (0: no limit). An incremental crawl moves the high water only when a page has completed it; any other
    moves it with every page. The high water never falls.
    """

    def __init__(self, *, incremental: bool = True, overlap_seconds: int = 86_400, most_reviews: int = 0):
        self.incremental, self.overlap_seconds, self.most_reviews = incremental, overlap_seconds, most_reviews

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stream = handle.getValueState("stream", "state string")
        self.known = handle.getMapState("known", "recommendationid string", "timestamp_updated long, source_hash string")
        self.early = handle.getMapState("early", "page_no long", "page string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        there = self.stream.exists()
        now = FIELDS | (json.loads(self.stream.get()[0]) if there else {})
        self.held, self.whole = {}, not there
        for row in rows:
            page = row.asDict(recursive=True)
            if page["page_no"] > now["page_no"] + 1:
                self.early.updateValue((page["page_no"],), (json.dumps(page),))
                continue
            if page["page_no"] <= now["page_no"]:  # it was here before
                continue
            yield self.follow(key, now, page)
            while self.early.containsKey((now["page_no"] + 1,)):
                held = json.loads(self.early.getValue((now["page_no"] + 1,))[0])
                self.early.removeKey((held["page_no"],))
                yield self.follow(key, now, held)
        self.stream.update((json.dumps(now),))

    def stored(self, review: dict) -> tuple[int, str] | None:
        """What the state has of a review. ``held`` is what this call has put there; of a new stream that is all (``whole``)."""
        if self.whole or review["recommendationid"] in self.held:
            return self.held.get(review["recommendationid"])
        found = self.known.getValue((review["recommendationid"],))
        return tuple(found) if found is not None else None

    def stop_reason(self, now: dict, page: dict, before: list[tuple[int, str] | None]) -> str | None:
        rows = page["reviews"] or []
        if not rows:
            return "empty_page"
        if page["cursor_out"] == page["cursor_in"]:
            return "repeated_cursor"
        if page["cursor_out"] in ("", "*"):
            return "non_progressing_cursor"
        if self.incremental and now["high"] is not None:
            oldest = now["high"] - self.overlap_seconds
            if all(r["timestamp_updated"] < oldest and b == (r["timestamp_updated"], r["source_hash"]) for r, b in zip(rows, before, strict=True)):
                return "fully_known_overlap"
        return None

    def follow(self, key, now: dict, page: dict) -> Row:
        """Take the stream's next page into ``now``."""
        now["page_no"] = page["page_no"]
        if page["crawl"] != now["crawl"]:
            now |= {"crawl": page["crawl"], "running": None, "pages": 0, "reviews": 0, "status": "partial", "reason": None}
        consumed, kinds = False, {"new": 0, "changed": 0}
        if now["reason"] is not None:
            pass  # behind the stop
        elif self.most_reviews and now["reviews"] >= self.most_reviews:
            now |= {"status": "complete", "reason": "configured_limit"}
        elif page["error"] == "cancelled":
            now["reason"] = "cancelled"
        elif page["error"]:
            now |= {"status": "failed", "reason": f"retry_exhausted:{page['error']}"}
        else:
            consumed, rows = True, page["reviews"] or []
            before = [self.stored(r) for r in rows]
            now["reason"] = self.stop_reason(now, page, before)
            for r, b in zip(rows, before, strict=True):
                seen = self.stored(r) if b is None else b  # the page itself may repeat it
                kinds["new"] += seen is None
                kinds["changed"] += seen is not None and seen[1] != r["source_hash"]
                value = (r["timestamp_updated"], r["source_hash"])
                if self.held.get(r["recommendationid"], seen) != value:
                    self.known.updateValue((r["recommendationid"],), value)
                self.held[r["recommendationid"]] = value
            if len(self.held) > HELD:
                self.held, self.whole = {}, False
            now |= {"pages": now["pages"] + 1, "reviews": now["reviews"] + len(rows), "cursor": page["cursor_out"]}
            now["running"] = max([r["timestamp_updated"] for r in rows] + [now["running"] or 0]) or None
            if now["reason"]:
                now["status"] = "complete"
            if now["reason"] or not self.incremental:
                now["high"] = max(now["high"] or 0, now["running"] or 0) or None
        return Row(appid=key[0], review_type=key[1], page_no=page["page_no"], crawl=page["crawl"], consumed=consumed, status=now["status"], stop_reason=now["reason"], cursor=now["cursor"], high_water=now["high"], pages=now["pages"], reviews=now["reviews"], **kinds, raw=page["raw"] if consumed else None)

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """Keyed state of any size needs the store on disk; a batch query also needs the session's streaming manager, which
    holds the coordinator of the stores and is made when it is first asked for."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    _ = spark.streams.active


def follow_pages(pages: DataFrame, *, incremental: bool = True, overlap_seconds: int = 86_400, most_reviews: int = 0) -> DataFrame:
    """What becomes of each stored page (``PAGE``), of a stream or of a table: ``RESULT``.

    ``status`` and ``stop_reason`` are those of the page's crawl after it, ``high_water`` that of the stream. A page that comes
    twice counts once. A page whose predecessor has not come yet waits in the state.
    """
    use_state_store(pages.sparkSession)
    rules = StopRules(incremental=incremental, overlap_seconds=overlap_seconds, most_reviews=most_reviews)
    return pages.groupBy(*STREAM).transformWithState(rules, RESULT, "Update", "None")


REVIEW_KEYS = ["appid", "recommendationid"]


def commit_pages(store: Store, project_id: str, writer: str = "crawl"):
    """For ``foreachBatch`` on :func:`follow_pages`: the reviews of consumed pages, each stream's cursor, status and high
    water, and the page log become visible in one commit; a batch that is repeated changes nothing.

    Of a review that several pages have, of one batch or of different ones, that of the latest update counts, whatever the
    order in which the two streams of an app come; of equal ones the last page's.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        taken = batch.filter("consumed").select("page_no", "raw", F.col("appid").alias("app"))
        rows = readers.page_reviews(taken, project_id, F.col("app"), keep=("page_no",))
        rows = latest(rows, REVIEW_KEYS, F.desc("timestamp_updated"), F.desc("page_no")).drop("page_no").withColumn("first_seen_at", F.col("timestamp_updated"))
        at = F.struct("page_no", "crawl", "cursor", "high_water", "status", "stop_reason")
        streams = batch.groupBy(*STREAM).agg(F.max_by(at, "page_no").alias("at")).select(*STREAM, "at.*")
        log = batch.drop("raw")
        store.commit(writer, batch_id, upserts={"reviews": (rows, REVIEW_KEYS, "timestamp_updated"), "streams": (streams, STREAM)}, appends={"pages": log})

    return write
