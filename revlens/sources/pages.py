"""Stored review pages as a Spark data source, in batches and as a stream with an offset a (app, polarity).

Pages lie under ``<path>/<appid>/<review_type>/<page number, nine digits>.json``, numbered from 0 without holes and never
changed. The offset of a stream is the number of its next page, so a batch is a range of pages a stream: a batch that is
repeated after a failure reads the same pages, and the next one begins behind them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "appid long, review_type string, page_no long, raw string"
ARROW = pa.schema([("appid", pa.int64()), ("review_type", pa.string()), ("page_no", pa.int64()), ("raw", pa.string())])
#: Pages that one task reads.
PAGES_PER_TASK = 1000


def page_path(folder: str, stream: str, number: int) -> str:
    return f"{folder}/{stream}/{number:09d}.json"


@dataclass
class Pages(InputPartition):
    stream: str
    first: int
    end: int


class Folder:
    """The streams of a folder and how many pages each has."""

    def __init__(self, options):
        self.path = options["path"]
        self.per_task = int(options.get("pagesPerTask", PAGES_PER_TASK))

    def opened(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def streams(self) -> list[str]:
        system, folder = self.opened()
        apps = [x.base_name for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.base_name.isdigit()]
        return sorted(f"{a}/{x.base_name}" for a in apps for x in system.get_file_info(fs.FileSelector(f"{folder}/{a}")) if re.fullmatch("positive|negative", x.base_name))

    def count(self, stream: str, at_least: int = 0) -> int:
        """Number of pages of a stream that has ``at_least`` so many: looked up in doubling steps, then by halving."""
        system, folder = self.opened()

        def there(number: int) -> bool:
            return system.get_file_info(page_path(folder, stream, number)).type == fs.FileType.File

        low, step = at_least, 1  # pages before low are there
        while there(low + step - 1):
            low += step
            step *= 2
        high = low + step - 1  # page high is not
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if there(middle) else (low, middle)
        return low

    def ranges(self, start: dict, end: dict) -> list[Pages]:
        return [Pages(s, at, min(at + self.per_task, n)) for s, n in sorted(end.items()) for at in range(start.get(s, 0), n, self.per_task)]

    def read_pages(self, part: Pages) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        system, folder = self.opened()
        appid, kind = part.stream.split("/")
        for number in range(part.first, part.end):
            with system.open_input_stream(page_path(folder, part.stream, number)) as file:
                raw = file.read().decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((int(appid), kind, number, raw), ARROW.types, strict=True)], schema=ARROW)


class PageReader(DataSourceReader, Folder):
    def __init__(self, options):
        Folder.__init__(self, options)

    def partitions(self) -> list[InputPartition]:
        return self.ranges({}, {s: self.count(s) for s in self.streams()})

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.read_pages(partition)


class PageStreamReader(DataSourceStreamReader, Folder):
    """Where the stream stands is known to Spark's checkpoint. Spark doesn't tell a source so before it asks for the latest
    offset; with ``maxPagesPerTrigger``, the offset that was committed last is therefore also kept in the file ``offsets``."""

    def __init__(self, options):
        Folder.__init__(self, options)
        self.most = int(options.get("maxPagesPerTrigger", 0))
        self.kept = options.get("offsets")
        if self.most and not self.kept:
            raise ValueError("maxPagesPerTrigger needs a file for the committed offsets")
        self.there: dict[str, int] = {}
        self.given: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Pages there are, of each stream at most ``maxPagesPerTrigger`` behind those that were given already."""
        self.there |= {s: self.count(s, self.there.get(s, 0)) for s in self.streams()}
        if not self.most:
            return dict(self.there)
        if self.given is None:
            system, path = fs.FileSystem.from_uri(self.kept)
            self.given = {}
            if system.get_file_info(path).type == fs.FileType.File:
                with system.open_input_stream(path) as file:
                    self.given = json.loads(file.read())
        self.given = {s: min(n, self.given.get(s, 0) + self.most) for s, n in self.there.items()}
        return dict(self.given)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if back := [s for s, n in start.items() if end.get(s, 0) < n]:
            raise ValueError(f"the offset of {back[0]} would go back from {start[back[0]]} to {end.get(back[0], 0)}")
        self.given = {s: max(n, (self.given or {}).get(s, 0)) for s, n in end.items()}
        return self.ranges(start, end)

    def commit(self, end: dict) -> None:
        if self.most:
            system, path = fs.FileSystem.from_uri(self.kept)
            with system.open_output_stream(f"{path}.new") as file:
                file.write(json.dumps(end).encode())
            system.move(f"{path}.new", path)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.read_pages(partition)


class ReviewPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "review_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStreamReader(self.options)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(ReviewPages)
    return spark.read.format("review_pages").load(path)


def stream_pages(spark: SparkSession, path: str, *, most: int = 0, offsets: str | None = None) -> DataFrame:
    """``most``: pages of a stream in a batch (0: all there are); it needs ``offsets``, a file beside the checkpoint."""
    spark.dataSource.register(ReviewPages)
    reader = spark.readStream.format("review_pages").option("maxPagesPerTrigger", most)
    return (reader.option("offsets", offsets) if offsets else reader).load(path)


def source_hash(review: Column) -> Column:
    """Hash of a review (variant) as it came, with sorted keys."""
    return F.sha2(F.to_json(review), 256)


def crawled(pages: DataFrame) -> DataFrame:
    """Pages as the stop rules take them. ``raw`` is an object of crawl, cursor_in, error and the service's answer (cursor,
    reviews); what is missing or of another kind is null."""
    v = F.try_parse_json("raw")
    items = F.coalesce(F.try_variant_get(v, "$.reviews", "array<variant>"), F.array().cast("array<variant>"))
    review = lambda r: F.struct(F.try_variant_get(r, "$.recommendationid", "string").alias("recommendationid"), F.try_variant_get(r, "$.timestamp_updated", "long").alias("timestamp_updated"), source_hash(r).alias("source_hash"))
    texts = [F.try_variant_get(v, f"$.{k}", "string").alias(a) for k, a in (("cursor_in", "cursor_in"), ("cursor", "cursor_out"), ("error", "error"))]
    return pages.select("appid", "review_type", "page_no", F.try_variant_get(v, "$.crawl", "long").alias("crawl"), *texts, F.transform(items, review).alias("reviews"), "raw")
