"""Archives: exact round trips, and what is salvaged of damaged ones."""

import base64
import gzip
import hashlib
import io
import os
import random

import pytest

from revlens.llm import warc

SCHEMA = "page_id long, url string, html string, kind string, start long, headers string, record_type string"


def awkward():
    texts = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "x" * 300_000, "ß WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "<p>a</p>", "\x1f\x08"]
    rows = [(10 - k, f"http://h/{k}", t, "k", 1, "h", "r") for k, t in enumerate(texts)]
    rows += [(None, None, "<p>n</p>", "k", 1, "h", "r"), (None, "u r\r\nl\x7f", "<p>n</p>", "k", 1, "h", "r"), (50, "http://s", "<p>n</p>", "k", 1, "h", "r")]
    return rows + [(60, "http://t", "<p>twice</p>", "k", 1, "h", "r")] * 3 + [(61, "http://t", "<p>twice</p>", "k", 1, "h", "r")] * 2


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    out, first = [], {}
    for k, (page, url, html, *_) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))):
        n = len((html or "").encode())
        of = first.setdefault(html or "", page) if n >= least else None
        again = n >= least and (html or "") in [h for h, _ in out]
        out.append((html or "", (page, n, digest(html), "revisit" if again else "response", of if again else None)))
    return sorted((r for _, r in out), key=str)


def rows_of(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [0, 1, 100])
def test_round_trip_of_awkward_rows(spark, least):
    pages = spark.createDataFrame(awkward(), SCHEMA).repartition(3)
    out = warc.archive_pages(pages, least=least)
    assert rows_of(out) == brute(awkward(), least)
    assert out.select("record_id").distinct().count() == len(awkward())


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_payloads_come_back_and_files_roll(spark, tmp_path, compression):
    rows = [(k, f"http://h/{k}", f"<p>{k}</p>" * 50, "k", 1, "h", "r") for k in range(40)]
    folder = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), folder, compression=compression, max_bytes=2000)
    open(os.path.join(folder, "left-behind.warc.gz"), "wb").write(b"of a lost attempt")
    found = warc.read_archives(spark, folder)
    assert warc.quarantined(found).count() == 0
    got = {r["headers"]["x-page-id"]: bytes(r["payload"]).decode() for r in found.filter("headers['warc-type'] = 'response'").collect()}
    assert got == {str(r[0]): r[2] for r in rows}
    assert len([x for x in os.listdir(folder) if not x.startswith("_")]) > 4


def parts(n=6, packed=True):
    pages = [warc.page_record({"type": "response", "record_id": f"id-{k}", "date": "2020-01-01T00:00:00Z", "uri": "http://h", "digest": "D", "refers_to": None, "page_id": k, "payload": (f"<p>{k} " + "text " * 200).encode()}) for k in range(n)]
    return [gzip.compress(x, mtime=0) if packed else x for x in pages]


def salvaged(data):
    out = list(warc.salvage(warc.Bytes(io.BytesIO(data), len(data))))
    return [int(x.headers["x-page-id"]) for x in out if isinstance(x, warc.Record)], [x for x in out if not isinstance(x, warc.Record)]


@pytest.mark.parametrize("packed", [True, False])
def test_damage_of_every_kind_loses_only_what_it_touches(packed):
    whole = parts(packed=packed)
    starts = [sum(map(len, whole[:k])) for k in range(7)]
    data = b"".join(whole)
    assert salvaged(data) == (list(range(6)), [])
    assert salvaged(b"") == ([], [])
    middle = starts[2] + len(whole[2]) // 2
    flipped = data[:middle] + bytes([data[middle] ^ 255]) + data[middle + 1 :]
    assert salvaged(flipped)[0] == [0, 1, 3, 4, 5]
    assert [g[:2] for g in salvaged(flipped)[1]] == [(starts[2], starts[3])]
    missing = data[: middle] + data[middle + 40 :]
    assert salvaged(missing)[0] == [0, 1, 3, 4, 5] and [g[:2] for g in salvaged(missing)[1]] == [(starts[2], starts[3] - 40)]
    junk = b"junk \x1f\x8b\x08 WARC/1.1\r\nContent-Length: 5\r\n\r\n"
    inserted = data[: starts[3]] + junk + data[starts[3] :]
    assert salvaged(inserted)[0] == list(range(6)) and [g[:2] for g in salvaged(inserted)[1]] == [(starts[3], starts[3] + len(junk))]
    ended = data[: starts[5] + 30]
    assert salvaged(ended)[0] == [0, 1, 2, 3, 4] and [g[:2] for g in salvaged(ended)[1]] == [(starts[5], starts[5] + 30)]
    assert salvaged(data[5:])[0] == [1, 2, 3, 4, 5]
    assert salvaged(b"\0" * 3_000_000 + data)[0] == list(range(6))


def test_random_damage_never_gives_a_wrong_record(spark):
    rng = random.Random(5)
    for packed in (True, False):
        whole = parts(8, packed)
        texts = {k: (f"<p>{k} " + "text " * 200).encode() for k in range(8)}
        for _ in range(150):
            data = bytearray(b"".join(whole))
            a = rng.randrange(len(data))
            data[a : a + rng.randrange(1, 200)] = bytes(rng.randrange(256) for _ in range(rng.randrange(200)))
            found = list(warc.salvage(warc.Bytes(io.BytesIO(bytes(data)), len(data))))
            records = [x for x in found if isinstance(x, warc.Record)]
            if packed:
                assert all(x.payload == texts[int(x.headers["x-page-id"])] for x in records)
            assert all(any(x.payload.endswith(t) for t in texts.values()) for x in records)  # no digest covers a plain header
            assert len(records) >= 5
            spans = sorted({(x.start, x.end) if isinstance(x, warc.Record) else x[:2] for x in found if not isinstance(x, warc.Record) or x.end})
            assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_one_member_of_many_records_and_a_member_with_a_hole():
    records = parts(5, packed=False)
    assert salvaged(gzip.compress(b"".join(records))) == (list(range(5)), [])
    got, gaps = salvaged(gzip.compress(records[0] + b"hole\r\n" + records[1]) + gzip.compress(records[2]))
    assert got == [0, 1, 2] and len(gaps) == 1 and "of member" in gaps[0][2]
    whole = gzip.compress(b"".join(records), mtime=0)
    got, gaps = salvaged(whole[:-4] + b"\1\2\3\4")  # the sum at the end is wrong, the records' digests agree
    assert got == [0, 1, 2, 3, 4] and [g[:2] for g in gaps] == [(0, len(whole))]


def test_gaps_are_logged_by_spark(spark, tmp_path):
    folder = str(tmp_path / "w")
    rows = [(k, "http://h", f"<p>{k}</p>" * 30, "k", 1, "h", "r") for k in range(30)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    name = next(x for x in os.listdir(folder) if x.endswith(".gz"))
    data = bytearray(open(os.path.join(folder, name), "rb").read())
    data[len(data) // 2] ^= 255
    open(os.path.join(folder, name), "wb").write(data)
    found = warc.read_archives(spark, folder)
    gaps = warc.quarantined(found).collect()
    assert len(gaps) == 1 and gaps[0]["file"] == name and gaps[0]["start"] <= len(data) // 2 < gaps[0]["end"]
    assert len(rows_of(warc.page_digests(found))) == 29
