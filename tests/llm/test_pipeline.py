"""Every stage of the pipeline against brute force on its own input."""

import importlib.util

import pytest
from pyspark.sql import functions as F
from test_operators import slow_components, slow_lines, texts_of

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("the pipeline is not there", allow_module_level=True)


def test_stages(spark, tmp_path):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    outs = {}
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / str(k)))
        outs[name] = (docs, out := spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert out.columns == list(p.COLUMNS)
        docs = out
    before, after = outs["language"]
    assert after.count() >= 0.97 * before.count()
    before, after = outs["line_dedup"]
    want = {d: text for d, (n, gone, text, _) in slow_lines(texts_of(before), 2).items() if gone < n}
    assert texts_of(after) == want
    before, after = outs["near_dedup"]
    assert sorted(texts_of(after)) == sorted(d for d, (_, c) in slow_components(texts_of(before), 5, 80).items() if c == d)
    before, after = outs["mixture"]
    assert 0 < after.count() < before.count() and set(texts_of(after)) <= set(texts_of(before))
    before, after = outs["pack"]
    assert {r["doc_id"] for r in after.select("doc_id").distinct().collect()} == set(texts_of(before))


def test_null_and_repeated_ids(spark):
    """Rows without an id stay, of the rows of one id one stays."""
    import corpus_pipeline as p

    long = " ".join(f"w{k}" for k in range(40))
    rows = [(None, long, "en", "a", 0), (None, "no id here", "en", "b", 0), (1, long, "en", "a", 0), (1, long, "en", "a", 0), (2, long, "en", "a", 0), (2, "other words", "en", "a", 0), (3, "short", "en", "a", 0), (3, "some more words", None, "a", 0), (4, None, "en", None, 0), (5, "alone", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in p.near_dedup(spark, docs, "").collect()))
    linked = [x for x in got if x[0] in (2, 3)]
    assert [x for x in got if x not in linked] == [(0, "no id here"), (0, long), (1, long), (4, ""), (5, "alone")]
    assert linked == [(3, "some more words")]
    nulls = spark.range(400).selectExpr("cast(null as long) doc_id", "concat('text number ', id) text", "'en' lang", "'a' source", "1L n_chars")
    kept = p.mixture(spark, nulls, "").count()
    assert 200 < kept < 360
    twice = spark.range(300).selectExpr("id % 150 doc_id", "if(id < 150, 'plain words', repeat('12345 ', 200)) text", "'en' lang", "'a' source", "1L n_chars")
    out = p.mixture(spark, twice, "")
    assert out.filter("text = 'plain words'").count() != out.filter("text <> 'plain words'").count() and out.columns == list(p.COLUMNS)


def test_stages_take_awkward_tables(spark):
    """Nulls in every column, columns with clashing names, and no rows at all, in each stage."""
    import corpus_pipeline as p

    text = "the cat and the dog were in the house with a lot of other animals\nthey sat there all day"
    rows = [(k, text + f" number {k}", "en", "a", 5) for k in range(12)] + [(None, text, None, None, None), (20, None, None, None, None), (21, "", "en", "a", 0), (21, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("kept", "score", "pos", "_rid", "topic", "length"):
        docs = docs.withColumn(name, F.lit("x"))
    for name, stage in p.STAGES:
        out = stage(spark, docs, "")
        n = out.count()
        assert n <= len(rows) and (name == "pack" or out.columns == list(p.COLUMNS))
        if name == "pack":
            assert n == len(rows) and out.filter("doc_id is null").count() == 1
        if name in ("line_dedup", "near_dedup"):
            assert out.filter("text is null").count() == 1
        assert stage(spark, docs.limit(0), "").count() == 0


def test_run_writes_its_stages(spark, monkeypatch):
    import corpus_pipeline as p

    read = []
    monkeypatch.setattr(p, "STAGES", [(n, lambda s, d, f: (read.append(d.inputFiles()), d.limit(3))[1]) for n in "abc"])
    assert p.run(spark, "/root/testdata/sf0.001").count() == 3
    assert "/0-a/" in read[1][0] and "/1-b/" in read[2][0]


def test_run_is_registered(spark):
    import __spark_entry__ as e

    assert "pipeline" in e.queries() and sum(k.startswith("op") for k in e.queries()) == 13
