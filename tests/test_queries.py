"""Every registered query with SQL gives the same rows as DuckDB over the same tables."""

import glob
import html
import os
from html.entities import html5

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from revlens.plans import oracle, reviews

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return ""
        return f"{x:.10g}" if isinstance(x, float) else str(x)

    df = df[sorted(df.columns)]
    return sorted(tuple(plain(x) for x in r) for r in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    mine = driver.queries()[name](spark, SF)
    want = duck.execute(driver.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(want.columns)
    got, expected = rows(pd.DataFrame([tuple(r) for r in mine.collect()], columns=mine.columns)), rows(want)
    assert len(got) == len(expected)
    bad = [(a, b) for a, b in zip(got, expected, strict=True) if a != b]
    assert not bad, (len(bad), bad[:3])


def test_every_query_is_compared_or_known():
    unwritten = {k for k in driver.queries() if k not in driver.oracle_sql() and not k.startswith("op") and k != "pipeline"}
    assert unwritten == set()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_sql_decodes_character_references_as_pages_are_decoded(duck):
    """Cut references, names that go on, numbers for other characters and for none."""
    texts = ["a &amp b", "x&ampy &amp;amp; & &;", "&notit; &notin; &notin &no", "&lt;b&gt &copy2 &AElig", "&#65;&#x41&#0;&#x80;&#x81;&#xD800;&#99999999999999999999;&#11;&#xFFFF;&#13;", "&# &#x; &#xg &#;", "&NotEqualTilde; &fjlig; &nosuchname;", "&thinsp;|&nbsp;|&&&&", "&" * 3 + "amp", "'&apos;&quot&#39", "", "&abcdefghijklmnopqrstuvwxyzabcdefghijklmnop;", "&\n&amp\tx"]
    texts += [f"&{k}" for k in html5] + [f"&{k}z" for k in html5] + [f"&#{n}" for n in (*range(1, 300), 55295, 57344, 65534, 131071, 1114111, 1114112)]
    got = duck.execute(f"SELECT {oracle.unescaped('t')} FROM (SELECT unnest(?) AS t, generate_subscripts(?, 1) AS i) ORDER BY i", [texts, texts]).fetchall()
    bad = [(t, g, html.unescape(t)) for t, (g,) in zip(texts, got, strict=True) if g != html.unescape(t)]
    assert not bad, (len(bad), bad[:5])


def test_a_project_is_taken_in_without_copies_of_its_texts(spark):
    """Texts are only in the documents: no stored table of a project has them."""
    stored = reviews.project(spark, SF)
    for rows in (stored.reviews, stored.decisions, stored.classifications):
        assert not {"review_text", "text"} & set(rows.columns)
    whole = reviews.reviews(spark, SF)
    assert stored.reviews.exceptAll(whole.drop("review_text")).isEmpty() and stored.reviews.count() == whole.count()
    assert stored.decisions.exceptAll(reviews.decisions(whole)).isEmpty() and stored.classifications.exceptAll(reviews.classifications(whole)).isEmpty()
