"""Registered queries of the corpus operators, with production parameters over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, html_extract, langid, lines, media, minhash, mixing, packing, repair, secrets, spotsigs, substrings, warc
from .common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio(table(spark, sf_dir, "documents"))


def audio(docs: DataFrame) -> DataFrame:
    return media.audio_features(media.encode_wav(docs))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spotsigs.fingerprints(docs, anchors=spotsigs.learn_anchors(docs))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digest(secrets.scan(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "longest_run", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", (langid.fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_media": op2_media,
    "op3_spotsigs": op3_spotsigs,
    "op4_secrets": op4_secrets,
    "op5_mixing": op5_mixing,
    "op6_html": op6_html,
    "op7_substrings": op7_substrings,
    "op8_lines": op8_lines,
    "op9_language": op9_language,
    "op10_minhash": op10_minhash,
    "op11_warc": op11_warc,
    "op12_alignment": op12_alignment,
    "op13_conversations": op13_conversations,
}

#: Line dedup, from its definition: lines i and i + 1 of a document that also follow one another at an earlier place are a
#: pair of places; pairs that go on line by line are a common run. A line goes if it is in such a run.
OP8_SQL = """
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(lines))) AS pos, lines FROM docs),
places AS (SELECT doc_id, pos, lines[pos] AS a, lines[pos + 1] AS b FROM starts),
pairs AS (SELECT x.doc_id, x.pos, y.doc_id AS other, x.pos - y.pos AS shift FROM places x JOIN places y ON x.a = y.a AND x.b = y.b AND (y.doc_id, y.pos) < (x.doc_id, x.pos)),
common AS (SELECT doc_id, count(*) + 1 AS n FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY pos) AS run FROM pairs) GROUP BY doc_id, other, shift, run),
longest AS (SELECT doc_id, max(n) AS longest_run FROM common GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT pos) AS lost FROM (SELECT doc_id, pos FROM pairs UNION ALL SELECT doc_id, pos + 1 FROM pairs) GROUP BY doc_id)
SELECT d.doc_id, len(d.lines)::BIGINT AS n_lines, coalesce(len(g.lost), 0)::BIGINT AS n_removed, coalesce(l.longest_run, 0)::BIGINT AS longest_run,
    sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(d.lines) + 1), lambda k: NOT coalesce(list_contains(g.lost, k), false)), lambda k: d.lines[k]), chr(10)), '')) AS kept_sha256
FROM docs d LEFT JOIN gone g USING (doc_id) LEFT JOIN longest l USING (doc_id)
"""

#: Archives, from the contract: the digest's letters are five bits each, and the smallest page of equal payloads is the response.
OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p),
d AS (SELECT *, [('0x' || h[10 * k + 1 : 10 * k + 10])::BIGINT FOR k IN range(4)] AS forty FROM f)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((forty[1 + i // 8] >> (35 - 5 * (i % 8))) & 31) + 1)::INT, 1) FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

SQL: dict[str, str] = {"op8_lines": OP8_SQL, "op11_warc": OP11_SQL}
