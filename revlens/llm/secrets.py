"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Every candidate value is hashed, and the corpus counts in how many repositories and under how many owners each hash
occurs. A value in many repositories, or in several of more than one owner, is a copied example; one in few repositories
is a live-looking credential. Besides the base kinds (always kept), a generic ``owned`` kind takes random-looking tokens
that are no copied examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank, cut

#: The base kinds in their order. (kind, pattern, shortest match or, for assign, shortest value)
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# `AKIA[A-Z0-9]+` and `[0-9a-f]+` are greedy runs, so asking for their length in the pattern drops the same matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Random-looking tokens: at least 24 characters with a lower-case letter, a capital and a digit among them.
GENERIC = r"(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{24,}"
VALUE_MIN = 12
#: Stands for a null id where rows are joined.
NO_ID = -(2**63)
#: A value is a copied example in at least MANY_REPOS repositories, whoever owns them, or in at least SHARED_REPOS
#: repositories of at least SHARED_OWNERS owners.
SHARED_OWNERS, SHARED_REPOS, MANY_REPOS = 2, 3, 10


KINDS = ("assign", "access", "hex", "generic")
#: What stands for a document in the exchanges: its id and two hashes of the row.
ROW = ["doc_id", "h1", "h2"]


def matches(text: Column, kind: str, pattern: str, value_group: int = 0) -> Column:
    """array<struct<kind, gap, size, value>> of the non-overlapping matches: the code points since the last match, those of
    the match, and its value."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    rows = F.arrays_zip(found.alias("m"), values.alias("v"), F.split(text, pattern, -1).alias("gap"))
    rows = F.transform(F.filter(rows, lambda r: r["m"].isNotNull()), lambda r: F.struct(F.lit(kind).alias("kind"), F.length(r["gap"]).alias("gap"), F.length(r["m"]).alias("size"), r["v"].alias("value")))
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<kind:string,gap:int,size:int,value:string>>"))


def rows_of(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """doc_id, h1, h2, owner, repo and ``found``, the matches of each kind, one row per document."""
    text = F.col("_t")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"), blank(text_col).alias("_t"))
    found = F.array(matches(text, "assign", ASSIGN, 2), matches(text, "access", ACCESS), matches(text, "hex", HEX), matches(text, "generic", GENERIC))
    parts = ("owner", "repo", "_t")
    return rows.select("doc_id", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"), "owner", "repo", found.alias("found"))


def candidates(found: DataFrame) -> DataFrame:
    """Row, owner, repo, kind, start, end, value of every match that is long enough; equal rows count as one. Places are
    code points, ends exclusive: running sums of gaps and matches in the order of a document's matches of one kind."""
    spans = found.filter(F.exists("found", lambda k: F.size(k) > 0)).select(*ROW, "owner", "repo", F.explode("found").alias("_kind")).select(*ROW, "owner", "repo", F.posexplode("_kind").alias("k", "m"))
    spans = spans.select(*ROW, "owner", "repo", "k", "m.*").dropDuplicates([*ROW, "kind", "k"])
    along = Window.partitionBy(*ROW, "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(along).cast("int")
    spans = spans.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    spans = spans.filter((F.col("kind") != "assign") | (F.length("value") >= VALUE_MIN))
    return spans.select(*ROW, "owner", "repo", "kind", "start", "end", "value")


def clear(spans: DataFrame) -> DataFrame:
    """The spans without generic ones that a base span overlaps: one that starts before ends behind its start, or one
    starts in it."""
    by_start = Window.partitionBy(*ROW).orderBy("start")
    base = F.col("kind") != "generic"
    before = F.max(F.when(base, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    overlapped = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    return spans.withColumn("_over", overlapped).filter(base | ~F.col("_over")).drop("_over")


def digest(value: Column) -> Column:
    """Two independent 64-bit halves: plain values leave the documents only as this."""
    return F.concat_ws("-", F.hex(F.xxhash64(value)), F.hex(F.xxhash64(F.lit("owner"), value)))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: n_repos, n_owners. Rows are first folded per (hash, owner, repo), then per (hash, owner), so a
    value that a third of the corpus copies reaches the last step as one row per owner and task."""
    each = spans.select(digest(F.col("value")).alias("hash"), "owner", "repo")
    by_owner = each.distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def scan(docs: DataFrame, *, shared_owners: int = SHARED_OWNERS, shared_repos: int = SHARED_REPOS, many_repos: int = MANY_REPOS, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """Spans of every document with their corpus-wide ownership: doc_id, spans array<struct<start, rank, kind, end, hash,
    n_repos, n_owners, live>>.

    Base spans (assign, access, hex) are always there. ``live`` is false for copied examples: values in at least
    ``many_repos`` repositories, or in at least ``shared_repos`` of at least ``shared_owners`` owners. A generic token
    becomes a span of kind ``owned`` only if it is live and no base span overlaps it. Null text has no spans; a null owner
    counts as one owner; rows that repeat an id each get the spans of their own text. An empty table gives an empty result.
    """
    found = cut(rows_of(docs, id_col=id_col, text_col=text_col, owner_col=owner_col, repo_col=repo_col))
    every = cut(candidates(found))
    counts = ownership(every)
    spans = clear(every).select(*ROW, "kind", "start", "end", digest(F.col("value")).alias("hash")).join(counts, "hash")
    copied = (F.col("n_repos") >= many_repos) | ((F.col("n_owners") >= shared_owners) & (F.col("n_repos") >= shared_repos))
    spans = spans.withColumn("live", ~copied).filter((F.col("kind") != "generic") | F.col("live"))
    rank = F.element_at(F.create_map(*[F.lit(x) for k, kind in enumerate((*KINDS[:3], "owned")) for x in (kind, k)]), F.col("kind"))
    spans = spans.withColumn("kind", F.when(F.col("kind") == "generic", "owned").otherwise(F.col("kind")))
    one = F.struct("start", rank.alias("rank"), "kind", "end", "hash", "n_repos", "n_owners", "live")
    spans = spans.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    per_doc = spans.groupBy(*ROW).agg(F.array_sort(F.collect_list(one)).alias("spans"))  # the spans of one document
    out = found.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), "h1", "h2").join(per_doc.withColumnRenamed("doc_id", "_id"), ["_id", "h1", "h2"], "left")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,hash:string,n_repos:bigint,n_owners:bigint,live:boolean>>")
    return out.select("doc_id", F.coalesce("spans", none).alias("spans"))


def scan_digest(spans: DataFrame) -> DataFrame:
    """One row per document: n_assign, n_access, n_hex, base_sha256, spans, n_repos (of each span, in
    their order), n_live, n_shared."""

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("spans", keep), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(keep) -> Column:
        return F.size(F.filter("spans", keep)).cast("long")

    return spans.select(
        "doc_id",
        count(lambda s: s["kind"] == "assign").alias("n_assign"),
        count(lambda s: s["kind"] == "access").alias("n_access"),
        count(lambda s: s["kind"] == "hex").alias("n_hex"),
        F.sha2(joined(lambda s: s["kind"] != "owned"), 256).alias("base_sha256"),
        joined(lambda s: F.lit(True)).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["n_repos"].cast("string")), ",").alias("n_repos"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_shared"),
    )
