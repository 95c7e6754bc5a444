"""Line dedup by a suffix array over line ids, in DataFrame functions only.

The suffixes of all documents' line sequences are ranked by distributed prefix doubling: a suffix's rank over its first 2n
lines is made of its rank over n lines and that of the suffix n lines further on. Ranks name classes of equal prefixes
(two 64-bit hashes); their order carries nothing, since only equality and the place of the first occurrence are asked for.

1. Documents of equal text are one class of which the smallest id goes into the array; all others are copies as a whole.
2. Doubling goes on as long as an interval (suffixes of equal rank) has two suffixes. Suffixes alone in theirs leave.
3. Going back down the levels, the longest common prefix of each suffix with any earlier one is put together of powers of
   two: an interval is divided by the rank of what follows; of each part the first stays behind, to stand for it among
   those that go on with shorter steps. A suffix is asked about in one interval at a time, so no level has more than two
   rows a suffix.
4. These prefixes are the maximal repeated runs; lines that they cover are deleted.

What leaves the documents is a row a line (level 1), afterwards a row a suffix that occurs twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

MIN_LINES = 2
#: Stands for a null id, which comes before all others.
NO_ID = -(2**63)
TEXT, RANK, NEXT, GROUP = ["_t1", "_t2"], ["r1", "r2"], ["n1", "n2"], ["g1", "g2"]


def two_hashes(*parts: Column | str) -> tuple[Column, Column]:
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents with ``_doc`` and the class of their text, ``_t1`` and ``_t2`` (of its own by id where the text is null)."""
    t1, t2 = two_hashes(F.col(text_col))
    return docs.withColumn("_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn("_t1", t1).withColumn("_t2", F.when(F.col(text_col).isNull(), F.xxhash64("_doc")).otherwise(t2))


def place() -> Column:
    return F.struct("doc", *TEXT, "pos")


def suffixes(docs: DataFrame, text_col: str) -> DataFrame:
    """doc, _t1, _t2, pos and the rank over one line, one row a suffix of a different text."""
    lines = docs.filter(F.col(text_col).isNotNull()).select("_doc", *TEXT, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "_line"))
    r1, r2 = two_hashes("_line")
    lines = lines.select("_doc", *TEXT, "pos", r1.alias("r1"), r2.alias("r2"))
    return lines.groupBy(*TEXT, "pos").agg(F.min("_doc").alias("doc"), F.first("r1").alias("r1"), F.first("r2").alias("r2"))


def in_intervals(ranked: DataFrame) -> DataFrame:
    """The suffixes whose rank another one has too; ``later``: an earlier one."""
    first = ranked.groupBy(*RANK).agg(F.count(F.lit(1)).alias("n"), F.min(place()).alias("first")).filter("n > 1").drop("n")
    return ranked.join(first, RANK).select("doc", *TEXT, "pos", *RANK, (place() > F.col("first")).alias("later"))


def levels(docs: DataFrame, text_col: str) -> list[tuple[int, DataFrame]]:
    """(depth, suffixes in intervals at that depth) for depths 1, 2, 4 and so on."""
    now, depth, out = cut(in_intervals(suffixes(docs, text_col))), 1, []
    while not now.isEmpty():
        out.append((depth, now))
        following = now.select(*TEXT, (F.col("pos") - depth).alias("pos"), *[F.col(r).alias(n) for r, n in zip(RANK, NEXT, strict=True)])
        r1, r2 = two_hashes(*RANK, *NEXT)
        ranked = now.join(following, [*TEXT, "pos"]).select("doc", *TEXT, "pos", r1.alias("r1"), r2.alias("r2"))
        now, depth = cut(in_intervals(ranked)), 2 * depth
    return out


def longest_earlier(found: list[tuple[int, DataFrame]], least: int = 1) -> DataFrame | None:
    """_t1, _t2, pos, n_lines: the longest common prefix, of at least ``least`` lines, of each suffix with an earlier one;
    None without any.

    ``asked`` rows are those of which the length is still sought in their interval; the others stand for earlier places.
    """
    now, above = None, None
    for depth, level in reversed(found):
        if now is not None:
            following = level.select(*TEXT, F.col("pos").alias("_at"), *[F.col(r).alias(n) for r, n in zip(RANK, NEXT, strict=True)])
            seen = now.withColumn("_at", F.col("pos") + F.col("n_lines")).join(following, [*TEXT, "_at"], "left").drop("_at")
            parts = seen.filter("n1 is not null").groupBy(*GROUP, *NEXT).agg(F.count(F.lit(1)).alias("_n"), F.min(place()).alias("_first")).filter("_n > 1").drop("_n")
            seen = seen.join(parts, [*GROUP, *NEXT], "left")
            g1, g2 = two_hashes(*GROUP, *NEXT)
            is_first = place() == F.col("_first")
            up = F.struct((F.col("n_lines") + depth).alias("n_lines"), g1.alias("g1"), g2.alias("g2"), (~is_first).alias("asked"))
            stay = F.struct("n_lines", *GROUP, "asked")
            goes = F.when(F.col("_first").isNull(), F.array(stay)).when(is_first, F.array(up, stay)).otherwise(F.array(up))
            now = seen.select("doc", *TEXT, "pos", F.explode(goes).alias("_g")).select("doc", *TEXT, "pos", "_g.*")
        if 2 * depth <= least and now is None:
            break
        rest = level if above is None else level.join(above.filter("later").select(*TEXT, "pos"), [*TEXT, "pos"], "left_anti")
        fresh = rest.join(rest.filter("later").select(*RANK).distinct(), RANK, "left_semi")
        fresh = fresh.select("doc", *TEXT, "pos", F.lit(depth).alias("n_lines"), *[F.col(r).alias(g) for r, g in zip(RANK, GROUP, strict=True)], F.col("later").alias("asked"))
        if 2 * depth > least:  # else what is shared to this depth alone is too short
            now = fresh if now is None else now.unionByName(fresh)
        now, above = cut(now), level
    return None if now is None else now.filter(F.col("asked") & (F.col("n_lines") >= least)).select(*TEXT, "pos", "n_lines")


def repeated_runs(longest: DataFrame) -> DataFrame:
    """Maximal repeated runs of lines, those that no run from the line before goes on with: _t1, _t2, pos, n_lines."""
    along = Window.partitionBy(*TEXT).orderBy("pos")
    within = (F.lag("pos").over(along) == F.col("pos") - 1) & (F.lag("n_lines").over(along) > F.col("n_lines"))
    return longest.withColumn("_within", F.coalesce(within, F.lit(False))).filter("not _within").drop("_within")


def stretches(runs: DataFrame) -> DataFrame:
    """What the runs of a text cover: _t1, _t2, ``_gone`` (first and last line of each stretch), ``_longest`` run."""
    before = Window.partitionBy(*TEXT).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*TEXT).orderBy("pos")
    end = F.col("pos") + F.col("n_lines")
    rows = runs.withColumn("_end", end).withColumn("_new", F.coalesce((F.col("pos") > F.max("_end").over(before)).cast("int"), F.lit(1)))
    rows = rows.withColumn("_k", F.sum("_new").over(upto)).groupBy(*TEXT, "_k").agg(F.min("pos").alias("a"), (F.max("_end") - 1).alias("b"), F.max("n_lines").alias("_longest"))
    return rows.groupBy(*TEXT).agg(F.collect_list(F.struct("a", "b")).alias("_gone"), F.max("_longest").alias("_longest"))  # of one text


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Delete every line of a run of at least ``min_lines`` lines that has occurred before.

    "Before" is a smaller id or, in one document, a smaller line number; a null id comes first. Lines end at line feeds;
    equal lines are those of equal 128-bit hashes. Returns the input's columns with the text reduced, and n_lines,
    n_removed and longest_run, the longest run of the document that has occurred before (those names are overwritten if
    the input has them). Null text stays null with 0 lines; a text that loses all its lines becomes empty. Rows that
    repeat both id and text count as one document and each get its result.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    hidden = {"_doc", "_first_doc", "_gone", "_longest", *TEXT}
    own = [c for c in docs.columns if c not in hidden | {"n_lines", "n_removed", "longest_run"}]
    docs = keyed(docs.select(*own), id_col, text_col)
    longest = longest_earlier(levels(docs, text_col), min_lines)
    copied = docs.filter(F.col(text_col).isNotNull()).groupBy(*TEXT).agg(F.min("_doc").alias("_first_doc"), F.max("_doc").alias("_last")).filter("_first_doc < _last").drop("_last")
    if longest is None:
        known = copied.withColumn("_gone", F.lit(None).cast("array<struct<a:int,b:int>>")).withColumn("_longest", F.lit(None).cast("int"))
    else:
        known = copied.join(stretches(repeated_runs(longest)), TEXT, "full")
    rows = docs.join(known, TEXT, "left")
    lines = F.split(F.col(text_col), "\n", -1)
    n = F.size(lines)
    whole = (F.col("_doc") > F.col("_first_doc")) & (n >= min_lines)
    gone = F.flatten(F.transform("_gone", lambda s: F.sequence(s["a"], s["b"])))  # different lines: stretches do not meet
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), n - 1), gone), lambda k: F.element_at(lines, k + 1)), "\n")
    text = F.when(whole, "").when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)
    size = F.when(F.col(text_col).isNull(), 0).otherwise(n)
    return rows.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in own],
        size.cast("long").alias("n_lines"),
        F.when(whole, n).otherwise(F.coalesce(F.size(gone), F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, n).otherwise(F.coalesce("_longest", F.lit(0))).cast("long").alias("longest_run"),
    )
