"""Mixing sources to target weights by iterative proportional fitting (raking).

Token mass is summed per cell (source, language, topic); cell weights are raked in turn to the target share of every
source, language and topic; documents are then sampled with the probability that their cell's calibrated weight gives.

The cells are a Spark table throughout, however many values a dimension has. A round of raking sums the weights by each
dimension and joins the factors; what the driver sees is how far the round still moved the marginals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank, cut

DIMS = ("source", "lang", "topic")
#: Target shares follow the observed ones to this power: 1 keeps them, 0 makes all values equal.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
#: Share of the corpus's tokens to sample.
KEEP = 0.7
#: Raking ends when no marginal was further off than TOLERANCE before a round, or after ROUNDS (targets that contradict
#: one another).
ROUNDS, TOLERANCE = 40, 1e-5
#: A table of so many cells at most is broadcast to the documents; beyond it both sides are shuffled.
BROADCAST_CELLS = 50_000


def topic_of(text: Column) -> Column:
    """A coarse topic, from the text's form alone: the first rule that fits."""
    n = F.greatest(F.length(text), F.lit(1))
    return (
        F.when(F.regexp_count(text, F.lit("[0-9]")) * 50 > n, "figures")
        .when(F.regexp_count(text, F.lit("[A-Z]")) * 4 > n, "capitals")
        .when(F.regexp_count(text, F.lit("[^\\p{L}\\p{N}\\s.,]")) * 20 > n, "symbols")
        .when(n < 400, "notes")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    """Words of a text; at least 1, so that an empty document has some mass."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(1)).cast("long")


def shares(cells: DataFrame, dim: str, power: float, wanted: dict[str, float] | None) -> DataFrame:
    """dim, goal: the target share of each value that has mass. Values without a target get 0, unless none has one."""
    values = cells.groupBy(dim).agg(F.sum("mass").alias("mass"))
    if wanted is None:
        raw = F.pow(F.col("mass"), F.lit(power))
    else:
        given = cells.sparkSession.createDataFrame(list(wanted.items()) or [("", 0.0)], f"{dim} string, _given double")
        values, raw = values.join(given, dim, "left"), F.coalesce("_given", F.lit(0.0))
    values = values.select(dim, raw.alias("_raw"))
    total = values.agg(F.sum("_raw"), F.count(F.lit(1))).first()
    return values.select(dim, (F.col("_raw") / total[0] if total[0] else F.lit(1.0 / max(1, total[1]))).alias("goal"))


def rake(cells: DataFrame, goals: dict[str, DataFrame], *, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``weight`` with the target marginals to the cells (columns of ``goals`` and ``mass``), started at their mass.

    If the marginals contradict one another the result is that of the last round.
    """
    total = cells.agg(F.sum("mass")).first()[0]
    now = cells.withColumn("weight", F.col("mass") / total)
    for dim, goal in goals.items():
        now = now.join(goal.withColumnRenamed("goal", f"_goal_{dim}"), dim)
    now = cut(now)
    for _ in range(rounds):
        rows = now.withColumn("_off", F.lit(0.0))
        for dim in goals:
            goal = F.col(f"_goal_{dim}")
            rows = rows.join(rows.groupBy(dim).agg(F.sum("weight").alias("_now")), dim).withColumn("_off", F.greatest("_off", F.abs(F.col("_now") - goal)))
            rows = cut(rows.withColumn("weight", F.when(F.col("_now") > 0, F.col("weight") * goal / F.col("_now")).otherwise(0.0)).drop("_now"))
        off = rows.agg(F.max("_off")).first()[0]
        now = rows.drop("_off")
        if off < tolerance:
            break
    return now.drop(*[f"_goal_{dim}" for dim in goals])


def with_probability(cells: DataFrame, budget: float) -> DataFrame:
    """Adds ``p``: expected tokens follow ``weight`` and add up to ``budget``, as far as no cell is asked for more than it
    has; what a full cell cannot give goes to the others. The rate of the others only grows until no cell is added to the
    full ones."""
    rate, full = 0.0, -1
    while True:
        is_full = F.col("weight") * rate >= F.col("mass")
        row = cells.filter("weight > 0").agg(F.sum(F.when(is_full, F.col("mass"))), F.sum(F.when(~is_full, F.col("weight"))), F.count_if(is_full)).first()
        if row[2] == full or not row[1] or budget <= (row[0] or 0):
            break
        rate, full = (budget - (row[0] or 0)) / row[1], row[2]
    return cells.withColumn("p", F.round(F.least(F.lit(1.0), F.col("weight") * rate / F.col("mass")), 12))


def described(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Callable[[Column], Column] = topic_of) -> DataFrame:
    """doc_id, source, lang, topic (null: "") and tokens of each document."""
    text = blank(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), blank(source_col).alias("source"), blank(lang_col).alias("lang"), topic(text).alias("topic"), token_count(text).alias("tokens"))


def cell_weights(rows: DataFrame, *, temper: dict[str, float] = TEMPER, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP) -> DataFrame | None:
    """The raked cells: source, lang, topic, mass, weight, p; None without rows."""
    cells = cut(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("mass")))
    mass = cells.agg(F.sum("mass")).first()[0]
    if mass is None:
        return None
    raked = rake(cells, {dim: shares(cells, dim, temper[dim], (targets or {}).get(dim)) for dim in DIMS})
    return with_probability(raked, keep * mass)


def mix(docs: DataFrame, *, temper: dict[str, float] = TEMPER, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Callable[[Column], Column] = topic_of) -> DataFrame:
    """Sample documents by calibrated probabilities: doc_id, source, lang, topic, tokens, weight, p, kept.

    ``weight`` is the raked token share of the document's cell, ``p`` its sampling probability, ``kept`` the decision,
    fixed by the seed and the document's id. Null source and language are values of their own (""), null text
    is empty, repeated rows get the same decision, an empty table an empty result.
    """
    rows = described(docs, id_col=id_col, text_col=text_col, source_col=source_col, lang_col=lang_col, topic=topic)
    rows = rows.withColumn("_u", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(1 << 52)) / F.lit(float(1 << 52)))
    rows = cut(rows)  # narrow, and read several times
    cells = cell_weights(rows, temper=temper, targets=targets, keep=keep)
    if cells is None:
        return rows.select("doc_id", *DIMS, "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("p"), F.lit(False).alias("kept"))
    table = cells.select(*DIMS, F.round("weight", 12).alias("weight"), "p")
    small = table.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    out = rows.join(F.broadcast(table) if small else table, list(DIMS))
    return out.select("doc_id", *DIMS, "tokens", "weight", "p", (F.col("_u") < F.col("p")).alias("kept"))
