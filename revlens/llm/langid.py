"""Language identification with interpolated Kneser-Ney character models.

One model per language, up to ``ORDER`` characters, kept as sorted arrays of packed n-gram codes with their discounted
probabilities and back-off weights. A text gets the language whose model has the lowest cross-entropy per character. The
temperature of the score and the cross-entropy above which a text is rejected are calibrated on documents that no model
was fitted to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blank, cut

ORDER = 5
BITS = np.uint64(12)
SYMBOLS = 1 << 12
#: No code point from here on is a letter.
LETTERS = 0x33480
#: Bounds of :func:`sample`: characters a language and in all (a text that would pass the bound and all after it are left out).
FIT_CHARS, FIT_ALL = 6_000_000, 60_000_000
#: n-grams whose counts a task holds before it passes them on.
HELD_GRAMS = 4_000_000
FOLDS = 5
#: Cross-entropies are counted in bins of STEP nats up to BINS of them. Limits are at least LEAST spreads above the median, or
#: ALONE spreads where nothing is known that must be rejected; a lost document weighs as much as LOST accepted wrong ones.
STEP, BINS, LEAST, ALONE, LOST = 0.01, 1500, 3.0, 6.0, 10.0
SHARPNESS = (2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
#: Ranges of hashes, as a power of two, in whose histogram a language's sample is looked for.
RANGE_BITS = 12
UNKNOWN = "und"
FOUND = ("lang_pred", "score", "rejected")
#: n-grams whose scores a worker remembers.
REMEMBERED = 1_500_000
BLOCK_CHARS = 2_000_000


def fold_of(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


class Symbols:
    """Texts as symbol codes: letters in lower case, everything else as single spaces (0)."""

    def __init__(self):
        code = np.arange(LETTERS)
        self.table = np.where(code < 3000, code + 1, 3001 + code * 2654435761 % (SYMBOLS - 3001)).astype(np.uint64)
        self.table[~np.array([chr(c).isalpha() for c in code])] = 0

    def __call__(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self.table[np.minimum(points, len(self.table) - 1)]
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
        return out[keep]


def grams(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Packed code of each symbol with the order - 1 before it (spaces before the start); low bits are the latest."""
    padded = np.concatenate([np.zeros(order - 1, np.uint64), symbols])
    out = np.zeros(len(symbols), np.uint64)
    for k in range(order):
        out = (out << BITS) | padded[k : k + len(symbols)]
    return out


class KneserNey:
    """Interpolated Kneser-Ney over counts of packed n-grams of one language."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.order, self.probs, self.backs = order, [], []
        levels = []
        codes, counts = codes.astype(np.uint64), counts.astype(np.float64)
        for n in range(order, 0, -1):
            levels.append((n, codes, counts))
            shorter = codes & np.uint64((1 << 12 * (n - 1)) - 1)
            codes, counts = np.unique(shorter, return_counts=True)  # how many different n-grams end so
            counts = counts.astype(np.float64)
        for n, codes, counts in reversed(levels):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context = codes >> BITS if n > 1 else np.zeros(len(codes), np.uint64)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            total, kinds = np.add.reduceat(counts, first), np.diff(np.append(first, len(codes)))
            share = np.repeat(total, kinds)
            self.probs.append((codes, (np.maximum(counts - discount, 0) / share).astype(np.float32)))
            self.backs.append((context[first], (discount * kinds / total).astype(np.float32)))

    def log_prob(self, codes: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """``levels`` are those of :func:`suffixes`, which models share."""
        p = np.full(1, 1 / SYMBOLS)
        for n, (own, shorter) in enumerate(levels if levels is not None else suffixes(codes, self.order), 1):
            p = look_up(*self.probs[n - 1], own, 0.0) + look_up(*self.backs[n - 1], own >> BITS if n > 1 else own * np.uint64(0), 1.0) * p[shorter]
        return np.log(p)


def suffixes(codes: np.ndarray, order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n from 1 to ``order``: the different ends of n symbols that the codes have (at last the codes as they are), and where each
    one's own end of n - 1 symbols is among those."""
    levels = []
    for n in range(order - 1, -1, -1):
        shorter, where = np.unique(codes & np.uint64((1 << 12 * n) - 1), return_inverse=True)
        levels.append((codes, where))
        codes = shorter
    return levels[::-1]


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], default)


class Scorer:
    """Cross-entropy per symbol of texts under every language's model."""

    def __init__(self, models: dict[str, KneserNey]):
        self.models, self.symbols = list(models.values()), Symbols()
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, len(models)), np.float32)

    def _of(self, codes: np.ndarray) -> np.ndarray:
        """Log probabilities of sorted different codes, one column a language."""
        out = np.empty((len(codes), len(self.models)), np.float32)
        at = np.searchsorted(self.keys, codes)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == codes if len(self.keys) else np.zeros(len(codes), bool)
        out[known] = self.values[at[known]]
        new = codes[~known]
        if len(new):
            levels = suffixes(new)
            fresh = np.stack([m.log_prob(new, levels) for m in self.models], 1).astype(np.float32)
            out[~known] = fresh
            if len(self.keys) < REMEMBERED:
                keys = np.concatenate([self.keys, new])
                order = np.argsort(keys, kind="stable")
                self.keys, self.values = keys[order], np.concatenate([self.values, fresh])[order]
        return out

    def __call__(self, texts: list[str]) -> np.ndarray:
        """One row a text; NaN for texts without letters. Long texts are summed over blocks."""
        sums, sizes = np.zeros((len(texts), len(self.models))), np.zeros(len(texts))
        held, owners, n = [], [], 0

        def flush() -> None:
            nonlocal held, owners, n
            if held:
                codes, back = np.unique(np.concatenate(held), return_inverse=True)
                scores = self._of(codes)
                lengths = [len(h) for h in held]
                starts = np.cumsum([0, *lengths[:-1]])
                for k in range(len(self.models)):
                    np.add.at(sums[:, k], owners, np.add.reduceat(scores[:, k].astype(np.float64)[back], starts))
                np.add.at(sizes, owners, lengths)
            held, owners, n = [], [], 0

        for k, text in enumerate(texts):
            symbols = self.symbols(text)
            if not symbols.any():
                continue
            codes = grams(symbols)
            for at in range(0, len(codes), BLOCK_CHARS):
                held.append(codes[at : at + BLOCK_CHARS])
                owners.append(k)
                n += len(held[-1])
                if n >= BLOCK_CHARS:
                    flush()
        flush()
        with np.errstate(invalid="ignore"):
            return -sums / np.where(sizes, sizes, np.nan)[:, None]


def added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order with the sums of their counts."""
    every, back = np.unique(np.concatenate(codes), return_inverse=True)
    return every, np.bincount(back, np.concatenate(counts), len(every)).astype(np.int64)


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, code, n of all n-grams of the rows' texts, added up by Spark. A task adds up what it can hold before."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, held, fresh = Symbols(), {}, {}

        def add(lang: str) -> None:
            own = [np.unique(np.concatenate(fresh.pop(lang)), return_counts=True)]
            held[lang] = added(*zip(*own, *([held[lang]] if lang in held else []), strict=True))

        def passed() -> Iterator[pa.RecordBatch]:
            for lang in list(fresh):
                add(lang)
            for lang, (codes, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], ["lang", "code", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = grams(symbols(text))
                for at in range(0, len(codes), BLOCK_CHARS):
                    fresh.setdefault(lang, []).append(codes[at : at + BLOCK_CHARS])
                    if sum(map(len, fresh[lang])) >= BLOCK_CHARS or len(fresh[lang]) >= 1000:
                        add(lang)
                        if sum(len(c) for c, _ in held.values()) >= HELD_GRAMS:
                            yield from passed()
        yield from passed()

    return rows.select("lang", "text").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def models_of(counts: pa.Table) -> dict[str, KneserNey]:
    """A model a language of the table lang, code, n."""
    names = counts.column("lang").combine_chunks().dictionary_encode()
    owner, codes, n = names.indices.to_numpy(zero_copy_only=False), counts.column("code").to_numpy().view(np.uint64), counts.column("n").to_numpy()
    models = {}
    for k, lang in enumerate(names.dictionary.to_pylist()):
        own = np.flatnonzero(owner == k)
        own = own[np.argsort(codes[own])]
        models[lang] = KneserNey(codes[own], n[own])
    return models


class LanguageModel:
    """Fitted models with their calibration."""

    def __init__(self, models: dict[str, KneserNey]):
        self.langs, self.models = sorted(models), {k: models[k] for k in sorted(models)}
        self.sharpness, self.limits = 10.0, dict.fromkeys(self.langs, np.inf)

    def calibrate(self, likelihood: np.ndarray, own: np.ndarray, wrong: np.ndarray) -> None:
        """Sharpness of the score by likelihood, limits by histograms (language, bin) of cross-entropies: of the language's
        own documents, and of texts that its model should reject."""
        if likelihood.any():
            self.sharpness = SHARPNESS[int(likelihood.argmax())]
        for k, lang in enumerate(self.langs):
            if own[k].any():
                self.limits[lang] = limit_of(own[k], wrong[k])


def limit_of(own: np.ndarray, wrong: np.ndarray) -> float:
    """The limit that separates the histograms best: the middle of the best stretch, not below the bulk of ``own``.

    The spread is 1.48 times the median distance from the median, so that a few odd documents move nothing.
    """
    at = (np.arange(len(own)) + 0.5) * STEP
    median = weighted_median(at, own)
    spread = max(1.4826 * weighted_median(np.abs(at - median), own), STEP)
    if not wrong.any():
        return median + ALONE * spread
    edges = (np.arange(len(own)) + 1) * STEP  # limits; what is above is rejected
    loss = LOST * (1 - np.cumsum(own) / own.sum()) + np.cumsum(wrong) / wrong.sum()
    loss[edges < median + LEAST * spread] = np.inf
    if not np.isfinite(loss).any():
        return median + LEAST * spread
    start = int(loss.argmin())
    end = start
    while end + 1 < len(loss) and loss[end + 1] <= loss[start] + 1e-12:
        end += 1
    return float(edges[start] + edges[end]) / 2


def weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    total = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(total, total[-1] / 2)])


def shuffled(text: str) -> str:
    """The letters and spaces of the text in another order, fixed by the text."""
    symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    order = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass"))).permutation(len(symbols))
    return symbols[order].tobytes().decode("utf-32-le", "surrogatepass")


def score_of(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-(entropy - entropy.min(1, keepdims=True)) * sharpness)
    return e / e.sum(1, keepdims=True)


def sample(rows: DataFrame, langs: int, most: int) -> DataFrame:
    """For trials on a part of a corpus (:func:`fit` does not use it). lang, text: at most ``most`` different texts a language, within the bounds of characters, by the hash of the text.

    A histogram of the hashes says which of its ranges hold a language's first ``most``; only these are put in order.
    """
    texts = rows.select("lang", F.xxhash64("text").alias("_h"), F.length("text").alias("_n")).distinct().withColumn("_b", F.shiftright("_h", 64 - RANGE_BITS))
    texts = cut(texts)  # narrow, and read twice
    before = F.sum("count").over(Window.partitionBy("lang").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    first = texts.groupBy("lang", "_b").count().withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < most)
    texts = texts.join(first.select("lang", "_b"), ["lang", "_b"], "left_semi")
    order = Window.partitionBy("lang").orderBy("_h")
    texts = texts.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= most)
    texts = texts.withColumn("_sum", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("_sum") <= min(FIT_CHARS, FIT_ALL // max(langs, 1)))
    chosen = texts.select("lang", "_h")  # at most ``most`` rows a language
    return rows.withColumn("_h", F.xxhash64("text")).join(chosen, ["lang", "_h"], "left_semi").dropDuplicates(["lang", "_h"]).select("lang", "text")


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit one model per language to the n-grams of all labelled documents outside of folds 0 and 1, each as often as it is there.

    Fold 1 only calibrates: all of its documents whose label the models confirm, against the documents of the other
    languages and against all of its documents with their letters shuffled. Rows with null text or language are left out.
    Without any labelled row the model knows no language and calls every text ``und``. What reaches the driver is a row a
    different n-gram and language: the model itself, whose growth slows down with that of the corpus.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.coalesce(fold_of(F.col(id_col)), F.lit(2)).alias("fold"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("fold <> 0")
    models = models_of(gram_counts(rows.filter("fold <> 1")).toArrow())
    model = LanguageModel(models)
    if models:
        index = {x: k for k, x in enumerate(model.langs)}
        shared = docs.sparkSession.sparkContext.broadcast(model.models)

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = Scorer(shared.value)
            for batch in batches:
                truth, texts = (c.to_pylist() for c in batch.columns)
                h = score(texts)
                y = np.array([index.get(x, -1) for x in truth])
                good = np.isfinite(h).all(1) & (y >= 0)
                h, y = h[good], y[good]
                total: dict = {}
                for j, sharpness in enumerate(SHARPNESS if len(y) else ()):
                    total["sharp", 0, j] = float(np.log(np.maximum(score_of(h, sharpness)[np.arange(len(y)), y], 1e-12)).sum())
                sure = h.argmin(1) == y if len(y) else np.zeros(0, bool)
                odd = score([shuffled(t) for t in texts])
                odd = odd[np.isfinite(odd).all(1)]
                for k in range(len(index)):
                    for kind, values in (("own", h[sure & (y == k), k]), ("other", h[sure & (y != k), k]), ("other", odd[:, k])):
                        for at, n in zip(*np.unique(np.clip(values / STEP, 0, BINS - 1).astype(int), return_counts=True), strict=True):
                            total[kind, k, int(at)] = total.get((kind, k, int(at)), 0.0) + float(n)
                columns = list(zip(*((*key, n) for key, n in total.items()), strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.float64()), strict=True)], ["kind", "k", "at", "n"])

        fold = rows.filter("fold = 1").select("lang", "text")
        table = fold.mapInArrow(histograms, "kind string, k int, at int, n double").groupBy("kind", "k", "at").agg(F.sum("n").alias("n"))
        sums = {"sharp": np.zeros((1, len(SHARPNESS))), "own": np.zeros((len(index), BINS)), "other": np.zeros((len(index), BINS))}
        for r in table.collect():  # at most BINS rows a language and kind
            sums[r["kind"]][r["k"], r["at"]] = r["n"]
        model.calibrate(sums["sharp"][0], sums["own"], sums["other"])
    return model


def predict(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """lang_pred, score and rejected beside doc_id (or the columns in ``keep``, of which those names are overwritten).

    Null text and text without letters are ``und`` with score 0 and count as rejected. ``score`` is the calibrated
    probability of the language. ``rejected`` is set if even the best model's cross-entropy is above its limit.
    """
    own = keep if keep is not None else [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        score = Scorer(m.models)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            rows = []
            h = score(texts) if m.langs else np.full((len(texts), 1), np.nan)
            for text, own_h in zip(texts, h, strict=True):
                if not m.langs or not np.isfinite(own_h).all() or not any(map(str.isalpha, text)):
                    rows.append((UNKNOWN, 0.0, True))
                else:
                    k = int(own_h.argmin())
                    rows.append((m.langs[k], float(score_of(own_h[None], m.sharpness)[0, k]), bool(own_h[k] > m.limits[m.langs[k]])))
            found = zip(*rows, strict=True) if rows else ((), (), ())
            arrays = [*batch.columns[:-1], *[pa.array(c, t) for c, t in zip(found, (pa.string(), pa.float64(), pa.bool_()), strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], *FOUND])

    rows = docs.select(*[F.col(c).alias(f"_own{k}") for k, c in enumerate(own)], blank(text_col).alias("_scored"))
    fields = [f for f in rows.schema.fields if f.name != "_scored"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + "".join(f", {c} {t}" for c, t in zip(FOUND, ("string", "double", "boolean"), strict=True))
    kept = [F.col(f"_own{k}").alias(c) for k, c in enumerate(own) if c not in FOUND]
    return rows.mapInArrow(run, schema).select(*kept, *FOUND)
