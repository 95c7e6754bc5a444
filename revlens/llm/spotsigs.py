"""SpotSigs document fingerprints: chains of content words that follow common-word anchors.

A signature is an anchor (a common word) with the next ``chain`` content words behind it; a document's fingerprint is the
set of its signatures as sorted 32-bit hashes. Stretches of a text that such chains leave unread (a language without
known anchors, code, word lists) are read by word n-grams chosen by their hash. Likeness is the Jaccard similarity of two such sets. For a similarity join
the sets are partitioned by their length: two sets can only reach a threshold if their lengths are within its ratio.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MIX, blank, cut, gram_hashes, sliding_min, units_for

#: Common words of four languages, anchors without learning and beside the learned ones.
ANCHORS = frozenset(
    """a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were
    which will with you der die das und ist nicht ein eine einer einem einen den dem des zu mit sich auf für im von es sie er wir als auch
    el la los las un una unos unas y o de del que en se no por con para su al lo como más pero le les des et est une du dans pour qui sur
    au aux avec pas ce cette il elle ils nous vous ne sont ont plus""".split()
)
CHAIN = 2
WORD = re.compile(r"[^\W\d_]+")
#: Words in a row that chains may leave unread; of longer stretches, one n-gram of every FILL is read at least.
GAP, FILL = 12, 4
#: Learned anchors: words of at least COMMON of the documents of their language label and script, the MOST commonest of these,
#: where there are MIN_DOCS such documents. At most MAX_ANCHORS are broadcast.
COMMON, MOST, MIN_DOCS, MAX_ANCHORS = 0.35, 60, 50, 5000
#: Entries that a task counts before it hands them to Spark.
COUNTED = 200_000


class Signer:
    """Signature sets of texts; remembers the code of each word it has met."""

    def __init__(self, chain: int = CHAIN, anchors: frozenset[str] = ANCHORS):
        self.chain, self.codes = chain, Codes(anchors)

    def __call__(self, text: str) -> np.ndarray:
        text = text.lower()
        words = WORD.findall(text)
        if len(words) <= GAP:  # texts of figures and marks: all that is between spaces counts as a word
            tokens = text.split()
            if len(tokens) > max(GAP, 2 * len(words)) or not words:
                words = tokens
        if not words:
            return np.zeros(0, np.uint32)
        if len(self.codes) > 500_000:
            self.codes.clear()
        codes = np.fromiter(map(self.codes.__getitem__, words), np.uint64, len(words))
        common = (codes & np.uint64(1)).astype(bool)
        # The start of a text counts as an anchor, so that every text with a word has a signature.
        anchors = np.concatenate([[-1], np.flatnonzero(common)])
        content = np.append(np.flatnonzero(~common), [len(words)] * self.chain)
        first = np.searchsorted(content, anchors, side="right")
        plain, codes = codes, np.append(codes, np.uint64(0))
        sig = np.where(anchors < 0, np.uint64(7), codes[anchors])
        whole = np.ones(len(anchors), bool)
        places = [anchors]
        for k in range(self.chain):
            at = content[np.minimum(first + k, len(content) - 1)]
            places.append(at)
            whole &= at < len(words)
            sig = (sig ^ codes[at]) * MIX
            sig ^= sig >> np.uint64(32)
        read = np.zeros(len(words) + 2, bool)  # place -1 is the last one, a missing content word the one before
        for at in places:
            read[at[whole]] = True
        whole[0] = True
        found = sig[whole].astype(np.uint32)
        more = self.unread(plain, read[: len(words)])
        if len(more):
            found = np.concatenate([found, more])
        elif len(found) == 1:  # a short text without chains is read as a whole
            found = (gram_hashes(plain, len(words)) >> np.uint64(32)).astype(np.uint32)
        return np.unique(found)

    def unread(self, codes: np.ndarray, read: np.ndarray) -> np.ndarray:
        """Hashes of the n-grams that are the smallest of some FILL in a row, in stretches of more than GAP unread words."""
        edges = np.concatenate([[-1], np.flatnonzero(read), [len(read)]])
        long = np.flatnonzero(np.diff(edges) - 1 > GAP)
        if not len(long):
            return np.zeros(0, np.uint32)
        out = []
        for k in long:
            grams = gram_hashes(codes[edges[k] + 1 : edges[k + 1]], self.chain + 1)
            least = sliding_min(grams, FILL) if len(grams) >= FILL else grams.min(keepdims=True)
            out.append(np.unique(least) >> np.uint64(32))
        return np.concatenate(out).astype(np.uint32)


class Codes(dict):
    """64-bit code of a word, odd for anchors."""

    def __init__(self, anchors: frozenset[str]):
        self.anchors = anchors

    def __missing__(self, word: str) -> int:
        code = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~1 | (word in self.anchors)
        return code


def script_of(word: str) -> str:
    return unicodedata.name(word[0], "").split(" ")[0]


def learn_anchors(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> frozenset[str]:
    """The words that are common among the documents of a language label (null: "") and script, with ANCHORS.

    All documents are counted, exact copies once a task, so that a text copied through the corpus does not make its words
    common. Labels and scripts with less than MIN_DOCS documents get no anchors of their own.
    """
    lang = blank(lang_col) if lang_col in docs.columns else F.lit("")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        total: Counter = Counter()
        scripts: dict[str, str] = {}

        def entries() -> pa.RecordBatch:
            columns = zip(*((*k, n) for k, n in total.items()), strict=True)
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "script", "word", "n"])
            return rows.sort_by("word")  # neighbours that begin alike take less room when they are exchanged

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
                if key in met:
                    continue
                met.add(key)
                seen = set()
                for word in set(WORD.findall(text.lower())):
                    script = scripts.get(word[0]) or scripts.setdefault(word[0], script_of(word))
                    total[label, script, word] += 1
                    seen.add(script)
                for script in seen:
                    total[label, script, ""] += 1
                if len(total) > COUNTED:
                    yield entries()
                    total.clear()
        if total:
            yield entries()

    counts = docs.select(lang.cast("string").alias("lang"), blank(text_col).alias("text")).mapInArrow(count, "lang string, script string, word string, n long")
    counts = cut(counts.groupBy("lang", "script", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON * MIN_DOCS))
    groups = counts.filter((F.col("word") == "") & (F.col("n") >= MIN_DOCS)).orderBy(F.desc("n"), "lang", "script").limit(MAX_ANCHORS)
    groups = F.broadcast(groups.select("lang", "script", F.col("n").alias("docs")))
    learned = counts.join(groups, ["lang", "script"]).filter((F.col("word") != "") & (F.col("n") >= COMMON * F.col("docs")))
    rank = F.row_number().over(Window.partitionBy("lang", "script").orderBy(F.desc("n"), "word"))
    learned = learned.withColumn("rank", rank).filter(F.col("rank") <= MOST)
    best = learned.groupBy("word").agg(F.max("n").alias("n")).orderBy(F.desc("n"), "word").limit(MAX_ANCHORS)
    return ANCHORS | {r["word"] for r in best.collect()}


def jaccard(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 without merging them where their lengths rule ``at_least`` out. Two empty sets: 1."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < at_least * large:
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (small + large - shared)


def hex_set(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents to ranges of ids so that each range also holds the first document of the range that follows it.

    Ranges are those of a range partitioning of the ids; texts are shuffled once. Returns part, ghost, doc_id, text,
    ordered within a part by descending id with the ghost (the next range's first document) at the end. Null ids count
    as the smallest.
    """
    lowest = -(2**63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("doc_id"), blank(text_col).alias("text"))
    parts = 2 * units_for(rows)
    # the ranges that Spark itself makes of the ids, which alone are shuffled for this; a row a range comes to the driver
    ranges = rows.select("doc_id").repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("part")).agg(F.max("doc_id").alias("top"))
    tops = np.array(sorted(r["top"] for r in ranges.collect()), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "ghost", "doc_id", "text"]
        for batch in batches:
            at = batch.column(0).to_numpy()
            part = np.searchsorted(tops, at)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.zeros(len(at), bool)), batch.column(0), batch.column(1)], names)
            hit = np.flatnonzero(tops[part] == at)
            if len(hit):  # the largest of a range follows on the smallest of the next; that of the last on the smallest of all
                to = (part[hit] + 1) % len(tops)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.ones(len(hit), bool)), batch.column(0).take(pa.array(hit)), batch.column(1).take(pa.array(hit))], names)

    dealt = rows.mapInArrow(deal, "part long, ghost boolean, doc_id long, text string")
    return dealt.repartition(units_for(rows), "part").sortWithinPartitions("part", "ghost", F.desc("doc_id"), "text")


def fingerprints(docs: DataFrame, *, chain: int = CHAIN, anchors: frozenset[str] = ANCHORS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each whole text, and its edit: the last third replaced by the start of the next document.

    The next document is that with the next smaller id (after the smallest, the largest); a single document follows
    itself. Null text is empty; an empty text's fingerprint is empty and like only to another empty one. Rows that share
    an id are ordered by their text. ``anchors`` are the fixed words or those of ``learn_anchors``. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, the fingerprint's length partition (that of
    ``similar_pairs`` at ALIKE) and alike_edited, alike_next: whether the likeness is ALIKE at least, by the pruned
    comparison, which merges no sets of partitions that are further apart.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, length_partition int, alike_edited boolean, alike_next boolean"

    shared = docs.sparkSession.sparkContext.broadcast(anchors)  # at most MAX_ANCHORS words and the fixed ones

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Signer(chain, shared.value)
        held: tuple | None = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for at in range(0, batch.num_rows, 256):
                out = []
                for part, ghost, doc, text in zip(*(c[at : at + 256] for c in columns), strict=True):
                    if held is not None and held[0] == part and ghost >= held[1]:
                        _, was_ghost, before, old, old_sig = held
                        sig = sign(text)
                        if not was_ghost:
                            third = len(old) // 3
                            edited = old[: len(old) - third] + text[:third]
                            other = sign(edited)
                            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                            out.append((before if before != -(2**63) else None, len(old), sha, hex_set(old_sig), hex_set(other), jaccard(old_sig, other), jaccard(old_sig, sig), partition_of(len(old_sig)), alike(old_sig, other), alike(old_sig, sig)))
                        held = (part, ghost, doc, text, sig)
                    else:
                        held = (part, ghost, doc, text, sign(text))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), KINDS, strict=True)], NAMES)

    return with_next(docs, id_col=id_col, text_col=text_col).mapInArrow(run, schema)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "length_partition", "alike_edited", "alike_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.bool_()]
#: Documents are alike from this Jaccard similarity of their fingerprints on.
ALIKE = 0.8


def partition_of(size: int, threshold: float = ALIKE) -> int:
    """Number of the length partition: sets of one partition are within the threshold's ratio of its first length."""
    return int(np.floor(np.log(max(size, 1)) / np.log(1 / threshold)))


def alike(a: np.ndarray, b: np.ndarray, threshold: float = ALIKE) -> bool:
    """Whether two sets' Jaccard similarity is ``threshold`` at least; sets of partitions that are not neighbours are not merged."""
    if abs(partition_of(len(a), threshold) - partition_of(len(b), threshold)) > 1:
        return False
    return jaccard(a, b, threshold) >= threshold


def length_partition(size: F.Column, threshold: float) -> F.Column:
    """Number of the length partition; sets of one partition are within the threshold's ratio of its first length."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.log(F.lit(1 / threshold))).cast("int")


def similar_pairs(prints: DataFrame, threshold: float = ALIKE) -> DataFrame:
    """Pairs of different fingerprints with Jaccard of at least ``threshold``, with the ids that stand for them.

    Input: doc_id, fingerprint. Equal fingerprints are first folded to their smallest id. Sets meet on a signature of
    their prefix (in the order of the hashes, the first that any pair above the threshold must have in common) within equal
    or neighbouring length partitions; only ids and lengths are on the rows that meet. Pairs are then confirmed on the full
    sets. Empty fingerprints are like nothing. Returns doc_id, other_id, likeness.
    """
    sets = prints.filter("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    sets = sets.withColumn("n", (F.length("fingerprint") / 8).cast("int"))
    sigs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("fingerprint", i * 8 + 1, F.lit(8)))
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1
    posts = sets.select("doc_id", "n", length_partition(F.col("n"), threshold).alias("level"), F.explode(F.slice(F.array_sort(sigs), F.lit(1), prefix)).alias("sig"))
    right = posts.withColumn("level", F.explode(F.array(F.col("level"), F.col("level") - 1))).select("sig", "level", F.col("doc_id").alias("other_id"), F.col("n").alias("m"))
    # a pair of one partition is met from either side, a pair of neighbouring ones once
    pairs = posts.join(right, ["sig", "level"]).filter((F.col("doc_id") != F.col("other_id")) & (F.least("n", "m") >= F.greatest("n", "m") * threshold - 1e-9))
    pairs = pairs.select(F.least("doc_id", "other_id").alias("doc_id"), F.greatest("doc_id", "other_id").alias("other_id")).distinct()
    full = sets.select("doc_id", "n", sigs.alias("sigs"))
    pairs = pairs.join(full, "doc_id").join(full.select(F.col("doc_id").alias("other_id"), F.col("n").alias("m"), F.col("sigs").alias("others")), "other_id")
    shared = F.size(F.array_intersect("sigs", "others"))
    pairs = pairs.withColumn("likeness", shared / (F.col("n") + F.col("m") - shared)).filter(F.col("likeness") >= threshold - 1e-12)
    return pairs.select("doc_id", "other_id", "likeness")
