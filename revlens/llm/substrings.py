"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words. A word is removed if a window that covers it has a word sequence that also
starts in a document with a smaller id. Hashes only propose; texts decide:

1. every window is represented by the smallest of its inner ``seed`` -word hashes (equal windows have equal ones); seeds
   met only once in the corpus are dropped;
2. of the windows whose seed recurs, the smallest id that has each is found by its own 96-bit hash. A work unit learns
   which of its windows start in a smaller document (proposals), and that document's unit, who wants to know its text;
3. that unit sends the passages themselves, runs of wanted windows, to the units that hold later copies;
4. a unit cuts its proposals to phrases, compiles them to Aho-Corasick automata of bounded size (pyahocorasick) and
   streams the passages sent to it and all of its documents through each. The smallest document in which a phrase is found
   decides: in all later ones its words go. Phrases that their proposed document does not have in one piece are tested
   again window by window.

Nothing that is exchanged grows with how often a passage occurs within a unit. Texts are shuffled once, by unit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, blank, gram_hashes, mix64, sliding_min, sorted_member, text_bytes, units_for, word_hashes

WINDOW = 13
SEED = 6
#: An automaton holds phrases of about this many characters, a phrase at most this many windows.
SHARD_CHARS = 1_000_000
PHRASE_WINDOWS = 2_000
NO_ID = -(2**63)

KINDS = {"bucket": pa.int64(), "unit": pa.int64(), "hashes": pa.binary(), "extra": pa.binary(), "more": pa.binary(), "doc": pa.int64(), "text": pa.binary()}
#: What a unit is told: hashes with extra (ids) are proposals, with more (units) too they are wanted from it; or a passage.
REPLY = ["unit", "hashes", "extra", "more", "doc", "text"]


def seed_minima(words: np.ndarray, window: int, seed: int) -> np.ndarray:
    """For each window, the smallest scrambled hash of its inner runs of ``seed`` words."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    return sliding_min(mix64(gram_hashes(words, seed)), window - seed + 1)


def second_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """32 bits of another hash of each window."""
    return (gram_hashes(mix64(words * MIX), window) >> np.uint64(32)).astype(np.uint32)


def dealt(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of the sorted ``hashes`` by bucket (their high bits)."""
    edges = np.searchsorted(hashes, np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)) if buckets > 1 else []
    cuts = [0, *map(int, edges), len(hashes)]
    return ((k, slice(a, b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a)


def rows_of(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, KINDS[n]) for c, n in zip(columns, names, strict=True)], names)


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), dtype)


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows of sorted columns start."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]))


def least_owner(hashes: np.ndarray, docs: np.ndarray, known: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Per window of a unit, the smallest document proposed for it: one of the unit or one that it was told of."""
    values, ids = np.concatenate([hashes, known]), np.concatenate([docs, owners])
    order = np.argsort(values, kind="stable")
    starts = run_starts(values[order])
    out = np.empty(len(values), np.int64)
    if len(values):
        out[order] = np.repeat(np.minimum.reduceat(ids[order], starts), np.diff(np.append(starts, len(values))))
    return out[: len(hashes)]


class Phrases:
    """Phrases of one automaton: text to (number of words, smallest document proposed for it)."""

    def __init__(self):
        self.found: dict[bytes, tuple[int, int]] = {}
        self.chars = 0

    def add(self, words: list[bytes], owner: int) -> None:
        phrase = b" " + b" ".join(words) + b" "
        if phrase not in self.found:
            self.chars += len(phrase)
        self.found[phrase] = (len(words), min(owner, self.found.get(phrase, (0, owner))[1]))


def proposals(docs: list[tuple[int, bytes]], limits: np.ndarray, sizes: np.ndarray, window: int) -> list[Phrases]:
    """The runs of windows that have one and the same smaller document, in shards."""
    out, at = [Phrases()], 0
    for (doc, text), n in zip(docs, sizes, strict=True):
        own = limits[at : at + n]
        at += n
        if not (own < doc).any():
            continue
        words, starts = text.split(), run_starts(own)
        for a, b in zip(starts, np.append(starts[1:], n), strict=True):
            if own[a] < doc:
                for k in range(a, b, PHRASE_WINDOWS):
                    out[-1].add(words[k : min(b, k + PHRASE_WINDOWS) + window - 1], int(own[a]))
        if out[-1].chars > SHARD_CHARS:
            out.append(Phrases())
    return out


def locate(shard: Phrases, passages: list[tuple[int, bytes]], docs: list[tuple[int, bytes]], masks: list[np.ndarray | None], window: int) -> list[Phrases]:
    """Find every occurrence of the shard's phrases, mark in ``masks`` what goes, and return what is to be tested again."""
    import ahocorasick

    if not shard.found:
        return []
    automaton, phrases = ahocorasick.Automaton(), list(shard.found.items())
    for k, (phrase, _) in enumerate(phrases):
        automaton.add_word(phrase.decode("latin-1"), k)
    automaton.make_automaton()
    owner = [2**63] * len(phrases)
    places: list[tuple[int, int, int]] = []
    for k, (doc, text) in enumerate([*passages, *docs]):
        line = " " + b" ".join(text.split()).decode("latin-1") + " "
        for end, phrase in automaton.iter(line):
            owner[phrase] = min(owner[phrase], doc)
            if k >= len(passages):
                places.append((k - len(passages), end, phrase))
    begins, last = np.zeros(0, np.int64), -1
    for k, end, phrase in places:
        doc, text = docs[k]
        if owner[phrase] < doc:
            if k != last:
                words = text.split()
                begins, last = np.cumsum([0, *(len(w) + 1 for w in words)]), k
                if masks[k] is None:
                    masks[k] = np.zeros(len(words), bool)
            first = int(np.searchsorted(begins, end + 1 - len(phrases[phrase][0])))
            masks[k][first : first + phrases[phrase][1][0]] = True
    again = [Phrases()]
    for k, (phrase, (n, wanted)) in enumerate(phrases):
        if n > window and owner[k] > wanted:
            words = phrase.split()
            for at in range(n - window + 1):
                again[-1].add(words[at : at + window], wanted)
            if again[-1].chars > SHARD_CHARS:
                again.append(Phrases())
    return again


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, seed: int = SEED, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller id.

    Words are runs of bytes other than space and 0x09-0x0D. Null or blank text has no words. A null id counts as the
    smallest; rows that share an id do not remove one another's words. Returns doc_id, n_words, n_removed, kept_sha256
    and, with ``texts``, the kept words joined by one space; one row per input row.
    """
    if not 0 < seed <= window:
        raise ValueError("seed must be between 1 and window")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), blank(text_col).alias("text"))
    units = buckets = units_for(rows)
    rows = rows.withColumn("unit", F.pmod(F.xxhash64("doc_id"), F.lit(units))).repartition(units, "unit")

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = batch.column(2).to_numpy()
            words = batch.column(1).cast(pa.large_binary())
            for u in np.unique(unit):
                found = []
                for k in np.flatnonzero(unit == u):
                    text = words[int(k)].as_py()
                    found.append(np.unique(seed_minima(word_hashes(text.split()), window, seed)))
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                out = [(b, int(u), values[s].tobytes(), np.packbits(counts[s] > 1).tobytes()) for b, s in dealt(values, buckets)]
                yield from rows_of(out, ["bucket", "unit", "hashes", "extra"]).to_batches()

    def recurring(table: pa.Table) -> pa.Table:
        units_ = table.column("unit").to_numpy()
        parts = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool) for x, p in zip(table.column("extra").to_pylist(), parts, strict=True)]
        values = np.concatenate(parts)
        ordered = np.sort(values)
        again = np.unique(np.concatenate([ordered[1:][ordered[1:] == ordered[:-1]], values[np.concatenate(twice)]]))
        out = []
        for u, part in zip(units_, parts, strict=True):
            if len(hit := part[sorted_member(part, again)]):
                out.append((int(u), hit.tobytes()))
        return rows_of(out, ["unit", "hashes"])

    def confirm(group: pa.Table, known: pa.Table) -> pa.Table:
        names = ["bucket", "unit", "hashes", "extra", "more"]
        again = np.unique(joined(known.column("hashes"), np.uint64))
        if not len(again) or not group.num_rows:
            return rows_of([], names)
        hashes, seconds, owners = [], [], []
        for doc, text in zip(group.column("doc_id").to_pylist(), text_bytes(group.column("text")), strict=True):
            words = word_hashes(text.split())
            hit = sorted_member(seed_minima(words, window, seed), again)
            if hit.any():
                hashes.append(gram_hashes(words, window)[hit])
                seconds.append(second_hashes(words, window)[hit])
                owners.append(np.full(len(hashes[-1]), doc, np.int64))
        if not hashes:
            return rows_of([], names)
        values, checks, ids = map(np.concatenate, (hashes, seconds, owners))
        order = np.lexsort((checks, values))
        values, checks, ids = values[order], checks[order], ids[order]
        starts = run_starts(values, checks)
        values, checks, least = values[starts], checks[starts], np.minimum.reduceat(ids, starts)
        unit = group.column("unit")[0].as_py()
        return rows_of([(b, unit, values[s].tobytes(), least[s].tobytes(), checks[s].tobytes()) for b, s in dealt(values, buckets)], names)

    def elsewhere(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        values, ids, checks = np.concatenate(parts), joined(table.column("extra"), np.int64), joined(table.column("more"), np.uint32)
        unit = np.repeat(table.column("unit").to_numpy(), [len(p) for p in parts])
        order = np.lexsort((ids, checks, values))
        values, ids, unit, checks = values[order], ids[order], unit[order], checks[order]
        starts = run_starts(values, checks)
        first = np.repeat(starts, np.diff(np.append(starts, len(values))))
        later = np.flatnonzero((ids > ids[first]) & (unit != unit[first]))
        first = first[later]
        out = []
        for mine, from_, more in ((unit[later], ids[first], None), (unit[first], ids[first], unit[later])):
            by = np.argsort(mine, kind="stable")
            edges = run_starts(mine[by])
            for a, b in zip(edges, np.append(edges[1:], len(by)), strict=True):
                k = by[a:b]
                out.append((int(mine[k[0]]), values[later[k]].tobytes(), from_[k].tobytes(), None if more is None else more[k].astype(np.int32).tobytes(), None, None))
        return rows_of(out, REPLY)

    def serve(group: pa.Table, told: pa.Table) -> pa.Table:
        """Passages for the units that want them; the unit's own proposals go on to the next step."""
        asked = pa.compute.is_valid(told.column("more"))
        wanted = told.filter(asked)
        hashes, ids, to = joined(wanted.column("hashes"), np.uint64), joined(wanted.column("extra"), np.int64), joined(wanted.column("more"), np.int32)
        order = np.lexsort((hashes, ids))
        hashes, ids, to = hashes[order], ids[order], to[order]
        out = []
        for doc, text in zip(group.column("doc_id").to_pylist(), text_bytes(group.column("text")), strict=True):
            a, b = np.searchsorted(ids, [doc, doc + 1])
            if a == b:
                continue
            words = text.split()
            grams = gram_hashes(word_hashes(words), window)
            low, high = a + np.searchsorted(hashes[a:b], grams), a + np.searchsorted(hashes[a:b], grams, side="right")
            n = high - low
            place = np.repeat(np.arange(len(grams)), n)
            unit = to[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
            order = np.lexsort((place, unit))
            place, unit = place[order], unit[order]
            starts = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (place[1:] > place[:-1] + 1)])) if len(unit) else []
            for x, y in zip(starts, np.append(starts[1:], len(unit)), strict=True):
                out.append((int(unit[x]), None, None, None, doc, b" ".join(words[place[x] : place[y - 1] + window])))
        own = told.filter(pa.compute.invert(asked))
        return pa.concat_tables([own, rows_of(out, REPLY).cast(own.schema)])

    def strip(group: pa.Table, told: pa.Table) -> pa.Table:
        known, owners = joined(told.column("hashes"), np.uint64), joined(told.column("extra"), np.int64)
        passages = [(d, t) for d, t in zip(told.column("doc").to_pylist(), told.column("text").to_pylist(), strict=True) if t is not None]
        mine = list(zip(group.column("doc_id").to_pylist(), text_bytes(group.column("text")), strict=True))
        grams = [gram_hashes(word_hashes(text.split()), window) for _, text in mine]
        sizes = np.array([len(g) for g in grams], np.int64)
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        limits = least_owner(hashes, np.repeat(np.array([d for d, _ in mine], np.int64), sizes), known, owners)
        masks: list[np.ndarray | None] = [None] * len(mine)
        waiting = proposals(mine, limits, sizes, window)
        while waiting:
            waiting += locate(waiting.pop(), passages, mine, masks, window)
        out = []
        for (doc, text), mask in zip(mine, masks, strict=True):
            words = text.split()
            kept = b" ".join(words if mask is None else compress(words, ~mask))
            out.append((doc if doc != NO_ID else None, len(words), 0 if mask is None else int(mask.sum()), hashlib.sha256(kept).hexdigest(), kept if texts else None))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        table = pa.table(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "text"])
        return table.set_column(4, "text", table.column("text").cast(pa.string())) if texts else table.drop_columns("text")

    blob = "bucket long, unit long, hashes binary, extra binary"
    reply = "unit long, hashes binary, extra binary, more binary, doc long, text binary"
    mine = rows.groupBy("unit")
    again = rows.mapInArrow(seeds, blob).groupBy("bucket").applyInArrow(recurring, "unit long, hashes binary")
    windows = mine.cogroup(again.groupBy("unit")).applyInArrow(confirm, blob + ", more binary")
    told = windows.groupBy("bucket").applyInArrow(elsewhere, reply)
    told = mine.cogroup(told.groupBy("unit")).applyInArrow(serve, reply)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if texts else "")
    return mine.cogroup(told.groupBy("unit")).applyInArrow(strip, schema)
