"""Repair of conversation structure: the cheapest audit of edits that makes a conversation alternate.

Faults are found by Spark on rows without their text: equal rows are counted, a row's first occurrence is an aggregate, and rows
are dealt to ranges of (conversation, turn, role, digest), so that a conversation of any length is spread over many ranges. Each
range gives one row a conversation: its counts, and the cheapest audits between the states of the grammar, found by a
persistent DP. A second pass streams, conversation by conversation, first these rows, which it joins to one audit, and then
the texts in the same order, which go through the digest of the repaired conversation; it holds one audit and one batch.

Rows of equal turn are ordered by role, then by the SHA-256 of their text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import record_batch, shuffle_partitions

#: White space, ends of sentences, and the costs of edits.
WHITE = r"[\x09-\x0D\x20]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the grammar (s?(ua)+)?: nothing yet, behind the system turn, behind a user turn, behind an assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
PRIME, BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Edit prefixes as linked nodes: each knows its parent, its ancestors at powers of two, and a rolling hash.

    Prefixes share their nodes. Two prefixes are compared by lifting both to the last place at which their hashes agree, the
    longest common prefix; that this really is common is verified letter by letter up to the node that they share.
    """

    def __init__(self, base: int = BASE, prime: int = PRIME):
        self.base, self.prime = base, prime
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]  # ancestors 1, 2, 4, ... steps above

    def add(self, parent: int, letters: str) -> int:
        for c in letters:
            node = len(self.letter)
            above = [parent]
            while (k := len(above)) <= len(self.up[above[-1]]) and self.depth[above[-1]] >= 1 << (k - 1):
                above.append(self.up[above[-1]][k - 1])
            self.letter.append(c)
            self.depth.append(self.depth[parent] + 1)
            self.hash.append((self.hash[parent] * self.base + ord(c)) % self.prime)
            self.up.append(above)
            parent = node
        return parent

    def lift(self, node: int, depth: int) -> int:
        while (rest := self.depth[node] - depth) > 0:
            node = self.up[node][rest.bit_length() - 1]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, a: int, b: int) -> bool:
        """Whether prefixes of equal length are equal, by their letters."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the prefix ``a`` comes before ``b``; one that the other begins with comes first."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if self.hash[x] == self.hash[y]:
            if self.same(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)  # hashes collide
        while self.depth[x] > 1:
            step = next((k for k in range(len(self.up[x]) - 1, -1, -1) if self.hash[self.up[x][k]] != self.hash[self.up[y][k]]), None)
            if step is None:
                break
            x, y = self.up[x][step], self.up[y][step]
        if not self.same(self.up[x][0], self.up[y][0]):
            return self.text(a) < self.text(b)  # hashes collide
        return self.letter[x] < self.letter[y]


def best(audits: Audits, options: list[tuple[int, int, str]]) -> tuple[int, int] | None:
    """The cheapest of (cost, prefix, letters behind it), of equal ones the least in ASCII; its new node is made."""
    if not options:
        return None
    least = min(x[0] for x in options)
    nodes = [audits.add(n, s) for c, n, s in options if c == least]
    first = nodes[0]
    for other in nodes[1:]:
        if audits.less(other, first):
            first = other
    return least, first


def run_segment(rows: list[tuple[str, bool, bool]], start: int) -> dict[int, tuple[int, str]]:
    """Cheapest audits from state ``start`` through rows of (initial, must go, truncated), by the state they end in.

    Inserted turns stand right before what is kept (or at the conversation's end, see ``close``): before a deletion they cost
    the same and are later in ASCII.
    """
    audits = Audits()
    live: dict[int, tuple[int, int]] = {start: (0, 0)}
    for initial, gone, truncated in rows:
        options: dict[int, list[tuple[int, int, str]]] = {q: [(c + DELETE, n, "D")] for q, (c, n) in live.items()}
        if not gone:
            extra = TRUNCATED if truncated else 0
            for target, letter in ((USER, "u"), (ASSISTANT, "a")):
                cost, edit = (KEEP, "K") if initial == letter else (REROLE, "R")
                before = (NONE, SYSTEM, ASSISTANT) if target == USER else (USER,)
                for q, (c, n) in live.items():
                    if q in before:
                        options.setdefault(target, []).append((c + cost + extra, n, edit))
                    else:  # one turn of the other role comes between
                        options.setdefault(target, []).append((c + INSERT + cost + extra, n, "I" + edit))
            if initial == "s" and NONE in live:
                c, n = live[NONE]
                options.setdefault(SYSTEM, []).append((c + extra, n, "K"))
        live = {q: best(audits, x) for q, x in options.items()}
    return {q: (c, audits.text(n)) for q, (c, n) in live.items()}


def close(live: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The cheapest whole audit: after a user turn an assistant's is put in, after a system turn both."""
    ends = {NONE: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
    return min((c + INSERT * ends[q], s + "I" * ends[q]) for q, (c, s) in live.items())


def through(live: dict[int, tuple[int, str]], segment: dict[tuple[int, int], tuple[int, str]]) -> dict[int, tuple[int, str]]:
    out: dict[int, tuple[int, str]] = {}
    for (p, q), (c, s) in segment.items():
        if p in live:
            found = (live[p][0] + c, live[p][1] + s)
            out[q] = min(out.get(q, found), found)
    return out


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the contract's damage: a row in twenty each is dropped, emptied, loses its sentence ends,
    is repeated, or becomes the user's. Null roles and texts are one space; in the key, so are null ids and turns."""
    kind = F.pmod(F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]).cast("binary")), F.lit(20))
    held = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("_kind")).filter("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    return held.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def flagged(rows: DataFrame) -> DataFrame:
    """The rows without text, one each: conv_id, turn, role, key, copy, blank, duplicate, truncated."""
    last = F.regexp_extract("text", rf"([^\x09-\x0D\x20]){WHITE}*\z", 1)
    narrow = rows.select("conv_id", "turn", "role", text_key(F.col("text")).alias("key"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), F.col("copies").cast("long").alias("copies"))
    each = narrow.groupBy("conv_id", "turn", "role", "key", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    first = each.groupBy("conv_id", "role", "key").agg(F.bool_or(F.col("turn").isNull()).alias("_none"), F.min("turn").alias("_first"))
    first = first.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"), F.when(~F.col("_none"), F.col("_first")).alias("_first"))
    joined = each.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    out = joined.select("conv_id", "turn", "role", "key", "blank", "truncated", "_first", copy)
    return out.select("conv_id", "turn", "role", "key", "copy", "blank", (~F.col("turn").eqNullSafe(F.col("_first")) | (F.col("copy") > 0)).alias("duplicate"), "truncated")


AUDIT = "array<struct<start:int,end:int,cost:long,audit:string>>"
SEGMENT_FIELDS = [
    ("conv_id", pa.int64()), ("part", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
    ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64()), ("audits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
]
SEGMENT = f"conv_id long, part long, blank long, duplicate long, truncated long, illegal long, head string, tail string, least long, most long, turns long, audits {AUDIT}"
LEGAL = {"su", "ua", "au"}


def segment_row(conv: int | None, part: int, rows: list[tuple], whole: bool) -> tuple:
    """One row of SEGMENT for rows of (turn, initial, blank, duplicate, truncated); ``whole``: the conversation begins here."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1] for r in rows]
    edits = [(i, b or d, t) for _, i, b, d, t in rows]
    audits = [{"start": p, "end": q, "cost": c, "audit": s} for p in ([NONE] if whole else range(4)) for q, (c, s) in run_segment(edits, p).items()]
    faults = [sum(r[2] for r in rows), sum(r[3] and not r[2] for r in rows), sum(r[4] and not (r[2] or r[3]) for r in rows)]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return conv, part, *faults, illegal, initials[0], initials[-1], min(turns, default=None), max(turns, default=None), len(set(turns)), audits


def segments(rows: DataFrame) -> DataFrame:
    """Rows of ``flagged`` to a row a conversation and range of rows. Only the first conversation of a range may have begun in
    an earlier one: for it, audits from every state are found."""
    order = ["conv_id", "turn", "role", "key", "copy"]
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", F.spark_partition_id().cast("long").alias("part"), "turn", F.substring("role", 1, 1).alias("initial"), "blank", "duplicate", (F.col("truncated") & ~F.col("blank") & ~F.col("duplicate")).alias("truncated"))
    schema = pa.schema(SEGMENT_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now: tuple | None = None
        first, out = True, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for conv, part, *row in zip(*columns, strict=True):
                if (conv, part) != now:
                    if now is not None:
                        out.append(segment_row(*now, held, not first))
                        first = False
                    now, held = (conv, part), []
                held.append(tuple(row))
            if out:
                yield record_batch(schema, zip(*out, strict=True))
                out = []
        if now is not None:
            yield record_batch(schema, zip(*[segment_row(*now, held, not first)], strict=True))

    return dealt.mapInArrow(run, SEGMENT)


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
RESULT_SCHEMA = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Conversation:
    """Joins a conversation's segments in their order, then follows its audit along the texts."""

    def __init__(self, conv: int | None):
        self.conv, self.live = conv, {NONE: (0, "")}
        self.settled: list[str] = []  # what all live audits begin with
        self.counts, self.turns = np.zeros(4, np.int64), 0
        self.tail: str | None = None
        self.least: int | None = None
        self.most: int | None = None
        self.audit: str | None = None
        self.cost = 0

    def segment(self, x: dict) -> None:
        self.counts += [x["blank"], x["duplicate"], x["truncated"], x["illegal"]]
        if self.tail is not None:
            self.counts[3] += self.tail + x["head"] not in LEGAL
        self.tail = x["tail"]
        if x["least"] is not None:
            self.turns += x["turns"] - (x["least"] == self.most)
            self.least = x["least"] if self.least is None else self.least
            self.most = x["most"]
        self.live = through(self.live, {(a["start"], a["end"]): (a["cost"], a["audit"]) for a in x["audits"]})
        common = len(os.path.commonprefix([s for _, s in self.live.values()]))
        self.settled.append(next(iter(self.live.values()))[1][:common])
        self.live = {q: (c, s[common:]) for q, (c, s) in self.live.items()}

    def begin(self) -> None:
        self.cost, rest = close(self.live)
        self.audit = "".join(self.settled) + rest
        self.place, self.state, self.sha, self.some = 0, NONE, hashlib.sha256(), False

    def put(self, line: str) -> None:
        self.sha.update(("\n" if self.some else "") .encode() + line.encode())
        self.some = True

    def inserted(self) -> None:
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.state = ASSISTANT if self.state == USER else USER
            self.put("user:" if self.state == USER else "assistant:")
            self.place += 1

    def text(self, role: str, text: str, copies: int) -> None:
        if self.audit is None:
            self.begin()
        for _ in range(copies):
            self.inserted()
            edit = self.audit[self.place]
            self.place += 1
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                self.state = SYSTEM
            else:
                self.state = ASSISTANT if self.state == USER else USER
            self.put(f"{role if edit == 'K' else 'user' if self.state == USER else 'assistant'}:{text}")

    def row(self) -> tuple:
        if self.audit is None:
            self.begin()
        self.inserted()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return self.conv, gaps, *self.counts.tolist(), self.cost, self.audit, self.sha.hexdigest()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row a conversation of ``rows`` (conv_id, turn, role, text, copies) and its ``segments``."""
    nothing = {c: F.lit(None).cast(t) for c, t in (("part", "long"), ("audits", AUDIT), ("turn", "long"), ("role", "string"), ("text", "string"))}
    names = ["conv_id", "kind", "part", "blank", "duplicate", "truncated", "illegal", "head", "tail", "least", "most", "turns", "audits", "turn", "role", "key", "text", "copies"]
    left = found.withColumns({"kind": F.lit(0), **{c: nothing[c] for c in ("turn", "role", "text")}, "key": F.lit(None).cast("binary"), "copies": F.lit(None).cast("int")})
    right = rows.withColumns({"kind": F.lit(1), **{c: nothing[c] for c in ("part", "audits")}, "key": text_key(F.col("text")), **{c: F.lit(None).cast("string") for c in ("head", "tail")}, **{c: F.lit(None).cast("long") for c in ("blank", "duplicate", "truncated", "illegal", "least", "most", "turns")}})
    stream = left.select(*names).unionByName(right.select(*names)).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "turn", "role", "key").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        for batch in batches:
            out = []
            columns = {name: batch.column(k).to_pylist() for k, name in enumerate(batch.schema.names)}
            for k, conv in enumerate(columns["conv_id"]):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.row())
                    now = Conversation(conv)
                if columns["kind"][k] == 0:
                    now.segment({name: column[k] for name, column in columns.items()})
                else:
                    now.text(columns["role"][k], columns["text"][k], columns["copies"][k])
            if out:
                yield record_batch(RESULT_SCHEMA, zip(*out, strict=True))
        if now is not None:
            yield record_batch(RESULT_SCHEMA, zip(*[now.row()], strict=True))

    return stream.mapInArrow(run, RESULT)


def repair(rows: DataFrame) -> DataFrame:
    """Audit and digest of every conversation of ``rows`` (conv_id, turn, role, text and, if there, copies).

    Rows without an id are one conversation; null turns come first and leave no gaps; null roles and texts are one space;
    repeated rows are duplicates; an empty table gives an empty result; further columns are ignored.
    """
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
    return repaired(rows, segments(flagged(rows)))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """``repair`` after ``damage``, a row for every conversation of ``rows``: zeros and empty texts if none of its rows is left."""
    every = rows.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    found = repair(damage(rows.select("conv_id", "turn", "role", "text")))
    joined = every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("_conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
