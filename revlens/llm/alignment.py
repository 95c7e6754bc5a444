"""Alignment of two tokenizers over the same bytes, by divide and conquer at shared cuts.

Texts are tokenised in blocks of a few MB. A block's intervals start as whole documents; each is cut at a common end near its
middle, which is looked for by bisecting one tokenizer's ends for those of the other, from the middle outwards, and both halves
go on. Intervals without a common end inside are the leaf groups. All intervals of a level go through each step together.

Tokens have at least one byte, so exactly one token of each side ends at a common end: a group's last two are its link. How
often a pair of ids is linked in the corpus is summed from one row a block and pair; each block gets the counts of its own
pairs back. Nothing that is broadcast or gathered grows with the corpus. What is stored and exchanged are rows of a document or
of a pair, as Spark reads thousands of rows at once: with a block's links in a row, a batch of rows was a whole file.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, record_batch, shared_folder
from .packing import BYTE_OF, PATTERN, merge_ranks

BLOCK_BYTES = 4_000_000
#: A task holds a row group when it writes or reads.
ROW_GROUP_BYTES = 16 << 20
#: Words remembered by a task, with their pieces, and their length: a text without spaces is one word.
REMEMBERED = 200_000
REMEMBERED_CHARS = 32
#: What is left to the model: letters of more than two bytes.
UNUSUAL = re.compile("[\u0800-\U0010ffff]")
SPACE = "▁"
WORD = r" *[^ ]+| +"

Tokens = tuple[np.ndarray, bool]


class ByteLevel:
    """Ids of byte-level BPE with special tokens read as plain text, and each id's length in bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        vocab = {k: v for k, v in definition["model"]["vocab"].items()}
        self.bytes_of = {v: bytes(BYTE_OF[c] for c in k) if all(c in BYTE_OF for c in k) else k.encode() for k, v in vocab.items()}
        self.lengths = lengths_of(self.bytes_of)
        found = merge_ranks(definition)
        if found is None:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self.ids = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
        else:
            import tiktoken

            ranked = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=found[0], special_tokens={})
            self.ids = lambda text: np.asarray(ranked.encode_to_numpy(text, disallowed_special=()), "<u4")
        self.lossless = found is not None

    def __call__(self, text: str) -> Tokens:
        """The ids, and whether their bytes are the text's."""
        ids = self.ids(text)
        return ids, self.lossless or b"".join(map(self.bytes_of.get, ids.tolist())) == text.encode()


class Pieces:
    """Ids of a SentencePiece model, which adds a space in front; ``text`` comes with that space.

    Words behind at most one space, of letters up to two bytes, are merged by ``tiktoken`` if the model allows it: no piece goes on
    behind a word with a space, scores fall as ids grow, and each piece is its own encoding (all asked of the vocabulary).
    Both then join the same pairs in the same order. Other words, and texts of other models, go through the model itself.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes_of = {i: bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)}
        self.lengths = lengths_of(self.bytes_of)
        ordinary = {p.replace(SPACE, " "): i for i, p in enumerate(pieces) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        plain = {p: i for p, i in ordinary.items() if "  " not in p and not UNUSUAL.search(p)}
        joined = {p: i for p, i in plain.items() if len(p) > 1}
        scores = [model.get_score(i) for i in joined.values()]
        self.by_word = not any(re.search("[^ ] ", p) for p in ordinary) and all(a > b for a, b in zip(scores, scores[1:], strict=False))
        # a piece that merging does not reach would be found whole by the one and not by the other
        self.by_word &= all(model.encode("\n" + p)[2:] == [i] for p, i in plain.items())
        self.seen: dict[str, Tokens] = {}
        if self.by_word:
            import tiktoken

            # letters of two bytes are joined before anything else
            ids = [plain.get(chr(i), model.piece_to_id(f"<0x{i:02X}>")) if i < 128 else model.piece_to_id(f"<0x{i:02X}>") for i in range(256)]
            order = [p for p in plain if len(p) == 1 and not p.isascii()] + list(joined)
            ranks = {bytes([i]): i for i in range(256)} | {p.encode(): 256 + k for k, p in enumerate(order)}
            self.id_of = np.array(ids + [plain[p] for p in order], "<u4")
            self.ranked = tiktoken.Encoding(path, pat_str=WORD, mergeable_ranks=ranks, special_tokens={})

    def merged(self, text: str) -> np.ndarray:
        return self.id_of[self.ranked.encode_to_numpy(text, disallowed_special=())]

    def whole(self, text: str) -> Tokens:
        """By the model itself, which puts a space in front: a text of spaces alone would get none."""
        ids = self.model.encode(text[1:]) if text.strip(" ") else self.model.encode("a" + text)[1:]
        return np.array(ids, "<u4"), b"".join(map(self.bytes_of.get, ids)) == text.encode()

    def word(self, word: str) -> Tokens:
        found = self.seen.get(word)
        if found is None:
            found = self.whole(word)
            if len(word) <= REMEMBERED_CHARS and len(self.seen) < REMEMBERED:
                self.seen[word] = found
        return found

    def __call__(self, text: str) -> Tokens:
        if not self.by_word or SPACE in text:
            return self.whole(text)
        if plain_word(text):
            return self.merged(text), True
        parts: list[np.ndarray] = []
        same = True
        for plain, words in itertools.groupby(re.findall(WORD, text), key=plain_word):
            if plain:
                parts.append(self.merged("".join(words)))
                continue
            for word in words:
                ids, exact = self.word(word)
                parts.append(ids)
                same &= exact
        return np.concatenate(parts), same


def plain_word(word: str) -> bool:
    return "  " not in word and not UNUSUAL.search(word)


def lengths_of(bytes_of: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(bytes_of) + 1, np.int64)
    for k, v in bytes_of.items():
        out[k] = len(v)
    return out


def near_middle(ends: np.ndarray, among: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range of places ``first..last`` in ``ends``: the place nearest to its middle whose end is also in the sorted
    ``among``, and its place there; -1 if there is none. Rings around the middle double, so a range without one is read once.
    """
    at, there = np.full(len(first), -1, first.dtype), np.full(len(first), -1, first.dtype)
    middle = (first + last) // 2
    open_ = np.flatnonzero(first <= last)
    near = 0
    while len(open_):
        far = max(1, 2 * near)
        if near == 0:
            places, owner = middle[open_], open_
        else:
            steps = np.repeat(np.arange(near, far, dtype=first.dtype), 2)
            steps[1::2] *= -1
            places, owner = (middle[open_][:, None] + steps).ravel(), np.repeat(open_, len(steps))
            inside = (places >= first[owner]) & (places <= last[owner])
            places, owner = places[inside], owner[inside]
        wanted = ends[places]
        found = np.searchsorted(among, wanted)
        hit = np.flatnonzero(among[found] == wanted)
        new = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]] if len(hit) else hit
        at[owner[new]], there[owner[new]] = places[new], found[new]
        open_ = open_[(at[open_] < 0) & ((middle[open_] + far <= last[open_]) | (middle[open_] - far >= first[open_]))]
        near = far
    return at, there


def groups(a_ends: np.ndarray, b_ends: np.ndarray, a_docs: np.ndarray, b_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (token places, exclusive) of the groups on both sides, in order.

    ``a_ends``, ``b_ends``: byte offsets at which tokens end; both last ones are equal. ``a_docs``, ``b_docs``: how many
    tokens stand before each document, and at last their number; documents without tokens are left out.
    """
    place = np.int32 if len(a_ends) + len(b_ends) < 2**30 else np.int64
    a_docs, b_docs = a_docs.astype(place), b_docs.astype(place)
    a0, a1, b0, b1 = a_docs[:-1], a_docs[1:], b_docs[:-1], b_docs[1:]
    some = a1 > a0
    a0, a1, b0, b1 = a0[some], a1[some], b0[some], b1[some]
    end_of = np.zeros(len(a_ends) + 1, b1.dtype)
    while len(a0):
        at, there = near_middle(a_ends, b_ends, a0, np.where(b1 - b0 > 1, a1 - 2, a0 - 1))
        leaf = at < 0
        end_of[a1[leaf]] = b1[leaf]
        a0, a1, b0, b1, at, there = (x[~leaf] for x in (a0, a1, b0, b1, at + 1, there + 1))
        # both halves stay side by side, so ends are looked for in their order
        a0, a1, b0, b1 = (np.stack(x, 1).ravel() for x in ((a0, at), (at, a1), (b0, there), (there, b1)))
    a = np.flatnonzero(end_of).astype(place)
    return a, end_of[a]


def digits(most: int) -> np.ndarray:
    """Decimal digits of 0..most in the first seven bytes of a word, filled up with zero bytes."""
    return np.char.encode(np.arange(most + 1).astype("U7"), "ascii").astype("S8").view("<u8")


def spelled(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, docs: np.ndarray, words: np.ndarray) -> Iterator[bytes]:
    """``a1,a2|b1;...`` of each document. ``docs``: groups up to each document's end; ``words``: the digits of all ids."""
    size_a, size_b = np.diff(ga, prepend=ga.dtype.type(0)), np.diff(gb, prepend=gb.dtype.type(0))
    out = np.empty(len(a) + len(b), "<u8")
    out[np.arange(len(a), dtype=gb.dtype) + np.repeat(gb - size_b, size_a)] = words[a]
    out[np.arange(len(b), dtype=ga.dtype) + np.repeat(ga, size_b)] = words[b]
    chars = out.view(np.uint8).reshape(-1, 8)
    chars[:, 7] = ord(",")
    chars[ga + gb - size_b - 1, 7] = ord("|")
    chars[ga + gb - 1, 7] = ord(";")
    last = docs[np.diff(docs, prepend=0) > 0] - 1
    chars[(ga + gb - 1)[last], 7] = 0
    at = np.r_[0, np.r_[0, ga + gb][docs]].tolist()
    for start, end in itertools.pairwise(at):
        yield chars[start:end].tobytes().translate(None, b"\0")


#: A row a document. ``links``: the place of each link's pair in the block's ``pairs``, which its first document has.
BLOCK_FIELDS = [
    ("block", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
]
BLOCK_TYPE = "block string, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pairs array<long>, counts array<long>"


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def aligned_block(name: str, ids: list, tokens: list[tuple[np.ndarray, np.ndarray]], a_lengths: np.ndarray, b_lengths: np.ndarray, words: np.ndarray) -> list:
    """Rows of BLOCK_FIELDS for documents with their tokens on both sides."""
    a, b = (np.concatenate([t[k] for t in tokens]).astype(np.int32) for k in (0, 1))
    a_docs, b_docs = (np.cumsum([0, *(len(t[k]) for t in tokens)]) for k in (0, 1))
    ga, gb = groups(a_lengths[a].cumsum(dtype=np.uint32), b_lengths[b].cumsum(dtype=np.uint32), a_docs, b_docs)
    upto = np.searchsorted(ga, a_docs[1:], side="right")
    digests = [hashlib.sha256(text).hexdigest() if text else "" for text in spelled(a, b, ga, gb, upto, words)]
    place, pairs = pd.factorize(pair_key(a[ga - 1], b[gb - 1]))
    links = pa.Array.from_buffers(pa.binary(), len(ids), [None, *map(pa.py_buffer, (np.r_[0, 4 * upto].astype("<i4"), place.astype("<u4")))])
    rest = [None] * (len(ids) - 1)
    return [[name] * len(ids), ids, np.diff(a_docs), np.diff(b_docs), np.diff(upto, prepend=0), digests, links, [pairs, *rest], [np.bincount(place, minlength=len(pairs)), *rest]]


def blocks(docs: DataFrame, a_path: str, b_path: str, *, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    schema = pa.schema(BLOCK_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = ByteLevel(a_path), Pieces(b_path)
        task = TaskContext.get().partitionId()
        ids, tokens, size, n = [], [], 0, 0
        none = np.zeros(0, "<u4")
        words = digits(max(len(first.lengths), len(second.lengths)))

        def flush() -> pa.RecordBatch:
            return record_batch(schema, aligned_block(f"{task}-{n}", ids, tokens, first.lengths, second.lengths, words))

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                found = none, none
                if text:
                    (a, a_same), (b, b_same) = first(" " + text), second(" " + text)
                    if a_same and b_same:
                        found = a, b
                ids.append(doc)
                tokens.append(found)
                size += 64 + len(text)
                if size >= block_bytes:
                    yield flush()
                    ids, tokens, size, n = [], [], 0, n + 1
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(text_col).alias("text")).mapInArrow(run, BLOCK_TYPE)


def pair_counts(stored: DataFrame) -> DataFrame:
    """pair, count, best: how often each pair is linked, and whether no pair of the same B id is linked more often."""
    each = stored.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("count"))
    each = each.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = each.groupBy("b").agg(F.max("count").alias("_most"))
    return each.join(most, "b").select("pair", "count", (F.col("count") == F.col("_most")).alias("best"))


def scored(stored: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents with n_links, n_best and count_sum. A block's documents meet one row for each of its own pairs."""
    known = stored.select("block", F.posexplode("pairs").alias("place", "pair")).join(counts, "pair").select(F.col("block").alias("pairs_of"), "place", "count", "best")
    docs = stored.drop("pairs", "counts")
    out = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        links = np.frombuffer(b"".join(rows["links"].to_pylist()), "<u4")
        n = rows["n_groups"].to_numpy()
        ends = np.r_[0, n.cumsum()]
        place = pairs["place"].to_numpy()
        sums = []
        for values in (pairs["best"].cast(pa.int8()), pairs["count"]):
            of = np.zeros(len(place), np.int64)
            of[place] = values.to_numpy()
            sums.append(np.diff(np.r_[0, of[links].cumsum()][ends]))
        return pa.table([rows["doc_id"], rows["n_a"], rows["n_b"], n, n, *sums, rows["groups_sha256"]], schema=out)

    return docs.groupBy("block").cogroup(known.groupBy("pairs_of")).applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Align a byte-level tokenizer's tokens of each whole text with those of a SentencePiece model.

    One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Null and empty texts, and
    texts that either tokenizer doesn't give back byte by byte, have no tokens: zeros and an empty string. Rows that repeat
    an id are aligned each and each counts; a null id stays null; an empty table gives an empty result; further columns are
    ignored. The blocks are written to the shared folder, so lost executors tokenise nothing again.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    blocks(docs, a_path, b_path, id_col=id_col, text_col=text_col, block_bytes=block_bytes).write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    stored = spark.read.schema(BLOCK_TYPE).parquet(path)
    return scored(stored, pair_counts(stored))


def token_groups(text: str, first: Callable[[str], Tokens], second: Callable[[str], Tokens]) -> list[tuple[list[int], list[int]]]:
    """The groups of one text as lists of ids, for looking at an alignment."""
    (a, _), (b, _) = first(" " + text), second(" " + text)
    ga, gb = groups(first.lengths[a].cumsum(), second.lengths[b].cumsum(), np.array([0, len(a)]), np.array([0, len(b)]))
    return [(x.tolist(), y.tolist()) for x, y in zip(np.split(a, ga[:-1]), np.split(b, gb[:-1]), strict=True)]
