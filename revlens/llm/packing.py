"""Best-fit packing of tokenised documents into fixed-length sequences by minimum bin slack.

Tokens are counted once per document; what is packed afterwards are piece *lengths*, of which there are at most
``capacity`` different ones. The packing plan is therefore a function of a histogram of bounded size:

* per bin the longest piece left is taken, and a bitset subset-sum over the lengths still available finds the fullest
  feasible completion (bin slack is minimal for that seed); the combination is applied as often as the counts allow;
* pieces get their place from their rank within their length, which is computed in two levels (count per length and
  bucket, then a rank within the bucket), so that one very common length does not end in one task.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blank, cut, shuffle_partitions

CAPACITY = 1024
END_ID = 2
#: The splitting pattern of byte-level BPE, and its alphabet (printable bytes stand for themselves, the others
#: for the characters from 256 on, in their order).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


def merge_ranks(definition: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks and special tokens of a tokenizer file, if it is plain byte-level BPE whose ids follow the order of its merges.

    Then, and only then, the lowest id is the next merge, and an encoder that knows ranks alone gives the file's own ids.
    """
    model, before, added = definition["model"], definition.get("pre_tokenizer") or {}, definition.get("added_tokens") or []
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain &= before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and definition.get("normalizer") is None
    plain &= all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
    if not plain:
        return None
    special = {t["content"]: t["id"] for t in added}
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    single = [v for k, v in vocab.items() if len(k) == 1]
    ordered = len(single) == 256 and len(vocab) == 256 + len(merged) and all(a < b for a, b in zip([max(single), *merged], merged, strict=False))
    return ({bytes(BYTE_OF[c] for c in k): v for k, v in vocab.items()}, special) if ordered else None


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes, as ``tokenizers`` gives them for the file at ``path``.

    The ids of plain byte-level BPE are found by ``tiktoken``, from the same file's vocabulary, in half the time: both cut
    by the same pattern and merge by the same ranks. Other tokenizers go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            found = merge_ranks(json.load(file))
        if found is None:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            self.ids = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
        else:
            import tiktoken

            ranked = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=found[0], special_tokens=found[1])
            self.ids = lambda text: ranked.encode_to_numpy(text, allowed_special="all")

    def __call__(self, text: str) -> bytes:
        return self.ids(text).astype("<u4", copy=False).tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut each document's ids (with ``end_id`` appended) into pieces of at most ``capacity``; the first may be shorter.

    Null text counts as empty and gives the one-token piece ``[end_id]``. A null id stays null; repeated rows give
    repeated pieces. Returns id, piece, start, length, ids_crc32.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                out: list[tuple] = []
                for doc, data in zip(ids[at : at + 256], map(encode, texts[at : at + 256]), strict=True):
                    data = memoryview(data + tail)
                    total = len(data) // 4
                    first = total % capacity or capacity
                    cuts = [0, *range(first, total + 1, capacity)]
                    out += [(doc, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def slack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Minimum-bin-slack plan over a histogram of lengths: which ranks of each length go to which bins.

    ``counts`` has at most ``capacity`` entries, so this is small at any corpus size: a combination is repeated until
    one of its lengths has fewer pieces left than it takes, which bounds the number of different combinations by about
    ``capacity * ln(capacity)``.

    Row: pieces of ``length`` with rank in [first, first + bins * copies) fill bins ``bin .. bin + bins - 1``; the copies
    of one bin lie one after the other from ``offset``.
    """
    left = {k: int(v) for k, v in counts.items() if v > 0}
    if any(not 0 < k <= capacity for k in left):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    order = sorted(left, reverse=True)
    while order:
        seed = order[0]
        room = capacity - seed
        # reach[i]: bit s is set if s tokens can be made of the first i (length, multiple) items
        reach, items = [1], []
        full, mask = 1 << room, (1 << (room + 1)) - 1
        for length in order:
            spare = min(left[length] - (length == seed), room // length)
            step = 1
            while spare > 0 and not reach[-1] & full:
                take = min(step, spare)
                items.append((length, take))
                reach.append((reach[-1] | reach[-1] << length * take) & mask)
                spare -= take
                step *= 2
            if reach[-1] & full:
                break
        best = reach[-1].bit_length() - 1
        chosen = {seed: 1}
        for k in range(len(items), 0, -1):
            if not reach[k - 1] >> best & 1:
                length, take = items[k - 1]
                chosen[length] = chosen.get(length, 0) + take
                best -= length * take
        times = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], times, n, bins, offset))
            used[length] += times * n
            left[length] -= times * n
            offset += length * n
        bins += times
        order = [k for k in order if left[k]]
    return pd.DataFrame(rows, columns=["length", "first", "bins", "copies", "bin", "offset"]).astype("int64")


def ranked(pieces: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds ``rank``, from 0 within ``key``, without gathering a key in one task.

    A key's rows are dealt to buckets by hash; the table of (key, bucket) counts gives each bucket its first rank. Only
    that table, of at most ``buckets`` rows a key, is windowed by key.
    """
    buckets = 4 * shuffle_partitions(pieces.sparkSession)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(key, "_bucket").count()
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col(key), F.col("_bucket"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(first, [key, "_bucket"])
        .withColumn("rank", F.col("_first") + F.col("_rank"))
        .drop("_bucket", "_first", "_rank")
    )


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as minimum bin slack finds.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null text is empty, an empty
    table gives an empty result, repeated rows are packed each, further columns of the input are ignored.
    """
    pieces = cut(token_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = slack_plan(counts, capacity).sort_values(["length", "first"])
    stride = np.int64(1) << 44  # ranks of one length stay below this
    starts = plan["length"].to_numpy() * stride + plan["first"].to_numpy()
    first, bins, bin_, offset = (plan[c].to_numpy() for c in ("first", "bins", "bin", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy("int64"), rank.to_numpy("int64")
        at = np.searchsorted(starts, n * stride + r, side="right") - 1
        copy, nth = np.divmod(r - first[at], bins[at])
        return pd.DataFrame({"sequence_id": bin_[at] + nth, "offset": offset[at] + copy * n})

    placed = ranked(pieces, "length", ["doc_id", "piece", "ids_crc32"]).withColumn("_place", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.sequence_id", "_place.offset")
