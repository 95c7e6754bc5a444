"""MinHash near-dedup: an inverted join of signature coordinates, with exact confirmation.

Documents are posted under the (coordinate, value) pairs of their signature. Two documents whose sets are ``threshold``
alike collide in at least ``agree`` of ``coordinates`` coordinates (but for about one such pair in 200 000 at the defaults,
for 0.85 one in 30 million), so they meet in a list even if each is posted under its ``coordinates - agree + 1`` rarest
pairs alone (the prefix). The other, longer lists are skipped: collisions in them are counted by looking them up in the
signatures of the pairs that the prefix lists give. Pairs with ``agree`` collisions are confirmed on full sets.

No list is expanded into pairs. Each list has one pivot, the document whose pairs are the most common:

1. every document of a list is counted and confirmed against the pivot; links found that way join whole groups of copies;
2. of the documents that met the pivot, those not joined to it that way are the queries; collisions of queries with all
   the others are counted in blocks of bounded size, then confirmed on full sets. Pairs that already are joined
   say nothing new and are skipped, as are those whose distances to the pivot rule a link out (the Hamming distance of
   signatures and the Jaccard distance of sets are metrics).

Both steps confirm links on full sets, so the components are those of the true links between the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MIX, blank, cut, cut_small, gram_hashes, mix64, tasks_for, text_bytes, word_hashes

COORDINATES, AGREE = 40, 20
#: Cells of the fixed-size sketch that estimates how common a (coordinate, value) pair is.
SKETCH = 1 << 16
#: 64-bit words of the Bloom filter that keeps texts without candidates out of a shuffle.
BLOOM = 1 << 18
#: Queries and bases of a block, when collisions are counted; full sets go in blocks of a half and a quarter of that.
BLOCK = (512, 2048)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; A-Z in lower case; one shingle if it has fewer words."""
    words = text.lower().split()  # bytes: lower() is A-Z only, split() is at space and 0x09-0x0D
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(size, len(words))))


def coordinate_keys(coordinates: int) -> np.ndarray:
    return mix64(np.arange(1, coordinates + 1, dtype=np.uint64) * MIX) | np.uint64(1)


def signature(shingles: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.full(len(keys), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 4096):
        x = shingles[at : at + 4096, None] * keys
        out = np.minimum(out, mix64(x).min(0))
    return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, *, size: int, coordinates: int = COORDINATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, same (a hash that stands for the set; null if empty), sig."""
    keys = coordinate_keys(coordinates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, same, sigs = [], [], []
            for text in text_bytes(batch.column(1)):
                s = shingle_set(text, size)
                sizes.append(len(s))
                same.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s, keys).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "same", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, same binary, sig binary")


def pair_keys(sig: bytes) -> np.ndarray:
    """The 64-bit keys of a signature's (coordinate, value) pairs."""
    values = np.frombuffer(sig, np.uint32).astype(np.uint64)
    return mix64(values + (np.arange(1, len(values) + 1, dtype=np.uint64) << np.uint64(32)))


def sketch(sigs: DataFrame) -> np.ndarray:
    """How many pairs fall into each of SKETCH cells; its size does not depend on the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for sig in batch.column(0).to_pylist():
                np.add.at(total, pair_keys(sig) % np.uint64(SKETCH), 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    out = np.zeros(SKETCH, np.int64)
    for row in sigs.select("sig").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["cell"]] = row["n"]
    return out


def postings(sigs: DataFrame, common: np.ndarray, agree: int) -> DataFrame:
    """key, doc_id, weight: each document under the prefix of its pairs, rarest first. weight: how common its pairs are."""
    shared = sigs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys, docs, weights = [], [], []
            for doc, sig in zip(ids, batch.column(1).to_pylist(), strict=True):
                pairs = pair_keys(sig)
                often = cells[pairs % np.uint64(SKETCH)]
                first = np.lexsort((pairs, often))[: len(pairs) - agree + 1]
                keys.append(pairs[first])
                docs.append(np.full(len(first), doc))
                weights.append(np.full(len(first), int(often.sum())))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(weights))], ["key", "doc_id", "weight"])

    return sigs.select("doc_id", "sig").mapInArrow(run, "key long, doc_id long, weight long")


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def with_agreement(pairs: DataFrame) -> DataFrame:
    """doc_id, pivot and ``same``, the number of coordinates in which ``sig`` and ``pivot_sig`` agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a == b).sum(1).astype(np.int64))], ["doc_id", "pivot", "same"])

    return pairs.select("doc_id", "pivot", "sig", "pivot_sig").mapInArrow(run, "doc_id long, pivot long, same long")


def linked(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return shared * 100 >= (n + m - shared) * percent


def with_shared(pairs: DataFrame) -> DataFrame:
    """Adds ``shared``, the exact intersection of the sets in ``set`` and ``pivot_set``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, pivots = batch.column(2), batch.column(3)
            got = [shared_count(np.frombuffer(sets[k].as_buffer(), np.uint64), np.frombuffer(pivots[k].as_buffer(), np.uint64)) for k in range(batch.num_rows)]
            sizes = [[len(x[k].as_buffer()) // 8 for k in range(batch.num_rows)] for x in (sets, pivots)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in (*sizes, got)]], ["doc_id", "pivot", "n", "m", "shared"])

    return pairs.select("doc_id", "pivot", "set", "pivot_set").mapInArrow(run, "doc_id long, pivot long, n long, m long, shared long")


def block_links(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of a block between its queries and its bases, as few as join what they join."""
    ids, label, query = (table.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "label", "query"))
    sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    often = np.bincount(code) > 1
    keep = often[code]
    code, owner = (np.cumsum(often) - 1)[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    q, b = np.flatnonzero(query), np.flatnonzero(~query)
    shared = np.zeros((len(q), len(b)), np.float32)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        x, y = np.searchsorted(code, [at, at + 4096])
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[x:y], code[x:y] - at] = 1
        shared += m[q] @ m[b].T
    union = sizes[q][:, None] + sizes[b][None] - shared
    ok = (100 * shared >= percent * union) & possible(table, q, b, percent)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k, j in zip(*np.nonzero(ok), strict=True):
        x, y = find(int(label[q[k]])), find(int(label[b[j]]))
        if x != y:
            root[y] = x
            out.append((int(ids[q[k]]), int(ids[b[j]])))
    return out


def possible(table: pa.Table, q: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of queries and bases that a link would tell something about: not yet joined, and not ruled out by
    their distances to the pivot."""
    label = table.column("label").to_numpy()
    far = table.column("far").to_numpy()  # NaN where the distance to the pivot is not known
    return (label[q][:, None] != label[b][None]) & ~(np.abs(far[q][:, None] - far[b][None]) > 1 - percent / 100 + 1e-9)


def in_blocks(members: DataFrame, queries: int, bases: int, slack: int) -> DataFrame:
    """Deal each cluster's queries (members not yet joined to its pivot) to blocks against blocks of all its members.

    A block has about ``queries`` queries and ``bases`` bases. A cluster with few queries sends its members to one block
    each; nothing is paired here. ``slack``: in so many coordinates linked documents may differ, so a member much nearer
    to the pivot than the nearest query is left out.
    """
    loose = F.col("label") != F.col("pivot_label")
    sizes = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("k"), F.count_if(loose).alias("n"), F.min(F.when(loose, F.col("apart"))).alias("least")).filter("n > 0 and k > 1")
    sizes = sizes.select("pivot", "least", F.ceil(F.col("n") / queries).cast("int").alias("_q"), F.ceil(F.col("k") / bases).cast("int").alias("_b"))
    rows = members.join(cut_small(sizes), "pivot").withColumn("_loose", loose).filter(F.col("_loose") | (F.col("apart") >= F.col("least") - slack))
    i, j = F.pmod(F.xxhash64("doc_id", "pivot"), F.col("_q")).cast("int"), F.pmod(F.xxhash64("doc_id"), F.col("_b")).cast("int")
    asked = rows.filter("_loose").withColumn("i", i).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).withColumn("query", F.lit(True))
    against = rows.withColumn("j", j).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_q") - 1))).withColumn("query", F.lit(False))
    names = ["pivot", "i", "j", "doc_id", "query", "label", "pivot_label", "apart", "far"]
    return against.select(*names).unionByName(asked.select(*names))


def colliding(members: DataFrame, sigs: DataFrame, agree: int, coordinates: int, percent: int) -> DataFrame:
    """The members of each cluster that collide in at least ``agree`` coordinates and are not joined: pivot, doc_id."""

    def run(table: pa.Table) -> pa.Table:
        sig = np.stack([np.frombuffer(x, np.uint32) for x in table.column("sig").to_pylist()])
        query = table.column("query").to_numpy(zero_copy_only=False)
        q, b = np.flatnonzero(query), np.flatnonzero(~query)
        same = np.zeros((len(q), len(b)), np.uint8)
        for c in range(sig.shape[1]):
            same += sig[q, c, None] == sig[None, b, c]
        hit = (same >= agree) & possible(table, q, b, percent)
        took = np.zeros(len(query), bool)
        took[q], took[b] = hit.any(1), hit.any(0)
        return table.select(["pivot", "doc_id"]).filter(pa.array(took))

    dealt = in_blocks(members, *BLOCK, coordinates - agree).join(sigs, "doc_id")
    return dealt.groupBy("pivot", "i", "j").applyInArrow(run, "pivot long, doc_id long").distinct()


def cluster_links(members: DataFrame, sets: DataFrame, slack: int, percent: int) -> DataFrame:
    """Links inside of clusters between members not yet joined, confirmed on full sets: a, b."""

    def run(table: pa.Table) -> pa.Table:
        found = block_links(table, percent)
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = in_blocks(members, BLOCK[0] // 2, BLOCK[1] // 4, slack).join(sets, "doc_id")
    return dealt.groupBy("pivot", "i", "j").applyInArrow(run, "a long, b long")


def fetch_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """doc_id, set for the wanted ids. docs: doc_id, text.

    A Bloom filter of fixed size (2 MB whatever the corpus) keeps most other texts out of the shuffle; the join decides.
    """
    cell, bit = F.pmod(F.xxhash64("doc_id"), F.lit(BLOOM)), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(64)).cast("int")
    words = np.zeros(BLOOM, np.int64)
    for row in wanted.groupBy(cell.alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id, 1), 64) as int))")).alias("bits")).toLocalIterator():
        words[row["cell"]] = row["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = (shared.value[batch.column(2).to_numpy()] >> batch.column(3).to_numpy().astype(np.uint64)) & np.uint64(1)
            yield batch.select(["doc_id", "text"]).filter(pa.array(hit.astype(bool)))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size).tobytes() for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "set"])

    near = docs.select("doc_id", "text", cell.alias("cell"), bit.alias("bit")).mapInArrow(maybe, "doc_id long, text string")
    return cut(near.join(wanted, "doc_id", "left_semi").mapInArrow(to_sets, "doc_id long, set binary").filter("length(set) > 0"))


def meeting(links: DataFrame, rounds: int = 4) -> DataFrame:
    """node, label: the smallest node within ``rounds`` links. Nodes of one label are connected; not all that are have one."""
    edges = cut_small(links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))))
    tasks = tasks_for(edges.count())
    label = edges.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label"))
    for _ in range(rounds - 1):
        told = edges.join(label.withColumnRenamed("node", "v"), "v").coalesce(tasks)
        told = told.select(F.inline(F.array(F.struct(F.col("u").alias("node"), "label"), F.struct(F.col("v").alias("node"), "label"))))
        label = told.groupBy("node").agg(F.min("label").alias("label")).coalesce(tasks)
    return label


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node), for nodes that have links. links: a, b.

    Large-star and small-star contraction: links go over to each node's smallest neighbour until only stars are left.
    What is gathered per node is a minimum, and the joins deal out both sides, so a hot centre can be split. There are
    never more links than at first, so as many tasks do for every round.
    """
    edges = cut_small(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    tasks = tasks_for(edges.count())
    before = None
    while True:
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        large = cut(large.distinct()).coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # u -> m, and v -> m for the other neighbours
        small = large.join(least, "u").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).filter("u <> v").coalesce(tasks)
        edges = cut(small.distinct()).coalesce(tasks)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    pairs = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
    return edges.select(F.inline(pairs)).distinct()


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, coordinates: int = COORDINATES, agree: int = AGREE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of ``size`` -word shingles have 100 * intersection >= percent * union.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable) and kept (doc_id = component_id), one row
    per input row. Documents without words (null, empty, blank) are linked with nothing. A null id gets a null component
    and links nothing. Rows that share an id stand for one document; if their texts differ, they are linked.
    ``coordinates`` and ``agree`` suit a percent of 80; lower thresholds need a lower ``agree``.
    """
    sigs = cut(signatures(docs, size=size, coordinates=coordinates, id_col=id_col, text_col=text_col))
    # copies: one class per set; its smallest id stands for it
    full = sigs.filter("same is not null and doc_id is not null")
    classes = cut(full.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")))
    reps = classes.select(F.col("rep").alias("doc_id"), "sig")
    posted = postings(reps, sketch(reps), agree)
    best = posted.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("weight", (-F.col("doc_id")).alias("neg"))).alias("best")).filter("k > 1")
    pivots = cut_small(best.select("key", (-F.col("best.neg")).alias("pivot")))
    pairs = posted.join(pivots, "key").filter("doc_id <> pivot").select("doc_id", "pivot").distinct()

    pivot_sigs = reps.select(F.col("doc_id").alias("pivot"), F.col("sig").alias("pivot_sig"))
    pairs = cut_small(with_agreement(pairs.join(reps, "doc_id").join(pivot_sigs, "pivot")))
    matched = pairs.filter(F.col("same") >= agree).select("doc_id", "pivot")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(text_col).alias("text")).filter("doc_id is not null")
    sets = fetch_sets(texts, cut_small(matched.select("doc_id").unionByName(matched.select(F.col("pivot").alias("doc_id"))).distinct()), size)
    with_set = matched.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("pivot"), F.col("set").alias("pivot_set")), "pivot")
    near = linked(F.col("shared"), F.col("n"), F.col("m"), percent)
    far = 1 - F.col("shared") / (F.col("n") + F.col("m") - F.col("shared"))
    measured = cut_small(with_shared(with_set).select("doc_id", "pivot", near.alias("near"), far.alias("far")))
    links = measured.filter("near").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"))
    stars = cut_small(meeting(links))

    members = pairs.join(measured.select("doc_id", "pivot", "far"), ["doc_id", "pivot"], "left")
    members = members.join(stars.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left")
    members = members.join(stars.select(F.col("node").alias("pivot"), F.col("label").alias("pivot_label")), "pivot", "left")
    members = cut_small(members.select("pivot", "doc_id", F.coalesce("label", "doc_id").alias("label"), F.coalesce("pivot_label", "pivot").alias("pivot_label"), (coordinates - F.col("same")).alias("apart"), F.coalesce("far", F.lit(float("nan"))).alias("far")))
    found = cut_small(colliding(members, reps, agree, coordinates, percent))
    members = cut_small(members.join(found, ["pivot", "doc_id"], "left_semi"))
    sets = fetch_sets(texts, cut_small(found.select("doc_id").distinct()), size)
    links = links.unionByName(cluster_links(members, sets, coordinates - agree, percent))
    # rows that share an id but not a text
    several = full.groupBy("doc_id").agg(F.min("same").alias("x"), F.max("same").alias("y")).filter("x <> y").select("doc_id")
    twice = full.join(several, "doc_id").join(classes.select("same", "rep"), "same").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = cut_small(components(links.unionByName(twice)))

    label = classes.select("same", "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    label = cut(label.select("same", F.coalesce("component", "rep").alias("component")))
    out = sigs.select("doc_id", "n_shingles", "same").join(label, "same", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
