"""Tokenizer alignment against a brute-force version with the tokenizers' own libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest

from revlens.llm import alignment, queries

A_PATH, B_PATH = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
PARTS = [" ", "  ", "   ", "\n", "\t", "a", "Bc", "é", "ß", "7", "'s", ".", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>", "中文", "😀", " ", "▁", "\0", "word", "the", "　", "́", "ж"]


def hostile(n):
    rng = random.Random(3)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(n)]


class Plain:
    """Both tokenizers by their own libraries, groups by common ends."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.byte = {chr(x): x for x in kept} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in kept)}

    def groups(self, text):
        if not text:
            return [], 0, 0
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in ids_b)]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return [], 0, 0
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        out, x, y = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            p, q = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
            out.append((ids_a[x:p], ids_b[y:q]))
            x, y = p, q
        return out, len(ids_a), len(ids_b)


def brute(texts):
    plain = Plain()
    found = [plain.groups(t) for t in texts]
    count = collections.Counter((a[-1], b[-1]) for g, _, _ in found for a, b in g)
    most = collections.defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    rows = []
    for g, n_a, n_b in found:
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((n_a, n_b, len(g), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block_bytes", [1, 20_000, alignment.BLOCK_BYTES])
def test_alignment_against_brute_force(spark, block_bytes):
    corpus = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()][:60]
    texts = [None, "", " ", "   ", "\n\n", "x" * 5000, "a b  " * 3000, "▁", *hostile(150), *corpus, corpus[0], corpus[0]]
    docs = spark.createDataFrame([(k, t, 1, "p", 2, "b") for k, t in enumerate(texts)], "doc_id long, text string, n_a int, pairs string, count int, block string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, A_PATH, B_PATH, block_bytes=block_bytes).collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    assert [k for k, row in enumerate(want) if got[k] != row] == []


def test_ids_are_those_of_the_libraries():
    plain, first, second = Plain(), alignment.ByteLevel(A_PATH), alignment.Pieces(B_PATH)
    assert second.by_word
    for text in hostile(4000):
        if text:
            assert first(" " + text)[0].tolist() == plain.a.encode(" " + text, add_special_tokens=False).ids
            assert second(" " + text)[0].tolist() == plain.b.encode(text)


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = [(None, "the cat"), (None, "the cat"), (5, "the cat"), (5, None)]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A_PATH, B_PATH).collect()
    assert sorted((r["doc_id"] or -1, r["n_groups"], r["count_sum"]) for r in got) == [(-1, 2, 6), (-1, 2, 6), (5, 0, 0), (5, 2, 6)]
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH).collect() == []


def test_stored_rows_are_documents_and_hold_their_own_links(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["the cat", None, "x y z " * 500, "", "中文 the"])], "doc_id long, text string").coalesce(1)
    rows = alignment.blocks(docs, A_PATH, B_PATH, id_col="doc_id", text_col="text", block_bytes=alignment.BLOCK_BYTES).collect()
    assert [r["doc_id"] for r in rows] == [0, 1, 2, 3, 4] and len({r["block"] for r in rows}) == 1
    assert [len(r["links"]) for r in rows] == [4 * r["n_groups"] for r in rows]
    assert [r["pairs"] is not None for r in rows] == [True, False, False, False, False]
    assert sum(rows[0]["counts"]) == sum(r["n_groups"] for r in rows)


def test_long_words_are_not_remembered():
    second = alignment.Pieces(B_PATH)
    words = [" " + "中" * 3, " " + "文" * 5000]
    assert [second.word(w)[0].tolist() for w in words] == [second.whole(w)[0].tolist() for w in words]
    assert list(second.seen) == words[:1]


def test_divide_and_conquer_finds_every_common_end():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 50, 2000):
        for share in (0.02, 0.5, 1):
            ends_a = np.unique(np.r_[rng.choice(size * 3, size), size * 3])
            ends_b = np.unique(np.r_[rng.choice(size * 3, size), rng.choice(ends_a, int(share * len(ends_a))), size * 3])
            a, b = alignment.groups(ends_a, ends_b, np.array([0, len(ends_a)]), np.array([0, len(ends_b)]))
            common = np.intersect1d(ends_a, ends_b)
            assert ends_a[a - 1].tolist() == common.tolist() == ends_b[b - 1].tolist()


def test_groups_of_one_text():
    first, second = alignment.ByteLevel(A_PATH), alignment.Pieces(B_PATH)
    got = alignment.token_groups("The tokenizers differ.", first, second)
    spelled = [(b"".join(map(first.bytes_of.get, a)), b"".join(map(second.bytes_of.get, b))) for a, b in got]
    assert all(a == b for a, b in spelled) and b"".join(a for a, _ in spelled) == b" The tokenizers differ."
