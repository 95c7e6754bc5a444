"""Conversation repair against a brute-force search over all audits, and the linked audits against plain strings."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from revlens.llm import repair

WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def legal(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    if initials[:1] == "s" and not body:
        return False
    return len(body) % 2 == 0 and all(c == "ua"[k % 2] for k, c in enumerate(body))


def search(rows):
    """Cheapest (cost, audit) by best-first search over (row, output's tail state), audits as plain strings."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, last, out = heapq.heappop(queue)
        if (at, last) in seen:
            continue
        seen.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for c in nexts.replace("s", ""):
            heapq.heappush(queue, (cost + 3, audit + "I", at, c, (*out, ({"u": "user", "a": "assistant"}[c] + ":"))))
        if at < len(rows):
            role, text, gone, cut = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, last, out))
            if not gone:
                extra = 3 * cut
                if role[:1] in nexts and role[:1]:
                    heapq.heappush(queue, (cost + extra, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))
                for c in nexts.replace("s", ""):
                    heapq.heappush(queue, (cost + extra + 3, audit + "R", at + 1, c, (*out, f"{ {'u': 'user', 'a': 'assistant'}[c] }:{text}")))


def brute(rows):
    result = {}
    every = {r[0] for r in rows}
    for conv in every:
        mine = [r for r in damaged(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, faults, items = set(), [0, 0, 0], []
        for _, _, role, text in mine:
            bare = text.strip(WHITE)
            kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                faults[kind] += 1
            items.append((role, text, kind in (0, 1), kind == 2))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, out = search(items)
        result[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return result


def mine(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"]
    texts = ["Yes.", "No", "Why?", "a b. ", "", " \n", None, "x!", "é。", "same.", "same."]
    return [(c if c else None, rng.choice([None, *range(most + 3)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(9999)}{rng.choice(['.', '', '!'])}") for c in range(conversations) for _ in range(rng.randrange(1, most))]


SCHEMA = "conv_id long, turn long, role string, text string, audit string, part int, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "k") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_against_search(spark, seed):
    rows = random_rows(seed, 250, 14)
    assert mine(repair.repair_damaged(frame(spark, rows))) == brute(rows)


def test_given_conversations_against_search(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert mine(repair.repair_damaged(table)) == brute(rows)


def test_one_long_conversation_over_many_ranges(spark):
    """Nearly all rows are one conversation: it is cut into ranges, and they join to the same audit."""
    rng = random.Random(4)
    rows = [(7, k // 2, rng.choice(["user", "assistant", "system", "x"]), f"t{rng.randrange(3000)}{rng.choice(['.', ''])}") for k in range(5000)]
    rows += [(8, 1, "user", "a."), (6, 1, "assistant", "b.")]
    flags = repair.flagged(repair.damage(frame(spark, rows)))
    assert repair.segments(flags).filter("conv_id = 7").count() > 2
    assert mine(repair.repair_damaged(frame(spark, rows))) == brute(rows)


def test_copies_of_one_row_and_dropped_conversations(spark):
    rows = [(1, 5, "user", "a.")] * 300 + [(2, 1, "user", "q?"), (2, 2, "assistant", "a.")]
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "q?")]
    out = mine(repair.repair_damaged(frame(spark, rows)))
    assert out == brute(rows)
    assert out[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(("base", "prime"), [(repair.BASE, repair.PRIME), (1, 3), (1, 1)])
def test_audits_compare_like_strings_even_if_hashes_collide(base, prime):
    rng = random.Random(2)
    audits = repair.Audits(base, prime)
    nodes = [0]
    for _ in range(400):
        nodes.append(audits.add(rng.choice(nodes[-30:]), rng.choice("DIKR")))
    texts = {n: audits.text(n) for n in nodes}
    for a, b in itertools.product(rng.sample(nodes, 60), repeat=2):
        assert audits.less(a, b) == (texts[a] < texts[b])
        depth = rng.randrange(len(texts[a]) + 1)
        assert texts[audits.lift(a, depth)] == texts[a][:depth]


def test_every_small_conversation():
    """All sequences of up to four rows over the kinds of rows, by the DP, by the DP in two segments and by the search."""
    kinds = [("s", False, False), ("u", False, False), ("a", False, True), ("x", False, False), ("u", True, False), ("a", False, False)]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            want = search([(i, "t", g, t) for i, g, t in rows])[:2]
            assert repair.close(repair.run_segment(list(rows), repair.NONE)) == want
            live = repair.run_segment(list(rows[: n // 2]), repair.NONE)
            second = {(p, q): x for p in range(4) for q, x in repair.run_segment(list(rows[n // 2 :]), p).items()}
            assert repair.close(repair.through(live, second)) == want
