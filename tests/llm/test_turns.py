"""Repaired conversations against a search over all edits, and over whole conversations."""

import hashlib
import heapq
import random
import re
import zlib
from functools import cache
from itertools import product

import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import turns
from tallyhouse.llm.queries import op11_conversation_repair
from tallyhouse.llm.turns import damaged, digests, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string, chunk long, at int, made string, digest string"
CLASH = ("1", "2", "3")
SPACE = " \t\n\x0b\x0c\r"


def planted(rows):
    for conv_id, turn, role, text in rows:
        lot = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv_id, turn)).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        yield from [(conv_id, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)


def order(row):
    _, turn, role, text = row
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, "sua".find(role[:1]) if role[:1] and role[:1] in "sua" else 3, digest)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, lines) by best-first search over audits: the least cost, then the least audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, tail, lines = heapq.heappop(heap)
        if (at, tail) in done:
            continue
        done.add((at, tail))
        if at == len(rows) and tail in ("", "a"):
            return cost, audit, lines
        follows = "a" if tail == "u" else "u"
        name = {"u": "user", "a": "assistant"}[follows]
        heapq.heappush(heap, (cost + 5, audit + "I", at, follows, (*lines, f"{name}:")))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, tail, lines))
            if found[at] not in ("blank", "duplicate"):
                more = 5 if found[at] == "truncated" else 0
                heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, follows, (*lines, f"{name}:{text}")))
                if role[:1] == follows or (tail == "" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
    raise AssertionError


def brute(original):
    out = []
    for conv_id in {row[0] for row in original}:
        rows = sorted(planted(row for row in original if row[0] == conv_id), key=order)
        found = faults(rows)
        numbers = {row[1] for row in rows} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [row[2][:1] for row in rows]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
        cost, audit, lines = cheapest(rows, found)
        out.append((
            conv_id, gaps, *[found.count(name) for name in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def repaired(spark, rows, **sizes):
    table = spark.createDataFrame([(*row, 7, 8, *CLASH[:2]) for row in rows], SCHEMA)
    found, counts = repair_conversations(damaged(table), copies="copies", **sizes)
    audits = {row.conv_id: row for row in digests(found).collect()}
    return sorted((
        (r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, audits[r.conv_id].audit, audits[r.conv_id].repaired_sha256)
        for r in counts.collect()
    ), key=repr)


def conversations(seed, count, most):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None]
    texts = ["A.", "B!", "C", "D?", "  ", "", None, "E. \n", "long " * 40 + ".", "F", "É\U0001f600."]
    rows = []
    for conv_id in range(count):
        for turn in range(rng.randrange(1, most)):
            number = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 3])
            rows.append((conv_id if conv_id else None, number, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows


def test_search_equals_all_edits(spark):
    rows = conversations(1, 60, 12)
    assert repaired(spark, rows) == [row for row in brute(rows) if any(planted(r for r in rows if r[0] == row[0]))]


@pytest.mark.parametrize("size, span", [(1, 2), (3, 1), (7, 64)])
def test_chunks_of_any_size_give_the_same(spark, size, span):
    rows = conversations(2, 12, 60) + [(99, n, "assistant", f"no end {n}") for n in range(40)] + [(98, n, "user", "  ") for n in range(40)]
    assert repaired(spark, rows, size=size, span=span) == brute(rows)


def test_vectors_of_every_chunk_are_those_of_the_whole(spark, monkeypatch):
    """Text without an end keeps what the vectors start with: each pass gets only so far."""
    rows = [(5, n, "user", f"no end {n}") for n in range(200)] + [(5, 200, "assistant", "An end.")]
    passes = []
    real = turns.written
    monkeypatch.setattr(turns, "written", lambda rows, purpose: passes.append(purpose) or real(rows, purpose))
    assert repaired(spark, rows, size=4, span=2) == brute(rows)
    assert 3 <= passes.count("fix-up") <= 5


def test_repeated_rows_of_a_hot_conversation(spark):
    rows = [(1, 3, "user", "Same.")] * 500 + [(1, 4, "user", "Same.")] * 30 + [(1, n, "user", "Same.") for n in range(5, 300)] + [(None, None, None, None)] * 300
    assert repaired(spark, rows, size=16) == brute(rows)


def test_empty(spark):
    assert repaired(spark, []) == []


def test_trace_takes_the_least_of_all_cheapest_audits():
    codes = [cls + 4 * fault for cls in range(4) for fault in (turns.NO_FAULT, turns.BLANK, turns.CUT)]
    initials = {turns.OTHER: "t", turns.SYSTEM: "s", turns.USER: "u", turns.ASSISTANT: "a"}

    @cache
    def searched(row):
        rows = [(0, 0, initials[code & 3], "") for code in row]
        return cheapest(rows, [["", "blank", "duplicate", "truncated"][code >> 2] for code in row])[:2]

    for row in product(codes, repeat=3):
        costs = turns._backward(bytes(row), [1] * 3, turns.NOTHING_FOLLOWS)[0]
        edits, _, _ = turns._trace(bytes(row), [1] * 3, turns.NOTHING_FOLLOWS, turns.START, True)
        assert (costs[turns.START], "".join(edits)) == searched(row)


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()
    want = brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table])
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = op11_conversation_repair(spark, sf_dir).select(*names)
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_conversation_without_rows_after_damage(spark, tmp_path):
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Gone.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [tuple(r) for r in op11_conversation_repair(spark, str(tmp_path)).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ] == brute(rows)
