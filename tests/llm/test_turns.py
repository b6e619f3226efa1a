"""Structure repair and the prefix trie of conversations, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from eventmill.llm import structure_repair as repairs
from eventmill.llm.prefix_trie import COLUMNS, borrowed, prefix_trie, sequences
from eventmill.llm.structure_repair import damaged, edits, repair

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHES = ("unit", "chars", "turns", "node", "up", "h", "first", "fault", "gone", "letter", "digest", "times", "n", "path")


def conversations(spark, rows):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.select("*", *(F.lit(1).alias(c) for c in CLASHES))


def order(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def odd_rows(seed=3):
    """Copies, shared beginnings, nulls anywhere, equal turns, repeated rows, gaps, odd roles, one long conversation."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), 100, 101, 103, 199, 205, 300, 1234, -5, -100, -163]:
        for t in range(rng.randrange(0, 7)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["hi.", "hi", "why?", "", " \n ", None, "é日.", "no end", "end! \t"])
            rows.append((c, t + (t > 3), role, text))
    rows += [(50 + i, t, "user", f"same {t}.") for i in range(9) for t in range(4)]
    rows += [(60, None, "system", "be kind."), (60, 0, "user", "a?"), (60, 0, "assistant", "b."), (60, 0, "user", "a?"), (60, 0, "user", "a?"), (61, None, None, None)]
    rows += [(70, t, ("user", "assistant")[t % 2], f"turn {t // 3}.") for t in range(700)]
    rows += [(None, 1, "user", "x."), (None, 2, "assistant", "y.")]
    return rows


# Structure repair


def brute_edits(kinds):
    """The cheapest edits by trying all that lead to each state, row by row: (cost, letters)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(best, state, cost, letters):
        if state not in best or (cost, letters) < best[state]:
            best[state] = (cost, letters)

    def inserted(best):
        for _ in range(3):
            for state, (cost, letters) in list(best.items()):
                put(best, after[state], cost + 3, letters + "I")
        return best

    best = inserted({"": (0, "")})
    for letter, must_go, cut in kinds:
        new = {}
        for state, (cost, letters) in best.items():
            put(new, state, cost + 4, letters + "D")
            if must_go:
                continue
            put(new, after[state], cost + 3 + 3 * cut, letters + "R")
            if letter == after[state] or (letter == "s" and state == ""):
                put(new, letter, cost + 3 * cut, letters + "K")
        best = inserted(new)
    return min(best[s] for s in ("", "a") if s in best)


def brute_repair(rows):
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else x for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        by_id[conv] += []
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        by_id[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, kept in by_id.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, order(r[1], r[2])))
        seen, kinds, counts = set(), [], Counter()
        for _, role, text in kept:
            inside = text.strip(" \t\n\x0b\x0c\r")
            again, cut = (role, text) in seen, inside[-1:] not in (".", "!", "?")
            seen.add((role, text))
            counts["blank" if not inside else "duplicate" if again else "truncated" if cut else ""] += 1
            kinds.append((role[:1], not inside or again, cut))
        turns = {t for t, *_ in kept if t is not None}
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        cost, audit = brute_edits(kinds)
        state, lines, at = "", [], 0
        step = {"": "user", "s": "user", "u": "assistant", "a": "user"}
        for letter in audit:
            if letter == "I":
                lines.append(step[state] + ":")
                state = step[state][0]
                continue
            _, role, text = kept[at]
            at += 1
            if letter == "D":
                continue
            role = step[state] if letter == "R" else role
            state = role[0]
            lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_edits_are_the_least_of_the_cheapest():
    kinds = [("x", True, False), *((l, False, c) for c in (False, True) for l in "suax")]
    for n in range(5):
        for rows in itertools.product(range(9), repeat=n):
            assert edits(bytes(rows)) == brute_edits([kinds[r] for r in rows])
    rng = random.Random(0)
    for n in (63, 64, 65, 400):
        rows = bytes(rng.randrange(9) for _ in range(n))
        assert edits(rows) == brute_edits([kinds[r] for r in rows])


def test_few_vectors_are_kept(monkeypatch):
    made = []
    plain = repairs._vectors
    monkeypatch.setattr(repairs, "_vectors", lambda *a: made.append(len(out := plain(*a))) or out)
    edits(bytes(5 for _ in range(10_000)))
    assert max(made) <= 102  # a block is the root of the length


@pytest.mark.parametrize("seed", [3, 4])
def test_repair_equals_brute_force(spark, seed):
    rows = odd_rows(seed)
    found = {r.conv_id: tuple(r)[1:] for r in repair(damaged(conversations(spark, rows))).collect()}
    assert found == brute_repair(rows)


def test_repair_of_untouched_rows(spark):
    rows = [(1, 1, "system", "s."), (1, 2, "user", "u."), (1, 3, "assistant", "a."), (2, 5, "assistant", "a."), (3, 1, "user", "cut")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "conv_id = 9 AS gone")
    found = {r.conv_id: r for r in repair(frame).collect()}
    assert (found[1].audit, found[1].cost) == ("KKK", 0)
    assert (found[2].audit, found[2].cost) == ("IK", 3)
    assert (found[3].audit, found[3].cost, found[3].truncated) == ("D", 4, 1)


def test_dropped_conversation_and_no_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair(damaged(conversations(spark, [(gone, 0, "user", "x.")]))).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    assert repair(damaged(conversations(spark, []))).collect() == []


# Prefix trie


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, order(role, text), role, text))
    own = {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    return out


def brute_trie(paths):
    members, kids = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(node))))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


@pytest.mark.parametrize("most", [1, 3, 4096])
def test_trie_equals_brute_force(spark, most):
    rows = [r for r in odd_rows() if r[0] != 70 or r[1] < 12]  # a level of its own for each shared depth if most is 1
    assert nodes(prefix_trie(borrowed(sequences(conversations(spark, rows))), most)) == brute_trie(rebuilt(rows))


def test_long_conversation_is_one_task(spark):
    rows = odd_rows()
    assert nodes(prefix_trie(borrowed(sequences(conversations(spark, rows))))) == brute_trie(rebuilt(rows))


def test_a_third_of_all_begin_alike(spark):
    rows = [(c, t, "user", f"{'shared' if t < 3 and c % 3 == 0 else c} {t}") for c in range(600) for t in range(5)]
    rows += [(c, 0, "user", "copy") for c in range(1000, 1400)]
    plain = sequences(conversations(spark, rows))
    paths = defaultdict(tuple)
    for c, _, role, text in sorted(rows):
        paths[c] += ((role, text),)
    assert nodes(prefix_trie(plain, 20)) == nodes(prefix_trie(plain)) == brute_trie(dict(paths))


def test_ends_longer_than_a_run(spark, monkeypatch):
    monkeypatch.setattr("eventmill.llm.prefix_trie._RUN", 60)
    rows = [(c, 0, "user", "copy") for c in range(300)]
    end = [r for r in prefix_trie(sequences(conversations(spark, rows))).collect() if r.depth == 1]
    assert [r.ends_sha256 for r in end] == [hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()]


def test_trie_of_nothing(spark):
    assert prefix_trie(borrowed(sequences(conversations(spark, [])))).collect() == []
    assert prefix_trie(borrowed(sequences(conversations(spark, [(None, 1, "user", "x")])))).collect() == []
    short = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)  # lent nothing, and its one turn is replaced
    assert nodes(prefix_trie(borrowed(sequences(conversations(spark, [(short, 1, "user", "x")]))))) == brute_trie({short: ()})
