"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest
from conftest import SMALL

from shelfpulse.llm import conversations
from shelfpulse.llm.common import table

MIDDLE = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"
sys.setrecursionlimit(20_000)
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def best(rows):
    """Figures of one conversation's rows in order, by trying every edit at every row."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def rest(place, state, inserts):
        found = []
        for role in ("user", "assistant"):
            if inserts < 3 and (state, role[0]) in goes:
                cost, audit, lines = rest(place, role[0], inserts + 1)
                found.append((cost + 5, "I" + audit, (f"{role}:", *lines)))
        if place == len(rows):
            return min(found + [(0, "", ())] * (state in ("", "a")), default=(10**9, "", ()))
        _, _, own, text = rows[place]
        cost, audit, lines = rest(place + 1, state, 0)
        found.append((cost + 2, "D" + audit, lines))
        if faults[place] not in ("blank", "duplicate"):
            for letter, role, price in (("K", own, 0), ("R", "user", 1), ("R", "assistant", 1)):
                if (state, role[:1]) in goes:
                    cost, audit, lines = rest(place + 1, goes[state, role[:1]], 0)
                    found.append((cost + price + 5 * (faults[place] == "truncated"), letter + audit, (f"{role}:{text}", *lines)))
        return min(found)

    cost, audit, lines = rest(0, "", 0)
    turns = {t for _, t, _, _ in rows if t is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups


def told(frame):
    rows = frame.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_given_tables(spark, folder):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in table(spark, folder, "conversations").collect()]
    left = by_conversation(damage(rows))
    want = {conv: best(sorted(left.get(conv, []), key=lambda r: r[1])) for conv in {r[0] for r in rows}}
    assert told(conversations.op11_conversation_repair(spark, folder)) == want


def random_rows(rng, convs, length):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, length)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rng.choice([f"text {turn}.", f"cut {turn}", "same.", "", " \t", "again?  "])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 5, 4096])
def test_chunks_of_any_size(spark, chunk):
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in random_rows(random.Random(chunk), 40, 14)}.values())
    want = {conv: best(sorted(own, key=lambda r: r[1])) for conv, own in by_conversation(rows).items()}
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert told(conversations.figures(frame.repartition(3), chunk=chunk)) == want


def test_passes_do_not_grow_with_chunks(spark, monkeypatch):
    """Truncated rows carry every vector on unchanged; hundreds of chunks of them still take few passes."""
    rows = [(1, n, "user" if n % 2 else "assistant", f"cut {n}") for n in range(300)] + [(1, 300, "user", "asked?")]
    passes = []
    real = conversations._runs
    monkeypatch.setattr(conversations, "_runs", lambda chunks: passes.append(1) or real(chunks))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert told(conversations.figures(frame, chunk=2)) == {1: best(rows)}
    assert len(passes) < 8


def test_repaired_rows(spark):
    rows = random_rows(random.Random(5), 20, 10)
    frame = spark.createDataFrame(list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values()),
                                  "conv_id long, turn long, role string, text string")
    figures = told(conversations.figures(frame, chunk=3))
    groups = by_conversation([tuple(r) for r in conversations.repaired(frame, chunk=3).orderBy("conv_id", "place").collect()])
    assert groups.keys() == figures.keys()
    for conv, own in groups.items():
        assert [r[1] for r in own] == list(range(len(own)))
        assert "".join(r[2] for r in own) == figures[conv][6]
        stay = [r for r in own if r[2] != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[4][:1] for r in stay))
        assert hashlib.sha256("\n".join(f"{r[4]}:{r[5]}" for r in stay).encode()).hexdigest() == figures[conv][7]


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, key string, kind string, part long, row long, tag long, plans string"
    more = ("k", "x", 7, 8, 9, "p")
    rows = [(None, None, None, None), (None, 1, "user", "a?"), (1, None, "user", "first."), (1, 0, "assistant", "x" * 200_000 + "."),
            (1, 0, "assistant", "x" * 200_000 + "."), (2, 5, "system", "only."), (3, 1, "", "no role."), (4, 1, "user", "ça va \U0001f600?")]
    frame = spark.createDataFrame([r + more for r in rows], schema)
    want = {conv: best(sorted(own, key=lambda r: (r[1] is not None, r[1], r[2]))) for conv, own in
            by_conversation([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]).items()}
    assert told(conversations.figures(frame, chunk=2)) == want
    assert want[1][2] == 1 and want[2][6] == "D"
    assert conversations.figures(frame.where("1 = 0")).collect() == []
    assert conversations.repaired(frame.where("1 = 0")).collect() == []
    none = told(conversations.figures(frame.where("1 = 0"), frame.where("conv_id = 4").select("conv_id")))
    assert none == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    damaged, dropped = conversations.damaged(frame)
    kept = by_conversation(damage(rows))
    assert {c: sorted(map(str, own)) for c, own in kept.items()} == {
        c: sorted(map(str, own)) for c, own in by_conversation([tuple(r) for r in damaged.collect()]).items()}
    assert damaged.count() + dropped.count() >= len(rows)


def test_equal_rows_over_many_chunks(spark):
    """Copies of one row in one turn, more than a chunk holds: one stays, the rest are duplicates."""
    rows = [(1, 0, "user", "ask.")] * 50 + [(1, 1, "assistant", "say.")] * 3 + [(2, 0, "user", "ask.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert told(conversations.figures(frame, chunk=4)) == {1: best(rows[:53]), 2: best(rows[53:])}
