"""Repair of turns against an exhaustive search over edits."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from tezgah.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, place int, none string, audit string, chunk int"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        def name(x):
            return " " if x is None else str(x)

        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """``(cost, audit, roles)`` by trying every edit; ``rows`` are (role's initial, must go, cut off)."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            role = "a" if state == "u" else "u"
            cost, audit, made = best(i, role, inserted + 1)
            ways.append((cost + 2, "I" + audit, (("I", role), *made)))
        if i < len(rows):
            initial, gone, cut = rows[i]
            cost, audit, made = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + audit, (("D", None), *made)))
            if not gone:
                if initial in after[state]:
                    cost, audit, made = best(i + 1, after[state][initial], 0)
                    ways.append((cost + cut, "K" + audit, (("K", None), *made)))
                for role in {"u", "a"} & set(after[state]):
                    cost, audit, made = best(i + 1, role, 0)
                    ways.append((cost + 2 + cut, "R" + audit, (("R", role), *made)))
        return min(ways, key=lambda w: w[:2]) if ways else (10**6, "", ())

    return best(0, "", 0)


def brute(conversations):
    groups = defaultdict(list)
    for row in damage([r[:4] for r in conversations]):
        groups[row[0]].append(row[1:])
    out = {}
    for conv in {r[0] for r in conversations}:
        rows = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, symbols = set(), Counter(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:], strict=False))
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, made = cheapest(tuple(symbols))
        lines, left = [], iter(rows)
        for edit, to in made:
            row = next(left) if edit != "I" else (None, None, "")
            if edit != "D":
                role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[to]
                lines.append(f"{role}:{row[2]}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made_rows(seed, conversations, longest):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in range(conversations):
        at = 0
        for _ in range(int(rng.integers(1, longest))):
            at += int(rng.choice([0, 1, 1, 1, 1, 3]))
            role = str(rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "s", "User"]))
            text = str(rng.choice(["Yes.", "No", "What?", " ", "\t\n", "Well. ", "é!", f"text {rng.integers(99)}.", "no end,"]))
            rows.append((conv, at if rng.random() > 0.05 else None, role if rng.random() > 0.03 else None, text if rng.random() > 0.03 else None))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", None), (None, None, None, "x"), (-5, None, "user", "a."), (-6, 7, "assistant", "word " * 30_000 + ".")]
    return [(*r, 1, "n", "a", 2) for r in rows]


def as_dict(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def query(spark, rows, parts=3):
    conversations = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return turn_repair.report(turn_repair.damaged(conversations), conversations)


@pytest.mark.parametrize("segment", [4096, 4])
def test_every_conversation_is_that_of_the_search(spark, monkeypatch, segment):
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    rows = made_rows(1, 150, 12)
    assert as_dict(query(spark, rows)) == brute(rows)


def test_one_long_conversation_is_cut_into_segments(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "SEGMENT", 16)
    rng = np.random.default_rng(2)
    rows = [(1, k, ["user", "assistant", "system", "x"][int(rng.integers(4))], f"{k % 40}" + ".,"[k % 2], 1, "n", "a", 2) for k in range(150)]
    rows += [(k, 0, "user", "Hi.", 1, "n", "a", 2) for k in range(2, 40)]
    assert as_dict(query(spark, rows, 5)) == brute(rows)


def test_maps_say_what_reading_and_tracing_say():
    t, rng = turn_repair.tables(), np.random.default_rng(3)
    assert len(t.vectors) < 200
    for n in (0, 1, 4, 7, 33):
        symbols = rng.integers(0, turn_repair.SYMBOLS, n).tolist()
        front, cost, states = t.maps(symbols)
        for v in range(len(t.vectors)):
            trail, read = t.read(symbols, v)
            assert (trail[0], read) == (front[v], cost[v])
            for q in range(4):
                assert t.trace(symbols, v, q)[1] == states[v, q]


def test_block_tables_agree_with_single_steps():
    t = turn_repair.tables()
    rng = np.random.default_rng(4)
    for code in rng.integers(0, turn_repair.SYMBOLS**turn_repair.LENGTH, 300).tolist():
        for v in range(len(t.vectors)):
            at, cost = v, 0
            for k in range(turn_repair.LENGTH):
                s = code // turn_repair.SYMBOLS**k % turn_repair.SYMBOLS
                cost, at = cost + t.cost[s, at], t.step[s, at]
            assert (at, cost) == (t.block[code, v], t.price[code, v])


def test_repaired_rows_follow_the_pattern(spark):
    rows = made_rows(5, 60, 9)
    conversations = spark.createDataFrame(rows, SCHEMA)
    out = defaultdict(list)
    for r in turn_repair.repaired(conversations).orderBy("conv_id", "place", "nth").collect():
        out[r.conv_id].append(r.role[0])
    assert out and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in out.values())


def test_nothing_and_conversations_that_lose_all_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turn_repair.report(turn_repair.damaged(none), none).collect() == []
    assert turn_repair.repaired(none).collect() == []
    dropped = [k for k in range(200) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    rows = [(k, 0, "user", "Hi.", 1, "n", "a", 2) for k in dropped]
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert dropped and as_dict(query(spark, rows)) == dict.fromkeys(dropped, empty)
