"""Repair of turns against a walk over the states of the grammar, which knows no targets or bands."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from conftest import SF, rows
from roomtrace.llm import turn_repair as T

BLANK = " \t\n\x0b\x0c\r"
NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}
AFTER = {"s": 1, "u": 2, "a": 3}


def brute(turns):
    """turns: (turn, role, text) in order.  Least (cost, audit) over the grammar's states, by plain string lists."""
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "", [])}

    def better(table, state, found):
        if state not in table or found[:2] < table[state][:2]:
            table[state] = found

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, said) in list(table.items()):
                for role in NEXT[state].replace("s", ""):
                    better(table, AFTER[role], (cost + 2, audit + "I", [*said, ({"u": "user", "a": "assistant"}[role], "")]))

    for (_, role, text), fault in zip(turns, faults):
        inserted(best)
        then = {}
        for state, (cost, audit, said) in best.items():
            better(then, state, (cost + 3, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            extra = cost + (fault == "truncated")
            for wanted in NEXT[state]:
                if role[:1] == wanted:
                    better(then, AFTER[wanted], (extra, audit + "K", [*said, (role, text)]))
                elif wanted != "s":
                    better(then, AFTER[wanted], (extra + 2, audit + "R", [*said, ({"u": "user", "a": "assistant"}[wanted], text)]))
        best = then
    inserted(best)
    cost, audit, said = min(best[s] for s in (0, 3) if s in best)
    numbers = [t for t, _, _ in turns if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "said": said,
    }


def ordered(turns):
    space = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    return sorted(space, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def random_turns(rnd, n, messy):
    out = []
    for i in range(n):
        turn = None if messy and rnd.random() < 0.1 else rnd.randrange(n) if messy else i
        role = rnd.choice(["user", "assistant", "system", "tool", "", None, "ua"]) if rnd.random() < messy else ("user", "assistant")[i % 2]
        text = rnd.choice(["", " \n", None, "no end", "Yes.", "Yes.", f"Text {rnd.randrange(4)}!"]) if rnd.random() < 0.5 else f"Number {i}."
        out.append((turn, role, text))
    return out


def tokens_of(rnd, n):
    return "".join(rnd.choice("suaSUAx--XUAua") for _ in range(n))


@pytest.mark.parametrize("segment", [3, 32])
def test_alignment_is_the_cheapest_and_least(monkeypatch, segment):
    monkeypatch.setattr(T, "SEGMENT", segment)
    rnd = random.Random(segment)
    for _ in range(600):
        tokens = tokens_of(rnd, rnd.randrange(0, 13))
        turns = []
        for i, t in enumerate(tokens):
            role = {"s": "system", "u": "user", "a": "assistant", "-": "user"}.get(t.lower(), "tool")
            turns.append((i, role, "" if t == "-" else f"{i}" if t.isupper() else f"{i}."))
        cost, audit, _, _ = T.span_audit(tokens, T.START, None)
        want = brute(turns)
        assert (cost, audit) == (want["cost"], want["audit"]), tokens


def test_costs_of_spans_agree_with_audits():
    rnd = random.Random(5)
    for _ in range(60):
        a, b = tokens_of(rnd, rnd.randrange(1, 50)), tokens_of(rnd, rnd.randrange(1, 50))
        costs = T.span_costs(b)
        after = T._before(tuple(tuple(costs[4 * s : 4 * s + 4]) for s in range(4)), T.CLOSING)
        first = T.span_audit(a, T.START, after)
        second = T.span_audit(b, first[3], None)
        whole = T.span_audit(a + b, T.START, None)
        assert (first[0] + second[0], first[1] + second[1]) == (whole[0], whole[1])


@pytest.mark.parametrize("span", [T.SPAN, 45])
def test_any_turns(spark, span):
    rnd = random.Random(span)
    table = {c: random_turns(rnd, rnd.randrange(1, 14), rnd.choice([0, 0.3, 1])) for c in range(60)}
    table[None] = random_turns(rnd, 9, 0.3)
    table[100] = random_turns(rnd, 700, 0.2)
    table[101] = [(1, "user", "Same."), (1, "user", "Same."), (None, None, None)]
    df = spark.createDataFrame(
        [(c, t, r, x, "extra") for c, turns in table.items() for t, r, x in turns], "conv_id bigint, turn bigint, role string, text string, digest string"
    ).repartition(7)
    found = T.audits(spark, df, span).persist()
    got = {r["conv_id"]: r for r in rows(found)}
    assert set(got) == set(table)
    said = {}
    for r in sorted(rows(T.repaired(df, found)), key=lambda r: r["position"]):
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, turns in table.items():
        want = brute(ordered(turns))
        assert {k: got[conv][k] for k in want if k != "said"} == {k: v for k, v in want.items() if k != "said"}, conv
        assert said.get(conv, []) == want["said"]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id string, turn bigint, role string, text string")
    found = T.audits(spark, none)
    assert rows(found) == [] and rows(T.repaired(none, found)) == []


def test_query(spark, answer):
    kept, every = {}, set()
    for conv, turn, role, text in duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall():
        every.add(conv)
        hit = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else "".join(c for c in text if c not in ".!?") if hit == 2 else text
        kept.setdefault(conv, []).extend([(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1))
    got = {r["conv_id"]: r for r in answer("op11_turn_repair")}
    assert set(got) == every
    for conv in every:
        want = brute(ordered(kept.get(conv, [])))
        said = "\n".join(f"{r}:{x}" for r, x in want.pop("said"))
        assert got[conv] == {"conv_id": conv, **want, "repaired_sha256": hashlib.sha256(said.encode()).hexdigest()}
