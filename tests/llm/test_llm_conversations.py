from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from layerloom.llm import conversations
from layerloom.llm.conversations import Audits, Rebuilder, Trails
from layerloom.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def fault_of(rows, i):
    role, text = rows[i]
    shown = VISIBLE.findall(text)
    if not shown:
        return "blank"
    if (role, text) in rows[:i]:
        return "duplicate"
    return "truncated" if shown[-1] not in ".!?" else None


def exhaustive(rows):
    """Every sequence of edits with up to two insertions in each gap: the least by cost, then letters."""
    faults = [fault_of(rows, i) for i in range(len(rows))]
    choices = []
    for (role, text), fault in zip(rows, faults, strict=True):
        own = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault else 0
            own += [("K", extra, (role, text)), ("R", 3 + extra, ("user", text)), ("R", 3 + extra, ("assistant", text))]
        choices.append(own)
    new = [("I", 3, ("user", "")), ("I", 3, ("assistant", ""))]
    gap = [seq for n in range(3) for seq in itertools.product(new, repeat=n)]
    best = None
    for edits in itertools.product(gap, *(pair for own in choices for pair in ([(c,) for c in own], gap))):
        flat = [edit for part in edits for edit in part]
        turns = [edit[2] for edit in flat if edit[2] is not None]
        if LEGAL.fullmatch("".join(role[:1] or "?" for role, _ in turns)):
            text = "\n".join(f"{role}:{text}" for role, text in turns)
            found = (sum(e[1] for e in flat), "".join(e[0] for e in flat), sha256(text.encode()).hexdigest())
            best = found if best is None else min(best, found)
    return best


def by_strings(rows):
    """The same by a plain dynamic program over whole audits and whole texts."""
    follow = {"": "us", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(2):
            for state, (cost, audit, turns) in list(states.items()):
                for to in follow[state].replace("s", ""):
                    offer(states, to, (cost + 3, audit + "I", (*turns, names[to] + ":")))
        return states

    def offer(states, to, found):
        if to not in states or found[:2] < states[to][:2]:
            states[to] = found

    states = {"": (0, "", ())}
    for i, (role, text) in enumerate(rows):
        fault, after = fault_of(rows, i), {}
        for state, (cost, audit, turns) in inserted(states).items():
            offer(after, state, (cost + 4, audit + "D", turns))
            if fault in (None, "truncated"):
                cost += 3 if fault else 0
                for to in follow[state]:
                    if role[:1] == to:
                        offer(after, to, (cost, audit + "K", (*turns, f"{role}:{text}")))
                    if to != "s":
                        offer(after, to, (cost + 3, audit + "R", (*turns, f"{names[to]}:{text}")))
        states = after
    states = inserted(states)
    cost, audit, turns = min((states[s] for s in ("", "a") if s in states), key=lambda found: found[:2])
    return cost, audit, sha256("\n".join(turns).encode()).hexdigest()


def result(rows):
    """All columns of ``(turn, role, text)`` rows in order."""
    plain = [row[1:] for row in rows]
    faults = [fault_of(plain, i) for i in range(len(plain))]
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(plain, plain[1:], strict=False)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, *by_strings(plain))


def values(row):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return tuple(row[name] for name in names)


def in_order(rows):
    def digest(role, text):
        return sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()

    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))


@pytest.mark.parametrize("seed", range(60))
def test_cheapest_audit_of_all(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", " ", "Go on!", "What?", "x"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", " ", ""]
    rows = [(rng.choice(roles), rng.choice(texts)) for _ in range(seed % 4)]
    want = exhaustive(rows)
    assert by_strings(rows) == want
    part = conversations.Part(":1", 1)
    faults = {"blank": 1, "duplicate": 2, "truncated": 3, None: 0}
    for i, (role, text) in enumerate(rows):
        part.add(i, role, text, faults[fault_of(rows, i)])
    assert part.whole()[2:] == want


@pytest.mark.parametrize("seed", range(20))
def test_parts_put_together_equal_the_whole(seed):
    rng = random.Random(seed)
    rows = [(rng.choice("suaa"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(60)]
    audits = Audits()
    states = audits.entered(conversations.START)
    whole = states
    for initial, fault in rows:
        whole = audits.after_row(whole, initial, fault)
    at = 0
    while at < len(rows):
        size = rng.randrange(1, 12)
        part = conversations.Part(":1", 1)
        for initial, fault in rows[at : at + size]:
            part.add(None, initial, "", fault)
        transfers = {(entry, exit_): (cost, audit) for entry, exit_, cost, audit, _ in part.transfers()}
        states = audits.after_part(states, transfers)
        at += size
    assert audits.closed(states) == audits.closed(whole)


@pytest.mark.parametrize("collide", [False, True])
def test_audits_compare_like_texts(monkeypatch, collide):
    if collide:  # every hash is equal, so that only the verification tells audits apart
        monkeypatch.setattr(conversations, "_hashed", lambda start, letters: 0)
    rng = random.Random(1)
    trails, nodes, texts = Trails(), [0], [""]
    for _ in range(400):
        at = rng.randrange(max(0, len(nodes) - 20), len(nodes))
        letters = "".join(rng.choice("DIK") for _ in range(rng.choice([1, 1, 1, 5])))
        nodes.append(trails.extended(nodes[at], letters))
        texts.append(texts[at] + letters)
    for _ in range(3000):
        a, b = rng.randrange(len(nodes)), rng.randrange(len(nodes))
        assert trails.text(nodes[a]) == texts[a]
        assert trails.less(nodes[a], nodes[b]) == (texts[a] < texts[b])


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    kept = defaultdict(list)
    for r in rows:
        case = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        role, text = r.role or " ", r.text if r.text is not None else " "
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        own = (r.turn, "user" if case == 4 else role, text)
        kept[r.conv_id] += [own] * (0 if case == 0 else 2 if case == 3 else 1)
    found = {r.conv_id: values(r) for r in QUERIES["op11_conversation_repair"](spark, sf_dir).collect()}
    assert found == {c: result(in_order(own)) for c, own in kept.items()}
    assert {kind for row in found.values() for kind in row[6]} == set("KDRI")


def test_odd_rows_and_a_conversation_over_many_tasks(spark):
    rng = random.Random(3)
    odd = [
        (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (2, None, None, None), (2, None, "user", "a"),
        (3, 5, "user", "é。"), (3, 5, "user", "é。"), (3, 9, "assistant", "x" * 300_000 + "."), (4, 1, "", "Empty role."),
        (4, 2, "user", "\x85"), (4, 3, "user", "　."), (5, 1, "assistant", "Only."), (6, None, "user", "U?"),
        (6, None, "assistant", "A!"), (7, -3, "system", "S."), (7, 3, "system", "S."),
    ]
    long = [(8, i // 2 * 2, rng.choice(["user", "assistant", "assistant"]), f"{i % 700} said{rng.choice('.!,')}") for i in range(4000)]
    same = [(9, 1, "user", "Same.")] * 1500
    rows = odd + long + same
    turns = spark.createDataFrame([(*row, 1) for row in rows], "conv_id long, turn long, role string, text string, KEY int")
    found = conversations.repaired(turns.repartition(5)).collect()
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want = {conv: result(in_order(own)) for conv, own in groups.items()}
    assert {r.conv_id: values(r) for r in found} == want and len(found) == len(want)
    empty = conversations.with_empty(turns, conversations.repaired(turns.filter("conv_id = 5")))
    rest = {values(r) for r in empty.collect() if r.conv_id != 5}
    assert rest == {(0, 0, 0, 0, 0, 0, "", sha256().hexdigest())} and empty.count() == len(want)
    assert conversations.repaired(turns.limit(0)).count() == 0


def test_rebuilt_turns():
    built = Rebuilder("KRDI")
    for role, text in [("system", "s."), ("x", "b."), ("x", " ")]:
        built.take(role, text)
    assert built.digest() == sha256(b"system:s.\nuser:b.\nassistant:").hexdigest()
