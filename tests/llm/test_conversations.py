"""Conversation repair against a search over all edits and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from cellspark.llm import conversations as cv
from cellspark.llm.queries import op11_conversation_repair

WANTED = re.compile(r"(s?(ua)+)?\Z")
SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        visible = text.strip(SPACES)
        if not visible:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def best(rows):
    """(cost, audit, repaired) over plain layers: at most one row is worth inserting before a row, two at the end."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    layer = {"": (0, "", [])}
    for (role, text), fault in zip(rows, faults(rows)):
        nexts = defaultdict(list)
        for state, (cost, audit, out) in layer.items():
            starts = [(state, cost, audit, out)]
            made = "a" if state == "u" else "u"
            starts.append((made, cost + 5, audit + "I", [*out, (names[made], "")]))
            for at, c, a, o in starts:
                nexts[at].append((c + 2, a + "D", o))
                if fault in ("blank", "duplicate"):
                    continue
                more = 5 if fault else 0
                if role[:1] and role[:1] in follow[at]:
                    nexts[role[0]].append((c + more, a + "K", [*o, (role, text)]))
                to = "a" if at == "u" else "u"
                nexts[to].append((c + 1 + more, a + "R", [*o, (names[to], text)]))
        layer = {state: min(ways, key=lambda w: w[:2]) for state, ways in nexts.items()}
    ends = []
    for state, (cost, audit, out) in layer.items():
        if state in ("", "a"):
            ends.append((cost, audit, out))
        elif state == "u":
            ends.append((cost + 5, audit + "I", [*out, ("assistant", "")]))
        else:
            ends.append((cost + 10, audit + "II", [*out, ("user", ""), ("assistant", "")]))
    return min(ends, key=lambda w: w[:2])


def line(rows):
    """What the query returns for damaged rows (turn, role, text), in order."""
    plain = [(role, text) for _, role, text in rows]
    found = faults(plain)
    cost, audit, out = best(plain)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for role, _ in plain]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in out)
    counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    """Rows (conv, turn, role, text) to {conv: damaged rows in order}, with every conversation of the input."""
    groups = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        groups[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    for turns in groups.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    return groups


def all_audits(symbols):
    """Cheapest audit by trying every sequence of edits."""
    found = []
    for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
        for edits in itertools.product("KRD", repeat=len(symbols)):
            audit, roles, cost = "", "", 0
            for place, symbol in enumerate([*symbols, None]):
                for _ in range(inserts[place]):
                    audit, cost = audit + "I", cost + 5
                    roles += "a" if roles.endswith("u") else "u"
                if symbol is None:
                    break
                fault, kind = divmod(symbol, 4)
                edit = edits[place]
                audit += edit
                if edit == "D":
                    cost += 2
                    continue
                cost += (edit == "R") + 5 * (fault == cv.CUT) + 1000 * (fault >= cv.BLANK)
                roles += ("a" if roles.endswith("u") else "u") if edit == "R" else "suax"[kind]
            if WANTED.match(roles):
                found.append((cost, audit))
    return min(found)


def test_search_equals_all_edits():
    rng = random.Random(3)
    for _ in range(150):
        symbols = [rng.randrange(16) for _ in range(rng.randrange(4))]
        assert cv.cheapest(symbols) == all_audits(symbols), symbols


def as_rows(symbols):
    rows = []
    for i, s in enumerate(symbols):
        fault, kind = divmod(s, 4)
        text = {cv.SOUND: f"t{i}.", cv.CUT: f"t{i}", cv.BLANK: " "}.get(fault, "again.")
        rows.append((["system", "user", "assistant", "tool"][kind], text))
    return rows


def test_search_equals_layers():
    rng = random.Random(4)
    for n in [*range(12)] * 40 + [300]:
        symbols = [rng.choice([rng.randrange(12), 1, 2, 1, 2]) for _ in range(n)]
        assert cv.cheapest(symbols) == best(as_rows(symbols))[:2], symbols


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_segments_give_the_same(monkeypatch, size):
    monkeypatch.setattr(cv, "SEGMENT", size)
    rng = random.Random(size)
    for _ in range(300):
        symbols = [rng.choice([rng.randrange(12), 1, 2]) for _ in range(rng.randrange(1, 15))]
        parts = [symbols[at : at + size] for at in range(0, len(symbols), size)]
        ways = [cv.ways_through(part, not k) for k, part in enumerate(parts)]
        places = cv.choose([[w[:4] for w in table] for table in ways])
        taken = [table[place] for table, place in zip(ways, places)]
        assert (sum(w[2] for w in taken), "".join(w[4] for w in taken)) == cv.cheapest(symbols), symbols


def odd_rows():
    rng = random.Random(9)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "assistant", "user"]
    texts = ["Yes.", "no", "", None, " \t ", "Really?\n", "what!  ", "…", "é.", "a ", "x. y"]
    rows = []
    for conv in [None, *range(60)]:
        for i in range(rng.randrange(1, 9)):
            turn = rng.choice([i, i, i, None, rng.randrange(12)])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += [(100, -(2**63), "user", "Low."), (100, 2**63 - 1, "assistant", "High.")]
    rows += [(101, i % 50, rng.choice(["user", "assistant"]), f"Turn {i}{rng.choice(['.', '', '!'])}") for i in range(5000)]
    rows += [(102, i, "user" if i % 2 == 0 else "assistant", "long " * 100_000 + ".") for i in range(3)]
    rows += [(103, 1, "user", "Same.")] * 5
    return rows


def test_query_on_odd_rows(spark, tmp_path):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, _n int")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    want = {conv: line(turns) for conv, turns in damaged(rows).items()}
    assert want[100][0] > 2**63
    want[100] = (None, *want[100][1:])
    assert got == want


def test_turns(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "user", "cut"), (2, 0, "tool", "T.")]
    found = cv.repair(spark.createDataFrame(rows, "conv_id int, turn long, role string, text string"))
    got = sorted(tuple(r) for r in found.turns().collect())
    want = []
    for conv in (1, 2):
        cost, audit, out = best([(role, text) for c, _, role, text in rows if c == conv])
        want += [(conv, i, e, *turn) for i, (e, turn) in enumerate(zip(audit.replace("D", ""), out))]
    assert got == want


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert op11_conversation_repair(spark, str(tmp_path)).count() == 0
