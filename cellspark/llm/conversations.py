"""Repair of a conversation's structure with the cheapest edits.

Wanted are role initials like ``(s?(ua)+)?``. A repair keeps, reroles or deletes each row and inserts empty rows. Rows
have faults: blank, a duplicate of an earlier row, or truncated.

The edit lattice of n rows has the nodes (rows done, state), where the state is what the last row kept was: nothing, s,
u or a. Two Dijkstra searches, forward from the entry and in reverse from the exits, expand the heap with the smaller
head. They meet, and go on until no unfinished crossing can cost as little; of all crossings of that cost the one with
the least concatenated audit is taken. Audits of equal cost that reach one node are never a prefix of one another (what
one has more would be insertions, which cost), so the least half on either side belongs to the least whole.

A conversation may hold a third of all rows. Rows are numbered without sorting it in one task and dealt in segments of
``SEGMENT`` rows. The searches of a segment give the cost and the least audit from each entry state to each exit state;
insertions stand before a row, or after the very last one. One row of costs per segment is then enough to choose the
states at the borders, the least audit first again. Texts meet the chosen edits at the end; they stream past in order,
and a running hash, which has to see a conversation in order, holds nothing of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import ship
from cellspark.plans.scale import materialize, number_rows, settle

SEGMENT = 2048
#: Costs. Keeping costs nothing but the fault of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States, and those in which a conversation may end.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (NOTHING, AFTER_A)
#: The user or assistant row that may come next, by state: an inserted or reroled row is that one.
MADE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE_OF = {AFTER_U: "user", AFTER_A: "assistant"}
#: Kinds of rows by initial (3: any other) and faults; a row's symbol is the hexadecimal digit 4 * fault + kind.
KINDS = "sua"
SOUND, CUT, BLANK, DUPLICATE = range(4)
#: Pairs of adjacent kinds that are legal: su, ua, au.
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: The exit that stands for any state in ``ENDS``, after the last row of a conversation.
END = -1
SPACE = r"\x20\x09-\x0D"


def _row_edits(symbol: int, state: int) -> list[tuple[int, str, int]]:
    """(cost, edit, state after) of the edits that use up a row."""
    fault, kind = divmod(symbol, 4)
    edits = [(DELETE, "D", state)]
    if fault < BLANK:
        more = TRUNCATED if fault == CUT else 0
        if kind == 0 and state == NOTHING:
            edits.append((more, "K", AFTER_S))
        elif 0 < kind < 3 and MADE[state] == kind + 1:
            edits.append((more, "K", kind + 1))
        edits.append((REROLE + more, "R", MADE[state]))
    return edits


#: The same for all symbols and states, and turned round: (cost, edit, state before) by symbol and state after.
EDITS = [[_row_edits(symbol, state) for state in range(4)] for symbol in range(16)]
BEFORE = [
    [[(c, e, before) for before in range(4) for c, e, after in EDITS[symbol][before] if after == state] for state in range(4)]
    for symbol in range(16)
]
MADE_FROM = [[before for before in range(4) if MADE[before] == state] for state in range(4)]


def cheapest(symbols: list[int], entry: int = NOTHING, leave: int = END) -> tuple[int, str] | None:
    """(cost, ASCII-least audit) of the cheapest edits that lead from state ``entry`` before the rows to ``leave``.

    ``END``: the conversation ends here, rows may be inserted after the last one too. None: there is no way.
    """
    n = len(symbols)
    open_end = leave == END
    exits = ENDS if open_end else (leave,)

    def onward(node):
        row, state = node
        found = [(c, e, (row + 1, after)) for c, e, after in EDITS[symbols[row]][state]] if row < n else []
        if row < n or open_end:
            found.append((INSERT, "I", (row, MADE[state])))
        return found

    def back(node):
        row, state = node
        found = [(c, e, (row - 1, before)) for c, e, before in BEFORE[symbols[row - 1]][state]] if row else []
        if row < n or open_end:
            found += [(INSERT, "I", (row, before)) for before in MADE_FROM[state]]
        return found

    fore, rear = {(0, entry): 0}, {(n, state): 0 for state in exits}
    sides = [(fore, [(0, (0, entry))], set(), onward), (rear, [(0, node) for node in rear], set(), back)]
    best = min((fore[node] + rear[node] for node in fore if node in rear), default=inf)
    while sides[0][1] or sides[1][1]:
        heads = [heap[0][0] if heap else inf for _, heap, _, _ in sides]
        if heads[0] + heads[1] > best:
            break
        here = 0 if heads[0] <= heads[1] else 1
        labels, heap, settled, ways = sides[here]
        other = sides[1 - here][0]
        cost, node = heappop(heap)
        if node in settled:
            continue
        settled.add(node)
        for step, _, near in ways(node):
            reached = cost + step
            if reached < labels.get(near, inf):
                labels[near] = reached
                heappush(heap, (reached, near))
                if near in other:
                    best = min(best, reached + other[near])
    if best == inf:
        return None
    # Below the heads all labels are final, and so are those of all nodes before them on cheapest ways.
    heads = [heap[0][0] if heap else inf for _, heap, _, _ in sides]
    done_fore = {node: cost for node, cost in fore.items() if cost < heads[0]}
    done_rear = {node: cost for node, cost in rear.items() if cost < heads[1]}
    left = _least(done_fore, back, {(0, entry): ""}, 1)
    right = _least(done_rear, onward, {(n, state): "" for state in exits}, -1)
    # A cheapest way lies below the rear head whole, or below the fore head, or leaves the one for the other by an edge.
    audits = [right[(0, entry)]] if done_rear.get((0, entry)) == best else []
    audits += [left[(n, state)] for state in exits if done_fore.get((n, state)) == best]
    for node, cost in done_fore.items():
        for step, edit, near in onward(node):
            if near in done_rear and cost + step + done_rear[near] == best:
                audits.append(left[node] + edit + right[near])
    return best, min(audits)


def _least(done: dict, ways, audits: dict, sign: int) -> dict:
    """Least audit of the cheapest ways from the ``audits`` given to every node of ``done``.

    ``ways`` leads from a node to those before it. Edges use up a row, or cost something in the same row.
    """
    for node in sorted(done, key=lambda node: (sign * node[0], done[node])):
        cost = done[node]
        found = [(edit, audits[near]) for step, edit, near in ways(node) if near in done and done[near] + step == cost]
        if found:
            audits[node] = min(before + edit if sign > 0 else edit + before for edit, before in found)
    return audits


def ways_through(symbols: list[int], first: bool) -> list[tuple[int, int, int, int, str]]:
    """(entry, exit, cost, rank, audit) of a segment; the rank orders the audits of one entry.

    Only a full segment may be followed by another one, and only the first is entered with nothing before.
    """
    exits = [END] if len(symbols) < SEGMENT else [END, NOTHING, AFTER_S, AFTER_U, AFTER_A]
    ways = []
    for entry in [NOTHING] if first else range(4):
        found = [(leave, way) for leave in exits if (way := cheapest(symbols, entry, leave))]
        order = sorted(way[1] for _, way in found)
        ways += [(entry, leave, way[0], order.index(way[1]), way[1]) for leave, way in found]
    return ways


def choose(segments: list[list[tuple[int, int, int, int]]]) -> list[int]:
    """For the ways (entry, exit, cost, rank) of consecutive segments, the place of the way to take in each."""
    later = [{END: 0}]
    for at, ways in enumerate(reversed(segments)):
        costs: dict[int, int] = {}
        for entry, leave, cost, _ in ways:
            if (leave == END) == (at == 0) and leave in later[-1]:
                costs[entry] = min(costs.get(entry, cost + later[-1][leave]), cost + later[-1][leave])
        later.append(costs)
    later.pop()
    state, chosen = NOTHING, []
    for ways in segments:
        left = later.pop()
        last = not later
        possible = [
            (cost + left[leave], rank, place)
            for place, (entry, leave, cost, rank) in enumerate(ways)
            if entry == state and leave in left and (leave == END) == last
        ]
        place = min(possible)[2]
        chosen.append(place)
        state = ways[place][1]
    return chosen


_SOLVED = (
    "_conv string, _segment long, symbols string, blank long, duplicate long, truncated long, illegal long, "
    "ways array<struct<entry:int,leave:int,cost:long,rank:int>>, audits array<string>"
)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = None
    known: dict[tuple[str, bool], tuple] = {}
    for batch in batches:
        rows = []
        for conv, segment, text in zip(*(column.to_pylist() for column in batch.columns)):
            found = known.get((text, segment == 0))
            if found is None:
                symbols = [int(c, 16) for c in text]
                faults = [s // 4 for s in symbols]
                kinds = [s % 4 for s in symbols]
                illegal = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:]))
                ways = ways_through(symbols, segment == 0)
                listed = [dict(zip(("entry", "leave", "cost", "rank"), way)) for way in ways]
                counts = (faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal)
                found = (*counts, listed, [way[4] for way in ways])
                if len(text) <= 16 and len(known) < 100_000:
                    known[text, segment == 0] = found
            rows.append((conv, segment, text, *found))
        if schema is None:
            way = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())])
            kinds_of = [pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.list_(way), pa.list_(pa.string())]
            names = ["_conv", "_segment", "symbols", "blank", "duplicate", "truncated", "illegal", "ways", "audits"]
            schema = pa.schema(list(zip(names, kinds_of)))
        columns = list(zip(*rows)) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of several segments: (conv, segment, place of its way, illegal pair at its front)."""
    for batch in batches:
        rows = []
        for conv, segments in zip(*(column.to_pylist() for column in batch.columns)):
            tables = [[(w["entry"], w["leave"], w["cost"], w["rank"]) for w in s["ways"]] for s in segments]
            before = None
            for segment, place in zip(segments, choose(tables)):
                pair = (before, int(segment["first"], 16) % 4)
                rows.append((conv, segment["_segment"], place, int(before is not None and pair not in LEGAL)))
                before = int(segment["last"], 16) % 4
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
        names = ["_conv", "_segment", "_place", "_border"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str, str]]:
    """(conv, edit, role, text) of the repaired conversations, in order.

    Rows are (conv, role, text, entry, audit): edits of a segment, which have an audit, before the segment's rows.
    """
    audit, at, state = "", 0, NOTHING
    for batch in batches:
        for conv, role, text, entry, edits in zip(*(column.to_pylist() for column in batch.columns)):
            if edits is not None:
                audit, at, state = edits, 0, entry
                continue
            while True:
                edit = audit[at]
                at += 1
                if edit in "IR":
                    state = MADE[state]
                    yield conv, edit, ROLE_OF[state], text if edit == "R" else ""
                elif edit == "K":
                    state = KINDS.index(role[0]) + 1
                    yield conv, edit, role, text
                if edit != "I":
                    break
            while at < len(audit) and "I" * (len(audit) - at) == audit[at:]:
                state, at = MADE[state], at + 1
                yield conv, "I", ROLE_OF[state], ""


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["_conv", "place", "edit", "role", "text"], [pa.string(), pa.int64(), *[pa.string()] * 3]
    rows: list[tuple] = []
    last, place = None, 0

    def out():
        found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        rows.clear()
        return found

    for conv, edit, role, text in _repaired(batches):
        place = place + 1 if conv == last else 0
        last = conv
        rows.append((conv, place, edit, role, text))
        if len(rows) == 1024:
            yield out()
    if rows:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    last, running = None, None
    names, kinds = ["_conv", "repaired_sha256"], [pa.string(), pa.string()]

    def out():
        found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        rows.clear()
        return found

    for conv, _, role, text in _repaired(batches):
        if conv != last:
            if running:
                rows.append((last, running.hexdigest()))
            if len(rows) >= 4096:
                yield out()
            last, running = conv, hashlib.sha256()
        else:
            running.update(b"\n")
        running.update(role.encode())
        running.update(b":")
        running.update(text.encode())
    if running:
        rows.append((last, running.hexdigest()))
    if rows:
        yield out()


@dataclass
class Repair:
    """What ``repair`` finds. ``report`` has a row per conversation, ``turns()`` the repaired rows."""

    report: DataFrame
    _ordered: DataFrame
    _id_col: str

    def turns(self) -> DataFrame:
        """id, place (from 0), edit (K, R or I), role, text of the repaired conversations."""
        found = self._ordered.mapInArrow(_turns, "_conv string, place long, edit string, role string, text string")
        return _with_id(found, self._id_col, self.report.schema[self._id_col].dataType)

    def digests(self) -> DataFrame:
        """id, repaired_sha256: of the lines ``role:text``; conversations without a row left are missing."""
        found = self._ordered.mapInArrow(_digests, "_conv string, repaired_sha256 string")
        return _with_id(found, self._id_col, self.report.schema[self._id_col].dataType)


def _key(column: str) -> Column:
    """A text that is never null and tells all ids apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _with_id(df: DataFrame, id_col: str, dtype) -> DataFrame:
    value = F.when(F.col("_conv") != "", F.substr("_conv", F.lit(2)).cast(dtype))
    return df.select(value.alias(id_col), *[c for c in df.columns if c != "_conv"])


def repair(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repair:
    """Faults and cheapest repair of every conversation.

    Rows of a conversation stand by turn, nulls first; ties by role and text. A null id is a conversation of its own.
    Null roles and texts count as one space. The report: id, rows, gaps (turns missing between the least and the
    greatest; null if it exceeds a long), blank, duplicate, truncated, illegal, cost, audit. Ids are integers or
    strings. Other columns are left out. No row, no conversation.
    """
    ship(rows.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    given = rows.select(_key(id_col).alias("_conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = [F.col("turn"), F.col("role"), F.col("text")]
    placed = settle(
        rows.sparkSession, lambda: number_rows(given, ["_conv"], order, "_n").withColumn("_n", F.col("_n") - 1)
    )
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first_of_equals = placed.groupBy("_conv", same.alias("_same")).agg(F.min("_n").alias("_n")).select("_conv", "_n", F.lit(True).alias("_first"))
    last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
    fault = (
        F.when(last == "", BLANK)
        .when(F.col("_first").isNull(), DUPLICATE)
        .when(~last.isin(".", "!", "?"), CUT)
        .otherwise(SOUND)
    )
    kind = F.coalesce(F.nullif(F.instr(F.lit(KINDS), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(3))
    kind = F.when(F.col("role") == "", 3).otherwise(kind)
    symbol = F.substring(F.lit("0123456789abcdef"), fault * 4 + kind + 1, F.lit(1))
    # (conversation, number) is unique on both sides, so no key of this join is hot
    faults = placed.join(first_of_equals, ["_conv", "_n"], "left").select("_conv", "_n", symbol.alias("_symbol"))
    segments = faults.groupBy("_conv", F.expr(f"_n div {SEGMENT}").alias("_segment")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_symbol"))), lambda s: s["_symbol"]), "").alias("symbols")
    )
    solved = materialize(segments.mapInArrow(_solve, _SOLVED))
    counted = ["blank", "duplicate", "truncated"]
    alone = (F.col("_segment") == 0) & (F.length("symbols") < SEGMENT)
    of_one = solved.filter(alone).select("*", F.lit(0).alias("_place"), F.lit(0).cast("long").alias("_border"))
    part = F.struct("_segment", F.substring("symbols", 1, 1).alias("first"), F.substring("symbols", -1, 1).alias("last"), "ways")
    borders = (
        solved.filter(~alone).groupBy("_conv").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
        .mapInArrow(_border, "_conv string, _segment long, _place int, _border long")
    )
    several = solved.filter(~alone).join(borders, ["_conv", "_segment"])
    way = F.col("ways")[F.col("_place")]
    chosen = materialize(
        of_one.unionByName(several.select(of_one.columns)).select(
            "_conv", "_segment", F.length("symbols").cast("long").alias("rows"), *counted,
            (F.col("illegal") + F.col("_border")).alias("illegal"), way["cost"].alias("cost"),
            way["entry"].alias("entry"), F.col("audits")[F.col("_place")].alias("audit"),
        )
    )
    sums = [F.sum(c).alias(c) for c in ("rows", *counted, "illegal", "cost")]
    parts = F.array_sort(F.collect_list(F.struct("_segment", "audit")))
    by_conv = chosen.groupBy("_conv").agg(*sums, F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    turns = placed.groupBy("_conv").agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("different")
    )
    wide = [F.col(c).cast("decimal(38,0)") for c in ("most", "least", "different")]
    gaps = F.when(F.col("different") == 0, F.lit(0)).otherwise((wide[0] - wide[1] + 1 - wide[2]).try_cast("long"))
    report = by_conv.join(turns.select("_conv", gaps.cast("long").alias("gaps")), "_conv")
    nothing = [F.lit(None).cast(t) for t in ("string", "string", "int", "string")]
    stream = placed.select("_conv", "_n", F.lit(1).alias("_kind"), "role", "text", nothing[2].alias("entry"), nothing[3].alias("audit"))
    edits = chosen.select(
        "_conv", (F.col("_segment") * SEGMENT).alias("_n"), F.lit(0).alias("_kind"),
        nothing[0].alias("role"), nothing[1].alias("text"), "entry", "audit",
    )
    ordered = (
        stream.unionByName(edits).repartition("_conv").sortWithinPartitions("_conv", "_n", "_kind")
        .select("_conv", "role", "text", "entry", "audit")
    )
    return Repair(_with_id(report, id_col, rows.schema[id_col].dataType), ordered, id_col)


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, chosen by the CRC-32 of ``conv_id:turn`` modulo 20.

    Nulls in it, and null roles and texts, are one space. 0 drops a row, 1 empties its text, 2 removes ``.!?`` from
    it, 3 repeats the row, 4 makes the role user.
    """
    blank = F.lit(" ")
    name = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20
    text = F.coalesce("text", blank)
    hurt = rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("_times"),
    )
    return hurt.withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).drop("_times")
