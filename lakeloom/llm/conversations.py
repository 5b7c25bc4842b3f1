"""Conversation structure repair (operator 13).

A conversation's rows, ordered by turn, are repaired by the cheapest edits that
give role initials ``(s?(ua)+)?``. Its edit lattice has a node for every row
boundary and every state of that pattern (start, after system, after user,
after assistant); edges are Keep, Rerole, Delete and Insert. A bidirectional
Dijkstra search runs from both ends of the lattice: heaps of a forward and a
reverse side meet, every crossing that still may tie the best cost is settled,
and of all cheapest crossings the one of the least concatenated audit is taken.
Equal costs are told apart on each side by comparing the two audits from the
place where their paths part.

Long conversations. Rows are range-partitioned by conversation, turn, role and
digest, so a conversation of any size lies over many tasks, and are packed into
packets of bounded rows and bytes. A packet of a conversation that goes on
elsewhere gets a table of the cheapest audits between all pairs of states,
found by the same search; the search over a whole conversation then takes
packets as its layers. The task that joins a conversation's packets holds no
text, only these tables (16 audits a packet, where the result row itself has to
hold one). Repaired texts are hashed packet by packet in order.

Faults. A row is blank without a character other than ``[\\x20\\x09-\\x0D]``, a
duplicate if its role and text were seen earlier in the conversation, truncated
if the last such character is none of ``.!?``; the first of these counts.
First occurrences are found by an aggregate on digests (SHA-256, 128 bits of it,
over conversation, role and text) joined back behind a boundary, so that a row
that a conversation repeats without end is split.

Defined results: a null role or text is one space; a null conversation id is a
conversation of its own; null turns come first and count for no gap; rows of one
turn are ordered by role, then digest, and equal rows are interchangeable; a
conversation whose rows are all marked as gone gives zeros, an empty audit and
the hash of nothing. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.frames import boundary
from lakeloom.llm.base import SPACE, written

#: States of the pattern, and the role initials that lead on from each of them.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ACCEPTED = (START, ASSISTANT)
#: The costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
OK, BLANK, CUT, REPEATED = range(4)
INITIALS = "sua?"  # the last one stands for any other

Edge = tuple[int, int, str]  # node, cost, label


# ----------------------------------------------------------- the search
class _Side:
    """Labels of one direction: cost, link towards the end it came from, order of settling."""

    def __init__(self, ends: Iterable[int], forward: bool):
        self.forward = forward
        self.cost = dict.fromkeys(ends, 0)
        self.link: dict[int, tuple[int | None, str]] = {n: (None, "") for n in self.cost}
        self.order: dict[int | None, int] = {None: -1}
        # of equal costs the node closer to this side's end goes first, as
        # keeping a row costs nothing
        self.heap = sorted((0, n if forward else -n) for n in self.cost)

    def top(self) -> float:
        while self.heap and abs(self.heap[0][1]) in self.order:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> int:
        node = abs(heapq.heappop(self.heap)[1])
        self.order[node] = len(self.order)
        return node

    def _less(self, a: int | None, a_label: str, b: int | None, b_label: str) -> bool:
        """Whether the audit over ``a`` is less than the one over ``b``; only the parts up to their common node differ."""
        x, y = [a_label], [b_label]
        while a != b:
            if self.order[a] > self.order[b]:
                a, label = self.link[a]
                x.append(label)
            else:
                b, label = self.link[b]
                y.append(label)
        if self.forward:
            x.reverse()
            y.reverse()
        return "".join(x) < "".join(y)

    def relax(self, node: int, to: int, cost: int, label: str) -> None:
        if to in self.order:
            return
        cost += self.cost[node]
        known = self.cost.get(to)
        if known is None or cost < known:
            self.cost[to] = cost
            self.link[to] = (node, label)
            heapq.heappush(self.heap, (cost, to if self.forward else -to))
        elif cost == known and self._less(node, label, *self.link[to]):
            self.link[to] = (node, label)

    def path(self, node: int) -> list[tuple[int, str]]:
        """Nodes and labels from ``node`` to this side's end."""
        out = []
        at: int | None = node
        while at is not None:
            to, label = self.link[at]
            out.append((at, label))
            at = to
        return out


def cheapest(first: int, lasts: Iterable[int], out: Callable[[int], Iterable[Edge]], into: Callable[[int], Iterable[Edge]]) -> tuple[int, list[tuple[int, str]]] | None:
    """(cost, [(node, label that leads to it)]) of the cheapest way from ``first`` to one of ``lasts``;
    of equal costs the least concatenation of labels, None if there is no way.

    Nodes are numbered so that edges of no cost lead to a greater number.
    """
    lasts = list(lasts)
    ahead, back = _Side([first], True), _Side(lasts, False)
    best = float("inf")
    while True:
        a, b = ahead.top(), back.top()
        if a + b > best or a + b == float("inf"):
            break  # every crossing of the best cost has both of its ends settled
        side, other, edges = (ahead, back, out) if a <= b else (back, ahead, into)
        node = side.settle()
        if node in other.cost:
            best = min(best, side.cost[node] + other.cost[node])
        for to, cost, label in edges(node):
            side.relax(node, to, cost, label)
            if to in other.cost:
                best = min(best, side.cost[node] + cost + other.cost[to])
    if best == float("inf"):
        # one side ran dry before they met: the other end was reached by it, or by none
        reached = [n for n in lasts if n in ahead.order]
        if not reached:
            return None
        best = min(ahead.cost[n] for n in reached)
    # a cheapest way is ahead as far as it is settled there, then one crossing, then back
    found = [(ahead.path(n)[::-1], []) for n in lasts if n in ahead.order and ahead.cost[n] == best]
    for node in ahead.order:
        if node is None or ahead.cost[node] > best:
            continue
        for to, cost, label in out(node):
            if to not in ahead.order and to in back.order and ahead.cost[node] + cost + back.cost[to] == best:
                tail, lead = [], label
                for at, after in back.path(to):
                    tail.append((at, lead))
                    lead = after
                found.append((ahead.path(node)[::-1], tail))
    steps = min((h + t for h, t in found), key=lambda way: "".join(label for _, label in way))
    return int(best), steps


def _row_edges(symbol: int, state: int) -> list[tuple[int, int, str]]:
    """(state after, cost, edit) of a row's edits."""
    fault, initial = symbol >> 2, INITIALS[symbol & 3]
    edges = [(state, DELETE, "D")]
    if fault in (OK, CUT):
        extra = TRUNCATED if fault == CUT else 0
        for role, to in NEXT[state].items():
            if role == initial:
                edges.append((to, extra, "K"))
            elif role in ROLES:
                edges.append((to, REROLE + extra, "R"))
    return edges


_OUT = [[_row_edges(symbol, state) for state in range(4)] for symbol in range(16)]
_INTO = [[[(state, cost, edit) for state in range(4) for to, cost, edit in _OUT[symbol][state] if to == after] for after in range(4)] for symbol in range(16)]
_ADDED = [[to for role, to in NEXT[state].items() if role in ROLES] for state in range(4)]
_ADDED_INTO = [[state for state in range(4) if after in _ADDED[state]] for after in range(4)]


@functools.lru_cache(maxsize=4096)
def packet_audits(symbols: bytes, whole: bool) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit) of a packet's rows: of a whole conversation the one from
    start to acceptance, else between all pairs of states, without insertions after the last row."""
    n = len(symbols)

    def out(node):
        layer, state = divmod(node, 4)
        if layer < n or whole:
            yield from ((layer * 4 + to, INSERT, "I") for to in _ADDED[state])
        if layer < n:
            yield from ((layer * 4 + 4 + to, cost, edit) for to, cost, edit in _OUT[symbols[layer]][state])

    def into(node):
        layer, state = divmod(node, 4)
        if layer < n or whole:
            yield from ((layer * 4 + before, INSERT, "I") for before in _ADDED_INTO[state])
        if layer:
            yield from ((layer * 4 - 4 + before, cost, edit) for before, cost, edit in _INTO[symbols[layer - 1]][state])

    ends = [(START, ACCEPTED)] if whole else [(a, (b,)) for a in range(4) for b in range(4)]
    got = []
    for before, after in ends:
        way = cheapest(before, [n * 4 + state for state in after], out, into)
        if way is not None:
            cost, steps = way
            got.append((before, steps[-1][0] % 4, cost, "".join(label for _, label in steps)))
    return tuple(got)


def conversation_audit(tables: list[tuple[tuple[int, int, int, str], ...]]) -> tuple[int, list[str]]:
    """(cost, audit of each packet and of the end) by the same search, packets being the layers."""
    n = len(tables)

    def out(node):
        layer, state = divmod(node, 4)
        if layer < n:
            yield from ((layer * 4 + 4 + to, cost, audit) for before, to, cost, audit in tables[layer] if before == state)
        else:
            yield from ((layer * 4 + to, INSERT, "I") for to in _ADDED[state])

    def into(node):
        layer, state = divmod(node, 4)
        if layer == n:
            yield from ((layer * 4 + before, INSERT, "I") for before in _ADDED_INTO[state])
        if layer:
            yield from ((layer * 4 - 4 + before, cost, audit) for before, to, cost, audit in tables[layer - 1] if to == state)

    cost, steps = cheapest(START, [n * 4 + state for state in ACCEPTED], out, into)
    pieces = [""] * (n + 1)
    was = 0
    for node, label in steps:
        layer = node // 4
        pieces[layer - 1 if layer > was else layer] += label
        was = layer
    return cost, pieces


def applied(state: int, rows: list[tuple[str, str]], audit: str) -> tuple[int, list[tuple[str, str]]]:
    """(state after, repaired rows) of an audit's edits."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at]
        else:
            role = ROLES["a" if state == USER else "u"]
            text = "" if edit == "I" else rows[at][1]
        at += edit != "I"
        state = NEXT[state][role[0]]
        out.append((role, text))
    return state, out


# ------------------------------------------------------------- packets
_PACKETS = "conv long, packet long, whole boolean, symbols binary, digests array<binary>, turns array<long>, n_turns long, payload binary"


def _symbol(role: str, text: str) -> int:
    end = text.rstrip(SPACE)
    fault = BLANK if not end else OK if end[-1] in ".!?" else CUT
    return fault * 4 + max(0, "sua".find(role[0]) if role[:1] in ("s", "u", "a") else 3)


def _packet(conv, packet: int, whole: bool, rows: list[tuple]) -> dict:
    rows = [r for r in rows if not r[4]]
    symbols, digests, seen = bytearray(), [], set()
    for _, role, text, digest, _ in rows:
        symbol = _symbol(role, text)
        if symbol >> 2 == BLANK:
            digest = None
        elif digest in seen:
            symbol, digest = REPEATED * 4 + (symbol & 3), None
        else:
            seen.add(digest)
        symbols.append(symbol)
        digests.append(digest)
    turns = [r[0] for r in rows if r[0] is not None]
    payload = zstandard.compress(json.dumps([r[1:3] for r in rows], ensure_ascii=False).encode(), 3)
    return dict(conv=conv, packet=packet, whole=whole, symbols=bytes(symbols), digests=digests, turns=[turns[0], turns[-1]] if turns else [], n_turns=len(set(turns)), payload=payload)


def _packed(packet_rows: int, packet_bytes: int):
    schema = pa.schema([("conv", pa.int64()), ("packet", pa.int64()), ("whole", pa.bool_()), ("symbols", pa.binary()), ("digests", pa.list_(pa.binary())), ("turns", pa.list_(pa.int64())), ("n_turns", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = part = None
        held, size, no, run_no, packets_in_run = [], 0, 0, -1, 0

        def ready(last: bool, edge: bool) -> dict:
            nonlocal held, size, no, packets_in_run
            # a run at a partition's edge may go on in the next one
            whole = last and not edge and packets_in_run == 0 and run_no > 0
            row = _packet(conv, (part << 32) + no, whole, held)
            held, size, no, packets_in_run = [], 0, no + 1, packets_in_run + 1
            return row

        for b in batches:
            out = []
            columns = [b.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "digest", "gone", "part")]
            for c, turn, role, text, digest, gone, p in zip(*columns, strict=True):
                if run_no < 0 or c != conv:
                    if run_no >= 0:
                        out.append(ready(True, False))
                    conv, part, run_no, packets_in_run = c, p, run_no + 1, 0
                elif len(held) >= packet_rows or size + len(text) > packet_bytes:
                    out.append(ready(False, False))
                held.append((turn, role, text, digest, gone))
                size += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if run_no >= 0:
            yield pa.RecordBatch.from_pylist([ready(True, True)], schema)

    return run


def _tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A packet's counts and audits once its duplicates are known."""
    for b in batches:
        rows = []
        for r in b.to_pylist():
            symbols = bytearray(r["symbols"])
            for at in r["again"] or []:
                symbols[at] = REPEATED * 4 + (symbols[at] & 3)
            faults = [s >> 2 for s in symbols]
            initials = "".join(INITIALS[s & 3] for s in symbols)
            audits = [dict(zip(("before", "after", "cost", "audit"), x, strict=True)) for x in packet_audits(bytes(symbols), r["whole"])]
            rows.append(
                dict(
                    conv=r["conv"], packet=r["packet"], whole=r["whole"], turns=r["turns"], n_turns=r["n_turns"], blank=faults.count(BLANK), duplicate=faults.count(REPEATED), truncated=faults.count(CUT),
                    illegal=sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False)), ends=initials[:1] + initials[-1:], audits=audits,
                )
            )
        yield pa.RecordBatch.from_pylist(rows, _TABLE_SCHEMA)


_AUDITS = "array<struct<before:long,after:long,cost:long,audit:string>>"
_TABLES = f"conv long, packet long, whole boolean, turns array<long>, n_turns long, blank long, duplicate long, truncated long, illegal long, ends string, audits {_AUDITS}"
_LONG = pa.int64()
_TABLE_SCHEMA = pa.schema(
    [("conv", _LONG), ("packet", _LONG), ("whole", pa.bool_()), ("turns", pa.list_(_LONG)), ("n_turns", _LONG), ("blank", _LONG), ("duplicate", _LONG), ("truncated", _LONG), ("illegal", _LONG), ("ends", pa.string())]
    + [("audits", pa.list_(pa.struct([("before", _LONG), ("after", _LONG), ("cost", _LONG), ("audit", pa.string())])))]
)
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PIECES = "conv long, packet long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_PIECE_SCHEMA = pa.schema([("conv", _LONG), ("packet", _LONG), ("audit", pa.string())] + [(c, _LONG) for c in _COUNTS])


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(0, b.num_rows, 64):
            yield from b.slice(i, 64).to_pylist()


def _pieced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each packet's piece of its conversation's audit; the counts go with the first packet."""
    ready: list[dict] = []
    for conv, packets in groupby(_rows_of(batches), key=lambda r: r["conv"]):
        parts = list(packets)  # no texts: states, counts and audits
        if parts[0]["whole"]:
            audit = parts[0]["audits"][0]
            cost, pieces = audit["cost"], [audit["audit"], ""]
        else:
            cost, pieces = conversation_audit([tuple(tuple(a.values()) for a in p["audits"]) for p in parts])
        pieces[-2:] = [pieces[-2] + pieces[-1]]  # insertions at the end follow the last packet
        counts = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal")}
        ends = [p["ends"] for p in parts if p["ends"]]
        counts["illegal"] += sum(x[-1] + y[0] not in ("su", "ua", "au") for x, y in zip(ends, ends[1:], strict=False))
        turns = [p["turns"] for p in parts if p["turns"]]
        if turns:
            distinct = sum(p["n_turns"] for p in parts) - sum(x[1] == y[0] for x, y in zip(turns, turns[1:], strict=False))
            counts["gaps"] = turns[-1][1] - turns[0][0] + 1 - distinct
        else:
            counts["gaps"] = 0
        counts["cost"] = cost
        ready += [dict(conv=conv, packet=p["packet"], audit=piece) | (counts if i == 0 else {}) for i, (p, piece) in enumerate(zip(parts, pieces, strict=True))]
        if len(ready) >= 1024:
            yield pa.RecordBatch.from_pylist(ready, _PIECE_SCHEMA)
            ready = []
    if ready:
        yield pa.RecordBatch.from_pylist(ready, _PIECE_SCHEMA)


# ------------------------------------------------------------- repaired
def _repaired_packets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, its counts or None, audit piece, repaired rows) packet by packet, in order."""
    conv, state, piece, counts, first = None, START, "", None, True
    for r in _rows_of(batches):
        if first or r["conv"] != conv:
            conv, state, first = r["conv"], START, False
        if r["payload"] is None:  # a packet's piece comes before its rows
            piece, counts = r["audit"], {c: r[c] for c in _COUNTS} if r["cost"] is not None else None
            continue
        rows = [tuple(x) for x in json.loads(zstandard.decompress(r["payload"]))]
        state, fixed = applied(state, rows, piece)
        yield conv, counts, piece, fixed
        counts = None


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", _LONG)] + [(c, _LONG) for c in _COUNTS] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    ready, now, audits, digest, empty = [], None, [], None, True

    def done() -> dict:
        return now | dict(audit="".join(audits), repaired_sha256=digest.hexdigest())

    for conv, counts, piece, rows in _repaired_packets(batches):
        if counts is not None:
            if now is not None:
                ready.append(done())
                if len(ready) >= 1024:
                    yield pa.RecordBatch.from_pylist(ready, schema)
                    ready = []
            now, audits, digest, empty = counts | dict(conv_id=conv), [], hashlib.sha256(), True
        audits.append(piece)
        for role, text in rows:
            digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
            empty = False
    if now is not None:
        yield pa.RecordBatch.from_pylist([*ready, done()], schema)


def _turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", _LONG), ("position", _LONG), ("role", pa.string()), ("text", pa.string())])
    at = 0
    for conv, counts, _, rows in _repaired_packets(batches):
        at = 0 if counts is not None else at
        if rows:
            yield pa.RecordBatch.from_pylist([dict(conv_id=conv, position=at + i, role=role, text=text) for i, (role, text) in enumerate(rows)], schema)
        at += len(rows)


def _in_order(rows: DataFrame, packet_rows: int, packet_bytes: int) -> DataFrame:
    """Packets and their audits' pieces, those of one conversation in one task and in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = F.coalesce(F.col("gone"), F.lit(False))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.when(gone, "").otherwise(role).alias("role"), F.when(gone, "").otherwise(text).alias("text"), gone.alias("gone"))
    known = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit("-")), F.length("role"), F.concat("role", "text"))
    rows = rows.withColumn("digest", F.unhex(F.substring(F.sha2(known, 256), 1, 32)))
    # the salt lets a row that is repeated without end lie over many tasks
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "salt")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("conv", "turn", "role", "text", "digest", "gone", F.spark_partition_id().cast("long").alias("part"))
    packets = written(ranged.mapInArrow(_packed(packet_rows, packet_bytes), _PACKETS), "packets")
    shown = packets.select("packet", F.posexplode("digests").alias("at", "digest")).where(F.col("digest").isNotNull())
    again = boundary(shown.groupBy("digest").agg(F.min("packet").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    # a packet's own repeats are found already: any other packet than the first one repeats it
    repeats = shown.join(again, "digest").where("packet > first").groupBy("packet").agg(F.collect_list("at").alias("again"))
    known = packets.drop("payload", "digests").join(repeats, "packet", "left").select("conv", "packet", "whole", "symbols", "turns", "n_turns", "again")
    tables = known.mapInArrow(_tabled, _TABLES)
    pieces = written(tables.repartition("conv").sortWithinPartitions("conv", "packet").mapInArrow(_pieced, _PIECES), "audit-pieces")
    none = [F.lit(None).cast("long").alias(c) for c in _COUNTS]
    both = pieces.withColumn("payload", F.lit(None).cast("binary")).unionByName(packets.select("conv", "packet", F.lit(None).cast("string").alias("audit"), *none, "payload"))
    return both.repartition("conv").sortWithinPartitions("conv", "packet", F.col("payload").isNotNull())


def repair(rows: DataFrame, packet_rows: int = 512, packet_bytes: int = 1 << 20) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row per conversation.

    ``rows`` has conv_id, turn, role, text and gone (a row that only names its conversation).
    """
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return _in_order(rows, packet_rows, packet_bytes).mapInArrow(_digested, f"conv_id long, {counts}, audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame, packet_rows: int = 512, packet_bytes: int = 1 << 20) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations' rows."""
    return _in_order(rows, packet_rows, packet_bytes).mapInArrow(_turned, "conv_id long, position long, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, gone) that faults by ``crc32(conv_id:turn) % 20`` leave."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws(":", F.coalesce(conv.cast("string"), F.lit(" ")), F.coalesce(turn.cast("string"), F.lit(" ")))
    fault = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (fault == 0).alias("gone"), copies.alias("copy")).drop("copy")
