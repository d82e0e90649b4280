"""Repair of conversations: the cheapest edits that leave well-formed turns, by bidirectional search."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallybook.llm.common import materialized, small_batches, width

# --- fixed values: roles, faults, costs ---
ROLES = ("user", "assistant")
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
# --- end of fixed values ---

# What the repaired turns so far end with: nothing, a system turn, a user turn, an assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
_STATES = (NONE, SYSTEM, USER, ASSISTANT)
_NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
# Edits that make a conversation complete from each state: (cost, audit).
_CLOSING = {NONE: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}

# A row as one character: "#" must go; else s, u, a or x for its role's initial, upper case if cut short.
_MUST_GO = "#"

Ends = tuple[tuple[int, int, str], ...]


def row_code(initial: str, fault: str | None) -> str:
    if fault in (BLANK, DUPLICATE):
        return _MUST_GO
    code = initial if initial in ("s", "u", "a") else "x"
    return code.upper() if fault == TRUNCATED else code


def steps(code: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, state after) of every edit that uses up a row."""
    yield DELETE, "D", state
    if code == _MUST_GO:
        return
    more = CUT_SHORT if code.isupper() else 0
    after = _NEXT[state]
    if code.lower() == _INITIAL[after]:
        yield more, "K", after
    elif code.lower() == "s" and state == NONE:
        yield more, "K", SYSTEM
    yield REROLE + more, "R", after


def _back(code: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letter, state before) of every edit of a row that ends in ``state``."""
    for before in _STATES:
        for cost, letter, after in steps(code, before):
            if after == state:
                yield cost, letter, before


class _Side:
    """One of the two searches: a heap, what is settled, and the least audit of each node.

    At equal cost, nodes farther along come first, so all ways to a node are known when it is settled:
    edits that cost nothing always use up a row.
    """

    def __init__(self, direction: int):
        self.direction, self.heap, self.best, self.settled = direction, [], {}, {}

    def offer(self, cost: int, row: int, state: int, audit: str) -> None:
        known = self.best.get((row, state))
        if known is None or cost < known[0]:
            self.best[row, state] = (cost, audit)
            heapq.heappush(self.heap, (cost, row * self.direction, state))
        elif cost == known[0] and audit < known[1]:
            self.best[row, state] = (cost, audit)

    def top(self) -> int | None:
        while self.heap and (node := (self.heap[0][1] * self.direction, self.heap[0][2])) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> tuple[int, str, int, int]:
        _, row, state = heapq.heappop(self.heap)
        node = (row * self.direction, state)
        self.settled[node] = self.best[node]
        return *self.settled[node], *node


def search(codes: str, entry: int, ends: Ends) -> tuple[int, str] | None:
    """Least cost and its least audit, from ``entry`` before the rows to one of ``ends`` after them; None if there is no way.

    ``ends`` are (state, cost, audit) of what follows. Turns may be inserted before each row. Two Dijkstra searches
    run over the lattice of (rows used up, state), one from the entry, one from the ends, the one with the lower
    top first. Once both tops together exceed the least cost met, every cheapest way has an edit that crosses
    from a node settled from the front to one settled from the rear, or it is settled from the front up to its end.
    Of all such crossings of least cost the least concatenated audit is taken. Audits of equal cost to one
    node are never prefixes of each other, so the least audit up to a node belongs to the least of the whole.
    """
    n, front, rear = len(codes), _Side(1), _Side(-1)
    front.offer(0, 0, entry, "")
    for state, cost, audit in ends:
        rear.offer(cost, n, state, audit)
    closing = {state: (cost, audit) for state, cost, audit in ends}
    least = float("inf")
    while True:
        a, b = front.top(), rear.top()
        if a is None and b is None or (a or 0) + (b or 0) > least:
            break
        if b is None or a is not None and a <= b:
            cost, audit, row, state = front.settle()
            if row == n and state in closing:
                least = min(least, cost + closing[state][0])
            for more, letter, to_row, to in _forward(codes, n, row, state):
                front.offer(cost + more, to_row, to, audit + letter)
                if met := rear.settled.get((to_row, to)):
                    least = min(least, cost + more + met[0])
        else:
            cost, audit, row, state = rear.settle()
            for more, letter, from_row, before in _backward(codes, n, row, state):
                rear.offer(cost + more, from_row, before, letter + audit)
                if met := front.settled.get((from_row, before)):
                    least = min(least, cost + more + met[0])
    crossings = []
    for (row, state), (cost, audit) in front.settled.items():
        if row == n and state in closing and cost + closing[state][0] == least:
            crossings.append(audit + closing[state][1])
        for more, letter, to_row, to in _forward(codes, n, row, state):
            if (met := rear.settled.get((to_row, to))) and cost + more + met[0] == least:
                crossings.append(audit + letter + met[1])
    return (int(least), min(crossings)) if crossings else None


def _forward(codes: str, n: int, row: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    if row < n:
        for cost, letter, after in steps(codes[row], state):
            yield cost, letter, row + 1, after
        yield INSERT, "I", row, _NEXT[state]


def _backward(codes: str, n: int, row: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    if row > 0:
        for cost, letter, before in _back(codes[row - 1], state):
            yield cost, letter, row - 1, before
    if row < n:
        for before in _STATES:
            if _NEXT[before] == state:
                yield INSERT, "I", row, before


def walk(codes: str, entry: int, audit: str) -> list[tuple[int, str, int, int]]:
    """(row, letter, state before, state after) of each edit; an inserted turn has the row it precedes."""
    out, row, state = [], 0, entry
    for letter in audit:
        before = state
        if letter == "K":
            state = SYSTEM if codes[row].lower() == "s" else _NEXT[state]
        elif letter in "RI":
            state = _NEXT[state]
        out.append((row, letter, before, state))
        row += letter != "I"
    return out


@lru_cache(maxsize=1 << 16)
def _whole(codes: str) -> tuple[int, str]:
    return search(codes, NONE, tuple((q, *_CLOSING[q]) for q in _STATES))


def whole(codes: str) -> tuple[int, str]:
    """Least cost and audit of a whole conversation; short ones recur, so they are remembered."""
    return _whole(codes) if len(codes) <= 32 else _whole.__wrapped__(codes)


def table(codes: str) -> list[tuple[int, int, int, str, int]]:
    """(entry, end, cost, audit, rank) of a piece of a conversation, from every state to every state.

    ``rank`` orders the audits of one entry. They end with a row's letter and all use up the same rows,
    so none is a prefix of another, and ranks decide between whole audits too.
    """
    out = []
    for entry in _STATES:
        found = [(hit[1], end, hit[0]) for end in _STATES if (hit := search(codes, entry, ((end, 0, ""),)))]
        out += [(entry, end, cost, audit, rank) for rank, (audit, end, cost) in enumerate(sorted(found))]
    return out


Table = Mapping[tuple[int, int], tuple[int, int]]


def joined(tables: list[Table]) -> list[tuple[int, int, int, str, int]]:
    """As ``table`` of consecutive pieces, given (cost, rank) by (entry, end) of each.

    In the place of an audit stands the path: the end state of each piece, as digits.
    """
    ways: dict[int, list[tuple[list[int], int, int, str]]] = {q: [] for q in _STATES}
    for end in _STATES:
        # Backwards: least cost from each state; of equal ones the least rank here, as its audit comes first.
        ahead: dict[int, tuple[int, str]] = {end: (0, "")}
        for piece in reversed(tables):
            now: dict[int, tuple[int, str]] = {}
            for entry in _STATES:
                options = [
                    (cost + ahead[to][0], rank, str(to) + ahead[to][1])
                    for to in ahead
                    if (entry, to) in piece
                    for cost, rank in [piece[entry, to]]
                ]
                if options:
                    cost, _, path = min(options)
                    now[entry] = (cost, path)
            ahead = now
        for entry, (cost, path) in ahead.items():
            states = [entry, *map(int, path)]
            ranks = [piece[a, b][1] for piece, a, b in zip(tables, states, states[1:])]
            ways[entry].append((ranks, end, cost, path))
    return [
        (entry, end, cost, path, rank)
        for entry in _STATES
        for rank, (_, end, cost, path) in enumerate(sorted(ways[entry]))
    ]


def closed(rows: list[tuple[int, int, int, str, int]]) -> tuple[int, int]:
    """(cost, end) of the best way from the first entry, with what completes the conversation."""
    cost, _, end = min((cost + _CLOSING[end][0], rank, end) for entry, end, cost, _, rank in rows if entry == NONE)
    return cost, end


# ---------------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows harmed by a checksum of ``conv_id:turn``; nulls count as one space.

    0 drops a row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 gives it
    a copy beside it, 4 makes it the user's. Ids and turns themselves stay null.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, harm = F.coalesce("text", space), F.col("harm")
    return (
        conversations.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("harm"))
        .where("harm <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(harm == 4, F.lit(ROLES[0])).otherwise(F.coalesce("role", space)).alias("role"),
            F.when(harm == 1, F.lit("")).when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.when(harm == 3, 2).otherwise(1).alias("copies"),
        )
    )


def _key(digest: Column) -> Column:
    """Checksum that names a row by conversation, turn, role and digest of its text."""
    conv, turn = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in ("conv_id", "turn")]
    return F.unhex(F.sha2(F.concat_ws(":", conv, turn, F.sha2("role", 256), F.hex(digest)), 256))


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def _facts(rows: DataFrame) -> DataFrame:
    """One narrow row per conversation, turn, role and text: how often it occurs, and whether it is the first of its role and text."""
    last = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), -1, 1)
    keys = ["conv_id", "turn", "role", "digest"]
    narrow = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), "copies",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    counted = narrow.groupBy(*keys, "blank", "cut").agg(F.sum("copies").cast("long").alias("copies"))
    counted = materialized(counted.withColumn("first", F.lit(False)), "turns")
    # The first turn of each role and text is marked by a union, not a join: a text that fills half a
    # conversation stays spread by turn.
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = counted.groupBy("conv_id", "role", "digest").agg(F.min(when).alias("when"))
    marked = firsts.select("conv_id", F.col("when.turn").alias("turn"), "role", "digest", F.lit(True).alias("first"))
    kept = [F.max(c).alias(c) for c in ("copies", "blank", "cut", "first")]
    return counted.unionByName(marked, allowMissingColumns=True).groupBy(*keys).agg(*kept)


def _ordered(rows: DataFrame) -> DataFrame:
    """Every single row with its ``fault`` and ``place``: conversations side by side, in turn order, dealt to tasks
    by ranges of conversation and turn, so that a long one spans many."""
    single = _facts(rows).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    again = ~F.col("first") | (F.col("copy") > 1)
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), TRUNCATED)
    keys = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest", "copy")]
    dealt = single.repartitionByRange(width(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.select("conv_id", "turn", "role", _key(F.col("digest")).alias("key"), fault.alias("fault"), F.monotonically_increasing_id().alias("place"))


@dataclass
class Stats:
    """Of consecutive rows: distinct turns, faults, illegal neighbours, and what stands at both ends."""

    turn_first: int | None
    turn_last: int | None
    role_first: str
    role_last: str
    turns: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int

    @staticmethod
    def of(turn: int | None, role: str, fault: str | None) -> Stats:
        initial = role[:1]
        return Stats(turn, turn, initial, initial, int(turn is not None), int(fault == BLANK), int(fault == DUPLICATE), int(fault == TRUNCATED), 0)

    def add(self, other: Stats) -> None:
        """Turns are sorted, nulls first and uncounted, so only the turn at the border can be on both sides."""
        self.illegal += other.illegal + (self.role_last + other.role_first not in LEGAL)
        self.turns += other.turns - (self.turn_last is not None and self.turn_last == other.turn_first)
        self.turn_first = other.turn_first if self.turn_first is None else self.turn_first
        self.turn_last = self.turn_last if other.turn_last is None else other.turn_last
        self.role_last = other.role_last
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated


_STATS = tuple(Stats.__dataclass_fields__)
_STATS_TYPES = "turn_first long, turn_last long, role_first string, role_last string, turns long, blank long, duplicate long, truncated long, illegal long"
_WAYS = "ways array<struct<entry:int,end:int,cost:long,audit:string,rank:int>>"
_WAY = ("entry", "end", "cost", "audit", "rank")
_OUT = 512  # rows a batch handed back


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of Arrow batches as they are: unlike pandas, integers beside nulls stay integers."""
    for batch in batches:
        yield from batch.to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _mapped(rows: DataFrame, of: Callable[[Iterator[dict]], Iterator[dict]], types: str) -> DataFrame:
    """Rows made from a stream of rows, a partition at a time; ``conv_id`` keeps its type."""
    types = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {types}"
    schema = to_arrow_schema(StructType.fromDDL(types))
    return rows.mapInArrow(lambda batches: _batched(of(_listed(batches)), schema), types)


def _runs(rows: Iterator[dict], most: int) -> Iterator[tuple[list[dict], int, bool]]:
    """Neighbouring rows of one conversation, at most ``most``, how many such runs of it came before, and whether
    they are known to be all of it.

    What touches the first or last row of the task may go on in the next one.
    """
    run: list[dict] = []
    number, opened = 0, False  # opened: the conversation began in this task, after another, and within this run
    for row in rows:
        if run and (run[0]["conv_id"] != row["conv_id"] or len(run) == most):
            other = run[0]["conv_id"] != row["conv_id"]
            yield run, number, opened and other
            number, opened, run = 0 if other else number + 1, other, []
        run.append(row)
    if run:
        yield run, number, False


def _named(ways: list[tuple]) -> list[dict]:
    return [dict(zip(_WAY, way, strict=True)) for way in ways]


def _pieces(rows: DataFrame, most: int) -> DataFrame:
    """Whole conversations with their one way, and pieces, with a ``table``, of those too long or cut by a task's border."""

    def solved(stream: Iterator[dict]) -> Iterator[dict]:
        for run, number, complete in _runs(stream, most):
            stats = Stats.of(run[0]["turn"], run[0]["role"], run[0]["fault"])
            for row in run[1:]:
                stats.add(Stats.of(row["turn"], row["role"], row["fault"]))
            codes = "".join([row_code(r["role"][:1], r["fault"]) for r in run])
            ways = [(NONE, NONE, *whole(codes), 0)] if complete else table(codes)
            held = [{"turn": r["turn"], "role": r["role"], "key": r["key"]} for r in run]
            yield {
                "conv_id": run[0]["conv_id"], "place": run[0]["place"], "number": number, **vars(stats),
                "ways": _named(ways), "whole": complete, "held": held,
            }

    types = f"place long, number long, {_STATS_TYPES}, {_WAYS}, whole boolean, held array<struct<turn:long,role:string,key:binary>>"
    return materialized(_mapped(_ordered(rows), solved, types), "pieces")


def _joined_level(level: DataFrame) -> DataFrame:
    """Pieces of a conversation with equal ``task`` and ``number`` as one, with their places as ``children``."""

    def merged(stream: Iterator[dict]) -> Iterator[dict]:
        for (task, number, _), run in groupby(stream, key=lambda row: (row["task"], row["number"], row["conv_id"])):
            run = list(run)
            stats = Stats(**{c: run[0][c] for c in _STATS})
            for row in run[1:]:
                stats.add(Stats(**{c: row[c] for c in _STATS}))
            tables = [{(w["entry"], w["end"]): (w["cost"], w["rank"]) for w in row["ways"]} for row in run]
            yield {
                "conv_id": run[0]["conv_id"], "task": task, "number": number, "place": run[0]["place"], **vars(stats),
                "ways": _named(joined(tables)), "children": [row["place"] for row in run],
            }

    keys = ["conv_id", "task", "number"]
    dealt = level.repartition(*keys).sortWithinPartitions(*keys, "place")
    return materialized(_mapped(dealt, merged, f"task long, number long, place long, {_STATS_TYPES}, {_WAYS}, children array<long>"), "joined")


def _chosen_pieces(pieces: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """Of the pieces that are not whole conversations: ``place, entry, end, tail`` of each, and totals per conversation.

    Pieces are joined level by level, at most ``fan`` to one, until each conversation has a single row; then the
    ends chosen there are handed down. ``tail`` completes the last piece.
    """
    bare = F.transform("ways", lambda w: F.struct(w["entry"], w["end"], w["cost"], F.lit("").alias("audit"), w["rank"]))
    # The task that saw a piece stands in the upper bits of its place.
    task = F.shiftright("place", 33).alias("task")
    level = pieces.where("not whole").select("conv_id", task, "number", "place", *_STATS, bare.alias("ways"))
    levels: list[DataFrame] = []
    while True:
        n, conversations, most = level.agg(F.count("*"), F.count_distinct(F.struct("conv_id")), F.max("number")).first()
        if n == conversations:
            break
        # First what one task saw becomes one piece, then that of neighbouring tasks.
        coarser = "number" if most else "task"
        level = _joined_level(level.withColumn(coarser, F.floor(F.col(coarser) / fan).cast("long")))
        levels.append(level)

    def decided(stream: Iterator[dict]) -> Iterator[dict]:
        for row in stream:
            cost, end = closed([tuple(w[c] for c in _WAY) for w in row["ways"]])
            yield {**{c: row[c] for c in ("conv_id", "place", *_STATS)}, "entry": NONE, "end": end, "cost": cost, "tail": _CLOSING[end][1]}

    roots = materialized(_mapped(level, decided, f"place long, {_STATS_TYPES}, entry int, end int, cost long, tail string"), "roots")
    chosen = roots.select("place", "entry", "end", "tail")
    for above in reversed(levels):
        path = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (w["end"] == F.col("end")))[0]["audit"]
        opened = above.join(chosen, "place").select("entry", "tail", "children", path.alias("path"))
        opened = opened.select("entry", "tail", "path", F.size("children").alias("n"), F.posexplode("children").alias("at", "place"))
        before = F.col("path").substr(F.col("at"), F.lit(1)).cast("int")
        chosen = opened.select(
            "place",
            F.when(F.col("at") == 0, F.col("entry")).otherwise(before).alias("entry"),
            F.col("path").substr(F.col("at") + 1, F.lit(1)).cast("int").alias("end"),
            F.when(F.col("at") == F.col("n") - 1, F.col("tail")).otherwise("").alias("tail"),
        )
    return chosen, roots


@dataclass(frozen=True)
class Repaired:
    """``edits``: ``conv_id, place, step, letter, turn, role, key`` of every edit, in the order of place and step;
    ``rows``: ``conv_id, place, step, role, text`` of the turns that are left; ``summary``: one row per conversation
    with ``gaps, blank, duplicate, truncated, illegal, cost, audit``."""

    edits: DataFrame
    rows: DataFrame
    summary: DataFrame


def repair(rows: DataFrame, *, most: int = 1024, fan: int = 256) -> Repaired:
    """The cheapest edits that give each conversation's roles the initials ``(s?(ua)+)?``.

    ``rows`` have ``conv_id, turn, role, text`` and, optionally, ``copies``. A row is kept for nothing, given the
    role user or assistant for REROLE, or deleted for DELETE, which blank and duplicate rows must be;
    an empty turn is inserted for INSERT; a truncated row that stays costs CUT_SHORT more. Of
    equally cheap audits, the edits' initials in order, the least by code point is taken. A row's first fault counts: blank, then
    duplicate (role and text seen earlier in the conversation), then truncated.

    Conversations are read in sorted ranges, so one of any length spans many tasks. Whole ones are solved by one
    bidirectional search. Those longer than ``most`` rows, or cut by a task's border, are solved in pieces from
    every state to every state, and the pieces joined, ``fan`` at a time: the result is the same.

    Rows are taken by turn, nulls first, then by role and by the SHA-256 of the text. Null roles and texts
    count as one space, which is blank and starts no legal pair. Rows without a conversation are one conversation. Repeated
    rows are duplicates. Empty and very long texts are like any other, and other columns are ignored. An
    empty table gives no rows. Audit and repaired rows of a conversation are as long as it is.
    """
    small_batches(rows.sparkSession, 2000)
    space = F.lit(" ")
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), copies.alias("copies"))
    pieces = _pieces(rows, most)
    chosen, roots = _chosen_pieces(pieces, fan)
    kept = pieces.select("conv_id", "place", "held", "ways", "whole")
    of_entry = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (w["end"] == F.col("end")))[0]["audit"]
    cut = kept.where("not whole").join(chosen, "place").select("conv_id", "place", "held", "entry", F.concat(of_entry, F.col("tail")).alias("audit"))
    first_way = F.col("ways")[0]
    solved = kept.where("whole").select("conv_id", "place", "held", F.lit(NONE).alias("entry"), first_way["audit"].alias("audit")).unionByName(cut)

    def spelled(stream: Iterator[dict]) -> Iterator[dict]:
        for piece in stream:
            held = piece["held"]
            codes = "".join([row_code(r["role"][:1], None) for r in held])
            for step, (row, letter, _, after) in enumerate(walk(codes, piece["entry"], piece["audit"])):
                out = {"conv_id": piece["conv_id"], "place": piece["place"], "step": step, "letter": letter, "turn": None, "role": None, "key": None}
                if letter != "I":
                    out |= held[row]
                if letter in "RI":
                    out["role"] = ROLES[after == ASSISTANT]
                yield out

    edits = materialized(_mapped(solved, spelled, "place long, step long, letter string, turn long, role string, key binary"), "edits")
    texts = rows.select(_key(_digest()).alias("key"), "text").dropDuplicates(["key"])
    taken = edits.where(F.col("letter").isin("K", "R")).join(texts, "key").select("conv_id", "place", "step", "role", "text")
    inserted = edits.where(F.col("letter") == "I").select("conv_id", "place", "step", "role", F.lit("").alias("text"))

    gaps = F.coalesce(F.col("turn_last") - F.col("turn_first") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    counts = [gaps, "blank", "duplicate", "truncated", "illegal"]
    audits = cut.groupBy(F.struct("conv_id").alias("of")).agg(F.sort_array(F.collect_list(F.struct("place", "audit"))).alias("parts"))
    audits = audits.select("of", F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    long_ones = roots.withColumn("of", F.struct("conv_id")).join(audits, "of").select("conv_id", *counts, "cost", "audit")
    short_ones = pieces.where("whole").select("conv_id", *counts, first_way["cost"].alias("cost"), first_way["audit"].alias("audit"))
    return Repaired(edits, taken.unionByName(inserted), short_ones.unionByName(long_ones))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``: of ``role:text`` lines in order, joined by newlines.

    SHA-256 reads a conversation from front to back, so each goes to one task; it streams through, however long.
    """

    def hashed(stream: Iterator[dict]) -> Iterator[dict]:
        for conv_id, lines in groupby(stream, key=lambda row: row["conv_id"]):
            digest = hashlib.sha256()
            for i, line in enumerate(lines):
                digest.update(f"{chr(10) if i else ''}{line['role']}:{line['text']}".encode("utf-8", "surrogatepass"))
            yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}

    dealt = rows.repartition(width(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "place", "step")
    return _mapped(dealt, hashed, "repaired_sha256 string")


def summarised(conversations: DataFrame, repaired: Repaired) -> DataFrame:
    """Summary and digest of every ``conv_id`` of ``conversations``, also of those without any row left to repair."""
    of = F.struct("conv_id").alias("of")
    every = conversations.select(of).distinct()
    found = repaired.summary.select(of, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    hashes = digests(repaired.rows).select(of, "repaired_sha256")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        every.join(found, "of", "left").join(hashes, "of", "left")
        .select(
            "of.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
