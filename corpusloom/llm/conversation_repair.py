"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

A legal conversation is empty, or an optional system row and then pairs of a user and an assistant row. Reading it takes
four states: nothing yet, after a system row, after a user row, after an assistant row. Every row is kept, given another
role or deleted, and rows without text are inserted where a role is missing.

The edits are found by Hirschberg's divide and conquer. A vector of four costs runs forward from the start to the middle
of a conversation, one runs backward from its end; where their sum is least, a cheapest path crosses the middle. Next to
each forward cost stands the rank of the state by the letters of its best path, so of several optimal crossings the one
with the least letters is known without holding any path. Both halves are then solved alone. Only vectors and the states
at the crossings are held.

Conversations are dealt out by ranges of (conversation, turn), so a conversation of any length lies in consecutive
pieces. A piece acts like one large row: four costs for each of the four states before it. The crossings between the
pieces of a long conversation are found on these, and each piece is then solved on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.storage import settle

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
READS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FILLS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the one role of ROLES that may come next
ENDS = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # rows to insert behind the last one
LEGAL_PAIRS = {"su", "ua", "au"}
NEVER = 1 << 40
PLACE_BITS = 33  # as in monotonically_increasing_id: the partition above, the row below
SPACE, STOPS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
PREFIX = 64
ROWS_AT_ONCE, CHARS_AT_ONCE = 10_000, 4_000_000


@dataclass(frozen=True)
class Transfer:
    """What a row, or a piece of a conversation, costs from each state to each, and the order of its paths by letters."""

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]  # among the paths from the same state


@lru_cache(maxsize=None)
def row_paths(initial: str, fault: str | None) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest letters of one row, with the rows inserted before it, from state to state. Equal costs: least letters."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for before in STATES:
        state, inserted = before, 0
        for _ in range(3):
            moves = [(state, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = TRUNCATED * (fault == CUT)
                if state in READS.get(initial, {}):
                    moves.append((READS[initial][state], extra, "K"))
                moves.append((FILLS[state], REROLE + extra, "R"))
            for after, cost, letter in moves:
                path = (INSERT * inserted + cost, "I" * inserted + letter)
                found[before, after] = min(found.get((before, after), path), path)
            state, inserted = FILLS[state], inserted + 1
    return found


@lru_cache(maxsize=None)
def row_transfer(initial: str, fault: str | None) -> Transfer:
    paths, cost, rank = row_paths(initial, fault), [], []
    for a in STATES:
        order = sorted((paths[a, b][1], b) for b in STATES if (a, b) in paths)
        place = {b: i for i, (_, b) in enumerate(order)}
        cost.append(tuple(paths[a, b][0] if (a, b) in paths else NEVER for b in STATES))
        rank.append(tuple(place.get(b, 0) for b in STATES))
    return Transfer(tuple(cost), tuple(rank))


def only(state: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    return tuple(0 if s == state else NEVER for s in STATES), (0, 0, 0, 0)


@lru_cache(maxsize=1 << 16)
def forward(costs: tuple[int, ...], ranks: tuple[int, ...], by: Transfer) -> tuple[tuple[int, ...], tuple[int, ...], int]:
    """One step of the forward vector: costs less their minimum, ranks, and that minimum.

    Best paths to two states differ before the shorter one ends, as both end with the same row. So the order of their
    beginnings decides unless they begin in the same state.
    """
    best = []
    for b in STATES:
        ways = [(costs[a] + by.cost[a][b], ranks[a], by.rank[a][b]) for a in STATES if costs[a] < NEVER and by.cost[a][b] < NEVER]
        best.append(min(ways, default=(NEVER, 0, 0)))
    reached = [b for b in STATES if best[b][0] < NEVER]
    place = {b: i for i, b in enumerate(sorted(reached, key=lambda b: best[b][1:]))}
    least = min((best[b][0] for b in reached), default=0)
    return tuple(best[b][0] - least if b in place else NEVER for b in STATES), tuple(place.get(b, 0) for b in STATES), least


@lru_cache(maxsize=1 << 16)
def backward(costs: tuple[int, ...], by: Transfer) -> tuple[int, ...]:
    """One step of the backward vector, costs less their minimum."""
    best = [min(min(by.cost[a][b] + costs[b] for b in STATES), NEVER) for a in STATES]
    least = min(best)
    return tuple(c - least if c < NEVER else NEVER for c in best)


def run_forward(transfers: list[Transfer], lo: int, hi: int, start: int) -> tuple[tuple[int, ...], tuple[int, ...], int]:
    (costs, ranks), total = only(start), 0
    for i in range(lo, hi):
        costs, ranks, least = forward(costs, ranks, transfers[i])
        total += least
    return costs, ranks, total


def piece_transfer(transfers: list[Transfer]) -> Transfer:
    """Many rows as one."""
    cost, rank = [], []
    for start in STATES:
        costs, ranks, total = run_forward(transfers, 0, len(transfers), start)
        cost.append(tuple(c + total if c < NEVER else NEVER for c in costs))
        rank.append(ranks)
    return Transfer(tuple(cost), tuple(rank))


def last_state(transfers: list[Transfer], start: int = START) -> int:
    """Where the audit-least of the cheapest paths ends, what has to be inserted behind it included."""
    costs, ranks, _ = run_forward(transfers, 0, len(transfers), start)
    return min((s for s in STATES if costs[s] < NEVER), key=lambda s: (costs[s] + INSERT * ENDS[s], ranks[s]))


def crossings(transfers: list[Transfer], start: int, end: int) -> list[int]:
    """The states before the first, between all, and after the last of `transfers` on the audit-least cheapest path."""
    states = [start] + [end] * len(transfers)
    todo = [(0, len(transfers))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        costs, ranks, _ = run_forward(transfers, lo, mid, states[lo])
        rest = tuple(0 if s == states[hi] else NEVER for s in STATES)
        for i in range(hi - 1, mid - 1, -1):
            rest = backward(rest, transfers[i])
        states[mid] = min((s for s in STATES if costs[s] < NEVER and rest[s] < NEVER), key=lambda s: (costs[s] + rest[s], ranks[s]))
        todo += [(lo, mid), (mid, hi)]
    return states


def fault_of(role: str, text: str, again: bool) -> str | None:
    """The first fault of a row."""
    seen = text.rstrip(SPACE)
    return BLANK if not seen else DUPLICATE if again else CUT if seen[-1] not in STOPS else None


def edits_of(roles: list[str], faults: list[str | None], start: int, end: int, last: bool) -> Iterator[tuple[int | None, str, str | None, int]]:
    """(row or None, letter, new role, cost) of each edit in order. `last`: what is missing at the very end follows."""
    states = crossings([row_transfer(r[:1], f) for r, f in zip(roles, faults, strict=True)], start, end)
    for i, (role, fault) in enumerate(zip(roles, faults, strict=True)):
        state = states[i]
        _, letters = row_paths(role[:1], fault)[state, states[i + 1]]
        for _ in letters[:-1]:
            state = FILLS[state]
            yield None, "I", ROLES[state], INSERT
        extra = TRUNCATED * (fault == CUT)
        if letters[-1] == "D":
            yield i, "D", None, DELETE
        elif letters[-1] == "K":
            yield i, "K", role, extra
        else:
            yield i, "R", ROLES[FILLS[state]], REROLE + extra
    if last:
        state = end
        for _ in range(ENDS[end]):
            state = FILLS[state]
            yield None, "I", ROLES[state], INSERT


def runs(rows: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Consecutive rows that agree in the first `keys` columns, as lists of columns, across the batches."""
    held: list[list] | None = None
    for batch in rows:
        columns = [c.to_pylist() for c in batch.columns]
        names = list(zip(*columns[:keys], strict=True))
        at = 0
        for i in range(1, len(names) + 1):
            if i < len(names) and names[i] == names[at]:
                continue
            piece = [c[at:i] for c in columns]
            if held and tuple(c[0] for c in held[:keys]) == names[at]:
                for c, more in zip(held, piece, strict=True):
                    c.extend(more)
            else:
                if held:
                    yield held
                held = piece
            at = i
    if held:
        yield held


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[text] or "") if text is not None else 0
        if len(held) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn over range partitions. Rows that are equal in all columns may be told apart
    by where they were, so that any number of them spreads too."""
    keyed = rows.withColumns({"head": F.left("text", F.lit(PREFIX)), "digest": F.md5("text"), "salt": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "head", "digest", "salt"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(placed.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("place")))


def _split(ordered: DataFrame) -> DataFrame:
    """Conversations that lie in more than one partition: fewer than there are partitions."""
    part = F.shiftright("place", PLACE_BITS).alias("part")
    ends = ordered.groupBy(part).agg(F.min(F.struct("conv")).alias("a"), F.max(F.struct("conv")).alias("b"))
    parts = ends.select("part", F.explode(F.array("a", "b")).alias("end")).distinct()
    return parts.groupBy("end").agg(F.count("*").alias("n")).where("n > 1").select(F.col("end.conv").alias("split_conv"))


def _pieces(long: DataFrame) -> DataFrame:
    """Rows of split conversations with their partition, and whether role and text came earlier."""
    part = F.shiftright("place", PLACE_BITS).alias("part")
    first = long.groupBy("conv", "role", F.sha2("text", 256).alias("digest")).agg(F.min("place").alias("first"))
    marked = long.join(first.select("first"), long["place"] == F.col("first"), "left")
    again = F.col("first").isNull().alias("again")
    return settle(marked.select("conv", part, "turn", "role", "text", "place", again).repartition("part").sortWithinPartitions("place"))


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> list[DataFrame]:
    """Every edit of every conversation: its place in order, letter, cost, the row's old role, fault and turn, the new role and text.

    Rows come by turn, nulls first; on equal turns by role, by the first 64 characters of the text and by its md5. A null
    role or text counts as one space, a null conversation is one of its own. A row's first fault counts: blank, duplicate (role
    and text came earlier in the conversation), truncated (does not end with one of `.!?`). Keep (K) costs 0, Rerole (R) 3,
    Delete (D) 4, Insert (I) 3, and a truncated row that stays 3 more; blank and duplicate rows must go. The first letter of a
    role says what it is; a role that starts with none of s, u and a can't be kept, nor can an empty one. Of equally cheap edits
    the ones with the least letters are taken. Further columns are left out.

    The result is two tables, whole conversations and those that the ranges split; in each partition of the first, and of the
    second once sorted, the edits of a conversation follow each other. `report` sums both up.
    """
    plain = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text")
    )
    ordered = _ordered(plain)
    split = settle(_split(ordered))
    on = ordered["conv"].eqNullSafe(split["split_conv"])
    fields = [ordered.schema["conv"], T.StructField("place", T.LongType()), T.StructField("sub", T.IntegerType()), ordered.schema["turn"]]
    rest = T._parse_datatype_string("old_role string, fault string, letter string, cost int, role string, text string").fields
    schema = T.StructType([*fields, *rest])
    # one row of `split` stands for a partition at least, so its size is bounded by their number
    whole = ordered.join(F.broadcast(split), on, "left_anti").mapInArrow(_solve_whole(schema), schema)
    if split.isEmpty():
        return [whole]
    pieces = _pieces(ordered.join(F.broadcast(split), on, "left_semi"))
    summed = T.StructType([ordered.schema["conv"], *T._parse_datatype_string("part long, cost array<long>, rank array<long>").fields])
    met = T.StructType([ordered.schema["conv"], *T._parse_datatype_string("part long, enter int, leave int, last boolean").fields])
    states = pieces.select("conv", "part", "role", "text", "again").mapInArrow(_sum_pieces, summed).groupBy("conv").applyInPandas(_meet, met)
    states = states.withColumnsRenamed({"conv": "met_conv", "part": "met_part"})
    same = pieces["conv"].eqNullSafe(states["met_conv"]) & (pieces["part"] == states["met_part"])
    placed = pieces.join(F.broadcast(states), same)  # a row per partition that a split conversation touches
    solved = placed.select("conv", "part", "turn", "role", "text", "place", "again", "enter", "leave", "last")
    return [whole, solved.mapInArrow(_solve_pieces(schema), schema)]


def _rows_of(columns: list[list], faults: list[str | None], start: int, end: int, last: bool) -> Iterator[tuple]:
    conv, turn, role, text, place = columns
    at, sub = place[0], 0
    for i, letter, new, cost in edits_of(role, faults, start, end, last):
        if i is None:
            yield conv[0], at, sub, None, None, None, letter, cost, new, ""
            sub += 1
        else:
            gone = letter == "D"
            yield conv[0], at, sub, turn[i], role[i], faults[i], letter, cost, new, None if gone else text[i]
            at, sub = place[min(i + 1, len(place) - 1)], sub + 1 if i + 1 == len(place) else 0


def _solve_whole(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    def solved(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for columns in runs(rows, 1):
            _, _, role, text, _ = columns
            seen: set[tuple[str, str]] = set()
            faults = []
            for key in zip(role, text, strict=True):
                faults.append(fault_of(*key, key in seen))
                seen.add(key)
            end = last_state([row_transfer(r[:1], f) for r, f in zip(role, faults, strict=True)])
            yield from _rows_of(columns, faults, START, end, True)

    arrow = to_arrow_schema(schema)
    return lambda rows: _batches(solved(rows), arrow, text=9)


def _piece_faults(role: list[str], text: list[str], again: list[bool]) -> list[str | None]:
    return [fault_of(r, t, a) for r, t, a in zip(role, text, again, strict=True)]


def _sum_pieces(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, part, role, text, again in runs(rows, 2):
        faults = _piece_faults(role, text, again)
        total = piece_transfer([row_transfer(r[:1], f) for r, f in zip(role, faults, strict=True)])
        flat = [[[x for line in table for x in line]] for table in (total.cost, total.rank)]
        yield pa.RecordBatch.from_arrays([pa.array(conv[:1]), pa.array(part[:1], pa.int64()), *(pa.array(f, pa.list_(pa.int64())) for f in flat)], ["conv", "part", "cost", "rank"])


def _meet(pieces: pd.DataFrame) -> pd.DataFrame:
    """The crossings between the pieces of one conversation, a row per partition it touches."""
    pieces = pieces.sort_values("part")
    square = lambda flat: tuple(tuple(int(x) for x in flat[4 * a : 4 * a + 4]) for a in STATES)
    transfers = [Transfer(square(c), square(r)) for c, r in zip(pieces["cost"], pieces["rank"], strict=True)]
    states = crossings(transfers, START, last_state(transfers))
    last = [False] * (len(transfers) - 1) + [True]
    return pd.DataFrame({"conv": pieces["conv"], "part": pieces["part"], "enter": states[:-1], "leave": states[1:], "last": last})


def _solve_pieces(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    def solved(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, _, turn, role, text, place, again, enter, leave, last in runs(rows, 2):
            yield from _rows_of([conv, turn, role, text, place], _piece_faults(role, text, again), enter[0], leave[0], last[0])

    arrow = to_arrow_schema(schema)
    return lambda rows: _batches(solved(rows), arrow, text=9)


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class _Report:
    """Sums of one conversation, edit by edit; the letters are all that grows with it."""

    def __init__(self):
        self.faults = {BLANK: 0, DUPLICATE: 0, CUT: 0}
        self.turns: list = []  # lowest, latest
        self.distinct = self.illegal = self.cost = 0
        self.before: str | None = None
        self.letters: list[str] = []
        self.hash, self.any = hashlib.sha256(), False

    def add(self, turn, old_role, fault, letter, cost, role, text) -> None:
        self.letters.append(letter)
        self.cost += cost
        if letter != "I":
            if fault:
                self.faults[fault] += 1
            if self.before is not None and self.before + old_role[:1] not in LEGAL_PAIRS:
                self.illegal += 1
            self.before = old_role[:1]
            if turn is not None and (not self.turns or turn != self.turns[1]):
                self.turns = [self.turns[0] if self.turns else turn, turn]
                self.distinct += 1
        if letter != "D":
            self.hash.update(f"{chr(10) * self.any}{role}:{text}".encode())
            self.any = True

    def row(self, conv) -> tuple:
        gaps = int(self.turns[1] - self.turns[0]) + 1 - self.distinct if self.turns else 0
        return conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest()


def report(edits: list[DataFrame]) -> DataFrame:
    """Per conversation with rows: gaps in its turns, faults, illegal neighbours, cost, letters of the edits and sha256 of the repaired
    lines `role:text`. Whole conversations are summed up where they are; the edits of split ones meet in order in one task,
    which holds one batch and the letters, as a sha256 can only be taken in order.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([edits[0].schema["conv"], *T._parse_datatype_string(REPORT).fields])
    arrow = to_arrow_schema(schema)
    names = ["conv", "turn", "old_role", "fault", "letter", "cost", "role", "text"]

    def summed(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, now = None, None
        for batch in rows:
            for key, *edit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and key != conv:
                    yield now.row(conv)
                    now = None
                if now is None:
                    conv, now = key, _Report()
                now.add(*edit)
        if now is not None:
            yield now.row(conv)

    run = lambda rows: _batches(summed(rows), arrow)
    order = [["conv", "place", "sub"]] * (len(edits) - 1)
    sorted_ = [edits[0], *(e.repartition("conv").sortWithinPartitions(*by) for e, by in zip(edits[1:], order, strict=True))]
    done = [e.select(*names).mapInArrow(run, schema) for e in sorted_]
    return done[0] if len(done) == 1 else done[0].unionByName(done[1])


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Known faults at places that a checksum of conversation and turn picks; a null counts as one space, but a null turn stays."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.pmod(F.crc32(key), F.lit(20))
    plain = rows.select(conv, turn, F.coalesce(role, space).alias(role), F.coalesce(text, space).alias(text), kind.alias("kind")).where("kind <> 0")
    bare = F.regexp_replace(text, "[.!?]", "")
    hurt = plain.withColumn(text, F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, bare).otherwise(F.col(text)))
    hurt = hurt.withColumn(role, F.when(F.col("kind") == 4, "user").otherwise(F.col(role)))
    times = F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return hurt.select(conv, turn, role, text, F.explode(times).alias("kind")).drop("kind")


def damage_report(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The report of every conversation of `rows` after `damage`; zeros and the empty text for one without rows."""
    found = report(repair_conversations(damage(rows, conv), conv))
    every = rows.select(F.col(conv).alias("_every")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    blanks = {f.name: F.coalesce(f.name, F.lit(0 if f.dataType == T.LongType() else empty if f.name == "repaired_sha256" else "")).alias(f.name) for f in found.schema.fields[1:]}
    return every.join(found, every["_every"].eqNullSafe(found["conv"]), "left").select(F.col("_every").alias(conv), *blanks.values())


# All paths of every conversation, row by row; the checksum is computed bit by bit, as the engine has none.
ORACLE_SQL = r"""WITH RECURSIVE
octets AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
summed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: unicode(c)::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind FROM keyed, octets),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS n FROM summed WHERE kind <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS clash FROM placed),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM seen),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (clash) AS illegal, count(*) AS n FROM faulty GROUP BY conv_id),
fills(state, met, n, lines) AS (VALUES (0, 0, 0, ''), (0, 2, 1, chr(10) || 'user:'), (0, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, 0, ''), (1, 2, 1, chr(10) || 'user:'), (1, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, ''), (2, 3, 1, chr(10) || 'assistant:'), (3, 3, 0, ''), (3, 2, 1, chr(10) || 'user:')),
steps(met, initial, goes) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
moves AS (SELECT f.conv_id, f.i, s.state, s.n, s.lines || coalesce(chr(10) || m.role || ':' || f.text, '') AS lines, m.letter, m.cost, m.goes
  FROM faulty f, fills s, LATERAL (SELECT 'D' AS letter, 4 AS cost, NULL AS role, s.met AS goes
    UNION ALL SELECT 'K', 0, f.role, t.goes FROM steps t WHERE t.met = s.met AND t.initial = left(f.role, 1) AND f.fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT 'R', 3, CASE t.initial WHEN 'u' THEN 'user' ELSE 'assistant' END, t.goes FROM steps t
      WHERE t.met = s.met AND t.initial <> 's' AND f.fault NOT IN ('blank', 'duplicate')) m),
priced AS (SELECT m.conv_id, m.i, m.state, m.goes, 3 * m.n + m.cost + CASE WHEN f.fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END AS cost,
  repeat('I', m.n) || letter AS letters, m.lines FROM moves m JOIN faulty f ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.i = f.i),
paths AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'letters': '', 'lines': ''} AS best FROM facts
  UNION ALL SELECT p.conv_id, p.i + 1, x.goes, min({'cost': p.best.cost + x.cost, 'letters': p.best.letters || x.letters, 'lines': p.best.lines || x.lines})
  FROM paths p JOIN priced x ON p.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = p.i + 1 AND x.state = p.state GROUP BY p.conv_id, p.i, x.goes),
closed AS (SELECT p.conv_id, min({'cost': p.best.cost + 3 * z.n, 'letters': p.best.letters || repeat('I', z.n), 'lines': p.best.lines || z.lines}) AS best
  FROM paths p JOIN facts f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.n JOIN (SELECT * FROM fills WHERE met = 3 OR (state = 0 AND met = 0)) z
  ON p.state = z.state AND (p.state <> 0 OR z.met = 0) GROUP BY p.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.letters, '') AS audit,
  sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN facts f ON e.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN closed c ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""
