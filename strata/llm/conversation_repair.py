"""Conversation structure repair: the cheapest edits, by Four-Russians block tables.

A conversation is in order when its role initials read ``(s?(ua)+)?``. The rows
of a conversation are symbols (role initial, fault); an automaton of four states
reads them, and the cost vector says how cheaply each state can be reached. Two
facts make tables of it: costs that differ by more than ``FAR`` from the least
can't matter, and what matters is the differences only. So there are few
normalised vectors, and for every vector and every block of ``BLOCK`` symbols
the vector behind the block and the added cost are computed once; a
conversation is read a block at a time, by lookup. Then the blocks are expanded
from the last to the first, each into the steps that lie on a cheapest path, and
the steps are read forward, always the ASCII-least of them: from one state every
edit leads to one state, so this is the least of all cheapest edit strings.

Rows are sorted globally, by ranges, so a conversation of any length lies in
consecutive tasks. One that lies within a task is repaired there. Pieces of the
others (the first and the last of a task, or more than ``PIECE_ROWS`` rows) are
reduced to what each of the four states becomes behind them, a matrix; the
product of these tells each piece which of its ends are on a cheapest path.
Only the SHA-256 has to see a long conversation's rows in one stream; the task
that has it holds a piece at a time, and the edits.

Defined cases: a null role or text is one space, a null conv_id a conversation
of its own. Rows of one turn come in the order of the SHA-256 of role and text,
so the result doesn't depend on the order of the table. Roles that begin with
other letters than s, u and a can't be kept. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACES, read_table, written

BLOCK = 4
PIECE_ROWS = 50_000
PIECE_CHARS = 8_000_000
# The costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 2 * INSERT  # from any state, two insertions and the other state's edits do as well
NEVER = 1 << 20
# states: nothing yet, behind s, behind u, behind a
STATES, START, ENDS = range(4), 0, (0, 3)
READS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
INSERTED = (2, 2, 3, 2)  # the state behind an inserted row, and behind one whose role is changed
ROLES = ("user", "user", "assistant", "user")
INITIALS = "sua?"
GONE, PAD = 8, 9  # symbols: 2 * initial + truncated; a row that has to go; a place behind the last row
SYMBOLS = 10


@cache
def edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, ASCII-least first."""
    if symbol == GONE:
        return [("D", DELETE, state)]
    more = TRUNCATED * (symbol % 2)
    kept = READS.get((state, INITIALS[symbol // 2]))
    out = [("D", DELETE, state)]
    if kept is not None:
        out.append(("K", KEEP + more, kept))
    return [*out, ("R", REROLE + more, INSERTED[state])]


def _closed(costs: list[int]) -> list[int]:
    """With up to two insertions."""
    out = list(costs)
    for _ in range(2):
        for state in STATES:
            out[INSERTED[state]] = min(out[INSERTED[state]], out[state] + INSERT)
    return out


def _behind(costs: list[int] | tuple[int, ...], symbol: int) -> list[int]:
    if symbol == PAD:
        return list(costs)
    out = [NEVER] * len(STATES)
    for state in STATES:
        for _, cost, after in edits(state, symbol):
            out[after] = min(out[after], costs[state] + cost)
    return _closed(out)


def normalised(costs: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least if c - least <= FAR else NEVER for c in costs), least


class Tables:
    """The normalised vectors, and for each of them and each block the vector behind it and the added cost."""

    def __init__(self):
        units = [_closed([0 if s == state else NEVER for s in STATES]) for state in STATES]
        self.vectors = [normalised(u)[0] for u in units]
        self.number = {v: i for i, v in enumerate(self.vectors)}
        after, added = [], []
        for vector in self.vectors:  # grows while it is read
            for symbol in range(SYMBOLS):
                found, cost = normalised(_behind(vector, symbol))
                if found not in self.number:
                    self.number[found] = len(self.vectors)
                    self.vectors.append(found)
                after.append(self.number[found])
                added.append(cost)
        after, added = (np.array(x, dtype=np.int32).reshape(-1, SYMBOLS) for x in (after, added))
        one, one_added = after, added
        for _ in range(BLOCK - 1):  # a block and one symbol more
            added = (added[:, :, None] + one_added[after]).reshape(len(after), -1)
            after = one[after].reshape(len(after), -1)
        self.after, self.added = after.tolist(), added.tolist()

    def read(self, vector: int, blocks: list[int]) -> tuple[list[int], int]:
        """The vectors before each block and behind the last, and the added cost."""
        path, cost = [vector], 0
        for block in blocks:
            cost += self.added[vector][block]
            vector = self.after[vector][block]
            path.append(vector)
        return path, cost


@cache
def tables() -> Tables:
    return Tables()


def blocks_of(symbols: list[int]) -> list[int]:
    full = [*symbols, *[PAD] * (-len(symbols) % BLOCK)]
    return [int("".join(map(str, full[i : i + BLOCK]))) for i in range(0, len(full), BLOCK)]


def alive_at_end(costs: tuple[int, ...] | list[int]) -> int:
    """The states, as bits, from which a cheapest path ends, after insertions perhaps."""
    least = min(costs[s] for s in ENDS)
    return _with_insertions(costs, sum(1 << s for s in ENDS if costs[s] == least))


def _with_insertions(costs: tuple[int, ...] | list[int], alive: int) -> int:
    for _ in range(2):
        for state in STATES:
            after = INSERTED[state]
            if alive >> after & 1 and costs[state] < NEVER and costs[state] + INSERT == costs[after]:
                alive |= 1 << state
    return alive


@lru_cache(200_000)
def expanded(vector: int, block: int, alive: int) -> tuple[int, dict[int, tuple[str, int]]]:
    """The block's steps on a cheapest path that ends in ``alive``: its states at the start, and the edits and the end of each."""
    symbols = [int(s) for s in f"{block:0{BLOCK}d}" if int(s) != PAD]
    costs = [list(tables().vectors[vector])]
    for symbol in symbols:
        costs.append(_behind(costs[-1], symbol))
    best = {s: ("", s) for s in STATES if alive >> s & 1}
    for i in range(len(symbols) - 1, -1, -1):
        here, there, found = costs[i], costs[i + 1], {}
        for state in STATES:
            for letter, cost, after in edits(state, symbols[i]):  # the first that fits is ASCII-least
                if here[state] < NEVER and after in best and here[state] + cost == there[after]:
                    found[state] = (letter + best[after][0], best[after][1])
                    break
        for _ in range(2):
            for state in STATES:
                after = INSERTED[state]
                if after in found and here[state] < NEVER and here[state] + INSERT == here[after]:
                    inserted = ("I" + found[after][0], found[after][1])
                    if state not in found or found[state][0] > inserted[0]:
                        found[state] = inserted
        best = found
    return sum(1 << s for s in best), best


def traced(path: list[int], blocks: list[int], alive: int, state: int) -> tuple[str, int]:
    """The ASCII-least edits of a cheapest path that goes from ``state`` into ``alive``, and its last state."""
    steps = []
    for vector, block in zip(reversed(path[:-1]), reversed(blocks), strict=True):
        alive, step = expanded(vector, block, alive)
        steps.append(step)
    out = []
    for step in reversed(steps):
        piece, state = step[state]
        out.append(piece)
    return "".join(out), state


def last_insertions(vector: int, state: int) -> str:
    """The insertions behind the last row."""
    costs, out = tables().vectors[vector], ""
    while not (state in ENDS and costs[state] == min(costs[s] for s in ENDS)):
        state, out = INSERTED[state], out + "I"
    return out


class Piece:
    """Consecutive rows of a conversation, after damage: symbols and counts."""

    def __init__(self):
        self.turns, self.roles, self.texts, self.symbols = [], [], [], []
        self.blank = self.duplicate = self.truncated = 0

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        bare = text.strip(SPACES)
        if not bare:
            self.blank += 1
            symbol = GONE
        elif seen:
            self.duplicate += 1
            symbol = GONE
        else:
            cut = bare[-1] not in ".!?"
            self.truncated += cut
            symbol = 2 * ("sua".find(role[:1]) if role[:1] else -1) + cut
            symbol = 6 + cut if symbol < 0 else symbol
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.symbols.append(symbol)

    def illegal(self) -> int:
        first = [r[:1] for r in self.roles]
        return sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))

    def distinct_turns(self) -> int:
        known = [t for t in self.turns if t is not None]
        return sum(a != b for a, b in zip(known, known[1:], strict=False)) + bool(known)

    def ends(self) -> tuple[int | None, int | None]:
        known = [t for t in self.turns if t is not None]
        return (known[0], known[-1]) if known else (None, None)

    def matrix(self) -> list[int]:
        """Cost from each state at the start to each at the end."""
        blocks, out = blocks_of(self.symbols), []
        for state in STATES:
            path, cost = tables().read(state, blocks)
            out += [min(c + cost, NEVER) if c < NEVER else NEVER for c in tables().vectors[path[-1]]]
        return out

    def repaired(self, audit: str, state: int) -> Iterator[str]:
        """``role:text`` of the rows that the edits leave, from the state before them."""
        rows = iter(zip(self.roles, self.texts, strict=True))
        for letter in audit:
            role, text = (ROLES[state], "") if letter == "I" else next(rows)
            if letter == "D":
                continue
            state = READS[state, role[0]] if letter == "K" else INSERTED[state]
            yield f"{role if letter == 'K' else _role_of(state)}:{text}"


def _role_of(state: int) -> str:
    return "assistant" if state == 3 else "user"


def repair_one(piece: Piece) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and the repaired rows of a whole conversation."""
    blocks = blocks_of(piece.symbols)
    path, cost = tables().read(START, blocks)
    end = path[-1]
    audit, state = traced(path, blocks, alive_at_end(tables().vectors[end]), START)
    audit += last_insertions(end, state)
    cost += min(tables().vectors[end][s] for s in ENDS)
    first, last = piece.ends()
    gaps = 0 if first is None else last - first + 1 - piece.distinct_turns()
    rows = list(piece.repaired(audit, START))
    sha = hashlib.sha256("\n".join(rows).encode("utf-8", "surrogatepass")).hexdigest()
    return gaps, piece.blank, piece.duplicate, piece.truncated, piece.illegal(), cost, audit, sha, rows


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired array<string>"
OUT = [f.split()[0] for f in RESULT.split(", ")]
KEYS = ["unknown", "conv"]
AT = ["slice", "piece", "nth"]
CARRIED = ["turn", "role", "text", "row_key", "copies"]
ROW = "turn long, role string, text string, row_key string, copies int"
SCHEMA = f"unknown boolean, conv long, {RESULT}, slice long, piece long, nth long, {ROW}"
STRING, LONG = pa.string(), pa.int64()
RESULT_TYPES = [LONG] * 6 + [STRING, STRING, pa.list_(STRING)]
ROW_TYPES = [LONG, STRING, STRING, STRING, pa.int32()]


def _arrow(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _repair_within(rows_of_piece: int, keep_rows: bool):
    """Repairs the conversations that lie within a sorted partition, passes the rows of the others on."""
    names = [*KEYS, *OUT, *AT, *CARRIED]
    types = [pa.bool_(), LONG, *RESULT_TYPES, LONG, LONG, LONG, *ROW_TYPES]
    no_result, no_row = (None,) * len(OUT), (None,) * (len(AT) + len(CARRIED))

    def passed(key: tuple, at: tuple, rows: list[tuple]) -> list[tuple]:
        return [(*key, *no_result, *at, nth, *row) for nth, row in enumerate(rows)]

    def whole(key: tuple, rows: list[tuple]) -> tuple:
        piece, seen = Piece(), set()
        for turn, role, text, row_key, copies in rows:
            for _ in range(copies):
                piece.add(turn, role, text, row_key in seen)
                seen.add(row_key)
        *found, repaired = repair_one(piece)
        return (*key, *found, repaired if keep_rows else None, *no_row)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_id = TaskContext.get().partitionId()
        key, held, chars, piece, inner, out, size = None, [], 0, 0, False, [], 0
        for *own, turn, role, text, row_key, copies in _rows(batches):
            own = tuple(own)
            if own != key:
                if key is not None:
                    out += [whole(key, held)] if inner and not piece else passed(key, (slice_id, piece), held)
                    inner = True  # it began here
                key, held, chars, piece = own, [], 0, 0
            elif len(held) >= rows_of_piece or chars >= PIECE_CHARS:
                out += passed(key, (slice_id, piece), held)
                held, chars, piece = [], 0, piece + 1
            held.append((turn, role, text, row_key, copies))
            chars += len(text)
            size += len(text)
            if len(out) >= 5_000 or size >= PIECE_CHARS:
                yield _arrow(out, names, types)
                out, size = [], 0
        if key is not None:
            out += passed(key, (slice_id, piece), held)
        yield _arrow(out, names, types)

    return within


def _by_key(rows: Iterator[tuple], many: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same first columns."""
    key, held = None, []
    for row in rows:
        if row[:many] != key:
            if held:
                yield key, held
            key, held = row[:many], []
        held.append(row[many:])
    if held:
        yield key, held


def _piece_of(rows: list[tuple]) -> Piece:
    """From (turn, role, text, copies, seen) rows."""
    piece = Piece()
    for turn, role, text, copies, seen in rows:
        for nth in range(copies):
            piece.add(turn, role, text, seen or nth > 0)
    return piece


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = [*KEYS, *AT[:2], "matrix"], [pa.bool_(), LONG, LONG, LONG, pa.list_(LONG)]
    for key, rows in _by_key(_rows(batches), 4):
        yield _arrow([(*key, _piece_of([r[1:] for r in rows]).matrix())], names, types)


def _along(table: pa.Table) -> pa.Table:
    """A conversation's matrices multiplied up: for each piece, the ends of it that are on a cheapest path."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in [*KEYS, *AT[:2], "matrix"]), strict=True), key=lambda r: r[2:4])
    vectors = [tables().vectors[START]]
    for *_, matrix in rows:
        vectors.append(normalised([min(vectors[-1][s] + matrix[4 * s + t] for s in STATES) for t in STATES])[0])
    alive, out = alive_at_end(vectors[-1]), []
    for (*key, matrix), start in zip(reversed(rows), reversed(vectors[:-1]), strict=True):
        out.append((*key, alive, not out))
        behind = [min(start[s] + matrix[4 * s + t] for s in STATES) for t in STATES]
        alive = sum(1 << s for s in STATES if start[s] < NEVER and any(alive >> t & 1 and start[s] + matrix[4 * s + t] == behind[t] for t in STATES))
    return pa.Table.from_batches([_arrow(out, [*KEYS, *AT[:2], "alive", "last"], [pa.bool_(), LONG, LONG, LONG, LONG, pa.bool_()])])


def _streamed(keep_rows: bool):
    """Repairs conversations whose pieces come in order, a piece at a time."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = None
        for (*key, _, _, alive, last), rows in _by_key(_rows(batches), 6):
            if key != conv:
                conv, vector, cost, state, audit, sha, any_row = key, START, 0, START, [], hashlib.sha256(), False
                counts, role, turns, distinct, kept = [0] * 4, None, (None, None), 0, []
            piece = _piece_of([r[1:] for r in rows])
            blocks = blocks_of(piece.symbols)
            path, added = tables().read(vector, blocks)
            letters, after = traced(path, blocks, alive, state)
            vector, cost = path[-1], cost + added
            if last:
                letters += last_insertions(vector, after)
                cost += min(tables().vectors[vector][s] for s in ENDS)
            for line in piece.repaired(letters, state):
                sha.update((("\n" if any_row else "") + line).encode("utf-8", "surrogatepass"))
                any_row = True
                if keep_rows:
                    kept.append(line)
            audit.append(letters)
            state = after
            counts = [a + b for a, b in zip(counts, (piece.blank, piece.duplicate, piece.truncated, piece.illegal()), strict=True)]
            if piece.roles:
                counts[3] += role is not None and role + piece.roles[0][:1] not in ("su", "ua", "au")
                role = piece.roles[-1][:1]
            first, final = piece.ends()
            if first is not None:
                distinct += piece.distinct_turns() - (turns[1] == first)
                turns = (first if turns[0] is None else turns[0], final)
            if last:
                gaps = 0 if turns[0] is None else turns[1] - turns[0] + 1 - distinct
                found = (*key, gaps, *counts, cost, "".join(audit), sha.hexdigest(), kept if keep_rows else None)
                yield _arrow([found], [*KEYS, *OUT], [pa.bool_(), LONG, *RESULT_TYPES])

    return stream


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, keep_rows: bool = True) -> DataFrame:
    """conv_id, counts of faults, the cheapest edits and their cost, and the repaired rows, of every conversation.

    ``rows``: conv_id, turn, role, text, and copies, so many times each row is
    meant; a row with 0 copies only names its conversation.
    """
    none = F.lit(" ")
    role, text = F.coalesce("role", none), F.coalesce("text", none)
    row_key = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text), 256)
    known = rows.select(
        F.col("conv_id").isNull().alias("unknown"), F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), row_key.alias("row_key"), F.col("copies").cast("int").alias("copies"),
        (F.monotonically_increasing_id() % 1024).alias("spread"),
    )
    order = ["unknown", "conv", F.col("turn").asc_nulls_first(), "row_key"]
    # equal rows may lie in several tasks, their order is no matter
    placed = known.repartitionByRange(*order, "spread").sortWithinPartitions(*order).select(*KEYS, *CARRIED)
    found = written(placed.mapInArrow(_repair_within(piece_rows, keep_rows), SCHEMA), "conversations")

    whole = found.where("slice IS NULL").select(*KEYS, *OUT)
    parts = found.where("slice IS NOT NULL").select(*KEYS, *AT, *CARRIED)
    here = F.struct(*AT)
    firsts = written(parts.where("copies > 0").groupBy(*KEYS, "row_key").agg(F.min(here).alias("earliest")), "first_rows")
    marked = parts.join(firsts, [*KEYS, "row_key"], "left").select(*KEYS, *AT, "turn", "role", "text", "copies", F.coalesce(here > F.col("earliest"), F.lit(False)).alias("seen"))
    marked = written(marked, "pieces")
    at = [*KEYS, "slice", "piece"]
    matrices = marked.repartition(*at).sortWithinPartitions(*at, "nth").mapInArrow(_matrices, "unknown boolean, conv long, slice long, piece long, matrix array<long>")
    along = matrices.groupBy(*KEYS).applyInArrow(_along, "unknown boolean, conv long, slice long, piece long, alive long, last boolean")
    joined = marked.join(written(along, "piece_ends"), at).select(*at, "alive", "last", "nth", "turn", "role", "text", "copies", "seen")
    streamed = joined.repartition(*KEYS).sortWithinPartitions(*at, "nth").mapInArrow(_streamed(keep_rows), f"unknown boolean, conv long, {RESULT}")
    every = whole.unionByName(streamed)
    return every.select(F.when(~F.col("unknown"), F.col("conv")).alias("conv_id"), *OUT)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the registered query: a twentieth of the rows each dropped, emptied, unpunctuated, repeated or given to the user."""
    none = F.lit(" ")

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), none)

    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    role, text = shown("role"), shown("text")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), hit.alias("hit"))
    gone = F.col("hit") == 0
    return rows.select(
        "conv_id", "turn",
        F.when(gone, "").when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (F.col("hit") == 1), "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("hit") == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(read_table(spark, sf_dir, "conversations"))
    return repair(rows, keep_rows=False).drop("repaired")


def _sql() -> str:
    """The least (cost, edits) of each state, a row after the other."""

    def then(state: str, cost: str, letter: str, line: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {line}}}"

    def least(*found: str) -> str:
        return f"list_min(list_filter([{', '.join(found)}], lambda x: x IS NOT NULL))"

    def given(condition: str, found: str) -> str:
        return f"CASE WHEN {condition} THEN {found} END"

    def kept(state: str, initial: str) -> str:
        return given(f"NOT gone AND initial = '{initial}'", then(state, "k", "K", "own"))

    def changed(state: str, role: str) -> str:
        return given("NOT gone", then(state, "k + 1", "R", f"'{role}:' || text || chr(10)"))

    user, assistant = "'user:' || chr(10)", "'assistant:' || chr(10)"
    never = "{'c': 1048576, 'a': '', 'r': ''}"
    e = {
        "e0": then("s0", "2", "D"),
        "e1": least(then("s1", "2", "D"), kept("s0", "s")),
        "e2": least(then("s2", "2", "D"), *(f(s, w) for s in ("s0", "s1", "s3") for f, w in ((changed, "user"), (kept, "u")))),
        "e3": least(then("s3", "2", "D"), changed("s2", "assistant"), kept("s2", "a")),
    }
    return rf"""
WITH RECURSIVE bits AS (
  SELECT b, 0 AS n, b::BIGINT AS c FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, n + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE n < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE n = 8),
d AS MATERIALIZED (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS hit
  FROM conversations, crc),
h AS (
  SELECT conv, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d),
f AS (
  SELECT *, sha256(length(role) || ':' || role || ':' || text) AS row_key FROM h),
g AS MATERIALIZED (
  SELECT conv, turn, role, text, left(role, 1) AS initial, role || ':' || text || chr(10) AS own,
    row_number() OVER w AS nth, lag(left(role, 1)) OVER w AS before,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM f WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, row_key, copy)),
dp AS (
  SELECT DISTINCT conv, 0::BIGINT AS nth, {{'c': 0, 'a': '', 'r': ''}} AS s0, {never} AS s1,
    {{'c': 5, 'a': 'I', 'r': {user}}} AS s2, {{'c': 10, 'a': 'II', 'r': {user} || {assistant}}} AS s3 FROM d
  UNION ALL
  SELECT conv, nth, e0, e1, f2, {least("e3", then("f2", "5", "I", assistant))} FROM (
    SELECT *, {least("e2", *(then(s, "5", "I", user) for s in ("e0", "e1", "e3")))} AS f2 FROM (
      SELECT conv, nth, {", ".join(f"{v} AS {k}" for k, v in e.items())} FROM (
        SELECT dp.conv, g.nth, s0, s1, s2, s3, initial, text, own, blank OR seen AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS k
        FROM dp JOIN g ON g.conv = dp.conv AND g.nth = dp.nth + 1)))),
best AS (SELECT conv, arg_max(list_min([s0, s3]), nth) AS b FROM dp GROUP BY conv),
n AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(blank)::BIGINT AS blank,
    count_if(NOT blank AND seen)::BIGINT AS duplicate, count_if(NOT blank AND NOT seen AND cut)::BIGINT AS truncated,
    count_if(before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM g GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit,
  sha256(CASE WHEN b.r = '' THEN '' ELSE left(b.r, length(b.r) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM d) JOIN best USING (conv) LEFT JOIN n USING (conv)
"""


ORACLE = _sql()
