import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv, turn, role, text in rows:
        show = [" " if v is None else str(v) for v in (conv, turn)]
        hit = zlib.crc32(":".join(show).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if hit == 0:
            continue
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(hit, text)
        yield from [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)


def cheapest(rows):
    """(cost, audit, repaired rows) by a table over all rows and states, whole edit strings compared."""
    reads = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def put(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                put(table, role[0], (cost + 5, audit + "I", [*out, f"{role}:"]))
        return table

    table = inserted({"": (0, "", [])})
    for role, text, gone, cut in rows:
        after = {}
        for state, (cost, audit, out) in table.items():
            put(after, state, (cost + 2, audit + "D", out))
            if gone:
                continue
            if role[:1] in reads[state]:
                put(after, role[0], (cost + 5 * cut, audit + "K", [*out, f"{role}:{text}"]))
            other = "assistant" if state == "u" else "user"
            put(after, other[0], (cost + 1 + 5 * cut, audit + "R", [*out, f"{other}:{text}"]))
        table = inserted(after)
    return min((table[s] for s in ("", "a") if s in table), key=lambda v: v[:2])


def brute(rows):
    out = {conv: None for conv, *_ in rows}
    found = list(damage(rows))
    for conv in out:
        mine = [r for r in found if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()))
        seen, marked, blank, duplicate, truncated = set(), [], 0, 0, 0
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            is_blank, is_seen = not bare, (role, text) in seen
            cut = bool(bare) and not is_seen and bare[-1] not in ".!?"
            blank, duplicate, truncated = blank + is_blank, duplicate + (is_seen and not is_blank), truncated + cut
            seen.add((role, text))
            marked.append((role, text, is_blank or is_seen, cut))
        turns = [t for _, t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        cost, audit, repaired = cheapest(marked)
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return sorted(((conv, *v) for conv, v in out.items()), key=str)


def conversations(seed, many, longest=9, odd=True):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None] if odd else ["user", "assistant", "system"]
    texts = ["Yes.", "No!", "Why?", "and then", "Well. ", "...", "x", " \t", "", None, "é. ¿"] if odd else [f"Text {i}." for i in range(9)]
    rows = []
    for conv in range(many):
        turn = 0
        for _ in range(rng.randrange(1, longest)):
            turn += rng.choice((1, 1, 1, 1, 2, 0))
            rows.append((conv, None if odd and rng.random() < 0.05 else turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.fixture
def run(spark, tmp_path):
    def go(rows, extra=(), name="t"):
        df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in extra})
        df.write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        out = cr.op12_conversation_repair(spark, f"{tmp_path}/{name}")
        assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        return sorted((tuple(r) for r in out.collect()), key=str)

    return go


def test_block_lookup_and_tracing_against_a_table_of_strings():
    rng = random.Random(7)
    for n in [*range(12)] * 60 + [40, 90, 150]:
        symbols = [rng.choice((0, 2, 2, 4, 4, 1, 3, 5, 6, 7, 8)) for _ in range(n)]
        blocks = cr.blocks_of(symbols)
        path, cost = cr.tables().read(cr.START, blocks)
        end = cr.tables().vectors[path[-1]]
        audit, state = cr.traced(path, blocks, cr.alive_at_end(end), cr.START)
        audit += cr.last_insertions(path[-1], state)
        rows = [("sua?"[s // 2] if s < 8 else "x", "", s == 8, s % 2) for s in symbols]
        assert (cost + min(end[0], end[3]), audit) == cheapest(rows)[:2]


def test_tables_are_whole():
    t = cr.tables()
    assert len(t.after) == len(t.vectors) and all(len(row) == cr.SYMBOLS**cr.BLOCK for row in t.after)
    assert all(max(c for c in v if c < cr.NEVER) <= cr.FAR for v in t.vectors)


def test_against_brute_force(run):
    rows = conversations(1, 120)
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (2**53 + 1, 2**40, "user", "A."), (2**63 - 1, -5, "user", "B.")]
    assert run(rows, extra=("audit", "slice", "copies", "hit", "unknown")) == brute(rows)


def test_repeated_rows_empty_table_and_dropped_conversations(run):
    rows = conversations(3, 20)
    assert run(rows * 2, name="twice") == brute(rows * 2)
    assert run([], name="none") == []
    dropped = next(c for c in range(500, 900) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    [found] = run([(dropped, 1, "user", "Hi.")], name="gone")
    assert found == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_conversation_holds_most_rows(run):
    rows = conversations(4, 30) + [(1000, t, ("user", "assistant")[t % 2], f"Turn {t % 700}.") for t in range(2000)]
    assert run(rows) == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_conversations_over_many_pieces(spark, size):
    rows = conversations(size, 40, longest=30) + [(777, 1, "user", "same.")] * 50
    df = cr.damaged(spark.createDataFrame(rows, SCHEMA).repartition(5))
    out = cr.repair(df, piece_rows=size).collect()
    assert sorted((tuple(r)[:-1] for r in out), key=str) == brute(rows)
    for r in out:
        assert hashlib.sha256("\n".join(r["repaired"]).encode()).hexdigest() == r["repaired_sha256"]


def test_very_long_text(run):
    rows = [(1, 2, "user", "long " * 400_000 + "."), (1, 3, "assistant", "Yes."), (1, 4, "user", "x")]
    assert run(rows) == brute(rows)


def test_sql_agrees(run, tmp_path):
    rows = conversations(5, 60) + [(None, None, None, None), (5, None, "user", "")]
    got = run(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/t/conversations.parquet/*.parquet'")
    assert sorted(con.execute(cr.ORACLE).fetchall(), key=str) == got
