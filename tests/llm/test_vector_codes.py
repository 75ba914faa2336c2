import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain loops over Python's integers: {row: (code, error)}, label errors, hash."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(-(-max((len(r[1]) for r in kept), default=0) // parts), 1)
    whole = [[math.floor(256 * x) if abs(x) < 2**40 else 256 * int(x) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[near(c[p], p) for p in range(parts)] for c in cut]
        for p in range(parts):
            for i in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p][1] == i]
                if own:
                    books[p][i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out, by_label = [], {}
    for r, c in zip(kept, cut, strict=True):
        found = [near(c[p], p) for p in range(parts)]
        error = sum(f[0] for f in found)
        by_label[r[2]] = by_label.get(r[2], 0) + error
        out.append((r[0], "".join(f"{f[1]:02x}" for f in found), error, r[2]))
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=str)


def run(spark, rows, tmp_path, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in ("code", "error", "entry", "used", "total", "of")})
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    out = vc.op13_vector_codes(spark, str(tmp_path))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(n, size, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, scale, size)], int(i % 3) if i % 7 else None) for i in range(n)]


def test_nearest_is_exact_and_takes_the_lowest_of_equals():
    rng = np.random.default_rng(1)
    for width in (1, 3, 4, 5, 8):
        parts, entries = rng.integers(-4, 5, (300, width)), rng.integers(-4, 5, (40, width))
        which, apart, summed = vc.nearest(parts, entries, vc.walsh(width))
        plain = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (which == plain.argmin(axis=1)).all() and (apart == plain.min(axis=1)).all()
        big = parts.astype(object) * 10**30
        which, apart, _ = vc.nearest(big, entries.astype(object) * 10**30, vc.walsh(width))
        assert (which == plain.argmin(axis=1)).all() and apart.tolist() == [v * 10**60 for v in plain.min(axis=1).tolist()]


def test_entries_are_given_up_early():
    rng = np.random.default_rng(2)
    parts, entries = rng.integers(-200, 200, (500, 16)), rng.integers(-200, 200, (256, 16))
    parts[:250] = entries[rng.integers(0, 256, 250)] + rng.integers(-9, 9, (250, 16))  # half of them near an entry
    _, _, summed = vc.nearest(parts, entries, vc.walsh(16))
    assert summed < 0.5 * 500 * 256 * 16


def test_matrix_is_orthogonal_in_sequency_order():
    h = vc.walsh(8)
    assert (h @ h.T == 8 * np.eye(8)).all()
    assert [(row[1:] != row[:-1]).sum() for row in h] == list(range(8))


@pytest.mark.parametrize("size", [64, 16, 40, 5])
def test_against_plain_loops(spark, tmp_path, size):
    rows = vectors(150, size)
    rows += [(3, rows[3][1], 1), (3, rows[4][1], None), (1000, rows[0][1], 2)]  # repeated ids and vectors
    assert run(spark, rows, tmp_path) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = vectors(80, 32, seed=5)
    rows += [(500, None, 1), (501, [None, *rows[0][1][1:]], 1), (502, [float("nan")] * 32, 1), (503, [float("inf")] * 32, 1), (504, [1.0, 2.0], 1)]
    rows += [(None, rows[5][1], None), (2**53 + 1, rows[6][1], None), (2**63 - 1, [], 1), (-1, [-0.0] * 32, 2)]
    assert run(spark, rows, tmp_path, extra=True) == brute(rows)


def test_few_rows_no_rows_and_one_hot_vector(spark, tmp_path):
    assert run(spark, vectors(5, 16), tmp_path / "few") == brute(vectors(5, 16))
    assert run(spark, [], tmp_path / "none") == []
    hot = [(i, [0.25] * 16, 1) for i in range(300)] + vectors(20, 16)
    assert run(spark, hot, tmp_path / "hot") == brute(hot)


def test_large_components_are_exact_until_an_error_passes_a_long(spark, tmp_path):
    rows = [(i, [float(2**45 + 3 * i)] + [0.5] * 15, 1) for i in range(70)]
    assert run(spark, rows, tmp_path / "large") == brute(rows)
    with pytest.raises(Exception, match="(?i)too large|overflow|int64|long"):
        run(spark, [*rows, *((200 + i, [1e30 * (i + 1)] * 16, 1) for i in range(70))], tmp_path / "beyond")


def test_codes_decode_to_their_entries(spark):
    df = spark.createDataFrame(vectors(100, 32, seed=8), SCHEMA)
    books = vc.train(df, "embedding", "vec_id")
    rows = vc.decode(vc.encode(df, "embedding", books, "vec_id", "embedding"), books).collect()
    for r in rows:
        whole = [math.floor(256 * x) for x in r["embedding"]]
        assert sum((a - b) ** 2 for a, b in zip(whole, r["decoded"], strict=True)) == r["error"]


def test_sql_agrees(spark, tmp_path):
    rows = vectors(90, 64, seed=4) + [(500, None, 1), (501, [float("nan")] * 64, 1)]
    got = run(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(con.execute(vc.ORACLE).fetchall(), key=str) == got
