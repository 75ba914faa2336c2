"""Cleaning, fingerprints, surrogate keys and exact ratios."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions.cleaning import clean_strings
from strata.functions.fingerprint import with_row_hash
from strata.functions.keys import surrogate_key
from strata.functions.numeric import ratio_half_up


def test_cleaning_rows_and_flag(spark):
    raw = ["O'Brien  st.", "McDonald-Ave", "123 main  st ", "Main St", "é x", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "id long, street string")
    out = {r.id: (r.street, r.validFlag) for r in clean_strings(df).collect()}
    assert [out[i] for i in range(6)] == [
        ("O'brien St", 0),
        ("Mcdonald Ave", 0),
        ("123 Main St", 0),
        ("Main St", 1),
        ("X", 0),
        (None, 0),
    ]


def test_cleaning_keeps_key_and_column_order(spark):
    df = spark.createDataFrame([("k_1", 3, "a b")], "id string, n int, s string")
    out = clean_strings(df)
    assert out.columns == ["id", "n", "s", "validFlag"]
    assert out.first().id == "k_1"


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame([(1, "  hello__WORLD  "), (2, "x")], "id long, s string")
    once = clean_strings(df).drop("validFlag")
    twice = clean_strings(once)
    assert [r.s for r in once.orderBy("id").collect()] == [r.s for r in twice.orderBy("id").collect()]
    assert all(r.validFlag == 1 for r in twice.collect())


def test_null_shift_fingerprint(spark):
    df = spark.createDataFrame([(1, "a", None, "b"), (2, "a", "b", None)], "id long, x string, y string, z string")
    marked = {r.id: r.hash for r in with_row_hash(df).collect()}
    plain = {r.id: r.hash for r in with_row_hash(df, null_marker=None).collect()}
    assert marked[1] != marked[2]
    assert plain[1] == plain[2]


def test_surrogate_key_drops_nulls(spark):
    df = spark.createDataFrame([(None, 5), (5, None), (None, None)], "o long, i long")
    assert [r.k for r in df.select(surrogate_key("i", "o").alias("k")).collect()] == ["5", "5", ""]


def test_ratio_half_up_is_exact(spark):
    df = spark.createDataFrame([(57, 200), (-57, 200), (1, 3), (0, 5), (5, 0)], "n long, d long")
    got = [r.x for r in df.select(ratio_half_up(F.col("n"), F.col("d"), 2).alias("x")).collect()]
    assert got == [Decimal("0.29"), Decimal("-0.29"), Decimal("0.33"), Decimal("0.00"), None]


def test_dedupe_key_survivor_does_not_depend_on_input_order(spark):
    from strata.operators.dedupe import dedupe_key

    rows = [(1, "b", None), (1, "a", 2), (1, "a", None), (2, "z", 1)]
    a = dedupe_key(spark.createDataFrame(rows, "id long, v string, n int"), "id").collect()
    b = dedupe_key(spark.createDataFrame(rows[::-1], "id long, v string, n int").repartition(3), "id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == [(1, "a", None), (2, "z", 1)]


def test_snapshot_file_cap(spark):
    import glob

    from strata.sources.sinks import read_snapshot, write_snapshot

    path = write_snapshot(spark, spark.range(100).coalesce(1), "capped", max_records_per_file=30)
    if path.startswith("file:"):
        path = path[len("file:"):]
    assert len(glob.glob(f"{path}/*.parquet")) == 4
    assert read_snapshot(spark, path).count() == 100


def test_unicode_letters_option_keeps_accented_words(spark):
    df = spark.createDataFrame([(1, "é x"), (2, "Zoë  Ann")], "id long, s string")
    ascii_rule = {r.id: r.s for r in clean_strings(df).collect()}
    unicode_rule = {r.id: r.s for r in clean_strings(df, unicode_letters=True).collect()}
    assert ascii_rule == {1: "X", 2: "Zo Ann"}
    assert unicode_rule == {1: "É X", 2: "Zoë Ann"}


def test_read_sources_registers_one_view_per_name(spark):
    from strata.sources.tables import read_sources
    from tests.conftest import SF_SMALL

    tables = read_sources(spark, SF_SMALL, "orders, customer")
    assert set(tables) == {"orders", "customer"}
    assert spark.table("orders").count() == tables["orders"].count() > 0
    assert spark.sql("select count(*) as n from customer").first().n > 0


def test_fingerprints_of_different_rows_differ(spark):
    """A separator, a backslash or the null marker inside a value can't imitate another row."""
    from strata.functions.fingerprint import fingerprint

    rows = [("a~b", "c"), ("a", "b~c"), (None, "z"), ("\\N", "z"), ("a\\", "~c"), ("a\\~", "c"), ("a", None), ("a", ""), ("\\", "N"), ("\\\\N", "z")]
    df = spark.createDataFrame(rows, "x string, y string").withColumn("h", fingerprint(["x", "y"]))
    assert len({r.h for r in df.collect()}) == len(rows)
