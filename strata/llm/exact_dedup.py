"""Exact dedup by content-defined chunk recipes.

A text without its white space is cut into chunks at places that its content
defines: behind the first of a few rare character patterns that lies at least
``MIN_CHUNK`` characters after the last cut, at most ``MAX_CHUNK``. A chunk gets a short identifier; one pass, which
moves each chunk once and copies within a task not even that, verifies that
every identifier stands for one content. Texts are then equal exactly if their
ordered lists of identifiers, their recipes, are equal, and only recipes are
grouped and joined. DataFrame functions only.

Defined cases: a null text is the empty text, whose recipe is empty; all such
rows are one group. A null ``doc_id`` ranks after any other. Rows that repeat
doc_id, length and normalised text are copies of which one stays. An empty
table gives an empty result. Other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import DOCUMENT_COLUMNS, SPACES, read_table, written

MIN_CHUNK = 256
MAX_CHUNK = 8192
# about one place in 500 characters of Latin text; digits and letters without case have patterns of their own
PLACES = r"[dhlmc][aeiou][bgkpvw][aeiou]|[37][0-9][05]|\p{Lo}\p{P}(?=\p{Lo})"
CUT = r"(?s).{%d,%d}?(?:%s)|.{1,%d}" % (MIN_CHUNK - 4, MAX_CHUNK - 4, PLACES, MAX_CHUNK)


def short_id(chunk: Column) -> Column:
    """128 bits of two differently seeded hashes."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


def long_id(chunk: Column) -> Column:
    return F.sha2(chunk, 256)


def text_id(chunk: Column) -> Column:
    return chunk


#: Tried in turn until one is verified; the last one is verified by itself.
IDENTIFIERS: tuple[Callable[[Column], Column], ...] = (short_id, long_id, text_id)


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def chunks(text: Column) -> Column:
    """The chunks of a normalised text, in order; joined they give the text."""
    return F.regexp_extract_all(text, F.lit(CUT), F.lit(0))


def clashes(docs: DataFrame, identify: Callable[[Column], Column]) -> DataFrame:
    """Identifiers that stand for more than one chunk content."""
    every = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    store = every.select(identify(F.col("chunk")).alias("chunk_id"), "chunk").groupBy("chunk_id").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    return store.where("lo != hi").select("chunk_id")


def verified_identifier(docs: DataFrame, identifiers: Sequence[Callable[[Column], Column]] = IDENTIFIERS) -> Callable[[Column], Column]:
    """The first function under which no two chunk contents share an identifier."""
    for identify in identifiers[:-1]:
        if clashes(docs, identify).isEmpty():
            return identify
    return identifiers[-1]


def exact_dedup(docs: DataFrame, identifiers: Sequence[Callable[[Column], Column]] = IDENTIFIERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, text_chars.

    Of texts that are equal without white space, the row with the most code
    points stays, then the one with the smallest doc_id.
    """
    identify = verified_identifier(docs.select("text"), identifiers)
    text = normalised(F.col("text"))
    recipes = written(
        docs.select(
            "doc_id",
            F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("text_chars"),
            F.sha2(text, 256).alias("text_sha256"),
            F.transform(chunks(text), lambda c: identify(c)).alias("recipe"),
        ),
        "recipes",
    )
    rows = recipes.groupBy("doc_id", "text_chars", "text_sha256", "recipe").agg(F.count(F.lit(1)).alias("copies"))
    # ~doc_id descends as doc_id ascends, and never overflows
    rank = F.struct("text_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("inverse"))
    best = F.max(rank).alias("best")
    classes = written(recipes.groupBy("recipe").agg(best, F.count(F.lit(1)).alias("group_size")), "recipe_classes")
    classes = classes.select("recipe", F.bitwise_not("best.inverse").alias("keep_id"), F.col("best.text_chars").alias("keep_chars"), "group_size")
    joined = rows.join(classes, "recipe").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_chars") == F.col("keep_chars")) & (F.col("copy") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "text_chars")


def keep_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever these are called."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    own = docs.select(F.struct("*").alias("row"), F.sha2(normalised(F.col("text")), 256).alias("sha"), length.alias("chars"))
    stay = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha"), F.col("text_chars").alias("keep_chars"))
    both = own.join(stay, F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")) & (F.col("chars") == F.col("keep_chars")))
    # rows that repeat doc_id and text: the first in the order of the other columns
    first = Window.partitionBy("keep_id", "keep_sha", "keep_chars").orderBy(*(f"row.{c}" for c in DOCUMENT_COLUMNS[1:]))
    return both.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
