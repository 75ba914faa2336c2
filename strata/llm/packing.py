"""Best-fit packing planned over a histogram of lengths.

Texts are tokenised and cut into pieces; how many pieces have which length is
all that the plan needs. The driver fits lengths from long to short, each time
into the fullest sequences with room, for all equally full sequences at once:
its work and the plan's size depend on the sequence length, not on the corpus.
Pieces then get a rank within their length, and take the slot that the plan has
for it.

Defined cases: a null or empty text is the end token alone. Pieces of rows that
repeat a doc_id are packed each on their own. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import copied, counted, read_table, running_total, slots_for, written

MAX_TOKENS = 2048
END_ID = 0
CACHED_WORDS = 800_000  # words whose ids a Python worker keeps


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordIds(dict):
    """Token ids of a word (its UTF-8 bytes) as little-endian unsigned 32-bit integers.

    The tokenizer never joins across white space, so a text's ids are those of
    its words. A run of Latin letters with punctuation behind it, the common
    case, goes to the tokenizer's model directly, as the lower-case letters and
    the punctuation that its own rules make of it; every other word goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
        self.marks = lru_cache(10_000)(self._through)

    def _through(self, word: str) -> bytes:
        return _packed(self.full.encode(word, add_special_tokens=False).ids)

    def _letters(self, letters: str) -> bytes:
        known = letters if letters.isascii() else self.byte_level.pre_tokenize_str(letters)[0][0]
        return _packed([t.id for t in self.model.tokenize(known)])

    def __missing__(self, key: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        word = key.decode("utf-8", "surrogatepass")
        found = self.plain(word)
        if found is None or "<|" in word:
            ids = self._through(word)
        else:
            letters, marks = found[1].lower(), found[2]
            if letters == word:
                ids = self._letters(letters)
            else:
                ids = self[letters.encode()] + (self.marks(marks) if marks else b"")
        self[key] = ids
        return ids


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every text, its end id included."""
    end = _packed([END_ID])
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(tokenizer)
        width = 4 * max_tokens
        for batch in batches:
            doc_ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))  # Arrow keeps ids whole beside nulls
            out = []
            for doc_id, text in zip(doc_ids, texts, strict=True):
                raw = b"".join(map(ids.__getitem__, (text or "").encode("utf-8", "surrogatepass").split())) + end
                for at in range(0, len(raw), width):
                    part = raw[at : at + width]
                    out.append((doc_id, at // width, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_slots(counts: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, long before short, over counts.

    Rows (length, first_rank, pieces, each, first_sequence, offset): so many pieces of
    a length, ``each`` of them side by side in a sequence from ``offset`` on.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> runs of (first sequence, how many)
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def put(first: int, many: int, each: int, free: int, length: int = length) -> None:
            nonlocal left, rank
            rows.append((length, rank, many * each, each, first, max_tokens - free))
            room[free - each * length].append((first, many))
            rank, left = rank + many * each, left - many * each

        for free in sorted(f for f in room if f >= length):
            runs = room.pop(free)
            while runs and left:
                first, many = runs.pop()
                fit = free // length
                whole = min(many, left // fit)
                if whole:
                    put(first, whole, fit, free)
                if whole < many and left:
                    put(first + whole, 1, left, free)
                    whole += 1
                if whole < many:
                    runs.append((first + whole, many - whole))
            if runs:
                room[free].extend(runs)
            if not left:
                break
        if left:
            fit = max_tokens // length
            whole = left // fit
            if whole:
                put(sequences, whole, fit, max_tokens)
                sequences += whole
            if left:
                put(sequences, 1, left, max_tokens)
                sequences += 1
    return rows


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The pieces with the sequence and the offset that each one takes."""
    spark = docs.sparkSession
    found = written(token_pieces(docs, tokenizer, max_tokens), "pieces")
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most max_tokens rows
    found = counted(found)  # pieces of rows that repeat take neighbouring ranks
    schema = "length long, first_rank long, pieces long, each long, first_sequence long, at long"
    plan = spark.createDataFrame(plan_slots(counts, max_tokens), schema)
    slots = slots_for(sum(counts.values()))
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    top = F.shiftright(key, 64 - (slots.bit_length() - 1)) if slots > 1 else F.lit(0).cast("long")
    keyed = found.withColumns({"_key": key, "_slot": top})
    ranked = running_total(keyed, ["length"], "_slot", [F.col("_key"), F.col("doc_id"), F.col("piece")], "copies", "rank")
    ranked = copied(ranked, "rank", F.lit(1).cast("long"))
    # the plan has a few rows for each length, whatever the corpus
    took = ranked.join(F.broadcast(plan), "length").where("rank >= first_rank AND rank < first_rank + pieces")
    within = F.col("rank") - F.col("first_rank")
    return took.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (within % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), word_tokenizer_path())
