"""Exact top-k inner products by best-first search over an M-tree of pages.

The tree: a bounded sample gives the routing objects of the top level; a vector
belongs to the nearest one and keeps its distance to it, the parent distance.
The vectors of a cell, in rings of that distance, fill pages of ``PAGE``
vectors; a page is divided among ``LEAVES`` routing objects of its own, each
with covering radius and parent distance. Every vector is in the index.

The search: queries travel in blocks, and a block as a whole is held against the
pages first; only what that leaves over meets single queries. What a query has
already found among the sample bounds what it still needs. The largest inner product that a ball or a
ring can hold follows from the triangle inequality,

    q.x = (|q|^2 + |x|^2 - d(q,x)^2) / 2,   d(q,x) >= |d(q,p) - d(x,p)|,

so stored distances rule out cells, pages and leaves before any inner product is
computed; what is left is visited best bound first, and each visit raises what a
query needs. Bounds are rounded up and ties go on unless all ids there are
larger, so the result is exact.

Defined cases: a row whose id or vector is null, or whose vector holds a null or
a component that is not finite, takes no part; finite ones of any size do, and
a score among the best that a long can't hold stops the run. A shorter vector counts as filled up with zeros. Rows that repeat an id are one
candidate, with its best score, and never their own query's. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import read_table, running_total, slots_for, written

TOP = 5
QUERY_EVERY = 50
SCALE = 256
LIMIT = 2.0**400  # of a scaled component, which only doubles can pass: squares have to be finite; beyond it the run stops
SLACK = 4e-12  # of the sizes that a bound is computed from, for rounding
LONG = 2**63
SAMPLE = 4096
CELLS = 64
RINGS = 64
PAGE = 1024
LEAVES = 16
BLOCK_PAGES = 16  # queries of so many neighbouring pages travel together,
BLOCK_QUERIES = 512  # and of so many cells that there are about so many
SHARD_PAGES = 16  # about so many pages are visited one after the other for a block


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: through floats where these are exact, as Python's integers where longs are too short."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < LONG:
        return a.astype(np.int64) @ b.astype(np.int64).T
    wide = np.argwhere(np.sqrt(_norms(a))[:, None] * np.sqrt(_norms(b))[None, :] >= LONG // 2)
    with np.errstate(invalid="ignore"):  # components beyond a long are in wide pairs, or meet zeros
        out = (a.astype(np.int64) @ b.astype(np.int64).T).astype(object)
    for i, j in wide.tolist():
        out[i, j] = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[j].tolist(), strict=True))
    return out


def _norms(a: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a, dtype=np.float64)


def _distances(a: np.ndarray, b: np.ndarray, dots: np.ndarray | None = None) -> np.ndarray:
    """Distances of all rows; from the inner products where these and the norms are exact in floats."""
    left, right = _norms(a), _norms(b)
    if left.max(initial=0.0) + right.max(initial=0.0) < 2**51:
        dots = _products(a, b) if dots is None else dots
        return np.sqrt(np.maximum(left[:, None] + right[None, :] - 2.0 * dots, 0.0))
    own = a.astype(np.float64)
    return np.stack([np.sqrt(_norms(own - row)) for row in b.astype(np.float64)], axis=1)


def spread_out(vectors: np.ndarray, many: int) -> list[int]:
    """Indices of routing objects: each the farthest from those before it, no two the same."""
    chosen = [0]
    apart = _distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < many:
        far = int(apart.argmax())
        if apart[far] == 0:
            break
        chosen.append(far)
        apart = np.minimum(apart, _distances(vectors, vectors[far : far + 1])[:, 0])
    return chosen


def _at_most(norm: np.ndarray, largest: np.ndarray, apart: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product, a whole number, from the least distance; ``far`` is the largest that this comes from."""
    bound = (norm + largest - np.maximum(apart, 0.0) ** 2) / 2
    return np.floor(bound + (norm + largest + far**2) * SLACK + 1e-3)


def _within(dots: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product, a whole number, from the one with the centre and what the radius can add."""
    dots = dots.astype(np.float64)
    return np.floor(dots + reach + (np.abs(dots) + reach) * SLACK + 1e-3)


def _whole(numbers) -> np.ndarray:
    numbers = list(numbers)
    return np.array(numbers, dtype=np.int64 if all(-LONG <= x < LONG for x in numbers) else object)


class Best:
    """The best (score, id) of each query so far, and what an entry has to beat."""

    def __init__(self, score: np.ndarray, vec_id: np.ndarray, top: int):
        self.needed, self.needed_id, self.top = score.astype(np.float64), vec_id.copy(), top
        self.found: list[dict[int, int]] = [{} for _ in score]

    def may_hold(self, bound: np.ndarray, first_id: np.ndarray | int) -> np.ndarray:
        """Whether entries up to ``bound`` with ids from ``first_id`` can still matter."""
        needed, own = (x if bound.ndim == 1 else x[:, None] for x in (self.needed, self.needed_id))
        return (bound > needed) | ((bound == needed) & (first_id <= own))

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        held = self.found[query]
        taken: set[int] = set()
        for k in np.lexsort((ids, -scores)).tolist():
            vec_id, score = int(ids[k]), int(scores[k])
            if vec_id in taken:
                continue
            if score > held.get(vec_id, score - 1):
                held[vec_id] = score
            taken.add(vec_id)
            if len(taken) == self.top:  # the rest ranks below so many other ids
                break
        ranked = sorted(held.items(), key=lambda x: (-x[1], x[0]))[: self.top]
        self.found[query] = dict(ranked)
        if len(ranked) == self.top:
            vec_id, score = ranked[-1]
            if (score, -vec_id) > (self.needed[query], -self.needed_id[query]):
                self.needed[query], self.needed_id[query] = score, vec_id


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and the scaled whole numbers of every vector that takes part."""
    scaled = lambda x: x.cast("double") * SCALE
    # from 2**52 on doubles are whole, and soon beyond a long
    sized = F.transform("embedding", lambda x: F.when(F.abs(scaled(x)) >= 2.0**52, scaled(x)).otherwise(F.floor(scaled(x)).cast("double")))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return embeddings.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine).select("vec_id", sized.alias("vec"))


def _matrix(vectors, width: int, kind: str) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=kind)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _page(key: tuple, rows: pd.DataFrame, width: int, kind: str) -> pd.DataFrame:
    """One page: its vectors by leaf, the routing object first, and what the leaves store."""
    rows = rows.sort_values(["dist", "vec_id"])
    vectors = np.frombuffer(b"".join(rows["vec"]), dtype=kind).reshape(len(rows), width)
    routers = spread_out(vectors, LEAVES)
    apart = _distances(vectors, vectors[routers])
    leaf = apart.argmin(axis=1)
    leaf[routers] = np.arange(len(routers))
    own = apart[np.arange(len(rows)), leaf]
    order = np.lexsort((rows["vec_id"].to_numpy(), np.isin(np.arange(len(rows)), routers, invert=True), leaf))
    ends = np.cumsum(np.bincount(leaf, minlength=len(routers)))
    starts = ends - np.diff(ends, prepend=0)
    dist, ids, norms = rows["dist"].to_numpy()[order], rows["vec_id"].to_numpy()[order], _norms(vectors)[order]
    return pd.DataFrame(
        {
            "cell": [key[0]], "page": [key[1]], "nearest": [dist.min()], "farthest": [dist.max()], "first_id": [ids.min()], "largest": [norms.max()],
            "ids": [ids.astype("<i8").tobytes()], "vecs": [vectors[order].tobytes()], "ends": [ends.tolist()],
            "radius": [np.maximum.reduceat(own[order], starts).tolist()], "parent": [dist[starts].tolist()],
            "leaf_first_id": [np.minimum.reduceat(ids, starts).tolist()], "leaf_largest": [np.maximum.reduceat(norms, starts).tolist()],
        }
    )


PAGE_SCHEMA = "cell int, page long, nearest double, farthest double, first_id long, largest double, ids binary, vecs binary, ends array<long>, radius array<double>, parent array<double>, leaf_first_id array<long>, leaf_largest array<double>"


def visit(best: Best, query_ids: np.ndarray, queries: np.ndarray, to_parent: np.ndarray, page) -> None:
    """Search one page for all queries, leaf by leaf, the most promising first."""
    width = queries.shape[1]
    ids = np.frombuffer(page.ids, dtype="<i8")
    vectors = np.frombuffer(page.vecs, dtype=queries.dtype).reshape(len(ids), width)
    ends = np.asarray(page.ends, dtype=np.int64)
    starts = ends - np.diff(ends, prepend=0)
    radius, parent, first_id, largest = (np.asarray(x) for x in (page.radius, page.parent, page.leaf_first_id, page.leaf_largest))
    norms = _norms(queries)
    # stored distances only
    apart = np.abs(to_parent[:, None] - parent[None, :]) - radius[None, :]
    bound = _at_most(norms[:, None], largest[None, :], apart, to_parent[:, None] + parent[None, :])
    wanted = best.may_hold(bound, first_id[None, :])
    some = np.flatnonzero(wanted.any(axis=1))
    if not len(some):
        return
    dots = _products(queries[some], vectors[starts])
    routed = _distances(queries[some], vectors[starts], dots)
    bound[some] = np.minimum(bound[some], _at_most(norms[some, None], largest[None, :], routed - radius[None, :], routed))
    bound[some] = np.minimum(bound[some], _within(dots, np.sqrt(norms[some, None]) * radius[None, :]))
    for leaf in np.argsort(-bound.max(axis=0), kind="stable").tolist():
        asks = np.flatnonzero(wanted[:, leaf] & best.may_hold(bound[:, leaf], first_id[leaf]))
        if not len(asks):
            continue
        span = slice(starts[leaf], ends[leaf])
        scores = _products(queries[asks], vectors[span])
        for row, query in enumerate(asks.tolist()):
            own = (scores[row].astype(np.float64) >= best.needed[query]) & (ids[span] != query_ids[query])
            if own.any():
                best.add(query, scores[row][own], ids[span][own])


def top_k(embeddings: DataFrame, top: int = TOP, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score for every vector whose id is divisible by ``every``."""
    vectors = usable(embeddings)
    empty = "query_id long, rank int, vec_id long, score long"
    spark = embeddings.sparkSession
    facts = vectors.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.min("vec_id"), F.max("vec_id"), F.count_if(F.col("vec_id") % every == 0), F.max(F.array_max(F.transform("vec", F.abs)))).first()
    if not facts[0]:
        return spark.createDataFrame([], empty)
    count, width, low, high = facts[0], max(1, facts[1]), facts[2], facts[3]
    largest = facts[5] or 0.0
    if not largest < LIMIT:
        raise ValueError(f"op8: a component of {largest / SCALE} is too large to search")
    kind = "<i4" if largest < 2**31 else "<f8"  # either holds every scaled component
    cells_together = max(1, BLOCK_QUERIES * CELLS // max(1, facts[4]))
    # a bounded sample: routing objects, and what queries find before the search
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE).collect()
    sample_ids = np.array([r["vec_id"] for r in picked], dtype=np.int64)
    sample = _matrix([r["vec"] for r in picked], width, kind)
    routers = sample[spread_out(sample, CELLS)]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            own = _matrix(batch["vec"].tolist(), width, kind)
            apart = _distances(own, routers)
            cell = apart.argmin(axis=1)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "cell": cell.astype(np.int32), "dist": apart[np.arange(len(own)), cell], "vec": [v.tobytes() for v in own]})

    placed = written(vectors.mapInPandas(assign, "vec_id long, cell int, dist double, vec binary"), "vectors")
    far = {r["cell"]: r["far"] for r in placed.groupBy("cell").agg(F.max("dist").alias("far")).collect()}  # at most CELLS rows
    slots = slots_for(count)
    ring = F.least(F.floor(F.col("dist") * (RINGS / (max(far.values()) or 1.0))), F.lit(RINGS - 1))
    by_id = F.floor((F.col("vec_id").cast("double") - float(low)) / (float(high) - float(low) + 1.0) * slots)
    slotted = placed.withColumns({"slot": (ring * slots + by_id).cast("long"), "one": F.lit(1).cast("long")})
    ranked = running_total(slotted, ["cell"], "slot", [F.col("dist"), F.col("vec_id")], "one", "rank").withColumn("page", F.floor(F.col("rank") / PAGE).cast("long"))

    def page(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _page(key, rows, width, kind)

    ranked = ranked.select("cell", "page", "vec_id", "dist", "vec")
    pages = written(ranked.groupBy("cell", "page").applyInPandas(page, PAGE_SCHEMA), "pages")

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What each query finds in the sample, and the cells that may hold better."""
        reach = np.array([far.get(k, -1.0) for k in range(len(routers))])
        for batch in batches:
            if not len(batch):
                continue
            ids = batch["vec_id"].to_numpy()
            own = np.frombuffer(b"".join(batch["vec"]), dtype=kind).reshape(len(ids), width)
            best = Best(np.full(len(ids), -np.inf), np.full(len(ids), np.iinfo(np.int64).max), top)
            for at in range(0, len(ids), 256):
                scores = _products(own[at : at + 256], sample)
                sizes = scores.astype(np.float64)
                for row in range(len(scores)):
                    others = np.flatnonzero(sample_ids != ids[at + row])
                    if len(others) > 8 * top:
                        near = np.partition(sizes[row][others], -4 * top)[-4 * top]
                        others = others[sizes[row][others] >= near]
                    best.add(at + row, scores[row][others], sample_ids[others])
            to = _distances(own, routers)
            norms = _norms(own)
            bound = _within(_products(own, routers), np.sqrt(norms)[:, None] * np.maximum(reach, 0.0)[None, :])
            row, cell = np.nonzero((bound >= best.needed[:, None]) & (reach >= 0)[None, :])
            tell = batch.iloc[row]
            yield pd.DataFrame(
                {
                    "query_id": tell["vec_id"].to_numpy(), "home": tell["cell"].to_numpy(), "home_page": tell["page"].to_numpy(), "vec": tell["vec"].to_numpy(), "cell": cell.astype(np.int32),
                    "to_parent": to[row, cell], "norm": norms[row], "needed": best.needed[row], "needed_id": best.needed_id[row],
                }
            )

    asked = ranked.where(F.col("vec_id") % every == 0).select("vec_id", "cell", "page", "vec")
    started = written(asked.mapInPandas(start, "query_id long, home int, home_page long, vec binary, cell int, to_parent double, norm double, needed double, needed_id long"), "queries")
    block = [F.floor(F.col("home") / cells_together).cast("long").alias("home"), F.floor(F.col("home_page") / BLOCK_PAGES).cast("long").alias("part")]
    # a block of queries against a ring of the cell: for all of them, the ring holds nothing nearer than
    # the least difference of distances to the router, and the least demanding of them decides
    of_block = started.select(*block, "cell", "to_parent", "norm", "needed").groupBy("home", "part", "cell")
    of_block = of_block.agg(F.min("to_parent").alias("near"), F.max("to_parent").alias("far"), F.max("norm").alias("norm"), F.min("needed").alias("needed"))
    gap = F.greatest(F.col("near") - F.col("farthest"), F.col("nearest") - F.col("far"), F.lit(0.0))
    bound = (F.col("norm") + F.col("largest") - gap * gap) / 2
    far_off = F.col("far") + F.col("farthest")
    # kept as a double: a long can be too short
    bound = bound + (F.col("norm") + F.col("largest") + far_off * far_off) * SLACK + 1e-3
    bound = F.when(F.abs(bound) >= 2.0**52, bound).otherwise(F.floor(bound).cast("double"))
    directory = pages.select("cell", "page", "nearest", "farthest", "largest")
    met = of_block.join(directory, "cell").withColumn("bound", bound).where("bound >= needed")
    pairs = met.select("home", "part", "cell", "page", "bound")
    # the queries of a block with their distances to a cell's router: bounded by the pages that they live on
    columns = ["query_id", "vec", "to_parent", "needed", "needed_id"]
    blocks = started.select(*block, "cell", F.struct(*columns).alias("q")).groupBy("home", "part", "cell").agg(F.collect_list("q").alias("q"))
    blocks = blocks.select("home", "part", "cell", *(F.col(f"q.{c}").alias(c) for c in columns))
    work = pairs.join(blocks, ["home", "part", "cell"]).join(pages.drop("nearest", "farthest", "first_id", "largest"), ["cell", "page"])
    shards = -(-pages.count() // SHARD_PAGES)
    work = work.withColumn("shard", F.pmod(F.xxhash64("cell", "page"), F.lit(max(1, shards))))
    dealt = work.repartition("home", "part", "shard").sortWithinPartitions("home", "part", "shard", F.desc("bound"), "cell", "page")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, known = None, {}

        def result() -> Iterator[pd.DataFrame]:
            out = [(q, v, s) for q, held in known.items() for v, s in held.items()]
            if not out:
                return
            queries, ids, scores = zip(*out, strict=True)
            if max(scores) >= LONG:
                raise OverflowError(f"op8: a score of {max(scores)} does not fit a long")
            # one below all longs is null, which ranks last
            held = pd.array([s if s >= -LONG else None for s in scores], dtype="Int64")
            yield pd.DataFrame({"query_id": queries, "vec_id": ids, "score": held})

        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.home, row.part, row.shard) != current:
                    yield from result()
                    current, known = (row.home, row.part, row.shard), {}
                ids = np.asarray(row.query_id, dtype=np.int64)
                queries = np.frombuffer(b"".join(row.vec), dtype=kind).reshape(len(ids), width)
                best = Best(np.asarray(row.needed, dtype=np.float64), np.asarray(row.needed_id, dtype=np.int64), top)
                for k, q in enumerate(ids.tolist()):
                    if q in known:  # what pages before this one have given
                        held = known[q]
                        best.add(k, _whole(held.values()), _whole(held.keys()))
                visit(best, ids, queries, np.asarray(row.to_parent, dtype=np.float64), row)
                for k, q in enumerate(ids.tolist()):
                    if best.found[k]:
                        merged = known.get(q, {})
                        for v, s in best.found[k].items():
                            merged[v] = max(s, merged.get(v, s))
                        known[q] = dict(sorted(merged.items(), key=lambda x: (-x[1], x[0]))[:top])
        yield from result()

    found = dealt.mapInPandas(search, "query_id long, vec_id long, score long").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    score = F.coalesce("score", F.raise_error(F.lit("op8: a score does not fit a long")).cast("long")).alias("score")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", score)


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec::DOUBLE[], c.vec::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
