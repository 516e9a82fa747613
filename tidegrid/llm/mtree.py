"""Exact top-k search by inner product: M-trees of paged metric nodes, searched best first.

Inner products become distances: every vector gets one more component that brings it to the
greatest length M, a query gets 0 there, and then distance² = |q|² + M² - 2 q·x.  Vectors go to
the nearest of a few pivots, and each pivot's vectors into blocks of bounded size.  A block is an
M-tree of depth two: pages with a centre, a covering radius and the centre's distance to the
pivot, and in each page the distance of every vector to the centre.  By the triangle inequality
these stored distances rule out pages and vectors before any distance to them is computed.

Queries first search one block of their own pivot, and what they find there rules out pivots.
The rest go on packed, so that what travels is a row for each block and part of the queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import written

SCALE = 256
PIVOTS = 32
BLOCK = 4096
PAGE = 128
QUERY_PART = 4096


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole-number vectors; rows that are null or hold null or non-finite components go."""
    for batch in batches:
        ids, packed, norm, size, top = [], [], [], [], []
        for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
            if i is None or v is None or None in v:
                continue
            x = np.floor(SCALE * np.array(v, np.float64))
            if np.isfinite(x).all():
                ids.append(i)
                packed.append(x.astype("<f8").tobytes())
                norm.append(float(x @ x))
                size.append(len(x))
                top.append(float(np.abs(x).max(initial=0)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(packed, pa.binary()),
             pa.array(norm, pa.float64()), pa.array(size, pa.int32()), pa.array(top, pa.float64())],
            names=["vec_id", "x", "norm", "size", "top"])


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Vectors of one length; missing last components are 0."""
    if all(len(b) == 8 * width for b in blobs):
        return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), width)
    out = np.zeros((len(blobs), width))
    for row, b in zip(out, blobs):
        row[:len(b) // 8] = np.frombuffer(b, "<f8")
    return out


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that brings them to length sqrt(most)."""
    return np.c_[x, np.sqrt(np.maximum(0, most - (x * x).sum(1)))]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of every row of ``a`` from every row of ``b``."""
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(0, squares))


def build_pages(ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, most: float,
                page: int = PAGE) -> list[dict]:
    """Pages of one block: the farthest vectors become centres, the rest follow the nearest.

    A page that gets too many is filled in the order of distance, the rest going to further
    pages around the same centre, so that copies of one vector fill pages of their own.
    """
    lifted = _lifted(x, most)
    home = _distances(lifted, pivot[None])[:, 0]
    wanted = max(1, -(-2 * len(x) // page))
    centres = [int(home.argmax())]
    near = _distances(lifted, lifted[centres])[:, 0]
    owner = np.zeros(len(x), np.int64)
    while len(centres) < wanted and near.max() > 0:
        centres.append(int(near.argmax()))
        d = _distances(lifted, lifted[centres[-1:]])[:, 0]
        closer = d < near
        owner[closer] = len(centres) - 1
        near = np.where(closer, d, near)
    out = []
    for c, centre in enumerate(centres):
        mine = np.flatnonzero(owner == c)
        mine = mine[np.lexsort((ids[mine], near[mine]))]
        for lo in range(0, len(mine), page):
            part = mine[lo:lo + page]
            d = _distances(lifted[part], lifted[centre][None])[:, 0]
            out.append({"centre": lifted[centre], "parent": float(home[centre]),
                        "radius": float(d.max()), "ids": ids[part], "x": x[part], "near": d})
    return out


def search_block(pages: list[dict], to_pivot: float, query: np.ndarray, own: int, most: float,
                 k: int, floor: float) -> list[tuple[float, int]]:
    """The best (score, -id) of a block that may beat ``floor``, pages in order of their bound."""
    norm = float(query @ query)
    slack = 1e-7 * (norm + most) + 1e-9
    best: list[tuple[float, int]] = []

    def reach() -> float:
        """The distance beyond which nothing counts any more."""
        score = max(floor, best[0][0]) if len(best) == k else floor
        return np.inf if score == -np.inf else np.sqrt(max(0.0, norm + most - 2 * score + slack))

    parents = np.array([p["parent"] for p in pages])
    radii = np.array([p["radius"] for p in pages])
    first = np.abs(to_pivot - parents) - radii  # no distance computed yet
    open_ = np.flatnonzero(first <= reach())
    if not len(open_):
        return best
    lifted = np.append(query, 0.0)
    d = _distances(lifted[None], np.array([pages[i]["centre"] for i in open_]))[0]
    queue = sorted(zip((d - radii[open_]).tolist(), open_.tolist(), d.tolist()))
    for bound, i, to_centre in queue:
        limit = reach()
        if bound > limit:
            break
        page = pages[i]
        on = np.abs(to_centre - page["near"]) <= limit
        if not on.any():
            continue
        ids, scores = page["ids"][on], page["x"][on] @ query
        other = ids != own
        ids, scores = ids[other], scores[other]
        if len(scores) > k:  # ties at the k-th score stay until the ids are compared
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        for entry in zip(scores.tolist(), (-ids).tolist()):
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return best


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products.

    Components x become floor(256 x).  Queries are the rows whose id is divisible by ``every``,
    candidates all rows with another id; ties go to the smaller id.  Rows whose id or vector is
    null, or whose vector holds null or non-finite components, take no part; shorter vectors
    count as ending in zeros.  A repeated query row gives its result once; repeated candidates
    all count.  Scores are exact while they stay below 2^53.
    """
    spark = vectors.sparkSession
    packed = written(vectors.select(F.col(key).cast("long").alias("id"), F.col(vector)
                                    .cast("array<double>").alias("v"))
                     .mapInArrow(_pack, "vec_id long, x binary, norm double, size int, top double"),
                     "vectors")
    result = "query_id long, rank int, vec_id long, score long"
    rows, most, width = packed.agg(F.count(F.lit(1)), F.max("norm"), F.max("size")).first()
    if not rows:
        return spark.createDataFrame([], result)
    # a bounded number of pivots: any will do for right results
    blobs = [r["x"] for r in packed.select("x").distinct()
             .orderBy(F.xxhash64("x")).limit(PIVOTS).collect()]
    pivots = _lifted(_matrix(blobs, width), most)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_lifted(_matrix(batch.column("x").to_pylist(), width), most), pivots)
                at = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("x"), pa.array(at.astype(np.int32)),
                     pa.array(d[np.arange(len(at)), at])], names=["vec_id", "x", "pivot", "home"])

    placed = written(packed.select("vec_id", "x").mapInArrow(
        nearest, "vec_id long, x binary, pivot int, home double"), "placed")
    sizes = {r["pivot"]: r for r in placed.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.max("home").alias("radius")).collect()}
    blocks = [(p, -(-r["n"] // BLOCK)) for p, r in sorted(sizes.items())]
    starts = np.cumsum([0] + [n for _, n in blocks])
    first = {p: int(s) for (p, _), s in zip(blocks, starts)}
    pivot_of = np.repeat([p for p, _ in blocks], [n for _, n in blocks])
    count_of = dict(blocks)
    radius = np.array([sizes[p]["radius"] if p in sizes else -np.inf for p in range(len(pivots))])

    start_of = F.element_at(F.create_map(*[F.lit(x) for p in first for x in (p, first[p])]),
                            F.col("pivot"))
    blocks_of = F.element_at(F.create_map(*[F.lit(x) for p in first for x in (p, count_of[p])]),
                             F.col("pivot"))
    # copies of a vector and rows of a hot pivot are dealt over its blocks by id
    in_block = placed.withColumn(
        "block", (start_of + F.pmod(F.xxhash64("vec_id", "x"), blocks_of)).cast("int"))

    def index(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        ids = group.column("vec_id").to_numpy()
        x = _matrix(group.column("x").to_pylist(), width)
        pages = build_pages(ids, x, pivots[pivot_of[block]], most)
        blob = lambda name: pa.array([np.ascontiguousarray(p[name]).tobytes() for p in pages],
                                     pa.binary())
        return pa.table({"block": pa.array([block] * len(pages), pa.int32()),
                         "parent": pa.array([p["parent"] for p in pages]),
                         "radius": pa.array([p["radius"] for p in pages]),
                         "centre": blob("centre"), "ids": blob("ids"), "x": blob("x"),
                         "near": blob("near")})

    pages = written(in_block.groupBy("block").applyInArrow(
        index, "block int, parent double, radius double, centre binary, ids binary, x binary, "
               "near binary"), "pages")

    asked = placed.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "x"])
    parts = max(1, -(-asked.count() // QUERY_PART))

    def sent(batches: Iterator[pa.RecordBatch], own: bool) -> Iterator[pa.RecordBatch]:
        """Queries packed by block: to one of their own pivot's, or to all that the floor allows."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x").to_pylist(), width)
            lifted = np.c_[x, np.zeros(len(x))]
            d = _distances(lifted, pivots)
            ids = batch.column("vec_id").to_numpy()
            part = batch.column("part").to_numpy()
            if own:
                home = np.where(np.isfinite(radius), d, np.inf).argmin(1)
                target = [(first[int(p)], home == p) for p in np.unique(home)]
                floor = np.full(len(x), -np.inf)
            else:
                floor = np.array([np.nan if f is None else f for f in
                                  batch.column("floor").to_pylist()], np.float64)
                floor = np.where(np.isnan(floor), -np.inf, floor)
                norm = (x * x).sum(1)
                with np.errstate(invalid="ignore"):
                    reach = np.sqrt(np.maximum(0, norm + most - 2 * floor + 1e-6 * (norm + most)))
                target = [(b, d[:, p] - radius[p] <= reach) for b, p in enumerate(pivot_of)]
            out = []
            for b, mask in target:
                for q in np.unique(part[mask]):
                    mine = np.flatnonzero(mask & (part == q))
                    out.append((int(b), int(q), ids[mine].tobytes(), x[mine].tobytes(),
                                floor[mine].tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)],
                names=["block", "part", "ids", "x", "floor"])

    def search(index_pages: pa.Table, queries: pa.Table) -> pa.Table:
        tree = [{"centre": np.frombuffer(r["centre"], "<f8"), "parent": r["parent"],
                 "radius": r["radius"], "ids": np.frombuffer(r["ids"], "<i8"),
                 "x": np.frombuffer(r["x"], "<f8").reshape(-1, width),
                 "near": np.frombuffer(r["near"], "<f8")} for r in index_pages.to_pylist()]
        found: list[tuple] = []
        for r in queries.to_pylist():
            x = np.frombuffer(r["x"], "<f8").reshape(-1, width)
            to_pivot = _distances(np.c_[x, np.zeros(len(x))],
                                  pivots[pivot_of[r["block"]]][None])[:, 0]
            for i, q, d, floor in zip(np.frombuffer(r["ids"], "<i8").tolist(), x, to_pivot,
                                      np.frombuffer(r["floor"], "<f8")):
                tag = int(np.frombuffer(q.tobytes(), "<i8").sum(dtype=np.int64))
                found += [(i, tag, -j, int(s)) for s, j in
                          search_block(tree, d, q, i, most, k, floor)]
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns],
                        names=["query_id", "tag", "vec_id", "score"])

    by_id = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    sent_as = "block int, part int, ids binary, x binary, floor binary"
    found_as = "query_id long, tag long, vec_id long, score long"

    def run(queries: DataFrame) -> DataFrame:
        # pages go only where a query of their block is
        queries = written(queries, "sent")
        asked_for = queries.select(F.col("block").alias("_block"), F.col("part").alias("_part")).distinct()
        many = pages.join(asked_for, F.col("block") == F.col("_block")) \
            .select(*pages.columns, F.col("_part").alias("part"))
        return many.groupBy("block", "part").cogroup(queries.groupBy("block", "part")) \
            .applyInArrow(search, found_as)

    home = run(by_id.select("vec_id", "x", "part").mapInArrow(lambda b: sent(b, True), sent_as))
    floors = written(home.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("floor")), "floors")
    if asked.count() != asked.select("vec_id").distinct().count():
        floors = floors.withColumn("floor", F.lit(None).cast("double"))  # ids of several vectors
    bounded = by_id.join(floors, F.col("vec_id") == F.col("query_id"), "left") \
        .select("vec_id", "x", "part", "floor")
    best = run(bounded.mapInArrow(lambda b: sent(b, False), sent_as))
    order = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
