"""Exact top-k inner product by best-first search of a paged M-tree (operator 4).

Vectors are quantised to integers.  One more coordinate, sqrt(M^2 - |x|^2) with M the
largest norm, puts all candidates on a sphere, where a larger inner product with
a query (extended by 0) is a smaller Euclidean distance, so the M-tree's metric
bounds apply.

The tree has three levels.  Top: routing objects taken from a bounded
sample, each with the covering radius of its region.  Middle: a region's rows in blocks
of about ``BLOCK_ROWS`` (a hot region is salted over more blocks).  Bottom: pages of
about ``PAGE_ROWS`` entries with a routing object, a covering radius, the page's
distance to the region's routing object and each entry's distance to the
page's.  Every row is indexed.

A query first searches one block of its own region, which bounds its k-th score.  It is
then sent to those blocks only whose region can hold a score that good.
Inside a block each query takes pages nearest bound first; parent distances drop
pages and entries before any distance is computed.  The queries of a block advance
together, page by page, so the arithmetic is done on matrices.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, map_columns, materialize

SCALE = 256
TOP = 5
QUERY_MOD = 50
REGION_ROWS = 8192        # rows a region is meant to have
MAX_REGIONS = 1024        # bound of the sample of routing objects
BLOCK_ROWS = 8192
PAGE_ROWS = 256
QUERY_ROWS = 4096         # queries searched in a block at a time
_NONE = -(1 << 62)         # stands for no score yet; its negative is a long too
_SLACK = 1e-6             # relative allowance for rounding of distances; scores themselves are exact


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<long>): floor(scale * component); rows with a null id, a null vector or a
    null or non-finite component are left out."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
            .where(finite)
            .select("vec_id", F.transform("embedding", lambda v: F.floor(v * scale).cast("long")).alias("x")))


def _matrix(rows, dims: int) -> np.ndarray:
    """Integer rows as a matrix, shorter ones filled up with zeros."""
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _lifted(x: np.ndarray, top_norm: float) -> np.ndarray:
    """Rows with the coordinate that gives them all the norm sqrt(top_norm)."""
    f = x.astype(float)
    return np.column_stack([f, np.sqrt(np.maximum(top_norm - (f * f).sum(axis=1), 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (through floating point only where that is exact)."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    return (q.astype(float) @ x.T.astype(float)).astype(np.int64) if bound < 2 ** 52 else q @ x.T


def build_pages(ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, top_norm: float, page_rows: int = PAGE_ROWS) -> list[dict]:
    """Leaf pages of one block; rows that all lie at one place are cut by count alone."""
    lifted = _lifted(x, top_norm)
    n = max(1, -(-len(ids) // page_rows))
    routers = lifted[np.linspace(0, len(ids) - 1, n).astype(int)]
    distance = _distances(lifted, routers)
    nearest = distance.argmin(axis=1)
    pages = []
    for r in range(n):
        rows = np.flatnonzero(nearest == r)
        rows = rows[np.argsort(distance[rows, r], kind="stable")]
        for at in range(0, len(rows), page_rows):  # an overfull page becomes rings around its routing object
            part = rows[at:at + page_rows]
            pages.append({"router": routers[r].tobytes(), "radius": float(distance[part, r].max()),
                          "parent_distance": float(np.linalg.norm(routers[r] - pivot)),
                          "ids": ids[part].tobytes(), "x": x[part].tobytes(),
                          "entry_distance": distance[part, r].tobytes()})
    return pages


def search_pages(pages: list[dict], q_ids: np.ndarray, q: np.ndarray, pivot: np.ndarray, top_norm: float,
                 known: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, dict]:
    """Best ``top`` (ids, scores) per query within one block; unused places have the score ``_NONE``.

    ``known``: score a result must reach per query (``_NONE`` where none is known).  Also
    returns how many distances the stored bounds saved.
    """
    dims = q.shape[1]
    lifted = np.column_stack([q.astype(float), np.zeros(len(q))])
    norm = (lifted * lifted).sum(axis=1)
    best_id = np.full((len(q), top), -1, dtype=np.int64)
    best = np.full((len(q), top), _NONE)
    stats = {"pages": 0, "entries": 0, "skipped_pages": 0, "skipped_entries": 0}

    def reach(rows):
        """Largest distance at which a row's next result can lie."""
        floor_score = np.maximum(best[rows, -1], known[rows]).astype(float)
        square = norm[rows] + top_norm - 2 * floor_score
        return np.sqrt(np.maximum(square, 0)) * (1 + _SLACK) + _SLACK * (1 + np.sqrt(top_norm))

    parent = _distances(lifted, pivot[None, :])[:, 0]
    from_parent = np.array([p["parent_distance"] for p in pages])
    radius = np.array([p["radius"] for p in pages])
    # the stored distance to the region's routing object bounds a page before its own router is looked at
    rough = np.abs(parent[:, None] - from_parent[None, :]) - radius[None, :]
    open_pages = rough <= reach(np.arange(len(q)))[:, None]
    stats["skipped_pages"] += int((~open_pages).sum())
    routers = np.array([np.frombuffer(p["router"]) for p in pages])
    to_router = _distances(lifted, routers)
    bound = np.where(open_pages, to_router - radius[None, :], np.inf)
    order = np.argsort(bound, axis=1, kind="stable")
    alive = np.arange(len(q))
    for step in range(len(pages)):
        page_of = order[alive, step]
        near = bound[alive, page_of] <= reach(alive)
        stats["skipped_pages"] += int((~near).sum()) * (len(pages) - step)
        alive, page_of = alive[near], page_of[near]  # bounds only grow along a query's order
        if not len(alive):
            break
        for k in np.unique(page_of):
            rows = alive[page_of == k]
            p = pages[k]
            entry = np.frombuffer(p["entry_distance"])
            gap = np.abs(to_router[rows, k][:, None] - entry[None, :])
            possible = gap <= reach(rows)[:, None]
            used = np.flatnonzero(possible.any(axis=0))
            stats["pages"] += len(rows)
            stats["entries"] += len(rows) * len(used)
            stats["skipped_entries"] += len(rows) * (len(entry) - len(used))
            if not len(used):
                continue
            ids = np.frombuffer(p["ids"], dtype=np.int64)[used]
            score = _scores(q[rows], np.frombuffer(p["x"], dtype=np.int64).reshape(-1, dims)[used])
            own = q_ids[rows][:, None] == ids[None, :]
            score = np.where(own, _NONE, score)
            all_id = np.concatenate([best_id[rows], np.broadcast_to(np.where(own, -1, ids[None, :]), score.shape)], axis=1)
            all_score = np.concatenate([best[rows], score], axis=1)
            if all_score.shape[1] > 4 * top:  # rows that can still enter, before the exact order
                cut = -np.partition(-all_score, top - 1, axis=1)[:, top - 1]
                keep = (all_score >= cut[:, None]).any(axis=0)
                all_id, all_score = all_id[:, keep], all_score[:, keep]
            place = np.lexsort((all_id, -all_score), axis=-1)[:, :top]
            best_id[rows] = np.take_along_axis(all_id, place, axis=1)
            best[rows] = np.take_along_axis(all_score, place, axis=1)
    return best_id, best, stats


class Index:
    """Regions (routing objects, radii, block counts) and the written table of pages."""

    def __init__(self, vectors: DataFrame, region_rows: int = REGION_ROWS, block_rows: int = BLOCK_ROWS):
        """``vectors``: :func:`quantized` rows."""
        spark = vectors.sparkSession
        bound_batches(spark)
        x = materialize(vectors, "mtree_vectors")
        norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
        row = x.agg(F.count("*"), F.max(norm), F.max(F.size("x"))).first()
        self.rows, self.top_norm, self.dims = int(row[0]), float(row[1] or 0), int(row[2] or 0)
        wanted = min(MAX_REGIONS, max(1, -(-self.rows // region_rows)))
        sample = [r.x for r in x.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()]
        self.pivots = _lifted(_matrix(sample, self.dims), self.top_norm) if sample else np.zeros((1, self.dims + 1))
        dims, top_norm = self.dims, self.top_norm
        shared = spark.sparkContext.broadcast(self.pivots)

        def assign(batch):
            rows = batch.column("x").to_pylist()
            d = _distances(_lifted(_matrix(rows, dims), top_norm), shared.value)
            return {"vec_id": batch.column("vec_id"), "x": rows, "pivot": d.argmin(axis=1).astype(np.int32),
                    "distance": d.min(axis=1)}

        self.assigned = materialize(map_columns(x, assign, "vec_id long, x array<long>, pivot int, distance double"),
                                    "mtree_assigned")
        found = {r.pivot: r for r in self.assigned.groupBy("pivot").agg(
            F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}  # at most MAX_REGIONS rows
        n = len(self.pivots)
        self.radius = np.array([found[i].radius if i in found else -1.0 for i in range(n)])
        self.blocks = np.array([-(-found[i].n // block_rows) if i in found else 0 for i in range(n)])
        salts = F.array(*[F.lit(int(max(1, b))) for b in self.blocks])
        salt = F.pmod(F.xxhash64("vec_id", F.lit("salt")), F.element_at(salts, F.col("pivot") + 1)).cast("int")

        def build(group: pd.DataFrame) -> pd.DataFrame:
            pages = build_pages(group["vec_id"].to_numpy(dtype=np.int64), _matrix(group["x"].tolist(), dims),
                                shared.value[int(group["pivot"].iloc[0])], top_norm)
            return pd.DataFrame(pages).assign(pivot=group["pivot"].iloc[0], salt=group["salt"].iloc[0])

        schema = ("router binary, radius double, parent_distance double, ids binary, x binary, entry_distance binary, "
                  "pivot int, salt int")
        self.pages = materialize(self.assigned.select("vec_id", "x", "pivot", salt.alias("salt"))
                                 .groupBy("pivot", "salt").applyInPandas(build, schema), "mtree_pages")

    def _search(self, pages: DataFrame, queries: DataFrame, parts: int, top: int) -> DataFrame:
        """queries (query_id, x, known, pivot, salt) against their block: (query_id, vec_id, score)."""
        pivots = queries.sparkSession.sparkContext.broadcast(self.pivots)
        dims, top_norm = self.dims, self.top_norm

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
            q_ids = right["query_id"].to_numpy(dtype=np.int64)
            ids, scores, _ = search_pages(left.to_dict("records"), q_ids, _matrix(right["x"].tolist(), dims),
                                          pivots.value[int(left["pivot"].iloc[0])], top_norm,
                                          right["known"].to_numpy(dtype=np.int64), top)
            hit = scores.ravel() != _NONE
            hit &= scores.ravel() >= np.repeat(right["known"].to_numpy(dtype=np.int64), top)
            return pd.DataFrame({"query_id": np.repeat(q_ids, top)[hit], "vec_id": ids.ravel()[hit],
                                 "score": scores.ravel()[hit]})

        part = F.pmod(F.xxhash64("query_id", F.lit("part")), F.lit(parts)).cast("int")
        every = pages.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        keys = ["pivot", "salt", "part"]
        return (every.groupBy(*keys).cogroup(queries.withColumn("part", part).groupBy(*keys))
                .applyInPandas(run, "query_id long, vec_id long, score long"))

    def search(self, queries: DataFrame, top: int = TOP) -> DataFrame:
        """queries (query_id, x, pivot: own region) -> (query_id, rank, vec_id, score), ties to the smaller vec_id."""
        none = _NONE
        parts = max(1, -(-queries.count() // QUERY_ROWS))
        home = queries.select("query_id", "x", F.lit(none).alias("known"), "pivot", F.lit(0).alias("salt"))
        first = materialize(self._search(self.pages.where("salt = 0"), home, parts, top), "mtree_first")
        bounds = first.groupBy("query_id").agg(F.when(F.count("*") >= top, F.min("score")).otherwise(F.lit(none)).alias("known"))
        shared = queries.sparkSession.sparkContext.broadcast((self.pivots, self.radius, self.blocks))
        dims, top_norm = self.dims, self.top_norm

        def route(batch):
            pivots, radius, blocks = shared.value
            rows, known = batch.column("x").to_pylist(), batch.column("known").to_numpy(zero_copy_only=False)
            q = np.column_stack([_matrix(rows, dims).astype(float), np.zeros(len(rows))])
            reach = np.sqrt(np.maximum((q * q).sum(axis=1) + top_norm - 2 * known.astype(float), 0))
            reach = reach * (1 + _SLACK) + _SLACK * (1 + np.sqrt(top_norm))
            near = (_distances(q, pivots) - radius[None, :] <= reach[:, None]) & (blocks > 0)[None, :]
            out = {k: [] for k in ("query_id", "x", "known", "pivot", "salt")}
            ids, homes = batch.column("query_id").to_pylist(), batch.column("pivot").to_pylist()
            for i, p in zip(*np.nonzero(near)):
                for salt in range(int(p == homes[i]), int(blocks[p])):
                    for k, v in zip(out, (ids[i], rows[i], int(known[i]), int(p), salt)):
                        out[k].append(v)
            return out

        routed = map_columns(
            queries.join(bounds, "query_id", "left").select("query_id", "x", F.coalesce("known", F.lit(none)).alias("known"), "pivot"),
            route, "query_id long, x array<long>, known long, pivot int, salt int")
        found = first.unionByName(self._search(self.pages, routed, parts, top))
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, query_mod: int = QUERY_MOD, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` rows of greatest integer inner product per query.

    Queries are the rows whose vec_id is divisible by ``query_mod``, candidates all
    rows with another vec_id.  Rows with a null id or vector, or null or non-finite components, take no part;
    shorter vectors count as filled up with zeros; a vec_id that repeats is one query (its
    smallest vector) and a candidate per row; equal scores go to the smaller
    vec_id; other columns are ignored; an empty table gives none.  Scores are exact while they fit a long.
    """
    index = Index(quantized(vectors))
    queries = (index.assigned.where(F.col("vec_id") % query_mod == 0)
               .groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("x", "pivot")).alias("r"))
               .select("query_id", "r.x", "r.pivot"))
    return index.search(materialize(queries, "mtree_queries"), top)
