"""Approximate nearest neighbours by largest inner product, with balanced posting lists.

Centroids come from a bounded sample, cut into equal halves again and again, and are searched by an in-memory
neighbourhood graph. Every vector is indexed: it goes to the list of its nearest centroid and, near a boundary, to those
of other centroids within ``REPLICA_RATIO`` of that distance. A query visits the lists whose centroids are within
``PROBE_RATIO`` of its nearest one, ``LEAST_LISTS`` at least. Long lists are cut into blocks, so that a list is work for many tasks; inner products
are exact sums in double precision on the original vectors.

Inner products become distances by one more component (what a vector's norm lacks of the largest norm).

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do rows
without vec_id; equal rows count once. Of equal vectors only the ``k + 1`` smallest vec_ids can be in any answer, as ties
go to smaller ones, so the others are left out before the index. Without vectors the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored

K = 20
EVERY = 20
#: The index is fitted on at most so many vectors, those with the smallest hashes.
SAMPLE = 20_000
LIST_SIZE = 64
MAX_LISTS = 1024
DEGREE = 24
BEAM = 192
REPLICA_RATIO = 1.06
REPLICAS = 4
PROBE_RATIO = 1.35
#: Lists that every query visits, however much nearer the first one is.
LEAST_LISTS = 16
BLOCK = 256


def usable(vectors: DataFrame, k: int = K) -> DataFrame:
    """``vec_id, v`` (array of double) of the rows that take part, equal vectors thinned out."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .filter((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
        .select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
        .distinct()
    )
    return rows


def thinned(rows: DataFrame, k: int = K) -> DataFrame:
    """Of equal vectors the k + 1 smallest vec_ids."""
    smallest = Window.partitionBy("v").orderBy("vec_id")
    return rows.withColumn("_no", F.row_number().over(smallest)).filter(F.col("_no") <= k + 1).drop("_no")


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def balanced_centroids(x: np.ndarray, n_lists: int) -> np.ndarray:
    """Centroids of parts of equal size: parts are halved at the median between two poles."""
    parts = [np.arange(len(x))]
    while len(parts) < n_lists and max(map(len, parts)) > 1:
        parts.sort(key=len, reverse=True)
        part = parts.pop(0)
        own = x[part]
        centre = own.mean(0)
        one = own[np.argmax(((own - centre) ** 2).sum(1))]
        two = own[np.argmax(((own - one) ** 2).sum(1))]
        for _ in range(4):
            side = np.argsort(own @ (two - one), kind="stable")
            half = len(side) // 2
            one, two = own[side[:half]].mean(0), own[side[half:]].mean(0)
        parts += [part[side[:half]], part[side[half:]]]
    return np.array([x[p].mean(0) for p in parts])


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Each centroid's nearest others, the last quarter of its links being far ones that keep the graph in one piece."""
    n = len(centroids)
    near = min(degree - degree // 4, n - 1)
    links = np.zeros((n, min(degree, max(1, n - 1))), np.int32)
    for low in range(0, n, 512):
        d = distances(centroids[low : low + 512], centroids)
        d[np.arange(len(d)), np.arange(low, low + len(d))] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, : links.shape[1]]
        links[low : low + 512] = order if n > 1 else 0
    far = np.random.default_rng(7).integers(0, n, (n, max(0, links.shape[1] - near)))
    links[:, near:] = far
    if n > 1:
        links[:, -1] = (np.arange(n) + 1) % n
    return links


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def graph_search(queries: np.ndarray, centroids: np.ndarray, links: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest centroids found for each query and their distances, nearest first.

    Best-first search from a few spread entry points, all queries a step at a time: each expands its nearest open
    centroid until none of its beam is open.
    """
    n, c = len(queries), len(centroids)
    beam = min(beam, c)
    entries = np.unique(np.linspace(0, c - 1, min(c, 8)).astype(np.int64))
    seen = np.zeros((n, c), bool)
    seen[:, entries] = True
    ids = np.full((n, beam), -1, np.int64)
    dist = np.full((n, beam), np.inf)
    open_ = np.zeros((n, beam), bool)
    d = distances(queries, centroids[entries])
    order = np.argsort(d, axis=1, kind="stable")[:, :beam]
    m = order.shape[1]
    ids[:, :m], dist[:, :m], open_[:, :m] = entries[order], np.take_along_axis(d, order, 1), True
    active = np.arange(n)
    while len(active):
        best = np.where(open_[active], dist[active], np.inf).argmin(1)
        going = open_[active, best]
        active, best = active[going], best[going]
        if not len(active):
            break
        open_[active, best] = False
        found = links[ids[active, best]].astype(np.int64)
        fresh = ~seen[active[:, None], found]
        # A link may be there twice; its second mention would stand twice in the beam.
        found_sorted = np.sort(found, axis=1)
        fresh &= ~_repeated(found) if (found_sorted[:, 1:] == found_sorted[:, :-1]).any() else True
        seen[active[:, None], found] = True
        gap = queries[active][:, None, :] - centroids[found]
        near = np.where(fresh, np.sqrt((gap * gap).sum(2)), np.inf)
        all_ids = np.concatenate((ids[active], found), axis=1)
        all_dist = np.concatenate((dist[active], near), axis=1)
        all_open = np.concatenate((open_[active], fresh), axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, order, 1)
        dist[active] = np.take_along_axis(all_dist, order, 1)
        open_[active] = np.take_along_axis(all_open, order, 1) & np.isfinite(dist[active])
    return ids, dist


def _repeated(rows: np.ndarray) -> np.ndarray:
    """Which entries have an equal one before them in their row."""
    order = np.argsort(rows, axis=1, kind="stable")
    ordered = np.take_along_axis(rows, order, 1)
    again = np.zeros(rows.shape, bool)
    again[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    out = np.zeros(rows.shape, bool)
    np.put_along_axis(out, order, again, 1)
    return out


class Index:
    """Centroids and their graph: bounded by ``MAX_LISTS``, hence carried by tasks."""

    def __init__(self, rows: DataFrame) -> None:
        n, norm = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
        self.n, self.norm = n, norm or 0.0
        order = ["_hash", "vec_id", "_of_v"]
        keyed = rows.withColumns({"_hash": F.xxhash64("vec_id"), "_of_v": F.xxhash64("v")})
        if n > SAMPLE:
            # Each task would send the driver as many vectors as the sample has. Their keys alone tell the tasks the last one's.
            last = keyed.select(*order).orderBy(*order).limit(SAMPLE).agg(F.max(F.struct(*order)).alias("last")).first()["last"]
            keyed = keyed.filter(F.struct(*order) <= F.struct(*(F.lit(x).cast("long") for x in last)))
        chosen = keyed.orderBy(*order).limit(SAMPLE).select("v").collect()
        x = self.lifted(np.array([r["v"] for r in chosen])) if chosen else np.zeros((0, 1))
        self.centroids = balanced_centroids(x, max(1, min(MAX_LISTS, n // LIST_SIZE))) if len(x) else x
        self.links = neighbour_graph(self.centroids) if len(x) else np.zeros((0, 1), np.int32)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Stored vectors with the component that makes all norms equal."""
        rest = np.sqrt(np.maximum(self.norm - (x * x).sum(1), 0))
        return np.column_stack((x, rest))

    def aimed(self, q: np.ndarray) -> np.ndarray:
        """Queries on the same sphere, where nearness orders as inner products do."""
        length = np.sqrt((q * q).sum(1))[:, None]
        return np.column_stack((q / length * np.sqrt(self.norm), np.zeros(len(q))))


def assigned(rows: DataFrame, index: Index, queries: bool) -> DataFrame:
    """``list_id, vec_id, v``: the lists a vector is stored in, or those a query visits."""
    ratio, most = (PROBE_RATIO, BEAM) if queries else (REPLICA_RATIO, REPLICAS)

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            for low in range(0, len(x), 1024):
                own = x[low : low + 1024]
                place = index.aimed(own) if queries else index.lifted(own)
                ids, dist = graph_search(place, index.centroids, index.links, BEAM if queries else 32)
                near = np.isfinite(dist) & (dist <= dist[:, :1] * ratio)
                near[:, most:] = False
                if queries:
                    # A query right at a centroid would else see that one list only, and too few vectors.
                    near[:, :LEAST_LISTS] = np.isfinite(dist[:, :LEAST_LISTS])
                at, column = np.nonzero(near)
                part = batch.slice(low, len(own)).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at, column], pa.int64()), part.column(0), part.column(1)], names=["list_id", "vec_id", "v"]
                )

    return rows.select("vec_id", "v").mapInArrow(run, "list_id long, vec_id long, v array<double>")


def blocked(lists: DataFrame, size: int) -> DataFrame:
    """``list_id, ids, vs``: each list in blocks of about ``size`` vectors."""
    lengths = lists.groupBy("list_id").agg(F.count("*").alias("n"))
    salt = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / size).cast("long"))
    return (
        lists.join(lengths, "list_id")
        .withColumn("salt", salt)
        .groupBy("list_id", "salt")
        .agg(F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias("rows"))
        .select("list_id", F.col("rows.vec_id").alias("ids"), F.col("rows.v").alias("vs"))
    )


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, each summed from the first component on, whatever block it is computed in."""
    out = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        out += a[:, d, None] * b[None, :, d]
    return out


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose vec_id is divisible by ``every`` its k nearest others."""
    rows = stored(usable(vectors, k), "vectors")
    most = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), "n").first()
    if most is not None:
        rows = rows.filter(F.size("v") == most["n"])
    index = Index(rows)
    result = "query_id long, rank int, vec_id long, score double"
    if not index.n:
        return rows.sparkSession.createDataFrame([], result)
    kept = stored(thinned(rows, k), "candidates")
    stored_lists = stored(assigned(kept, index, queries=False), "posting-lists")
    asked = stored(assigned(rows.filter(F.col("vec_id") % every == 0), index, queries=True), "visited-lists")
    # Merged, never broadcast: a query's vector lies in the file once for each list it visits, and so takes hardly any room there;
    # by the file's size Spark would send all visits to the driver.
    blocks = blocked(stored_lists, BLOCK).hint("merge").join(
        blocked(asked, BLOCK // 2).withColumnsRenamed({"ids": "query_ids", "vs": "query_vs"}), "list_id"
    )

    def run(batches):
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(("ids", "vs", "query_ids", "query_vs"))}
            for i in range(batch.num_rows):
                ids = np.asarray(columns["ids"][i].values)
                query_ids = np.asarray(columns["query_ids"][i].values)
                scores = inner_products(matrix(columns["query_vs"][i].values), matrix(columns["vs"][i].values))
                scores[query_ids[:, None] == ids] = -np.inf
                order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                top = np.take_along_axis(scores, order, 1).ravel()
                good = np.isfinite(top)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, order.shape[1])[good]),
                        pa.array(ids[order].ravel()[good]),
                        pa.array(top[good]),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    found = (
        blocks.select("ids", "vs", "query_ids", "query_vs")
        .mapInArrow(run, "query_id long, vec_id long, score double")
        # A vector stored in several visited lists is found several times; of rows that share an id the nearest counts.
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
