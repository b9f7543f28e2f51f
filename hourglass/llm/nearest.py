"""Nearest neighbours by a block matrix join (operator 8).

Queries and candidates are cut into blocks. A task holds one block of queries
and meets candidate blocks one after the other; each meeting is a tile. In a
tile, vectors are int8 with a scale of their own, and the product of the two
int8 matrices gives each inner product up to a proven error: with
x = s (q + e), |e| <= 1/2 in every component,

    |x.y - s t q.r| <= s t (|q|_1 / 2 + |r|_1 / 2 + dim / 4).

A pair whose upper bound is below the query's k-th best so far (or the k-th
largest lower bound in the tile) can't be among the k nearest; all others are
recomputed in double precision on the original vectors. Each task keeps a
heap of k per query, and the tasks' heaps are merged per query at the end. So
the result is exact: the quantisation only decides what is recomputed.

Every vector is compared with every query, as the task sets it, in cells of a
query block and a slice of the candidates: rows are dealt out by hash, once to
each cell that needs them, so that hot vectors spread and no cell grows with
the input. Broadcast are only the counts per vector length, size-checked.

Defined cases: vectors that are null or empty, zero, or hold a null or
non-finite component take no part, neither as query nor as candidate; vectors
of different length are not compared; rows with a null id take no part; equal
scores go to the smaller id, and repeated ids are separate candidates (a
query's own id is never its neighbour) but one query, the one of the smallest vector;
a query without candidates has no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.operators.joins import bounded_broadcast

K = 20
#: Queries in a block: a task holds their vectors, and a heap of K for each.
QUERY_BLOCK = 8192
#: Candidates that meet a block of queries in one task, about.
SLICE = 8192
#: Candidates and queries in a tile.
TILE, TILE_QUERIES = 512, 2048


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles, dim) of the vectors that take part."""
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    df = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)) \
        .withColumn("dim", F.size("v"))


def int8(x):
    """Scale and int8 values of each row; float32 holds them exactly."""
    import numpy as np
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = np.finfo("f8").tiny  # the largest component underflows
    return scale, np.clip(np.rint(x / scale[:, None]), -127, 127).astype("f4")


def tile_product(q, c):
    """Inner products of int8 rows, exact: float32 sums stay whole up to 2**24."""
    import numpy as np
    out = np.zeros((len(q), len(c)))
    for d in range(0, q.shape[1], 1024):
        out += q[:, d:d + 1024] @ c[:, d:d + 1024].T
    return out


def inner(a, b):
    """Row-wise inner products in double precision, summed from the first component on."""
    import numpy as np
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


class Heaps:
    """The k best (score, smaller id first) candidates of each query of a block."""

    def __init__(self, ids, vectors, k: int):
        import numpy as np
        self.ids, self.x, self.k = ids, vectors, k
        self.scale, self.q = int8(vectors)
        self.norm1 = np.abs(self.q).sum(1).astype("f8")
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def meet(self, ids, x) -> None:
        """A block row: tiles of this block's queries with these candidates."""
        scale, c = int8(x)
        norm1 = abs(c).sum(1).astype("f8")
        for lo in range(0, len(self.ids), TILE_QUERIES):
            self._tile(slice(lo, lo + TILE_QUERIES), ids, x, scale, c, norm1)

    def _tile(self, at: slice, ids, x, scale, c, norm1) -> None:
        import heapq

        import numpy as np
        scales = np.outer(self.scale[at], scale)
        near = tile_product(self.q[at], c) * scales
        error = scales * (self.norm1[at, None] / 2 + norm1[None, :] / 2 + x.shape[1] / 4)
        error += error * 1e-9 + np.abs(near) * 1e-9  # rounding of the bounds themselves
        own = self.ids[at, None] == ids[None, :]
        floor = self.floor[at]
        if len(ids) > self.k:
            lower = np.where(own, -np.inf, near - error)
            floor = np.maximum(floor, np.partition(lower, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        rows, cols = np.nonzero((near + error >= floor[:, None]) & ~own)
        rows += at.start
        for some in range(0, len(rows), 1 << 17):
            r, j = rows[some:some + (1 << 17)], cols[some:some + (1 << 17)]
            for i, v, score in zip(r.tolist(), ids[j].tolist(), inner(self.x[r], x[j]).tolist()):
                heap, entry = self.heaps[i], (score, -v)
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        for i in np.unique(rows).tolist():
            if len(self.heaps[i]) == self.k:
                self.floor[i] = self.heaps[i][0][0]


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           query_block: int = QUERY_BLOCK, slice_rows: int = SLICE, tile: int = TILE) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest by inner product of each
    row for which ``is_query`` (over the column ``id``) holds."""
    vectors = usable(df, id_col, vector_col).withColumn("asks", is_query)
    counts = vectors.groupBy("dim").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("asks") / query_block)).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("slices"))
    counts = bounded_broadcast(counts)  # a row per vector length
    hashed = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # Queries go to all slices of their block, candidates to all blocks of their slice.
    rows = vectors.join(counts, "dim")
    once = rows.filter("asks").groupBy("id", "dim", "blocks", "slices").agg(F.min("v").alias("v")).withColumn("asks", F.lit(True))
    queries = once.withColumn("block", hashed(1, "blocks")).withColumn("slice", each("slices"))
    candidates = rows.withColumn("asks", F.lit(False)).withColumn("slice", hashed(2, "slices")) \
        .withColumn("block", each("blocks"))
    cells = queries.unionByName(candidates).select("id", "v", "dim", "block", "slice", "asks") \
        .repartition("dim", "block", "slice").sortWithinPartitions("dim", "block", "slice", F.desc("asks"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        at, asking, heaps, waiting = None, [], None, []

        def tiles(rest: bool):
            nonlocal waiting
            while waiting and (rest or sum(len(i) for i, _ in waiting) >= tile):
                ids, x = np.concatenate([i for i, _ in waiting]), np.concatenate([x for _, x in waiting])
                for lo in range(0, len(ids), tile):
                    if rest or lo + tile <= len(ids):
                        heaps.meet(ids[lo:lo + tile], x[lo:lo + tile])
                done = len(ids) if rest else len(ids) // tile * tile
                waiting = [(ids[done:], x[done:])] if done < len(ids) else []

        def result():
            if heaps is None:
                return
            tiles(True)
            found = [(q, -j, s) for q, h in zip(heaps.ids.tolist(), heaps.heaps) for s, j in h]
            if found:
                q, j, s = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(j, pa.int64()),
                                                  pa.array(s, pa.float64())], names=["query_id", "id", "score"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            cell = np.stack([batch.column(i).to_numpy() for i in (2, 3, 4)], 1)
            asks = batch.column(5).to_numpy(zero_copy_only=False)
            flat, ends = batch.column(1).flatten().to_numpy(), batch.column(1).offsets.to_numpy()
            ends = ends - ends[0]
            cuts = np.flatnonzero(np.any(cell[1:] != cell[:-1], 1) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if lo == hi:
                    continue
                here = tuple(cell[lo].tolist())
                x = flat[ends[lo]:ends[hi]].reshape(hi - lo, -1)
                if here != at:
                    yield from result()
                    at, asking, heaps, waiting = here, [], None, []
                if asks[lo]:
                    asking.append((ids[lo:hi], x))
                elif asking or heaps is not None:
                    if heaps is None:
                        heaps = Heaps(np.concatenate([i for i, _ in asking]), np.concatenate([v for _, v in asking]), k)
                        asking = []
                    waiting.append((ids[lo:hi], x))
                    tiles(False)
        yield from result()

    found = cells.mapInArrow(run, "query_id long, id long, score double")
    # A query's heaps: at most k from each slice.
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("id") % 20 == 0) \
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
             vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
