"""Exact top-k by inner product: columnar branch and bound over blocks of dimensions.

Vectors are turned into whole numbers, floor(scale * x). Candidates lie in vertical layout (a
row of the array is a dimension). For each query, partial scores grow dimension block by
dimension block; what the remaining dimensions can still add is bounded by the product of the
remaining masses (Cauchy-Schwarz). A candidate whose partial score and bound stay below the
k-th best known score is dropped and the rest is compacted, until all dimensions are in.

Queries and candidates are dealt into blocks of bounded size; each (query block, candidate
block) pair is one group of a shuffle, and each query keeps its k best of every block.

Cases: vectors that are null, empty or hold null or non-finite components, and rows without id,
take no part; scores beyond a long count as the nearest long; vectors of another length are no candidates; rows with the query's own id are
never its candidates; an id that appears on several rows is a query and a candidate for each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnia.llm.common import ready

QUERY_BLOCK = 2_048
CANDIDATE_BLOCK = 16_384
DIMENSIONS = 16  # at a time
EXACT = float(1 << 52)


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null if the vector takes no part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.when(good & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def branch_and_bound(query: np.ndarray, columns: np.ndarray, rest: list[np.ndarray], allowed: np.ndarray, ids: np.ndarray, k: int, at_least: float):
    """Places and scores of the k best allowed candidates, ties to smaller ids.

    ``columns``: dimension x candidate; ``rest[b]``: each candidate's mass from block b on.
    """
    live, partial = np.flatnonzero(allowed), None
    floor = at_least
    d = len(query)
    masses = np.sqrt(np.append(np.cumsum((query**2)[::-1])[::-1], 0.0))
    for b, start in enumerate(range(0, d, DIMENSIONS)):
        end = min(d, start + DIMENSIONS)
        part = columns[start:end] if len(live) == columns.shape[1] else columns[start:end, live]
        step = query[start:end] @ part
        partial = step if partial is None else partial + step
        if end < d and len(live) > k:
            bound = masses[end] * rest[b + 1][live]
            # the k-th best of what is certain is a floor for the k-th best score
            certain = partial - bound
            floor = max(floor, float(np.partition(certain, -k)[-k]))
            keep = partial + bound + 1e-6 * (1 + np.abs(partial) + bound) >= floor
            if keep.mean() < 0.8:
                live, partial = live[keep], partial[keep]
    if len(live) > k:
        edge = np.partition(partial, -k)[-k]
        near = partial >= edge
        live, partial = live[near], partial[near]
    best = np.lexsort((ids[live], -partial))[:k]
    return live[best], partial[best]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """(query id, vec id, score) of each query's k best among the given vectors."""
    limit = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if limit >= EXACT:  # beyond what floating point holds exactly: whole numbers of any size
        for q, x in zip(query_ids.tolist(), queries.astype(object), strict=True):
            scores = np.clip(vectors.astype(object) @ x, -(1 << 63), (1 << 63) - 1)
            own = [i for i in range(len(ids)) if ids[i] != q]
            for i in sorted(own, key=lambda i: (-scores[i], ids[i]))[:k]:
                yield q, int(ids[i]), int(scores[i])
        return
    columns = np.ascontiguousarray(vectors.T, dtype=np.float64)
    squares = columns**2
    starts = range(0, len(columns), DIMENSIONS)
    rest = [np.sqrt(squares[s:].sum(axis=0)) for s in starts]
    for q, x in zip(query_ids.tolist(), queries.astype(np.float64), strict=True):
        place, score = branch_and_bound(x, columns, rest, ids != q, ids, k, -np.inf)
        for i, s in zip(ids[place].tolist(), score.tolist(), strict=True):
            yield q, i, int(round(s))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows for each row with ``is_query``."""
    ready(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), whole(F.col(column), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    ).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("q").cast("long")).alias("queries")).first()
    nq, nc = 1 + (n["queries"] or 0) // QUERY_BLOCK, 1 + n["all"] // CANDIDATE_BLOCK
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # before any explode, which would number copies
    own = lambda blocks, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dims = F.size("v").alias("dims")
    candidates = rows.select(dims, every(nq).alias("qb"), own(nc, 1).alias("cb"), F.lit(False).alias("q"), "vec_id", "v")
    queries = rows.filter("q").select(dims, own(nq, 2).alias("qb"), every(nc).alias("cb"), F.lit(True).alias("q"), "vec_id", "v")

    def search(key, t):
        dim = key[0].as_py()
        flag = np.asarray(t.column("q").combine_chunks().cast(pa.int8())).astype(bool)
        ids = t.column("vec_id").to_numpy()
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        found = list(search_block(ids[flag], v[flag], ids[~flag], v[~flag], k)) if flag.any() and not flag.all() else []
        a, b, c = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.int64())})

    best = candidates.unionAll(queries).groupBy("dims", "qb", "cb").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
