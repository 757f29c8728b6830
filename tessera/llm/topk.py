"""Exact top-k by inner product: columnar branch and bound.

Candidates are dealt to tiles by a hash of their id and laid out vertically, one
array a dimension. For each query the products are accumulated a block of dimensions
at a time; by Cauchy-Schwarz the dimensions still missing can change a score by at
most the product of the remaining norms, so candidates whose upper bound is below the
k-th best lower bound are compacted away before the next block.

The stated query set is compared with all rows in tiles of bounded size: both sides
are dealt to (candidate tile, query tile) keys, and each tile returns k rows a query at
most. The first candidate tile goes ahead; each query's k-th score in it is a bound from
the start in all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

#: Rows of a candidate tile and of a query tile, and dimensions accumulated at once.
TILE, QUERY_TILE, DIMENSIONS = 8192, 4096, 16
#: Queries whose first block is multiplied at once.
BATCH = 64
#: Sums up to this are exact in doubles.
EXACT = float(1 << 52)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id long, v array<bigint>) with floor(scale * x) for each component x as double.

    Rows with a null id, a null vector, or a vector holding null or non-finite
    components are left out. Repeated rows are rows each.
    """
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def _suffix_norms(rows: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norm of the dimensions from each edge on, a row an edge."""
    squares = rows.astype(np.float64) ** 2
    return np.stack([np.sqrt(squares[:, e:].sum(axis=1)) for e in edges])


def tile_topk(query_rows, queries, rows, ids, vectors, k: int, floors=None, dimensions: int = DIMENSIONS):
    """Triples (query number, row number, score) of each query's k highest inner products in
    the tile, ties to smaller ids. The row that is the query's own (query_rows, rows) is left
    out, as is what cannot reach the query's floor."""
    order = np.lexsort((rows, ids))
    rows, ids, width = rows[order], ids[order], vectors.shape[1]
    edges = list(range(0, width, dimensions)) or [0]
    high = [np.abs(m.astype(np.float64)).max(initial=0) for m in (queries, vectors)]
    kind = np.float64 if high[0] * high[1] * max(width, 1) < EXACT else object
    columns = np.ascontiguousarray(vectors[order].T.astype(kind))
    rest, query_rest = _suffix_norms(vectors[order], [*edges, width]), _suffix_norms(queries, [*edges, width])
    queries = queries.astype(kind)
    for start in range(0, len(queries), BATCH):
        first = queries[start : start + BATCH, :dimensions] @ columns[:dimensions]
        for at in range(start, min(start + BATCH, len(queries))):
            floor = -np.inf if floors is None else floors[at]
            alive = np.flatnonzero(rows != query_rows[at])
            sums = first[at - start][alive]
            for b, edge in enumerate(edges):
                if b:
                    sums = sums + queries[at, edge : edge + dimensions] @ columns[edge : edge + dimensions, alive]
                slack = query_rest[b + 1, at] * rest[b + 1, alive]
                slack = slack + 1e-9 * slack
                least = floor
                if len(alive) > k:
                    least = max(floor, np.partition(sums - slack, len(alive) - k)[len(alive) - k])
                hold = sums + slack >= least
                alive, sums = alive[hold], sums[hold]
            best = np.lexsort((rows[alive], ids[alive], -sums))[:k]
            for i in best:
                yield at, int(order[alive[i]]), int(sums[i])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _matrix(table: pa.Table) -> np.ndarray:
    vectors = table.column("v").combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks)
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 10, tile: int = TILE, query_tile: int = QUERY_TILE) -> DataFrame:
    """(query_id, rank int from 1, vec_id, score) for rows (id, v) of integer_vectors; other
    columns serve is_query only.

    Every row but the query's own is a candidate, rows that repeat its id or all of it
    included; rows repeated in full take a place each. Each query row is a query: an id that
    stands in two of them has its ranks twice. A query with fewer candidates gets all of
    them, one without any gets no row. Only vectors of equal length are compared. Scores
    are exact as long as they fit a long. An empty table gives an empty result.
    """
    numbered = vectors.select("id", "v", is_query.alias("asks"), F.size("v").alias("width"), F.monotonically_increasing_id().alias("row"))
    numbered = staged(numbered, "vectors")
    n, n_queries = numbered.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    tiles, query_tiles = max(1, -(-n // tile)), max(1, -(-n_queries // query_tile))
    dealt = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    every = lambda low, count: F.explode(F.sequence(F.lit(low), F.lit(count - 1)))
    queries = staged(numbered.where("asks").withColumn("query_tile", dealt(query_tiles)), "queries")
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        asking, asked, rows, ids = _column(left, "row"), _column(left, "id"), _column(right, "row"), _column(right, "id")
        found = list(tile_topk(asking, _matrix(left), rows, ids, _matrix(right), k, _column(left, "floor")))
        at, place, score = np.array(found, object).reshape(-1, 3).T
        at, place = at.astype(np.int64), place.astype(np.int64)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (asking[at], asked[at], rows[place], ids[place], list(score))], schema=schema)

    def search(asking: DataFrame, low: int, high: int) -> DataFrame:
        """The queries (with their floors) against candidate tiles low to high - 1."""
        key = ["width", "tile", "query_tile"]
        left = asking.withColumn("tile", every(low, high)).select(*key, "row", "id", "v", "floor")
        right = numbered.withColumn("tile", dealt(tiles)).where(F.col("tile").between(low, high - 1)).withColumn("query_tile", every(0, query_tiles)).select(*key, "row", "id", "v")
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint")

    best = search(queries.withColumn("floor", F.lit(float("-inf"))), 0, 1)
    if tiles > 1:
        best = staged(best, "first_tile")
        # a query's rows in one tile are k at most, so its lowest is a bound once it has k
        floors = best.groupBy(F.col("query_row").alias("row")).agg(F.count("*").alias("held"), F.min("score").cast("double").alias("floor"))
        bounded = queries.join(floors.where(F.col("held") >= k).drop("held"), "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        best = best.unionByName(search(bounded, 1, tiles))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
