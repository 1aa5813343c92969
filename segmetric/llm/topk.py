"""Exact top-k search by inner product, one block of documents at a time.

Vectors are sorted by id into blocks; a block keeps its vectors (the forward index) and the
greatest and least value of every component. A query's bound for a block is the sum over
components of the greater product with those two. Blocks are scored in the order of their
bounds until the next bound lies below the query's k-th score; a bound equal to it is still
scored, for ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.llm.common import written

#: Vectors of a block, blocks of a stripe (one task's unit) and queries of a chunk.
BLOCK = 512
STRIPE = 16
CHUNK = 512


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): components floor(scale * x), x as double, of the usable vectors."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.size("v") > 0).where(~bad)
            .select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("long")).alias("v")))


def _pack(most: int):
    """Rows (vec_id, dim, v) sorted by dim and id -> packs of at most ``most`` vectors of one dim."""
    schema = pa.schema([("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("vals", pa.list_(pa.int64()))])

    def out(dim, ids, vals):
        flat = np.concatenate(vals)
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                                           pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))],
                                          schema=schema)

    def run(batches: Iterator[pa.RecordBatch]):
        now, ids, vals = None, [], []
        for b in batches:
            off = b.column("v").offsets.to_numpy()
            flat = b.column("v").values.to_numpy(zero_copy_only=False)
            dims = b.column("dim").to_pylist()
            for i, vec_id in enumerate(b.column("vec_id").to_pylist()):
                if ids and (dims[i] != now or len(ids) == most):
                    yield out(now, ids, vals)
                    ids, vals = [], []
                now = dims[i]
                ids.append(vec_id)
                vals.append(flat[off[i]:off[i + 1]].copy())
        if ids:
            yield out(now, ids, vals)

    return run


def _better(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def block_max_search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
                     block: int = BLOCK) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Scores and ids of each query's k best vectors, and how many (query, block) pairs were scored."""
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * vectors.shape[1] < 2.0 ** 52
    kind = np.float64 if exact else np.int64  # float64 products are exact below 2**53
    q = queries.astype(kind)
    cuts = list(range(0, len(ids), block))
    forward = [vectors[c:c + block].astype(kind) for c in cuts]
    high = np.array([f.max(axis=0) for f in forward])
    low = np.array([f.min(axis=0) for f in forward])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    best_s = [np.empty(0, dtype=kind) for _ in query_ids]
    best_i = [np.empty(0, dtype=np.int64) for _ in query_ids]
    live = np.arange(len(query_ids))
    scored = 0
    for r in range(len(cuts)):
        nxt = order[live, r]
        kth = np.array([best_s[j][-1] if len(best_s[j]) == k else -np.inf for j in live])
        live = live[bound[live, nxt] >= kth]
        if not len(live):
            break
        nxt = order[live, r]
        for b in np.unique(nxt):
            who = live[nxt == b]
            scores = q[who] @ forward[b].T
            at = ids[cuts[b]:cuts[b] + block]
            scored += len(who)
            for row, j in enumerate(who):
                s = scores[row]
                if len(best_s[j]) == k:
                    keep = np.flatnonzero((s >= best_s[j][-1]) & (at != query_ids[j]))
                else:
                    keep = np.flatnonzero(at != query_ids[j])
                if not len(keep):
                    continue
                s_all, i_all = np.concatenate([best_s[j], s[keep]]), np.concatenate([best_i[j], at[keep]])
                top = _better(s_all, i_all, k)
                best_s[j], best_i[j] = s_all[top], i_all[top]
    return best_s, best_i, scored


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(col, i, dim):
        off = col.offsets.to_numpy()
        return col.values.to_numpy(zero_copy_only=False)[off[i]:off[i + 1]].reshape(-1, dim)

    def run(batches):
        for b in batches:
            for i, dim in enumerate(b.column("dim").to_pylist()):
                q_ids, ids = matrix(b.column("q_ids"), i, 1)[:, 0], matrix(b.column("ids"), i, 1)[:, 0]
                s, v, _ = block_max_search(matrix(b.column("q_vals"), i, dim), q_ids,
                                           matrix(b.column("vals"), i, dim), ids, k)
                n = [len(x) for x in v]
                chunk = b.column("chunk")[i].as_py()
                rows = chunk * CHUNK + np.arange(len(q_ids))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q_ids, n)), pa.array(np.repeat(rows, n)), pa.array(np.concatenate(v)),
                    pa.array(np.concatenate(s).astype(np.int64))], schema=schema)

    return run


def exact_top_k(df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding",
                scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of greatest integer inner product for every
    row whose id is divisible by ``every``; ties go to the smaller id.

    Null vectors, empty ones and those with null or non-finite components take no part, nor
    do rows with null id. Every row is a candidate, so repeated rows take several ranks. A
    query meets vectors of its own length only, never rows of its own id; with fewer candidates
    than k all are given. Repeated query rows are asked once; several vectors under one query
    id are separate queries under that id, ranked each for itself. Scores must fit 64 bits. An empty table gives an empty result.
    """
    base = integer_vectors(df, id_col, vec_col, scale).groupBy("vec_id", "v").agg(F.count("*").alias("copies")).withColumn(
        "dim", F.size("v"))
    cast = "dim int, ids array<long>, vals array<long>"
    # of equal rows no more than k can be among the k best
    candidates = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    sorted_rows = candidates.repartitionByRange("dim", "vec_id").sortWithinPartitions("dim", "vec_id")
    stripes = written(sorted_rows.select("vec_id", "dim", "v").mapInArrow(_pack(BLOCK * STRIPE), cast), "stripes")
    asked = base.where(F.col("vec_id") % every == 0)
    chunks = (asked.repartitionByRange("dim", "vec_id").sortWithinPartitions("dim", "vec_id")
              .select("vec_id", "dim", "v").mapInArrow(_pack(CHUNK), cast)
              .select("dim", F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals")))
    named = written(chunks.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    # every chunk meets every stripe of its dimension: the stated query set against all rows, in blocks
    per_dim = named.groupBy("dim").agg(F.collect_list("chunk").alias("all"))
    pairs = (stripes.join(per_dim, "dim").select("dim", "ids", "vals", F.explode("all").alias("chunk"))
             .join(named.select("chunk", "q_ids", "q_vals"), "chunk"))
    meet = pairs.repartition(F.xxhash64("chunk", F.col("ids")[0])).select("dim", "chunk", "ids", "vals", "q_ids", "q_vals")
    found = meet.mapInArrow(_search(k), "query_id long, query_row long, vec_id long, score long")
    by = Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
