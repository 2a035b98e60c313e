"""Exact top-k search by inner product in three phases with a uniform threshold.

A vector's components are cut into groups; each group ranks all candidates by its own part of the score.
Phase 1 takes the leaders of these lists and gives each query a safe cutoff. Phase 2 spreads the cutoff
evenly over the lists: a candidate under its share in every list cannot reach it, one over it in some
list is kept while the rest of its score could still do so. Phase 3 resolves what is left exactly.
Queries meet all candidates, both in blocks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.plans.stages import stage

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
LISTS = 4
_AT_ONCE = 128
_EXACT = float(1 << 53)
PACKED = "block long, ids binary, dims long, vectors binary"


def quantized(vector: Column | str) -> Column:
    """floor(256 * x) of each component, NULL for vectors that are NULL or hold NULL, NaN or infinity.

    A component of 2^55 and more has no such whole number of 64 bits; its vector is NULL too.
    """
    values = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 55)))
    return F.when(usable, F.transform(values, lambda x: F.floor(x * 256).cast("long")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "vector",
          candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with other rows.

    ``vector`` holds integers. Ties go to the smaller vec_id; fewer candidates than k give fewer rows.
    Rows with a NULL id or vector take no part; an id that repeats counts once, with its smallest vector;
    a query is never its own result. Shorter vectors count as filled up with zeros, empty ones score 0.
    Scores must fit 64 bits. Where sums of products may pass 2^53, bounds are widened by what doubles can be off, and
    scores are computed in whole numbers.

    A block sends k rows per query at most, so neither many equal vectors nor a loose cutoff can grow
    what a query's results are picked from beyond k for each block.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("q")).where(
        "id IS NOT NULL AND v IS NOT NULL"
    )
    unique = stage(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")), "topk_rows", n=F.count("*"), q=F.count_if("q"))
    blocks = max(1, -(-unique.measured["n"] // candidate_block))
    query_blocks = max(1, -(-unique.measured["q"] // query_block))
    candidates = stage(_packed(unique.table, blocks), "topk_candidates").table
    queries = stage(_packed(unique.table.where("q"), query_blocks), "topk_queries").table

    # Every query block meets every candidate block: rows of a whole block each.
    left = candidates.withColumn("query_block", _each(query_blocks))
    right = queries.select(F.col("block").alias("query_block"), _each(blocks).alias("block"),
                           F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("vectors").alias("q_vectors"))

    def leaders(candidate: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        found = []
        for q_ids, ids, parts, slack, _ in _scores(candidate, query, lists):
            total = parts.sum(axis=0)
            own = q_ids[:, None] == ids[None, :]
            lead = np.zeros(total.shape, bool)
            for part in parts:
                at = np.argpartition(np.where(own, np.inf, -part), min(k, part.shape[1]) - 1, axis=1)[:, :k]
                np.put_along_axis(lead, at, True, axis=1)
            known = np.where(lead & ~own, total, -np.inf)
            kth = -np.sort(-known, axis=1)[:, k - 1] if known.shape[1] >= k else np.full(len(q_ids), -np.inf)
            kth, tops = kth - slack, parts.max(axis=2) + slack
            found.append(pd.DataFrame({"query_id": q_ids, "cutoff": kth, **{f"top{g}": tops[g] for g in range(lists)}}))
        return pd.concat(found) if found else pd.DataFrame(columns=["query_id", "cutoff", *[f"top{g}" for g in range(lists)]])

    tops = [f"top{g}" for g in range(lists)]
    by = ["query_block", "block"]
    pairs = left.groupBy(*by).cogroup(right.groupBy(*by))
    first = pairs.applyInPandas(leaders, "query_id long, cutoff double, " + ", ".join(f"{t} double" for t in tops))
    cutoffs = first.groupBy("query_id").agg(F.max("cutoff").alias("cutoff"), *[F.max(t).alias(t) for t in tops])
    ids = unique.table.where("q").select(F.col("id").alias("query_id")).distinct()
    bounded = stage(
        ids.join(cutoffs, "query_id").withColumn("query_block", _block(F.col("query_id"), query_blocks)).groupBy("query_block").agg(
            F.sort_array(F.collect_list(F.struct("query_id", "cutoff", *tops))).alias("bounds")
        ),
        "topk_cutoffs",
    ).table
    with_bounds = queries.join(bounded, queries["block"] == bounded["query_block"]).select(
        "query_block", _each(blocks).alias("block"), F.col("ids").alias("q_ids"),
        F.col("dims").alias("q_dims"), F.col("vectors").alias("q_vectors"), *[F.col(f"bounds.{c}").alias(f"b_{c}") for c in ["query_id", "cutoff", *tops]],
    )

    def resolve(candidate: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        found = []
        bounds = query.iloc[0] if len(query) else None
        for q_ids, ids, parts, off, exact in _scores(candidate, query, lists):
            at = np.searchsorted(bounds["b_query_id"], q_ids)
            cutoff = np.asarray(bounds["b_cutoff"], float)[at]
            most = np.array([np.asarray(bounds[f"b_{t}"], float)[at] for t in tops])
            slack = np.where(np.isfinite(cutoff), (most.sum(axis=0) - cutoff) / lists, np.inf)
            share = (most - slack)[:, :, None]
            over = parts >= share - off
            seen = over.any(axis=0) | ~np.isfinite(cutoff)[:, None]
            could = np.where(over, parts, np.minimum(share, most[:, :, None])).sum(axis=0) + 1e-6 + lists * off
            open_ = seen & ((could >= cutoff[:, None]) | ~np.isfinite(cutoff)[:, None]) & (q_ids[:, None] != ids[None, :])
            q, c = np.nonzero(open_)
            score = exact(q, c)
            kept = score >= cutoff[q] - off
            q, c, score = q[kept], c[kept], score[kept]
            order = np.lexsort((ids[c], -score, q))
            q, c, score = q[order], c[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            best = place < k
            found.append(pd.DataFrame({"query_id": q_ids[q[best]], "vec_id": ids[c[best]], "score": score[best]}))
        return pd.concat(found) if found else pd.DataFrame(columns=["query_id", "vec_id", "score"])

    rest = left.groupBy(*by).cogroup(with_bounds.groupBy(*by)).applyInPandas(resolve, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rest.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block(vec_id: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(vec_id), F.lit(blocks)).cast("long")


def _each(blocks: int) -> Column:
    """One row for every block number."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    """PACKED: vectors as the rows of one matrix per block."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        dims = max(map(len, part["v"]))
        matrix = np.zeros((len(part), dims), np.int64)
        for i, values in enumerate(part["v"]):
            matrix[i, : len(values)] = values
        return pd.DataFrame({
            "block": [part["block"].iloc[0]], "ids": [part["id"].to_numpy(np.int64).tobytes()], "dims": [dims], "vectors": [matrix.tobytes()],
        })

    return rows.select("id", "v", _block(F.col("id"), blocks).alias("block")).groupBy("block").applyInPandas(pack, PACKED)


def _scores(candidate: pd.DataFrame, query: pd.DataFrame, lists: int):
    """Some queries at a time: their ids, candidate ids, the score parts (list, query, candidate) as doubles, how far
    these may be off, and a function that gives the whole scores of (query, candidate) pairs."""
    if candidate.empty or query.empty:
        return
    c, q = candidate.iloc[0], query.iloc[0]
    ids, q_ids = np.frombuffer(c["ids"], np.int64), np.frombuffer(q["q_ids"], np.int64)
    dims = max(int(c["dims"]), int(q["q_dims"]), 1)
    left = np.zeros((len(ids), dims), np.int64)
    left[:, : c["dims"]] = np.frombuffer(c["vectors"], np.int64).reshape(len(ids), c["dims"])
    right = np.zeros((len(q_ids), dims), np.int64)
    right[:, : q["q_dims"]] = np.frombuffer(q["q_vectors"], np.int64).reshape(len(q_ids), q["q_dims"])
    floats, q_floats = left.astype(float), right.astype(float)
    largest = np.abs(floats).max(initial=0) * np.abs(q_floats).max(initial=0) * dims
    off = 0.0 if largest < _EXACT else largest * (dims + 4) * 2.0**-52
    groups = [g for g in np.array_split(np.arange(dims), lists)]
    for i in range(0, len(q_ids), _AT_ONCE):
        parts = np.array([q_floats[i : i + _AT_ONCE, g] @ floats[:, g].T for g in groups])

        def exact(some: np.ndarray, of: np.ndarray, first: int = i, parts: np.ndarray = parts) -> np.ndarray:
            if not off:
                return parts[:, some, of].sum(axis=0).astype(np.int64)
            # What wraps around on the way comes back if the sum fits.
            cuts = range(0, len(some), 1 << 14)
            found = [(right[first + some[j : j + (1 << 14)]] * left[of[j : j + (1 << 14)]]).sum(axis=1) for j in cuts]
            return np.concatenate([np.zeros(0, np.int64), *found])

        yield q_ids[i : i + _AT_ONCE], ids, parts, off, exact
