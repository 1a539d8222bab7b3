"""Exact top-k search by inner product with norm buckets.

Vectors are grouped by length. Within a bucket of lengths up to L, a query q whose k-th best score so far is s only wants
vectors with a cosine of at least ``s / (|q| L)``. By this local threshold each query picks its pruning for the bucket:
none of it is wanted (threshold over 1), all of its vectors long enough (a low threshold), or those whose coordinates lie
in the feasible ranges of the query's largest coordinates (a high one). What is left is verified by products.

The floor also prunes before anything is shuffled: no query goes to a bucket whose longest vector is too short for it, and no
vector to a block of queries for which it is too short. A bucket is dealt to blocks of bounded size, as are the queries; each pair of blocks is a task's unit of work, so a length
that all vectors share is no hot spot. First every query meets one block of the longest vectors, which gives its ``s``; these are
the vectors of as many of the longest buckets as hold a thousand, so a few that are far longer than the rest take no floor away.
Each unit returns at most k rows a query, so the last shuffle is small.

Vectors that are null or hold null or non-finite components take no part, and empty ones neither. Only vectors of equal
dimension are compared. Ties go to smaller ids; repeated
candidates count each, a repeated query once. A row without an id is no candidate and no query.
Scores are exact; scores and components beyond 64 bits saturate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import stored

#: Most vectors of a block of candidates, most queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
#: Blocks of candidates to aim for at least, so that a small table uses all cores.
LEAST_BLOCKS, LEAST_ROWS = 64, 256
#: Local thresholds from which coordinates prune better than lengths, and how many coordinates are used.
COORDINATE_COSINE, COORDINATES = 0.8, 4
#: Ratio of the longest to the shortest vector of a bucket.
BUCKET_RATIO = 1.1
#: Vectors of the longest buckets, at least, from which the blocks are formed that queries meet first.
SEED_ROWS = 1024
_WIDEST = 2.0**26
#: What names a unit of work: dimension, bucket, block of the bucket, block of queries.
UNIT = ["d", "bucket", "block", "asked"]


def quantised(column: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; null where the vector takes no part."""
    fine = F.forall(F.col(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine & (F.size(column) > 0), F.transform(F.col(column), lambda x: F.floor(x.cast("double") * scale).cast("double")))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows, as integers; those beyond 64 bits saturate."""
    if max(np.abs(q).max(initial=0), np.abs(c).max(initial=0)) <= _WIDEST / max(1, q.shape[1]) ** 0.5:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(a, b)) for b in c] for a in q], object).reshape(len(q), len(c))
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of(q: np.ndarray, q_ids: np.ndarray, at_least: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> list[tuple]:
    """(query, id, score) of each query's k best candidates in a block that can reach ``at_least``."""
    q_length, c_length = np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))
    order = np.argsort(-c_length, kind="stable")
    c, c_ids, c_length = c[order], c_ids[order], c_length[order]
    longest = c_length[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(at_least > 0, at_least * (1 - 1e-9) / (q_length * longest), -1.0)
    wanted = local <= 1
    by_coordinate = wanted & (local >= COORDINATE_COSINE)
    out: list[tuple] = []

    def verify(i: int, scores: np.ndarray, which: np.ndarray) -> None:
        keep = (scores >= at_least[i]) & (which != q_ids[i])
        scores, which = scores[keep], which[keep]
        if len(scores) > k:
            far = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, which = scores[far], which[far]
        for j in np.lexsort((which, -scores))[:k]:
            out.append((int(q_ids[i]), int(which[j]), int(scores[j])))

    by_length = np.flatnonzero(wanted & ~by_coordinate)
    if len(by_length):
        # Vectors too short for every such query are left out; the product of the rest is one matrix product.
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(at_least[by_length] > 0, at_least[by_length] * (1 - 1e-9) / q_length[by_length], 0).min()
        n = int(np.searchsorted(-c_length, -shortest, side="right"))
        for low in range(0, len(by_length), 256):
            part = by_length[low : low + 256]
            for i, scores in zip(part, _products(q[part], c[:n])):
                verify(i, scores, c_ids[:n])
    if by_coordinate.any():
        unit = c / np.maximum(c_length, 1e-300)[:, None]
        ranked = np.argsort(unit, axis=0, kind="stable")
        values = np.take_along_axis(unit, ranked, axis=0)
        for i in np.flatnonzero(by_coordinate):
            direction, t = q[i] / q_length[i], float(local[i])
            seen = np.zeros(len(c), np.int8)
            chosen = np.argsort(-np.abs(direction), kind="stable")[:COORDINATES]
            for f in chosen:
                x = float(direction[f])
                spread = np.sqrt(max(0.0, 1 - t * t) * max(0.0, 1 - x * x))
                low = -1.0 if x < 0 and -x >= t or x <= -t else x * t - spread
                high = 1.0 if x >= t else x * t + spread
                a, b = np.searchsorted(values[:, f], low - 1e-9), np.searchsorted(values[:, f], high + 1e-9, side="right")
                seen[ranked[a:b, f]] += 1
            place = np.flatnonzero(seen == len(chosen))
            if len(place):
                verify(i, _products(q[i : i + 1], c[place])[0], c_ids[place])
    return out


def _units(work: DataFrame, k: int) -> DataFrame:
    """Best rows of each unit of work: rows (d, bucket, block, asked, query, id, v, at_least), where the rows of a unit, which the
    first four name, lie together."""

    def solve(rows: list[tuple]) -> list[tuple]:
        queries, others = [r for r in rows if r[0]], [r for r in rows if not r[0]]
        if not queries or not others:
            return []
        table = lambda part: np.frombuffer(b"".join(r[2] for r in part), "<f8").reshape(len(part), -1)
        number = lambda part: np.array([r[1] for r in part], np.int64)
        return best_of(table(queries), number(queries), np.array([r[3] for r in queries], np.float64), table(others), number(others), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def made(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            unit = list(zip(*(batch.column(c).to_pylist() for c in range(4))))
            query, number, at_least = (batch.column(c).to_pylist() for c in (4, 5, 7))
            lists = batch.column(6)
            start, flat = lists.offsets.to_numpy(), np.asarray(lists.values.to_numpy(zero_copy_only=False), "<f8")
            for j, u in enumerate(unit):
                if u != last:
                    if found := solve(held):
                        yield made(found)
                    held, last = [], u
                held.append((query[j], number[j], flat[start[j] : start[j + 1]].tobytes(), at_least[j]))
        if found := solve(held):
            yield made(found)

    return work.select(*UNIT, "is_query", "id", "v", "at_least").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(df: DataFrame, vec_id: str, embedding: str, queries: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows. ``queries``: which rows are queries."""
    rows = df.select(F.col(vec_id).cast("long").alias("id"), quantised(embedding, scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.where("v IS NOT NULL AND id IS NOT NULL").withColumn("length", length)
    rows = rows.withColumn("bucket", F.when(F.col("length") > 0, F.floor(F.log(F.col("length")) / F.log(F.lit(BUCKET_RATIO)))).otherwise(-100_000).cast("int"))
    rows = stored(rows.withColumn("d", F.size("v")), "vectors")

    # Components are whole numbers, so lengths other than 0 lie between 1 and 1e308: at most some thousands of buckets a dimension,
    # each a row of the tables below. Spark broadcasts them where their stored size allows it.
    sizes = rows.groupBy("d", "bucket").agg(F.count("*").alias("n"), F.count_if("asks").alias("asking"), F.max("length").alias("most"))
    per_block = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(LEAST_ROWS), F.ceil(F.sum("n").over(Window.partitionBy("d")) / LEAST_BLOCKS)))
    longer = F.coalesce(F.sum("n").over(Window.partitionBy("d").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asked = F.ceil(F.sum("asking").over(Window.partitionBy("d")) / BLOCK_QUERIES)
    plan = sizes.select("*", per_block.alias("per_block"), (longer < SEED_ROWS).alias("seeds"), asked.alias("query_blocks"))
    plan = stored(plan.withColumn("blocks", F.ceil(F.col("n") / F.col("per_block"))), "buckets")
    dims = plan.groupBy("d").agg(F.max("query_blocks").alias("query_blocks"), F.ceil(F.sum(F.when(F.col("seeds"), F.col("n"))) / F.max("per_block")).alias("seed_blocks"))
    asking = rows.where("asks").select("d", "id", "v", "length").dropDuplicates(["id"]).join(dims, "d").withColumn("asked", F.pmod(F.xxhash64("id", F.lit(1)), "query_blocks"))

    def work(candidates: DataFrame, questions: DataFrame) -> DataFrame:
        both = candidates.select(*UNIT, F.lit(False).alias("is_query"), "id", "v", F.lit(None).cast("double").alias("at_least"))
        both = both.union(questions.select(*UNIT, F.lit(True), "id", "v", "at_least"))
        return _units(both.repartition(*UNIT).sortWithinPartitions(*UNIT), k)

    ground = F.lit(-float("inf"))
    # A block of queries first meets one block of the longest vectors: a query's k-th score there is its floor for the others.
    first = asking.select("d", F.lit(0).alias("bucket"), F.pmod("asked", "seed_blocks").alias("block"), "asked", "id", "v", ground.alias("at_least"))
    long = rows.join(plan.where("seeds").select("d", "bucket"), ["d", "bucket"]).drop("bucket").join(dims, "d").withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), "seed_blocks"))
    long = long.where("block < query_blocks").withColumn("asked", F.explode(F.sequence("block", F.col("query_blocks") - 1, "seed_blocks")))
    seed = stored(work(long.withColumn("bucket", F.lit(0)), first), "seed")
    floor = seed.groupBy("query_id").agg(F.count("*").alias("found"), F.min("score").alias("at_least")).where(F.col("found") >= k)
    bound = F.col("at_least").cast("double")
    asking = asking.join(floor.select(F.col("query_id").alias("id"), "at_least"), "id", "left").withColumn("at_least", F.coalesce(bound - F.abs(bound) * 1e-12, ground))
    # A query only goes to buckets in which some length can reach its floor, and only vectors go to a block of queries that are
    # long enough for one of them; a block that no query wants of a bucket is not formed.
    reach = lambda length: F.col("at_least") * (1 - 1e-9) <= F.col("length") * length
    pairs = asking.select("d", "asked", "id", "v", "length", "at_least").join(plan.select("d", "bucket", "blocks", "most"), "d").where(reach(F.col("most")))
    shortest = F.min(F.when(F.col("at_least") > 0, F.when(F.col("length") > 0, F.col("at_least") / F.col("length")).otherwise(F.lit(0.0))).otherwise(F.lit(0.0)))
    each_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    needed = pairs.groupBy("d", "bucket", "blocks", "asked").agg(shortest.alias("shortest"))
    units = stored(needed.select("d", "bucket", "asked", "shortest", each_block.alias("block")), "units")  # a row for each unit of work
    others = rows.join(plan.select("d", "bucket", "blocks"), ["d", "bucket"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    # Vectors meet the blocks of queries by their own block, so no key is larger than a block, and are repeated where they are wanted only.
    wanted = others.join(units, ["d", "bucket", "block"]).where(F.col("length") >= F.col("shortest") * (1 - 1e-9))
    found = work(wanted, pairs.withColumn("block", each_block))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
