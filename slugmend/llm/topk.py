"""Exact top-k search by inner product: norms in descending order, SVD-rotated partial sums.

Vectors become integers, ``floor(1024 x)`` of every component; scores are exact
integer inner products. The bounds that prune are floating point with a
slack for rounding, and every survivor is scored exactly.

1. *Rotation.* The Gram matrix of all vectors (dimension squared, summed by
   Spark) gives the right singular vectors; in their basis the first
   coordinates hold most of every vector's length.
2. *Order.* Vectors are range-partitioned and sorted by descending length and
   packed into chunks of ``CHUNK`` vectors; queries are packed into blocks.
3. *First thresholds.* The chunk of longest vectors (bounded, sent to all
   query blocks) gives every query a k-th best score to start from.
4. *Search.* A chunk meets a query block only if, by Cauchy-Schwarz, longest
   times longest reaches the block's lowest threshold. Inside, runs of
   descending length stop as soon as ``|q| |c|`` falls below; else the partial
   sum over the first coordinates plus the product of the residual lengths
   bounds the score, survivors are scored, and thresholds rise.
5. Each pair of chunk and block returns at most k rows a query; a window per
   query keeps the best k.

Blocks of queries (one in a hundred rows) are copied to the chunks they must
meet, chunks are not moved. Nothing is collected but the Gram matrix and the
first chunk.

Edge cases: a vector that is null, or has a null or non-finite component,
takes no part; vectors of different dimension never meet; repeated rows (same
id and vector) count once; a row's own id is never its result; ties go to the
smaller id; fewer than k candidates give all of them; an empty table gives an
empty result; further columns are ignored. Integer components beyond 2^24
would no longer be exact in double arithmetic and are scored with Python
integers; scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slugmend.llm.common import map_arrow
from slugmend.sources.cuts import materialise

SCALE = 1024
CHUNK = 4096
QUERIES = 512
#: Vectors of one step inside a chunk; thresholds rise between steps.
RUN = 512
#: Parts that the chunks of one dimension are dealt to when they are matched with blocks.
SALTS = 64
#: Share of the squared length that the first coordinates should hold.
HEAD_SHARE = 0.8
#: Components up to which double products and sums are exact at any practical dimension.
EXACT = float(1 << 20)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``dim``, ``v`` (integers as doubles) of the rows that take part."""
    x = F.transform(vector, lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).filter(finite)
        .select("vec_id", F.transform(x, lambda e: F.floor(e * float(SCALE)).cast("double")).alias("v"))
        .distinct()
        .withColumn("dim", F.size("v"))
        .filter(F.col("dim") > 0)
    )


def _matrix(batch: pa.RecordBatch, column: str = "v") -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, part in _by_dim(batch):
            m = _matrix(part)
            sums[d] = sums.get(d, 0) + m.T @ m
    for d, gram in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(gram), pa.list_(pa.float64()))],
            names=["dim", "i", "row"],
        )


def rotations(vectors: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """By dimension: the basis of right singular vectors, and how many coordinates are the head."""
    rows = vectors.transform(map_arrow, _grams, "dim int, i int, row array<double>")
    summed = (
        rows.select("dim", "i", F.posexplode("row").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x")).collect()
    )
    out = {}
    for d in {r["dim"] for r in summed}:
        gram = np.zeros((d, d))
        for r in summed:
            if r["dim"] == d:
                gram[r["i"], r["j"]] = r["x"]
        values, basis = np.linalg.eigh((gram + gram.T) / 2)
        values, basis = np.maximum(values[::-1], 0), basis[:, ::-1]
        held = np.cumsum(values) / max(values.sum(), 1e-300)
        out[d] = (np.ascontiguousarray(basis), int(min(d, np.searchsorted(held, HEAD_SHARE) + 1)))
    return out


def _pack(rows: int):
    """Rows of one partition, in order, packed into blocks: dim, longest length, ids, vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(d: int) -> pa.RecordBatch:
            ids, m = (np.concatenate(x) for x in zip(*waiting.pop(d), strict=True))
            longest = float(np.sqrt((m * m).sum(axis=1)).max())
            return pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([longest]), pa.array([ids.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                names=["dim", "longest", "ids", "vectors"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                for d, part in _by_dim(batch.slice(start, rows)):
                    have = sum(len(i) for i, _ in waiting.get(d, ()))
                    if have + part.num_rows > rows:
                        yield block(d)
                    waiting.setdefault(d, []).append((part.column("vec_id").to_numpy().astype(np.int64), _matrix(part)))
        for d in list(waiting):
            yield block(d)

    return run


_BLOCK = "dim int, longest double, ids binary, vectors binary"


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(vectors, dtype=np.float64).reshape(-1, dim)


def _products(queries: np.ndarray, chunk: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the pairs (q, c)."""
    if max(np.abs(queries).max(), np.abs(chunk).max()) <= EXACT:
        if 20 * len(q) > len(queries) * len(chunk):  # many survivors: one matrix product
            return (queries @ chunk.T)[q, c].astype(np.int64)
        return np.einsum("ij,ij->i", queries[q], chunk[c]).astype(np.int64)
    big = [sum(int(a) * int(b) for a, b in zip(queries[i], chunk[j], strict=True)) for i, j in zip(q, c, strict=True)]
    return np.array(big, dtype=np.int64)


def search(
    queries: np.ndarray, query_ids: np.ndarray, chunk: np.ndarray, ids: np.ndarray, low: np.ndarray,
    basis: np.ndarray, head: int, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of a chunk for each query that can still matter: (query position, chunk position, score).

    ``low``: a score that the k-th best of each query is known to reach.
    """
    none = np.empty(0, dtype=np.int64)
    best_q, best_c, best_s = none, none, none
    low = low.astype(np.float64).copy()
    rq, rc = queries @ basis, chunk @ basis
    q_len, c_len = np.linalg.norm(queries, axis=1), np.linalg.norm(chunk, axis=1)
    q_tail, c_tail = np.linalg.norm(rq[:, head:], axis=1), np.linalg.norm(rc[:, head:], axis=1)
    order = np.argsort(-c_len, kind="stable")
    for start in range(0, len(order), RUN):
        run = order[start : start + RUN]
        reach = q_len * c_len[run[0]] * (1 + 1e-9) + 1
        live = np.flatnonzero(reach >= low)
        if not len(live):
            break  # lengths only descend
        bound = rq[live, :head] @ rc[run, :head].T + np.outer(q_tail[live], c_tail[run])
        slack = 1e-9 * np.outer(q_len[live], c_len[run]) + 1
        a, b = np.nonzero(bound + slack >= low[live][:, None])
        other = query_ids[live[a]] != ids[run[b]]
        a, b = a[other], b[other]
        if not len(a):
            continue
        score = _products(queries[live], chunk[run], a, b)
        q, c = live[a], run[b]
        best_q, best_c, best_s = np.concatenate([best_q, q]), np.concatenate([best_c, c]), np.concatenate([best_s, score])
        sort = np.lexsort((ids[best_c], -best_s, best_q))
        best_q, best_c, best_s = best_q[sort], best_c[sort], best_s[sort]
        first = np.searchsorted(best_q, best_q)
        rank = np.arange(len(best_q)) - first
        keep = rank < k
        full = rank == k - 1
        low[best_q[full]] = np.maximum(low[best_q[full]], best_s[full])
        best_q, best_c, best_s = best_q[keep], best_c[keep], best_s[keep]
    return best_q, best_c, best_s


def _search_blocks(turn: dict[int, tuple[np.ndarray, int]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                query_ids, queries = _unpack(row["q_ids"], row["q_vectors"], row["dim"])
                ids, chunk = _unpack(row["ids"], row["vectors"], row["dim"])
                low = np.frombuffer(row["low"], dtype=np.float64)
                q, c, s = search(queries, query_ids, chunk, ids, low, *turn[row["dim"]], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[q]), pa.array(ids[c]), pa.array(s)], names=["query_id", "vec_id", "score"]
                )

    return run


_FOUND = "query_id long, vec_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _thresholds(k: int):
    """Block rows with ``low``: the k-th best score of each query so far, minus infinity if there are fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, floors = [], []
            for r in range(batch.num_rows):
                ids = np.frombuffer(batch.column("q_ids")[r].as_py(), dtype=np.int64)
                known = {x["query_id"]: x["score"] for x in batch.column("kth")[r].as_py() or ()}
                low = np.array([known.get(i, -np.inf) for i in ids.tolist()], dtype=np.float64)
                lows.append(low.tobytes())
                floors.append(float(low.min()))
            names = ["block", "dim", "q_longest", "q_ids", "q_vectors"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(lows, pa.binary()), pa.array(floors)], names=[*names, "low", "floor"]
            )

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best of every row whose id ``every`` divides."""
    own = materialise(usable(vectors, vector), "vectors")
    turn = rotations(own)
    length = F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)
    parts = max(1, -(-own.count() // CHUNK))
    chunks = (
        own.withColumn("length", length).repartitionByRange(parts, F.desc("length"), "vec_id")
        .sortWithinPartitions(F.desc("length"), "vec_id").select("vec_id", "dim", "v")
        .transform(map_arrow, _pack(CHUNK), _BLOCK)
    )
    chunks = materialise(chunks.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    blocks = own.filter(F.col("vec_id") % every == 0).transform(map_arrow, _pack(QUERIES), _BLOCK).select(
        F.monotonically_increasing_id().alias("block"), "dim", F.col("longest").alias("q_longest"),
        F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
    )
    blocks = materialise(blocks, "query-blocks")
    # The longest vectors of each dimension: one chunk each, of bounded size.
    first = chunks.groupBy("dim").agg(F.max_by("chunk", F.struct("longest", "chunk")).alias("chunk"))
    first = chunks.join(F.broadcast(first), ["dim", "chunk"]).drop("longest")
    started = (
        blocks.join(F.broadcast(first), "dim")
        .transform(map_arrow, _first_scores(turn, k), _FOUND + ", block long")
    )
    started = materialise(started, "first-scores")
    per_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        started.withColumn("rank", F.row_number().over(per_query)).filter(F.col("rank") == k)
        .groupBy("block").agg(F.collect_list(F.struct("query_id", "score")).alias("kth"))
    )
    ready = materialise(
        blocks.join(kth, "block", "left")
        .transform(map_arrow, _thresholds(k), "block long, dim int, q_longest double, q_ids binary, q_vectors binary, low binary, floor double"),
        "ready",
    )
    # Which chunk must meet which block: by lengths alone.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    heads = chunks.select("dim", "chunk", "longest", F.pmod(F.xxhash64("chunk"), F.lit(SALTS)).cast("int").alias("salt"))
    meets = (
        ready.select("dim", "block", "q_longest", "floor", salts.alias("salt")).join(heads, ["dim", "salt"])
        .filter(F.col("q_longest") * F.col("longest") * (1 + 1e-9) + 1 >= F.col("floor"))
        .select("block", "chunk")
    )
    pairs = meets.join(ready.drop("q_longest", "floor"), "block").join(chunks.drop("dim", "longest"), "chunk")
    found = pairs.transform(map_arrow, _search_blocks(turn, k), _FOUND)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _first_scores(turn: dict[int, tuple[np.ndarray, int]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                query_ids, queries = _unpack(row["q_ids"], row["q_vectors"], row["dim"])
                ids, chunk = _unpack(row["ids"], row["vectors"], row["dim"])
                low = np.full(len(query_ids), -np.inf)
                q, c, s = search(queries, query_ids, chunk, ids, low, *turn[row["dim"]], k)
                block = pa.array(np.full(len(q), row["block"], dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[q]), pa.array(ids[c]), pa.array(s), block], names=["query_id", "vec_id", "score", "block"]
                )

    return run
