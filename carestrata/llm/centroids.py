"""Centroid clustering (integer k-means) over dictionary-encoded vectors.

Every chunk of vectors is stored once as dictionaries: the dimensions are cut into blocks, a block's distinct subvectors
get codes, and a vector becomes one code for each block. A round computes the exact squared distance of each distinct
subvector to each centroid's part once for its chunk, and a vector's distance is the sum of the table entries its codes
point to. Means come from the same codes: how often a cluster holds a code, times the code's subvector.

Dictionaries belong to chunks, not to the table, since nothing bounds the distinct subvectors of a table: a chunk's
dictionary is bounded by the chunk, needs no join, and all that leaves a task are the sums of its clusters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage

SCALE = 1024
#: vectors of one dictionary; at 64 dimensions a chunk has about a megabyte of codes
CHUNK = 8192
#: dimensions of a block
WIDTH = 2
#: larger components could not be squared and summed in 64 bits
MAX_COMPONENT = 1 << 26
_CHUNKS = "ids array<bigint>, sizes array<int>, entries binary, codes binary"


def integer_vectors(vectors: DataFrame, dims: int = 64) -> DataFrame:
    """``(vec_id, x)``: the vectors with exactly ``dims`` components, none null, NaN or infinite, as ``floor(1024 * x)``.

    A component beyond ``MAX_COMPONENT`` is an error, since its squared distance would not fit a long.
    """
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    floors = F.transform(value, lambda v: F.floor(v * SCALE))
    fits = F.forall(value, lambda v: F.abs(v) <= MAX_COMPONENT / SCALE)
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == dims) & finite)
    checked = F.when(fits, floors).otherwise(F.raise_error(F.lit(f"a component exceeds {MAX_COMPONENT // SCALE}")).cast("array<bigint>"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), checked.alias("x"))


def encode_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``values (n, width)`` in ascending order, and each row's code."""
    codes = np.zeros(len(values), dtype=np.int64)
    for column in values.T:  # pair the code so far with the next component; a code stays below n
        seen, part = np.unique(column, return_inverse=True)
        _, first, codes = np.unique(codes * len(seen) + part, return_index=True, return_inverse=True)
    return values[first], codes


def encode(kept: DataFrame, dims: int = 64, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """One row for every chunk of at most ``chunk`` vectors: ids, dictionary sizes, dictionaries and codes."""

    def packed(ids: list, rows: np.ndarray) -> pa.RecordBatch:
        entries, codes, sizes = [], [], []
        for start in range(0, dims, width):
            seen, code = encode_block(rows[:, start : start + width])
            entries.append(seen.astype("<i4").tobytes())
            codes.append(code.astype("<u2" if chunk <= 65536 else "<u4").tobytes())
            sizes.append(len(seen))
        columns = [
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([sizes], pa.list_(pa.int32())),
            pa.array([b"".join(entries)], pa.binary()),
            pa.array([b"".join(codes)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["ids", "sizes", "entries", "codes"])

    def run(batches):
        ids, parts, held = [], [], 0
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for at in range(0, batch.num_rows, chunk):
                ids += batch.column(0).slice(at, chunk).to_pylist()
                parts.append(rows[at : at + chunk])
                held += len(parts[-1])
                if held >= chunk:
                    yield packed(ids, np.concatenate(parts))
                    ids, parts, held = [], [], 0
        if held:
            yield packed(ids, np.concatenate(parts))

    return kept.select("vec_id", "x").mapInArrow(run, _CHUNKS)


class Chunk:
    """A decoded chunk: for each block its dictionary and the codes of all vectors."""

    def __init__(self, row: dict, dims: int, width: int):
        self.ids, self.blocks = row["ids"], []
        n, entry, code = len(self.ids), 0, 0
        size = len(row["codes"]) // (n * len(row["sizes"]))
        for start, m in zip(range(0, dims, width), row["sizes"]):
            w = min(width, dims - start)
            seen = np.frombuffer(row["entries"], "<i4", m * w, entry).reshape(m, w).astype(np.int64)
            codes = np.frombuffer(row["codes"], f"<u{size}", n, code)
            self.blocks.append((start, seen, codes))
            entry, code = entry + 4 * m * w, code + size * n

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector (the smaller number of equals) and its squared distance."""
        total = np.zeros((len(self.ids), len(centroids)), dtype=np.int64)
        for start, seen, codes in self.blocks:
            part = centroids[:, start : start + seen.shape[1]]
            table = ((seen[:, None, :] - part[None]) ** 2).sum(axis=2)
            total += table[codes]
        best = total.argmin(axis=1)
        return best, total[np.arange(len(best)), best]

    def sums(self, best: np.ndarray, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of each cluster and the sums of their components."""
        out = np.zeros((k, dims), dtype=np.int64)
        for start, seen, codes in self.blocks:
            m = len(seen)
            held = np.bincount(best * m + codes, minlength=k * m).reshape(k, m)
            out[:, start : start + seen.shape[1]] = held @ seen
        return np.bincount(best, minlength=k), out


def _chunks(batches, dims: int, width: int):
    for batch in batches:
        for row in batch.to_pylist():
            yield Chunk(row, dims, width)


def _means(chunks: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """The centroids after one round; an empty cluster keeps its own. Collects one row per cluster and dimension."""
    k, dims = centroids.shape

    def run(batches):
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for chunk in _chunks(batches, dims, width):
            n, s = chunk.sums(chunk.nearest(centroids)[0], k, dims)
            counts, sums = counts + n, sums + s
        yield pa.RecordBatch.from_pydict(
            {"cluster": list(range(k)), "n": counts.tolist(), "sums": sums.tolist()},
            schema=pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]),
        )

    parts = chunks.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    added = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d")
    means = centroids.copy()
    for row in added.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        if row["n"]:
            means[row["cluster"], row["d"]] = int(row["s"]) // row["n"]
    return means


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    *,
    dims: int = 64,
    seed: int = 3,
    width: int = WIDTH,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of the kept ``vectors (vec_id, embedding)``.

    Vectors that :func:`integer_vectors` leaves out have no row. Starts are the ``k`` vectors with the smallest SHA-256
    of ``seed:vec_id`` (equal ids: the smaller components first; null ids last); with fewer vectors there are fewer
    clusters. Ties go to the smaller cluster. A null ``vec_id`` stays null, repeated rows stay repeated and count as
    often, other columns are ignored, an empty table gives an empty result. Rounds stop early once nothing moves, since
    later ones would repeat the last.

    Nothing unbounded leaves a task: a round brings ``k * dims`` sums to the driver, and chunks are read from files.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, dims)
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.orderBy(named.asc_nulls_last(), "x").limit(k).select("x").collect()
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not starts:
        return spark.createDataFrame([], schema)

    chunks = stage(encode(kept, dims, width, chunk), "vector-chunks")
    centroids = np.array([r["x"] for r in starts], dtype=np.int64)
    for _ in range(rounds):
        moved = _means(chunks, centroids, width)
        if (moved == centroids).all():
            break
        centroids = moved

    def assign(batches):
        for part in _chunks(batches, dims, width):
            best, distance = part.nearest(centroids)
            columns = [pa.array(part.ids, pa.int64()), pa.array(best, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = stage(chunks.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "vector-clusters")
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    held = {r["cluster"]: int(r["s"]) for r in per_cluster}  # at most k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = sum(held.values())
    facts = spark.createDataFrame(
        [(c, s, total, digests[c]) for c, s in held.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
