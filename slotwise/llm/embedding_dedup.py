"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A bounded sample fits, for each code, principal axes and a rotation that alternates between binary
codes and the orthogonal matrix that fits them best; the signs after the rotation are the bits.
Every vector is then indexed in several tables by substrings of its codes and meets only vectors
of its label, dimension and substring; those are reranked with the original vectors in double
precision.

The substring length follows the size of the largest label (about ``BUCKET`` vectors a bucket).
The number of tables follows from a measurement: sample vectors are paired with noisy partners
exactly at the threshold, and there are as many tables as leave at most ``miss`` of such pairs
without a common substring.  Pairs more alike than the threshold are missed less often.

Equal vectors of a label are one class before anything is compared.  A bucket of any size is
handled whole: it is cut into blocks and every pair of blocks is one small matrix product; a pair
of vectors counts only in the first table that the two share.  Nothing is emitted per pair: each
block pair gives one row per linked vector, with its number of links and one spanning edge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import arrow_map, ship, stored
from slotwise.llm.components import components

SAMPLE = 20_000                 # vectors that the rotations are fitted on
BUCKET = 128                    # vectors a bucket holds on average, in the largest label
BLOCK = 512                     # vectors in a block of a large bucket
ITERATIONS = 30


def fit_rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """Projection (dimension x bits) of unit vectors: principal axes, rotated for balanced codes."""
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(np.cov(x.T) if len(x) > 1 else np.eye(x.shape[1]))
    rotation, _ = np.linalg.qr(rng.standard_normal(axes.shape))
    v = (x - x.mean(0)) @ axes
    for _ in range(ITERATIONS):
        left, _, right = np.linalg.svd(np.sign(v @ rotation).T @ v)
        rotation = (left @ right).T
    return axes @ rotation


@dataclass
class Index:
    """Bits of a unit vector: signs of (x - mean) @ projection; table t has the t-th ``bits`` of them."""
    mean: np.ndarray
    projection: np.ndarray
    bits: int

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(vectors x tables) substring values."""
        signs = ((x - self.mean) @ self.projection > 0).reshape(len(x), -1, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def fit_index(sample: np.ndarray, largest: int, threshold: float, miss: float) -> Index:
    """sample: unit vectors of one dimension; largest: rows of the largest label."""
    dim = sample.shape[1]
    bits = max(4, min(30, math.ceil(math.log2(max(largest, 1) / BUCKET + 1))))
    mean, rng = sample.mean(0), np.random.default_rng(3)
    noise = rng.standard_normal(sample.shape)
    noise -= (noise * sample).sum(1, keepdims=True) * sample
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-30)
    partner = threshold * sample + math.sqrt(1 - threshold ** 2) * noise
    codes: list[np.ndarray] = []
    for seed in range(200):
        codes.append(fit_rotation(sample, seed))
        projection = np.hstack(codes)
        tables = projection.shape[1] // bits
        if not tables:
            continue
        index = Index(mean, projection[:, :tables * bits], bits)
        missed = (index.keys(sample) != index.keys(partner)).all(1).mean()
        if missed <= miss or dim == 1:
            break
    return index


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _links_of_blocks(table: pa.Table, low: int, high: int, number: int, threshold: float) -> pa.Table:
    order = table.sort_by("vec_id")
    block, ids, copies = (order[c].to_numpy() for c in ("block", "vec_id", "copies"))
    x = np.array([np.frombuffer(v, np.float64) for v in order["vector"].to_pylist()])
    keys = np.array([np.frombuffer(v, np.int32) for v in order["tables"].to_pylist()])
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    linked = x[a] @ x[b].T >= threshold
    if low == high:
        np.fill_diagonal(linked, False)
    for t in range(number):                                # only in the first table both share
        linked &= keys[a, t][:, None] != keys[b, t][None, :]
    count = np.zeros(len(ids), np.int64)
    count[a] += linked @ copies[b]
    if low != high:
        count[b] += copies[a] @ linked
    root = np.arange(len(ids))
    while linked.any():                                    # smallest row reachable inside the block pair
        new = root.copy()
        new[a] = np.minimum(new[a], np.where(linked, root[b][None, :], len(ids)).min(1))
        new[b] = np.minimum(new[b], np.where(linked, new[a][:, None], len(ids)).min(0))
        if (new == root).all():
            break
        root = new
    some = count > 0
    return pa.table({"vec_id": ids[some], "links": count[some], "root": ids[root[some]]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, miss: float = 0.01, key: str = "vec_id",
                    vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (smallest reachable id), kept.

    Defined results: rows whose label is null, or whose vector is null, empty, zero or holds a null
    or non-finite component, link with nothing; vectors of different length don't link; equal
    vectors of a label link; rows repeated under one id and vector link too (each counts the
    others) and share a component; an empty table gives an empty table; only the named columns are read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.where(usable).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))      # -0.0 is 0.0
    classes = stored(good.groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
                     .withColumn("dim", F.size("v")), "itq-classes")

    sizes = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(100).collect()
    largest = classes.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("n"))
    most = {r["dim"]: r["n"] for r in largest.join(F.broadcast(spark.createDataFrame(
        [(r["dim"],) for r in sizes], "dim int")), "dim").collect()} if sizes else {}
    index: dict[int, Index] = {}
    for dim in most:
        sample = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
        x = _unit(np.array(sample["v"].to_pylist(), float))
        index[dim] = fit_index(x, most[dim], threshold, miss)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column(4))
            unit: list[bytes] = [b""] * batch.num_rows
            keys: list[np.ndarray] = [np.zeros(0, np.int64)] * batch.num_rows
            values = batch.column(1).to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = _unit(np.array([values[i] for i in at], float))
                # a dimension beyond the hundred most frequent has one table with one bucket
                k = index[dim].keys(x) if dim in index else np.zeros((len(x), 1), np.int64)
                for i, row, own in zip(at, x, k, strict=True):
                    unit[i], keys[i] = row.tobytes(), own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(unit, pa.binary()),
                 pa.array([k.astype(np.int32).tobytes() for k in keys], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["label", "vec_id", "copies", "dim", "vector", "tables", "keys"])

    kind = classes.schema["label"].dataType.simpleString()
    coded = arrow_map(classes.select("label", "v", "vec_id", "copies", "dim"), encode,
                      f"label {kind}, vec_id long, copies long, dim int, vector binary, tables binary, keys array<long>")
    coded = stored(coded, "itq-coded")
    spread = coded.select("label", "dim", "vec_id", "copies", "vector", "tables", F.posexplode("keys").alias("number", "bucket"))
    bucket = ["label", "dim", "number", "bucket"]
    sizes_of = stored(coded.select("label", "dim", F.posexplode("keys").alias("number", "bucket")).groupBy(*bucket)
                      .agg(F.count("*").alias("_n")).where("_n > 1"), "itq-buckets")
    placed = (spread.join(sizes_of, bucket).withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("_blocks")).cast("int"))
              .withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
              .withColumns({"_low": F.least("block", "_other"), "_high": F.greatest("block", "_other")})
              .select(*bucket, "_low", "_high", "block", "vec_id", "copies", "vector", "tables"))

    def compare(group: tuple, table: pa.Table) -> pa.Table:
        number, low, high = (group[i].as_py() for i in (2, 4, 5))
        return _links_of_blocks(table, low, high, number, threshold)

    found = stored(placed.groupBy(*bucket, "_low", "_high").applyInArrow(compare, "vec_id long, links long, root long"), "itq-links")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("vec_id").alias("src"), F.col("root").alias("dst")), "itq")
    result = stored(classes.select("label", "v", "vec_id", "copies").join(links, "vec_id", "left")
                    .join(linked.withColumnRenamed("id", "vec_id"), "vec_id", "left")
                    .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                            F.coalesce("component", "vec_id").alias("component_id")), "itq-result")
    shown = good.join(result, ["label", "v"]).select("vec_id", "n_links", "component_id").unionByName(
        rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return shown.withColumn("kept", F.col("vec_id") == F.col("component_id"))
