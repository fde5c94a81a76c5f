"""Best-fit packing of token pieces, planned on the histogram of their lengths.

A plan is a list of patterns (which lengths share a sequence) with how often each is used.  Exact
complements come first: for the longest length still there, the gap to a full sequence is looked
up among single lengths, then sums of two, then of three, and the combination is consumed as often
as the counts allow.  What has no exact complement is packed best-fit, longest first.  Where those
rests leave gaps that smaller pieces would fill, combinations used last (those of small pieces) are given
back to them.  The plan depends on at most ``capacity`` counts, however many documents there are; pieces then find their
place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from slotwise.llm import word_ids
from slotwise.llm.common import arrow_map, bounded_broadcast, stored

CAPACITY = 2048
GROUP = 100_000         # pieces of one length that a task ranks, about
MAX_GROUPS = 200_000    # groups that are broadcast; with more, the join shuffles


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32.  A document is its ids, then id 0 (null
    text: only that); longer ones are cut every ``capacity`` ids."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids.cached(tokenizer)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, stop, ids, ends in word_ids.ids_of(batch.column(1), table):
                rows: list[list] = [[], [], [], [], []]
                flat = ids.astype("<u4").tobytes()
                for doc, a, b in zip(keys[row:stop], ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    own = flat[4 * a:4 * b] + b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(own) // 4, capacity)):
                        part = own[4 * at:4 * (at + capacity)]
                        for column, x in zip(rows, (doc, k, at, len(part) // 4, zlib.crc32(part)), strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(x, pa.int64()) for x in rows[2:])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), cut,
                     "doc_id long, piece int, start long, length long, ids_crc32 long")


def _best_pair(count: np.ndarray, gap: int, most: int) -> tuple[int, int] | None:
    """Two lengths with sum ``gap``, the larger as large as can be but at most ``most``."""
    low, high = (gap + 1) // 2, min(gap - 1, most)
    if high < low:
        return None
    large = np.arange(high, low - 1, -1)
    ok = (count[large] > 0) & (count[gap - large] > 0) & ((large * 2 != gap) | (count[large] > 1))
    at = int(ok.argmax())
    return (int(large[at]), int(gap - large[at])) if ok[at] else None


def _complement(count: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths that are there and fill ``gap`` exactly."""
    if count[gap] > 0:
        return (gap,)
    if pair := _best_pair(count, gap, gap):
        return pair
    for a in np.flatnonzero(count[:gap - 1])[::-1]:
        if 3 * a < gap:
            break
        count[a] -= 1
        pair = _best_pair(count, gap - int(a), int(a))
        count[a] += 1
        if pair:
            return (int(a), *pair)
    return None


def _exact(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Patterns that fill a sequence exactly, longest pieces first, and the counts that are left."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    out, rest = [], {}
    for length in range(capacity, 0, -1):
        while count[length] > 0:
            count[length] -= 1
            more = _complement(count, capacity - length) if length < capacity else ()
            count[length] += 1
            if more is None:
                rest[length] = int(count[length])
                count[length] = 0
                break
            use = Counter((length, *more))
            times = min(int(count[x]) // k for x, k in use.items())
            for x, k in use.items():
                count[x] -= k * times
            out.append((dict(use), times))
    return out, rest


def _best_fit(rest: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns of the pieces that have no exact complement: best fit, longest first."""
    open_bins: list[list[tuple[Counter, int]]] = [[] for _ in range(capacity + 1)]    # by gap
    for length in sorted(rest, reverse=True):
        left = rest[length]
        gap = length
        while left and gap <= capacity:
            if not open_bins[gap]:
                gap += 1
                continue
            pattern, times = open_bins[gap].pop()
            fits = min(times * (gap // length), left)
            each = gap // length
            whole, part = divmod(fits, each)
            for k, n in ((each, whole), (part, 1 if part else 0)):
                if n:
                    open_bins[gap - k * length].append((pattern + Counter({length: k}), n))
            if used := times - whole - bool(part):
                open_bins[gap].append((pattern, used))
            left -= fits
        each = capacity // length
        for k, n in ((each, left // each), (left % each, 1)):
            if k and n:
                open_bins[capacity - k * length].append((Counter({length: k}), n))
    return [(dict(p), n) for bins in open_bins for p, n in bins]


def _give_back(exact: list[tuple[dict[int, int], int]], rest: dict[int, int], uses: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """The last ``uses`` uses of exact patterns are taken apart and join the rest."""
    kept, rest = list(exact), dict(rest)
    while uses and kept:
        pattern, times = kept.pop()
        back = min(times, uses)
        uses -= back
        if times > back:
            kept.append((pattern, times - back))
        for length, k in pattern.items():
            rest[length] = rest.get(length, 0) + k * back
    return kept, rest


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: how many}, uses) that place every piece once.

    While more sequences are used than the pieces' sum needs, twice as many of the exact combinations
    are given back to the rests as before; the shortest plan counts, of equal ones that with
    most exact combinations.
    """
    exact, rest = _exact(histogram, capacity)
    needed = -(-sum(length * n for length, n in histogram.items()) // capacity)
    best, fewest, uses = [], None, 0
    while True:
        kept, loose = _give_back(exact, rest, uses)
        whole = kept + _best_fit(loose, capacity)
        total = sum(n for _, n in whole)
        if fewest is None or total < fewest:
            best, fewest = whole, total
        if not kept or fewest <= needed:
            return best
        uses = 2 * uses or 1


def slots(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, pieces of this length a sequence)."""
    rows, rank, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length, k in sorted(pattern.items(), reverse=True):
            rows.append((length, rank[length], rank[length] + k * times, sequence, offset, k))
            rank[length] += k * times
            offset += k * length
        sequence += times
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to stored pieces (doc_id, piece, start, length, ...).

    Pieces that fill a sequence alone need no place (their sequences have numbers below 0).  The others
    of a length are ranked inside hash groups of about ``group`` pieces, as many as the length's
    count asks for; the groups' sizes give each its first rank, so no length meets in one task.
    """
    spark = cut.sparkSession
    # at most ``capacity`` rows reach the driver
    histogram = {r["length"]: r["n"] for r in cut.where(F.col("length") < capacity).groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = spark.createDataFrame([(length, n // group + 1) for length, n in histogram.items()], "_length long, _salts long")
    salted = cut.join(F.broadcast(salts), F.col("length") == F.col("_length")).withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.col("_salts"))).drop("_length", "_salts")
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")
                              .rowsBetween(Window.unboundedPreceding, -1))
    groups = stored(groups.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_first")), "pack-groups")
    place = spark.createDataFrame(
        slots(plan(histogram, capacity)),
        "length long, _lo long, _hi long, _sequence long, _offset long, _each long")
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start"))
    ranked = (salted.withColumn("_in", inside)
              .join(bounded_broadcast(groups, MAX_GROUPS), ["length", "_salt"])
              .withColumn("_rank", F.col("_first") + F.col("_in") - 1).drop("_salt", "_in", "_first"))
    here = (ranked["length"] == place["length"]) & (ranked["_rank"] >= place["_lo"]) & (ranked["_rank"] < place["_hi"])
    nth = F.col("_rank") - F.col("_lo")
    # the plan's rows: a few per length, from at most ``capacity`` counts
    placed = ranked.join(F.broadcast(place), here).select(
        *[ranked[c] for c in cut.columns],
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * ranked["length"]).cast("long").alias("offset"))
    alone = cut.where(F.col("length") >= capacity).select(
        *cut.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Every document's pieces with their sequence and place: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    Defined results: null and empty texts are one id (0); repeated rows are packed each; equal
    lengths are taken in key order inside hash groups; an empty table gives an empty table; only
    the named columns are read.
    """
    return pack(stored(pieces(docs, tokenizer, capacity, key, text), "pack-pieces"), capacity)
