"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Every permutation gives two signature values, the least and the greatest hash of the document's
shingles, so ``2 x PERMUTATIONS`` values cost half the hash evaluations.  Bands of ``ROWS`` values
(min and max of two permutations) are the candidate keys: at similarity 0.8 a pair misses all
bands with probability (1 - 0.8^4)^24 = 3e-6.

1. One pass over the texts: set size, a 128-bit key of the set, band keys of the signature.
2. Documents with equal sets are one class; only the class's smallest document goes on.
3. In every band bucket each class is paired with the bucket's smallest class, never all with all,
   and the pairs are confirmed on their full sets.  Confirmed links give first components.
4. Buckets that still hold several components are compared in blocks, on long signatures.  First
   each class only proposes its most alike partner of another component, which joins what belongs
   together with few pairs; then all pairs of different components whose signatures agree often
   enough are confirmed, in a crowded block pair by comparing its full sets at one go.  So every candidate pair is confirmed, ruled out, or inside one component.

Links compare exactly: 100 x intersection >= threshold x union, on 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import textnum
from slotwise.llm.common import arrow_map, stored
from slotwise.llm.components import components

PERMUTATIONS = 48
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
BLOCK = 512                     # classes of a bucket that meet another block in one task's matrix
LONG = 256                      # permutations of the long signatures, a byte per value
SLACK = 0.09                    # below the threshold a long signature may agree: five standard deviations
_RNG = np.random.default_rng(977)
_A = (_RNG.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _RNG.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]
_A_LONG = (_RNG.integers(0, 2**31, LONG, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B_LONG = _RNG.integers(0, 2**32, LONG, dtype=np.uint32)[:, None]


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of whole texts; fewer words than ``size`` are one shingle."""
    for lo, hi, buf, offsets in textnum.slices(column):
        words, at = textnum.word_hashes(buf, offsets, lower=True)
        runs = textnum.mix(textnum.combine(words, size, size))
        for k in range(hi - lo):
            n = at[k + 1] - at[k]
            if n >= size:
                yield lo + k, np.unique(runs[at[k]:at[k + 1] - size + 1])
            else:
                yield lo + k, textnum.mix(textnum.combine(words[at[k]:at[k + 1]], int(n), int(n))) if n else words[:0]


def signature(shingles: np.ndarray, times: np.ndarray = _A, plus: np.ndarray = _B) -> np.ndarray:
    """Minimum and maximum under each permutation, side by side."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
    low = np.full(len(times), 0xFFFFFFFF, np.uint32)
    high = np.zeros(len(times), np.uint32)
    for s in range(0, x.shape[1], 2048):
        h = x[:, s:s + 2048] * times + plus
        h ^= h >> np.uint32(15)
        np.minimum(low, h.min(1), out=low)
        np.maximum(high, h.max(1), out=high)
    return np.stack([low, high], 1).ravel()


def signatures(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            count, one, two = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            bands: list[np.ndarray | None] = [None] * n
            for row, s in shingle_sets(batch.column(1), size):
                if not len(s):
                    continue
                count[row] = len(s)
                one[row] = textnum.mix(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)
                two[row] = textnum.mix(s * np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).astype(np.int64)
                values = signature(s)
                rows = values.reshape(BANDS, ROWS).astype(np.uint64)
                key_of = np.arange(1, BANDS + 1, dtype=np.uint64)
                for j in range(ROWS):
                    key_of = textnum.mix(key_of * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
                bands[row] = key_of.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count), pa.array(one), pa.array(two),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_1", "set_2", "bands"])

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), sign,
                     "doc_id long, n_shingles long, set_1 long, set_2 long, bands array<long>")


def long_signatures(texts: DataFrame, size: int) -> DataFrame:
    """texts (doc_id, text): doc_id, signature of 2 x LONG bytes."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = [b""] * batch.num_rows
            for row, s in shingle_sets(batch.column(1), size):
                out[row] = (signature(s, _A_LONG, _B_LONG) >> np.uint32(24)).astype(np.uint8).tobytes() if len(s) else b"\0" * (2 * LONG)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "signature"])

    return arrow_map(texts, sign, "doc_id long, signature binary")


def shingles_of(texts: DataFrame, size: int) -> DataFrame:
    """texts (doc_id, text): doc_id, shingles (sorted distinct 64-bit hashes)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [s.tobytes() for _, s in shingle_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "shingles"])

    return arrow_map(texts, sets, "doc_id long, shingles binary")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    """Those (src, dst) pairs whose full sets are similar enough."""
    wanted = pairs.select(F.col("src").alias("doc_id")).union(pairs.select("dst")).distinct()
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = stored(texts.join(stored(wanted, "minhash-wanted"), "doc_id", "left_semi"), "minhash-texts")
    both = (pairs.join(texts.select(F.col("doc_id").alias("src"), F.col("text").alias("a")), "src")
            .join(texts.select(F.col("doc_id").alias("dst"), F.col("text").alias("b")), "dst")
            .select("src", "dst", "a", "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            pairs_of = zip(shingle_sets(batch.column(2), size), shingle_sets(batch.column(3), size), strict=True)
            for (row, a), (_, b) in pairs_of:
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok[row] = common > 0 and 100 * common >= percent * (len(a) + len(b) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["src", "dst"]).filter(pa.array(ok))

    return arrow_map(both, check, "src long, dst long")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """rows (bucket, n_bucket, doc_id, ..) with block pairs: a row meets every block of its bucket once."""
    placed = rows.withColumn("_blocks", F.ceil(F.col("n_bucket") / BLOCK).cast("int"))
    placed = placed.withColumn("_block", F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int"))
    placed = placed.withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
    return placed.withColumns({"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")}).drop("_blocks", "_other", "n_bucket")


def _sides(table: pa.Table, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    block = table["_block"].to_numpy()
    left = np.flatnonzero(block == low)
    return left, left if low == high else np.flatnonzero(block == high)


def _proposed(rows: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Candidate pairs (src, dst) of different components, by long signatures; with ``best_only``
    just each row's most alike partner in the other block.  A block pair with many candidates is
    named instead (bucket, _low, _high): its sets are to be compared where they meet."""
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        doc, n, component = (table[c].to_numpy() for c in ("doc_id", "n_shingles", "component"))
        sign = np.array([np.frombuffer(x, np.uint8) for x in table["signature"].to_pylist()])
        left, right = _sides(table, low, high)
        src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left:
            j = right[component[right] != component[i]]
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            if low == high:
                j = j[doc[j] < doc[i]]
            alike = (sign[j] == sign[i]).sum(1)
            ok = alike >= (percent / 100 - SLACK) * sign.shape[1]
            j = j[ok]
            if best_only and len(j):
                j = j[[int(alike[ok].argmax())]]
            src.append(np.maximum(doc[j], doc[i]))
            dst.append(np.minimum(doc[j], doc[i]))
        src, dst = np.concatenate(src), np.concatenate(dst)
        if len(src) <= 2 * len(doc):
            none = [None] * len(src)
            return pa.table({"src": src, "dst": dst, "bucket": pa.array(none, pa.int64()), "_low": pa.array(none, pa.int32()), "_high": pa.array(none, pa.int32())})
        none = pa.array([None], pa.int64())
        return pa.table({"src": none, "dst": none, "bucket": [key[0].as_py()], "_low": pa.array([low], pa.int32()), "_high": pa.array([high], pa.int32())})

    shape = "src long, dst long, bucket long, _low int, _high int"
    return _in_blocks(rows).groupBy("bucket", "_low", "_high").applyInArrow(compare, shape)


def _links_in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """rows (bucket, _low, _high, _block, doc_id, shingles): exact links inside each block pair, as one
    edge per linked row to the smallest row it reaches there."""
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        table = table.sort_by("doc_id")
        doc = table["doc_id"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        size = np.array([len(x) for x in sets])
        row = np.repeat(np.arange(len(sets)), size)
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row, column = row[times[column] > 1], column[times[column] > 1]         # others are in no intersection
        _, column = np.unique(column, return_inverse=True)
        left, right = _sides(table, low, high)
        common = np.zeros((len(left), len(right)), np.float32)
        for begin in range(0, int(column.max(initial=-1)) + 1, 4096):
            at = (column >= begin) & (column < begin + 4096)
            has = np.zeros((len(sets), 4096), np.float32)
            has[row[at], column[at] - begin] = 1
            common += has[left] @ has[right].T
        linked = 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
        if low == high:
            np.fill_diagonal(linked, False)
        root = np.arange(len(doc))
        while linked.any():
            new = root.copy()
            new[left] = np.minimum(new[left], np.where(linked, root[right][None, :], len(doc)).min(1))
            new[right] = np.minimum(new[right], np.where(linked, new[left][:, None], len(doc)).min(0))
            if (new == root).all():
                break
            root = new
        far = root != np.arange(len(doc))
        return pa.table({"src": doc[far], "dst": doc[root[far]]})

    return rows.groupBy("bucket", "_low", "_high").applyInArrow(compare, "src long, dst long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    Defined results: texts without words (null, empty) have no shingles and link with nothing;
    fewer words than ``size`` make one shingle; documents with equal sets link; ties go to the
    smaller id; rows repeated under one doc_id are one document, whose every row is returned with
    that row's own set size; an empty table gives an empty table; only the named columns are read.
    """
    signed = stored(signatures(docs, size, key, text), "minhash-signed")
    classes = stored(signed.where("n_shingles > 0").groupBy("set_1", "set_2", "n_shingles")
                     .agg(F.min("doc_id").alias("rep")), "minhash-classes")
    reps = signed.join(classes.withColumnRenamed("rep", "doc_id"), ["set_1", "set_2", "n_shingles", "doc_id"], "left_semi")
    reps = reps.dropDuplicates(["set_1", "set_2", "doc_id"])

    rows = reps.select(F.explode("bands").alias("bucket"), "doc_id", "n_shingles")
    buckets = stored(rows.groupBy("bucket").agg(F.count("*").alias("n_bucket"), F.min(F.struct("doc_id", "n_shingles")).alias("least"))
                     .where("n_bucket > 1"), "minhash-buckets")
    shared = stored(rows.join(buckets, "bucket").select("bucket", "n_bucket", "doc_id", "n_shingles", "least"), "minhash-shared")
    star = (shared.where(F.col("doc_id") != F.col("least.doc_id"))
            .where(100 * F.least("n_shingles", "least.n_shingles") >= percent * F.greatest("n_shingles", "least.n_shingles"))
            .select(F.col("doc_id").alias("src"), F.col("least.doc_id").alias("dst")).distinct())
    star = stored(star, "minhash-star")
    first = stored(confirmed(star, docs, size, percent, key, text), "minhash-links")

    links, tried, signs = first, star, None
    for best_only in (True, False):
        found = stored(components(links, "minhash-found"), "minhash-component")
        member = shared.drop("least").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        member = stored(member.withColumn("component", F.coalesce("component", "doc_id")), "minhash-member")
        mixed = stored(member.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                       .where("lo <> hi").select("bucket"), "minhash-mixed")
        member = member.join(mixed, "bucket", "left_semi")
        if signs is None:                               # the first round's open classes hold the second's
            texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            open_ids = stored(member.select("doc_id").distinct(), "minhash-open")
            signs = long_signatures(texts.join(open_ids, "doc_id", "left_semi"), size)
            signs = stored(signs.dropDuplicates(["doc_id"]), "minhash-long")
        proposed = stored(_proposed(member.join(signs, "doc_id"), percent, best_only), "minhash-proposed")
        across = proposed.where("bucket IS NULL").select("src", "dst").distinct().join(tried, ["src", "dst"], "left_anti")
        across = stored(across, "minhash-across")
        dense = proposed.where("bucket IS NOT NULL").select("bucket", "_low", "_high")
        packed = member.select("bucket", "n_bucket", "doc_id").join(dense.select("bucket").distinct(), "bucket", "left_semi")
        crowded = stored(_in_blocks(packed).join(dense, ["bucket", "_low", "_high"]), "minhash-crowded")
        sets = stored(texts.join(stored(crowded.select("doc_id").distinct(), "minhash-crowd"), "doc_id", "left_semi"), "minhash-crowd-texts")
        inside = _links_in_blocks(crowded.join(shingles_of(sets, size).dropDuplicates(["doc_id"]), "doc_id"), percent)
        links = links.union(confirmed(across, docs, size, percent, key, text)).union(inside)
        links = stored(links, "minhash-more")
        tried = stored(tried.union(across), "minhash-tried")

    same = signed.where("n_shingles > 0").join(classes, ["set_1", "set_2", "n_shingles"]).where("doc_id <> rep")
    # rows repeated under one doc_id with other texts tie their classes together as well
    tied = same.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    links = links.union(tied.select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")))
    label = stored(components(stored(links, "minhash-all"), "minhash-last"), "minhash-label")
    of_class = stored(classes.join(label.withColumnRenamed("id", "rep"), "rep", "left")
                      .select("set_1", "set_2", "n_shingles", F.coalesce("component", "rep").alias("component")), "minhash-of-class")
    out = signed.select("doc_id", "n_shingles", "set_1", "set_2").join(of_class, ["set_1", "set_2", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
