"""Removes word windows that an earlier document holds, by FM-indexes over content-dealt shards.

Every run of consecutive windows is anchored at the word k-gram of least hash inside the windows (its
minimiser), so equal windows have equal anchors wherever they stand, and a shard that gets all runs
of an anchor sees every occurrence of their windows.

1. Anchors that only one document has are dropped.
2. The runs of the others, each distinct run once with the smallest document that holds it, are
   dealt to shards by anchor.  An anchor with very many distinct runs is cut into single windows,
   dealt by the window itself, so no anchor is too large for a task.
3. Each shard builds a compressed FM-index of its runs and streams the runs backward through it,
   which gives the smallest document of every window's occurrences.
4. Windows whose smallest document comes before their own mark their words; the rest is kept.

Words are compared by a 64-bit hash each: two windows that differ in one word are taken as equal with
probability 2^-64.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import bloom, fm_index, textnum
from slotwise.llm.common import arrow_map, stored

WINDOW = 13
GRAM = 4                        # words of an anchor
MASK = (1 << 48) - 1            # bits of an anchor's hash that are kept; a collision only costs time
HOT_RUNS = 4096                 # distinct runs of an anchor beyond which they are cut into windows
SHARD_WORDS = 400_000           # words that one FM-index holds, at least one anchor's
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def runs_of(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a slice of documents: document, first word in the slice, windows, anchor."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none, none, none
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    grams = textnum.mix(textnum.combine(words, GRAM))
    inside = np.flatnonzero(doc[:len(words) - window + 1] == doc[window - 1:])
    if not len(inside):
        return none, none, none, none
    width = window - GRAM + 1
    anchor_at = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(1)[inside] + inside
    new = np.ones(len(inside), bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (inside[1:] != inside[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(inside)))
    return doc[inside[first]], inside[first], n, (grams[anchor_at[first]] & np.uint64(MASK)).astype(np.int64)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column in one array, and where each row's begin (one more for the end); nulls are empty."""
    sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(sizes))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, doc_id), once per run."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in textnum.slices(batch.column(1)):
                doc, _, _, anchor = runs_of(*textnum.word_hashes(buf, offsets), window)
                yield pa.RecordBatch.from_pydict({"anchor": anchor, "doc_id": ids[lo:hi][doc].astype(np.int64)})

    return arrow_map(docs, find, "anchor long, doc_id long")


def runs(docs: DataFrame, shared: np.ndarray | None, window: int) -> DataFrame:
    """(anchor, doc_id, start, words) of the runs whose anchor is shared; words as uint64 hashes.

    shared: a filter over the shared anchors; None: docs has them in the column ``anchors``."""
    wanted = docs.sparkSession.sparkContext.broadcast(shared) if shared is not None else None

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in textnum.slices(batch.column(1)):
                words, at = textnum.word_hashes(buf, offsets)
                doc, start, n, anchor = runs_of(words, at, window)
                if wanted is not None:
                    ok = bloom.contains(wanted.value, anchor)
                else:
                    own, ends = _flat(batch.column(2).slice(lo, hi - lo))
                    at_doc = np.searchsorted(doc, np.arange(hi - lo + 1))       # runs come in document order
                    ok = np.concatenate([np.zeros(0, bool), *[np.isin(anchor[a:b], own[c:d]) for a, b, c, d in
                                                              zip(at_doc[:-1], at_doc[1:], ends[:-1], ends[1:], strict=True) if a < b]])
                doc, start, n, anchor = doc[ok], start[ok], n[ok], anchor[ok]
                flat = words.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(ids[lo:hi][doc].astype(np.int64)), pa.array((start - at[doc]).astype(np.int32)),
                     pa.array([flat[8 * s:8 * (s + k + window - 1)] for s, k in zip(start.tolist(), n.tolist(), strict=True)], pa.binary())],
                    names=["anchor", "doc_id", "start", "words"])

    return arrow_map(docs, find, "anchor long, doc_id long, start int, words binary")


def _owners_in_shards(routed: DataFrame, window: int, known_by: str) -> DataFrame:
    """routed (route, run, words, owner), dealt by route: (route, ``known_by``, owners), one owner per
    window; a sequence is known by its run or by its words."""
    at, kind = (2, pa.binary()) if known_by == "words" else (1, pa.int64())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def answer() -> pa.RecordBatch:
            found = fm_index.first_owners([np.frombuffer(w, "<u8") for _, _, w, _ in held], np.array([o for *_, o in held]), window)
            return pa.RecordBatch.from_arrays([pa.array([r for r, *_ in held], pa.int64()), pa.array([row[at] for row in held], kind),
                                               pa.array(found, pa.list_(pa.int64()))], names=["route", known_by, "owners"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SHARD_WORDS and row[0] != held[-1][0]:
                    yield answer()
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) // 8
        if held:
            yield answer()

    dealt = routed.select("route", "run", "words", "owner").repartition("route").sortWithinPartitions("route")
    return arrow_map(dealt, search, f"route long, {known_by} {'binary' if at == 2 else 'long'}, owners array<long>")


def first_documents(found: DataFrame, window: int) -> DataFrame:
    """found (anchor, doc_id, start, words): (anchor, run, owners) per distinct run."""
    distinct = found.groupBy("anchor", "words").agg(F.min("doc_id").alias("owner"))
    distinct = stored(distinct.withColumn("run", F.xxhash64("words")), "substring-runs")
    hot = stored(distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT_RUNS).select("anchor"), "substring-hot")
    usual = distinct.join(hot, "anchor", "left_anti").select(F.col("anchor").alias("route"), "run", "words", "owner")
    # a run is known by its anchor's and its own hash from here on: its words go no further
    usual = stored(_owners_in_shards(usual, window, "run").withColumnRenamed("route", "anchor"), "substring-owners")

    single = distinct.join(hot, "anchor", "left_semi").select("anchor", "run", "owner", F.posexplode(F.expr(
        f"transform(sequence(0, length(words) div 8 - {window}), i -> substring(words, 8 * i + 1, {8 * window}))")).alias("place", "words"))
    single = stored(single, "substring-windows")
    windows = single.groupBy("words").agg(F.min("owner").alias("owner")).withColumn("run", F.xxhash64("words"))
    of_window = stored(_owners_in_shards(windows.withColumn("route", F.col("run")), window, "words"), "substring-window-owners")
    cut = single.join(of_window, "words").groupBy("anchor", single["run"]).agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("owners")[0].alias("owner")))).alias("o"))
    cut = cut.select("anchor", "run", F.transform("o", lambda x: x["owner"]).alias("owners"))
    return stored(usual.unionByName(cut), "substring-first")


def without_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text.

    Defined results: null and empty texts have no words; texts shorter than the window keep all;
    windows are judged on the input; a window repeated inside one document only stays; among
    documents the smallest id keeps it; rows repeated under one id are one document, each of whose
    rows loses the places found; an empty table gives an empty table; only the named columns are read.
    """
    rows = _rows(docs, key, text)
    shared = anchors(rows, window).groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    shared = stored(shared.select("anchor"), "substring-shared")
    wanted = bloom.build(shared, "anchor")
    source = rows
    if wanted is None:
        per_doc = anchors(rows, window).join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
        source = rows.join(stored(per_doc, "substring-per-doc"), "doc_id").select("doc_id", "text", "anchors")
    found = runs(source, wanted, window)
    first = first_documents(found, window)
    member = found.select("anchor", "doc_id", "start", F.xxhash64("words").alias("run"))
    marks = member.join(first, ["anchor", "run"]).select("doc_id", F.filter(F.transform(
        "owners", lambda o, i: F.when(o < F.col("doc_id"), F.col("start") + i)), lambda p: p.isNotNull()).alias("p")).where(F.size("p") > 0)
    marks = stored(marks.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("p"))).alias("places")), "substring-marks")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, begin = _flat(batch.column(2))
            for lo, hi, buf, offsets in textnum.slices(batch.column(1)):
                n, gone, left = [], [], []
                for row in range(lo, hi):
                    words = _WORD.findall(buf[offsets[row - lo]:offsets[row - lo + 1]].tobytes())
                    own = places[begin[row]:begin[row + 1]]
                    n.append(len(words))
                    if not len(own):
                        gone.append(0)
                        left.append(b" ".join(words))
                        continue
                    edge = np.bincount(own, minlength=len(words) + 1)[:len(words) + 1] - np.bincount(own + window, minlength=len(words) + 1)[:len(words) + 1]
                    drop = np.cumsum(edge)[:len(words)] > 0
                    gone.append(int(drop.sum()))
                    left.append(b" ".join(w for w, d in zip(words, drop.tolist(), strict=True) if not d))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                                  pa.array(left, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return arrow_map(rows.join(marks, "doc_id", "left").select("doc_id", "text", "places"), keep,
                     "doc_id long, n_words long, n_removed long, kept_text string")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
