"""Language identification by error-correcting output codes.

Every learned language gets a codeword; one binary n-gram classifier per bit (naive Bayes over
hashed byte 2- and 3-grams, letters only) predicts that bit.  Decoding weighs each bit's logistic
loss by how often that bit was right for that language on the training rows, and takes the
codeword of least total loss; documents whose two best codewords are close are flagged ambiguous.

The n-gram counts are sums over all training rows, made by the tasks and kept as a Spark table of
(language, bucket) rows; the tasks add them up per bit of the codewords.  The model has a
(buckets x bits) array, about 10 log2(n) bits, and (languages x bits) ones: every language is learned.

Defined results: null, empty or letterless text is ``und`` with score 0; without any training row
everything is ``und``; a single learned language gets score 1; equal losses go to the
alphabetically first language; repeated rows count as often as they stand there; rows without a
language are predicted but never learned from; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm import textnum
from slotwise.llm.common import arrow_map, stored

BUCKETS = 1 << 12           # for each n-gram length
FEATURES = 2 * BUCKETS
_FOLD = np.full(256, 32, np.uint32)          # all but letters becomes a blank
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def ngram_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents x FEATURES) counts of hashed byte n-grams that hold a letter."""
    n = len(offsets) - 1
    if not len(buf):
        return np.zeros((n, FEATURES))
    b = _FOLD[buf]
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    out = []
    for size, times in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        m = len(b) - size + 1
        if m < 1:
            out.append(np.zeros((n, BUCKETS)))
            continue
        key = b[:m].copy()
        for i in range(1, size):
            key = key * np.uint32(257) + b[i:m + i]
        ok = (doc[:m] == doc[size - 1:]) & (key != 32 * 257 + 32 if size == 2 else b[1:m + 1] != 32)
        slot = (key * np.uint32(times)) >> np.uint32(20)
        at = doc[:m][ok].astype(np.int64) * BUCKETS + slot[ok]
        out.append(np.bincount(at, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float64))
    return np.hstack(out)


def in_blocks(buf: np.ndarray, offsets: np.ndarray, most: int = 256) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first document, end document, counts) of at most ``most`` documents at a time, however short they are."""
    for first in range(0, len(offsets) - 1, most):
        last = min(first + most, len(offsets) - 1)
        yield first, last, ngram_counts(buf[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])


def codewords(n: int) -> np.ndarray:
    """(languages x bits) of +-1: all splits into two parts for up to 6 languages, else random
    codes of 10 log2(n) bits, the best of many draws by smallest distance between rows (above 256
    languages the first draw whose rows all differ)."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = [[1 if c == 0 or s >> (c - 1) & 1 else -1 for c in range(n)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, float).T
    bits, rng, best, most = int(np.ceil(10 * np.log2(n))), np.random.default_rng(7), None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        if n > 256:
            if len(np.unique(code, axis=0)) == n:
                return code
            continue
        apart = (code[:, None, :] != code[None, :, :]).sum(2) + np.eye(n) * bits
        if apart.min() > most:
            best, most = code, apart.min()
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray            # languages x bits
    weights: np.ndarray         # features x bits: log ratio of the n-gram under both bit values
    trust: np.ndarray           # languages x bits: how much a bit's loss counts

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum(1, keepdims=True)
        return counts @ self.weights / np.maximum(total, 1)

    def losses(self, counts: np.ndarray) -> np.ndarray:
        z = self.margins(counts)
        plus, minus = self.trust * (self.code > 0), self.trust * (self.code < 0)
        return (np.logaddexp(0, -z) @ plus.T + np.logaddexp(0, z) @ minus.T) / self.trust.sum(1)[None, :]


def model_from_sums(langs: list[str], code: np.ndarray, of_ones: np.ndarray, of_all: np.ndarray) -> Model:
    """Bit classifiers from (FEATURES x bits) and (FEATURES) sums of the languages' n-gram shares; languages weigh alike."""
    if len(langs) == 1:
        weights = np.ones((FEATURES, 1))
    else:
        ones, zeros = of_ones / (code > 0).sum(0), (of_all[:, None] - of_ones) / (code < 0).sum(0)
        weights = np.log(ones) - np.log(zeros)
        apart = np.abs(((ones - zeros) * weights).sum(0)) / 4
        weights = weights / np.maximum(apart, 1e-9) * 3      # +-3 is the mean margin of either side
    return Model(langs, code, weights, np.ones_like(code))


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from every row of ``train`` that has a language.  None without training rows."""
    rows = train.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().toLocalIterator())
    if not langs:
        return None
    index = {x: i for i, x in enumerate(langs)}
    code = codewords(len(langs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([index[x] for x in batch.column(1).to_pylist()], int)
            for lo, hi, buf, offsets in textnum.slices(batch.column(0)):
                here, place = np.unique(at[lo:hi], return_inverse=True)
                sums = np.zeros((len(here), FEATURES))
                for first, last, part in in_blocks(buf, offsets):
                    np.add.at(sums, place[first:last], part)
                i, j = np.nonzero(sums)
                yield pa.RecordBatch.from_pydict({"i": here[i].astype(np.int32), "j": j.astype(np.int32), "n": sums[i, j]})

    counts = stored(arrow_map(rows, count, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")), "lang-ngrams")
    half = (F.col("j") >= BUCKETS).cast("int").alias("h")
    total = np.full((len(langs), 2), 0.5 * BUCKETS)
    for r in counts.groupBy("i", half).agg(F.sum("n").alias("n")).toLocalIterator():
        total[r["i"], r["h"]] += r["n"]

    def per_bit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.concatenate([code > 0, np.ones((len(langs), 1))], 1)
        sums, seen = np.zeros((FEATURES, bits.shape[1])), np.zeros(FEATURES, bool)
        for batch in batches:
            i, j, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for lo in range(0, len(i), 4096):
                x, y = i[lo:lo + 4096], j[lo:lo + 4096]
                np.add.at(sums, y, bits[x] * (n[lo:lo + 4096] / total[x, (y >= BUCKETS).astype(int)])[:, None])
                seen[y] = True
        j = np.flatnonzero(seen)
        for lo in range(0, len(j), 1024):
            k = j[lo:lo + 1024]
            yield pa.RecordBatch.from_pydict({"j": np.repeat(k, sums.shape[1]).astype(np.int32), "b": np.tile(np.arange(sums.shape[1], dtype=np.int32), len(k)),
                                              "p": sums[k].ravel()})

    low = 0.5 / total                                           # every bucket's share without any n-gram
    sums = np.repeat(low.T @ np.concatenate([code > 0, np.ones((len(langs), 1))], 1), BUCKETS, 0)
    for r in arrow_map(counts, per_bit, "j int, b int, p double").groupBy("j", "b").agg(F.sum("p").alias("p")).toLocalIterator():
        sums[r["j"], r["b"]] += r["p"]
    model = model_from_sums(langs, code, sums[:, :-1], sums[:, -1])

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, seen = np.zeros(model.code.shape), np.zeros(len(langs))
        for batch in batches:
            at = np.array([index[x] for x in batch.column(1).to_pylist()], int)
            for lo, hi, buf, offsets in textnum.slices(batch.column(0)):
                for first, last, part in in_blocks(buf, offsets):
                    known = at[lo + first:lo + last]
                    np.add.at(good, known, model.margins(part) * model.code[known] > 0)
                    np.add.at(seen, known, 1)
        i, b = np.indices(model.code.shape).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "b": b.astype(np.int32), "good": good.ravel(),
                                          "seen": np.repeat(seen, model.code.shape[1])})

    for r in (arrow_map(rows, right, "i int, b int, good double, seen double").groupBy("i", "b")
              .agg(F.sum("good").alias("good"), F.sum("seen").alias("seen")).collect()):
        model.trust[r["i"], r["b"]] = max((r["good"] + 0.5) / (r["seen"] + 1), 0.01)
    return model


def predict(docs: DataFrame, model: Model | None, keep: dict[str, Column], text: str = "text",
            ambiguous_below: float = 0.1) -> DataFrame:
    """The ``keep`` columns of every row, with lang_pred, score (0 to 1) and ambiguous.

    score is 1 less the best loss over the second best: 0 for a tie."""
    rows = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text).alias("_text"))
    if model is None:
        return rows.drop("_text").withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "ambiguous": F.lit(True)})

    names_out = [*keep, "lang_pred", "score", "ambiguous"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, "und"], object)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            pred, score = np.full(len(column), len(model.langs)), np.zeros(len(column))
            for lo, hi, buf, offsets in textnum.slices(column):
                letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[buf])])
                has = letters[offsets[1:]] > letters[offsets[:-1]]
                for k in np.flatnonzero(~has & (np.diff(offsets) > 0)):
                    has[k] = any(c.isalpha() for c in column[lo + int(k)].as_py())
                for first, last, part in in_blocks(buf, offsets):
                    at = lo + first + np.flatnonzero(has[first:last])
                    loss = model.losses(part[has[first:last]])
                    ranked = np.sort(loss, 1)
                    pred[at] = loss.argmin(1)
                    score[at] = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-300) if len(model.langs) > 1 else 1.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[pred], pa.string()), pa.array(np.clip(score, 0, 1)),
                 pa.array(score < ambiguous_below)], names=names_out)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return arrow_map(rows, label, f"{kept}, lang_pred string, score double, ambiguous boolean")
