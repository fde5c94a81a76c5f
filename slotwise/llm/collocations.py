"""Phrase collocations from one count of padded four-word windows.

Every word starts one window: it and the three words that follow in its piece, padded at the
piece's end.  Only these longest windows are counted; the counts of all shorter phrases are the sums
of their extensions (padding included), which a ROLLUP over the window's first three words yields in one
pass, so no n-gram is exploded for itself.

A phrase can't be more frequent than its words, so words below the minimum end a window as padding
does.  Words that reach it get numbers while they fit ``MAX_WORDS`` (windows are then two 64-bit
numbers); with more words the same windows are counted as strings, none left out.

Windows are dealt by their first two words, so the counts of four and three words are complete in
one task, and third words that can't make a phrase are folded into the padding before the ROLLUP shuffles
again.  Pairs of hot words (each at least 1 in ``HOT`` of all words) are dealt by their third word
too, triples of hot words by their fourth; what then isn't complete in a task is left to the ROLLUP.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm import textnum
from slotwise.llm.common import arrow_map, bounded_broadcast, stored

LONGEST, MIN_COUNT, TOP = 4, 30, 2000
CONTAINED_PERCENT = 80
SCORE_SCALE = 2_000_000
MAX_WORDS = 1_000_000
MAX_LANGS = 10_000
HOT, SALTS = 1000, 64
#: A language's candidates are ranked in this many hash groups before the survivors are ranked together.
RANK_GROUPS = 256
#: Bytes that end a piece, and those that end a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(PIECE_ENDS)] = True
WORD_BYTES = ~_ENDS_PIECE
WORD_BYTES[[32, 9]] = False
_WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, pa.DictionaryArray, np.ndarray]]:
    """Per slice of texts (text, lang): the languages, each word's language, the words, each word's piece."""
    langs = batch.column(1).dictionary_encode()
    of_row = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for row, stop, buf, offsets in textnum.slices(batch.column(0)):
        words, first = textnum.runs(buf, offsets, WORD_BYTES, lower=True)
        if len(words):
            doc = np.repeat(np.arange(stop - row), np.diff(first))
            ends = np.cumsum(_ENDS_PIECE[buf])[textnum.run_starts(buf, offsets, WORD_BYTES)]
            yield langs.dictionary, of_row[row:stop][doc], words.dictionary_encode(), doc * (len(buf) + 1) + ends


def _codes(words: pa.DictionaryArray) -> np.ndarray:
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, word, n) of the words with ``min_count`` occurrences, stored; word null: all of a language's
    words (0 for one without any)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "word", "n"]
        for batch in batches:
            seen = batch.column(1).unique()
            yield pa.RecordBatch.from_arrays([seen, pa.nulls(len(seen), pa.string()), pa.array(np.zeros(len(seen), np.int64))], names=names)
            for langs, of_word, words, _ in _slices(batch):
                keys, n = np.unique(of_word * len(words.dictionary) + _codes(words), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(keys // len(words.dictionary))), words.dictionary.take(pa.array(keys % len(words.dictionary))), pa.array(n)], names=names)
                all_of = np.bincount(of_word, minlength=len(langs))
                yield pa.RecordBatch.from_arrays([langs, pa.nulls(len(langs), pa.string()), pa.array(all_of)], names=names)

    counts = arrow_map(_rows(docs, text, lang), count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("word").isNull() | (F.col("n") >= min_count)), "collocation-words")


def _follow(w: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
    """The window of each word: itself and the next ones, 0 from its piece's end on or from a 0."""
    columns = [w]
    for k in range(1, LONGEST):
        at = np.zeros_like(w)
        if len(w) > k:
            at[:-k] = np.where((piece[k:] == piece[:-k]) & (columns[-1][:-k] > 0), w[k:], 0)
        columns.append(at)
    return columns


def _windows(w: np.ndarray, piece: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A slice's different windows of numbers as (first two, last two, how many of the first three are hot
    from the second on, count)."""
    w1, w2, w3, w4 = _follow(w, piece)
    some = w1 > 0
    first, last = w1[some] << 32 | w2[some], w3[some] << 32 | w4[some]
    order = np.lexsort((last, first))
    first, last = first[order], last[order]
    starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])])[:len(first)])
    n = np.diff(np.append(starts, len(first)))
    first, last = first[starts], last[starts]
    pair = hot[first >> 32] & hot[first & _LOW]
    return first, last, pair.astype(np.int32) + (pair & hot[last >> 32]), n


_LOW = (1 << 32) - 1


def _numbered_windows(rows: DataFrame, numbers: dict[str, dict[str, int]], hot: set[tuple[str, str]]) -> DataFrame:
    """Windows (first, last: two words' numbers each, 0 for padding, heat, n), counted within slices."""
    known = rows.sparkSession.sparkContext.broadcast((numbers, sorted(numbers[g][w] for g, w in hot), sum(map(len, numbers.values()))))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of, hot_numbers, most = known.value
        is_hot = np.zeros(most + 1, bool)
        is_hot[hot_numbers] = True
        for batch in batches:
            for langs, of_word, words, piece in _slices(batch):
                size = len(words.dictionary)
                keys, at = np.unique(of_word * size + _codes(words), return_inverse=True)
                of = [number_of.get(x, {}) for x in langs.to_pylist()]
                names = words.dictionary.to_pylist()
                number = np.fromiter((of[k // size].get(names[k % size], 0) for k in keys.tolist()), np.int64, len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _windows(number[at], piece, is_hot)], names=["first", "last", "heat", "n"])

    return arrow_map(rows, windows, "first long, last long, heat int, n long")


def _named_windows(rows: DataFrame, hot: set[tuple[str, str]]) -> DataFrame:
    """Windows (lang, w1..w4: words, empty for padding, heat, n), counted within slices."""
    known = rows.sparkSession.sparkContext.broadcast(hot)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, of_word, words, piece in _slices(batch):
                size = len(words.dictionary)
                keys, at = np.unique(of_word * size + _codes(words), return_inverse=True)
                of, names = langs.take(pa.array(keys // size)), words.dictionary.take(pa.array(keys % size))
                is_hot = np.array([False, *((g, w) in known.value for g, w in zip(of.to_pylist(), names.to_pylist(), strict=True))])
                first, last, heat, n = _windows(at.astype(np.int64) + 1, piece, is_hot)
                names = pa.concat_arrays([pa.array([""], names.type), names])
                yield pa.RecordBatch.from_arrays([of.take(pa.array((first >> 32) - 1)), *[names.take(pa.array(x)) for x in (first >> 32, first & _LOW, last >> 32, last & _LOW)],
                                                  pa.array(heat), pa.array(n)], names=["lang", *_WORDS, "heat", "n"])

    return arrow_map(rows, windows, "lang string, " + ", ".join(f"{w} string" for w in _WORDS) + ", heat int, n long")


def _levels(windows: DataFrame, head: list[str], tail: list[str], third: Column, fourth: Column, nothing: Column, min_count: int) -> DataFrame:
    """(head.., third, fourth, n): the windows with ``min_count`` occurrences, and with fourth null the sums
    over the fourth word, where the third is ``nothing`` if it can't make a phrase.  Stored.

    Dealt by ``head`` (the first two words) and, for hot words, salts: one shuffle, and every step
    after it stays in its task.
    """
    by_third, by_fourth = (F.pmod(F.xxhash64(x), F.lit(SALTS)) for x in (third, fourth))
    salt = F.when(F.col("heat") == 0, 0).when(F.col("heat") == 1, 1 + by_third).otherwise(1 + SALTS + SALTS * by_third + by_fourth).cast("int")
    dealt = windows.withColumn("salt", salt).repartition(*head, "salt")
    counted = (dealt.groupBy(*head, "salt", "heat", *tail).agg(F.sum("n").alias("n"))
               .select(*head, "salt", "heat", third.alias("third"), fourth.alias("fourth"), "n"))
    # the condition on the word names n, so it stays above the count and both uses share one shuffle
    longest = counted.where((F.col("n") >= min_count) & (F.when(F.col("n") >= min_count, F.col("fourth")) != nothing))
    triples = counted.groupBy(*head, "salt", "heat", "third").agg(F.sum("n").alias("n"))
    kept = F.when((F.col("n") >= min_count) | (F.col("heat") == 2), F.col("third")).otherwise(nothing)
    folded = triples.withColumn("third", kept).groupBy(*head, "salt", "third").agg(F.sum("n").alias("n"))
    sums = folded.select(*head, "third", F.lit(None).cast(counted.schema["fourth"].dataType).alias("fourth"), "n")
    return stored(longest.select(*head, "third", "fourth", "n").unionByName(sums), "collocation-levels")


def _marginals(levels: DataFrame, lead: list[str], nothing, min_count: int) -> DataFrame:
    """(lead.., words: the phrase, f) of the phrases of one to four words with ``min_count`` occurrences;
    levels: (lead.., w1..w4, n), w4 null where summed over."""
    longest = levels.where("w4 IS NOT NULL").select(*lead, F.array(*_WORDS).alias("words"), F.col("n").alias("f"))
    sums = levels.where("w4 IS NULL").rollup(*lead, *_WORDS[:-1]).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    # left_out has a bit per column that a row sums over: 0, 1, 3 for three, two, one words
    phrase = F.when(F.col("left_out") == 0, F.array(*_WORDS[:3])).when(F.col("left_out") == 1, F.array(*_WORDS[:2])).otherwise(F.array("w1"))
    shorter = (sums.where((F.col("f") >= min_count) & F.col("left_out").isin(0, 1, 3)).select(*lead, phrase.alias("words"), "f")
               .where(F.element_at("words", -1) != nothing))
    return longest.unionByName(shorter)


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
            words: DataFrame | None = None) -> DataFrame:
    """(lang, words, f): every phrase of one to four words with ``min_count`` occurrences, stored."""
    counts = word_counts(docs, text, lang, min_count) if words is None else words
    frequent = counts.where("word IS NOT NULL")
    rows = _rows(docs, text, lang)
    total = counts.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    # at most HOT words
    hot = {(r["lang"], r["word"]) for r in frequent.where(F.col("n") * HOT >= total).select("lang", "word").collect()}
    if frequent.count() > max_words:
        levels = _levels(_named_windows(rows, hot), ["lang", "w1", "w2"], ["w3", "w4"], F.col("w3"), F.col("w4"), F.lit(""), min_count)
        levels = levels.select("lang", "w1", "w2", F.col("third").alias("w3"), F.col("fourth").alias("w4"), "n")
        return stored(_marginals(levels, ["lang"], F.lit(""), min_count), "collocation-phrases")
    numbers: dict[str, dict[str, int]] = {}
    # at most ``max_words`` words reach the driver; the most frequent ones get the small numbers
    table = frequent.orderBy(F.desc("n"), "lang", "word").select("lang", "word").toPandas()
    for k, (name, word) in enumerate(zip(table["lang"], table["word"], strict=True)):
        numbers.setdefault(name, {})[word] = k + 1
    halves = [half(F.col(c)).cast("int") for c in ("first", "last") for half in (lambda x: F.shiftright(x, 32), lambda x: x.bitwiseAND(F.lit(_LOW)))]
    levels = _levels(_numbered_windows(rows, numbers, hot), ["first"], ["last"], halves[2], halves[3], F.lit(0), min_count)
    levels = levels.select(halves[0].alias("w1"), halves[1].alias("w2"), F.col("third").alias("w3"), F.col("fourth").alias("w4"), "n")
    found = stored(_marginals(levels, [], F.lit(0), min_count), "collocation-numbers")
    table["number"] = np.arange(1, len(table) + 1, dtype=np.int32)
    named = rows.sparkSession.createDataFrame(pa.table({"lang": pa.array(table["lang"], pa.string()), "word": pa.array(table["word"], pa.string()),
                                                        "number": pa.array(table["number"], pa.int32())}))
    out = found
    for k in range(LONGEST):                    # at most ``max_words`` rows, checked above
        one = named.select(F.col("number").alias("_number"), F.col("word").alias(f"_word{k}"), *([] if k else ["lang"]))
        out = out.join(F.broadcast(one), F.get("words", F.lit(k)) == F.col("_number"), "left" if k else "inner").drop("_number")
    return stored(out.select("lang", F.filter(F.array(*[f"_word{k}" for k in range(LONGEST)]), lambda x: x.isNotNull()).alias("words"), "f"),
                  "collocation-phrases")


def _inside() -> Column:
    """The phrases of two words or more that stand inside ``words``, as strings."""
    k = F.size("words")
    return F.flatten(F.transform(F.sequence(F.lit(2), k - 1), lambda m: F.transform(
        F.sequence(F.lit(1), k - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 a / (l + r)) in decimals: exact beyond 64 bits."""
    return F.call_function("div", a.cast("decimal(38,0)") * F.lit(SCORE_SCALE), (left + right).cast("decimal(38,0)"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP,
                 max_words: int = MAX_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut: each language's ``top`` phrases of two to four words.

    score = floor(2000000 a / (l + r)) for the cut of the phrase where it is lowest (ties: the first);
    phrases that a longer candidate holds with 80 % of their occurrences or more are left out.  Counts
    are whole numbers and the quotient is one of decimals, so nothing is rounded.

    Defined results: a null language is ``und``, null and empty texts have no words; ties go by a, then
    by the phrase's bytes; repeated rows count each; a language without candidates has no row; an
    empty table gives an empty table; only the named columns are read.
    """
    counts = word_counts(docs, text, lang, min_count)
    every = phrases(docs, text, lang, min_count, max_words, counts)
    known = every.select("lang", F.array_join("words", " ").alias("phrase"), "f")
    longer = every.where(F.size("words") > 2).select("lang", F.explode(_inside()).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("f_longer"))
    cand = every.where(F.size("words") > 1).select("lang", "words", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"))
    left_in = cand.join(longer, ["lang", "phrase"], "left").where(F.col("f_longer").isNull() | (F.col("f_longer") * 100 < F.col("a") * CONTAINED_PERCENT))
    cuts = stored(left_in.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ").alias("tail")), "collocation-cuts")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r")).alias("best"))
    scored = stored(lowest.select("lang", "phrase", "a", "best.*"), "collocation-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    some = scored.withColumn("_group", group)
    some = some.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order))).where(F.col("_at") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    all_words = counts.where("word IS NULL").select("lang", "n")
    return ranked.join(bounded_broadcast(all_words, MAX_LANGS), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def oracle() -> str:
    """DuckDB: n-grams of each length exploded and counted for themselves."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(ws[i:i + {k - 1}], ' ') AS phrase, {k} AS k, count(*) AS f FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM p) GROUP BY ALL"
        for k in range(1, LONGEST + 1))
    return f"""
    WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
               SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
    g AS (SELECT * FROM ({grams}) WHERE f >= {MIN_COUNT}),
    cand AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, k, f AS a FROM g WHERE k > 1),
    longer AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS f_longer FROM (
               SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL),
    cuts AS (SELECT c.lang, c.phrase, c.a, cut, h.f AS l, t.f AS r, (c.a::HUGEINT * {SCORE_SCALE}) // (h.f + t.f) AS score
             FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
             JOIN g h ON h.lang = c.lang AND h.phrase = array_to_string(ws[1:cut], ' ') JOIN g t ON t.lang = c.lang AND t.phrase = array_to_string(ws[cut + 1:], ' ')),
    lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts),
    n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
    ranked AS (SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank FROM lowest w LEFT JOIN longer o
               ON o.lang = w.lang AND o.phrase = w.phrase WHERE nth = 1 AND (f_longer IS NULL OR 100 * f_longer < {CONTAINED_PERCENT} * a))
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}"""
