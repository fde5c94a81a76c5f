"""Quality rules: divergence of a document's histograms from those of its language.

Two histograms describe a document: its characters by class, and its words over the common words of
its language (all others in one bin).  References are the same histograms over the whole corpus,
per language; languages with too little text, and documents without a language, use the reference
of the whole corpus.  A document fails when the Jensen-Shannon distance (base 2, so 0 to 1) of
either histogram is too large; texts too short for a histogram to mean anything are not judged by
it.  Base rules on length and repetition come first.

Only DataFrame functions are used.  Text is never shuffled: word counts are aggregated inside
the tasks first, and the references (a bounded number of languages with at most 1 / ``min_share``
common words each) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import bounded_broadcast, let, stored

#: Character classes, counted one after the other on what the earlier ones leave; the last bin is the rest.
CLASSES = ("[a-z]+", r"[\x20\x09-\x0D]+", r"\p{L}+", "[0-9]+", r"[.,;:!?'\"()-]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_SHARE = 0.005               # a common word makes at least this share of its language's words
MIN_REFERENCE_WORDS = 2000      # a language with fewer words has no reference of its own
MIN_CHARS, MIN_WORDS = 200, 50  # shorter texts are not judged by that histogram
MAX_CHARS_DISTANCE, MAX_WORDS_DISTANCE = 0.35, 0.42
MAX_LANGUAGES = 1000            # references broadcast; with more, the join shuffles


def class_counts(text: Column) -> Column:
    """Struct: ``counts`` of the characters in each class (the rest last), ``symbols`` among the rest."""
    def step(left: Column, patterns: tuple[str, ...], done: list[Column]) -> Column:
        if not patterns:
            return F.struct(F.array(*done, F.length(left).cast("long")).alias("counts"),
                            F.regexp_count(left, F.lit(f"[{SYMBOLS}]")).cast("long").alias("symbols"))
        return let(F.regexp_replace(left, patterns[0], ""), lambda rest: step(
            rest, patterns[1:], [*done, (F.length(left) - F.length(rest)).cast("long")]))
    return step(text, CLASSES, [])


def _starts_of_repeats(hashes: Column) -> Column:
    """Ascending places of the hashes that occur twice or more."""
    def few(order: Column) -> Column:
        """The hashes that repeat, from the sorted hashes."""
        return F.array_distinct(F.filter(order, lambda h, j: F.coalesce(F.get(order, j + 1) == h, F.lit(False))))

    def by_sorting(order: Column) -> Column:
        twin = F.filter(order, lambda x, j: (
            F.coalesce(F.get(order, j + 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.when(j > 0, F.get(order, j - 1)["h"] == x["h"]), F.lit(False))))
        return F.sort_array(F.transform(twin, lambda x: x["i"]))

    def find(twice: Column) -> Column:
        listed = F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # looking up a short list is quickest; sorting hashes with their places bounds the rest
        return F.when(F.size(twice) <= 64, listed).otherwise(let(placed, by_sorting))

    none = F.array().cast("array<int>")
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(
        let(let(F.sort_array(hashes), few), find))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside a window of consecutive words that the text holds twice or more."""
    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda n, x: n + x)

    n = F.greatest(F.size(words) - (window - 1), F.lit(0))
    hashes = F.transform(F.arrays_zip(*[F.slice(words, k + 1, n) for k in range(window)]), lambda x: F.xxhash64(x))
    return let(hashes, lambda h: let(_starts_of_repeats(h), covered))


def split_words(text: Column) -> Column:
    """All words of a text: its other white space becomes blanks, then it is cut at blanks."""
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def base_columns(docs: DataFrame) -> DataFrame:
    """docs (.., _text, _words, _classes) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed."""
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": (F.length("_text") - F.col("_classes.counts")[1]).cast("long"),
        "n_symbols": F.col("_classes.symbols"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_words")),
    })
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _half_divergence(p: Column, q: Column) -> Column:
    """One bin's share of the divergence (0 log 0 = 0)."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    return (term(p, q) + term(q, p)) / 2


def chars_distance(counts: Column, shares: Column) -> Column:
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(1))
    parts = F.transform(counts, lambda n, i: _half_divergence(n / total, F.get(shares, i)))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def words_distance(words: Column, common: Column, shares: Column) -> Column:
    """common: a language's common words; shares: theirs, in the same order.  Only the runs of sorted
    places are visited: a common word that is absent adds half its share."""
    n = F.greatest(F.size(words), F.lit(1))

    def of_runs(order: Column) -> Column:
        first = F.filter(F.transform(order, lambda x, i: F.when((i == 0) | (F.get(order, i - 1) != x), i)), lambda i: i.isNotNull())

        def total(starts: Column) -> Column:
            runs = F.transform(starts, lambda s, j: F.struct(
                ((F.coalesce(F.get(starts, j + 1), F.size(order)) - s) / n).alias("p"),
                F.get(shares, F.get(order, s) - 1).alias("q")))
            fold = F.aggregate(
                runs, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q")),
                lambda a, x: F.struct((a["d"] + _half_divergence(x["p"], x["q"])).alias("d"),
                                      (a["p"] + x["p"]).alias("p"), (a["q"] + x["q"]).alias("q")))
            every = F.aggregate(shares, F.lit(0.0), lambda s, x: s + x)
            return let(fold, lambda a: F.sqrt(F.greatest(
                a["d"] + (every - a["q"]) / 2
                + _half_divergence(F.greatest(1 - a["p"], F.lit(0.0)), F.greatest(1 - every, F.lit(0.0))), F.lit(0.0))))
        return let(first, total)

    places = F.transform(words, lambda w: F.array_position(common, w).cast("int"))
    return let(F.sort_array(F.filter(places, lambda x: x > 0)), of_runs)


def word_references(docs: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE,
                    min_words: int = MIN_REFERENCE_WORDS) -> DataFrame:
    """(lang, common, word_shares) of each language with enough words; lang null: the whole corpus."""
    rows = docs.select(F.col(lang).alias("lang"), F.coalesce(text, F.lit("")).alias("t"))
    by_word = rows.select("lang", F.explode(split_words(F.col("t"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    by_word = stored(by_word, "divergence-words")

    def common(frequent: DataFrame) -> DataFrame:
        return frequent.select("lang", "word", (F.col("n") / F.col("total")).alias("share")).groupBy("lang").agg(
            F.sort_array(F.collect_list(F.struct("word", "share"))).alias("c")).select(
            "lang", F.transform("c", lambda x: x["word"]).alias("common"), F.transform("c", lambda x: x["share"]).alias("word_shares"))

    totals = stored(by_word.groupBy("lang").agg(F.sum("n").alias("total")), "divergence-total")
    own = by_word.join(totals.where(F.col("total") >= min_words), "lang").where(F.col("n") >= min_share * F.col("total"))
    total = totals.agg(F.sum("total")).first()[0] or 0
    whole = by_word.groupBy("word").agg(F.sum("n").alias("n")).where((F.lit(total) >= min_words) & (F.col("n") >= min_share * F.lit(total)))
    whole = whole.select(F.lit(None).cast("string").alias("lang"), "word", "n", F.lit(total).alias("total"))
    return stored(common(own).unionByName(common(whole)), "divergence-common")


def class_references(stats: DataFrame, min_words: int = MIN_REFERENCE_WORDS) -> DataFrame:
    """(lang, class_shares) from stored per-document counts; lang null: the whole corpus."""
    bins = range(len(CLASSES) + 1)
    by_lang = stored(stats.groupBy("_lang").agg(F.sum("n_words").alias("n_words"), *[F.sum(F.col("_counts")[i]).alias(f"c{i}") for i in bins]),
                     "divergence-classes")
    whole = by_lang.agg(F.sum("n_words").alias("n_words"), *[F.sum(f"c{i}").alias(f"c{i}") for i in bins]).withColumn("_lang", F.lit(None).cast("string"))
    sums = by_lang.where(F.col("_lang").isNotNull()).unionByName(whole).where(F.col("n_words") >= min_words)
    total = F.greatest(sum((F.col(f"c{i}") for i in bins), F.lit(0)), F.lit(1))
    return stored(sums.select("_lang", F.array(*[F.col(f"c{i}") / total for i in bins]).alias("class_shares")), "divergence-shares")


def _held_against(rows: DataFrame, reference: DataFrame, values: list[str], kinds: list[str]) -> DataFrame:
    """rows with the reference of their language, else of the whole corpus (one row, as literals)."""
    whole = reference.where(F.col("_lang").isNull()).select(*values).first()
    rows = rows.join(bounded_broadcast(reference.where(F.col("_lang").isNotNull()), MAX_LANGUAGES), "_lang", "left")
    if whole is None:
        return rows
    return rows.withColumns({v: F.coalesce(v, F.array(*[F.lit(x) for x in whole[v]]).cast(k)) for v, k in zip(values, kinds, strict=True)})


def divergence_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                     max_chars: float = MAX_CHARS_DISTANCE, max_words: float = MAX_WORDS_DISTANCE) -> DataFrame:
    """Per row: key, the base columns, base_failed, kept, reason, chars_distance, words_distance.

    Two passes over the texts: common words per language, then everything about a document but its
    characters' distance, which needs only the small stored rows of the second pass.

    Defined results: null and empty texts have no words and fail the base rules, and what fails there
    has no words_distance; a null or rare
    language is held against the whole corpus, and without enough words there either only the base
    rules judge; repeated rows are judged alike; a distance equal to its limit passes; an empty table
    gives an empty table; only the named columns are read.
    """
    words = word_references(docs, text, lang).withColumnRenamed("lang", "_lang")
    rows = docs.select(F.col(key), F.col(lang).alias("_lang"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = _held_against(rows, words, ["common", "word_shares"], ["array<string>", "array<double>"])
    rows = rows.withColumns({"_words": split_words(F.col("_text")), "_classes": class_counts(F.col("_text"))})
    rows = base_columns(rows).withColumn("words_distance", F.when(
        ~F.col("base_failed") & (F.col("n_words") >= MIN_WORDS) & (F.size("common") > 0),
        words_distance(F.col("_words"), F.col("common"), F.col("word_shares"))))
    stats = stored(rows.select(key, "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                               F.col("_classes.counts").alias("_counts"), "words_distance"), "divergence-stats")
    judged = _held_against(stats, class_references(stats), ["class_shares"], ["array<double>"])
    chars = F.aggregate("_counts", F.lit(0).cast("long"), lambda n, x: n + x)
    judged = judged.withColumn("chars_distance", F.when(
        (chars >= MIN_CHARS) & F.col("class_shares").isNotNull(), chars_distance(F.col("_counts"), F.col("class_shares"))))
    reason = (F.when(F.col("base_failed"), "base").when(F.col("chars_distance") > max_chars, "chars")
              .when(F.col("words_distance") > max_words, "words"))
    return judged.withColumn("reason", reason).select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("reason").isNull().alias("kept"), "reason", "chars_distance", "words_distance")


def oracle() -> str:
    """DuckDB: the same rules; words and windows as rows."""
    classes = [c.replace("'", "''") for c in CLASSES]
    left, counts = ["t"], []
    for c in classes:
        left.append(f"regexp_replace({left[-1]}, '{c}', '', 'g')")
        counts.append(f"length({left[-2]}) - length({left[-1]})")
    counts.append(f"length({left[-1]})")
    columns = ", ".join(f"{x} AS c{i}" for i, x in enumerate(counts))
    bins = range(len(CLASSES) + 1)

    def half(p: str, q: str) -> str:
        return (f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
                f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END) / 2")

    total = " + ".join(f"c{i}" for i in bins)
    of_lang = ", ".join(f"sum(c{i})::DOUBLE / greatest(sum({total}), 1) AS q{i}" for i in bins)
    chars = " + ".join(half(f"(c{i}::DOUBLE / greatest({total}, 1))", f"coalesce(o.q{i}, a.q{i})") for i in bins)
    return f"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, lang, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
    u AS (SELECT doc_id, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
    five AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER s || ' '
             || lead(word, 2) OVER s || ' ' || lead(word, 3) OVER s || ' ' || lead(word, 4) OVER s AS k FROM u
             WINDOW s AS (PARTITION BY doc_id ORDER BY i)) x WHERE k IS NOT NULL),
    rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat FROM five, range(0, 5) r(o) WHERE n > 1 GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
              WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    base AS (SELECT d.doc_id, d.lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
               length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
               coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, {columns}
             FROM d JOIN w USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
    failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
    own_c AS (SELECT lang, {of_lang} FROM base WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {MIN_REFERENCE_WORDS}),
    all_c AS (SELECT {of_lang} FROM base HAVING sum(n_words) >= {MIN_REFERENCE_WORDS}),
    counted AS (SELECT lang, word, count(*) AS n FROM u GROUP BY ALL),
    common AS (SELECT lang, word, n / t AS q FROM (SELECT *, sum(n) OVER (PARTITION BY lang) AS t FROM counted WHERE lang IS NOT NULL)
               WHERE t >= {MIN_REFERENCE_WORDS} AND n >= {MIN_SHARE} * t),
    everyword AS (SELECT word, n / t AS q FROM (SELECT word, sum(n) AS n, sum(sum(n)) OVER () AS t FROM counted GROUP BY word)
               WHERE t >= {MIN_REFERENCE_WORDS} AND n >= {MIN_SHARE} * t),
    ref AS (SELECT f.doc_id, f.n_words, c.word, c.q FROM failed f JOIN common c USING (lang)
            UNION ALL SELECT f.doc_id, f.n_words, e.word, e.q FROM failed f, everyword e WHERE NOT EXISTS (SELECT 1 FROM common c WHERE c.lang = f.lang)),
    hits AS (SELECT doc_id, word, count(*) AS n FROM u GROUP BY ALL),
    bins AS (SELECT r.doc_id, r.q, coalesce(h.n, 0)::DOUBLE / r.n_words AS p FROM ref r LEFT JOIN hits h USING (doc_id, word) WHERE r.n_words > 0),
    rest AS (SELECT doc_id, sum({half('p', 'q')}) AS s, greatest(1 - sum(p), 0) AS p, greatest(1 - sum(q), 0) AS q FROM bins GROUP BY doc_id),
    wd AS (SELECT doc_id, sqrt(greatest(s + {half('p', 'q')}, 0)) AS words_distance FROM rest),
    judged AS (SELECT f.*, CASE WHEN {total} >= {MIN_CHARS} AND coalesce(o.q0, a.q0) IS NOT NULL THEN sqrt(greatest({chars}, 0)) END AS chars_distance,
               CASE WHEN NOT base_failed AND n_words >= {MIN_WORDS} THEN words_distance END AS words_distance
             FROM failed f LEFT JOIN own_c o USING (lang) LEFT JOIN all_c a ON true LEFT JOIN wd USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason IS NULL AS kept, reason
    FROM (SELECT *, CASE WHEN base_failed THEN 'base' WHEN chars_distance > {MAX_CHARS_DISTANCE} THEN 'chars'
                         WHEN words_distance > {MAX_WORDS_DISTANCE} THEN 'words' END AS reason FROM judged)"""
