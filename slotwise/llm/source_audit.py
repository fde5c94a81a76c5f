"""Divergence audit of a corpus's sources: how far the smoothed term shares of each source of a
language lie from those of the language's other sources, and which terms a source has too often.

Counts are exact integers.  A worker counts the terms of a slice of texts by (lang, source), Spark
sums the counts; texts are read once.  The terms a source stands out by are found by a dominance
skyband: among the terms of a source, one with a higher count there, a lower count in the language
and an earlier name comes before another in the ranking, so a term that ``top`` others dominate can't
be among the first ``top``.  Every partition keeps its own skyband in one pass over rows sorted so that
a term's dominators come before it; the union of the skybands holds every term of the final ranking
and is ranked exactly.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm import textnum
from slotwise.llm.common import arrow_map, bounded_broadcast, ship, stored

SCALE, PRIOR = 1_000_000_000, 5
MIN_DOCS, TOP = 30, 50
SLICE_BYTES = 4 << 20
BLOCK = 256
#: The groups' rows (a few numbers each) are broadcast up to this many; beyond, joins shuffle them.
MAX_GROUPS = 50_000
#: Bytes of terms: ASCII letters and everything above.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _group_ids(langs: pa.Array, sources: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of each row's (lang, source), and the two values of each number."""
    a, b = langs.dictionary_encode(), sources.dictionary_encode()
    of_lang, of_source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
    pairs, group = np.unique(of_lang * max(len(b.dictionary), 1) + of_source, return_inverse=True)
    return group, a.dictionary.take(pa.array(pairs // max(len(b.dictionary), 1))), b.dictionary.take(pa.array(pairs % max(len(b.dictionary), 1)))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n occurrences, n_docs documents), summed within slices of texts only.  Every
    group also has a row with term null."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, langs, sources = _group_ids(batch.column(1), batch.column(2))
            every = pa.nulls(len(langs), pa.string())
            zero = pa.array(np.zeros(len(langs), np.int64))
            yield pa.RecordBatch.from_arrays([langs, sources, every, zero, zero], names=["lang", "source", "term", "n", "n_docs"])
            for row, stop, buf, offsets in textnum.slices(batch.column(0), SLICE_BYTES):
                words, first = textnum.runs(buf, offsets, TERM_BYTES, lower=True)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                n_terms = len(coded.dictionary)
                # occurrences per (document, term), then occurrences and documents per (group, term)
                doc_term, n = np.unique(np.repeat(np.arange(stop - row), np.diff(first)) * n_terms + term, return_counts=True)
                of = group[row:stop][doc_term // n_terms] * n_terms + doc_term % n_terms
                keys, at = np.unique(of, return_inverse=True)
                place = pa.array(keys // n_terms)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(place), sources.take(place), coded.dictionary.take(pa.array(keys % n_terms)),
                     pa.array(np.bincount(at, n, len(keys)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(keys)))],
                    names=["lang", "source", "term", "n", "n_docs"])

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))])
    return arrow_map(rows, count, "lang string, source string, term string, n long, n_docs long")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), exactly (the product may pass 64 bits)."""
    top = (count + PRIOR).cast("decimal(38,0)") * F.lit(SCALE)
    return F.lit(1).cast("long") + F.call_function("div", top, (total + PRIOR * terms).cast("decimal(38,0)"))


def _skyband(top: int):
    """Keeps, of rows (lang, source, n, n_lang, term, ..) sorted by group, n down, n_lang up, term up, those
    that fewer than ``top`` rows of their group in this partition dominate.

    Dominators come first in that order, and are looked for among kept rows only: a dropped one
    has ``top`` kept dominators, which dominate the row too.  Memory: the skyband of one group.
    """
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, lows = None, [], np.zeros(0, np.int64)         # kept names in order, their n_lang
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (0, 1, 3, 4)]
            kept = []
            for lang, source, low, term in zip(*columns, strict=True):
                if group != (lang, source):
                    group, names, lows = (lang, source), [], np.zeros(0, np.int64)
                name = term.encode()
                at = bisect.bisect_left(names, name)
                kept.append(at < top or int(np.count_nonzero(lows[:at] <= low)) < top)
                if kept[-1]:
                    names.insert(at, name)
                    lows = np.insert(lows, at, low)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return keep


def skyband(rows: DataFrame, top: int) -> DataFrame:
    """Rows (lang, source, n, n_lang, term, f) that fewer than ``top`` others of their group dominate:
    per partition first, then among what the partitions kept."""
    order = ["lang", "source", F.desc("n"), "n_lang", "term"]
    rows = rows.select("lang", "source", "n", "n_lang", "term", "f")
    schema = "lang string, source string, n long, n_lang long, term string, f long"
    local = arrow_map(rows.sortWithinPartitions(*order), _skyband(top), schema)
    return arrow_map(local.repartition("lang", "source").sortWithinPartitions(*order), _skyband(top), schema)


def _block_distances(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of |p - p'| over the terms of a (lang, low block, high block, salt) between its sources: one row
    per two sources, with the number of terms.  Rows without a term name the sources (p: that of
    a count of 0)."""
    low, high = (k.as_py() for k in keys[1:3])
    marks = table.filter(pc.is_null(table["term"])).sort_by([("block", "ascending"), ("source", "ascending")])
    rows = table.filter(pc.is_valid(table["term"]))
    sources, block = marks["source"].to_pylist(), marks["block"].to_numpy()
    nothing = marks["p"].to_numpy()
    term = rows["term"].combine_chunks().dictionary_encode()
    n_terms = len(term.dictionary)
    at_term = term.indices.to_numpy(zero_copy_only=False)
    at_source = pc.index_in(rows["source"], marks["source"].combine_chunks()).to_numpy()
    order = np.argsort(at_term, kind="stable")
    at_term, at_source, p = at_term[order], at_source[order], rows["p"].to_numpy()[order]
    first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
    total = np.zeros((len(first), len(second)), np.int64)
    for start in range(0, n_terms, BLOCK):
        a, b = np.searchsorted(at_term, [start, start + BLOCK])
        dense = np.tile(nothing, (min(BLOCK, n_terms - start), 1))
        dense[at_term[a:b] - start, at_source[a:b]] = p[a:b]
        for k, s in enumerate(first):
            total[k] += np.abs(dense[:, second] - dense[:, s:s + 1]).sum(0)
    i, j = np.nonzero(first[:, None] < second[None, :] if low == high else np.ones(total.shape, bool))
    return pa.table({"lang": [keys[0].as_py()] * len(i), "source": [sources[first[k]] for k in i], "item": [sources[second[k]] for k in j],
                     "f": total[i, j], "n_terms": np.full(len(i), n_terms)})


def source_pairs(rows: DataFrame, groups: DataFrame, sources_per_block: int = 256, rows_per_task: int = 200_000) -> DataFrame:
    """(lang, source, item, value): the sum of |p - p'| over all kept terms for every two sources of a
    language, both ways round, as the result lists them.

    Sources are dealt to blocks of at most ``sources_per_block``; a task holds the terms of one
    salt for two blocks, so its size depends neither on a language's sources nor on its terms.
    Terms that neither block has add the distance of two counts of 0.
    """
    groups = groups.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / sources_per_block).cast("int"))
    groups = stored(groups.withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1), "audit-blocks")
    salts = max(1, -(-rows.count() // rows_per_task))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    numbered = bounded_broadcast(groups.select("lang", "source", "block", "blocks"), MAX_GROUPS)
    terms = rows.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int").alias("salt")).join(numbered, ["lang", "source"])
    marks = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("nothing").alias("p"), F.explode(every).alias("salt"), "block", "blocks")
    meet = (terms.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "salt", "source", "block", "term", "p"))
    ship(rows.sparkSession)
    sums = (meet.groupBy("lang", "low", "high", "salt")
            .applyInArrow(_block_distances, "lang string, source string, item string, f long, n_terms long")
            .groupBy("lang", "source", "item").agg(F.sum("f").alias("f"), F.sum("n_terms").alias("n_terms")))
    sums = stored(sums, "audit-sums")
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "f", "n_terms"))
    a = groups.select("lang", "source", "nothing", "n_kept")
    b = groups.select("lang", F.col("source").alias("item"), F.col("nothing").alias("nothing_item"))
    pairs = a.join(b, "lang").where("source != item").join(both, ["lang", "source", "item"], "left")
    seen, f = F.coalesce("n_terms", F.lit(0)), F.coalesce("f", F.lit(0))
    return pairs.select("lang", "source", "item", (f + (F.col("n_kept") - seen) * F.abs(F.col("nothing") - F.col("nothing_item"))).alias("value"))


def divergence_audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
                     top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair``: the distance of the source's term shares from
    those of each other source of the language.  Part ``term``: the ``top`` terms by which the
    source's share is above the language's.

    Terms are runs of ASCII letters and non-ASCII characters, in ASCII lower case; a language keeps
    those in at least ``min_docs`` of its rows.  Defined results: nulls are empty strings; texts
    without terms still make their group; a language without kept terms has distances of 0 and no
    terms; ties go by the item's bytes; repeated rows count each; an empty table gives an
    empty table; only the named columns are read.
    """
    counts = term_counts(docs, text, lang, source).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    counts = stored(counts, "audit-counts")
    everywhere = Window.partitionBy("lang", "term")
    rows = counts.where("term IS NOT NULL").withColumns({"n_lang": F.sum("n").over(everywhere), "d": F.sum("n_docs").over(everywhere)})
    rows = stored(rows.where(F.col("d") >= min_docs).drop("d", "n_docs"), "audit-kept")
    langs = rows.select("lang", "term", "n_lang").distinct().groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("n_lang").alias("all_lang"))
    groups = (counts.where("term IS NULL").select("lang", "source")
              .join(rows.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["total", "n_kept", "all_lang"]))
    nothing = F.when(F.col("n_kept") > 0, _share(F.lit(0), F.col("total"), F.greatest("n_kept", F.lit(1)))).otherwise(0)
    groups = stored(groups.withColumn("nothing", nothing), "audit-groups")
    shares = rows.join(bounded_broadcast(groups.drop("nothing"), MAX_GROUPS), ["lang", "source"]).withColumns({
        "p": _share(F.col("n"), F.col("total"), F.col("n_kept")), "q": _share(F.col("n_lang"), F.col("all_lang"), F.col("n_kept"))})
    shares = stored(shares.select("lang", "source", "term", "n", "n_lang", "p", "q"), "audit-shares")
    band = skyband(shares.where("p > q").withColumn("f", F.col("p") - F.col("q")), top)
    terms = band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("f").alias("value"))
    pairs = source_pairs(shares, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return terms.withColumn("rank", ranked).where(F.col("rank") <= top).unionByName(pairs.withColumn("rank", ranked))


def oracle() -> str:
    """DuckDB: the same numbers from every (source, kept term), ranked without a skyband."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share = "1 + ({scale}::HUGEINT * ({n} + {prior})) // ({total} + {prior} * v)"
    p = share.format(scale=SCALE, prior=PRIOR, n="coalesce(c.n, 0)", total="g.total")
    q = share.format(scale=SCALE, prior=PRIOR, n="k.n_lang", total="l.total")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
    u AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n_lang FROM u GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCS}),
    counted AS (SELECT lang, source, term, count(*) AS n FROM u JOIN kept USING (lang, term) GROUP BY ALL),
    langs AS (SELECT lang, count(*) AS v, sum(n_lang)::HUGEINT AS total FROM kept GROUP BY lang),
    grp AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN counted USING (lang, source) GROUP BY ALL),
    s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {p} AS p, {q} AS q
          FROM grp g JOIN langs l USING (lang) JOIN kept k ON k.lang = g.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f, 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) z
              ON z.lang = a.lang AND z.source = a.source AND z.item = b.source),
    terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM s WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
    UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank
                             FROM terms) WHERE rank <= {TOP}"""
