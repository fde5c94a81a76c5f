"""Personal data: patterns for direct identifiers, and terms that reveal them.

Emails, IP addresses, card and phone numbers are found by patterns and validated.  Their values are
the protected entities.  A term (word) reveals an entity as far as knowing the term tells of the
entity: their pointwise mutual information as a share of the entity's own information, with counts
smoothed (a term's lines are taken as ``smoothing`` more, which hold the entity as often as all
lines do).  It must also be supported: the lower confidence bound (Wilson, ``deviations`` standard
errors) of the entity's probability given the term is at least ``certainty``, which asks the same
of every corpus, however large; a word seen twice, once of them beside an entity, proves nothing.

Co-occurrence is counted over lines (term and entity in one line) and over documents, there only
for terms that stood near the entity in two different documents or more, and for entities that
hold at least one bit (at most half of the documents have them).  Near is up to ``REACH``
characters, so a word meets the entities around it and not all of a long document or line.  Terms
that reveal an entity are masked wherever they stand: removed if they tell all (no line or document
without the entity has them), else generalised.

Only DataFrame functions are used.  Places of matches and words are running sums of the lengths of
what lies between, taken block by block, so no array is copied once per element.  Shuffled are the
documents with entities, their words (once, by document), the counts of pairs and of terms (a task's,
each once), and the documents that are joined with their terms or spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import let, stored, words_of

#: The matches of these are those of the plain patterns (fixed values); possessive loops and the look
#: at the character before only keep long runs of word characters or digits from being tried again
#: at every place.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
PATTERN = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
#: A text without these characters has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
MASK = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "removed": ""}
SMOOTHING = 0.5
DISCLOSURE = 0.9
CERTAINTY, DEVIATIONS = 0.5, 1.0
REACH = 512                     # characters between a term and an entity
SUPPORT = 2                     # documents with a term near an entity, for the count over documents
BLOCK = 64
#: Up to so many terms are broadcast to the words of all documents; of more, up to so many 64-bit hashes, and the
#: words that have one of them are joined by a shuffle.
MOST_TERMS, MOST_HASHES = 200_000, 2_000_000
MOST_FLAGS = 1_000_000          # spans times stretches of a text, up to which far words are left out early
SPAN = "array<struct<start:int,end:int,kind:string,value:string>>"


def _luhn(digits: Column) -> Column:
    reverse = F.reverse(F.split(digits, ""))
    doubled = F.transform(reverse, lambda d, i: let(d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = F.transform(F.split(match, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
        return F.forall(part, lambda x: (F.length(x) <= 3) & (F.substring(x, 1, 3).cast("int") <= 255))
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(9, 15)


def running(values: Column, largest: bool = False) -> Column:
    """What stands before each element of an integer array: the sum, or with ``largest`` the maximum (0 at
    first).  Elements before the block and those inside it are taken apart, so n elements cost some n * BLOCK
    steps and no copies that grow."""
    def fold(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), (lambda a, x: F.greatest(a, x)) if largest else (lambda a, x: a + x))

    def join(a: Column, b: Column) -> Column:
        return F.greatest(a, b) if largest else a + b

    def over(v: Column) -> Column:
        n = F.floor((F.size(v) + BLOCK - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda b: fold(F.slice(v, b * BLOCK + 1, BLOCK)))
        return let(blocks, lambda s: let(F.transform(s, lambda x, b: fold(F.slice(s, 1, b))), lambda before: F.transform(
            v, lambda x, i: join(F.get(before, F.floor(i / BLOCK).cast("int")), fold(F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))))))

    return let(values, over)


def _spans(text: Column, kind: str) -> Column:
    """Valid matches of one kind, in order."""
    pattern = PATTERN[kind]

    def of(matches: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("value")))
        return F.filter(let(pairs, lambda x: F.zip_with(x, running(F.transform(x, lambda y: y["gap"] + y["size"])), lambda y, at: F.struct(
            (at + y["gap"]).alias("start"), (at + y["gap"] + y["size"]).alias("end"), y["value"].alias("value")))), lambda s: _valid(kind, s["value"]))

    none = F.array().cast(SPAN)
    labelled = F.transform(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, of(m))), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))
    may = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]")
    return F.coalesce(F.when(may, labelled), none)


def base_spans(docs: DataFrame) -> DataFrame:
    """docs (.., _text) with one array of spans per kind: _email, _ip, _card, _phone."""
    return docs.withColumns({f"_{k}": _spans(F.col("_text"), k) for k in KINDS})


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "term", "removed")]), kind).cast("int")


def ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), _rank(s["kind"]).alias("rank"), s["end"].alias("end"),
                                                  s["kind"].alias("kind"), s["value"].alias("value")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))


def described(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _words(text: Column) -> Column:
    """The words (line, start, end, term) of a text, in order."""
    def places(pairs: Column) -> Column:
        starts = running(F.transform(pairs, lambda x: x["gap"] + x["size"]))
        lines = running(F.transform(pairs, lambda x: x["breaks"]))
        return F.zip_with(pairs, F.zip_with(starts, lines, lambda a, n: F.struct(a.alias("at"), n.alias("line"))), lambda x, y: F.struct(
            (y["line"] + x["breaks"]).alias("line"), (y["at"] + x["gap"]).alias("start"), (y["at"] + x["gap"] + x["size"]).alias("end"), x["w"].alias("term")))

    def pairs(words: Column) -> Column:
        gaps = F.slice(F.split(text, r"[^\x20\x09-\x0D]+", -1), 1, F.size(words))
        return F.zip_with(gaps, words, lambda g, w: F.struct(F.length(g).alias("gap"), F.length(F.translate(g, "\t\x0b\x0c\r ", "")).alias("breaks"),
                                                             F.length(w).alias("size"), w.alias("w")))
    return let(let(words_of(text), pairs), places)


def entities(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, text_id, spans (base) and, where there are any, the text."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = base_spans(rows).withColumn("spans", F.concat(*[f"_{k}" for k in KINDS]))
    rows = rows.withColumn("spans", F.when(F.size("spans") > 1, ordered(F.col("spans"))).otherwise(F.col("spans")))
    return rows.select("doc_id", F.xxhash64("_text").alias("text_id"), "spans", F.when(F.size("spans") > 0, F.col("_text")).alias("text"))


def _buckets(start: Column, end: Column, around: int = 0) -> Column:
    """The stretches of REACH characters that a range touches, and those beside them."""
    return F.explode(F.sequence(F.floor(start / REACH) - around, F.floor((F.greatest(end, start + 1) - 1) / REACH) + around))


def _around(words: Column, spans: Column) -> Column:
    """The words that stand in stretches where one can be near a span, by a flag per stretch.  All words, if one
    is longer than a stretch (it may reach a span from far) or there are very many stretches and spans."""
    near = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(F.floor(s["start"] / REACH) - 2, F.floor(s["end"] / REACH) + 1))))
    last = F.floor(F.element_at(words, -1)["start"] / REACH)
    usual = (F.size(spans) * last < MOST_FLAGS) & F.forall(words, lambda w: w["end"] - w["start"] <= REACH)
    flags = let(near, lambda n: F.transform(F.sequence(F.lit(0).cast("long"), last), lambda b: F.array_contains(n, b)))
    return F.when(usual, let(flags, lambda f: F.filter(words, lambda w: F.get(f, F.floor(w["start"] / REACH).cast("int"))))).otherwise(words)


def near_words(found: DataFrame) -> DataFrame:
    """(doc_id, text_id, entity, term, n_lines): for each word near an entity and outside all, the number of
    lines that hold both; and with a null term for each entity, the number of lines that hold it.  A unit
    is one document id with one text.

    Words and spans are shuffled once, by unit; the groups by stretch and the counts stay in those
    partitions.  A group holds the words and spans of a stretch or three of one text, with the entities inside
    those words; pairs are rows, not arrays.
    """
    unit = ["doc_id", "text_id"]
    some = found.where("text IS NOT NULL").dropDuplicates(unit)
    words = stored(some.select(*unit, F.explode(let(_words(F.col("text")), lambda w: _around(w, F.col("spans")))).alias("w")).select(*unit, "w.*"), "pii-words")
    spans = some.select(*unit, F.explode("spans").alias("s")).select(*unit, "s.start", "s.end", F.col("s.value").alias("entity"))
    both = words.unionByName(spans, allowMissingColumns=True).repartition(*unit).withColumn("bucket", _buckets(F.col("start"), F.col("end")))
    first = F.col("bucket") == F.floor(F.col("start") / REACH)       # a long word is not copied to every stretch it touches
    word = F.when(F.col("term").isNotNull(), F.struct("line", "start", "end", F.when(first, F.col("term")).otherwise("").alias("term")))
    span = F.when(F.col("entity").isNotNull(), F.struct("start", "end", "entity"))
    met = both.groupBy(*unit, "bucket").agg(F.collect_list(word).alias("words"), F.collect_list(span).alias("spans"))

    def inside(w: Column) -> Column:
        over = F.filter("spans", lambda s: (s["start"] < w["end"]) & (s["end"] > w["start"]))
        return F.struct(w["line"].alias("line"), w["start"].alias("start"), w["term"].alias("term"),
                        F.array_distinct(F.transform(over, lambda s: s["entity"])).alias("own"))

    # words inside an entity are held in the stretches beside theirs too; a word that touches two stretches may be
    # inside an entity in one only, and is then in that of its start twice
    place, wide = F.floor(F.col("w.start") / REACH), F.when(F.size("w.own") > 0, 1).otherwise(0)
    near = (met.select(*unit, F.explode(F.transform("words", inside)).alias("w")).where((F.col("w.term") != "") | (F.size("w.own") > 0)).withColumn("bucket", F.explode(F.sequence(place - wide, place + wide)))
            .groupBy(*unit, "bucket").agg(F.collect_list("w").alias("words")))
    held = F.flatten(F.transform("words", lambda w: F.transform(w["own"], lambda e: F.struct(w["line"].alias("line"), w["start"].alias("at"), e.alias("entity")))))
    none = F.lit(None).cast("struct<line:int,start:int,term:string>")

    def apart(taken: Column) -> Column:
        return F.transform(F.filter("words", lambda w: (F.size(w["own"]) == 0) & ~F.array_contains(taken, w["start"])), lambda w: w.dropFields("own"))

    taken = F.array_distinct(F.transform(F.filter("words", lambda w: F.size(w["own"]) > 0), lambda w: w["start"]))
    # each word apart, and null for the entities' own lines; then what it meets: a word may hold very many entities
    each = near.withColumn("held", held).where(F.size("held") > 0).select(*unit, "bucket", "held", F.explode(F.concat(let(taken, apart), F.array(none))).alias("w"))
    meets = F.filter("held", lambda h: F.when(F.col("w").isNull(), F.floor(h["at"] / REACH) == F.col("bucket")).otherwise(F.abs(F.col("w.start") - h["at"]) <= REACH))
    found_near = each.select(*unit, "w", F.explode(meets).alias("h")).select(*unit, F.col("h.entity").alias("entity"), F.col("w.term").alias("term"), F.when(
        F.col("w").isNull() | (F.col("w.line") == F.col("h.line")), F.col("h.line")).alias("line"))
    return found_near.groupBy(*unit, "entity", "term").agg(F.count_distinct("line").alias("n_lines"))


def _candidates(near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (entity, term, scale, n_both) that have enough support to be judged, and (entity, scale,
    n_entity)."""
    counts = stored(near.groupBy("entity", "term").agg(F.sum("n_lines").alias("line"), F.count("*").alias("doc")), "pii-together")

    def by_scale(rows: DataFrame, name: str, least_docs: int) -> DataFrame:
        enough = {"line": F.col("line") > 0, "doc": F.col("doc") >= least_docs}
        line, doc = (rows.where(c).withColumn("scale", F.lit(k)).withColumn(name, F.col(k)).drop("line", "doc") for k, c in enough.items())
        return line.unionByName(doc)

    return by_scale(counts.where("term IS NOT NULL"), "n_both", SUPPORT), by_scale(counts.where("term IS NULL").drop("term"), "n_entity", 1)


def lower_bound(hits: Column, n: Column, deviations: float = DEVIATIONS) -> Column:
    """Wilson's lower confidence bound of hits / n."""
    p, z2 = hits / n, deviations * deviations
    return (p + z2 / (2 * n) - deviations * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def supported(n_both: Column, n_term: Column, certainty: float = CERTAINTY) -> Column:
    return lower_bound(n_both, n_term) >= certainty - 1e-9


def reveals(n_both: Column, n_term: Column, n_entity: Column, n_all: Column, by_doc: Column, smoothing: float = SMOOTHING,
            disclosure: float = DISCLOSURE, certainty: float = CERTAINTY) -> Column:
    """Whether a term reveals an entity, from the numbers of lines (documents) with both, with the term, with
    the entity, and of all."""
    share = n_entity / n_all
    information = -F.log2(share)
    mutual = F.log2((n_both + smoothing * share) / (n_term + smoothing) / share)
    enough = F.when(by_doc, information >= 1).otherwise(information > 0)
    return enough & (mutual >= disclosure * information) & supported(n_both, n_term, certainty)


def _may_have(rows: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """The rows whose hash (in ``column``) is among stored ``hashes``; all rows if there are too many to broadcast."""
    if hashes.limit(MOST_HASHES + 1).count() > MOST_HASHES:
        return rows
    return rows.join(F.broadcast(hashes.select(F.col(hashes.columns[0]).alias(column)).distinct()), column, "left_semi")


def _with_terms(words: DataFrame, terms: DataFrame) -> DataFrame:
    """words (.., term) joined with stored terms (term, ..); of the words, only those that may be one are shuffled."""
    if terms.limit(MOST_TERMS + 1).count() <= MOST_TERMS:
        return words.join(F.broadcast(terms), "term")
    few = _may_have(words.withColumn("_hash", F.xxhash64("term")), "_hash", terms.select(F.xxhash64("term")))
    return few.drop("_hash").join(terms, "term")


def disclosing_terms(docs: DataFrame, found: DataFrame, text: str = "text", smoothing: float = SMOOTHING,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, action): the terms that reveal an entity, with what becomes of them."""
    together, n_entity = _candidates(near_words(found))
    candidates = stored(together.select("term", "scale").distinct(), "pii-candidates")
    whole = F.coalesce(text, F.lit(""))
    lines = docs.select(F.explode(F.split(whole, "\n")).alias("of"))

    def count(units: DataFrame, scale: str) -> DataFrame:
        """Lines or documents that have a candidate term; every text of the corpus is read."""
        own = candidates.where(F.col("scale") == scale).select("term")
        words = units.select(F.explode(F.array_distinct(words_of(F.col("of")))).alias("term"))
        n_term = F.count("*").alias("n_term")
        if own.limit(MOST_TERMS + 1).count() <= MOST_TERMS:
            counted = words.join(F.broadcast(own), "term").groupBy("term").agg(n_term)
        else:                                           # each task counts its words first: places of words are never shuffled
            few = _may_have(words.withColumn("_hash", F.xxhash64("term")), "_hash", own.select(F.xxhash64("term")))
            counted = few.groupBy("term").agg(n_term).join(own, "term")
        return counted.select("term", "n_term", F.lit(scale).alias("scale"))

    # the counts are of rows: a document id that has two texts, or rows twice, counts as often
    n_term = stored(count(lines, "line").unionByName(count(docs.select(whole.alias("of")), "doc")), "pii-terms")
    n_doc, n_line = docs.agg(F.count("*"), F.sum(F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1)).first()
    n_all = F.when(F.col("scale") == "doc", F.lit(n_doc)).otherwise(F.lit(n_line or 0))
    # what has too little support is left out before the entities' counts are joined
    known = together.join(n_term, ["term", "scale"]).where(supported(F.col("n_both"), F.col("n_term"))).join(n_entity, ["entity", "scale"])
    told = reveals(F.col("n_both"), F.col("n_term"), F.col("n_entity"), n_all, F.col("scale") == "doc", smoothing, disclosure)
    return known.where(told).groupBy("entity", "term").agg(F.when(F.max(F.col("n_both") >= F.col("n_term")), "removed").otherwise("term").alias("action"))


def term_spans(docs: DataFrame, revealing: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every place of a disclosing term, in whatever document: doc_id, text_id, added (spans)."""
    # all terms are masked alike wherever they stand: removed if that is due for one entity
    terms = stored(revealing.groupBy("term").agg(F.min("action").alias("action")), "pii-disclosing")
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("_text")).withColumn("text_id", F.xxhash64("_text"))
    words = rows.select("doc_id", "text_id", F.explode(F.array_distinct(words_of(F.col("_text")))).alias("term"))
    hits = stored(_with_terms(words, terms).groupBy("doc_id", "text_id").agg(
        F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("actions")), "pii-hits")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_id") == F.col("_t"))
    rows = _may_have(rows, "text_id", hits.select("text_id"))         # texts without a term stay where they are
    rows = rows.join(hits.withColumnsRenamed({"doc_id": "_d", "text_id": "_t"}), same).withColumn("names", F.map_keys("actions"))
    rows = base_spans(rows).withColumn("spans", F.concat(*[f"_{k}" for k in KINDS]))
    at = rows.select("doc_id", "text_id", "actions", "spans", F.explode(F.filter(_words(F.col("_text")), lambda w: F.array_contains("names", w["term"]))).alias("w"))
    at = at.select("doc_id", "text_id", "actions", "spans", "w.start", "w.end", F.col("w.term").alias("value"))
    apart = at.where(~F.exists("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))))
    return apart.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set(F.struct(
        "start", "end", F.element_at("actions", F.col("value")).alias("kind"), "value"))).alias("added"))


def sanitised_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", smoothing: float = SMOOTHING,
                    disclosure: float = DISCLOSURE) -> DataFrame:
    """Per row: doc_id, text_id, base (validated pattern spans) and spans (with disclosing terms)."""
    found = stored(entities(docs, key, text), "pii-found")
    revealing = stored(disclosing_terms(docs, found, text, smoothing, disclosure), "pii-revealing")
    added = stored(term_spans(docs, revealing, key, text), "pii-added")
    both = found.join(added.withColumnsRenamed({"doc_id": "_d", "text_id": "_t"}), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_id") == F.col("_t")), "left")
    return both.select("doc_id", "text_id", F.col("spans").alias("base"),
                       F.when(F.col("added").isNull(), F.col("spans")).otherwise(ordered(F.concat("spans", "added"))).alias("spans"))


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms.

    Defined results: null texts are empty and have no spans; spans of different kinds may overlap and
    are all reported; a term inside a base span adds nothing; a word that reveals two entities is one
    span, removed if one of them asks for it; rows repeated under one id are reported each, and count as one document in
    the term statistics when their text is equal; an empty table gives an empty table; only the
    named columns are read.
    """
    spans = sanitised_spans(docs, **options)
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    count = {f"n_{k}": number(k) for k in KINDS}
    return spans.select("doc_id", *[c.alias(n) for n, c in count.items()], F.sha2(described(F.col("base")), 256).alias("base_sha256"),
                        described(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_terms"))


def masked(text: Column, spans: Column) -> Column:
    """text with every span replaced by its mask; a span that begins inside an earlier one widens it."""
    masks = F.create_map(*[F.lit(x) for pair in MASK.items() for x in pair])
    def of(before: Column) -> Column:
        """before: how far the earlier spans of each span reach."""
        parts = F.zip_with(spans, before, lambda s, at: F.when(s["start"] >= at, F.concat(F.substring(text, at + 1, s["start"] - at), masks[s["kind"]])).otherwise(""))
        last = F.greatest(F.element_at(before, -1), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(running(F.transform(spans, lambda s: s["end"]), largest=True), of)).otherwise(text)


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with personal data and disclosing terms masked in ``text``."""
    spans = sanitised_spans(docs, key, text, **options).where(F.size("spans") > 0)
    spans = stored(spans.select(F.col("doc_id").alias("_d"), F.col("text_id").alias("_t"), F.col("spans").alias("_spans")).distinct(), "pii-spans")
    docs_of = docs.withColumn("_text_id", F.xxhash64(F.coalesce(text, F.lit(""))))
    same = F.col(key).eqNullSafe(F.col("_d")) & (F.col("_text_id") == F.col("_t"))

    def changed(rows: DataFrame) -> DataFrame:
        out = rows.join(spans, same, "left")
        return out.withColumn(text, F.when(F.col("_spans").isNotNull(), masked(F.col(text), F.col("_spans"))).otherwise(F.col(text))).select(*docs.columns)

    if spans.limit(MOST_HASHES + 1).count() > MOST_HASHES:
        return changed(docs_of)
    hashes = F.broadcast(spans.select(F.col("_t").alias("_text_id")).distinct())
    # texts without a span stay where they are
    return changed(docs_of.join(hashes, "_text_id", "left_semi")).unionByName(docs_of.join(hashes, "_text_id", "left_anti").select(*docs.columns))
