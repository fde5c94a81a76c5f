"""BPE coding, collocations and the divergence audit against the library and brute force."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import collocations, prefix_bpe, queries, source_audit, word_ids

SF = "/root/testdata/sf0.001"
EDGES = [None, "", " \n\t", "word", "word, WORD. word", "x" * 20000, "a b " * 3000, "é😀 Don't 's 1,234.5 <|endoftext|>x ΣΑΣ ǰ̌ J̌  |",
         "one two three. one two three; one two", "word, WORD. word"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2"][i % 3], "x", "y") for i, t in enumerate(EDGES)]
    return spark.createDataFrame([*rows, rows[4]], "doc_id long, text string, lang string, source string, ids string, term string")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_encoding_equals_the_library(spark, library, edges):
    path = queries.tokenizer_path()
    got = prefix_bpe.encode(edges, path, decode=True).collect()
    assert len(got) == len(EDGES) + 1
    for r in got:
        ids = library.encode(EDGES[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    back = {r["doc_id"]: r["decoded"] for r in prefix_bpe.decode(prefix_bpe.encode(edges, path), path).collect()}
    assert back == {r["doc_id"]: r["decoded"] for r in got}
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in prefix_bpe.decode(none, path).collect()} == {1: None, 2: ""}
    assert prefix_bpe.encode(edges.limit(0), path, decode=True).count() == 0


def test_prefix_programming_equals_the_library_on_random_texts(library):
    bpe = prefix_bpe.PrefixBpe(queries.tokenizer_path())
    rng = random.Random(3)
    pool = [*"aabbccdeeirstn 'é'sll tA0123.,;!ΣİǅŁjJ́̌​\x1c\x85 ß漢😀", "<|endoftext|>", "<|startoftext|>", "'re", "...", "the", "aaaa"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == want
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert [i for x in bpe.encode_many(words) for i in x] == want
        for a, b in zip(want, want[1:]):
            if max(a, b) < 49406 and " " not in text and text.isalpha():
                assert bpe.compatible(a, b)


def test_byte_level_files_are_coded_text_by_text():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, tok = prefix_bpe.PrefixBpe(path), Tokenizer.from_file(path)
    assert not bpe.by_word
    for text in [x or "" for x in EDGES]:
        assert bpe.encode(text) == tok.encode(text, add_special_tokens=False).ids


def test_op11_digests(spark, library):
    got = {r["doc_id"]: r for r in queries.op11_prefix_bpe(spark, SF).collect()}
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
        assert tuple(got[doc])[1:] == want


def brute_collocations(rows, min_count, top):
    n, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, cut = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "city", "ünder", "x.y", "a\tb", "is", "THE", "re-do", "'s"]
    rows = [(" ".join(rng.choice(words[:rng.randint(2, 12)]) + rng.choice(["", "", "", ",", "!\n"]) for _ in range(rng.randint(0, 60))),
             rng.choice([None, "en", "und", "de", ""])) for _ in range(300)]
    return [*rows, (None, "en"), ("", None), (" \n.,", "zz"), ("in new york city today " * 40, "hot"), ("one rare word", "en"), rows[0]]


@pytest.mark.parametrize("max_words", [10**6, 0])
def test_collocations_equal_brute_force(spark, max_words):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, g, 1, "w") for t, g in rows], "text string, lang string, n long, w1 string")
    got = collocations.collocations(docs, min_count=12, top=40, max_words=max_words).drop("cut").collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, 12, 40)
    assert collocations.collocations(docs.limit(0), max_words=max_words).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 10**16 + 7, 3 * 10**16 + 1, 10**17
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 2000000 * a // (left + right)


def brute_audit(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = collections.Counter(t for g, _, ts in docs if g == lang for t in set(ts))
        kept = {t for t, k in seen.items() if k >= min_docs}
        groups = collections.defaultdict(collections.Counter)
        whole = collections.Counter()
        for g, s, ts in docs:
            if g == lang:
                groups[s].update(t for t in ts if t in kept)
                whole.update(t for t in ts if t in kept)

        def share(c, kept=kept):
            total = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = share(whole), {s: share(c) for s, c in groups.items()}
        for s in groups:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])
            out += [(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms[:top], 1)]
    return sorted(out)


def audit_rows():
    rng = random.Random(4)
    names = [a + b for a in ["a", "b", "é", "zz", "Q"] for b in ["a", "c", "ß", "xy", "o", "M", "i"]]
    rows = []
    for _ in range(400):
        s = rng.randint(0, 6)
        rows.append((" ".join(rng.choice(names[s:s + 20]) + rng.choice(["", "1", "-", ".x"]) for _ in range(rng.randint(0, 40))),
                     rng.choice(["en", "en", "de", None]), None if s == 6 else f"s{s}"))
    return [*rows, (None, "en", "empty"), ("", None, "s1"), ("lonely", "nolang", "a"), ("", "nolang", "b"), rows[0]]


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    docs = spark.createDataFrame([(t, g, s, "x", 3) for t, g, s in rows], "text string, lang string, source string, term string, n long")
    got = source_audit.divergence_audit(docs, min_docs=12, top=5).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, 12, 5)
    assert source_audit.divergence_audit(docs.limit(0)).count() == 0


def test_distances_are_the_same_in_small_blocks(spark):
    rows = [("en", f"s{i}", f"t{j}", 1000 * i + 37 * j * j) for i in range(7) for j in range(9) if (i * j) % 4]
    groups = [("en", f"s{i}", 10 * i, 12) for i in range(8)] + [("de", "s", 5, 0), ("de", "r", 9, 0)]
    terms = spark.createDataFrame(rows, "lang string, source string, term string, p long")
    groups = spark.createDataFrame(groups, "lang string, source string, nothing long, n_kept long")
    small = source_audit.source_pairs(terms, groups, sources_per_block=3, rows_per_task=5)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, source_audit.source_pairs(terms, groups).collect()))
    assert small.count() == 8 * 7 + 2


def test_skyband_keeps_the_first(spark):
    rng = random.Random(8)
    rows = [("en", f"s{i % 3}", rng.randint(1, 9), rng.randint(9, 20), f"t{i}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "lang string, source string, n long, n_lang long, term string, f long").repartition(7)
    got = {tuple(r) for r in source_audit.skyband(df, 4).collect()}
    want = {r for r in rows if sum(o[1] == r[1] and o[2] >= r[2] and o[3] <= r[3] and o[4] < r[4] for o in rows) < 4}
    assert got == want


def test_a_small_word_table_gives_the_same_ids(library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(word_ids, "TABLE_WORDS", 40)
    monkeypatch.setattr(word_ids, "SLICE_BYTES", 200)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "of", "a", f"w{rng.randint(0, 300)}", "Don't", ""]) for _ in range(rng.randint(0, 50))) for _ in range(80)] + [None, ""]
    bpe = prefix_bpe.PrefixBpe(queries.tokenizer_path())
    got = [ids[a:b].tolist() for _, _, ids, ends in word_ids.ids_of(pa.array(texts), bpe.words) for a, b in zip(ends, ends[1:])]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_printable_ascii_words_pass_the_normalizer_by(library):
    table = word_ids.LibraryTable(queries.tokenizer_path())
    whole, seen = table.tokenizer, []

    class Watched:
        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    table.tokenizer = Watched()
    texts = ["The THE the Don't I'LL U.S.A. x1Y22 a_b--C", "É J\u030c I\u0307 ΣΑΣ", "<|EndOfText|> <|endoftext|>A <b>", "a\x1fB \x7fC"]
    got = [table.of(t) for t in texts]
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    reached = " ".join(seen).split(" ")
    assert not {"The", "THE", "the", "Don't", "I'LL", "U.S.A.", "x1Y22", "a_b--C"} & set(reached)
    assert {"É", "J\u030c", "<|EndOfText|>", "<b>", "a\x1fB"} <= set(reached)


def test_new_words_encoded_together_keep_their_ids():
    table = word_ids.LibraryTable(queries.tokenizer_path())
    assert table.mark
    texts = [f"~ a~b x{table.mark} {table.mark}{table.mark}", "<|endoftext|>y <|startoftext|> a<|startoftext|>b <|startof", "́abc ΣΑΣ \u0085x \x00 🙂 don't", "",
             " ".join(f"w{i}z{i % 7}." for i in range(500))]
    for mark in (table.mark, ""):                        # together; one by one
        table._clear()
        table.mark = mark
        for text in texts:
            assert table.of(text) == np.array(table.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
