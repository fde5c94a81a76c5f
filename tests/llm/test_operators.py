"""Every operator on edge cases (nulls, empty texts, ties, repeated rows, empty tables, clashing column
names) and against brute force on the smallest tables."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import (bloom, components, divergence, embedding_dedup, fm_index, language_id, minhash, mixing, packing,
                          queries, sanitise, site_quality, substring_dedup, url_filter, word_ids)

SF = "/root/testdata/sf0.001"
LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
TEXTS = [None, "", " \n\t", "word", LINE, LINE, "Prefix " + LINE + " suffix", "x " * 3000, "é😀 a@b.co +1 (377) 555-0271 " + LINE]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "src1", "src2"][i % 3], len(t or ""), 1, 2) for i, t in enumerate([*TEXTS, TEXTS[4]])]
    rows.append(rows[4])                                                         # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, bucket long")


def texts_of(table="documents"):
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/{table}.parquet' ORDER BY 1").fetchall()


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_base_rules_on_edges(docs):
    got = divergence.divergence_rules(docs).collect()
    assert len(got) == 11
    for r in got:
        t = ([*TEXTS, TEXTS[4]])[r["doc_id"]]
        w = words(t)
        five = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if five[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        assert (r["n_words"], r["n_repeat_words"], r["word_chars"]) == (len(w), len(cover), sum(map(len, w)))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
    assert divergence.divergence_rules(docs.limit(0)).count() == 0


def test_distances_against_numpy(spark):
    p, common, shares = ["a", "b", "a", "zz"], ["a", "b", "c"], [0.3, 0.2, 0.1]
    row = spark.createDataFrame([(p, common, shares)], "w array<string>, c array<string>, s array<double>")
    got = row.select(divergence.words_distance(F.col("w"), F.col("c"), F.col("s"))).first()[0]
    x, y = np.array([0.5, 0.25, 0, 0.25]), np.array([0.3, 0.2, 0.1, 0.4])
    m = (x + y) / 2
    want = np.sqrt(sum(a * np.log2(a / c) / 2 for a, c in zip(x, m, strict=True) if a) + sum(b * np.log2(b / c) / 2 for b, c in zip(y, m, strict=True) if b))
    assert got == pytest.approx(want)


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((6, 8))
    x = np.concatenate([base + 0.1 * rng.standard_normal(base.shape) for _ in range(8)])
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    rows += [(100, None, 1), (101, [0.0] * 8, 1), (102, [float("nan")] * 8, 1), (103, [None] + [1.0] * 7, 1), (104, x[0].tolist(), None),
             (105, x[0].tolist(), 0), (106, [1.0, 2.0], 0), (107, [], 0)]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    usable = [r for r in rows if r[0] < 100 or r[0] == 105]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in usable}
    links = {i: {j for j, _, m in usable if j != i and m == k and unit[i] @ unit[j] >= 0.93} for i, _, k in usable}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r["n_links"] == len(links.get(i, ()))
        seen, todo = {i}, [i]
        while todo:
            todo += (new := links.get(todo.pop(), set()) - seen)
            seen |= new
        assert r["component_id"] == min(seen) and r["kept"] == (i == min(seen))


def test_fm_index_counts_and_owners():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(5, 9, n) for n in rng.integers(1, 60, 30)]
    owner = rng.permutation(30)
    first = {}
    for s, o in zip(seqs, owner, strict=True):
        for i in range(len(s) - 12):
            first[tuple(s[i:i + 13])] = min(first.get(tuple(s[i:i + 13]), o), o)
    got = fm_index.first_owners(seqs, owner, 13)
    assert [list(x) for x in got] == [[first[tuple(s[i:i + 13])] for i in range(len(s) - 12)] for s in seqs]
    text = np.array([1, 2, 1, 2, 1, 0, 2, 1, 0])
    assert fm_index.FMIndex(text, 3).count(np.array([1, 2, 1])) == 2


def brute_substring(rows):
    w = {k: words(t) for k, t in rows}
    first = {}
    for k in sorted(w):
        for i in range(len(w[k]) - 12):
            first.setdefault(tuple(w[k][i:i + 13]), k)
    out = {}
    for k, x in w.items():
        drop = {j for i in range(len(x) - 12) if first[tuple(x[i:i + 13])] < k for j in range(i, i + 13)}
        out[k] = (len(x), len(drop), hashlib.sha256(" ".join(y for i, y in enumerate(x) if i not in drop).encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot, keys", [(4096, 10**6), (0, 0)])          # single windows; without filters
def test_substrings_against_brute_force(spark, docs, monkeypatch, hot, keys):
    monkeypatch.setattr(substring_dedup, "HOT_RUNS", hot)
    monkeypatch.setattr(bloom.build, "__defaults__", (keys,))
    want = brute_substring([(i, t) for i, t in enumerate([*TEXTS, TEXTS[4]])])
    for r in substring_dedup.digests(substring_dedup.without_repeats(docs)).collect():
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]


def test_runs_words_are_kept_once(spark, docs, monkeypatch):
    kept = {}
    whole = substring_dedup.stored
    monkeypatch.setattr(substring_dedup, "stored", lambda df, name: kept.setdefault(name, whole(df, name)))
    assert substring_dedup.without_repeats(docs).count() == docs.count()
    assert [name for name, df in kept.items() if "words" in df.columns and df.count()] == ["substring-runs"]


def test_packing_round_trip(spark, docs):
    path = queries.tokenizer_path()
    got = packing.best_fit_packing(docs, path, capacity=64).toPandas()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    for doc, text in enumerate([*TEXTS, TEXTS[4]]):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = got[got.doc_id == doc].drop_duplicates(["piece"]).sort_values("piece")
        want = [(s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes())) for s in range(0, len(ids), 64)]
        assert list(zip(mine.start, mine.length, mine.ids_crc32, strict=True)) == want
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x.length.sum() <= 64 and (x.offset == x.length.cumsum().shift(fill_value=0)).all()


def test_words_tokenize_like_whole_texts():
    path = queries.tokenizer_path()
    ids = word_ids.cached(path)
    for text in ["Don't STOP!! x<|endoftext|>y  a\tb\r\nc 'quoted' it's 's", "é́ ﬁ ΣΑΣ ΑΣ. Ǆ 1,234.5 ||| [x]", " a b ,,, '", ""]:
        assert ids.of(text) == np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(2)
    count = dict(collections.Counter(rng.integers(1, 101, 500).tolist()))
    plan = packing.plan(dict(count), 100)
    used = collections.Counter()
    for pattern, times in plan:
        assert sum(length * k for length, k in pattern.items()) <= 100
        for length, k in pattern.items():
            used[length] += k * times
    assert used == count
    gaps: list[int] = []                                                  # plain best-fit decreasing
    for length in sorted(collections.Counter(count).elements(), reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 100) - length)
    assert sum(times for _, times in plan) <= len(gaps)


def test_plans_give_combinations_back_where_rests_need_them():
    # 6 + 2 + 2 fills ten, but then the sevens lack their twos
    count = {7: 2, 6: 1, 2: 2, 4: 1, 1: 2}
    assert sum(times for _, times in packing.plan(dict(count), 10)) == 3
    rng = np.random.default_rng(8)
    for _ in range(60):
        count = dict(collections.Counter(rng.integers(1, 41, int(rng.integers(1, 120))).tolist()))
        made = packing.plan(dict(count), 40)
        used = collections.Counter()
        for pattern, times in made:
            assert sum(length * k for length, k in pattern.items()) <= 40
            used.update({length: k * times for length, k in pattern.items()})
        assert used == count
        exact, rest = packing._exact(dict(count), 40)
        assert sum(n for _, n in made) <= min(sum(n for _, n in exact + packing._best_fit(rest, 40)), sum(n for _, n in packing._best_fit(count, 40)))
    assert packing.plan({}) == []


def test_small_groups_and_full_pieces_place_alike(spark):
    rows = [(i, 0, 0, [64, 64, 40, 24, 7, 7, 7][i % 7]) for i in range(700)] + [(3, 0, 0, 24)] * 3
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    for group in (5, 1000):
        got = packing.pack(cut, 64, group).toPandas()
        assert sorted(got.length) == sorted(r[3] for r in rows)
        for _, x in got.sort_values("offset").groupby("sequence_id"):
            assert x.length.sum() <= 64 and (x.offset == x.length.cumsum().shift(fill_value=0)).all()
        assert got.sequence_id.nunique() <= -(-int(got.length.sum()) // 64) + 1
    assert packing.pack(cut.limit(0), 64).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.net/en/x?q"), (4, "https://x.org/fr/casino"), (5, "http://roads-tracker.com/"),
            (6, "http://ads-track.com"), (7, "http://x.com/free/bonus"), (8, "http://x.com/free"), (9, "http://sub.example.com/de/"), (10, "://net"), (10, "://net")]
    got = url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()
    verdict = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == 11 and verdict[1] == verdict[2] == ("", "", None, "allow")
    assert verdict[3] == ("a.example.net", "/en/x", "example.net/en/", "allow") and verdict[4][2:] == ("org/fr/", "allow")
    assert [verdict[i][3] for i in (5, 6, 7, 8, 9)] == ["allow", "block", "block", "allow", "block"]


def test_terms_in_the_whole_url(spark):
    rows = [(1, "http://x.com/search?q=CASINO"), (2, "http://x.com/a#free-bonus"), (3, "casino"), (4, "http://x.com/free?a=bonus"),
            (5, "http://x.com/?q=casinos"), (6, "http://x.org/fr/?q=casino"), (7, "http://x.com/?q=free")]
    got = {r["page_id"]: r["verdict"] for r in url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow"}


def test_language_on_edges(spark, docs):
    model = language_id.fit(spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") % 2 == 0))
    got = {r["doc_id"]: r for r in language_id.predict(docs, model, {"doc_id": F.col("doc_id")}).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and all(0 <= r["score"] <= 1 for r in got.values())
    held = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") % 2 == 1)
    right = language_id.predict(held, model, {"lang": F.col("lang")}).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    assert language_id.predict(docs, language_id.fit(docs.limit(0)), {"doc_id": F.col("doc_id")}).where("lang_pred <> 'und'").count() == 0


def test_more_languages_than_256(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)), f"l{i:03}") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(table)
    assert len(model.langs) == 300
    got = language_id.predict(table, model, {"lang": F.col("lang")}).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 285


def brute_near(rows, size, percent):
    sets = {}
    for k, t in rows:
        b = re.sub(r"[A-Z]", lambda m: m[0].lower(), t or "")
        w = words(b)
        sets[k] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_near_duplicates_against_brute_force(spark, docs, monkeypatch):
    rng, base = np.random.default_rng(4), [f"w{i}" for i in range(60)]
    rows = [(i, t) for i, t in enumerate([*TEXTS, TEXTS[4]])]
    for k in range(60):                                                   # near copies whose mutual similarity lies around the limit
        w = list(base)
        for i in rng.integers(0, 60, int(rng.integers(1, 4))):
            w[i] = f"x{k}_{i}"
        rows.append((100 + k, " ".join(w)))
    monkeypatch.setattr(minhash, "BLOCK", 8)
    table = spark.createDataFrame([*rows, rows[4]], "doc_id long, text string")
    got = minhash.near_duplicates(table, 4, 80).collect()
    want = brute_near(rows, 4, 80)
    assert len(got) == len(rows) + 1 and all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in got)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "src long, dst long")
    got = {r["id"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_personal_data(spark, docs):
    cases = ["a@b.c_d@e.f", "a@b.c.@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 007.1.2.3", "4111 1111 1111 1111 4111-1111--1111", "+1 (377) 555-0271 +", None, "",
             "é@x.y 😀a@b.co 1.1.1.1", "1" * 3000 + " " + "a" * 20000 + " +" + "1 " * 9]
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15
    got = {r["doc_id"]: r for r in sanitise.personal_data(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")).collect()}
    for i, t in enumerate(cases):
        spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, t or "") if valid(kind, m[0]))
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{kind}:{s}:{e}" for s, _, kind, e in spans).encode()).hexdigest()


def test_disclosing_terms_and_masks(spark):
    rows = [(i, f"Zorblax wrote to a@b.co today\nother line of the text {i}") for i in range(5)] + [(9, "wrote today\nto the text"), (10, "wrote\nwrote\nto\ntoday\ntoday")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    out = {r["doc_id"]: r["text"] for r in sanitise.sanitise(table).collect()}
    assert out[9] == "wrote today\nto the text" and out[0].startswith(" ") and "[EMAIL]" in out[0] and "Zorblax" not in out[0] and "other line" in out[0]


def test_terms_of_entities_seen_once(spark):
    rows = [(i, f"common words stand in every line {i % 7}") for i in range(100)] + [(200, "common Quenbix words a@b.co")]
    got = {r["doc_id"]: r for r in sanitise.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[200]["spans"] == "removed:7:14,email:21:27" and got[200]["n_terms"] == 1
    assert all(got[i]["n_terms"] == 0 for i in range(100))


@pytest.mark.parametrize("most", [10**6, 0])                             # broadcast; shuffled
def test_terms_across_lines_and_documents(spark, monkeypatch, most):
    monkeypatch.setattr(sanitise, "MOST_TERMS", most)
    rows = [(i, f"common words\nstand in every line {i % 7}") for i in range(200)]
    rows += [(300 + i, "Quenbix common\n\nmail: jane@x.org words\nQuenbix\tevery") for i in range(4)] + [(400, "line with Quenbix")]
    got = {r["doc_id"]: r["spans"] for r in sanitise.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[300] == "term:0:7,removed:16:21,email:22:32,term:39:46"
    assert got[400] == "term:10:17" and not any(got[i] for i in range(200))


def test_site_shrinkage(spark):
    rows = [("big", "p", 0.0)] * 500 + [("other", "p", 1.0)] * 500 + [("tiny", "p", 0.0)]
    got, prior = site_quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    share = {r["host"]: r["path_share"] for r in got.collect()}
    assert share["big"] < 0.05 < share["tiny"] < prior + 0.01 < share["other"]


def test_quality_on_edges(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert site_quality.quality_classifier(docs, none).where("kept").count() == 11


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    rows = [sorted(map(str, x[sorted(x.columns)].astype(object).where(x.notna(), None).itertuples(index=False, name=None))) for x in (got, want)]
    assert rows[0] == rows[1]


def test_mixing_on_edges(docs):
    got = mixing.mix(docs, F.lit(None).cast("string"), 0.5, 2).collect()
    assert sum(r["_tokens"] for r in got) <= 0.5 * sum(len(words(t)) for t in [*TEXTS, TEXTS[4], TEXTS[4]])
    assert mixing.mix(docs.limit(0), F.lit("d"), 0.5).count() == 0


def test_pipeline_keeps_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out
