"""The quality classifier, the language codes and every stage of the pipeline against plain Python."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from slotwise.llm import language_id, mixing, queries, site_quality
from test_operators import SF, brute_near
from test_sanitise import brute_terms


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def logit(p):
    return math.log(p / (1 - p))


def style(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    n, chars = max(len(w), 1), max(len(t), 1)
    return [sum(a == b for a, b in zip(w, w[1:], strict=False)) / n, len(set(w)) / n, sum(c in "#*$%&|<>!~^=_{}\\" for c in t) / chars,
            len(regex.findall(r"\p{Lu}", t)) / chars, sum(c in "0123456789" for c in t) / chars, sum(c in ".,;:?" for c in t) / n,
            t.count("\n") / n, len(t) / n / 10, math.log1p(len(w)) / 10, sum(len(x) <= 3 for x in w) / n]


def strength(sites):
    """sites: (sum of probabilities, documents, prior mean) each."""
    total = sum(n for _, n, _ in sites)
    observed = sum(n * (s / n - m) ** 2 for s, n, m in sites)
    within = sum(m * (1 - m) for _, _, m in sites)
    noise = sum(n * m * (1 - m) for _, n, m in sites) / total
    between = max((observed - within) / total, 0.0)
    return min(max(noise / between - 1, 1.0), 1e6) if between else 1e6


def brute_quality(rows, model):
    """rows (doc_id, text, host, path): (doc_id, evidence, host share, path share, probability) each."""
    weights, intercept = model
    odds = [max(-30.0, min(30.0, intercept + sum(w * f for w, f in zip(weights, style(t), strict=True)))) for _, t, _, _ in rows]
    prior = sum(map(sigmoid, odds)) / len(rows)
    hosts, paths = collections.defaultdict(lambda: [0.0, 0]), collections.defaultdict(lambda: [0.0, 0])
    for (_, _, h, p), x in zip(rows, odds, strict=True):
        for site in (hosts[h], paths[h, p]):
            site[0] += sigmoid(x)
            site[1] += 1
    k = strength([(s, n, prior) for s, n in hosts.values()])
    host = {h: (s + k * prior) / (n + k) for h, (s, n) in hosts.items()}
    k = strength([(s, n, host[h]) for (h, _), (s, n) in paths.items()])
    path = {at: (s + k * host[at[0]]) / (n + k) for at, (s, n) in paths.items()}
    return [(d, x, host[h], path[h, p], sigmoid(x + logit(path[h, p]) - logit(prior))) for (d, _, h, p), x in zip(rows, odds, strict=True)]


def test_posteriors_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame([(-1, None, None, None), (-2, "", "src1", None), (-3, "Word " * 2000, None, "en"), (-3, "Word " * 2000, None, "en")],
                                  "doc_id long, text string, source string, lang string")
    docs = docs.select("doc_id", "text", "source", "lang").unionByName(extra).withColumns({"_key": F.lit("x"), "_host": F.lit(1), "_evidence": F.lit("y")})
    model = site_quality.fit(docs, labels)
    want = brute_quality([tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()], model)
    got = site_quality.quality_classifier(docs, labels).collect()
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want), strict=True):
        assert g[0] == w[0] and list(g[1:5]) == pytest.approx(list(w[1:]), rel=1e-9, abs=1e-12)
        assert abs(w[4] - 0.5) < 1e-9 or g["kept"] == (w[4] >= 0.5)


def brute_grams(text):
    """(n-gram length, bucket): count, byte by byte."""
    b = [c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").encode()]
    out = collections.Counter()
    for size, times in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        for i in range(len(b) - size + 1):
            g = b[i:i + size]
            if (size == 2 and g == [32, 32]) or (size == 3 and g[1] == 32):
                continue
            key = 0
            for c in g:
                key = (key * 257 + c) % 2**32
            out[size, key * times % 2**32 >> 20] += 1
    return out


def brute_language(train, texts):
    """Codes of all splits (up to six languages), decoded by plain loops."""
    langs = sorted({x for _, x in train})
    grams = [(brute_grams(t), langs.index(x)) for t, x in train]
    keys = [(size, k) for size in (2, 3) for k in range(language_id.BUCKETS)]
    share = []
    for at in range(len(langs)):
        n = sum((g for g, x in grams if x == at), collections.Counter())
        total = {size: 0.5 * language_id.BUCKETS + sum(v for (s, _), v in n.items() if s == size) for size in (2, 3)}
        share.append({k: (n[k] + 0.5) / total[k[0]] for k in keys})
    code = [[1 if c == 0 or s >> (c - 1) & 1 else -1 for s in range(2 ** (len(langs) - 1) - 1)] for c in range(len(langs))]
    bits = range(len(code[0]))
    weight = []
    for b in bits:
        side = {v: [c for c in range(len(langs)) if code[c][b] == v] for v in (1, -1)}
        mean = {v: {k: sum(share[c][k] for c in side[v]) / len(side[v]) for k in keys} for v in side}
        w = {k: math.log(mean[1][k]) - math.log(mean[-1][k]) for k in keys}
        apart = abs(sum((mean[1][k] - mean[-1][k]) * w[k] for k in keys)) / 4
        weight.append({k: 3 * x / max(apart, 1e-9) for k, x in w.items()})

    def margin(g, b):
        return sum(v * weight[b][k] for k, v in g.items()) / max(sum(g.values()), 1)

    good = [[0.5] * len(bits) for _ in langs]
    for g, x in grams:
        for b in bits:
            good[x][b] += margin(g, b) * code[x][b] > 0
    seen = collections.Counter(x for _, x in grams)
    trust = [[max(v / (seen[c] + 1), 0.01) for v in row] for c, row in enumerate(good)]
    out = []
    for t in texts:
        if not any(c.isalpha() for c in t or ""):
            out.append(("und", 0.0))
            continue
        z = [margin(brute_grams(t), b) for b in bits]
        loss = [sum(trust[c][b] * math.log1p(math.exp(-code[c][b] * z[b])) for b in bits) / sum(trust[c]) for c in range(len(langs))]
        first, second = sorted(loss)[:2]
        out.append((langs[loss.index(first)], 1 - first / second))
    return out


def test_decoding_by_hand(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    train = [r for r in rows if r[0] % 3 == 0]
    texts = [t for _, t, _ in rows][:60] + [None, "", "1 2 3", "é", "ein Haus the house la casa"]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.predict(table, model, {"doc_id": F.col("doc_id")}).collect()}
    for i, (lang, score) in enumerate(brute_language([(t, x) for _, t, x in train if x is not None], texts)):
        assert got[i]["score"] == pytest.approx(score, rel=1e-6, abs=1e-9)
        assert got[i]["lang_pred"] == lang or score < 1e-9


def test_short_texts_take_little_memory():
    column = pa.array(["ab cd"] * 10_000)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, 10_001).astype(np.int64)
    most = 0
    for first, last, counts in language_id.in_blocks(np.frombuffer(data, np.uint8), at):
        most = max(most, counts.nbytes)
        assert counts.shape[0] == last - first and counts.sum() == (last - first) * 6               # ab, b_, _c, cd, ab_, _cd
    assert most <= 256 * language_id.FEATURES * 8


def test_a_row_without_an_id_is_not_held_out(spark, tmp_path):
    rows = [(None, "the house is here", "en"), (1, "das haus ist hier", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["held_out"] for r in queries.op8_language_id(spark, str(tmp_path)).collect()}
    assert got[None] is False and got[1] == (zlib.crc32(b"1") % 4 == 2)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def personal(text):
    """(start, end, value, kind) of all valid matches."""
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if (kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "card" and 12 <= len(d) <= 19 and luhn)
                    or (kind == "phone" and 9 <= len(d) <= 15)):
                out.append((m.start(), m.end(), m[0], kind))
    return out


def brute_masked(texts):
    told = brute_terms([t or "" for t in texts], lambda t: [s[:3] for s in personal(t)])
    action = {}
    for (_, term), what in told.items():
        action[term] = min(what, action.get(term, what))
    order = [*PATTERNS, "term", "removed"]
    out = []
    for t in texts:
        base = personal(t or "")
        spans = list(base)
        for m in re.finditer(r"[^\x20\x09-\x0D]+", t or ""):
            if m[0] in action and not any(a < m.end() and b > m.start() for a, b, _, _ in base):
                spans.append((m.start(), m.end(), m[0], action[m[0]]))
        if not spans:
            out.append(t)
            continue
        text, at = "", 0
        for a, b, _, kind in sorted(spans, key=lambda s: (s[0], order.index(s[3]))):
            if a >= at:
                text += t[at:a] + ("" if kind == "removed" else f"[{kind.upper()}]")
            at = max(at, b)
        out.append(text + t[at:])
    return out


def test_every_stage_of_the_pipeline(spark, monkeypatch):
    given = []

    def noted(stage):
        def call(session, docs, sf_dir):
            given.append(docs)
            return stage(session, docs, sf_dir)
        return call

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, noted(f)) for n, f in corpus_pipeline.STAGES])
    out = corpus_pipeline.run(spark, SF).toPandas()
    rows = [{r["doc_id"]: r for r in d.collect()} for d in given]            # ids are unique in the given tables
    first, judged, single, clean, mixed = rows
    assert all(d.columns == given[0].columns for d in given)

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    hand = brute_quality([(r["doc_id"], r["text"], r["source"], r["lang"]) for r in first.values()], site_quality.fit(given[0], labels))
    assert set(judged) == {d for d, *_, p in hand if p >= 0.5} and 0 < len(judged) <= len(first)

    near = brute_near([(d, r["text"]) for d, r in judged.items()], corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert set(single) == {d for d, (_, least) in near.items() if d == least}

    ids = sorted(single)
    texts = brute_masked([single[d]["text"] for d in ids])
    assert [clean[d]["text"] for d in ids] == texts and len(clean) == len(ids)
    assert all(r["n_chars"] == len(r["text"] or "") for r in clean.values() if r["text"] is not None)

    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([{k: r[k] for k in ("doc_id", "lang", "source", "text")} for r in clean.values()]))
    taken = con.execute(mixing.oracle(corpus_pipeline.MIX_SHARE, 1, corpus_pipeline.MIX_SEED)).fetchall()
    assert sorted(mixed) == sorted(t[0] for t in taken)

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    want, sizes = [], []
    for d, r in mixed.items():
        own = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(own), 2048)):
            part = own[at:at + 2048]
            want.append((d, k, at, len(part), zlib.crc32(part.tobytes())))
            sizes.append(len(part))
    assert sorted(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, x in out.sort_values("offset").groupby("sequence_id"):
        assert x.length.sum() <= 2048 and (x.offset == x.length.cumsum().shift(fill_value=0)).all()
    assert out.sequence_id.nunique() >= -(-sum(sizes) // 2048)
