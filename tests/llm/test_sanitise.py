"""The term rule against brute force, long texts, and running sums."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from slotwise.llm import sanitise

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def emails(text):
    return [(m.start(), m.end(), m[0]) for m in re.finditer(EMAIL, text)]


def brute_terms(texts, spans_of=emails):
    """Terms by the rule in the module's docstring; spans_of gives a text's entities (start, end, value)."""
    lines, docs, near_line, near_doc, e_line, e_doc = {}, {}, {}, {}, {}, {}
    n_lines = 0
    for d, text in enumerate(texts):
        n_lines += text.count("\n") + 1
        spans = spans_of(text)
        words = [(text.count("\n", 0, m.start()), m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        for line, _, _, w in words:
            lines.setdefault(w, set()).add((d, line))
            docs.setdefault(w, set()).add(d)
        held = [(line, a, v) for line, a, b, _ in words for x, y, v in spans if x < b and y > a]
        for line, _, v in held:
            e_line.setdefault(v, set()).add((d, line))
            e_doc.setdefault(v, set()).add(d)
        for line, a, b, w in words:
            if not any(x < b and y > a for x, y, _ in spans):
                for at_line, at, v in held:
                    if abs(a - at) <= sanitise.REACH:
                        near_doc.setdefault((v, w), set()).add(d)
                        if line == at_line:
                            near_line.setdefault((v, w), set()).add((d, line))

    def told(both, term, entity, n, least):
        share = entity / n
        info = -math.log2(share)
        mutual = math.log2((both + 0.5 * share) / (term + 0.5) / share)
        p = both / term
        low = (p + 1 / (2 * term) - math.sqrt(p * (1 - p) / term + 1 / (4 * term * term))) / (1 + 1 / term)
        return (info >= 1 if least else info > 0) and mutual >= 0.9 * info and low >= 0.5 - 1e-9

    out = {}
    for (v, w), both in near_line.items():
        if told(len(both), len(lines[w]), len(e_line[v]), n_lines, False):
            out[v, w] = len(both) >= len(lines[w])
    for (v, w), both in near_doc.items():
        if len(both) >= 2 and told(len(both), len(docs[w]), len(e_doc[v]), len(texts), True):
            out[v, w] = out.get((v, w), False) or len(both) >= len(docs[w])
    return {k: "removed" if x else "term" for k, x in out.items()}


@pytest.mark.parametrize("most", [10**6, 0])
def test_terms_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(sanitise, "MOST_TERMS", most)
    rng = random.Random(6)
    common = [f"w{i}" for i in range(30)]
    people = [(f"name{i}", f"p{i}@x.org") for i in range(6)]
    texts = []
    for d in range(160):
        words = [rng.choice(common) + rng.choice(["", "", "\n", " \t"]) for _ in range(rng.randint(0, 300))]
        for name, mail in people:
            if rng.random() < 0.04:
                at = rng.randint(0, len(words))
                words[at:at] = [name, *rng.choices(common, k=rng.randint(0, 3)), rng.choice(["", "\n"]) + mail]
            if rng.random() < 0.004:
                words.append(name)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sanitise.stored(sanitise.entities(docs), "t")
    got = {(r["entity"], r["term"]): r["action"] for r in sanitise.disclosing_terms(docs, found).collect()}
    want = brute_terms(texts)
    assert got == want and want


def test_a_rare_word_beside_an_entity_once_stays_elsewhere(spark):
    rows = [(i, f"plain words {i % 9}\nand more words {i % 7}") for i in range(3000)]
    rows += [(5000, "Quor wrote a@b.co\nplain Tervel words"), (5001, "Quor in a clean text"), (5002, "Tervel in a clean text")]
    got = {r["doc_id"]: r["spans"] for r in sanitise.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5001] == "" and got[5002] == "" and got[5000].endswith("email:11:17")


def test_words_are_counted_before_a_shuffle_and_far_ones_left_out(spark, monkeypatch):
    kept = {}
    whole = sanitise.stored

    def watched(df, name):
        kept[name] = (df._jdf.queryExecution().optimizedPlan().toString(), whole(df, name))
        return kept[name][1]

    monkeypatch.setattr(sanitise, "stored", watched)
    monkeypatch.setattr(sanitise, "MOST_TERMS", 0)
    far = " ".join(f"far{i}" for i in range(5000))
    rows = [(0, f"Quor wrote a@b.co {far}"), *[(i, f"plain {i % 9}") for i in range(1, 400)], (400, "x" * 2000 + ",c@d.org Tervel")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, sanitise.personal_data(docs).collect()))
    assert kept["pii-words"][1].where("term LIKE 'far%'").count() < 500
    plan = kept["pii-terms"][0]
    assert plan.index("Join Inner") < plan.index("Aggregate [term")
    monkeypatch.setattr(sanitise, "MOST_FLAGS", 0)
    assert sorted(map(tuple, sanitise.personal_data(docs).collect())) == got
    assert kept["pii-words"][1].where("term LIKE 'far%'").count() == 5000


def test_near_words_are_shuffled_once_and_equal_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(40):
        words = [rng.choice(["w1", "w2", "w3", "x" * 300, "y" * 1300, "z" * 600 + ",a@b.co", "(c@d.org)" + "v" * 900, "a@b.co", "e@f.net,a@b.co"])
                 + rng.choice(["", "", "\n", "\t"]) for _ in range(rng.randint(0, 40))]
        texts.append(" ".join(words))
    rows = [*enumerate(texts), (0, texts[0]), (0, texts[1]), (None, texts[2]), (None, texts[2])]
    want = {}
    for d, text in {(d, t) for d, t in rows}:
        spans = emails(text)
        words = [(text.count("\n", 0, m.start()), m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        held = {(line, a, v) for line, a, b, _ in words for x, y, v in spans if x < b and y > a}
        for line, _, v in held:
            want.setdefault((d, text, v, None), set()).add(line)
        taken = {a for _, a, _ in held}
        for line, a, _, w in words:
            for at_line, at, v in held:
                if a not in taken and abs(a - at) <= sanitise.REACH:
                    want.setdefault((d, text, v, w), set()).update({line} & {at_line})
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts_of = {r["h"]: r["text"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    near = sanitise.near_words(sanitise.stored(sanitise.entities(docs), "t"))
    got = {(r["doc_id"], texts_of[r["text_id"]], r["entity"], r["term"]): r["n_lines"] for r in near.collect()}
    assert got == {k: len(v) for k, v in want.items()} and got
    # spans once for their units, words and spans once for all that follows
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning(") == 2


def test_a_word_of_many_entities(spark):
    text = " ".join(f"w{i}" for i in range(20)) + " " + ",".join(f"a{i}@b{i}.org" for i in range(4000)) + " after"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = sanitise.stored(sanitise.entities(docs), "t")
    start = time.time()
    near = sanitise.near_words(found)
    assert near.where("n_lines = 1 AND term IS NOT NULL").count() == 20 * 4000
    assert near.where("n_lines = 1 AND term IS NULL").count() == 4000 and near.where("term = 'after' OR term = ''").count() == 0
    assert time.time() - start < 60


def test_running_sums_and_maxima(spark):
    rng = random.Random(1)
    rows = [(k, [rng.randint(0, 50) for _ in range(k)]) for k in (0, 1, 2, 63, 64, 65, 128, 129, 1000)]
    df = spark.createDataFrame(rows, "k int, v array<int>").select("k", "v", sanitise.running(F.col("v")).alias("s"), sanitise.running(F.col("v"), True).alias("m"))
    for r in df.collect():
        assert r["s"] == [sum(r["v"][:i]) for i in range(r["k"])]
        assert r["m"] == [max(r["v"][:i], default=0) for i in range(r["k"])]


def test_masks_where_spans_meet(spark):
    spans = [(0, 3, "email", "a"), (2, 5, "card", "b"), (4, 6, "ip", "c"), (6, 7, "term", "d"), (9, 10, "removed", "e")]
    row = spark.createDataFrame([("0123456789ab", spans), ("xyz", [])], f"t string, s {sanitise.SPAN}")
    assert [r[0] for r in row.select(sanitise.masked(F.col("t"), F.col("s"))).collect()] == ["[EMAIL][TERM]78ab", "xyz"]


def test_long_lines_take_linear_time(spark):
    def seconds(n):
        text = " ".join(["word", "other", "mail"][i % 3] + str(i % 97) for i in range(n)) + " someone@example.org"
        docs = spark.createDataFrame([(1, text), (2, "x\ny")], "doc_id long, text string")
        start = time.monotonic()
        assert sanitise.personal_data(docs).where("n_email = 1").count() == 1
        return time.monotonic() - start

    seconds(100)
    short, long = seconds(8_000), seconds(80_000)
    assert long < 10 * short + 10


def test_repeated_null_and_empty_rows(spark):
    rows = [(None, "a@b.co x"), (None, "a@b.co x"), (1, None), (1, "c@d.org"), (1, "c@d.org"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unit", F.lit(1)).withColumn("term", F.lit("t"))
    assert sanitise.personal_data(docs).count() == 6
    assert sanitise.sanitise(docs).columns == docs.columns and sanitise.sanitise(docs).count() == 6
    assert sanitise.personal_data(docs.limit(0)).count() == 0
