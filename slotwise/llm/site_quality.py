"""Quality classifier: a document classifier combined with what its site's documents look like.

A logistic model over style features gives each document's log-odds of being good.  Sites form a
tree (host, and path inside the host).  A host's share of good documents is its documents' mean
probability shrunk towards the corpus's, a path's is shrunk towards its host's; how strongly is
estimated from the spread between sites (empirical Bayes: sites hardly differ, or are sparse, and
the prior decides).  The site's log-odds, less the corpus's, are added to the document's evidence.

The model is fitted on at most ``sample`` labelled documents (the smallest hashes of their ids).
Everything else covers all rows: site sums are partial aggregates, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import GAP, bounded_broadcast, let, stored

SAMPLE = 20_000         # labelled documents that the model is fitted on; also the bound of their broadcast
MAX_SITES = 100_000     # site posteriors broadcast; with more, the join shuffles
THRESHOLD = 0.5


def features(text: Column) -> Column:
    """Style of a text as an array of doubles (null: empty)."""
    t = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        twin = F.size(F.filter(words, lambda w, i: w == F.get(words, i + 1)))
        chars = F.greatest(F.length(t), F.lit(1))
        return F.array(
            twin / n,
            F.size(F.array_distinct(words)) / n,
            F.regexp_count(t, F.lit("[#*$%&|<>!~^=_{}\\\\]")) / chars,
            F.regexp_count(t, F.lit("\\p{Lu}")) / chars,
            F.regexp_count(t, F.lit("[0-9]")) / chars,
            F.regexp_count(t, F.lit("[.,;:?]")) / n,
            F.regexp_count(t, F.lit("\n")) / n,
            F.length(t) / n / 10,
            F.log1p(F.size(words).cast("double")) / 10,
            F.size(F.filter(words, lambda w: F.length(w) <= 3)) / n,
        ).cast("array<double>")
    return let(F.filter(F.split(t, GAP), lambda w: w != ""), of)


N_FEATURES = 10


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: str = "quality",
        sample: int = SAMPLE) -> tuple[list[float], float] | None:
    """Weights and intercept of the document classifier; None unless both classes are there."""
    known = labels.where(F.col(good).isin(0, 1)).select(F.col(key).alias("_key"), F.col(good).cast("double").alias("label"))
    chosen = stored(known.orderBy(F.xxhash64("_key"), "_key", "label").limit(sample), "quality-labels")      # <= sample rows
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    rows = rows.select("label", features(F.col("_text")).alias("f"))
    rows = stored(rows.select("label", *[F.col("f")[i].alias(f"f{i}") for i in range(N_FEATURES)]), "quality-train")
    if rows.select("label").distinct().count() < 2:
        return None
    train = VectorAssembler(inputCols=[f"f{i}" for i in range(N_FEATURES)], outputCol="features").transform(rows)
    model = LogisticRegression(maxIter=50, regParam=1e-4, standardization=True).fit(train)
    return [float(x) for x in model.coefficients], float(model.intercept)


def _evidence(text: Column, model: tuple[list[float], float] | None) -> Column:
    if model is None:
        return F.lit(0.0)
    weights, intercept = model
    odds = let(features(text), lambda f: sum((f[i] * w for i, w in enumerate(weights)), F.lit(intercept)))
    return F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(q / (1 - q))


def _strength(sites: DataFrame, total: str, n: str, prior: Column) -> float:
    """Prior weight in documents, by moments: m(1-m)/spread - 1, where the spread between sites is
    what their observed variance has beyond the documents' own noise."""
    mean = F.col(total) / F.col(n)
    r = sites.agg(F.sum(F.col(n) * (mean - prior) ** 2).alias("ss"), F.sum(F.col(n) * prior * (1 - prior)).alias("noise"),
                  F.sum(prior * (1 - prior)).alias("within"), F.sum(n).alias("n")).first()
    if not r["n"] or not r["noise"]:
        return 1.0
    between = max((r["ss"] - r["within"]) / r["n"], 0.0)
    return min(max(r["noise"] / r["n"] / between - 1, 1.0) if between else 1e6, 1e6)


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """scored (host, path, p): posterior share of good documents per (host, path), and the corpus's."""
    paths = stored(scored.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count("*").alias("n")), "quality-paths")
    whole = paths.agg(F.sum("good"), F.sum("n")).first()
    prior = whole[0] / whole[1] if whole[1] else 0.5
    hosts = stored(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "quality-hosts")
    k = _strength(hosts, "good", "n", F.lit(prior))
    hosts = hosts.select(F.col("host").alias("_h"), ((F.col("good") + k * prior) / (F.col("n") + k)).alias("host_share"))
    both = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h"), "quality-sites")
    k = _strength(both, "good", "n", F.col("host_share"))
    return stored(both.select("host", "path", "host_share", ((F.col("good") + k * F.col("host_share")) / (F.col("n") + k)).alias("path_share")),
                  "quality-posteriors"), prior


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, key: str = "doc_id",
             text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``docs`` with _evidence, _host_share, _path_share, _probability and _good.

    ``host`` and ``path`` default to the columns source and lang.

    Defined results: null and empty texts are judged by their (zero) features; a null host or path is
    a site of its own; without labels of both classes the evidence is 0 and everything is good; of a
    document labelled twice both labels count; repeated rows are judged alike and each counts for its
    site; a probability equal to the threshold is good; an empty table gives an empty table.
    """
    model = fit(docs, labels, key, text, sample=sample)
    return _judged(docs.withColumns(_scores(host, path, text, model)), model is not None, threshold)


def _scores(host: Column | None, path: Column | None, text: str, model: tuple[list[float], float] | None) -> dict[str, Column]:
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    return {"_host": host.cast("string"), "_path": path.cast("string"), "_evidence": _evidence(F.col(text), model)}


def _judged(rows: DataFrame, fitted: bool, threshold: float) -> DataFrame:
    """rows with _host, _path and _evidence: the site's shares, _probability and _good."""
    scored = rows.select(F.col("_host").alias("host"), F.col("_path").alias("path"), _sigmoid(F.col("_evidence")).alias("p"))
    sites, prior = site_posteriors(scored)
    sites = bounded_broadcast(sites.withColumnsRenamed({"host": "_site_host", "path": "_site_path", "host_share": "_host_share",
                                                        "path_share": "_path_share"}), MAX_SITES)
    met = rows.join(sites, F.col("_host").eqNullSafe(F.col("_site_host")) & F.col("_path").eqNullSafe(F.col("_site_path")), "left")
    odds = F.col("_evidence") + _logit(F.coalesce("_path_share", F.lit(prior))) - _logit(F.lit(prior))
    met = met.withColumn("_probability", _sigmoid(odds))
    good = F.col("_probability") >= threshold if fitted else F.lit(True)
    return met.withColumn("_good", good).drop("_site_host", "_site_path", "_host", "_path")


def quality_classifier(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, key: str = "doc_id",
                       text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per row: the key, evidence (log-odds), host_share, path_share, probability, kept; as ``classify``.

    Texts are scored once; their scores, without the texts, are stored for the sites and the verdicts."""
    model = fit(docs, labels, key, text, sample=sample)
    scores = _scores(host, path, text, model)
    rows = stored(docs.select(F.col(key).alias("_key"), *[c.alias(name) for name, c in scores.items()]), "quality-scores")
    return _judged(rows, model is not None, threshold).select(
        F.col("_key").alias(key), F.col("_evidence").alias("evidence"), F.col("_host_share").alias("host_share"),
        F.col("_path_share").alias("path_share"), F.col("_probability").alias("probability"), F.col("_good").alias("kept"))
