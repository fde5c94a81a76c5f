"""Mixing sources to target weights by budgets that flow down a domain-language-source tree.

A node's budget is shared among its children by weight.  A child that can't use its share (its
documents, over the allowed epochs, have fewer tokens) takes what it has, and its siblings share the
rest; only what a whole subtree can't use goes to the subtree's siblings.  Each leaf then takes
the longest prefix of its seeded order that its budget holds: whole epochs first, then the start of
one more epoch, whose order is another one.

Only DataFrame functions are used.  A leaf of any size is never sorted in one task: documents are
dealt to buckets by the first digits of their order hash, bucket sums find the one bucket where the
prefix ends, and only that bucket is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm.common import bounded_broadcast, stored
from slotwise.llm.divergence import split_words

DIGITS = 3                      # hex digits of the order hash that make a bucket: 4096 buckets a leaf
MAX_LEAVES = 100_000            # leaf plans broadcast; with more, the join shuffles
LEAF = ["domain", "lang", "source"]


def _weight(column: str, weights: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(float(w))).otherwise(out)
    return out


def _share(children: DataFrame, parent: list[str], target: Column, budget: str) -> DataFrame:
    """children (.., capacity, weight) with ``budget``: the parent's target shared by weight, none
    above its capacity.  In the order of capacity per weight, the filled children come first."""
    each = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = each.orderBy(F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(float("inf")), *LEAF[:len(parent) + 1])
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = children.withColumn("_target", target).withColumn("_full", F.coalesce(
        (F.col("weight") > 0) & (F.col("capacity") * after <= F.col("weight") * (F.col("_target") - before)), F.lit(False)))
    left = F.col("_target") - F.sum(F.when(F.col("_full"), F.col("capacity")).otherwise(0.0)).over(each)
    weights = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(each)
    part = F.when(weights > 0, F.col("weight") * left / weights).otherwise(0.0)
    return rows.withColumn(budget, F.when(F.col("_full"), F.col("capacity").cast("double")).otherwise(part)).drop("_target", "_full")


def leaf_budgets(leaves: DataFrame, budget: float, epochs: int, domains: dict[str, float], langs: dict[str, float],
                 sources: dict[str, float]) -> DataFrame:
    """leaves (domain, lang, source, tokens) with ``budget`` in whole tokens."""
    leaves = leaves.withColumn("capacity", (F.col("tokens") * epochs).cast("double"))

    def level(columns: list[str], weights: dict[str, float]) -> DataFrame:
        return stored(leaves.groupBy(*columns).agg(F.sum("capacity").alias("capacity")), "mixing-level").withColumn("weight", _weight(columns[-1], weights))

    def under(child: DataFrame, parent: DataFrame, columns: list[str], value: str) -> DataFrame:
        parent = parent.select(*[F.col(c).alias(f"_{c}") for c in columns], F.col(value))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
        return child.join(parent, on).drop(*[f"_{c}" for c in columns])

    top = _share(level(LEAF[:1], domains), [], F.lit(float(budget)), "domain_budget")
    middle = _share(under(level(LEAF[:2], langs), top, LEAF[:1], "domain_budget"), LEAF[:1], F.col("domain_budget"), "lang_budget")
    low = under(leaves.withColumn("weight", _weight("source", sources)), middle, LEAF[:2], "lang_budget")
    low = _share(low, LEAF[:2], F.col("lang_budget"), "leaf_budget")
    # a thousandth of a token absorbs rounding before whole tokens are taken
    return low.select(*LEAF, "tokens", F.floor(F.col("leaf_budget") + 0.001).cast("long").alias("budget"))


def _order(seed: str, epoch: Column, key: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.col(key).cast("string")))


def _with_leaf(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    other = leaves.withColumnsRenamed({c: f"_{c}" for c in LEAF})
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEAF]
    return rows.join(bounded_broadcast(other, MAX_LEAVES), on).drop(*[f"_{c}" for c in LEAF])


def leaf_cuts(rows: DataFrame, plan: DataFrame, epochs: int, seed: str) -> DataFrame:
    """plan (leaf, tokens, budget) with how many whole epochs a leaf gives, and where in the next
    epoch's order its prefix ends: (cut_hash, cut_id)."""
    whole = F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs))).otherwise(epochs)
    plan = plan.withColumn("whole", whole.cast("int")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = stored(plan, "mixing-plan")
    part = _with_leaf(rows.withColumnRenamed("tokens", "_tokens"), plan.where(F.col("whole") < epochs).select(*LEAF, "whole", "rest"))
    part = part.withColumn("_hash", _order(seed, F.col("whole") + 1, "doc_id")).withColumn("_bucket", F.substring("_hash", 1, DIGITS))
    sums = stored(part.groupBy(*LEAF, "rest", "_bucket").agg(F.sum("_tokens").alias("_in")), "mixing-buckets")
    before = F.sum("_in").over(Window.partitionBy(*LEAF).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    last = stored(sums.withColumn("_before", F.coalesce(before, F.lit(0))).where(
        (F.col("_before") <= F.col("rest")) & (F.col("_before") + F.col("_in") > F.col("rest"))).select(*LEAF, F.col("_bucket").alias("_cut"), "_before"),
        "mixing-boundary")
    there = _with_leaf(part, last).where(F.col("_bucket") == F.col("_cut"))
    upto = F.col("_before") + F.sum("_tokens").over(Window.partitionBy(*LEAF).orderBy("_hash", "doc_id"))
    taken = there.withColumn("_upto", upto).where(F.col("_upto") <= F.col("rest")).groupBy(*LEAF).agg(F.max(F.struct("_hash", "doc_id")).alias("_last"))
    cut = last.withColumnsRenamed({c: f"_{c}" for c in LEAF}).join(taken, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEAF], "left")
    cut = cut.select(*[F.col(f"_{c}").alias(f"cut_{c}") for c in LEAF], F.coalesce("_last._hash", "_cut").alias("cut_hash"), F.col("_last.doc_id").alias("cut_id"))
    out = plan.join(cut, [F.col(c).eqNullSafe(F.col(f"cut_{c}")) for c in LEAF], "left")
    return stored(out.select(*LEAF, "budget", "whole", "cut_hash", "cut_id"), "mixing-cuts")


def mix(docs: DataFrame, domain: Column, budget_share: float, epochs: int = 1, domains: dict[str, float] | None = None,
        langs: dict[str, float] | None = None, sources: dict[str, float] | None = None, seed: str = "mix",
        key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All columns of ``docs``, one row per document and epoch that is taken, with _domain, _epoch
    (from 1), _tokens (words) and _budget (its leaf's tokens).  The total budget is ``budget_share``
    of the corpus's tokens; weights not given are 1.

    Defined results: null domains, languages and sources are nodes of their own; null and empty texts
    have no tokens and are taken when the prefix reaches them; rows repeated under one id stand
    at the same place of the order and are taken together or not at all; a weight of 0 takes nothing;
    an empty table gives an empty table; columns of other names pass through.
    """
    words = F.size(split_words(F.coalesce(F.col(text), F.lit("")))).cast("long")
    leaf = {"domain": domain.cast("string"), "lang": F.col(lang).cast("string"), "source": F.col(source).cast("string")}
    rows = stored(docs.select(F.col(key).alias("doc_id"), *[c.alias(n) for n, c in leaf.items()], words.alias("tokens")), "mixing-rows")
    leaves = stored(rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens")), "mixing-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = leaf_budgets(leaves, int(total * budget_share), epochs, domains or {}, langs or {}, sources or {})
    cuts = leaf_cuts(rows, plan, epochs, seed).withColumnsRenamed({c: f"_leaf_{c}" for c in LEAF})
    met = docs.withColumns({f"_{n}": c for n, c in leaf.items()}).withColumn("_tokens", words)
    met = met.join(bounded_broadcast(cuts, MAX_LEAVES), [F.col(f"_{c}").eqNullSafe(F.col(f"_leaf_{c}")) for c in LEAF])
    place = _order(seed, F.col("whole") + 1, key)
    inside = F.coalesce((place < F.col("cut_hash")) | ((place == F.col("cut_hash")) & (F.col(key) <= F.col("cut_id"))), F.lit(False))
    met = met.withColumn("_taken", F.col("whole") + F.when(inside, 1).otherwise(0)).where("_taken > 0")
    return met.withColumn("_epoch", F.explode(F.expr("sequence(1, _taken)"))).select(
        *docs.columns, "_domain", "_epoch", "_tokens", F.col("budget").alias("_budget"))


#: The registered query's tree and weights.
DOMAINS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANGS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}


def source_domain(source: str = "source") -> Column:
    """A domain for numbered sources: their number modulo 4; other sources have none."""
    number = F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (F.try_to_number(number, F.lit("999999999")) % 4).cast("int").cast("string")))


def oracle(budget_share: float, epochs: int, seed: str) -> str:
    """DuckDB: the same tree filled level by level, and one running sum over each leaf's order."""
    def weight(column: str, weights: dict[str, float]) -> str:
        return "CASE " + column + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1.0 END"

    def share(name: str, source: str, parent: str, target: str, keys: str) -> str:
        by = f"PARTITION BY {parent}" if parent else ""
        return f"""
    {name}_a AS (SELECT *, {target} AS t, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
                   sum(wt) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM {source}
                   WINDOW w AS ({by} ORDER BY cap / wt, {keys})),
    {name}_b AS (SELECT *, cap * a <= wt * (t - b) AS f FROM {name}_a),
    {name} AS (SELECT * EXCLUDE (t, b, a, f), CASE WHEN f THEN cap ELSE wt * (t - sum(CASE WHEN f THEN cap ELSE 0 END) OVER ({by}))
                   / sum(CASE WHEN f THEN 0 ELSE wt END) OVER ({by}) END AS {name}_budget FROM {name}_b)"""
    return f"""
    WITH docs AS (SELECT doc_id, 'd' || (CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % 4) AS domain, lang, source,
                   len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
    leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE * {epochs} AS cap, 1.0::DOUBLE AS wt FROM docs GROUP BY ALL),
    top AS (SELECT domain, sum(cap) AS cap, ({weight('domain', DOMAINS)})::DOUBLE AS wt FROM leaves GROUP BY domain),
    mid AS (SELECT domain, lang, sum(cap) AS cap, ({weight('lang', LANGS)})::DOUBLE AS wt FROM leaves GROUP BY domain, lang),
    {share('d', 'top', '', f"(SELECT CAST(floor(sum(tokens) * {budget_share}) AS DOUBLE) FROM docs)", 'domain')},
    under_d AS (SELECT mid.*, d_budget FROM mid JOIN d USING (domain)),
    {share('l', 'under_d', 'domain', 'd_budget', 'domain, lang')},
    under_l AS (SELECT leaves.*, l_budget FROM leaves JOIN l USING (domain, lang)),
    {share('s', 'under_l', 'domain, lang', 'l_budget', 'domain, lang, source')},
    budgets AS (SELECT domain, lang, source, tokens AS leaf_tokens, CAST(floor(s_budget + 0.001) AS BIGINT) AS budget FROM s),
    placed AS (SELECT docs.*, budget, e AS epoch, (e - 1) * leaf_tokens + sum(tokens) OVER (PARTITION BY domain, lang, source, e
                   ORDER BY md5('{seed}:' || e || ':' || doc_id), doc_id) AS upto
               FROM docs JOIN budgets USING (domain, lang, source), range(1, {epochs + 1}) r(e))
    SELECT doc_id, domain, lang, source, CAST(epoch AS INT) AS epoch, tokens, budget FROM placed WHERE upto <= budget"""
