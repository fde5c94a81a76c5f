"""URL filter: host/path rules first, else a weighted vocabulary found by Aho-Corasick.

Strict terms reject a url by one hit, soft terms only when several different ones hit.  A hit
counts only between boundaries: no ASCII letter or digit stands next to it, so ``ads-track`` does
not fire inside ``roads-tracker``.  All terms are searched in one pass over the whole
url, lower-cased, with its query and fragment.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule, and only
terms can block it; repeated rows are judged alike; an empty table gives an empty table; only the named
columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import ship

#: (verdict, host, path): a rule fits its host and all subdomains, if the path starts with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
#: One hit rejects.
STRICT = ("casino", "casino-win", "cheap-pills", "free-bets", "spam-farm", "adult-x", "ads-track", "porn", "xxx",
          "viagra")
#: Several different ones reject.
SOFT = ("ads", "adult", "bets", "betting", "bonus", "cheap", "click", "deal", "farm", "free", "pills", "poker",
        "promo", "sex", "spam", "track", "win")
SOFT_HITS = 2


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path`` (without query and fragment)."""
    has = F.coalesce(F.col(url).contains("://"), F.lit(False))
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": F.when(has, host).otherwise(""), "path": F.when(has, path).otherwise("")})


def _first_rule(rules, pick) -> Column:
    """The longest rule that fits; of equally long ones the first listed."""
    out = F.lit(None).cast("string")
    for verdict, host, path in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, pick(verdict, host, path)).otherwise(out)
    return out


def _between(text: str, start: int, end: int) -> bool:
    def inner(c: str) -> bool:
        return c.isascii() and c.isalnum()
    return not (start and inner(text[start - 1])) and not (end < len(text) and inner(text[end]))


def term_hits(df: DataFrame, strict=STRICT, soft=SOFT, url: str = "url") -> DataFrame:
    """Adds ``n_strict`` (hits) and ``n_soft`` (different soft terms) of the url."""
    kinds = {**dict.fromkeys(soft, False), **dict.fromkeys(strict, True)}

    @F.pandas_udf("n_strict long, n_soft long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, is_strict in kinds.items():
            found.add_word(term, (term, is_strict))
        found.make_automaton()
        for texts in parts:
            rows = []
            for text in texts:
                n_strict, seen = 0, set()
                for last, (term, is_strict) in found.iter(text):
                    if _between(text, last + 1 - len(term), last + 1):
                        n_strict += is_strict
                        if not is_strict:
                            seen.add(term)
                rows.append((n_strict, len(seen)))
            yield pd.DataFrame(rows, columns=["n_strict", "n_soft"])

    ship(df.sparkSession)
    lowered = F.lower(F.coalesce(url, F.lit("")))
    return df.withColumn("_hits", count(lowered)).select("*", "_hits.n_strict", "_hits.n_soft").drop("_hits")


def url_filter(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, strict=STRICT, soft=SOFT,
               soft_hits: int = SOFT_HITS) -> DataFrame:
    """One row per page: key, host, path, rule, verdict (allow or block), n_strict, n_soft."""
    parsed = with_host_path(pages.select(F.col(key), F.col(url).alias("_url")), "_url")
    judged = term_hits(parsed, strict, soft, "_url")
    by_terms = F.when((F.col("n_strict") >= 1) | (F.col("n_soft") >= soft_hits), "block").otherwise("allow")
    return judged.select(
        key, "host", "path", _first_rule(rules, lambda v, h, p: F.lit(h + p)).alias("rule"),
        F.coalesce(_first_rule(rules, lambda v, h, p: F.lit(v)), by_terms).alias("verdict"), "n_strict", "n_soft")


def oracle() -> str:
    """DuckDB: every term as a pattern between boundaries, in the whole lower-cased url."""
    def hit(term: str) -> str:
        return f"regexp_matches(t, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    fits = {h + p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in RULES}
    order = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits[h + p]} THEN '{h + p}'" for _, h, p in order)
    verdict = " ".join(f"WHEN {fits[h + p]} THEN '{v}'" for v, h, p in order)
    return f"""
    WITH cut AS (SELECT page_id, url, strpos(url, '://') AS mark FROM pages),
    rest AS (SELECT page_id, url, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS r FROM cut),
    parsed AS (SELECT page_id, url, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    low AS (SELECT *, lower(coalesce(url, '')) AS t FROM parsed)
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN {' OR '.join(map(hit, STRICT))} THEN 'block'
                WHEN {' + '.join(hit(x) + '::INT' for x in SOFT)} >= {SOFT_HITS} THEN 'block' ELSE 'allow' END AS verdict
    FROM low"""
