"""The url filter's SQL and code on urls with terms anywhere."""

import duckdb

from slotwise.llm import url_filter


def test_sql_and_code_agree_on_terms_anywhere(spark):
    strict, soft = url_filter.STRICT[0], url_filter.SOFT[:url_filter.SOFT_HITS]
    urls = [f"http://x.com/a?q={strict}", strict.upper(), f"x.com#{strict}", f"http://x.com/{strict}s", None, "", "http://", f"http://x.com/?{'&'.join(soft)}",
            f"http://x.com/{soft[0]}?{soft[0]}", f"http://a.net/?{strict}", f"http://example.net/en/{strict}", "HTTP://Example.COM/de/x", f"http://x.com/#{'-'.join(soft)}"]
    rows = list(enumerate(urls))
    got = url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string")).drop("n_strict", "n_soft").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    assert sorted(map(tuple, got)) == sorted(con.execute(url_filter.oracle()).fetchall())
    assert [r["verdict"] for r in sorted(got)[:3]] == ["block"] * 3
