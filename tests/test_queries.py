"""Every registered query that has SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

import html
import math
import re

import duckdb
import pytest

from consolida.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("<NA>", "NaT"):
        return "~"
    if isinstance(v, bool) or str(v) in ("True", "False"):
        return str(v)
    try:
        return f"{float(v):.6f}"
    except (TypeError, ValueError):
        return str(v)


def rows(df):
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_permits_have_every_site(spark):
    rows = catalogue.q_consolidated_permits(spark, SF).collect()
    assert len(rows) == 5
    assert all("<main><section" in r["html"] and "{{" not in r["html"] for r in rows)


def test_versions_hold_whole_pages(spark):
    decrees = catalogue.made_decrees(spark, SF)
    found = catalogue.pipeline.consolidate(decrees, catalogue.pipeline.tagged_operations(decrees), render=False).versions
    held = {}
    for r in found.where("decree_id = '2010-01-01'").select("aiot", "article_id", "content").collect():
        held.setdefault((r["aiot"], r["article_id"]), []).append(" ".join(html.unescape(r["content"] or "").split()))
    pages = catalogue.table(spark, SF, "pages").where("page_id % 10 = 0").select("page_id", "html").collect()
    texts = {str(p["page_id"] // 10): " ".join(re.sub("<[^>]*>", " ", p["html"]).split()) for p in pages}
    assert max(map(len, texts.values())) > 200
    assert all(any(text in content for content in held[site, article]) for site, text in texts.items() for article in "12")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
