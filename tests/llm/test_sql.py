"""The queries that SQL can express, against DuckDB on the driver's smallest tables; the others for their shape."""

import os

import pytest

from checks import compare
from gridagro.llm import queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    relation = duck.execute(queries.ORACLE[name])
    names = [column[0] for column in relation.description]
    assert sorted(df.columns) == sorted(names)
    assert compare.bag(df.collect(), df.columns) == compare.bag(relation.fetchall(), names)


def test_html_text_is_the_article(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.QUERIES["op9_html_text"](spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[row.page_id], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", re.sub(r"</?b>", "", article))]
        assert row.text == "\n".join(x for x in blocks if x) and row.n_chars == len(row.text)
