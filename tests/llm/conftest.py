import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs(spark):
    from fixtures import DOCS, corpus
    return spark.createDataFrame(corpus(), DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    from fixtures import DOCS
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf(spark, docs, tmp_path_factory):
    """A folder with ``documents`` and the tables that queries read besides."""
    from fixtures import words
    import random
    rng = random.Random(3)
    root = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{root}/documents.parquet")
    texts = [r.text for r in docs.where("length(text) > 400").collect()]
    items = [(0, " ".join(texts[0].split()[2:30])), (1, words(rng, 40)), (2, "x"), (3, ""), (4, None), (5, " ".join(texts[1].split()[5:9]).upper())]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(r.doc_id, int("#" not in (r.text or "#")), 0) for r in docs.collect() if r.doc_id is not None],
                          "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    pages = [(1, "http://b.example.com/x?q=1", "<p>one</p>"), (2, "http://B.example.com/x?q=1#f", "<p>one</p>"), (3, "https://a.example.org", ""), (4, None, None),
             (5, "nonsense", "é" * 9000), (7, "http://[bad", "<p>two\r\n\r\nparts</p>"), (6, "http://b.example.com:8080/", "<p>one</p>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    return root
