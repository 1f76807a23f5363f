import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termloom import index_documents, local_session, read_text_folder  # noqa: E402
from termloom.index import Index  # noqa: E402

FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
    session = local_session("8", shuffle_partitions=8, shared=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def cached(index):
    return Index(index.postings.cache(), index.doc_stats.cache())


@pytest.fixture(scope="session")
def english(spark):
    return cached(index_documents(read_text_folder(spark, f"{FIXTURES}/documents")))


@pytest.fixture(scope="session")
def greek(spark):
    return cached(index_documents(read_text_folder(spark, f"{FIXTURES}/documents_demo")))


@pytest.fixture(scope="session")
def small(spark):
    """Six short documents, one empty, one of stopwords only."""
    rows = [
        (1, "Storm storm STORM wind"), (2, "wind and rain"), (3, ""), (4, "the of and"), (5, "rain - well-known don't"),
        (6, "the of it"),
    ]
    return cached(index_documents(spark.createDataFrame(rows, "doc_id bigint, text string")))
