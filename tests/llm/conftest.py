import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SF


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                                     "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return make
