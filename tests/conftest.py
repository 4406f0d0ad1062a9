import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexharbor.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", memory="4g", partitions=4, name="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame([
        ("/c/a/king.txt", "en", "king txt", "The king of France met the queen."),
        ("/c/ab/king.of.france.txt", "en", "king of france txt", "A queen and a queen."),
        ("/c/b/empty.txt", "en", "empty txt", ""),
    ], "path string, lang string, title string, body string")


@pytest.fixture(scope="session")
def asked(spark):
    return spark.createDataFrame([
        (1, "term", "en", "king"), (2, "phrase", "en", "king of france"),
        (3, "phrase", "en", "france met"), (4, "fuzzy", "en", "qeuen"),
        (5, "prefix", "en", "/c/a"), (6, "term", "en", "the"),
        (7, "term", "en", "king queen"), (8, "term", "pl", "king"),
    ], "query_id int, kind string, lang string, text string")
