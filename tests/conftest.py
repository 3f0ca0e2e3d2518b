import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sourceloom.plans.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def extract(spark):
    """Rows of one source text, as dicts in source order."""
    from sourceloom.operators.chunks import extract_functions

    def run(language, text, **options):
        files = spark.createDataFrame([("f", language, text)], "path string, language string, text string")
        rows = extract_functions(files, languages=[language], **options).collect()
        return sorted((r.asDict() for r in rows), key=lambda r: (r["start_line"], r["start_column"]))

    return run
