import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("DAYBOOK_LOCAL_DIR", str(tmp_path_factory.mktemp("daybook")))
    session = local_session("tests", spark__default__parallelism="8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """DataFrame from rows and a DDL schema."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
