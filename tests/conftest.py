import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["TZ"] = "UTC"

from waybill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def same_batch_rows(request):
    """Stages of the pipeline called one by one leave the session with small batches; the next test has the session's own."""
    if "spark" not in request.fixturenames:
        yield
        return
    session = request.getfixturevalue("spark")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = session.conf.get(name)
    yield
    session.conf.set(name, before)


@pytest.fixture
def at():
    """Seconds after a fixed moment, as an aware datetime."""
    def moment(seconds: float) -> datetime:
        return datetime.fromtimestamp(1_704_100_000 + seconds, tz=timezone.utc)

    return moment
