import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from logweir.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, **{"spark.sql.maxMetadataStringLength": "2000"})
    yield session
    session.stop()
