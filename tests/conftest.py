import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickflow.session import local_session  # noqa: E402
from tickflow.streaming.bars import use_state_store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    use_state_store(session)
    return session
