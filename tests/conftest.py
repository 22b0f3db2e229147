import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quayside.session import clear_staged, local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        cpus=4,
        shuffle_partitions=4,
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=f"file://{shared}",
    )
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
