import pytest

from inkspool.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "4g", str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
