import pytest

from cohortflow.session import clear_scratch, local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "cohortflow-tests", str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()
