import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vintner.session import local_session
    from vintner.sources.storage import shared_dir

    warehouse = tempfile.mkdtemp(prefix="vintner-warehouse-")
    session = local_session(8, 4, **{"spark.sql.warehouse.dir": warehouse})
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="vintner-test-")
