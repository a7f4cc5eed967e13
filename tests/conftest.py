import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tarmac.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Small tables: compiling takes longer than running, so expressions are interpreted here.
    # The comparison at larger scale and the benchmark run compiled code.
    session = local_session(
        8,
        "tests",
        spark__sql__shuffle__partitions="2",
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
