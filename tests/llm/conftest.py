import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def sent(spark):
    """The session, with the package on its workers."""
    from lapframe.llm.ship import ship

    ship(spark)
    return spark
