import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def llm(spark):
    from commitloom.llm.shipping import ship

    return ship(spark)
