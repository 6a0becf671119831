import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from trolley.session import get_spark
    s = get_spark("local[*]", 8, extra={"spark.driver.memory": "8g"})
    yield s
