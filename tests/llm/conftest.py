import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture
def table(spark):
    """Make a DataFrame of rows under a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
