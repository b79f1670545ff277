import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rows_for_tests import CLASHES, SCHEMA, messy_rows  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty, very long, repeated and tied rows, with extra columns of clashing names."""
    df = spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)
    for name in CLASHES:
        df = df.withColumn(name, df["n_chars"].cast("string"))
    return df


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)
