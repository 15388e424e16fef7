import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import local_session
    session = local_session("*", shuffle_partitions=8, app_name="cartwheel-tests")
    yield session
    session.stop()


def raw_frame(spark, rows, columns=None, schema=None):
    """A raw order frame; every column is text unless a schema is given."""
    from cartwheel.schemas import ORDER_COLUMNS, PRODUCTS_COLUMN
    columns = columns or [*ORDER_COLUMNS, PRODUCTS_COLUMN]
    if schema is None:
        schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame(rows, schema)
