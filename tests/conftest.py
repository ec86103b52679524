import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
CLASSES = ["Iris-setosa", "Iris-versicolor", "Iris-virginica"]


@pytest.fixture(scope="session")
def spark():
    from foldwise.session import local_session
    s = local_session("*", 8, app="foldwise-tests")
    yield s


@pytest.fixture(scope="session")
def iris(spark):
    """150 rows of 4 features and 3 classes of 50, the shape of the public iris
    table.  Its file is read if FOLDWISE_IRIS names it; else the values follow a
    rule, with classes that overlap a little."""
    path = os.environ.get("FOLDWISE_IRIS", "")
    if path:
        from foldwise.sources.files import read_matrix
        return read_matrix(spark, path, 4).where("label IS NOT NULL")
    rows = [(i, [round(4 + i // 50 * (0.4 + 0.3 * j) + ((i * (7 + 2 * j)) % 23) / 12, 2) for j in range(4)], CLASSES[i // 50]) for i in range(150)]
    return spark.createDataFrame(rows, "row_id long, features array<double>, label string")
