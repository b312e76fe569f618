import json
import os

import pytest

from orestrata.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "orestrata-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark, tmp_path):
    """A small table from tuples, through the JSON reader (keeps decimals and maps exact)."""
    made = []

    def make(rows, schema):
        from pyspark.sql.types import StructType

        names = StructType.fromDDL(schema).fieldNames()
        path = tmp_path / f"frame-{len(made)}.json"
        made.append(path)
        path.write_text("".join(json.dumps(dict(zip(names, row)), default=str) + "\n" for row in rows))
        return spark.read.schema(schema).json(str(path))

    return make


@pytest.fixture(scope="session")
def sf_dir():
    """The smallest driver tables; tests on them are skipped where they are not mounted."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder
