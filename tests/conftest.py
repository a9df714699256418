import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = f"{Path(__file__).parent.parent}:{os.environ.get('PYTHONPATH', '')}"
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
