import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

CONF = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g"}


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config(map=CONF).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    from lodestone.shipping import ship

    ship(session)
    yield session
    session.stop()
