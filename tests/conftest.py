from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from hourtally import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    built = (
        SparkSession.builder.master("local[4]")
        .appName("hourtally-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(home / "shared"))
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={home}")
        .getOrCreate()
    )
    built.sparkContext.setLogLevel("ERROR")
    session.pin_report_settings(built)
    yield built
    built.stop()


@pytest.fixture
def scratch(spark):
    return session.scratch(spark, "test")
