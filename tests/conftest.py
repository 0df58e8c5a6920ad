import pytest
from pyspark.sql import SparkSession

from tallyworks.session import tune

DATA_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallyworks-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def without_broadcast(spark):
    """No automatic broadcast, as with tables that are too large for it."""
    keys = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    """The physical plan as text; the final one if ``df`` has already run."""
    explain = df._sc._jvm.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "simple").split("== Initial Plan ==")[0]
