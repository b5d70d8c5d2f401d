import sys
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from screenroll.schemas import FEED  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a feed table from dictionaries; absent columns are NULL."""

    def build(name, *rows):
        columns = [c for c, w in FEED[name].items() if w != "ts"]
        data = {c: pa.array([r.get(c) for r in rows], pa.string()) for c in columns}
        return spark.createDataFrame(pa.table(data))

    return build


@pytest.fixture(scope="session")
def small_feed(table):
    """A complete feed with one entity per call, to be overridden by table."""

    def build(**overrides):
        names = ["Entity", "EntityAddress", "EntityAlias", "EntityCountryAssociation", "EntityDOB",
                 "EntityEnforcement", "EntitySanction", "EntityIdentification", "EntityRemark",
                 "EntitySourceItem", "Country"]
        rows = {n: [] for n in names}
        rows["Entity"] = [{"EntityGUID": "E1", "EntityID": "1", "EntityTypeDesc": "Individual",
                           "Name": "Ann Bo Cid", "FirstName": "Ann", "LastName": "Cid"}]
        rows["Country"] = [{"tISO": "FR", "tCountry": "France"}, {"tISO": "DE", "tCountry": "Germany"}]
        rows.update(overrides)
        return {n: table(n, *r) for n, r in rows.items()}

    return build


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a DataFrame as sorted tuples of some columns."""

    def rows(df, *columns):
        got = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in got.collect()), key=repr)

    return rows
