import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import types as T  # noqa: E402

from strata.session import build_session  # noqa: E402

STR = T.StringType()


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    session = build_session("local[4]", app_name="strata-tests", shuffle_partitions=4,
                            extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                                   "spark.checkpoint.dir": f"{scratch}/checkpoint"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


def string_schema(*names):
    return T.StructType([T.StructField(n, STR) for n in names])


@pytest.fixture(scope="module")
def source_customer_df(spark):
    rows = [
        ("C001", " john ", "doe", "JOHN.DOE@COMPANY.COM", " active ", "2024-01-15", "120.50"),
        ("C002", "Mary", "Jones", "mary.jones@company.com", "inactive", "2024-02-05", "-80.00"),
        ("C003", "Alex", "Smith", "alex.smith@company.com", "pending", "2024-05-10", "0.00"),
    ]
    return spark.createDataFrame(rows, string_schema("customer_id", "first_name", "last_name", "email", "status",
                                                     "signup_date", "amount"))


@pytest.fixture(scope="module")
def operational_customer_df(source_customer_df):
    from strata.operators.customer import apply_advanced_customer_transformations
    return apply_advanced_customer_transformations(source_customer_df, as_of="2024-06-01")


@pytest.fixture(scope="module")
def curated_customer_df(operational_customer_df):
    from strata.operators.curated import build_curated_customer_metrics
    return build_curated_customer_metrics(operational_customer_df)


def by_key(df, key="customer_id"):
    return {r[key]: r.asDict() for r in df.collect()}
