import datetime as dt
import os
import sys

import pytest
from pyspark.sql import Row

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.schemas import RAW  # noqa: E402
from basketry.session import local_session  # noqa: E402

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    session.stop()


def ts(text):
    return dt.datetime.fromisoformat(text)


def table(spark, schema, rows):
    """A table from dicts; columns left out are null."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def order(order_id, user_id="u1", product_id="p1", day="2024-06-01", **more):
    row = dict(
        order_id=order_id, user_id=user_id, product_id=product_id, status="delivered", quantity=1,
        unit_price=10.0, discount_amount=0.0, created_at=ts(f"{day} 12:00:00"), region="EU",
    )
    return {**row, **more}


def user(user_id, plan_type="pro", signup="2024-01-10", **more):
    row = dict(
        user_id=user_id, email=f"{user_id}@example.org", name=f"Person {user_id}", plan_type=plan_type,
        signup_date=dt.date.fromisoformat(signup), country="de", created_at=ts(f"{signup} 08:00:00"),
        is_active="TRUE",
    )
    return {**row, **more}


def product(product_id, base=10.0, cost=4.0, **more):
    row = dict(
        product_id=product_id, name=f"Thing {product_id}", category="Garden", subcategory="Tools",
        base_price=base, cost_price=cost, created_at=ts("2023-01-01 00:00:00"), is_active="true",
    )
    return {**row, **more}


def event(event_id, user_id="u1", event_type="productview", at="2024-06-01 10:00:00", **more):
    row = dict(
        event_id=event_id, user_id=user_id, session_id="s1", event_type=event_type, product_id="p1",
        page="/p", referrer=None, device_type="desktop", created_at=at,
    )
    return {**row, **more}


@pytest.fixture(scope="session")
def make(spark):
    """make.orders([...]) and so on: raw tables from row dicts."""

    class Make:
        def __getattr__(self, name):
            return lambda rows: table(spark, RAW[name], rows)

    return Make()


def rows(df, *columns):
    """Rows as tuples in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


def by_key(df, key):
    return {row[key]: Row.asDict(row) for row in df.collect()}


def final_plan(df):
    """Physical plan text."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
