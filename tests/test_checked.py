import datetime as dt
import json

import pytest

from basketry.schemas import RAW
from basketry.sources import checked
from tests.conftest import rows, ts

ORDERS = ",".join(RAW["orders"].fieldNames())
GOOD = 'a,u1,p1,delivered,2,9.5,1,2024-06-01 10:00:00,EU'


@pytest.fixture()
def folder(tmp_path):
    def write(table, *lines):
        path = tmp_path / table
        path.mkdir(exist_ok=True)
        (path / f"part-{len(list(path.iterdir()))}.csv").write_text("\n".join([",".join(RAW[table].fieldNames()), *lines]) + "\n")
        return str(tmp_path)

    return write


def test_eight_kinds_of_bad_rows(spark, folder):
    bad = {
        "b,u1,p1,delivered,two,9.5,1,2024-06-01 10:00:00,EU": ["quantity"],
        "c,u1,p1,delivered,2.7,9.5,1,2024-06-01 10:00:00,EU": ["quantity"],
        'd,u1,p1,delivered,2,"9,5",1,2024-06-01 10:00:00,EU': ["unit_price"],
        "e,u1,p1,delivered,2,NaN,1,2024-06-01 10:00:00,EU": ["unit_price"],
        "f,u1,p1,delivered,2,9.5,1,2024-02-30 10:00:00,EU": ["created_at"],
        "g,u1,p1,delivered,2,9.5,1,yesterday,EU": ["created_at"],
        "h,u1,p1,delivered,2,9.5,1": ["columns"],
        "i,u1,p1,delivered,2,9.5,1,2024-06-01 10:00:00,EU,more": ["columns"],
        ",u1,p1,delivered,99999999999,x,,2024-06-01 10:00:00,EU": ["order_id", "quantity", "unit_price"],
    }
    good_lines = [GOOD, "k,,,,,,,,", 'l,u2,p2,"ship""ped", 3 ,1e1,-0.5,2024-06-01T10:00:00,', "m,u2,p2,x,1,.5,0,2024-06-01,EU"]
    root = folder("orders", *good_lines[:2], *list(bad)[:5])
    folder("orders", *list(bad)[5:], *good_lines[2:])
    good, rejects = checked.read(spark, root, "orders")
    assert good.schema == RAW["orders"]
    assert good.count() + rejects.count() == len(bad) + len(good_lines)
    got = {}
    for r in rejects.collect():
        key = r.content if "columns" in r.reasons else json.loads(r.content).get("order_id") or ""
        got[key.split(",")[0]] = r.reasons
        assert "/orders/part-" in r.file
    assert got == {line.split(",")[0]: reasons for line, reasons in bad.items()}
    assert dict(rows(checked.reason_counts(rejects))) == {"columns": 2, "created_at": 2, "order_id": 1, "quantity": 3, "unit_price": 3}
    found = {r["order_id"]: r for r in good.collect()}
    assert found["l"]["quantity"] == 3 and found["l"]["unit_price"] == 10.0 and found["l"]["status"] == 'ship"ped' and found["l"]["created_at"] == ts("2024-06-01 10:00:00")
    assert found["k"]["quantity"] is None and found["m"]["created_at"] == ts("2024-06-01 00:00:00")


def test_users_come_day_first(spark, folder):
    root = folder("users", "u1,a@b.c,Ann,pro,31-12-2023,DE,31-12-2023 08:00,TRUE", "u2,a@b.c,Bo,pro,12-31-2023,DE,31-12-2023 08:00,TRUE",
                  "u3,a@b.c,Cy,pro,2023-12-31,DE,2023-12-31 08:00:00,TRUE")
    good, rejects = checked.read(spark, root, "users")
    assert rows(good, "user_id", "signup_date") == [("u1", dt.date(2023, 12, 31)), ("u3", dt.date(2023, 12, 31))]
    assert rows(rejects, "reasons") == [(["signup_date"],)]


def test_nothing_delivered(spark, folder):
    good, rejects = checked.read(spark, folder("products"), "products")
    assert good.count() == rejects.count() == 0
