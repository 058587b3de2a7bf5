from basketry.operators import facts, staging
from tests.conftest import order, rows, user


def test_salted_join_equals_plain_join(make):
    orders = staging.stg_orders(make.orders(
        [order(f"o{i}", "hot" if i % 3 else f"u{i}") for i in range(60)] + [order("x", None), order("y", "nobody")]
    ))
    users = staging.stg_users(make.users([user("hot"), *(user(f"u{i}", "free") for i in range(0, 60, 3))]))
    plain = facts.with_user(orders, users)
    salted = facts.with_user(orders, users, salts=5)
    assert plain.columns == salted.columns
    assert rows(plain) == rows(salted)
    assert plain.count() == 62
