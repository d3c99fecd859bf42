import random
import re
from collections import Counter, defaultdict

import pytest

from basketry.operators import questions

ORDERS = (
    "order_id int, user_id int, order_number int, days_since_prior_order double, "
    "is_first_order boolean"
)
ITEMS = (
    "order_id int, product_id int, reordered int, user_id int, order_number int, "
    "product_name string, aisle_id int, aisle string, department_id int, department string"
)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    orders, items = [], []
    order_id = 0
    for user in range(40):
        for number in range(1, rng.choice([1, 2, 4, 9, 14, 25]) + 1):
            order_id += 1
            days = 0.0 if number == 1 else rng.choice([None, 3.0, 7.0, 30.0])
            orders.append((order_id, user, number, days, number == 1))
            for _ in range(rng.randrange(0, 6)):
                p = rng.randrange(8)
                row = (order_id, p, rng.choice([0, 1, None]), user, number, f"p{p}")
                items.append((*row, p % 3, f"a{p % 3}", p % 2, f"d{p % 2}" if p % 2 else None))
    return (
        orders,
        items,
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(items, ITEMS),
    )


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_shares(data):
    _, items, _, df = data
    want = [(k, n, round(n / len(items), 4)) for k, n in Counter(i[6] for i in items).items()]
    got = rows(questions.aisle_share(df), "aisle_id", "item_count", "item_share")
    assert got == sorted(want, key=str)
    want = [(k, n, round(n / len(items), 4)) for k, n in Counter(i[8] for i in items).items()]
    got = rows(questions.department_volume(df), "department_id", "item_count", "item_share")
    assert got == sorted(want, key=str)


def test_basket_size(data):
    _, items, _, df = data
    n = len({i[0] for i in items})
    assert tuple(questions.basket_size(df).first()) == (n, len(items), round(len(items) / n, 4))
    assert tuple(questions.basket_size(df.where("false")).first()) == (0, 0, None)


def mean_days(orders):
    days = [o[3] for o in orders if not o[4] and o[3] is not None]
    return round(sum(days) / len(days), 4) if days else None


def test_order_interval(data):
    orders, _, df, _ = data
    by_user = defaultdict(list)
    for o in orders:
        by_user[o[1]].append(o)
    want = [(u, len(os), mean_days(os)) for u, os in by_user.items()]
    assert None in {w[2] for w in want}
    got = rows(questions.order_interval(df), "user_id", "order_count", "avg_days_between_orders")
    assert got == sorted(want, key=str)


def test_user_frequency(data):
    orders, _, df, _ = data
    n_of = Counter(o[1] for o in orders)
    groups = defaultdict(list)
    for o in orders:
        n = n_of[o[1]]
        name = next((name for upper, name in questions.FREQUENCY_GROUPS if n <= upper), "21+")
        groups[name].append(o)
    want = [(g, len({o[1] for o in os}), len(os), mean_days(os)) for g, os in groups.items()]
    columns = ["frequency_group", "user_count", "order_count", "avg_days_between_orders"]
    assert rows(questions.user_frequency(df), *columns) == sorted(want, key=str)


def test_successive_products(data):
    _, items, _, df = data
    bought = {(i[1], i[3], i[4]) for i in items}
    repeats = [(p, u) for p, u, n in bought if (p, u, n + 1) in bought]
    want = [
        (p, n, len({u for q, u in repeats if q == p}))
        for p, n in Counter(p for p, _ in repeats).items()
    ]
    columns = ["product_id", "successive_purchases", "distinct_users"]
    assert rows(questions.successive_products(df), *columns) == sorted(want, key=str)


def test_successive_products_at_the_ends_of_words(spark):
    numbers = [-64, -63, -62, -1, 0, 1, 5, 62, 63, 64, 125, 126, 127, 200, 2147483647]
    rows = [(n, 1, 0, 9, n, "p", 1, "a", 1, "d") for n in numbers for _ in range(2)]
    got = questions.successive_products(spark.createDataFrame(rows, ITEMS)).collect()
    pairs = sum(n + 1 in numbers for n in numbers)
    assert [tuple(r) for r in got] == [(1, "p", pairs, 1)]


def test_department_repurchase(data):
    _, items, _, df = data
    want = []
    for d in {i[8] for i in items}:
        mine = [i for i in items if i[8] == d]
        users = {i[3] for i in mine}
        back = {i[3] for i in mine if i[2] == 1}
        want.append((d, len(mine), len(users), len(back), round(len(back) / len(users), 4)))
    columns = [
        "department_id", "total_order_rows", "distinct_users", "distinct_reordering_users",
        "returning_user_share",
    ]
    assert rows(questions.department_repurchase(df), *columns) == sorted(want, key=str)


@pytest.mark.parametrize("chunk", [1, 4, questions._CHUNK])
def test_cohort_retention(data, monkeypatch, chunk):
    monkeypatch.setattr(questions, "_CHUNK", chunk)
    orders, _, df, _ = data
    users, counts = defaultdict(set), Counter()
    for user in {o[1] for o in orders}:
        mine = sorted((o for o in orders if o[1] == user), key=lambda o: o[2])
        gap = next((o[3] for o in mine if o[2] == 2), None)
        cohort = "unknown" if gap is None else "0-30" if gap <= 30 else "31-90"
        since = 0
        for i, o in enumerate(mine):
            since += (o[3] or 0) if i else 0
            period = next(name for lower, name in questions.PERIODS if since >= lower)
            users[cohort, period].add(user)
            counts[cohort, period] += 1
    want = [
        (c, p, len(u), counts[c, p], round(len(u) / len(users[c, "0-89"]), 4))
        for (c, p), u in users.items()
    ]
    columns = ["cohort", "period", "user_count", "order_count", "user_share"]
    assert rows(questions.cohort_retention(df), *columns) == sorted(want, key=str)
    assert len(want) > 4


def test_cohorts_share_one_scan_of_the_orders(spark, tmp_path, data):
    data[2].write.parquet(f"{tmp_path}/orders")
    df = questions.cohort_retention(spark.read.parquet(f"{tmp_path}/orders"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan", final)) == 1 or "ReusedExchange" in final


def test_basket_evolution(data):
    _, items, _, df = data
    want = []
    for k in {i[4] for i in items}:
        mine = [i for i in items if i[4] == k]
        n = len({i[0] for i in mine})
        again = [i[2] for i in mine if i[2] is not None]
        rate = round(sum(again) / len(mine), 4) if again else None
        want.append((k, n, len(mine), round(len(mine) / n, 4), rate))
    columns = ["order_number", "order_count", "item_count", "avg_items_per_order", "reorder_rate"]
    assert rows(questions.basket_evolution(df), *columns) == sorted(want, key=str)
