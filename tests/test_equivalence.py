"""The monthly marts against totals worked out in plain Python over generated rows,
with NULL keys, names and amounts and duplicate dimension keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

from tillflow.operators import enrich as E
from tillflow.operators import marts as M
from tillflow.schema import CUSTOMER_SCHEMA, SALES_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA

CENT = D("0.01")


def _cents(x):
    return None if x is None else x.quantize(CENT, ROUND_HALF_UP)


def _add(totals, key, amount):
    """Sum that skips NULL; a key of only NULLs stays NULL."""
    old = totals.setdefault(key, None)
    if amount is not None:
        totals[key] = amount if old is None else old + amount


def _generated(seed):
    """Sales where customer 1 holds a third of all rows, with NULL keys and amounts, keys
    missing from dimensions, and duplicate dimension keys."""
    rnd = random.Random(seed)
    sales = []
    for i in range(600):
        cust = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, 5, 99, None])
        sales.append((cust, rnd.choice([10, 11, 12, None]), "pen",
                      None if rnd.random() < 0.05 else dt.date(2001, rnd.randint(1, 4), 1),
                      rnd.choice([100, 101, 102, 999]), D("1.00"), 1,
                      None if rnd.random() < 0.1 else D(rnd.randint(1, 99999)) / 1000, None))
    customer = [(1, "a", "b", "x", "1", "2"), (2, "c", "d", "y", "1", "2"),
                (2, "c", "e", "y", "1", "2"), (3, None, "f", "z", "1", "2"),
                (4, "g", "h", "w", "1", "2"), (4, "g", "h", "w", "1", "2")]  # exact copy
    store = [(10, "s", "m"), (11, "t", "n"), (11, "t2", "n2")]
    team = [(100, "p", "q", 100, "Y", "x", "1"), (101, "r", "s", 100, "N", "x", "1"),
            (101, "r", "s2", 100, "N", "x", "1"), (102, "u", None, 100, "N", "x", "1")]
    return sales, customer, store, team


def _name(first, last):
    return None if first is None or last is None else f"{first} {last}"


def _joined(sales, customer, store, team):
    for s in sales:
        for c in customer:
            for st in store:
                for t in team:
                    if (s[0], s[1], s[4]) == (c[0], st[0], t[0]):
                        yield s, c, st, t


def _frames(spark, data):
    return [spark.createDataFrame(rows, schema) for rows, schema in
            zip(data, (SALES_SCHEMA, CUSTOMER_SCHEMA, STORE_SCHEMA, SALES_TEAM_SCHEMA))]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_marts_equal_plain_totals(spark):
    for seed in range(2):
        data = _generated(seed)
        month = lambda d: None if d is None else f"{d:%Y-%m}"
        spend, people, store_sums, who, daily, count = {}, defaultdict(set), {}, defaultdict(set), {}, defaultdict(int)
        for s, c, _, t in _joined(*data):
            _add(spend, (s[0], month(s[3])), s[7])
            people[s[0]].add((_name(c[1], c[2]), c[3], c[5]))
            _add(store_sums, (s[1], s[4], month(s[3])), s[7])
            who[s[4]].add(_name(t[1], t[2]))
            _add(daily, (s[1], s[3]), s[7])
            count[s[1], s[3]] += 1
        frames = _frames(spark, data)
        want = [(k, n, a, p, m, _cents(v)) for (k, m), v in spend.items() for n, a, p in people[k]]
        assert _rows(M.customer_monthly_spend_from_sales(*frames)) == sorted(want, key=repr)
        assert _rows(M.customer_monthly_spend(M.customer_extract(E.enrich(*frames)))) == sorted(want, key=repr)
        want = [(st, p, n, m, _cents(v)) for (st, p, m), v in store_sums.items() for n in who[p]]
        assert _rows(M.salesperson_monthly_sales_from_sales(*frames)) == sorted(want, key=repr)
        assert _rows(M.salesperson_monthly_sales(M.sales_team_extract(E.enrich(*frames)))) == sorted(want, key=repr)
        want = [(st, d, _cents(v), count[st, d]) for (st, d), v in daily.items()]
        assert _rows(M.daily_store_sales_from_sales(*frames)) == sorted(want, key=repr)
        assert _rows(M.daily_store_sales(E.enrich(*frames))) == sorted(want, key=repr)


def test_orphans_equal_plain_lookup(spark):
    data = _generated(5)
    keys = [{r[0] for r in dim} for dim in data[1:]]
    want = [s + flags for s in data[0]
            if any(flags := (s[0] not in keys[0], s[1] not in keys[1], s[4] not in keys[2]))]
    got = E.orphan_sales(*_frames(spark, data))
    assert _rows(got) == _rows(spark.createDataFrame(want, got.schema))


def test_incentive_goes_to_the_highest_total(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(1, 3), p, f"n{p}", rnd.choice(["2001-01", "2001-02", None]),
             None if rnd.random() < 0.15 else D(rnd.choice([100, 250, 250, 999])) / 10)
            for p in range(120)]
    highest = defaultdict(lambda: None)
    for st, _, _, m, v in rows:
        if v is not None and (highest[st, m] is None or v > highest[st, m]):
            highest[st, m] = v
    want = [(*r, D("0.00") if r[4] != highest[r[0], r[3]] else _cents(r[4] * CENT) if r[4] is not None else None)
            for r in rows]
    monthly = spark.createDataFrame(rows, "store_id int, sales_person_id long, full_name string, "
                                          "sales_month string, total_sales decimal(18,2)")
    want = [(*r[:4], _cents(r[4]), r[5]) for r in want]
    assert _rows(M.top_seller_incentive(monthly)) == sorted(want, key=repr)


def test_product_sales_equal_plain_totals(spark):
    sales = [(1, dt.date(2001, 1, 5), 2, D("3.00")), (2, dt.date(2001, 1, 9), 1, D("2.50")),
             (3, dt.date(2001, 1, 9), 4, D("8.00")), (1, dt.date(2001, 2, 1), 1, D("1.50")),
             (9, dt.date(2001, 2, 1), 1, D("1.50")), (None, dt.date(2001, 2, 1), 1, D("1.50"))]
    product = [(1, "pen", D("1.50")), (2, "pen", D("2.50")), (3, "cup", D("2.00"))]
    got = M.product_monthly_sales(
        spark.createDataFrame(sales, "product_id long, sales_date date, quantity int, total_cost decimal(18,2)"),
        spark.createDataFrame(product, "id long, name string, current_price decimal(18,2)"))
    assert _rows(got.select("product_name", "sales_month", "units", "revenue", "list_price")) == [
        ("cup", "2001-01", 4, D("8.00"), D("2.00")), ("pen", "2001-01", 3, D("5.50"), D("2.50")),
        ("pen", "2001-02", 1, D("1.50"), D("2.50"))]
