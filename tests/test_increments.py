"""Incremental marts and point-in-time tables against full rebuilds, with every kind of change."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lakevault.operators import pit
from lakevault.plans import build, increments, marts, model

DAY = datetime(2024, 1, 1)
DATES = [DAY + timedelta(days=d) for d in (0, 3, 7)]
SHAPES = {
    "customers": "id bigint, name string, segment string, nation_id int, balance decimal(19,4), change_date timestamp_ntz",
    "employees": "id bigint, name string, nation_id int, balance decimal(19,4), change_date timestamp_ntz",
    "products": "id bigint, product_name string, product_code string, category string, size int, list_price decimal(12,2), standard_cost decimal(12,4), change_date timestamp_ntz",
    "orders": "id bigint, employee_id bigint, customer_id bigint, order_date timestamp_ntz, shipped_date timestamp_ntz, shipping_fee decimal(19,4), payment_type string, order_status string, change_date timestamp_ntz",
    "order_details": "order_id bigint, product_id bigint, line_number int, quantity decimal(9,2), unit_price decimal(12,2), discount decimal(5,2), order_detail_status string, date_allocated timestamp_ntz, change_date timestamp_ntz",
}


class Source:
    """A source system that changes at random."""

    def __init__(self, seed):
        self.rng, self.ids, self.lines = random.Random(seed), {t: 0 for t in SHAPES}, {}

    def decimal(self, most, digits=2):
        from decimal import Decimal

        return Decimal(self.rng.randrange(most)).scaleb(-digits)

    def row(self, table, key, when):
        rng, pick = self.rng, lambda t: self.rng.randint(1, self.ids[t]) if self.ids[t] else None
        if table == "customers":
            return (key, f"c{key}", rng.choice("AB"), rng.randrange(5), self.decimal(10**6, 4), when)
        if table == "employees":
            return (key, f"e{rng.randrange(50)}", rng.randrange(5), self.decimal(10**6, 4), when)
        if table == "products":
            return (key, f"p{key}", "code", rng.choice("XY"), 3, self.decimal(10**4), self.decimal(10**6, 4), when)
        return (key, pick("employees"), pick("customers"), when, rng.choice([None, when]), self.decimal(10**5, 4), "cash", rng.choice("OF"), when)

    def delivery(self, when, new, changed):
        rows = {}
        for table in ("customers", "employees", "products", "orders"):
            old = self.ids[table]
            keys = self.rng.sample(range(1, old + 1), min(changed, old)) + list(range(old + 1, old + 1 + new))
            self.ids[table] = old + new
            rows[table] = [self.row(table, k, when) for k in keys]
        keys = self.rng.sample(sorted(self.lines), min(changed, len(self.lines)))
        for _ in range(3 * new):
            pair = (self.rng.randint(1, max(1, self.ids["orders"] - 2)), self.rng.randint(1, max(1, self.ids["products"] - 1)))
            number = 1 + sum(k[:2] == pair for k in self.lines)
            self.lines[(*pair, number)] = True
            keys.append((*pair, number))
        rows["order_details"] = [
            (*k, self.decimal(1000), None if self.rng.random() < 0.2 else self.decimal(10**4), self.decimal(20), "O", None, when) for k in dict.fromkeys(keys)]
        return rows


def load(spark, lake, rows):
    staged = {t: build.stage(spark.createDataFrame(r, SHAPES[t]), model.STAGING[t]) for t, r in rows.items()}
    return build.load_vault(lake, staged.get, build.select_models(exclude=["psa"]), keep=True)


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_against_full_builds(spark, lake):
    source = Source(1)
    load(spark, lake, source.delivery(DAY, 12, 0))
    names, tables = build.select_models(exclude=["psa"]), build.Tables(lake)
    build.build_pits(lake, names, DATES[:1])
    build.build_marts(lake, names)
    for day, dates in ((2, DATES[:1]), (5, [*DATES, DAY - timedelta(days=1), DAY + timedelta(days=1)])):
        deltas = load(spark, lake, source.delivery(DAY + timedelta(days=day), 3, 4))
        for name in model.PITS:
            increments.update_pit(lake, name, tables, deltas, dates)
            hub, sats = model.PITS[name]
            whole = pit.build_pit(tables[hub], model.HUBS[hub].pk, {s: tables[s] for s in sats}, dates)
            assert rows_of(lake.read("raw_vault", name)) == rows_of(whole)
        increments.update_marts(lake, tables, deltas, names)
        lines = marts.order_lines(tables)
        assert rows_of(lake.read("meta", "order_items")) == rows_of(marts.item_totals(lines))
        assert rows_of(lake.read("meta", "product_totals")) == rows_of(marts.product_totals(lines))
        assert rows_of(lake.read("meta", "customer_totals")) == rows_of(marts.customer_totals(tables, marts.item_totals(lines)))
        for name, mart in marts.MARTS.items():
            assert rows_of(lake.read("mart", name)) == rows_of(mart(tables)), name


def test_a_date_is_added_without_older_versions(spark, lake):
    """The satellite is read only after the last stored date."""
    t = lambda day: DAY + timedelta(days=day)
    hub = spark.createDataFrame([("a",), ("b",), ("c",)], "pk string")
    sat = spark.createDataFrame([("a", t(0)), ("a", t(2)), ("b", t(4))], "pk string, load_datetime timestamp_ntz")
    dates = [t(d) for d in range(1000)]
    stored = lake.landed(pit.build_pit(hub, "pk", {"s": sat}, dates[:3]), "pit")
    lost = sat.where(F.col("load_datetime") > F.lit(str(t(2))).cast("timestamp_ntz"))  # older versions are not there any more
    got = stored.unionByName(pit.carried(stored, hub, "pk", {"s": lost}, dates[:3], dates[3:]))
    assert rows_of(got) == rows_of(pit.build_pit(hub, "pk", {"s": sat}, dates))
