"""Bring point-in-time tables, totals and marts up to date with what a delta added to the vault.

``deltas`` holds, per vault table, the rows that a load appended. The vault is insert-only, so a change
is a new version: what lines contributed before is taken off the totals and what they contribute now is
put on. Totals are additive, so old lines that did not change are not read for it. Mart rows are derived
again for the keys that a change reaches, by the same functions as in a full build and over the vault seen
through those keys, and only the cells that hold them are written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.operators import pit
from lakevault.operators.vault import current
from lakevault.plans import marts, model
from lakevault.plans.initial import packed, unpacked
from lakevault.sources.tables import Lake

Deltas = Mapping[str, DataFrame]
TOTALS = {"order_items": "order_hk", "customer_totals": "customer_hk", "product_totals": "product_hk"}
_MART_KEYS = {"mart_revenue_per_customer": "customer_id", "mart_order_overview": "order_id", "mart_product_sales": "product_id"}


def _keys(key: str, *frames: DataFrame | None) -> DataFrame | None:
    """The distinct keys of all frames that are there."""
    found = None
    for frame in frames:
        if frame is not None:
            part = frame.select(key)
            found = part if found is None else found.unionByName(part)
    return None if found is None else found.dropna().distinct()


def line_changes(tables, deltas: Deltas) -> DataFrame | None:
    """What the touched order lines contributed before (``sign`` -1) and contribute now (1)."""
    links, versions = deltas.get("lnk_order_product"), deltas.get("sat_order_detail")
    pk = "order_product_hk"
    touched = _keys(pk, links, versions)
    if touched is None:
        return None
    link, sat = (tables[n].join(touched, pk, "left_semi") for n in ("lnk_order_product", "sat_order_detail"))
    old_link = link if links is None else link.join(links, pk, "left_anti")
    old_sat = sat if versions is None else sat.join(versions, [pk, "load_datetime", "hashdiff"], "left_anti")
    found = None
    for sign, one, other in ((1, link, sat), (-1, old_link, old_sat)):
        payload = current(other, pk).select(pk, "quantity", "unit_price", "discount")
        lines = one.select(pk, "order_hk", "product_hk", "line_number").join(payload, pk)
        part = lines.select("order_hk", "product_hk", "line_number", *[m.alias(n) for n, m in marts.measures().items()], F.lit(sign).alias("sign"))
        found = part if found is None else found.unionByName(part)
    return found


def _signed(changes: DataFrame, key: str, names: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    taken = F.col("sign") < 0
    sums = []
    for n in names:
        sums.append(F.sum(F.when(taken, -F.col(n)).otherwise(F.col(n))).alias(f"{n}_sum"))
        sums.append(F.sum(F.when(F.col(n).isNotNull(), F.col("sign")).otherwise(0)).alias(f"{n}_n"))
    return changes.groupBy(key).agg(*[F.sum(c).alias(n) for n, c in counts.items()], *sums)


def _added_up(stored: DataFrame, change: DataFrame, key: str) -> DataFrame:
    """The stored totals of the changed keys with the change; keys that are left with nothing are none."""
    old = stored.join(change, key, "left_semi")
    columns = [c for c in stored.columns if c != key]
    both = old.unionByName(change.select(stored.columns)).groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])
    return both.select(key, *[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in columns])


def update_totals(lake: Lake, tables, deltas: Deltas, done) -> None:
    """Refresh the totals; ``done(key, keys)`` is told, each as soon as it is, whose totals are up to date.

    Order lines are read once; products and orders go on side by side.
    """
    changes = line_changes(tables, deltas)
    linked = deltas.get("lnk_order_customer")
    read = lambda name: lake.read("meta", name)
    if changes is not None:
        changes = lake.landed(changes, "line-changes")

    def products() -> None:
        if changes is None:
            return done("product_hk", None)
        first = F.when(F.col("line_number") == 1, F.col("sign")).otherwise(0)
        sold = _signed(changes, "product_hk", ["quantity", "gross", "priced", "revenue"], {"orders_count": first})
        lake.refresh("meta", "product_totals", ["product_hk"], rows=_added_up(read("product_totals"), sold, "product_hk"))
        done("product_hk", changes.select("product_hk"))

    def orders() -> None:
        parts, before = [], read("order_items")
        if changes is not None:
            items = lake.landed(_added_up(before, _signed(changes, "order_hk", ["revenue"], {"line_items": F.col("sign")}), "order_hk"), "items")
            known = tables["lnk_order_customer"].join(items, "order_hk", "left_semi")
            known = (known if linked is None else known.join(linked, "order_customer_hk", "left_anti")).select("order_hk", "customer_hk")
            parts += [(known.join(before.join(items, "order_hk", "left_semi"), "order_hk"), -1), (known.join(items, "order_hk"), 1)]
        if linked is not None:
            now = before if changes is None else before.join(items, "order_hk", "left_anti").unionByName(items)
            pairs = linked.select("order_hk", "customer_hk")
            parts.append((pairs.join(now.join(pairs, "order_hk", "left_semi"), "order_hk"), 1))
        moved = None
        for rows, sign in parts:
            part = rows.select("customer_hk", F.lit(sign).alias("sign"), F.col("revenue_sum").alias("sum"), F.col("revenue_n").alias("n"))
            moved = part if moved is None else moved.unionByName(part)

        def customers() -> None:
            if moved is None:
                return done("customer_hk", None)
            change = moved.groupBy("customer_hk").agg(
                F.sum("sign").alias("total_orders"), F.sum(F.when(F.col("sign") < 0, -F.col("sum")).otherwise(F.col("sum"))).alias("revenue_sum"),
                F.sum(F.col("sign") * F.col("n")).alias("revenue_n"))
            totals = lake.landed(_added_up(read("customer_totals"), change, "customer_hk"), "customers")
            lake.refresh("meta", "customer_totals", ["customer_hk"], rows=totals)
            done("customer_hk", totals.select("customer_hk"))

        def overview() -> None:
            if changes is not None:
                lake.refresh("meta", "order_items", ["order_hk"], rows=items)
            done("order_hk", None if changes is None else items.select("order_hk"))

        # ``before`` is the state that was there: a refresh leaves it readable
        side_by_side([customers, overview])

    side_by_side([products, orders])


def side_by_side(jobs: Sequence[Callable[[], None]]) -> None:
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        list(pool.map(lambda job: job(), jobs))


def build_totals(lake: Lake, tables) -> None:
    """All totals from the whole vault; lines are grouped by the 16 bytes of a key."""
    lines = packed(marts.order_lines(tables), "order_hk", "product_hk")

    def orders() -> None:
        lake.refresh("meta", "order_items", ["order_hk"], rows=unpacked(marts.item_totals(lines)), whole=True)
        lake.refresh("meta", "customer_totals", ["customer_hk"], rows=marts.customer_totals(tables, lake.read("meta", "order_items")), whole=True)

    side_by_side([orders, lambda: lake.refresh("meta", "product_totals", ["product_hk"], rows=unpacked(marts.product_totals(lines)), whole=True)])


def mart_rows(lake: Lake, name: str, tables, keys: DataFrame | None = None) -> DataFrame:
    """A mart's rows from the stored totals, all of them or those of the given hub keys."""
    functions = {
        "mart_revenue_per_customer": (marts.revenue_per_customer, "totals", "customer_totals"),
        "mart_order_overview": (marts.order_overview, "items", "order_items"),
        "mart_product_sales": (marts.product_sales, "totals", "product_totals"),
    }
    function, argument, totals = functions[name]
    stored, key = lake.read("meta", totals), TOTALS[totals]
    if keys is None:
        return function(tables, **{argument: stored})
    return function(marts.Among(tables, keys, key), **{argument: stored.join(keys, key, "left_semi")})


def reached(tables, deltas: Deltas, name: str, changed: DataFrame | None) -> DataFrame | None:
    """The hub keys whose rows of a mart a delta reaches; ``changed`` are those whose totals did."""
    d = deltas.get
    if name == "mart_product_sales":
        return _keys("product_hk", d("hub_product"), d("sat_product"), changed)
    customers, employees = (_keys(f"{n}_hk", d(f"hub_{n}"), d(f"sat_{n}")) for n in ("customer", "employee"))
    if name == "mart_revenue_per_customer":
        return _keys("customer_hk", customers, changed)
    via = [tables[f"lnk_order_{n}"].join(keys, f"{n}_hk", "left_semi") for n, keys in (("customer", customers), ("employee", employees)) if keys is not None]
    return _keys("order_hk", d("hub_order"), d("sat_order"), d("lnk_order_customer"), d("lnk_order_employee"), changed, *via)


def update_marts(lake: Lake, tables, deltas: Deltas, names: Sequence[str]) -> None:
    """Refresh totals and marts after a load, each mart as soon as its totals are up to date."""
    of_key = {"customer_hk": "mart_revenue_per_customer", "order_hk": "mart_order_overview", "product_hk": "mart_product_sales"}

    def refresh(key: str, changed: DataFrame | None) -> None:
        name = of_key[key]
        keys = reached(tables, deltas, name, changed) if name in names else None
        if keys is not None:
            rows = mart_rows(lake, name, tables, lake.landed(keys, "reached"))
            lake.refresh("mart", name, [_MART_KEYS[name]], rows=rows)

    update_totals(lake, tables, deltas, refresh)


def build_mart(lake: Lake, name: str, tables) -> None:
    lake.refresh("mart", name, [_MART_KEYS[name]], rows=mart_rows(lake, name, tables), whole=True)


# --- point-in-time tables ---


def build_pit(lake: Lake, name: str, tables, dates: Sequence[datetime]) -> None:
    hub, sats = model.PITS[name]
    pk = model.HUBS[hub].pk
    rows = pit.build_pit(tables[hub], pk, {s: tables[s] for s in sats}, dates)
    lake.refresh("raw_vault", name, [pk, "as_of_date"], rows=rows, cell="as_of_date", whole=True)


def update_pit(lake: Lake, name: str, tables, deltas: Deltas, dates: Sequence[datetime]) -> None:
    """New versions move the pointers of their keys at the dates they reach; new keys get a row for every
    date; dates that are not stored yet carry the pointers of the date before them on."""
    hub, sats = model.PITS[name]
    pk = model.HUBS[hub].pk
    stored = lake.read("raw_vault", name)
    # one row per date
    known = sorted(r[0] for r in stored.select("as_of_date").distinct().collect())
    versions = {s: deltas[s].select(pk, "load_datetime") for s in sats if s in deltas}
    fresh = deltas.get(hub)
    moved = pit.moved(stored, pk, versions, known) if versions else None
    added = None
    if fresh is not None:
        fresh = fresh.select(pk)
        added = pit.build_pit(fresh, pk, {s: tables[s].join(fresh, pk, "left_semi") for s in sats}, known)
    if moved is not None or added is not None:
        lake.refresh("raw_vault", name, [pk, "as_of_date"], rows=moved, added=added, cell="as_of_date")
    new = sorted(set(dates) - set(known))
    if new:
        rows = pit.carried(lake.read("raw_vault", name), tables[hub], pk, {s: tables[s] for s in sats}, known, new)
        lake.refresh("raw_vault", name, [pk, "as_of_date"], added=rows, cell="as_of_date")
