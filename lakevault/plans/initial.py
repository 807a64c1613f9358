"""The vault as it stands after the first delivery, or after the delta, as DataFrames.

A ``Vault`` answers ``vault["sat_order"]`` with the rows the loaders produce; nothing is stored.
The stored form of the same thing is in ``lakevault.plans.build``.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.staging import dealt, stage
from lakevault.operators.vault import HubSpec, LinkSpec, key_rows, sat_rows
from lakevault.plans import model, raw


#: tables of the orders' source that take nothing from the lines
_WITHOUT_LINES = ("hub_order", "lnk_order_customer")


class Vault:
    """``dealt`` names tables whose rows of the first load are wanted by their packed key, as a join on it takes them."""

    def __init__(self, spark: SparkSession, sf_dir: str, with_delta: bool = False, dealt: Collection[str] = ()):
        self.spark, self.sf_dir, self.with_delta, self.dealt = spark, sf_dir, with_delta, dealt

    def first_load(self, name: str) -> DataFrame:
        spec = self._spec(name)
        return self._rows(spec, 1, None)

    def delta_rows(self, name: str) -> DataFrame:
        """What batch 2 adds to the table."""
        spec = self._spec(name)
        return self._rows(spec, 2, self.first_load(name))

    def __getitem__(self, name: str) -> DataFrame:
        first = self.first_load(name)
        if self.with_delta and self._spec(name).source in model._RAW[2]:
            return first.unionByName(self.delta_rows(name))
        return first

    def _rows(self, spec, batch: int, target: DataFrame | None) -> DataFrame:
        if batch == 1 and spec.name in _WITHOUT_LINES:
            source = stage(raw.orders(self.spark, self.sf_dir, with_lines=False), model.STAGING["orders"])
        elif batch == 1 and spec.name in self.dealt:
            rows, rules = model._RAW[batch][spec.source](self.spark, self.sf_dir), model.STAGING[spec.source]
            source = stage(dealt(rows, rules, spec.pk, packed=True), rules)
        else:
            source = model.staged(self.spark, self.sf_dir, spec.source, batch)
        load = key_rows if isinstance(spec, (HubSpec, LinkSpec)) else sat_rows
        return load(source, target, spec)

    @staticmethod
    def _spec(name: str):
        return {**model.HUBS, **model.LINKS, **model.SATS}[name]


class Packed:
    """A vault whose MD5 keys and change hashes are the 16 bytes their text stands for.

    Joins and groups on them shuffle half as much, and the order of hashes is that of their texts. For results
    that hold no keys, or unpack them.
    """

    def __init__(self, vault):
        self.vault = vault

    def __getitem__(self, name: str) -> DataFrame:
        rows = self.vault[name]
        return packed(rows, *[c for c in rows.columns if c.endswith("_hk") or c == "hashdiff"])


def packed(rows: DataFrame, *columns: str) -> DataFrame:
    """MD5 texts as the 16 bytes they stand for."""
    return rows.withColumns({c: F.unhex(c) for c in columns})


def unpacked(rows: DataFrame) -> DataFrame:
    """Keys as texts again."""
    return rows.withColumns({c: F.lower(F.hex(c)) for c in rows.columns if c.endswith("_hk")})
