"""Staging: derived, hashed and ranked columns in one projection over a source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.functions.hashing import hash_key, hashdiff
from lakevault.operators.ordered import ranked


@dataclass(frozen=True)
class Diff:
    """A change hash over the named payload columns."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class Rank:
    partition_by: tuple[str, ...]
    order_by: tuple[str, ...]
    dense: bool = False


@dataclass(frozen=True)
class StageSpec:
    """``derived`` maps a new name to a source column, or to a constant when led by ``!``."""

    derived: Mapping[str, str] = field(default_factory=dict)
    hashed: Mapping[str, str | Sequence[str] | Diff] = field(default_factory=dict)
    ranked: Mapping[str, Rank] = field(default_factory=dict)
    include_source: bool = True


def derived_column(rule: str) -> Column:
    return F.lit(rule[1:]) if rule.startswith("!") else F.col(rule)


def dealt(df: DataFrame, spec: StageSpec, column: str, parts: int | None = None, packed: bool = False) -> DataFrame:
    """The source's rows by a hashed column, as its buckets take them, with nothing hashed yet.

    What is shuffled is the source's own columns, of which numbers are a fraction of the hashes made from them. With
    ``packed`` the rows lie by the 16 bytes of the hash, else by its text.
    """
    rule = spec.hashed[column]
    key = hash_key(df, [rule] if isinstance(rule, str) else rule)
    key = F.unhex(key) if packed else key
    return df.repartition(parts, key) if parts else df.repartition(key)


def stage(df: DataFrame, spec: StageSpec) -> DataFrame:
    """No shuffle unless ranked columns are asked for."""
    derived = df.withColumns({n: derived_column(r) for n, r in spec.derived.items()})
    hashes = {}
    for name, rule in spec.hashed.items():
        if isinstance(rule, Diff):
            hashes[name] = hashdiff(derived, rule.columns)
        else:
            hashes[name] = hash_key(derived, [rule] if isinstance(rule, str) else rule)
    staged = derived.withColumns(hashes) if hashes else derived
    for name, rank in spec.ranked.items():
        staged = ranked(staged, rank.partition_by, rank.order_by, name, rank.dense)
    if spec.include_source:
        return staged
    return staged.select(*spec.derived, *spec.hashed, *spec.ranked)


def cast_interface(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The declared columns with their declared types, nothing else."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in types.items()])
