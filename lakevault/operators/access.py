"""Access views: choose satellites, get one joined DataFrame.

``VaultModel`` holds the declared hubs, links, satellites and point-in-time tables and resolves how
they belong together. ``access_view`` joins the involved hubs by the smallest tree of links that
connects them (a Steiner tree), over hubs that were not asked for where that is shorter; so the view does
not depend on the order of choice. Two smallest trees that mean different joins are an error, and so is a
hub that cannot be reached: there is never an unconditioned join.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.pit import at_point
from lakevault.operators.vault import HubSpec, LinkSpec, SatSpec, current


class AmbiguousModelError(ValueError):
    pass


class MissingLinkError(ValueError):
    pass


@dataclass
class VaultModel:
    """``pits`` maps a PIT name to (hub name, satellite names)."""

    hubs: Mapping[str, HubSpec]
    links: Mapping[str, LinkSpec]
    sats: Mapping[str, SatSpec]
    pits: Mapping[str, tuple[str, Sequence[str]]] = field(default_factory=dict)
    branch: str | None = None

    def __post_init__(self) -> None:
        if self.branch:
            self.hubs, self.links, self.sats = (
                {n: s for n, s in group.items() if s.branch == self.branch}
                for group in (self.hubs, self.links, self.sats))
        self.hub_of_key: dict[str, str] = {}
        for name, hub in self.hubs.items():
            if hub.pk in self.hub_of_key:
                raise AmbiguousModelError(
                    f"{self.hub_of_key[hub.pk]} and {name} share the key {hub.pk}; name a branch")
            self.hub_of_key[hub.pk] = name
        self.link_of_key = {link.pk: name for name, link in self.links.items()}
        self.link_hubs = {
            name: [self.hub_of_key[fk] for fk in link.fks if fk in self.hub_of_key]
            for name, link in self.links.items()
        }
        for name, sat in self.sats.items():
            if sat.pk not in self.hub_of_key and sat.pk not in self.link_of_key:
                raise AmbiguousModelError(f"{name}: no hub or link has the key {sat.pk}")
        for name, (hub, _) in self.pits.items():
            if hub not in self.hubs:
                raise AmbiguousModelError(f"{name}: unknown hub {hub}")

    def parent(self, sat: str) -> tuple[str, str]:
        pk = self.sats[sat].pk
        return ("hub", self.hub_of_key[pk]) if pk in self.hub_of_key else ("link", self.link_of_key[pk])

    def pit_of(self, hub: str) -> str | None:
        return next((name for name, (owner, _) in self.pits.items() if owner == hub), None)

    def smallest_trees(self, wanted: Sequence[str]) -> list[frozenset[tuple[str, str]]]:
        """The smallest trees of (link, hub) edges that hold all wanted hubs and links; two are found if
        there are more.

        Dynamic programming over subsets of what is wanted: the best trees that connect a subset and end
        at some hub or link are joins of best trees of two parts there, or a best tree at a neighbour and
        the edge to it.
        """
        near: dict[str, list[str]] = {h: [] for h in self.hubs}
        for link, hubs in self.link_hubs.items():
            near[link] = sorted(set(hubs))
            for hub in near[link]:
                near[hub].append(link)
        edge = lambda a, b: (a, b) if a in self.links else (b, a)
        best: dict[tuple[int, str], list[frozenset]] = {}

        def offer(subset: int, at: str, trees: Sequence[frozenset]) -> bool:
            held = best.get((subset, at), [])
            least = min((len(t) for t in [*held, *trees]), default=0)
            kept = sorted({t for t in [*held, *trees] if len(t) == least}, key=sorted)[:2]
            best[subset, at] = kept
            return kept != held

        wanted = list(dict.fromkeys(wanted))
        for n, name in enumerate(wanted):
            offer(1 << n, name, [frozenset()])
        whole = (1 << len(wanted)) - 1
        for subset in range(1, whole + 1):
            for at in near:
                part = (subset - 1) & subset
                while part > subset - part:
                    one, two = best.get((part, at)), best.get((subset - part, at))
                    if one and two:
                        offer(subset, at, [a | b for a in one for b in two])
                    part = (part - 1) & subset
            waiting = deque(at for at in near if (subset, at) in best)
            while waiting:
                at = waiting.popleft()
                for other in near[at]:
                    if offer(subset, other, [t | {edge(at, other)} for t in best[subset, at]]):
                        waiting.append(other)
        found = best.get((whole, wanted[0]))
        if not found:
            alone = next(n for k, n in enumerate(wanted) if (1 | 1 << k, n) not in best)
            raise MissingLinkError(f"no link between {wanted[0]} and {alone}")
        return found

    def steps(self, hubs: Sequence[str], links: Sequence[str] = ()) -> list[tuple[str, str, str]]:
        """Joins (from hub, link, to hub) that connect the hubs and take in the links, from the first hub on.

        All direct links between two of the hubs take part, so trees that differ only in these are one.
        """
        every = [*hubs, *[h for link in links for h in self.link_hubs[link]]]
        direct = {link for link, near in self.link_hubs.items() if len(set(near) & set(hubs)) >= 2}
        trees = self.smallest_trees([*every, *links])
        if len({frozenset({link for link, _ in t} | direct) for t in trees}) > 1:
            ways = " or ".join(", ".join(sorted({link for link, _ in t})) for t in trees)
            raise AmbiguousModelError(f"{', '.join(dict.fromkeys(every))} are connected by {ways}; choose a satellite of one of them as well")
        tree, joined, out = set(trees[0]), [every[0]], []
        for hub in joined:
            for link, _ in sorted(e for e in tree if e[1] == hub):
                for other in [h for l, h in sorted(tree) if l == link]:
                    if other not in joined:
                        joined.append(other)
                        out.append((hub, link, other))
                if link not in {s[1] for s in out}:
                    out.append((hub, link, hub))
        return out

    def catalog(self, spark: SparkSession) -> DataFrame:
        """One row per vault object: kind, key, parents and number of payload columns."""
        rows = [("hub", n, h.pk, [], 0) for n, h in self.hubs.items()]
        rows += [("link", n, l.pk, self.link_hubs[n], len(l.fks)) for n, l in self.links.items()]
        rows += [("satellite", n, s.pk, [self.parent(n)[1]], len(s.payload)) for n, s in self.sats.items()]
        rows += [("pit", n, self.hubs[h].pk, [h], len(s)) for n, (h, s) in self.pits.items()]
        return spark.createDataFrame(
            rows, "kind string, name string, pk string, parents array<string>, n_columns int")


def view_name(sats: Sequence[str]) -> str:
    return "v_access_" + "_".join(s.removeprefix("sat_") for s in sats)


def access_view(
    model: VaultModel, tables: Mapping[str, DataFrame], sats: Sequence[str], *,
    as_of: Column | None = None, extra: Mapping[str, tuple[DataFrame, Sequence[str]]] | None = None,
) -> DataFrame:
    """Natural keys of the involved hubs, then the payload of each chosen satellite.

    The current version is taken, or with ``as_of`` the version valid at that date: from the hub's
    point-in-time table if it holds the date (one existence check), else from the versions
    themselves. Equal payload names are told apart by the satellite's name in front.
    ``extra`` adds tables that are not part of the vault, each with the columns to join on; there
    is no unconditioned join.
    """
    unknown = [s for s in sats if s not in model.sats]
    if unknown or not sats:
        raise ValueError(f"unknown satellites: {unknown}" if unknown else "no satellite chosen")
    parents = {s: model.parent(s) for s in sats}
    hubs: list[str] = []
    for kind, parent in parents.values():
        hubs += [h for h in ([parent] if kind == "hub" else model.link_hubs[parent]) if h not in hubs]

    # payload columns get their final names before any join
    seen: dict[str, int] = {}
    for sat in sats:
        for column in model.sats[sat].payload:
            seen[column] = seen.get(column, 0) + 1
    names = {
        (sat, c): c if seen[c] == 1 else f"{sat}_{c}"
        for sat in sats for c in model.sats[sat].payload
    }

    held: dict[str, bool] = {}

    def holds(pit: str) -> bool:
        if pit not in held:
            held[pit] = bool(tables[pit].where(F.col("as_of_date") == as_of).limit(1).count())
        return held[pit]

    def versions(sat: str) -> DataFrame:
        spec = model.sats[sat]
        kind, parent = parents[sat]
        pit = model.pit_of(parent) if kind == "hub" else None
        if as_of is not None and pit and sat in model.pits[pit][1] and holds(pit):
            found = at_point(tables[pit].where(F.col("as_of_date") == as_of), tables[sat], spec.pk, sat)
        elif as_of is not None:
            found = current(tables[sat].where(F.col(spec.ldts) <= as_of), spec.pk)
        else:
            found = current(tables[sat], spec.pk)
        return found.select(spec.pk, *[F.col(c).alias(names[sat, c]) for c in spec.payload])

    def with_sats(df: DataFrame, kind: str, parent: str) -> DataFrame:
        for sat in sats:
            if parents[sat] == (kind, parent):
                df = df.join(versions(sat), model.sats[sat].pk)
        return df

    def hub_part(hub: str) -> DataFrame:
        return with_sats(tables[hub].select(model.hubs[hub].pk, model.hubs[hub].nk), "hub", hub)

    def link_part(link: str) -> DataFrame:
        spec = model.links[link]
        return with_sats(tables[link].select(spec.pk, *spec.fks), "link", link)

    joined = {hubs[0]}
    used: set[str] = set()
    view = hub_part(hubs[0])

    def walk(steps) -> None:
        nonlocal view
        for source, link, target in steps:
            if link not in used:
                keys = [model.hubs[h].pk for h in model.link_hubs[link] if h in joined]
                part = link_part(link)
                if target not in joined and ("hub", target) not in parents.values():
                    # a hub of which only the key is shown joins the link's rows while these are narrow
                    part = part.join(hub_part(target), model.hubs[target].pk)
                    joined.add(target)
                view = view.join(part, keys)
                used.add(link)
            if target not in joined:
                view = view.join(hub_part(target), model.hubs[target].pk)
                joined.add(target)

    walk(model.steps(hubs, [parent for kind, parent in parents.values() if kind == "link"]))
    # any further link between two involved hubs restricts the view as well
    for link, near in model.link_hubs.items():
        if link not in used and len(set(near) & set(hubs)) >= 2:
            walk([(near[0], link, near[0])])

    columns = [model.hubs[h].nk for h in hubs] + [names[s, c] for s in sats for c in model.sats[s].payload]
    view = view.select(*columns)
    for name, (df, on) in (extra or {}).items():
        if not on:
            raise MissingLinkError(f"{name}: no columns to join on")
        view = view.join(df, list(on), "left")
    return view


def store_access_view(lake, model: VaultModel, tables: Mapping[str, DataFrame], sats: Sequence[str], **options) -> str:
    """Store an access view as ``mart.v_access_<satellites>``, replacing an earlier one; returns its name."""
    name = view_name(sats)
    lake.replace("mart", name, access_view(model, tables, sats, **options))
    return name
