"""Small helpers: coercion, formats, credentials, configuration, selection, names."""

import base64
import itertools
import json
import random
from datetime import date, datetime

import pytest

from lakevault.functions.runs import readable_age
from lakevault.operators.access import AmbiguousModelError, MissingLinkError, VaultModel, view_name
from lakevault.operators.vault import HubSpec, LinkSpec, SatSpec
from lakevault.plans import build, model
from lakevault.sources import files, paged_api, relational
from lakevault.sources.ingest import from_config, load_configs, since_cursor
from lakevault.sources.tables import layer_name


@pytest.mark.parametrize("value, expected", [
    (None, 3), (datetime(1996, 1, 1, 5), 2), (date(1996, 1, 1), 3), ("1996-01-01", 3), ("1996-01-01T12:30:00", 1),
])
def test_initial_value(spark, value, expected):
    rows = spark.createDataFrame([(datetime(1996, 1, 1),), (datetime(1996, 1, 1, 5),), (datetime(1996, 1, 2),)], "t timestamp_ntz")
    assert since_cursor(rows, "t", value).count() == expected


def test_initial_value_of_another_type(spark):
    assert since_cursor(spark.range(5), "id", 3).count() == since_cursor(spark.range(5), "id", "3").count() == 2
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        since_cursor(spark.range(5), "id", "not a number").collect()


@pytest.mark.parametrize("glob, expected", [
    ("*.csv", "csv"), ("sales_*.CSV", "csv"), ("*.jsonl", "jsonl"), ("*.ndjson", "jsonl"), ("*.parquet", "parquet"),
    ("*.PARQUET", "parquet"), ("*", None), ("*.txt", None), ("data", None),
])
def test_format_detection(glob, expected):
    if expected:
        assert files.drop_format(glob) == expected
    else:
        with pytest.raises(ValueError):
            files.drop_format(glob)


def test_format_errors():
    with pytest.raises(ValueError, match="set 'format'"):
        files.drop_format("*")
    with pytest.raises(ValueError, match="unknown format"):
        files.drop_format("*", "xml")
    assert files.drop_format("*", "csv") == "csv"


def test_auth():
    assert paged_api.auth_parts(None) == ({}, {})
    assert paged_api.auth_parts({"type": "bearer", "token": "t"}) == ({"Authorization": "Bearer t"}, {})
    assert paged_api.auth_parts({"type": "api_key", "key": "k"}) == ({"X-API-Key": "k"}, {})
    assert paged_api.auth_parts({"type": "api_key", "key": "k", "header_name": "q", "location": "query"}) == ({}, {"q": "k"})
    basic = paged_api.auth_parts({"type": "basic", "username": "u", "password": "p"})[0]["Authorization"]
    assert base64.b64decode(basic.split()[1]) == b"u:p"
    with pytest.raises(ValueError, match="unknown auth type"):
        paged_api.auth_parts({"type": "oauth"})


def test_cursor_parameter():
    assert paged_api.cursor_params(None, "x") == {}
    assert paged_api.cursor_params({"cursor": "updated_at"}, None) == {}
    assert paged_api.cursor_params({"cursor": "c", "initial_value": 3}, None) == {"since": "3"}
    assert paged_api.cursor_params({"cursor": "c", "param": "after", "initial_value": 3}, "9") == {"after": "9"}


def test_linked_pages_are_followed(spark):
    def fetch(url, params, headers):
        number = int(url.rsplit("=", 1)[1]) if "=" in url else 1
        following = f"https://api.invalid/x?page={number + 1}" if number < 4 else None
        return {"items": [{"id": number * 10 + i} for i in range(3)], "pages": None, "next": following}

    paged_api.register(spark, "linked_api", fetch)
    got = paged_api.read_resource(spark, "linked_api", "https://api.invalid", "x", "id int").collect()
    assert sorted(r.id for r in got) == [n * 10 + i for n in range(1, 5) for i in range(3)]


def test_connection_options():
    conn = {"c": {"host": "db", "login": "u", "password": "p", "database": "demo"}}
    assert relational.connection_options({"type": "postgres", "connection_id": "c"}, conn) == {
        "driver": "org.postgresql.Driver", "url": "jdbc:postgresql://db:5432/demo", "user": "u", "password": "p"}
    both = {"type": "mysql", "connection_id": "c", "connection_url": "jdbc:mysql://x/y"}
    assert relational.connection_options(both, conn)["url"] == "jdbc:mysql://x/y"
    assert relational.jdbc_url("mssql", {"host": "h", "port": 9, "database": "d"}) == "jdbc:sqlserver://h:9;databaseName=d"
    assert relational.jdbc_url("oracle", {"host": "h", "database": "d"}) == "jdbc:oracle:thin:@//h:1521/d"
    assert relational.jdbc_url("duckdb", {"path": "/x.db"}) == "jdbc:duckdb:/x.db"
    assert [relational.default_port(t) for t in ("postgres", "mssql", "oracle", "mysql", "sqlite", "duckdb")] == [
        5432, 1433, 1521, 3306, 0, 0]
    with pytest.raises(ValueError, match="connection_id"):
        relational.connection_options({"type": "postgres"})
    with pytest.raises(ValueError, match="unknown database"):
        relational.connection_options({"type": "db2", "connection_url": "x"})


def test_parallel_read_options():
    options = relational.table_options({"url": "u"}, "raw", "orders", ("id", 1, 100, 4))
    assert options["dbtable"] == "raw.orders" and options["numPartitions"] == "4" and options["upperBound"] == "100"


CONFIG = {
    "name": "demo", "type": "postgres", "connection_url": "jdbc:x", "target": {"schema": "raw_ingest"},
    "tables": [
        {"name": "customers", "primary_key": "id", "write_disposition": "replace"},
        {"name": "orders", "primary_key": "id", "write_disposition": "merge",
         "incremental": {"cursor": "order_date", "initial_value": "1996-01-01"}},
        {"name": "order_details", "primary_key": ["order_id", "product_id"], "write_disposition": "merge"},
        {"name": "log"},
    ],
}


def test_config():
    spec = from_config(CONFIG)
    assert [t.write_disposition for t in spec.tables] == ["replace", "merge", "merge", "append"]
    assert spec.tables[1].initial_value == "1996-01-01"  # becomes a value of the column's type when it is compared
    assert spec.tables[2].primary_key == ("order_id", "product_id")
    merged = from_config({**CONFIG, "target": {"write_disposition": "replace"}})
    assert [t.write_disposition for t in merged.tables] == ["replace", "merge", "merge", "replace"]
    assert merged.schema == "raw_demo"
    drops = from_config({"name": "d", "type": "filesystem", "path": "/x", "file_glob": "*.csv"})
    assert drops.tables[0].name == "d" and drops.tables[0].write_disposition == "append"
    assert from_config({"name": "d", "type": "filesystem", "path": "/x", "resource_name": "r"}).tables[0].name == "r"


@pytest.mark.parametrize("change, message", [
    ({"type": "mongo"}, "allowed: postgres, mssql, oracle, mysql, duckdb, sqlite, rest_api, filesystem"),
    ({"target": {"destination": "s3"}}, "unknown destination"),
    ({"target": {"write_disposition": "upsert"}}, "unknown write disposition"),
    ({"tables": [{"name": "t", "write_disposition": "merge"}]}, "needs a primary_key"),
])
def test_config_errors(change, message):
    with pytest.raises(ValueError, match=message):
        from_config({**CONFIG, **change})


def test_config_folder(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(CONFIG))
    (tmp_path / "b.json.disabled").write_text("not read")
    assert [s.name for s in load_configs(str(tmp_path))] == ["demo"]


def test_layer_names():
    assert layer_name("raw") == "raw"
    assert layer_name("", target="public") == "public"
    assert layer_name(" mart ", env_prefix="dev") == "dev_mart"


def test_aliases():
    assert view_name(["sat_customer", "sat_order"]) == "v_access_customer_order"


def test_vault_model():
    hubs, links, sats = model.HUBS, model.LINKS, model.SATS
    vault = VaultModel(hubs, links, sats, model.PITS)
    assert vault.parent("sat_order_detail") == ("link", "lnk_order_product")
    assert [s[1] for s in vault.steps(["hub_customer", "hub_product"])] == ["lnk_order_customer", "lnk_order_product"]
    assert vault.pit_of("hub_order") == "pit_order"
    with pytest.raises(AmbiguousModelError):
        VaultModel({**hubs, **model.PSA_HUBS}, links, sats)
    assert VaultModel({**hubs, **model.PSA_HUBS}, links, {**sats, **model.PSA_SATS}, branch="classic").hub_of_key[
        "customer_hk"] == "hub_customer"
    with pytest.raises(AmbiguousModelError):
        VaultModel(hubs, links, {"sat_x": SatSpec("sat_x", "x_hk", ("a",), "src")})
    alone = VaultModel({**hubs, "hub_x": HubSpec("hub_x", "x_hk", "x_id", "src")}, links, sats)
    with pytest.raises(MissingLinkError, match="no link between hub_customer and hub_x"):
        alone.steps(["hub_customer", "hub_x"])


def _vault(hubs, links):
    specs = {f"hub_{h}": HubSpec(f"hub_{h}", f"{h}_hk", f"{h}_id", "src") for h in hubs}
    return VaultModel(specs, {name: LinkSpec(name, f"{name}_hk", tuple(f"{h}_hk" for h in ends), "src") for name, ends in links.items()}, {})


def test_smallest_tree_against_all_subsets():
    """The tree has as few edges as any connected choice of links, whatever the order of the hubs."""
    rng = random.Random(3)
    for _ in range(60):
        hubs = "abcdef"[: rng.randint(3, 6)]
        links = {f"l{i}": rng.sample(hubs, rng.choice([2, 2, 3])) for i in range(rng.randint(2, 7))}
        vault = _vault(hubs, links)
        wanted = rng.sample([f"hub_{h}" for h in hubs], rng.randint(2, 3))
        edges = [(n, f"hub_{h}") for n, ends in links.items() for h in ends]
        best = None
        for size in range(1, 9):
            for chosen in itertools.combinations(edges, size):
                seen, grown = {wanted[0]}, True
                while grown:
                    grown = False
                    for a, b in chosen:
                        if (a in seen) != (b in seen):
                            seen |= {a, b}
                            grown = True
                if set(wanted) <= seen:
                    best = size
                    break
            if best:
                break
        for order in itertools.permutations(wanted):
            if best is None:
                with pytest.raises(MissingLinkError):
                    vault.smallest_trees(order)
            else:
                trees = vault.smallest_trees(order)
                assert all(len(t) == best for t in trees) and set(trees) == set(vault.smallest_trees(wanted))


def test_two_smallest_trees_are_ambiguous():
    two = {"via_x": "ax", "x_b": "xb", "via_y": "ay", "y_b": "yb"}
    with pytest.raises(AmbiguousModelError, match="via_x, x_b or via_y, y_b"):
        _vault("abxy", two).steps(["hub_a", "hub_b"])
    assert [s[1] for s in _vault("abxy", two).steps(["hub_a", "hub_b", "hub_y"])] == ["via_y", "y_b"]
    # two direct links between the hubs take part both
    assert len(_vault("ab", {"one": "ab", "two": "ab"}).steps(["hub_a", "hub_b"])) == 1


def test_model_selection():
    classic = build.select_models(exclude=["psa"])
    assert "hub_customer_psa" not in classic and "stg_customers_psa" not in classic
    assert classic.index("stg_orders") < classic.index("hub_order") < classic.index("pit_order") < classic.index("mart_order_overview")
    assert build.select_models(tags=["domain_master"]) == [
        "hub_customer", "hub_employee", "hub_product", "sat_customer", "sat_employee", "sat_product"]
    assert build.select_models(names=["mart_product_sales"], upstream=True) == [
        "stg_products", "stg_order_details", "hub_product", "lnk_order_product", "sat_product",
        "sat_order_detail", "mart_product_sales"]
    assert build.select_models(tags=["raw_vault"], all_of=["pit"]) == ["pit_customer", "pit_order"]
    with pytest.raises(ValueError, match="unknown models"):
        build.select_models(names=["nope"])


def test_readable_age(spark):
    values = [None, 0.0, 59.9, 3599.0, 3600.0, 4140.0, 172799.0, 172800.0, 8640000.0 * 20]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    from pyspark.sql import functions as F

    def expected(s):
        if s is None:
            return "n/a"
        h = s / 3600
        return f"{int(s / 60)} Min" if h < 1 else f"{h:.1f} Std" if h < 48 else f"{h / 24:.1f} Tage"

    assert [r[0] for r in df.select(readable_age(F.col("s"))).collect()] == [expected(v) for v in values]


def test_missing_table_is_stale(spark):
    from datetime import timedelta

    from pyspark.sql import functions as F

    from lakevault.operators.quality import freshness_gate

    now = F.lit("2024-01-31").cast("timestamp_ntz")
    empty = spark.createDataFrame([], "t timestamp_ntz")
    for table in (None, empty):
        assert freshness_gate(spark, table, "t", now, timedelta(hours=12)).first()["decision"] == "proceed_stale"
    fresh = spark.createDataFrame([(datetime(2024, 1, 30, 13),)], "t timestamp_ntz")
    assert freshness_gate(spark, fresh, "t", now, timedelta(hours=12)).first()["decision"] == "proceed_fresh"


def test_tests_are_chosen_by_tag(spark):
    from lakevault.operators.quality import select
    from lakevault.plans.queries_quality import all_tests

    tests = all_tests()
    assert len(tests) == 48
    assert len(select(tests, ["business-logic"])) == 5
    assert [t.name for t in select(tests, ["quality"], exclude=["demo-highlight"])].count("pair_a_not_below_b") == 0
    assert {t.severity for t in select(tests, ["freshness", "demo-highlight"])} == {"warn"}
