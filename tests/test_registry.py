"""Entities: columns that never leave, drift, overrides."""

import pytest

from tidemark.sources import registry as reg
from tidemark.sources.tables import Tables, scan, without_forbidden

LIVE = {"user": ["id", "Email", "password", "timemodified"], "sessions": ["id", "sid", "value"], "config": ["id", "value"], "message": ["id", "fullmessage", "timecreated"], "local_x": ["id", "code", "secret"]}


def live(name):
    return LIVE.get(name)


def test_registry_is_whole():
    made = reg.built_in()
    assert len(made) == len(reg.ENTITY_NAMES) == len(set(reg.ENTITY_NAMES))
    assert [n for n, e in made.items() if e.derived] == ["userlogins"]
    assert {n for n, e in made.items() if e.watermark} == set(reg.OWN_WATERMARKS)
    assert len(reg.FORBIDDEN_COLUMNS) == 20


def test_forbidden_columns_never_pass(spark):
    frames = {n: spark.createDataFrame([tuple(range(len(c)))], ", ".join(f"{x} long" for x in c)) for n, c in LIVE.items()}
    tables = Tables(spark, frames=frames)
    never = set(reg.FORBIDDEN_COLUMNS)
    overrides = [reg.Override("user", custom_columns="id, Password, email"), reg.Override("extra", custom_table="local_x"), reg.Override("sessions", discovered=True)]
    base = {n: reg.Entity(n, n) for n in ("user", "sessions", "config", "message")}
    for name, e in reg.effective(base, overrides, tables.live).items():
        got = scan(tables, e).columns
        assert not never & {c.lower() for c in got}
        assert ("sid" in got) == False and (name != "message" or "fullmessage" not in got)  # noqa: E712
    assert scan(tables, reg.Entity("config", "config")).columns == ["id", "value"]
    assert "fullmessage" in scan(tables, reg.Entity("message", "message"), bodies=True).columns
    assert scan(tables, reg.Entity("none", "none")) is None
    assert scan(tables, reg.Entity("user", "user", ("email",))) is None  # no id


def test_resolution():
    found = reg.resolved(reg.Entity("user", "user", ("ID", "email", "gone", "TIMEMODIFIED")), live)
    assert found == reg.Resolved(("id", "Email", "timemodified"), ("gone",), "timemodified")
    assert reg.resolved(reg.Entity("user", "user", ("email",)), live) is None
    unknown = reg.resolved(reg.Entity("u", "nowhere", ("id", "added"), "added"), live)
    assert unknown == reg.Resolved(("id", "added"), (), "added")
    assert reg.watermark_of(["timecreated", "TimeUpdated"]) == "timeupdated"
    assert reg.watermark_of(["timecreated"], "gone") == "timecreated"


def test_stripping_lists_a_row_out_only_if_it_must():
    out = reg.stripped({"a": reg.Entity("a", "config"), "b": reg.Entity("b", "user"), "c": reg.Entity("c", "user", ("password",))}, live)
    assert out["a"].columns is None and out["b"].columns == ("id", "Email", "timemodified") and out["c"].columns == ("id",)


def test_overrides():
    base = {n: reg.Entity(n, n, ("id",)) for n in ("user", "config", "local_x")}
    out = reg.merged(base, [reg.Override("user", enabled=False), reg.Override("config", custom_columns="nothing real"), reg.Override("local_x", discovered=True), reg.Override("new", custom_table=" user ", custom_columns="id\nemail"), reg.Override("no", custom_table="drop table")], live)
    assert set(out) == {"config", "local_x", "new"}
    assert out["config"].columns == ("id",) and out["local_x"].columns is None and out["new"] == reg.Entity("new", "user", ("id", "Email"))


def test_discovery():
    assert reg.discovered(["local_b", "local_a", "mod_a", "local_a"], ["local_", "mod_"]) == ["local_a", "local_b"]
    assert reg.discovered(["local_b"], ["mod_"]) == []


@pytest.mark.parametrize(("first", "last"), [(0, 5), (5, 5), (6, 5), (-1, 3)])
def test_windows_are_checked(first, last):
    from tidemark.operators import capture

    with pytest.raises(ValueError):
        capture.requested(["user"], {"user"}, first, last)


def test_codes_and_further_columns_never_leave(spark):
    df = spark.createDataFrame([(1, "C", "n", "t")], "id long, code string, name string, tax string")
    tables = Tables(spark, frames={"local_shop_coupons": df, "other": df}, by_table={"other": ("tax",)})
    overrides = [reg.Override("coupons", discovered=True, custom_table="local_shop_coupons"), reg.Override("asked", custom_table="local_shop_coupons", custom_columns="id,code,name"), reg.Override("more", custom_table="other")]
    made = reg.effective({}, overrides, tables.live, by_table=tables.by_table)
    assert {n: tables_of(tables, e) for n, e in made.items()} == {"coupons": ["id", "name", "tax"], "asked": ["id", "name"], "more": ["id", "code", "name"]}
    raw = reg.merged({}, overrides, tables.live)  # a scan holds them back by itself
    assert "code" not in tables_of(tables, raw["coupons"]) and "tax" not in tables_of(tables, raw["more"])
    assert without_forbidden(df, raw["coupons"]).columns == ["id", "name", "tax"]


def tables_of(tables, entity):
    return scan(tables, entity).columns
