"""Snapshot restore: all tables or none, whenever it is interrupted."""

import pytest

from ledgerlight.sources import catalog
from ledgerlight.plans.lineage import scratch_path

NAMES = ["first_coll", "second_coll", "third_coll"]


@pytest.fixture
def db(spark, request):
    name = f"restore_{abs(hash(request.node.name)) % 10**9}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    for n in NAMES[:2]:                                    # the third is new to the database
        spark.createDataFrame([(n, "old")], "name string, state string").write.saveAsTable(f"{name}.{n}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def snapshot(spark):
    rows = {n: spark.createDataFrame([(n, "new"), (n, "new too")], "name string, state string") for n in NAMES}
    return catalog.write_snapshot(rows, scratch_path(spark, "snapshot"))


def _states(spark, db):
    return {t.name: sorted(r.state for r in spark.table(f"{db}.{t.name}").collect()) for t in spark.catalog.listTables(db)}


OLD, NEW = {n: ["old"] for n in NAMES[:2]}, {n: ["new", "new too"] for n in NAMES}


def test_restores_every_table_and_leaves_nothing_behind(spark, db, snapshot):
    for _ in range(2):
        assert catalog.restore_snapshot(spark, snapshot, NAMES, db) == {n: f"{db}.{n}" for n in NAMES}
        assert _states(spark, db) == NEW
    assert catalog.recover_restore(spark, db) == []


def test_a_failure_before_the_renames_leaves_all_tables_old(spark, db, snapshot, monkeypatch):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalog.restore_snapshot(spark, snapshot, [*NAMES, "no_such_coll"], db)
    assert _states(spark, db) == OLD

    def fail(*_):
        raise OSError("disk")

    monkeypatch.setattr(catalog, "_write_journal", fail)
    with pytest.raises(OSError):
        catalog.restore_snapshot(spark, snapshot, NAMES, db)
    assert _states(spark, db) == OLD


@pytest.mark.parametrize("renames", range(5))
def test_a_failure_at_any_rename_is_recovered(spark, db, snapshot, monkeypatch, renames):
    done, rename = [], catalog._rename

    def fail_after(*names):
        if len(done) == renames:
            raise OSError("driver lost")
        done.append(names)
        rename(*names)

    with monkeypatch.context() as m:
        m.setattr(catalog, "_rename", fail_after)
        with pytest.raises(OSError):
            catalog.restore_snapshot(spark, snapshot, NAMES, db)
    assert catalog.recover_restore(spark, db) == NAMES
    assert _states(spark, db) == NEW
