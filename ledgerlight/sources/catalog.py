"""Catalog and table sinks.

Written results are catalog tables in the session's warehouse; a written
table is also how a multi-step job cuts lineage and shares a result between
steps (S12).  Cleanup works on catalog metadata only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.plans.lineage import scratch_path

WORK_DB_CONF = "ledgerlight.work.database"


def work_database(spark: SparkSession) -> str:
    """The database for written results, created on first use.

    A new database gets its own fresh location under the shared folder, so
    folders left by an earlier session (whose catalog is gone) can never
    collide with a managed table of this one; a database a persistent
    catalog already knows keeps its location.
    """
    db = spark.conf.get(WORK_DB_CONF, None) or "ledgerlight_work"
    if not spark.catalog.databaseExists(db):
        location = scratch_path(spark, f"warehouse-{db}")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    return db


def fresh_table(spark: SparkSession, name: str) -> str:
    """A name in the work database that no earlier call has used: frames already returned keep their table."""
    return f"{work_database(spark)}.{name}_{uuid.uuid4().hex[:12]}"


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as table ``name`` (S8, S10); ``mode='errorifexists'`` is the default of S9."""
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def materialize_step(df: DataFrame, prefix: str, name: str, database: str | None = None) -> DataFrame:
    """Store a step's result under ``prefix + name``, replacing it, and continue from it."""
    spark = df.sparkSession
    db = database or work_database(spark)
    return save_table(df, f"{db}.{prefix}{name}", "overwrite")


def create_table_if_not_exists(spark: SparkSession, name: str, columns_ddl: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with typed, NOT NULL-capable columns."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING parquet")


def insert_overwrite(df: DataFrame, name: str) -> DataFrame:
    df.write.insertInto(name, overwrite=True)
    return df.sparkSession.table(name)


def like_escape(prefix: str) -> str:
    return prefix.replace("\\", "\\\\").replace("_", "\\_").replace("%", "\\%")


def drop_tables_with_prefix(spark: SparkSession, database: str, prefix: str) -> list[str]:
    """Drop the tables whose name starts with ``prefix`` taken literally."""
    names = spark.createDataFrame([(t.name,) for t in spark.catalog.listTables(database)],
                                  "name string")
    doomed = [r[0] for r in names.where(F.col("name").like(like_escape(prefix.lower()) + "%")).collect()]
    for n in doomed:
        spark.sql(f"DROP TABLE IF EXISTS {database}.`{n}`")
    return doomed


def write_snapshot(collections: dict[str, DataFrame], snapshot_dir: str) -> str:
    """A snapshot is one Parquet folder per named collection."""
    for name, df in collections.items():
        df.write.mode("overwrite").parquet(f"{snapshot_dir}/{name}")
    return snapshot_dir


def restore_snapshot(spark: SparkSession, snapshot_dir: str, names: list[str],
                     database: str | None = None) -> dict[str, str]:
    """Replace the named collection tables by their snapshot copies, all or none of them.

    Every copy is first written whole beside its target; a failure up to here
    leaves all tables as they were.  Then the renames are noted in a journal and
    done.  A failure between them is made good by ``recover_restore``, which the
    next restore calls first, and which ends with all tables restored.  One
    restore of a database runs at a time.
    """
    db = database or work_database(spark)
    recover_restore(spark, db)
    run = uuid.uuid4().hex[:12]
    staged = {name: f"{name}__staged_{run}" for name in names}
    try:
        for name, copy in staged.items():
            spark.read.parquet(f"{snapshot_dir}/{name}").write.mode("overwrite").saveAsTable(f"{db}.{copy}")
        _write_journal(spark, db, {name: [copy, f"{name}__old_{run}"] for name, copy in staged.items()})
    except BaseException:
        for copy in staged.values():
            spark.sql(f"DROP TABLE IF EXISTS {db}.{copy}")
        raise
    recover_restore(spark, db)
    return {name: f"{db}.{name}" for name in names}


def recover_restore(spark: SparkSession, database: str) -> list[str]:
    """Finish the renames of a restore that was interrupted; the names of its tables (none without a journal)."""
    journal = _read_journal(spark, database)
    for name, (copy, old) in journal.items():
        if spark.catalog.tableExists(f"{database}.{copy}"):
            if spark.catalog.tableExists(f"{database}.{name}"):
                _rename(spark, database, name, old)
            _rename(spark, database, copy, name)
    for _, old in journal.values():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    files, path, _ = _journal(spark, database)
    files.delete(path, False)
    return list(journal)


def _rename(spark: SparkSession, database: str, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {database}.{name} RENAME TO {database}.{to}")


def _journal(spark: SparkSession, database: str):
    """(file system, journal, its unfinished form) in the database's folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = spark.catalog.getDatabase(database).locationUri
    at = path(f"{folder}/restore_journal.json")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at, path(f"{folder}/restore_journal.tmp")


def _write_journal(spark: SparkSession, database: str, renames: dict[str, list[str]]) -> None:
    files, at, unfinished = _journal(spark, database)
    out = files.create(unfinished, True)
    out.write(bytearray(json.dumps(renames).encode()))
    out.close()
    if not files.rename(unfinished, at):
        raise OSError(f"could not write {at.toString()}")


def _read_journal(spark: SparkSession, database: str) -> dict[str, list[str]]:
    files, at, _ = _journal(spark, database)
    if not files.exists(at):
        return {}
    return json.loads("".join(r.value for r in spark.read.text(at.toString(), wholetext=True).collect()))
