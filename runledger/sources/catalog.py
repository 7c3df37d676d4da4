"""Table registration (S10) and table listing.

Every sub-folder of a path becomes a table whose schema is inferred from its
files, like a crawler does.  Folder discovery is a distributed listing; only
the distinct folder names (one per table) reach the driver.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.sources.files import bare_path, below, list_files


def _identifier(name: str) -> str:
    ident = re.sub(r"[^0-9A-Za-z_]+", "_", name).strip("_").lower()
    return ident or "unnamed"


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Table names of a database as a DataFrame (a snapshot)."""
    return (spark.sql(f"SHOW TABLES IN `{database}`")
            .where(~F.col("isTemporary"))
            .select(F.col("tableName").alias("table_name")))


def table_folders(spark: SparkSession, root: str) -> list[str]:
    """Distinct first-level folder names below ``root`` that hold files."""
    rel = below(bare_path(F.col("path")), root)
    folders = (list_files(spark, root)
               .select(F.regexp_extract(rel, r"^([^/]+)/", 1).alias("folder"))
               .where("folder <> ''").distinct().collect())
    return sorted(r.folder for r in folders)


def table_names(folders: list[str]) -> dict[str, str]:
    """A table name for each folder; folders whose names differ only in
    characters that no table name has are told apart by a hash."""
    names: dict[str, list[str]] = {}
    for f in folders:
        names.setdefault(_identifier(f), []).append(f)
    return {f: n if len(fs) == 1 else
            f"{n}_{hashlib.sha256(f.encode()).hexdigest()[:8]}"
            for n, fs in names.items() for f in fs}


def create_database(spark: SparkSession, database: str,
                    location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; with a location on shared storage
    (the session's warehouse folder is used otherwise)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def register_path_tables(spark: SparkSession, database: str, root: str,
                         fmt: str = "csv",
                         options: dict[str, str] | None = None,
                         location: str | None = None) -> DataFrame:
    """Create the database if absent and (re)register one table per
    folder with an inferred schema.  Returns the registered table names.

    An existing table whose files now infer a different schema is replaced
    (the schema is updated in the catalog; data files are untouched) once its
    successor has been created, so a failed change leaves it as it was.
    ``evolving.register_evolving_tables`` adds and widens columns instead.
    """
    options = {"header": "true", "inferSchema": "true", **(options or {})}
    opts = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    create_database(spark, database, location)
    names = []
    for folder, name in table_names(table_folders(spark, root)).items():
        location = f"{root.rstrip('/')}/{folder}"
        qualified = f"`{database}`.`{name}`"
        target = qualified
        if spark.catalog.tableExists(f"{database}.{name}"):
            current = spark.table(qualified).schema
            fresh = spark.read.format(fmt).options(**options).load(location)
            if fresh.schema == current:
                spark.catalog.refreshTable(f"{database}.{name}")
                names.append(name)
                continue
            target = f"`{database}`.`{name}_{uuid.uuid4().hex[:8]}`"
        spark.sql(f"CREATE TABLE {target} USING {fmt} "
                  f"OPTIONS ({opts}) LOCATION '{location}'")
        if target != qualified:
            spark.sql(f"DROP TABLE {qualified}")
            spark.sql(f"ALTER TABLE {target} RENAME TO {qualified}")
        names.append(name)
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def new_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables present after registration but not before (anti join)."""
    return after.join(before, "table_name", "left_anti")
