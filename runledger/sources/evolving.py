"""Registration of CSV folders whose files differ in schema.

A folder's files may have been delivered over time: later ones with more
columns, or with values that no longer fit the first type.  Each table is

- a *base* table over the folder, in the database ``<database>_base``: every
  column is text, partition columns come from ``key=value`` folder names.  It
  only ever changes by ``ALTER TABLE ... ADD COLUMNS``;
- a *view* of the same name in ``<database>``, which casts each column to its
  type.  ``CREATE OR REPLACE VIEW`` switches it in one step, so readers always
  find a table, and a failed change leaves the former one.

Types form a lattice: int < bigint < double < string, date < timestamp <
string, boolean < string.  A column's type is the smallest that holds every
value of every file, joined with the type that the catalog has, so a table
never loses a column nor a value by narrowing.  They are found by one scan of
all folders, as conditions combined by file and column before the shuffle.

Files are read by position, so the header of every file has to be a beginning
of the longest one (compared by the session's case rule) and all files need
the same partition keys.  Folders for which this doesn't hold are refused with
a reason and keep their former table; ``convert_files`` reads such files by
name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.sources.catalog import (
    create_database, table_folders, table_names)
from runledger.sources.csv_parquet import header_columns
from runledger.sources.files import bare_path, below

# Each chain from the narrowest type on; above all of them is string.
CHAINS = (("int", "bigint", "double"), ("date", "timestamp"), ("boolean",))
NO_VALUES = "no values so far"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"     # fixed value of Spark's layout
RESULT = ("table_name string, status string, reason string, "
          "columns array<struct<name: string, type: string>>")


def widest(a: str | None, b: str | None) -> str | None:
    """Smallest type that holds both; null (no values) holds nothing."""
    if a is None or b is None or a == b:
        return b if a is None else a
    for chain in CHAINS:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    return "string"


def _fits(value: Column) -> dict[str, Column]:
    """Whether a text is a value of each type."""
    v = F.trim(value)
    day = r"\d{4}-\d{2}-\d{2}"
    whole, real = r"^[+-]?\d+$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    time = rf"^{day}([ T]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?" \
        r"(Z|[+-]\d{2}:\d{2})?)?$"

    def cast(pattern: str, to: str) -> Column:
        # Null for no value, which the aggregates pass over.
        return F.when(v.isNotNull(),
                      v.rlike(pattern) & v.try_cast(to).isNotNull())
    return {"int": cast(whole, "int"), "bigint": cast(whole, "bigint"),
            "double": cast(real, "double"), "date": cast(f"^{day}$", "date"),
            "timestamp": cast(time, "timestamp"),
            "boolean": F.lower(v).isin("true", "false")}


def _facts(values: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and, for column ``value``, the number of values and whether
    all of them fit each type."""
    return values.groupBy(*keys).agg(
        F.count("value").alias("n"),
        *[F.coalesce(F.bool_and(fit), F.lit(True)).alias(t)
          for t, fit in _fits(F.col("value")).items()])


def _narrowest(row) -> str | None:
    if not row.n:
        return None
    return next((t for chain in CHAINS for t in chain if row[t]), "string")


def _file(root: str) -> Column:
    return below(bare_path(F.col("_metadata.file_path"), encoded=True), root)


def _folder(file: Column) -> Column:
    return F.regexp_extract(file, r"^([^/]+)/", 1)


def file_headers(spark: SparkSession, root: str, folders: list[str]
                 ) -> DataFrame:
    """(file, folder, keys, header): first line of every file and the keys
    of its ``key=value`` folders, outermost first."""
    lines = (spark.read.option("recursiveFileLookup", "true")
             .option("lineSep", "\n").text(_paths(root, folders)))
    first = lines.select(
        _file(root).alias("file"), F.rtrim("value", F.lit("\r")).alias("v"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("no")).where("at = 0")
    return (first.groupBy("file").agg(F.min_by("v", "no").alias("header"))
            .select("file", _folder(F.col("file")).alias("folder"),
                    F.transform(_levels(), lambda s: F.substring_index(
                        s, "=", 1)).alias("keys"), "header"))


def _levels() -> Column:
    """``key=value`` folders of column ``file``, outermost first."""
    parts = F.split("file", "/")
    inner = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    return F.filter(inner, lambda s: s.contains("="))


def _paths(root: str, folders: list[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{f}" for f in folders]


def value_facts(spark: SparkSession, root: str, folders: list[str],
                width: int) -> DataFrame:
    """(file, position, facts) of the values of all files, one scan."""
    names = [f"v{i}" for i in range(width)]
    rows = (spark.read.schema(", ".join(f"{n} string" for n in names))
            .option("header", "true").option("recursiveFileLookup", "true")
            .csv(_paths(root, folders)))
    values = rows.select(_file(root).alias("file"),
                         F.posexplode(F.array(*names))
                         .alias("position", "value"))
    return _facts(values, ["file", "position"])


def partition_facts(headers: DataFrame) -> DataFrame:
    """(folder, position, facts) of the values in folder names."""
    level = F.explode(F.transform(_levels(), lambda s, i: F.struct(
        i.alias("position"), F.try_url_decode(F.replace(
            F.regexp_replace(s, r"^[^=]*=", ""), F.lit("+"), F.lit("%2B")))
        .alias("value"))))
    values = headers.select("folder", level.alias("x")).select(
        "folder", "x.position",
        F.nullif(F.col("x.value"), F.lit(NULL_FOLDER)).alias("value"))
    return _facts(values, ["folder", "position"])


def longest_header(headers: Iterable[list[str]], case_sensitive: bool
                   ) -> list[str] | None:
    """The header of which all are beginnings; null where there is none."""
    headers = list(headers)
    longest = max(headers, key=len)

    def same(a: str, b: str) -> bool:
        return a == b if case_sensitive else a.lower() == b.lower()
    fits = all(same(a, b) for h in headers for a, b in zip(h, longest))
    return longest if fits else None


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Registrar:
    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark, self.database, self.root = spark, database, root
        self.base_db = f"{database}_base"
        self.case = spark.conf.get("spark.sql.caseSensitive") == "true"

    def _exists(self, database: str, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{database}.{name}")

    def known_types(self, name: str) -> dict[str, str | None]:
        """Types that the catalog has; null for columns without values."""
        if not self._exists(self.database, name):
            return {}
        schema = self.spark.table(f"`{self.database}`.`{name}`").schema
        return {f.name: None if f.metadata.get("comment") == NO_VALUES
                else f.dataType.simpleString() for f in schema.fields}

    def base(self, name: str, folder: str, columns: list[str],
             keys: list[str]) -> tuple[list[str], bool]:
        """Create the base table or add the columns it lacks: its data
        columns and whether it changed.  ValueError: it can't be done."""
        qualified = f"`{self.base_db}`.`{name}`"
        if not self._exists(self.base_db, name):
            cols = ", ".join(f"{_quoted(c)} STRING" for c in columns + keys)
            parts = ", ".join(map(_quoted, keys))
            place = _text(f"{self.root.rstrip('/')}/{folder}")
            self.spark.sql(
                f"CREATE TABLE {qualified} ({cols}) USING csv "
                "OPTIONS ('header' 'true') "
                + (f"PARTITIONED BY ({parts}) " if keys else "")
                + f"LOCATION {place}")
            return columns, True
        old = self.spark.table(qualified).columns
        old_keys = [c.name for c in self.spark.catalog.listColumns(
            f"{self.base_db}.{name}") if c.isPartition]
        data = old[:len(old) - len(old_keys)]
        if longest_header([old_keys, keys], self.case) is None or \
                len(old_keys) != len(keys):
            raise ValueError(f"partition folders are {keys}, the table has "
                             f"{old_keys}")
        if longest_header([data, columns], self.case) is None:
            raise ValueError(f"columns are {columns}, the table has {data}")
        new = columns[len(data):]
        if new:
            cols = ", ".join(f"{_quoted(c)} STRING" for c in new)
            self.spark.sql(f"ALTER TABLE {qualified} ADD COLUMNS ({cols})")
        return data + new, bool(new)

    def view(self, name: str, types: dict[str, str | None]) -> None:
        heads = ", ".join(
            _quoted(c) + ("" if t else f" COMMENT '{NO_VALUES}'")
            for c, t in types.items())
        casts = ", ".join(
            f"try_cast({_quoted(c)} AS {t})"
            if t not in (None, "string") else _quoted(c)
            for c, t in types.items())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{self.database}`.`{name}` ({heads}) "
            f"AS SELECT {casts} FROM `{self.base_db}`.`{name}`")

    def register(self, name: str, folder: str, columns: list[str],
                 keys: list[str], fresh: list[str | None]
                 ) -> tuple[str, dict[str, str | None]]:
        known = self.known_types(name)
        data, changed = self.base(name, folder, columns, keys)
        if keys:
            self.spark.sql("ALTER TABLE "
                           f"`{self.base_db}`.`{name}` RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(f"{self.base_db}.{name}")
        found = dict(zip(columns, fresh)) | dict(
            zip(keys, fresh[len(columns):]))
        by_name = found if self.case else {
            c.lower(): t for c, t in found.items()}
        types = {c: widest(known.get(c), by_name.get(
            c if self.case else c.lower())) for c in data + keys}
        if known == types and not changed:
            return "unchanged", types
        self.view(name, types)
        return ("altered" if known else "created"), types


def _layouts(headers: DataFrame) -> dict[str, list]:
    """Different (header, keys) of each folder: metadata, a row for each
    layout of files, however many files have it."""
    out: dict[str, list] = {}
    for r in headers.select("folder", "header", "keys").distinct().collect():
        out.setdefault(r.folder, []).append(r)
    return out


def register_evolving_tables(spark: SparkSession, database: str, root: str,
                             location: str | None = None,
                             base_location: str | None = None) -> DataFrame:
    """Create the databases if absent; register every first-level folder
    of ``root`` that holds CSV files, or bring its table up to date.

    Returns a row for each folder: table_name, status (created, altered,
    unchanged, refused), reason (of a refusal) and the columns with their
    types (none where refused).  Files without a line are passed over; a
    folder without files has no row; a column without values is a string
    until it has some.  Values with line feeds aren't read as one value, as
    files are split by line.
    """
    create_database(spark, database, location)
    create_database(spark, f"{database}_base", base_location)
    folders = table_folders(spark, root)
    if not folders:
        return spark.createDataFrame([], RESULT)
    reg = _Registrar(spark, database, root)
    headers = file_headers(spark, root, folders)
    plans, rows = {}, []
    names = table_names(folders)
    for folder, layouts in _layouts(headers).items():
        parsed = [header_columns(r.header, reg.case) for r in layouts]
        bad = next((why for _, why in parsed if why), None)
        keys = layouts[0]["keys"]
        columns = longest_header([c for c, _ in parsed], reg.case)
        if bad is None and any(r["keys"] != keys for r in layouts):
            bad = "files differ in their partition folders"
        if bad is None and columns is None:
            bad = "headers of the files differ in more than added columns"
        if bad is None:
            bad = header_clash(columns, keys, reg.case)
        if bad:
            rows.append((names[folder], "refused", bad, []))
        else:
            plans[folder] = (columns, keys)
    if plans:
        width = max(len(c) for c, _ in plans.values())
        facts = value_facts(spark, root, sorted(plans), width)
        by_column = (facts.withColumn("folder", _folder(F.col("file")))
                     .groupBy("folder", "position").agg(
            F.sum("n").alias("n"), *[F.bool_and(t).alias(t)
                                     for chain in CHAINS for t in chain]))
        types = {(r.folder, r.position): _narrowest(r)
                 for r in by_column.collect()}
        in_names = {(r.folder, r.position): _narrowest(r) for r in
                    partition_facts(headers).collect()}
        for folder, (columns, keys) in plans.items():
            fresh = [types.get((folder, i)) for i in range(len(columns))]
            fresh += [in_names.get((folder, i)) for i in range(len(keys))]
            try:
                status, got = reg.register(names[folder], folder, columns,
                                           keys, fresh)
                rows.append((names[folder], status, None,
                             [(c, t or "string") for c, t in got.items()]))
            except ValueError as exc:
                rows.append((names[folder], "refused", str(exc), []))
    return spark.createDataFrame(sorted(rows, key=lambda r: r[0]), RESULT)


def header_clash(columns: list[str], keys: list[str], case_sensitive: bool
                 ) -> str | None:
    """Why data and partition columns can't stand in one table."""
    taken = {c if case_sensitive else c.lower() for c in columns}
    for k in keys:
        key = k if case_sensitive else k.lower()
        if key in taken:
            return f"column {k} is repeated"
        taken.add(key)
    return None
