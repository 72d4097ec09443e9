"""Versioned parquet tables under one root.

A table is a list of parts: a whole table, a month of the fact, a bucket of a dimension. Every write
goes to a new folder, ``<root>/<layer>/<table>/load=v.../``; a published version lists the parts of
every table, and its marks (numbers that go with the tables, such as the highest key handed out), in
``<root>/manifest/version=N``. Readers resolve the latest version once and never see a half-written
load; a change publishes the parts it wrote beside those it left alone. Renamed and dropped columns
are noted with the parts, whose files stay as they were written.

Feeds that were applied are registered under ``<root>/feeds/load_date=...``. An entry counts only if
the version it names was published by the same call. One writer publishes at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.schemas import TABLES
from starhouse.session import COMPRESSION

_MANIFEST = ("kind string, table_name string, name string, value string, columns string, "
             "publication string")
_FEEDS = "digest string, publication string, version int"
# Folder names that say where rows are stored and are no columns of a table.
_STORAGE = ("load", "slice", "bucket")


@dataclass(frozen=True)
class Part:
    """A folder of rows. ``name`` says which rows, ``columns`` what stored columns are called now."""

    path: str
    name: str = ""
    columns: tuple[tuple[str, str | None], ...] = ()  # (stored name, name now or None if dropped)

    def renamed(self, names: Mapping[str, str | None]) -> Part:
        """The part with its columns called by new names; None drops one."""
        known = dict(self.columns)
        now = {new: stored for stored, new in known.items() if new is not None}
        for old, new in names.items():
            known[now.get(old, old)] = new
        return replace(self, columns=tuple(sorted(known.items())))


@dataclass(frozen=True)
class Version:
    """What one version publishes; number 0 is the state before the first."""

    number: int = 0
    tables: dict[str, list[Part]] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)
    publication: str = ""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # Parts ------------------------------------------------------------------------------

    def write(self, df: DataFrame, table: str, by: Sequence[str] = ()) -> list[Part]:
        """Write new parts of the table, one for each value of the columns ``by``."""
        path = f"{self.root}/{TABLES[table].layer}/{table}/load=v{uuid.uuid4().hex}"
        if not by:
            df.write.parquet(path, compression=COMPRESSION)
            return [Part(path)]
        df.write.partitionBy(*by).parquet(path, compression=COMPRESSION)
        # one row per part reaches the driver; no rows make no part
        values = self.spark.read.schema(df.schema).parquet(path).select(*by).distinct().collect()
        names = sorted("/".join(f"{c}={v}" for c, v in zip(by, row, strict=True)) for row in values)
        return [Part(f"{path}/{name}", name) for name in names]

    def read(self, parts: Iterable[Part], schema: T.StructType | None = None) -> DataFrame:
        """The parts as one table; a known schema saves reading a file footer and names the columns."""
        groups: dict[tuple, list[str]] = {}
        for part in parts:
            base = part.path.partition("/load=")[0]
            groups.setdefault((base, part.columns), []).append(part.path)
        frames = [self._read(base, dict(columns), paths, schema)
                  for (base, columns), paths in groups.items()]
        if not frames:
            return self.spark.createDataFrame([], schema or T.StructType())
        found = frames[0]
        for other in frames[1:]:
            found = found.unionByName(other, allowMissingColumns=True)
        return found

    def _read(self, base: str, columns: dict[str, str | None], paths: list[str],
              schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read.option("basePath", base)
        if schema is not None:
            stored = {now: old for old, now in columns.items() if now is not None}
            reader = reader.schema(T.StructType([
                T.StructField(stored.get(f.name, f.name), f.dataType, f.nullable) for f in schema]))
        found = reader.parquet(*paths)
        names = schema.names if schema is not None else None
        kept = [(c, columns.get(c, c)) for c in found.columns if c not in _STORAGE]
        selected = found.select(*[F.col(c).alias(n) for c, n in kept if n is not None])
        return selected.select(*names) if names else selected

    # Versions ---------------------------------------------------------------------------

    def _rows(self, number: int) -> DataFrame | None:
        return self._json(f"{self.root}/manifest/version={number}", _MANIFEST)

    def _json(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).json(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self) -> int:
        """Number of the latest version, 0 if there is none: a search, the folder is never listed."""
        if self._rows(1) is None:
            return 0
        known = 1
        while self._rows(known * 2) is not None:
            known *= 2
        missing = known * 2
        while missing - known > 1:
            middle = (known + missing) // 2
            known, missing = (known, middle) if self._rows(middle) is None else (middle, missing)
        return known

    def version(self, number: int | None = None) -> Version:
        """A version, the latest by default."""
        number = self.latest() if number is None else number
        rows = self._rows(number) if number else None
        if rows is None:
            return Version()
        tables: dict[str, list[Part]] = {}
        marks: dict[str, int] = {}
        publication = ""
        for row in sorted(rows.collect(), key=lambda r: (r["kind"], r["table_name"], r["name"], r["value"])):
            publication = row["publication"]
            if row["kind"] == "mark":
                marks[row["name"]] = int(row["value"])
            elif row["kind"] == "table":
                tables.setdefault(row["table_name"], [])
            elif row["kind"] == "part":
                columns = tuple(tuple(c) for c in json.loads(row["columns"]))
                tables.setdefault(row["table_name"], []).append(Part(row["value"], row["name"], columns))
        return Version(number, tables, marks, publication)

    def publish(self, tables: Mapping[str, Sequence[Part]], marks: Mapping[str, int] | None = None,
                feed: tuple[str, str] | None = None) -> int:
        """Make the parts the next version; tables and marks not named carry over.

        ``feed``, a load date and a digest, is registered as applied by this version.
        """
        before = self.version()
        number, publication = before.number + 1, uuid.uuid4().hex
        if feed:
            day, digest = feed
            entry = self.spark.createDataFrame([(digest, publication, number)], _FEEDS)
            entry.coalesce(1).write.mode("append").json(f"{self.root}/feeds/load_date={day}")
        rows = [("version", "", "", str(number), "", publication)]
        rows += [("table", t, "", "", "", publication) for t in {**before.tables, **tables}]
        rows += [("part", t, p.name, p.path, json.dumps(p.columns), publication)
                 for t, parts in {**before.tables, **tables}.items() for p in parts]
        rows += [("mark", "", name, str(value), "", publication)
                 for name, value in {**before.marks, **(marks or {})}.items()]
        (
            self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
            .write.mode("error").json(f"{self.root}/manifest/version={number}")
        )
        return number

    def adopt(self, version: Version, tables: Sequence[str] | None = None) -> int:
        """Publish the parts and marks of another root's version here; the files stay where they are."""
        names = version.tables if tables is None else tables
        return self.publish({n: version.tables[n] for n in names}, version.marks)

    def rename_columns(self, table: str, names: Mapping[str, str | None]) -> int:
        """Publish the table under other column names; None drops a column. No file is written anew."""
        parts = self.version().tables[table]
        return self.publish({table: [p.renamed(names) for p in parts]})

    def applied(self, day: str, digest: str) -> bool:
        """Whether a published version applied this feed; reads the entries of one load date."""
        entries = self._json(f"{self.root}/feeds/load_date={day}", _FEEDS)
        if entries is None:
            return False
        found = entries.filter(F.col("digest") == digest).collect()  # one row per time it was tried
        for entry in found:
            rows = self._rows(entry["version"])
            if rows is not None and not rows.filter(F.col("publication") == entry["publication"]).isEmpty():
                return True
        return False
