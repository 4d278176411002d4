"""One commit for all that a load writes.

Each load writes its rows to folders of its own
(``<base>/<table>/load=<id>/...``), which no other load touches. A snapshot
lists, by table, the folders that make up the data, with their partition values
and row counts; readers take only what the newest snapshot lists. So a load
becomes visible as a whole, when its snapshot is created, or not at all: what a
failed load has left is never listed, and running it again adds nothing twice.

Snapshots are numbered files in ``<base>/_snapshots``, created only where no
file of that number is (:func:`~roadflow.sources.files.create_once`): of two
loads that start from the same snapshot one commits, the other gets
:class:`Conflict` and runs again from the new one.

The list has an entry per table, load and partition (calendar years), not per
file, so it stays small whatever the data.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import STORED
from ..sources.files import create_once, delete_folder, folder_names, read_text


#: The folder name of a null partition value.
NULL = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another load has committed meanwhile; run this one again."""


@dataclass(frozen=True)
class Part:
    folder: str  # below the base folder, or a whole path
    rows: int
    values: dict = field(default_factory=dict)  # of the partition columns


@dataclass
class Snapshot:
    version: int = 0
    parts: dict[str, list[Part]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def rows(self, table: str, **values) -> int:
        return sum(p.rows for p in self.of(table, **values))

    def of(self, table: str, **values) -> list[Part]:
        """The parts of a table with these partition values."""
        return [p for p in self.parts.get(table, []) if all(p.values.get(k) == v for k, v in values.items())]


class Snapshots:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    # -- commits ------------------------------------------------------------

    def versions(self) -> list[int]:
        names = folder_names(self.spark, f"{self.base}/_snapshots") or []
        return sorted(int(n[:8]) for n in names if re.fullmatch(r"\d{8}\.json", n))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version, the newest by default; an empty one before the first commit."""
        known = self.versions()
        if version is None and not known:
            return Snapshot()
        version = known[-1] if version is None else version
        held = json.loads(read_text(self.spark, f"{self.base}/_snapshots/{version:08d}.json"))
        return Snapshot(version, {t: [Part(**p) for p in parts] for t, parts in held["parts"].items()}, held["notes"])

    def commit(self, parent: Snapshot, parts: dict[str, list[Part]], notes: dict | None = None) -> Snapshot:
        """The snapshot after ``parent``: its tables, with those in ``parts`` replaced by what is listed there."""
        new = Snapshot(parent.version + 1, {**parent.parts, **parts}, {**parent.notes, **(notes or {})})
        text = json.dumps({"parts": {t: [asdict(p) for p in ps] for t, ps in new.parts.items()}, "notes": new.notes})
        if not create_once(self.spark, f"{self.base}/_snapshots/{new.version:08d}.json", text):
            raise Conflict(f"version {new.version} of {self.base} is there already")
        return new

    def expire(self, keep: int = 5) -> list[str]:
        """Deletes the folders that only snapshots before the newest ``keep`` list, and returns them.

        Folders that no snapshot lists may belong to a load that runs, and stay."""
        known = self.versions()
        kept = {p.folder for v in known[-keep:] for ps in self.snapshot(v).parts.values() for p in ps}
        old = {p.folder for v in known[:-keep] for ps in self.snapshot(v).parts.values() for p in ps}
        gone = sorted(f for f in old - kept if self.path(f).startswith(f"{self.base}/"))
        for folder in gone:
            delete_folder(self.spark, self.path(folder))
        return gone

    # -- data ---------------------------------------------------------------

    def path(self, folder: str) -> str:
        return folder if "://" in folder or folder.startswith(("/", "file:")) else f"{self.base}/{folder}"

    def write(self, table: str, df: DataFrame, by: tuple[str, ...] = (), load: str | None = None) -> list[Part]:
        """Writes a load of a table, in folders by the columns ``by``; the parts to commit.

        ``load`` names the load where a repeat must replace its own folder."""
        folder = f"{table}/load={load or uuid.uuid4().hex}"
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**STORED)
        (writer.partitionBy(*by) if by else writer).parquet(self.path(folder))
        written = self.spark.read.schema(df.schema).parquet(self.path(folder))
        if not by:
            return [Part(folder, written.count())]
        # Row counts stand in the files' footers; no column is read.
        rows = written.groupBy(*by).count().collect()
        return [Part("/".join([folder, *(f"{c}={NULL if r[c] is None else r[c]}" for c in by)]), r["count"],
                     {c: r[c] for c in by})
                for r in sorted(rows, key=lambda r: str(tuple(r)))]

    def write_slices(self, table: str, by: str, slices: dict, parallel: int = 4) -> list[Part]:
        """Writes a load of a table whose rows are given by value of the column ``by``, without a shuffle or a sort;
        the parts to commit."""
        from concurrent.futures import ThreadPoolExecutor

        folder = f"{table}/load={uuid.uuid4().hex}"

        def store(item) -> Part:
            value, df = item
            place = f"{folder}/{by}={value}"
            rows = df.drop(by)
            rows.write.mode("overwrite").options(**STORED).parquet(self.path(place))
            return Part(place, self.spark.read.schema(rows.schema).parquet(self.path(place)).count(), {by: value})

        with ThreadPoolExecutor(max_workers=parallel) as pool:
            return list(pool.map(store, slices.items()))

    def read(self, table: str, parts: list[Part], schema: T.StructType) -> DataFrame:
        """The rows of these parts of a table; ``schema`` names the columns, partition columns too."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        with_load = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        frames: dict[str, list[str]] = {}
        for p in parts:  # a table's parts may stand below another base: dimensions that are shared
            path = self.path(p.folder)
            frames.setdefault(path[:path.rindex(f"/{table}/")] + f"/{table}", []).append(path)
        reads = [self.spark.read.schema(with_load).option("basePath", base).parquet(*paths)
                 for base, paths in frames.items()]
        out = reads[0]
        for more in reads[1:]:
            out = out.unionByName(more)
        return out.select(*[F.col(f"`{c}`") for c in schema.names])
