"""Versioned tables: what is new is written beside what is there, and one rename makes it current.

A folder holds data under `data/` and manifests `manifests/00000001.json`, 2, ...; the last
one names the files that are current. Readers follow it, so they see the whole of a build
or none of it, and a write that fails, at any point, leaves the current tables as they
were. Two writers cannot both make the same manifest: the second fails and may try
again. The store must refuse a rename onto a file that exists, as HDFS and file systems do.
"""

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .writers import compact_json


class Store:
    """The tables of one folder (any path that Spark can write)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    @property
    def files(self):
        return self.path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    # manifests

    def manifests(self) -> list[int]:
        folder = self.path("manifests")
        if not self.files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def manifest(self, number: int | None = None) -> dict:
        """{"number": n, "tables": {name: {"parts": [...], "rows": n, "status": text}}} of a build; empty tables before the first."""
        numbers = self.manifests()
        if number is None and not numbers:
            return {"number": 0, "tables": {}}
        lines = self.spark.read.text(self.path("manifests", f"{number or numbers[-1]:08d}.json").toString(), wholetext=True)
        return json.loads(lines.first()["value"])

    def switch(self, after: dict, tables: dict[str, dict]) -> dict:
        """Makes the tables current, in place of the manifest `after`; FileExistsError if another build has come first."""
        made = {"number": after["number"] + 1, "tables": tables}
        begun = self.path("manifests", f".{uuid.uuid4().hex}")
        out = self.files.create(begun, False)
        out.write(bytearray(json.dumps(made, ensure_ascii=False).encode()))
        out.close()
        if self.manifests()[-1:] not in ([], [after["number"]]) or not self.files.rename(begun, self.path("manifests", f"{made['number']:08d}.json")):
            self.files.delete(begun, False)
            raise FileExistsError(f"manifest {made['number']} is there already")
        return made

    # tables

    def write(self, df: DataFrame) -> dict:
        """Writes the rows as a new part, which no manifest names yet."""
        part = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{part}")
        return {"parts": [part], "rows": self.spark.read.schema(df.schema).parquet(f"{self.root}/{part}").count(), "status": "ok"}

    def entry(self, entry: dict) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{p}" for p in entry["parts"]])

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """The table of the current build, or of an earlier one that is still kept; KeyError if there is none."""
        return self.entry(self.manifest(number)["tables"][name])

    def publish(self, products: dict[str, Callable[[], DataFrame]], least: dict[str, int] | None = None, meta: str | None = None) -> dict[str, str]:
        """Writes every product, then switches once; ok or what went wrong by name.

        A product that fails or has fewer than least[name] rows keeps its last version in
        the new build (status CACHE); one that never was there is left out (ERRO).
        meta: the name of a table of the build's parts, rows and states, which becomes
        current with them.
        """
        before = self.manifest()
        tables = {}
        for name, make in products.items():
            try:
                made = self.write(make())
                if made["rows"] < (least or {}).get(name, 0):
                    raise ValueError(f"{made['rows']} rows are too few")
                tables[name] = made
            except Exception as e:
                old = before["tables"].get(name)
                tables[name] = (old or {"parts": [], "rows": 0}) | {"status": f"{'CACHE' if old else 'ERRO'} ({str(e)[:120]})"}
        status = {name: t["status"] for name, t in tables.items()}
        if meta is not None:
            tables[meta] = self.write(self.spark.createDataFrame([(n, t["rows"], t["status"]) for n, t in sorted(tables.items())], "part string, rows long, status string"))
        self.switch(before, before["tables"] | {n: t for n, t in tables.items() if t["parts"]})
        return status

    def append(self, name: str, rows: DataFrame, keys: list[str]) -> int:
        """Adds to a table the rows whose keys it does not hold yet, as one more part; returns how many. Nothing written before is touched."""
        before = self.manifest()
        old = before["tables"].get(name)
        new = rows if old is None else rows.join(self.entry(old).select(*keys).distinct(), keys, "left_anti").select(*rows.columns)
        made = self.write(new)
        if made["rows"] or old is None:
            tables = before["tables"] | {name: {"parts": [*(old or {"parts": []})["parts"], *made["parts"]], "rows": made["rows"] + (old or {"rows": 0})["rows"], "status": "ok"}}
            self.switch(before, tables)
        return made["rows"]

    def prune(self, keep: int = 2) -> int:
        """Deletes the manifests before the last `keep` and the parts that no manifest left names; returns how many parts went.

        For times without a writer: a part that is being written is not named yet.
        """
        numbers = self.manifests()
        for n in numbers[:-keep]:
            self.files.delete(self.path("manifests", f"{n:08d}.json"), False)
        named = {p for n in numbers[-keep:] for t in self.manifest(n)["tables"].values() for p in t["parts"]}
        gone = [s.getPath() for s in self.files.listStatus(self.path("data")) if f"data/{s.getPath().getName()}" not in named]
        return sum(bool(self.files.delete(p, True)) for p in gone)


def snapshot(spark: SparkSession, read: Callable[[], DataFrame], path: str, least: int = 1) -> tuple[DataFrame | None, str]:
    """read() stored under path, or what path holds where reading fails, at any row, or gives too few rows; with the status ok, CACHE or ERRO."""
    store = Store(spark, path)
    status = store.publish({"rows": read}, {"rows": least})["rows"]
    return (None if status.startswith("ERRO") else store.read("rows")), status


def exported(store: Store, names: list[str]) -> str:
    """The current tables as JSON lines without null fields, in a folder of the build's number, which is returned."""
    build = store.manifest()
    folder = f"{store.root}/json/{build['number']:08d}"
    for name in names:
        compact_json(store.entry(build["tables"][name]), f"{folder}/{name}")
    return folder
