"""Tables of a project that change together: one small file names the version of every table.

A commit writes the new versions beside the old ones, then publishes one file, ``_generations/<number>.json``, that names the
version of each table. Readers see the tables of the newest file and nothing else, so a job that dies between two tables
leaves the old generation, whole; what it had written is never named. Two writers can't publish the same number: the
second one fails and must commit anew. Old generations stay readable until :meth:`Generations.vacuum`.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


class ConcurrentCommit(RuntimeError):
    """Another writer has published this generation."""


class Table:
    """One table of a project."""

    def __init__(self, generations: Generations, name: str):
        self.generations, self.name = generations, name

    def versions(self) -> list[int]:
        """Versions that some generation names."""
        found = (g["tables"].get(self.name) for g in self.generations.all())
        return sorted({t["version"] for t in found if t})

    def read(self, version: int | None = None) -> DataFrame:
        return self.generations.read(self.name, version)

    def commit(self, rows: DataFrame) -> int:
        """A generation in which only this table is new; its version."""
        return self.generations.commit({self.name: rows})["tables"][self.name]["version"]


class Generations:
    """Generations of tables under a folder on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder = f"{self.root}/_generations"
        self._fs = self._hadoop.Path(self.root).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        """Published generations."""
        return sorted(int(n[:-5]) for n in self._names(self._folder) if n.endswith(".json") and n[:-5].isdigit())

    def at(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self._folder}/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def all(self) -> list[dict]:
        return [self.at(n) for n in self.numbers()]

    def current(self) -> dict:
        """The newest generation: its number, and of each table the version, the stage that made it, and the versions it was made from."""
        found = self.numbers()
        return self.at(found[-1]) if found else {"number": 0, "tables": {}, "reports": {}}

    def table(self, name: str) -> Table:
        return Table(self, name)

    def has(self, *names: str) -> bool:
        known = self.current()["tables"]
        return all(n in known for n in names)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        if version is None:
            known = self.current()["tables"]
            if name not in known:
                raise FileNotFoundError(f"no table {name} in {self.root}")
            version = known[name]["version"]
        return self.spark.read.parquet(f"{self.root}/{name}/v{version}")

    def commit(self, tables: dict[str, DataFrame], stage: str = "", inputs: tuple[str, ...] = (), drop: tuple[str, ...] = (), reports: dict[str, DataFrame] | None = None) -> dict:
        """Write all tables, and reports as JSON lines, then publish them at once; tables in ``drop`` end. Gives the new generation."""
        old = self.current()
        number = old["number"] + 1
        made_from = {t: old["tables"][t]["version"] for t in inputs if t in old["tables"]}
        now = {n: t for n, t in old["tables"].items() if n not in drop}
        for name, rows in tables.items():
            used = [int(n[1:]) for n in self._names(f"{self.root}/{name}") if n[:1] == "v" and n[1:].isdigit()]
            version = max(used, default=0) + 1  # past what a job that died has left
            rows.write.parquet(f"{self.root}/{name}/v{version}")
            now[name] = {"version": version, "stage": stage, "made_from": made_from}
        told = dict(old.get("reports", {}))
        for name, rows in (reports or {}).items():
            path = f"{self.root}/_reports/{stage}/{number:012d}/{name}"
            rows.write.mode("overwrite").json(path)
            told[f"{stage}/{name}"] = path
        new = {"number": number, "stage": stage, "tables": now, "reports": told}
        self._publish(number, json.dumps(new, indent=1, sort_keys=True))
        return new

    def _publish(self, number: int, text: str) -> None:
        """The file appears whole, under a name that nobody else may have taken."""
        jvm = self.spark._jvm
        part = self._path(f"{self._folder}/.{number:012d}.{jvm.java.util.UUID.randomUUID()}.part")
        stream = self._fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        goal = self._fs.makeQualified(self._path(f"{self._folder}/{number:012d}.json"))
        context = self._hadoop.FileContext.getFileContext(goal.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(part), goal, none)
        except Exception as error:
            self._fs.delete(part, False)
            if self._fs.exists(goal):
                raise ConcurrentCommit(f"generation {number} is another writer's") from error
            raise

    def report(self, name: str) -> DataFrame:
        """The newest report ``<stage>/<name>``."""
        return self.spark.read.json(self.current()["reports"][name])

    def behind(self) -> dict[str, list[str]]:
        """Of each table that isn't up to date the inputs that have moved on since it was made, or that are behind themselves."""
        tables, out = self.current()["tables"], {}

        def look(name: str, seen: frozenset) -> list[str]:
            if name not in out and name not in seen:
                old = [t for t, v in tables[name]["made_from"].items() if t != name and (t not in tables or tables[t]["version"] != v or look(t, seen | {name}))]
                out[name] = sorted(old)
            return out.get(name, [])

        for name in tables:
            look(name, frozenset())
        return {n: why for n, why in out.items() if why}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions that none of the last ``keep`` generations names, and older generations; gives what went."""
        numbers = self.numbers()
        kept = [self.at(n) for n in numbers[-keep:]] if keep else []
        for n in numbers[: len(numbers) - len(kept)]:
            self._fs.delete(self._path(f"{self._folder}/{n:012d}.json"), False)
        gone = []
        for name in {*self._names(self.root)} - {"_generations", "_reports"}:
            named = {g["tables"][name]["version"] for g in kept if name in g["tables"]}
            for version in self._names(f"{self.root}/{name}"):
                if version[:1] == "v" and version[1:].isdigit() and int(version[1:]) not in named:
                    self._fs.delete(self._path(f"{self.root}/{name}/{version}"), True)
                    gone.append(f"{name}/{version}")
        return sorted(gone)
