"""A stored table whose columns change: a schema registry beside the files, old files read under the new schema.

Each change of columns is a new generation with a manifest of its own; batches
are written under the generation of the day and never rewritten.  A read takes
each generation's files by its own column names, casts what was widened and
fills what it lacks with the column's default.  Columns have numbers: one that
was dropped and added again under its name is another column, so old values
do not come back.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.batches import BatchTable, Files

#: Types that a column may be widened to, by what it is; any type may become a string.
WIDER = {
    "tinyint": ["smallint", "int", "bigint", "double"],
    "smallint": ["int", "bigint", "double"],
    "int": ["bigint", "double"],
    "bigint": ["double"],
    "float": ["double"],
    "date": ["timestamp"],
}


class EvolvingTable:
    """A table at ``path``; ``columns`` (name to type) are those of a new one."""

    def __init__(self, spark: SparkSession, path: str, columns: dict[str, str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)
        if not self._numbers():
            if not columns:
                raise ValueError(f"there is no table at {path}: name its columns")
            first = [{"id": i, "name": n, "type": self._type(t), "default": None} for i, (n, t) in enumerate(columns.items())]
            self.files.publish(f"{self.path}/_schemas/{0:06d}", json.dumps({"next": len(first), "columns": first}))

    def _type(self, ddl: str) -> str:
        return self.spark.createDataFrame([], f"c {ddl}").schema["c"].dataType.simpleString()

    def _numbers(self) -> list[int]:
        return [int(n) for n in self.files.names(f"{self.path}/_schemas") if not n.startswith(".")]

    def _schema(self, number: int) -> dict:
        return json.loads(self.files.text(f"{self.path}/_schemas/{number:06d}"))

    @property
    def columns(self) -> dict[str, str]:
        return {c["name"]: c["type"] for c in self._schema(self._numbers()[-1])["columns"]}

    def evolve(self, add: dict[str, str] | None = None, drop: list[str] | None = None, widen: dict[str, str] | None = None, defaults: dict[str, object] | None = None) -> bool:
        """A new generation, where anything changes; columns to add that are there, and to drop that are not, are left as they are.

        ``defaults``: what added columns hold in rows written before them, or without them.
        """
        at = self._numbers()[-1]
        now = self._schema(at)
        kept = [dict(c) for c in now["columns"] if c["name"] not in (drop or [])]
        by_name = {c["name"]: c for c in kept}
        for name, wanted in (widen or {}).items():
            column, wide = by_name[name], self._type(wanted)
            if wide != column["type"]:
                if wide != "string" and wide not in WIDER.get(column["type"], []):
                    raise ValueError(f"{name} is {column['type']}, which {wide} does not hold")
                column["type"] = wide
        number = now["next"]
        for name, kind in (add or {}).items():
            if name not in by_name:
                kept.append({"id": number, "name": name, "type": self._type(kind), "default": (defaults or {}).get(name)})
                number += 1
        if kept == now["columns"]:
            return False
        if not self.files.publish(f"{self.path}/_schemas/{at + 1:06d}", json.dumps({"next": number, "columns": kept})):
            raise RuntimeError(f"another writer changed the columns of {self.path}")
        return True

    def _rows(self, number: int, columns: list[dict]) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/g{number:06d}", ", ".join(f"`{c['name']}` {c['type']}" for c in columns))

    def holds(self, batch: str | int) -> bool:
        return any(self._rows(n, self._schema(n)["columns"]).holds(batch) for n in self._numbers())

    def write(self, rows: DataFrame, batch: str | int) -> bool:
        """Add a batch once, whatever generation it was written under; columns by name, absent ones by default, unknown ones are an error."""
        if self.holds(batch):
            return False
        at = self._numbers()[-1]
        columns = self._schema(at)["columns"]
        unknown = set(rows.columns) - {c["name"] for c in columns}
        if unknown:
            raise ValueError(f"the table has no {', '.join(sorted(unknown))}: evolve it first")
        value = lambda c: F.col(f"`{c['name']}`") if c["name"] in rows.columns else F.lit(c["default"])
        return self._rows(at, columns).write(rows.select(*[value(c).cast(c["type"]).alias(c["name"]) for c in columns]), batch)

    def read(self) -> DataFrame:
        """All batches of all generations under the last one's columns."""
        numbers = self._numbers()
        wanted = self._schema(numbers[-1])["columns"]
        out = None
        for n in numbers:
            own = self._schema(n)["columns"]
            names = {c["id"]: c["name"] for c in own}
            value = lambda c, names=names: F.col(f"`{names[c['id']]}`") if c["id"] in names else F.lit(c["default"])
            part = self._rows(n, own).read().select(*[value(c).cast(c["type"]).alias(c["name"]) for c in wanted])
            out = part if out is None else out.unionByName(part)
        return out
