"""A table whose columns follow what arrives: rescued fields become typed columns.

Records come with declared fields and ``rescued_data``, a JSON object of the
undeclared ones as texts (``sources.files.watchlist_lines``).  ``promote``,
called at a start, profiles the fields rescued since the last one, gives each
the narrowest type that holds all its values, and commits a new version of the
schema to a log.  From then on rows are written with those columns.  A value
that does not fit its column's type stays in ``rescued_data`` under its name,
and the next ``promote`` widens the type.  Types only widen::

    bigint -> double -> string        boolean -> string

Rows are never rewritten: every version of the schema has a ledger of its own,
and ``read`` shows all of them in the latest one, taking what earlier rows
hold of a promoted field out of their ``rescued_data``.

A text is a bigint only in the form a bigint is written in (``007`` is a
string), and no integer beyond 2^53 becomes a double, so nothing is lost;
a double that is widened to a string is spelled as Spark spells doubles.
Fields whose name is not a plain identifier, or differs from a column's only
in case, stay rescued, as do those beyond ``max_fields`` columns (the most
frequent ones come first) and lines that are no JSON object.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..schemas import RESCUED
from .ledger import Ledger

LOG = StructType([StructField("version", IntegerType()), StructField("field", StringType()),
                  StructField("type", StringType())])
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
INTEGER = r"^-?[0-9]+$"
NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
# Integers up to here are exact as doubles.
EXACT = 2 ** 53


def rescued_fields() -> Column:
    """The rescued fields of a row as a map of texts; NULL where a line is no JSON object."""
    is_object = F.get_json_object(RESCUED, "$").isNotNull() & F.ltrim(RESCUED).startswith("{")
    return F.when(is_object, F.from_json(RESCUED, "map<string,string>"))


def fits(value: Column, kind: str) -> Column:
    """True if a text can be kept as ``kind``; NULL or false if not."""
    if kind == "bigint":
        return value.try_cast("bigint").cast("string") == value
    if kind == "double":
        return value.rlike(NUMBER) & (~value.rlike(INTEGER) | (F.abs(value.try_cast("double")) <= EXACT))
    if kind == "boolean":
        return value.isin("true", "false")
    return value.isNotNull()


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both."""
    if a == b:
        return a
    return "double" if {a, b} == {"bigint", "double"} else "string"


def profile(fields: Column, rows: DataFrame) -> DataFrame:
    """``(field, n, type)`` of every field of a column of text maps; a partial aggregate per field."""
    every = rows.select(F.explode(fields).alias("field", "value")).filter(F.col("value").isNotNull())
    kinds = ("bigint", "double", "boolean")
    counts = every.groupBy("field").agg(F.count(F.lit(1)).alias("n"), *[
        F.bool_and(F.coalesce(fits(F.col("value"), k), F.lit(False))).alias(k) for k in kinds])
    narrowest = F.coalesce(*[F.when(F.col(k), F.lit(k)) for k in kinds], F.lit("string"))
    return counts.select("field", "n", narrowest.alias("type"))


def typed(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``rows`` with rescued values moved into columns of ``fields`` where they fit.

    A column that is there already is cast and kept where it has a value.
    """
    every = rescued_fields()
    columns = {}
    for name, kind in fields.items():
        value = F.element_at(every, F.lit(name))
        moved = F.when(fits(value, kind), value.try_cast(kind))
        columns[name] = F.coalesce(F.col(name).cast(kind), moved) if name in rows.columns else moved
    if fields:
        rest = F.map_filter(every, lambda k, v: ~reduce(lambda a, b: a | b, [
            (k == F.lit(n)) & F.coalesce(fits(v, kind), F.lit(False)) for n, kind in fields.items()]))
        columns[RESCUED] = F.when(every.isNull(), F.col(RESCUED)).when(F.size(rest) > 0, F.to_json(rest))
    return rows.withColumns(columns) if columns else rows


@dataclass(frozen=True)
class EvolvingTable:
    """A table below ``root`` with the declared columns, promoted ones and ``rescued_data``."""

    spark: SparkSession
    root: str
    declared: StructType
    max_fields: int = 500

    def on(self, spark: SparkSession) -> "EvolvingTable":
        return replace(self, spark=spark)

    def _log(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/schemas", LOG).create()

    def schemas(self) -> list[dict[str, str]]:
        """Promoted fields and their types, by version; version 0 has none."""
        out: dict[int, dict[str, str]] = {0: {}}
        for row in self._log().read().orderBy("version", "field").collect():     # a row per column and version
            out.setdefault(row["version"], {})[row["field"]] = row["type"]
        return [out[v] for v in sorted(out)]

    def _rows(self, version: int, fields: dict[str, str]) -> Ledger:
        promoted = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields.items())) if fields else StructType()
        return Ledger(self.spark, f"{self.root}/rows-v{version}", StructType([
            *self.declared.fields, *promoted.fields, StructField(RESCUED, StringType())])).create()

    def _parts(self, schemas: list[dict[str, str]]) -> list[Ledger]:
        return [self._rows(v, fields) for v, fields in enumerate(schemas)]

    def append(self, records: DataFrame, source: str, batch_id: int) -> bool:
        """Append a batch of records in the latest schema, unless some version holds it already."""
        schemas = self.schemas()
        *older, latest = self._parts(schemas)
        if any(part.committed(source, batch_id) for part in older):
            return False
        rows = typed(records.select(*self.declared.names, RESCUED), schemas[-1])
        return latest.append(rows.select(latest.schema.names), source, batch_id)

    def sink(self, source: str):
        """A ``foreachBatch`` handler that appends each micro-batch once."""
        def handle(batch: DataFrame, batch_id: int) -> None:
            self.on(batch.sparkSession).append(batch, source, batch_id)
        return handle

    def read(self) -> DataFrame:
        """Every row, of whatever version, in the latest schema."""
        schemas = self.schemas()
        names = [*self.declared.names, *schemas[-1], RESCUED]
        shown = [typed(part.read(), schemas[-1]).select(*names) for part in self._parts(schemas)]
        return reduce(DataFrame.unionByName, shown)

    def promote(self) -> dict[str, str]:
        """Commit a schema that holds what was rescued since the last one; returns the latest.

        Only rows of the latest version are looked at: earlier ones were
        when their version ended.
        """
        schemas = self.schemas()
        fields = dict(schemas[-1])
        latest = self._parts(schemas)[-1].read()
        known = {n.lower() for n in [*self.declared.names, RESCUED]}
        found = (profile(rescued_fields(), latest.filter(F.col(RESCUED).isNotNull()))
                 .filter(F.col("field").rlike(NAME) & ~F.lower("field").isin(*known)))
        widened = found.filter(F.col("field").isin(*fields)) if fields else found.limit(0)
        for row in widened.collect():                                            # at most a row per column
            fields[row["field"]] = self._widened(row["field"], fields[row["field"]], row["type"])
        taken = known | {n.lower() for n in fields}
        # Of names that differ in case only, the most frequent.
        new = (found.filter(~F.lower("field").isin(*taken))
               .groupBy(F.lower("field")).agg(F.max(F.struct("n", "field", "type")).alias("best")).select("best.*")
               .orderBy(F.desc("n"), "field").limit(max(0, self.max_fields - len(fields))))
        fields.update({row["field"]: row["type"] for row in new.collect()})      # at most max_fields rows
        if fields != schemas[-1]:
            version = len(schemas)
            rows = self.spark.createDataFrame([(version, n, t) for n, t in fields.items()], LOG)
            self._log().append(rows, "schema", version)
        return fields

    def _widened(self, name: str, old: str, new: str) -> str:
        kind = wider(old, new)
        if old == "bigint" and kind == "double":
            beyond = (F.col(name) > EXACT) | (F.col(name) < -EXACT)
            if not self.read().filter(beyond).isEmpty():
                return "string"
        return kind
