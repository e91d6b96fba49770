"""Schemas that follow what lands: a log of versions, and the order in which types widen.

A column's type only ever widens, long to double to string and date to timestamp to string, and columns are only ever
added, so what was stored under an earlier version reads under every later one without loss (long to
double: up to 2**53).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from keepwell.sources.versions import ConcurrentUpdate, VersionLog

# Each type with the ones it widens to, nearest first.
WIDER = {
    "void": ("boolean", "bigint", "double", "date", "timestamp_ntz", "string"),
    "boolean": ("string",),
    "bigint": ("double", "string"),
    "double": ("string",),
    "date": ("timestamp_ntz", "string"),
    "timestamp_ntz": ("string",),
    "string": (),
}


def wider(a: str, b: str) -> str:
    """The narrowest type that holds values of both."""
    ours, theirs = (a, *WIDER.get(a, ("string",))), (b, *WIDER.get(b, ("string",)))
    return next((t for t in ours if t in theirs), "string")


def merged(schemas: Iterable[StructType]) -> StructType:
    """All columns of the schemas in order of appearance, each with its widest type."""
    types: dict[str, str] = {}
    for schema in schemas:
        for field in schema.fields:
            kind = field.dataType.simpleString()
            types[field.name] = wider(types[field.name], kind) if field.name in types else kind
    return StructType([StructField(name, DataType.fromDDL(kind)) for name, kind in types.items()])


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the columns and types of a wider schema."""
    held = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def kinds_of(lines: DataFrame) -> dict[str, set[str]]:
    """The types of the values of each field in JSON lines (`value`), in one pass; one entry per field arrives here."""
    return fields_of(lines)[0]


def fields_of(lines: DataFrame) -> tuple[dict[str, set[str]], bool]:
    """The same, and whether these are the fields of every line: some lines may be no object, or one without fields."""
    fields = F.try_parse_json("value").try_cast("map<string, variant>")
    pairs = lines.select(F.explode_outer(fields).alias("name", "held"))
    kind = F.schema_of_variant("held")
    plain = (
        F.when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "double").when(kind == "BIGINT", "bigint")
        .when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "void").otherwise("string")
    )
    kinds: dict[str, set[str]] = {}
    whole = True
    for name, seen in pairs.select("name", F.when(F.col("name").isNotNull(), plain).alias("kind")).distinct().collect():
        if name is None:
            whole = False
        else:
            kinds.setdefault(name, set()).add(seen)
    return kinds, whole


def evolved(schema: StructType, kinds: Mapping[str, set[str]], limits: Mapping[str, str]) -> StructType:
    """The schema widened for these values, with the fields it lacks.

    limits: the widest type a declared column may take; what fits no type up to it is left to the rescue column.
    Text is how dates and times are written, so a declared date or time stays one.
    """
    fields = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        most = limits.get(field.name, "string")
        for seen in sorted(kinds.get(field.name, ())):
            wide = wider(kind, seen)
            if kind not in ("date", "timestamp_ntz") and most in (wide, *WIDER.get(wide, ())):
                kind = wide
        fields.append(StructField(field.name, DataType.fromDDL(kind)))
    for name in sorted(set(kinds) - set(schema.names)):
        kind = "void"
        for seen in sorted(kinds[name]):
            kind = wider(kind, seen)
        if kind != "void":  # a field that only ever was null has no type yet
            fields.append(StructField(name, DataType.fromDDL(kind)))
    return StructType(fields)


class SchemaLog:
    """The versions of a dataset's schema; the first is the declared one."""

    def __init__(self, spark: SparkSession, folder: str, declared: StructType):
        self.log = VersionLog(spark, folder)
        if not self.log.latest():
            try:
                self.log.commit({"schema": declared.jsonValue()}, 0)
            except ConcurrentUpdate:
                pass  # somebody else declared it at the same moment

    def current(self) -> tuple[int, StructType]:
        version = self.log.latest()
        return version, self.version(version)

    def version(self, number: int) -> StructType:
        return StructType.fromJson(self.log.entry(number)["schema"])

    def evolve(self, kinds: Mapping[str, set[str]], limits: Mapping[str, str]) -> tuple[int, StructType]:
        """The version that holds these values: a new one if the current one does not."""
        number, schema = self.current()
        wide = evolved(schema, kinds, limits)
        if wide == schema:
            return number, schema
        return self.log.commit({"schema": wide.jsonValue()}, number), wide
