"""Table schemas that change: which types may widen, and which version wrote a partition.

A batch may bring a wider type for a column (int, long, decimal, double; float,
double; a longer decimal), or a narrower one that the table's type holds; the
resolved type is the smallest that holds both. Anything else (a date met by a
string, a time with a zone by one without) is refused before a file is written.

Parquet files keep the type they were written with, and readers convert only some
of them. So a table whose types have changed keeps its versions beside its files:
the schemas, and for each partition rewritten since the first change the number of
the schema that wrote it. Merges rewrite whole partitions, so a partition has one
version. A read takes the partitions of each version with its own schema and casts.
While a commit replaces partitions they are marked as unknown; a reader that meets
such a mark (a commit that was interrupted) takes the types from the files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_FILE = "_schema.json"  # Spark's readers skip names that start with an underscore
VERSIONS_FILE = "_versions.json"
UNKNOWN = -1
#: Decimal digits that hold every value of an integer type.
INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


class IncompatibleTypes(TypeError):
    """A batch's column cannot be stored in the table's."""


def widen(a: T.DataType, b: T.DataType, name: str = "") -> T.DataType:
    """The smallest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(INTEGERS):
        return max(a, b, key=lambda t: ORDER.index(type(t)))
    if kinds <= {*INTEGERS, T.DecimalType}:
        (p, s), (q, r) = ((t.precision, t.scale) if isinstance(t, T.DecimalType) else (INTEGERS[type(t)], 0) for t in (a, b))
        whole, scale = max(p - s, q - r), max(s, r)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
        raise IncompatibleTypes(f"column {name}: {a.simpleString()} and {b.simpleString()} need more than 38 digits")
    if kinds == {T.FloatType, T.DoubleType} or T.DoubleType in kinds and kinds <= {*INTEGERS, T.DecimalType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.ArrayType}:
        return T.ArrayType(widen(a.elementType, b.elementType, f"{name}[]"), a.containsNull or b.containsNull)
    if kinds == {T.MapType} and a.keyType == b.keyType:
        return T.MapType(a.keyType, widen(a.valueType, b.valueType, f"{name}[]"), a.valueContainsNull or b.valueContainsNull)
    if kinds == {T.StructType}:
        return resolve(a, b, f"{name}.")
    raise IncompatibleTypes(f"column {name}: {a.simpleString()} in the table, {b.simpleString()} in the batch")


def resolve(target: T.StructType, source: T.StructType, prefix: str = "") -> T.StructType:
    """The target's columns, widened where the source's are wider, then the source's new ones."""
    theirs = {f.name.lower(): f for f in source}
    out = []
    for f in target:
        other = theirs.pop(f.name.lower(), None)
        out.append(f if other is None else T.StructField(f.name, widen(f.dataType, other.dataType, prefix + f.name), True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in source if f.name.lower() in theirs])


def retyped(target: T.StructType, source: T.StructType) -> bool:
    """Whether columns of the target have other types in ``source``."""
    theirs = {f.name.lower(): f.dataType for f in source}
    return any(f.name.lower() in theirs and theirs[f.name.lower()].simpleString() != f.dataType.simpleString() for f in target)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types; those that ``df`` lacks are NULL."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def _path(spark: SparkSession, path: str, name: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def load_json(spark: SparkSession, path: str, name: str):
    fs, p = _path(spark, path, name)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def save_json(spark: SparkSession, path: str, name: str, value) -> None:
    fs, p = _path(spark, path, name)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep the table's schema beside its files: a file written before a column was added lacks it."""
    save_json(spark, path, SCHEMA_FILE, schema.jsonValue())


def saved_schema(spark: SparkSession, path: str) -> T.StructType | None:
    found = load_json(spark, path, SCHEMA_FILE)
    return None if found is None else T.StructType.fromJson(found)


class Versions:
    """The schemas of a table whose types have changed, and which wrote a partition (0 where nothing is said)."""

    def __init__(self, schemas: Sequence[T.StructType] = (), at: dict[str, int] | None = None):
        self.schemas, self.at = list(schemas), dict(at or {})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Versions:
        found = load_json(spark, path, VERSIONS_FILE)
        return cls() if found is None else cls([T.StructType.fromJson(s) for s in found["schemas"]], found["at"])

    def save(self, spark: SparkSession, path: str) -> None:
        save_json(spark, path, VERSIONS_FILE, {"schemas": [s.jsonValue() for s in self.schemas], "at": self.at})

    @staticmethod
    def key(value: str | None) -> str:
        return "" if value is None else f"={value}"

    def mark(self, values: Iterable[str | None], version: int) -> None:
        self.at.update({self.key(v): version for v in values})

    def of(self, value: str | None) -> int:
        return self.at.get(self.key(value), 0)


def begin_change(spark: SparkSession, path: str, old: T.StructType, new: T.StructType, touched: Iterable[str | None]) -> Versions | None:
    """Before the partitions ``touched`` are rewritten as ``new``: note a change of types, and that they are in flux.
    None for a table whose types never changed."""
    versions = Versions.load(spark, path)
    if retyped(old, new):
        versions.schemas = [*(versions.schemas or [old]), new]
    if not versions.schemas:
        return None
    versions.mark(touched, UNKNOWN)
    versions.save(spark, path)
    return versions


def end_change(spark: SparkSession, path: str, versions: Versions | None, touched: Iterable[str | None]) -> None:
    if versions is not None:
        versions.mark(touched, len(versions.schemas) - 1)
        versions.save(spark, path)
