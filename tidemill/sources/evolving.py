"""Tables whose columns change: added columns, wider types, nothing narrower.

Every append goes to the folder of its shape, that is, of its columns and types. The
table's schema is the union of the shapes, each column as wide as its widest one;
readers take each folder as it was written and cast up. What cannot be
cast up without loss is refused before a row is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources.managed import SchemaMismatch

SHAPE = "_shape"
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both without loss, if one is a widening of the other."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    pair = {a.simpleString(), b.simpleString()}
    if pair == {"float", "double"} or ("double" in pair and pair & {"tinyint", "smallint", "int"}):
        return T.DoubleType()
    if pair == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        return _decimal(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = wider(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        inner = [wider(x.dataType, y.dataType) for x, y in zip(a, b, strict=True)]
        return None if None in inner else T.StructType([T.StructField(n, t) for n, t in zip(a.names, inner, strict=True)])
    return None


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType | None:
    sizes = []
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            sizes.append((t.precision - t.scale, t.scale))
        elif t.simpleString() in _DIGITS:
            sizes.append((_DIGITS[t.simpleString()], 0))
        else:
            return None
    whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def reconciled(table: T.StructType, rows: T.StructType) -> T.StructType:
    """The schema of both together; raises where a column's types cannot be reconciled."""
    have, bad = {f.name: f.dataType for f in table}, []
    for f in rows:
        both = wider(have[f.name], f.dataType) if f.name in have else f.dataType
        if both is None:
            bad.append(f"column {f.name} is {f.dataType.simpleString()}, table has {have[f.name].simpleString()}")
        else:
            have[f.name] = both
    if bad:
        raise SchemaMismatch("; ".join(bad))
    return T.StructType([T.StructField(n, t) for n, t in have.items()])


def _shapes(spark: SparkSession, path: str) -> list[DataFrame]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    folders = sorted((s.getPath().getName() for s in fs.listStatus(place)), key=lambda n: int(n.rpartition("=")[2]) if n.startswith(f"{SHAPE}=") else -1)
    return [spark.read.parquet(f"{path}/{n}") for n in folders if n.startswith(f"{SHAPE}=")]


def schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's schema; null if there is no table yet."""
    shapes = _shapes(spark, path)
    return reduce(reconciled, [s.schema for s in shapes]) if shapes else None


def append(df: DataFrame, path: str) -> T.StructType:
    """Append rows, whose columns may be fewer, more or of other width than the table's; returns the table's schema."""
    shapes = _shapes(df.sparkSession, path)
    merged = reduce(reconciled, [df.schema], reduce(reconciled, [s.schema for s in shapes])) if shapes else df.schema
    plain = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema]
    known = [i for i, s in enumerate(shapes) if plain(s.schema) == plain(df.schema)]
    df.write.mode("append").parquet(f"{path}/{SHAPE}={known[0] if known else len(shapes)}")
    return merged


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the table's schema; columns that a row was written without are null."""
    shapes = _shapes(spark, path)
    schema = reduce(reconciled, [s.schema for s in shapes])
    parts = []
    for shape in shapes:
        columns = [(F.col(f"`{f.name}`") if f.name in shape.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        parts.append(shape.select(*columns))
    return reduce(DataFrame.unionByName, parts)
