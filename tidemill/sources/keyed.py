"""A table by key whose rows can change and go, as plain files.

Every version of changes is a folder of its own: new rows, or keys that are gone. The
state at a version is the newest change per key, less what is gone. ``compact``
writes the state at a version as one more folder, the base; readers then start from
the newest base and look only at later changes, so what a read costs does not grow with
the history. A base counts once its write has ended; until then, and afterwards for
older versions, readers find what they found before. ``forget`` removes what lies
behind the newest base.

Writing a version again replaces it, so a batch that comes twice changes nothing. One
writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.latest import first_per_key

VERSION, GONE, UPTO = "_version", "_gone", "_upto"


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    key: tuple[str, ...]
    schema: T.StructType

    def put(self, rows: DataFrame, version: int) -> None:
        """Add or replace rows by key; of rows with one key within a version the first in the order of the columns counts."""
        self._write(rows.select(*self.schema.names, F.lit(False).alias(GONE)), version)

    def remove(self, keys: DataFrame, version: int) -> None:
        """Take away the rows with these keys; keys that are not there do no harm."""
        kinds = {f.name: f.dataType for f in self.schema}
        columns = [F.col(c) if c in self.key else F.lit(None).cast(kinds[c]).alias(c) for c in self.schema.names]
        self._write(keys.select(*self.key).distinct().select(*columns, F.lit(True).alias(GONE)), version)

    def rows(self, version: int | None = None) -> DataFrame:
        """The rows at a version, or the newest ones."""
        base = max((b for b in self._bases() if version is None or b <= version), default=None)
        changes = self._changes(base, version)
        if base is None:
            return self._newest(changes).filter(~F.col(GONE)).drop(GONE)
        held = self.spark.read.schema(self.schema).parquet(f"{self.path}/base/{UPTO}={base}")
        if changes is None:
            return held
        changed = self._newest(changes)
        same = [held[c].eqNullSafe(changed[c]) for c in self.key]
        kept = held.join(changed, same, "left_anti")
        return kept.unionByName(changed.filter(~F.col(GONE)).drop(GONE))

    def upto(self) -> int:
        """The version of the newest base; -1 if there is none."""
        return max(self._bases(), default=-1)

    def compact(self, upto: int | None = None) -> int:
        """Write the state at ``upto`` (the newest version by default) as a base."""
        versions = self._numbers("changes", VERSION)
        upto = max(versions) if upto is None else upto
        if upto not in self._bases():
            self.rows(upto).write.mode("overwrite").parquet(f"{self.path}/base/{UPTO}={upto}")
        return upto

    def forget(self) -> None:
        """Remove the changes and bases that the newest base stands for. Versions before it can't be read any more."""
        newest = self.upto()
        for kind, name, numbers in (("changes", VERSION, self._numbers("changes", VERSION)), ("base", UPTO, self._bases())):
            for n in numbers:
                if n < newest or (n == newest and kind == "changes"):
                    fs, place = self._place(f"{kind}/{name}={n}")
                    fs.delete(place, True)

    def _write(self, rows: DataFrame, version: int) -> None:
        if version <= self.upto():
            raise ValueError(f"version {version} is part of a base")
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/{VERSION}={version}")

    def _newest(self, changes: DataFrame | None) -> DataFrame:
        if changes is None:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType())]))
        order = [F.desc(VERSION), F.asc(GONE), *[F.col(c) for c in self.schema.names if c not in self.key]]
        return first_per_key(changes, list(self.key), order).drop(VERSION)

    def _changes(self, after: int | None, upto: int | None) -> DataFrame | None:
        """The changes of some versions: folders outside are not read."""
        wanted = [v for v in self._numbers("changes", VERSION) if (after is None or v > after) and (upto is None or v <= upto)]
        if not wanted:
            return None
        schema = T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType()), T.StructField(VERSION, T.LongType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/changes")
        return reader.parquet(*[f"{self.path}/changes/{VERSION}={v}" for v in wanted])

    def _bases(self) -> list[int]:
        """The bases whose write has ended."""
        out = []
        for n in self._numbers("base", UPTO):
            fs, place = self._place(f"base/{UPTO}={n}/_SUCCESS")
            if fs.exists(place):
                out.append(n)
        return out

    def _numbers(self, kind: str, name: str) -> list[int]:
        fs, place = self._place(kind)
        if not fs.exists(place):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(f.split("=")[1]) for f in found if f.startswith(f"{name}="))

    def _place(self, inside: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{inside}")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place
