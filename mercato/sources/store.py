"""Tables in folders of their own version, made visible together by one pointer row.

Every write goes to a fresh folder. What readers see is decided by the last row of a small log beside
them, which names each table's folders, schema and row count; it is appended when all tables of a load
are written and checked. A load that dies earlier, anywhere, leaves the previous tables as they were, and
readers that opened those keep reading their folders. Nothing is written twice, renamed or deleted.

Counts come out of the write itself (``observe``), so a table is read once however much is known of it
afterwards. Spark applies a finished task's counts once, so lost executors don't distort them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato.sources.sinks import WRITE_MODES

LOG_SCHEMA = "number long, name string, tables string"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Stored:
    """A table's folders (several after appends), its schema, rows and nulls by column."""

    folders: tuple[str, ...]
    schema: StructType
    rows: int
    nulls: dict[str, int]

    def to_json(self) -> dict:
        return {"folders": list(self.folders), "schema": self.schema.jsonValue(), "rows": self.rows, "nulls": self.nulls}

    @classmethod
    def from_json(cls, said: dict) -> Stored:
        return cls(tuple(said["folders"]), StructType.fromJson(said["schema"]), said["rows"], said["nulls"])

    def read(self, spark: SparkSession) -> DataFrame:
        names = [_quoted(n) for n in self.schema.names]
        parts = [spark.read.schema(self.schema).parquet(f).select(*names) for f in self.folders]
        return reduce(DataFrame.unionByName, parts)


def refuse_duplicates(columns: Iterable[str], name: str) -> None:
    columns = list(columns)
    twice = sorted({c for c in columns if columns.count(c) > 1})
    if twice:
        raise ValueError(f"{name}: duplicate column names {twice}")


def write_counted(df: DataFrame, folder: str, partition_by: Sequence[str] | None = None) -> Stored:
    """Write ``df`` to a folder; its row count and nulls by column are counted on the way."""
    counts = Observation()
    nulls = [F.count_if(F.col(_quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    writer = df.observe(counts, F.count(F.lit(1)).alias("rows"), *nulls).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    got = counts.get
    return Stored((folder,), df.schema, got["rows"], {c: got[f"n{i}"] for i, c in enumerate(df.columns)})


class TableStore:
    """The tables under ``base`` as the last published load left them."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _last(self):
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(f"{self.base}/log").orderBy(F.desc("number"), F.desc("name")).first()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def tables(self) -> dict[str, Stored]:
        last = self._last()
        return {k: Stored.from_json(v) for k, v in json.loads(last["tables"]).items()} if last else {}

    def read(self, name: str) -> DataFrame:
        found = self.tables().get(name)
        if found is None:
            raise KeyError(f"no table {name!r} is published in {self.base}")
        return found.read(self.spark)

    def load(self) -> Load:
        return Load(self)


class Load:
    """One load of a store: tables are written at once, seen by others after ``publish``."""

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark
        self.name = uuid.uuid4().hex
        self.before = store.tables()
        self.written: dict[str, Stored] = {}

    def write(self, name: str, df: DataFrame, *, mode: str = "overwrite", partition_by: Sequence[str] | None = None, allow_empty: bool = True) -> DataFrame:
        """Write a table of this load and return it as stored; ``mode`` is a write disposition.

        Duplicate column names are refused before, no rows (unless allowed) after the one pass over ``df``.
        """
        if mode not in WRITE_MODES:
            raise ValueError(f"unknown write mode {mode!r}")
        held = self.before.get(name)
        if held and (mode == "errorifexists" or mode == "WRITE_EMPTY" and held.rows):
            raise ValueError(f"{name} already holds rows")
        refuse_duplicates(df.columns, name)
        new = write_counted(df, f"{self.store.base}/loads/{self.name}/{name}", partition_by)
        if not new.rows and not allow_empty:
            raise ValueError(f"{name}: empty frame, load refused")
        if held and WRITE_MODES[mode] == "append":
            if held.schema.names != new.schema.names:
                raise ValueError(f"{name}: columns differ from those held")
            nulls = {c: held.nulls[c] + n for c, n in new.nulls.items()}
            self.written[name] = Stored(held.folders + new.folders, held.schema, held.rows + new.rows, nulls)
        else:
            self.written[name] = new
        return self.written[name].read(self.spark)

    def publish(self) -> dict[str, Stored]:
        """Make the load's tables the current ones, all at once; tables it didn't write stay as they are."""
        last = self.store._last()
        every = self.store.tables() | self.written
        row = ((last["number"] if last else 0) + 1, self.name, json.dumps({k: v.to_json() for k, v in every.items()}))
        self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{self.store.base}/log")
        return every
