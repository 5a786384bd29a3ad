"""Tables as Parquet folders, published load by load.

A load writes its rows into folders of their own, `<table>/part=<unique>`, and becomes visible when its numbered file appears in
the log. The file is put there by a rename that fails if the number is taken, so two writers never share a load: the later one
takes the next number, or starts again if what it wrote was computed from tables that have changed since. A load that fails
half-way leaves nothing behind that a reader would see. A table is its last full write plus the changes written since; a
changed row hides stored rows of the same key. Small loads therefore never rewrite a large table, and `compact` makes a new
full write when many changes have piled up.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.operators.merges import last_per_key
from pagetide.operators.normalize import conform
from pagetide.operators.skew import lookup_join
from pagetide.schemas import DEFAULTS, KEYS, TABLES
from pagetide.session import folder_bytes, sized_shuffle

FULL, CHANGES = "full", "changes"

# The tokens of loads that change no row begin with this.
COMPACTION = "compact-"

_LOG = "load bigint, table_name string, kind string, token string, part string"

# Loads since the last full write after which a table is written anew.
COMPACT_AFTER = 24


class StaleRead(RuntimeError):
    """Another load was published since the tables were read that this one was computed from."""


@dataclass
class Store:
    spark: SparkSession
    root: str

    def _log(self) -> list:
        """One line per load and table. It is small, and grows with the number of loads, not with the data."""
        try:
            return sorted(self.spark.read.schema(_LOG).json(f"{self.root}/_log").collect(), key=lambda row: row["load"])
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def last_load(self) -> int:
        return max((row["load"] for row in self._log()), default=0)

    def has(self, token: str) -> bool:
        return any(row["token"] == token for row in self._log())

    def read(self, table: str) -> DataFrame:
        return self.read_all([table])[table]

    def read_all(self, tables: list[str]) -> dict[str, DataFrame]:
        """Several tables as of the same load."""
        log = self._log()
        return {table: self._table(table, log) for table in tables}

    def _table(self, table: str, log: list) -> DataFrame:
        schema = TABLES[table]
        entries = [row for row in log if row["table_name"] == table]
        full = [row for row in entries if row["kind"] == FULL]
        start = full[-1]["load"] if full else 0
        changes = [row for row in entries if row["kind"] == CHANGES and row["load"] > start]
        base = self._folders(table, full[-1:])
        newer = self._folders(table, changes)
        if newer is None:
            rows = base
        else:
            rows = last_per_key(newer, KEYS[table], ["load"], schema.names) if len(changes) > 1 else newer
            if base is not None:
                hidden = newer.select(*KEYS[table]).distinct()
                untouched = lookup_join(base.select(*schema.names), hidden, KEYS[table], "left_anti")
                rows = untouched.unionByName(rows.select(*schema.names))
        if rows is None:
            rows = self.spark.createDataFrame([], schema)
        return conform(rows, schema, DEFAULTS[table])

    def in_step(self, table: str, others: list[str]) -> bool:
        """True if every load that wrote to one of the others wrote to `table` too, or came before a full write of it."""
        log = [row for row in self._log() if not row["token"].startswith(COMPACTION)]
        own = {row["load"] for row in log if row["table_name"] == table}
        start = max((row["load"] for row in log if row["table_name"] == table and row["kind"] == FULL), default=0)
        return own.issuperset(row["load"] for row in log if row["table_name"] in others and row["load"] > start)

    def size(self, *tables: str) -> int:
        """Bytes of the files that reading the tables takes."""
        log, folders = self._log(), []
        for table in tables:
            entries = [row for row in log if row["table_name"] == table]
            start = max((row["load"] for row in entries if row["kind"] == FULL), default=0)
            folders += [self._part(row.asDict()) for row in entries if row["load"] >= start]
        return folder_bytes(self.spark, folders)

    def _folders(self, table: str, entries: list) -> DataFrame | None:
        if not entries:
            return None
        paths = [f"{self.root}/{table}/part={row['part']}" for row in entries]
        fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in TABLES[table])
        rows = self.spark.read.schema(f"{fields}, part string").option("basePath", f"{self.root}/{table}").parquet(*paths)
        numbers = [F.lit(value) for row in entries for value in (row["part"], row["load"])]
        return rows.withColumn("load", F.create_map(*numbers)[F.col("part")]).drop("part")

    def publish(
        self,
        tables: dict[str, tuple[str, DataFrame]],
        token: str | None = None,
        computed_from: int | None = None,
        verify: Callable[[dict[str, DataFrame]], None] | None = None,
    ) -> int:
        """Write the frames of one load (kind, rows) and then make them visible together.

        A token names the load: publishing it a second time, as a restarted stream does, changes nothing. `computed_from` is the
        last load that the frames know of; if there is a newer one, StaleRead is raised and nothing becomes visible. `verify` sees
        the written rows of each table; if it raises, they are deleted.
        """
        token = token or uuid.uuid4().hex
        if self.has(token):
            return next(row["load"] for row in self._log() if row["token"] == token)
        lines = []
        for table, (kind, rows) in tables.items():
            part = uuid.uuid4().hex
            rows.select(*TABLES[table].names).write.parquet(f"{self.root}/{table}/part={part}")
            lines.append({"table_name": table, "kind": kind, "token": token, "part": part})
        if verify:
            try:
                verify({
                    line["table_name"]: self.spark.read.schema(TABLES[line["table_name"]]).parquet(self._part(line)) for line in lines
                })
            except Exception:
                for line in lines:
                    self._delete(self._part(line))
                raise
        while True:
            log = self._log()
            done = [row["load"] for row in log if row["token"] == token]
            if done:
                return done[0]
            last = max((row["load"] for row in log), default=0)
            if computed_from is not None and last != computed_from:
                raise StaleRead(f"load {last} was published after load {computed_from} was read")
            if self._commit(last + 1, lines):
                return last + 1

    def _part(self, line: dict) -> str:
        return f"{self.root}/{line['table_name']}/part={line['part']}"

    def _delete(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _commit(self, load: int, lines: list[dict]) -> bool:
        """Put the load's file into the log; False if its number is taken."""
        fs_package, conf = self.spark._jvm.org.apache.hadoop.fs, self.spark._jsc.hadoopConfiguration()
        folder = fs_package.Path(f"{self.root}/_log")
        fs = folder.getFileSystem(conf)
        fs.mkdirs(folder)
        hidden, final = fs_package.Path(folder, f"_{uuid.uuid4().hex}"), fs_package.Path(folder, f"{load:012d}.json")
        out = fs.create(hidden, True)
        out.write(bytearray("".join(json.dumps({"load": load, **line}) + "\n" for line in lines).encode()))
        out.close()
        rename = getattr(fs_package, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = fs_package.FileContext.getFileContext(fs.getUri(), conf)
        try:
            context.rename(fs.makeQualified(hidden), fs.makeQualified(final), options)
        except Py4JJavaError as error:
            fs.delete(hidden, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def compact(self, table: str) -> int:
        while True:
            last = self.last_load()
            try:
                with sized_shuffle(self.spark, self.size(table)):
                    return self.publish(
                        {table: (FULL, self.read(table))}, f"{COMPACTION}{uuid.uuid4().hex}", computed_from=last
                    )
            except StaleRead:
                continue

    def compact_pending(self) -> None:
        """Write the tables anew that have many loads of changes on top of their last full write."""
        for table, loads in self.pending_changes().items():
            if loads > COMPACT_AFTER:
                self.compact(table)

    def vacuum(self) -> int:
        """Delete the folders that no table needs any more, and return how many. Not while older reads still run."""
        log, gone = self._log(), 0
        for table in {row["table_name"] for row in log}:
            entries = [row for row in log if row["table_name"] == table]
            start = max((row["load"] for row in entries if row["kind"] == FULL), default=0)
            for row in entries:
                if row["load"] < start:
                    gone += self._delete(self._part(row.asDict()))
        return gone

    def pending_changes(self) -> dict[str, int]:
        """Loads since the last full write, per table."""
        pending: dict[str, int] = {}
        for row in self._log():
            pending[row["table_name"]] = 0 if row["kind"] == FULL else pending.get(row["table_name"], 0) + 1
        return pending
