"""Tables as immutable Parquet versions, with before-load snapshots and append-only logs.

Layout below the root folder::

    <schema>/<table>/v=<id>/...             files of one load
    <schema>/<table>/v=<id>/_slot=<n>/...   the same in a partitioned table: files of one load and slot
    <schema>/<table>/_current               text: the folders that make up the version in force, one a line
    <schema>/<table>/_partitioning          text: by which columns the table is dealt into slots or buckets
    <schema>/<table>/v=<id>/_buckets        text: the same, of a version that was written in buckets
    <schema>/<table>/_retired.<id>          text: folders that left the table, for expire()
    <log schema>/<log>/run=<id>/...         files of one append
    <log schema>/<log>/_schemas/<digest>    text: a schema that an append had
    <log schema>/<log>/_journal/...         text: rows that are not in the log's files yet

A load writes a new folder and then moves the pointer, so a reader sees the old table or the new one and a failed
load leaves nothing behind that anyone reads. An append writes its batch only and adds a line to the list. An upsert or
delete-insert of a partitioned table writes the slots that it touches and keeps the lines of the others. A snapshot is a
copy of the list, which costs nothing however large the table is. One writer per table at a time; any number of writers
per log.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import all_set, key_list, quoted, ref
from evenkeel.functions.hashing import value_digest
from evenkeel.operators.load import append, delete_insert, keys_in, upsert
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits
from evenkeel.sources.seeds import SNAPSHOT_SUFFIX

_SLOT = "_slot"

# Default schemas for tables and for snapshots and logs.
TABLE_SCHEMA = "SILVER"
QA_SCHEMA = "QA"


class TableMissing(ValueError):
    """The named table, snapshot or log does not exist."""


class TableStore:
    """``qa_schema`` holds the snapshots, and the logs unless ``log_schema`` names another place for them."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str = TABLE_SCHEMA,
        qa_schema: str = QA_SCHEMA,
        log_schema: str | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.qa_schema = qa_schema
        self.log_schema = log_schema or qa_schema

    # -- small files -------------------------------------------------------------------------------------

    def _file(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _exists(self, path: str) -> bool:
        fs, hadoop_path = self._file(path)
        return fs.exists(hadoop_path)

    def _list(self, path: str) -> list[tuple[str, int]]:
        """Names and modification times (milliseconds) of what a folder holds; nothing when there is none."""
        fs, hadoop_path = self._file(path)
        if not fs.exists(hadoop_path):
            return []
        return [(status.getPath().getName(), status.getModificationTime()) for status in fs.listStatus(hadoop_path)]

    def _read_text(self, path: str) -> str | None:
        if not self._exists(path):
            return None
        fs, hadoop_path = self._file(path)
        stream = fs.open(hadoop_path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        """Write beside the old file and rename over it, so that a reader sees either."""
        jvm = self.spark._jvm
        folder, name = path.rsplit("/", 1)
        fs, fresh = self._file(f"{folder}/_new.{name}.{uuid.uuid4().hex}")
        stream = fs.create(fresh, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fresh, jvm.org.apache.hadoop.fs.Path(path), options)

    def _delete(self, path: str) -> None:
        fs, hadoop_path = self._file(path)
        fs.delete(hadoop_path, True)

    def _read_pointer(self, folder: str) -> list[str] | None:
        """The folders of a version; None when there is no pointer."""
        text = self._read_text(f"{folder}/_current")
        if text is None:
            return None
        parts = [line.strip() for line in text.splitlines() if line.strip()]
        if not parts:
            raise TableMissing(f"the pointer {folder}/_current is empty; write the table or its snapshot again")
        return parts

    def _write_pointer(self, folder: str, parts: list[str]) -> None:
        self._write_text(f"{folder}/_current", "\n".join(parts))

    # -- tables ------------------------------------------------------------------------------------------

    def _table_folder(self, name: str) -> str:
        return f"{self.root}/{self.schema}/{name}"

    def exists(self, name: str) -> bool:
        return self._read_pointer(self._table_folder(name)) is not None

    def read(self, name: str) -> DataFrame:
        return self._read_parts(self.parts(name))

    def _read_parts(self, parts: list[str]) -> DataFrame:
        """Rows of the listed folders. Each is a root of its own, so its name makes no column of the table."""
        buckets = self._read_text(f"{parts[0]}/_buckets") if len(parts) == 1 else None
        return self.spark.read.parquet(*parts) if buckets is None else self._read_buckets(parts[0], json.loads(buckets))

    def _read_buckets(self, part: str, deal: dict) -> DataFrame:
        """A version in buckets, as a table of the session's catalog over its folder: only a catalog tells Spark of them."""
        name = f"ek_buckets_{hashlib.sha256(part.encode()).hexdigest()[:24]}"
        if not self.spark.catalog.tableExists(name):
            fields = self.spark.read.parquet(part).schema
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
            keys = ", ".join(quoted(c) for c in deal["columns"])
            self.spark.sql(
                f"create table {name} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
                f"into {deal['buckets']} buckets location '{part}'"
            )
        return self.spark.table(name)

    def _write_buckets(self, folder: str, df: DataFrame, deal: dict) -> None:
        """One file per bucket. The catalog entry of the write is dropped; reading makes one where it is needed."""
        name = f"ek_writing_{uuid.uuid4().hex}"
        keys, n = [ref(c) for c in deal["columns"]], deal["buckets"]
        writer = df.repartition(n, *keys).write.format("parquet").bucketBy(n, *deal["columns"]).sortBy(*deal["columns"])
        writer.option("path", folder).saveAsTable(name)
        self.spark.sql(f"drop table {name}")
        self._write_text(f"{folder}/_buckets", json.dumps(deal))

    def parts(self, name: str) -> list[str]:
        """The folders that make up the table at present."""
        parts = self._read_pointer(self._table_folder(name))
        if parts is None:
            raise TableMissing(f"table {name!r} does not exist below {self.root}/{self.schema}")
        return parts

    def _put_in_force(self, name: str, parts: list[str]) -> DataFrame:
        """Move the pointer; what leaves the table is noted first, so that expire() knows it from a load in progress."""
        folder = self._table_folder(name)
        gone = sorted(set(self._read_pointer(folder) or []) - set(parts))
        if gone:
            self._write_text(f"{folder}/_retired.{uuid.uuid4().hex}", "\n".join(gone))
        self._write_pointer(folder, parts)
        return self.read(name)

    def _write_part(self, name: str, df: DataFrame, beside: list[str]) -> DataFrame:
        folder = self._table_folder(name)
        fresh = f"{folder}/v={uuid.uuid4().hex}"
        deal = self.partitioning(name)
        if deal is not None and "buckets" in deal and not beside:
            self._write_buckets(fresh, df, deal)
            return self._put_in_force(name, [fresh])
        if deal is None or "buckets" in deal:  # an append's batch is a plain part beside the buckets
            df.write.parquet(fresh)
            return self._put_in_force(name, [*beside, fresh])
        # Each slot's rows together, large slots split and small ones joined where the shuffle is read.
        dealt = df.withColumn(_SLOT, F.expr(self._slot(df, deal))).hint("rebalance", _SLOT)
        dealt.write.partitionBy(_SLOT).parquet(fresh)
        slots = sorted(entry for entry, _ in self._list(fresh) if entry.startswith(f"{_SLOT}="))
        if not slots and not beside:  # an empty table: its schema stands in a file without a slot
            df.limit(0).write.mode("overwrite").parquet(fresh)
            return self._put_in_force(name, [fresh])
        held = [part for part in beside if f"/{_SLOT}=" in part or not slots]
        return self._put_in_force(name, [*held, *[f"{fresh}/{slot}" for slot in slots]])

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: str | Sequence[str] | None = None,
        slots: int | None = None,
        bucket_by: str | Sequence[str] | None = None,
        buckets: int = 200,
    ) -> DataFrame:
        """Write a complete new version and put it in force; ``write(name, read(name))`` joins the parts of many appends.

        ``partition_by`` deals the table, from now on, into slots by these columns: one for each combination of their
        values, or ``slots`` of them by hash. An upsert or delete-insert then writes only slots that it touches. Choose
        columns that a batch has few values of (a day, a region); a table keeps its partitioning until told another.

        ``bucket_by`` writes whole versions, from now on, in ``buckets`` sorted by these columns instead: two versions, or
        tables with as many buckets, are then compared by them without a shuffle. That holds until an append; the next
        whole version is in buckets again.
        """
        if partition_by is not None and bucket_by is not None:
            raise ValueError(f"write: {name!r} can be dealt into slots or into buckets, not both")
        dealt = partition_by if bucket_by is None else bucket_by
        if dealt is not None:
            columns = [dealt] if isinstance(dealt, str) else list(dealt)
            missing = [c for c in columns if c not in df.columns]
            if missing:
                raise ValueError(f"write: no column {', '.join(missing)} to partition {name!r} by")
            fs, hadoop_path = self._file(self._table_folder(name))
            fs.mkdirs(hadoop_path)
            deal = {"columns": columns} | ({"slots": slots} if bucket_by is None else {"buckets": buckets})
            self._write_text(f"{self._table_folder(name)}/_partitioning", json.dumps(deal))
        return self._write_part(name, df, [])

    def partitioning(self, name: str) -> dict | None:
        """Columns and number of slots (None: one per combination of values) or buckets of a table that is dealt."""
        text = self._read_text(f"{self._table_folder(name)}/_partitioning")
        return None if text is None else json.loads(text)

    def _slot(self, df: DataFrame, deal: dict) -> str:
        """A row's slot: a hash of the typed values, so that any value (null and empty text too) names a folder."""
        first, _ = value_digest(df, deal["columns"])
        return f"hex({first})" if deal["slots"] is None else f"cast(pmod({first}, {deal['slots']}) as string)"

    def _touched(self, name: str, deal: dict, batch: DataFrame, keys: list[str], limits: Limits) -> list[str]:
        """Slots that hold, or will hold, rows with a key of the batch.

        Where the key decides the slot, the batch alone tells. Otherwise a row may move: the target's key and partition
        columns are read as well, and no others.
        """
        wanted = batch.select(F.expr(self._slot(batch, deal)).alias(_SLOT)).distinct()
        if not set(deal["columns"]) <= set(keys):
            target = self.read(name)
            needed = dict.fromkeys([*keys, *deal["columns"]])
            narrow = target.where(all_set(keys)).select(*[quoted(c) for c in needed])
            held = keys_in(narrow, batch, keys, limits).select(F.expr(self._slot(narrow, deal)).alias(_SLOT)).distinct()
            wanted = wanted.unionByName(held).distinct()
        # One short row per slot of the table at most.
        return [row[0] for row in wanted.collect()]

    def _load_slots(
        self, name: str, batch: DataFrame, unique_key: str | Sequence[str], strategy: str, order_by: str | None, limits: Limits
    ) -> DataFrame:
        """Upsert or delete-insert that rewrites the touched slots and keeps the folders of all others."""
        deal, parts = self.partitioning(name), self.parts(name)
        keys = key_list(unique_key, strategy)
        touched = {f"/{_SLOT}={slot}" for slot in self._touched(name, deal, batch, keys, limits)}
        # Only the part of an empty table has no slot.
        ours = [part for part in parts if any(part.endswith(end) for end in touched) or f"/{_SLOT}=" not in part]
        target = self._read_parts(ours) if ours else self.read(name).where("false")
        if strategy == "upsert":
            result = upsert(target, batch, keys, order_by, limits)
        else:
            result = delete_insert(target, batch, keys, limits)
        whole = self.read(name).schema
        if [f.dataType for f in result.schema] != [f.dataType for f in whole]:
            # The batch widens a column, which every file must follow.
            everything = self.read(name)
            result = upsert(everything, batch, keys, order_by, limits) if strategy == "upsert" else delete_insert(
                everything, batch, keys, limits
            )
            return self._write_part(name, result, [])
        return self._write_part(name, result, [part for part in parts if part not in set(ours)])

    def _append(self, name: str, target: DataFrame, batch: DataFrame) -> DataFrame:
        """Add the batch as a part of its own; the whole table is written anew only if the batch widens a column."""
        result = append(target, batch)
        if [f.dataType for f in result.schema] != [f.dataType for f in target.schema]:
            return self.write(name, result)
        types = {f.name: f.dataType for f in target.schema}
        rows = batch.select(*[ref(c).cast(t).alias(c) for c, t in types.items()])
        return self._write_part(name, rows, self.parts(name))

    def expire(self, name: str, unknown_after_seconds: int = 86_400) -> int:
        """Delete folders that neither the table nor any snapshot, whatever its suffix, points to; returns how many.

        A folder that was part of the table and left it goes at once. One that no pointer ever named belongs to a load
        in progress or to a failed one: it goes when it was last changed ``unknown_after_seconds`` ago or earlier.
        """
        folder = self._table_folder(name)
        pointers = [self._read_pointer(folder)]
        snapshots = f"{self.root}/{self.qa_schema}"
        pointers += [self._read_pointer(f"{snapshots}/{entry}") for entry, _ in self._list(snapshots)]

        def place(path: str) -> str:
            return path[path.rindex("v=") :] if "/v=" in path else path

        in_use = {place(path) for parts in pointers for path in parts or []}
        entries = self._list(folder)
        notes = [entry for entry, _ in entries if entry.startswith("_retired.")]
        retired = {place(line) for note in notes for line in (self._read_text(f"{folder}/{note}") or "").splitlines() if line}
        oldest = (time.time() - unknown_after_seconds) * 1000
        removed = 0
        for entry, changed in entries:
            if not entry.startswith("v="):
                continue
            used = {path for path in in_use if path == entry or path.startswith(f"{entry}/")}
            left = {path for path in retired - in_use if path == entry or path.startswith(f"{entry}/")}
            if not used and (left or changed < oldest):
                self._delete(f"{folder}/{entry}")
                removed += 1
            elif used and entry not in used:
                for path in left:
                    if self._exists(f"{folder}/{path}"):
                        self._delete(f"{folder}/{path}")
                        removed += 1
        kept = sorted(retired & in_use)
        if kept:
            self._write_text(f"{folder}/_retired.{uuid.uuid4().hex}", "\n".join(f"{folder}/{path}" for path in kept))
        for note in notes:
            self._delete(f"{folder}/{note}")
        return removed

    # -- snapshots ---------------------------------------------------------------------------------------

    def snapshot_name(self, name: str, suffix: str | None = None) -> str:
        return f"{self.qa_schema}.{name}{suffix or SNAPSHOT_SUFFIX}"

    def _snapshot_folder(self, name: str, suffix: str | None = None) -> str:
        return f"{self.root}/{self.qa_schema}/{name}{suffix or SNAPSHOT_SUFFIX}"

    def take_snapshot(self, name: str, suffix: str | None = None) -> None:
        """Make the table's present version its before-load snapshot."""
        self._write_pointer(self._snapshot_folder(name, suffix), self.parts(name))

    def snapshot_parts(self, name: str, suffix: str | None = None) -> list[str]:
        """The folders that make up the snapshot; an error when there is none."""
        parts = self._read_pointer(self._snapshot_folder(name, suffix))
        if parts is None:
            raise TableMissing(
                f"before-load snapshot {self.snapshot_name(name, suffix)} not found; load the table first"
            )
        return parts

    def read_snapshot(self, name: str, suffix: str | None = None) -> DataFrame:
        return self._read_parts(self.snapshot_parts(name, suffix))

    def load(
        self,
        name: str,
        batch: DataFrame,
        unique_key: str | list[str] | None = None,
        strategy: str = "upsert",
        full_refresh: bool = False,
        order_by: str | None = None,
        partition_by: str | Sequence[str] | None = None,
        slots: int | None = None,
        limits: Limits = DEFAULT_LIMITS,
    ) -> DataFrame:
        """Load a batch and keep the snapshot.

        An incremental load snapshots the table first. A first load or a full refresh writes the batch as the
        whole table and snapshots it afterwards. Strategies: ``upsert``, ``delete_insert``, ``append``. ``partition_by``
        and ``slots`` count where the whole table is written; see :meth:`write`. Later loads of a partitioned table
        write the slots that the batch touches.
        """
        if full_refresh or not self.exists(name):
            loaded = self.write(name, batch, partition_by, slots)
            self.take_snapshot(name)
            return loaded
        if strategy in ("upsert", "delete_insert") and "slots" in (self.partitioning(name) or {}):
            self.take_snapshot(name)
            return self._load_slots(name, batch, unique_key, strategy, order_by, limits)
        target = self.read(name)
        if strategy == "upsert":
            result = upsert(target, batch, unique_key, order_by, limits)
        elif strategy == "delete_insert":
            result = delete_insert(target, batch, unique_key, limits)
        elif strategy == "append":
            self.take_snapshot(name)
            return self._append(name, target, batch)
        else:
            raise ValueError(f"unknown load strategy {strategy!r}")
        self.take_snapshot(name)
        return self.write(name, result)

    # -- logs --------------------------------------------------------------------------------------------

    def log_path(self, name: str) -> str:
        return f"{self.root}/{self.log_schema}/{name}"

    def _run_folder(self, name: str, run: str) -> str:
        return f"{self.log_path(name)}/run={quote(run, safe='')}"

    def _record_schema(self, name: str, schema: T.StructType) -> None:
        """Keep a schema that the log's files have; each different one has a file of its own, so writers never meet."""
        text = json.dumps([json.loads(field.json()) for field in schema], sort_keys=True)
        path = f"{self.log_path(name)}/_schemas/{hashlib.sha256(text.encode()).hexdigest()[:32]}"
        if not self._exists(path):
            fs, folder = self._file(f"{self.log_path(name)}/_schemas")
            fs.mkdirs(folder)
            self._write_text(path, text)

    def log_schema_of(self, name: str) -> T.StructType | None:
        """All columns that appends to the log had, oldest schema first; None for a log without recorded schemas."""
        folder = f"{self.log_path(name)}/_schemas"
        fields: dict[str, T.StructField] = {}
        for entry, _ in sorted(self._list(folder), key=lambda found: (found[1], found[0])):
            for field in json.loads(self._read_text(f"{folder}/{entry}")) if not entry.startswith("_") else []:
                own = T.StructField.fromJson(field | {"nullable": True})
                known = fields.setdefault(own.name.lower(), own)
                if known.dataType != own.dataType:
                    raise ValueError(f"log {name!r}: column {own.name} was written as {known.dataType} and {own.dataType}")
        return T.StructType(list(fields.values())) if fields else None

    def ensure_log(self, name: str, schema: T.StructType) -> None:
        """Create an empty log with this schema unless there is one."""
        if not self._exists(self.log_path(name)):
            self._record_schema(name, schema)

    def append_log(self, name: str, rows: DataFrame, run: str | None = None) -> None:
        """Append by column name, into a folder of its own, so that writers never meet; columns that the log lacks
        are added to it.

        ``run`` names the append: repeating it replaces what it wrote before. The new rows are written out of sight
        first, so a run that fails on the way leaves the rows of the earlier attempt.
        """
        self._record_schema(name, rows.schema)
        if run is None:
            rows.write.parquet(self._run_folder(name, uuid.uuid4().hex))
            return
        hidden, shown = f"{self.log_path(name)}/_writing/{uuid.uuid4().hex}", self._run_folder(name, run)
        rows.write.parquet(hidden)
        fs, written = self._file(hidden)
        self._delete(shown)
        if not fs.rename(written, self._file(shown)[1]):
            raise RuntimeError(f"log {name!r}: the rows of run {run!r} could not be moved into place")

    def read_log(self, name: str, schema: T.StructType | None = None, run: str | None = None) -> DataFrame:
        """All appended rows, or those of one run, whose folder alone is then read; columns missing in older files are
        null. The schema is the recorded one: no file is opened to find it."""
        if not self._exists(self.log_path(name)):
            raise TableMissing(f"log {name!r} does not exist below {self.root}/{self.log_schema}")
        schema = schema or self.log_schema_of(name)
        path = self.log_path(name) if run is None else self._run_folder(name, run)
        reader = self.spark.read.option("recursiveFileLookup", True)
        if schema is None:  # a log from before schemas were recorded
            return reader.option("mergeSchema", True).parquet(path)
        empty = run is not None and not self._exists(path)
        return self.spark.createDataFrame([], schema) if empty else reader.schema(schema).parquet(path)

    # -- journals ----------------------------------------------------------------------------------------

    def write_journal(self, name: str, entry: str, row: dict) -> None:
        """Keep one row of a log in a small file until the log's own files have it; written by the driver, without a job."""
        folder = f"{self.log_path(name)}/_journal"
        fs, hadoop_path = self._file(folder)
        fs.mkdirs(hadoop_path)
        self._write_text(f"{folder}/{quote(entry, safe='')}", json.dumps(row))

    def read_journal(self, name: str) -> dict[str, dict]:
        """Rows by entry: a few per run that is under way or was cut off."""
        folder = f"{self.log_path(name)}/_journal"
        found = {}
        for entry, _ in self._list(folder):
            text = None if entry.startswith("_") else self._read_text(f"{folder}/{entry}")
            if text:
                found[entry] = json.loads(text)
        return found

    def clear_journal(self, name: str, entries: Sequence[str]) -> None:
        for entry in entries:
            self._delete(f"{self.log_path(name)}/_journal/{quote(entry, safe='')}")
