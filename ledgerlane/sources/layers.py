"""Tables kept by layer: raw, marts and scratch, each load in a directory of its own."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RAW, MARTS, SCRATCH = "raw", "marts", "scratch"

_COMMIT = "_commit-"
_LOAD = "load"


class Conflict(RuntimeError):
    """Another writer has changed the same partitions since this one read them."""


#: Writers of one process take turns at a table's next commit, since creating a local file that must
#: not exist is no single step; other file systems refuse the second one by themselves.
_COMMITTING = threading.Lock()


#: Rows of the largest table that one task of a shuffle, or one bucket, is to hold: sorting rows as wide
#: as the fact's then stays in memory.
TASK_ROWS = 250_000

#: Bytes of files that one task of such a session reads: rows a task keeps to combine equal ones, all of
#: them if none are equal, then stay in memory.
TASK_BYTES = 16 << 20

_READ_BYTES = "spark.sql.files.maxPartitionBytes"
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

#: The JVM does not compile methods of more bytes, and Spark then deals a stage over smaller ones.
LONGEST_METHOD, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def shuffle_partitions(spark: SparkSession) -> int:
    """Into how many partitions the session deals a shuffle before it puts small ones together."""
    return int(spark.conf.get(_FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def deal_for(spark: SparkSession, rows: int) -> None:
    """Have shuffles of this session begin with enough partitions for a table of so many rows.

    A fixed number gives tasks that grow with the table until they sort on disk. Never lowers it. Tasks
    that read files get ``TASK_BYTES`` at most then, and no stage runs in a method that is interpreted.
    """
    wanted = -(-rows // TASK_ROWS)
    if wanted > shuffle_partitions(spark):
        spark.conf.set(_FIRST_PARTITIONS, wanted)
        if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > TASK_BYTES:
            spark.conf.set(_READ_BYTES, TASK_BYTES)
        spark.conf.set(LONGEST_METHOD, COMPILED_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder for an application's tables: ``spark.checkpoint.dir``, else the warehouse folder.

    Both are reachable by all executors, in local mode and on a cluster alike.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


@dataclass
class _Pending:
    """What a block of held commits will make of a table, and the loads it has written for it."""

    state: dict | None
    steps: list[Callable[[dict | None], dict]] = field(default_factory=list)
    loads: list[str] = field(default_factory=list)

    def applied(self, state: dict | None) -> dict:
        number = state["number"] if state else 0
        for step in self.steps:
            state = {**step(state), "number": number}
        return state


@dataclass
class LayerStore:
    """Parquet tables under ``<root>/<layer>/<table>/load=<id>``.

    A load writes to a directory no reader knows and becomes visible by a numbered commit, a small file
    beside the loads that names the directories which make up the table. The next number can be made
    only once: a writer that comes second reads the new state and tries again, so no commit is lost;
    if both replace the same partitions, the second fails with ``Conflict``. Readers keep the state
    they were given, or ask for a number. A failed load leaves the former one in place. The newest
    commit and ``keep`` former ones stay; what only older ones name is deleted. ``publish`` also keeps
    a view ``<layer>.<table>`` in the catalog; ``transient`` deletes the root when the application ends.

    A table may be stored in buckets of a key. Two tables in as many buckets meet on their keys
    without a shuffle, and so does a window over the key. Spark knows buckets by the catalog alone, so
    such a load has an entry there, made when it is written or first read.

    Inside ``held`` commits are kept back: this store object reads what it has written, all others the
    former tables, until the block ends well.
    """

    spark: SparkSession
    root: str
    publish: bool = False
    keep: int = 1
    transient: bool = False
    fresh: set[tuple[str, str]] = field(default_factory=set)

    def __post_init__(self) -> None:
        path = self._path(self.root)
        self._files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if self.transient:
            self._files.deleteOnExit(path)

        self._held: frozenset[str] = frozenset()
        self._pending: dict[tuple[str, str], _Pending] = {}

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _table(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _names(self, folder: str) -> list[str]:
        return [status.getPath().getName() for status in self._files.listStatus(self._path(folder))]

    # state: {"number": ..., "schema": ..., "parts": [relative directories], "buckets": [number, key] or null}

    def _numbers(self, layer: str, table: str) -> list[int]:
        base = self._table(layer, table)
        if not self._files.exists(self._path(base)):
            return []
        return sorted(int(name[len(_COMMIT):-len(".json")]) for name in self._names(base) if name.startswith(_COMMIT))

    def _commit_file(self, layer: str, table: str, number: int):
        return self._path(f"{self._table(layer, table)}/{_COMMIT}{number:010d}.json")

    def _state(self, layer: str, table: str, number: int | None = None) -> dict | None:
        """The newest state, or the one of a commit."""
        pending = self._pending.get((layer, table))
        if pending and pending.steps and number in (None, pending.state["number"]):
            return pending.state
        while True:
            found = self._numbers(layer, table)
            if number is not None and number not in found:
                raise FileNotFoundError(f"no commit {number} of {layer}.{table} is kept")
            if not found:
                return None
            chosen = found[-1] if number is None else number
            try:
                stream = self._files.open(self._commit_file(layer, table, chosen))
            except Exception as gone:  # a newer commit has just had it deleted
                if number is not None or "FileNotFound" not in str(gone):
                    raise
                continue
            try:
                return json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()

    def version(self, layer: str, table: str) -> int:
        """The number of the newest commit, 0 if there is none."""
        return (self._numbers(layer, table) or [0])[-1]

    def _commit(self, layer: str, table: str, derive: Callable[[dict | None], dict]) -> None:
        """Make the state that ``derive`` gives for the newest one the next, again if another was first."""
        if layer in self._held:
            pending = self._waiting(layer, table)
            number = pending.state["number"] if pending.state else 0
            pending.state = {**derive(pending.state), "number": number}
            pending.steps.append(derive)
            self.fresh.add((layer, table))
            return
        while True:
            state = self._state(layer, table)
            number = state["number"] + 1 if state else 1
            new = {**derive(state), "number": number}
            if self._create(self._commit_file(layer, table, number), json.dumps(new).encode()):
                break
        self._forget(layer, table, number)
        self.fresh.add((layer, table))
        if self.publish and layer.isidentifier():  # not the scratch layer of one update
            self._publish(layer, table, StructType.fromJson(json.loads(new["schema"])), new["parts"])

    def _waiting(self, layer: str, table: str) -> _Pending:
        if (layer, table) not in self._pending:
            self._pending[layer, table] = _Pending(self._state(layer, table))
        return self._pending[layer, table]

    @contextmanager
    def held(self, *layers: str) -> Iterator[None]:
        """Write, check, then show: commits of these layers become visible at the end of the block.

        If the block fails, none does and what it wrote is deleted. At its end all conflicts with other
        writers are looked for before the first table is shown; then the tables follow one another,
        each by its own commit. A block inside another for the same layers is part of it.
        """
        if self._held:
            if not self._held.issuperset(layers):
                raise ValueError("a block inside another can hold no further layers")
            yield
            return
        self._held, known = frozenset(layers), set(self.fresh)
        hidden = self._pending = {}
        try:
            yield
            self._held, self._pending = frozenset(), {}
            for name, pending in hidden.items():
                if pending.steps:
                    pending.applied(self._state(*name))
            for name in list(hidden):
                pending = hidden[name]
                if pending.steps:
                    self._commit(*name, pending.applied)
                    named = {part.split("/")[0] for part in pending.state["parts"]}
                    pending.loads = [load for load in pending.loads if load not in named]
                self._delete(*name, hidden.pop(name).loads)
        except BaseException:
            self.fresh = known
            for name, pending in hidden.items():
                self._delete(*name, pending.loads)
            raise
        finally:
            self._held, self._pending = frozenset(), {}

    def _delete(self, layer: str, table: str, loads: Iterable[str]) -> None:
        for load in loads:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(load)}")
            self._files.delete(self._path(f"{self._table(layer, table)}/{load}"), True)

    def _create(self, file, content: bytes) -> bool:
        """Write a whole file under a name that must not exist; False if it does."""
        draft = self._path(f"{file.getParent()}/_{uuid.uuid4().hex}.json")
        out = self._files.create(draft)
        out.write(content)
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        with _COMMITTING:
            try:
                context.rename(draft, file, none)
                return True
            except Exception as taken:
                if "FileAlreadyExists" not in str(taken):
                    raise
        self._files.delete(draft, False)
        return False

    def _forget(self, layer: str, table: str, newest: int) -> None:
        """Delete commits that are no longer kept, and loads that only they name. Loads of writers that
        have not committed yet are named by none and stay."""
        old = [k for k in self._numbers(layer, table) if k < newest - self.keep]
        named = [self._state_or_none(layer, table, k) for k in old]
        kept = [self._state_or_none(layer, table, k) for k in self._numbers(layer, table) if k not in old]
        used = {part.split("/")[0] for state in kept if state for part in state["parts"]}
        for number, state in zip(old, named, strict=True):
            self._delete(layer, table, {part.split("/")[0] for part in state["parts"]} - used if state else ())
            self._files.delete(self._commit_file(layer, table, number), False)

    def _state_or_none(self, layer: str, table: str, number: int) -> dict | None:
        try:
            return self._state(layer, table, number)
        except Exception as gone:  # another writer deleted it
            if "no commit" in str(gone) or "FileNotFound" in str(gone):
                return None
            raise

    def _publish(self, layer: str, table: str, schema: StructType, parts: list[str]) -> None:
        columns = ", ".join(f"`{name}`" for name in schema.fieldNames())
        chosen = []
        for part in parts:
            pairs = [piece.split("=", 1) for piece in part.split("/")]
            chosen.append(" AND ".join(f"CAST(`{k}` AS STRING) = '{v}'" for k, v in pairs))
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {layer}.{table} AS SELECT {columns} "
            f"FROM parquet.`{self._table(layer, table)}` WHERE ({') OR ('.join(chosen) or 'false'})"
        )

    @staticmethod
    def _entry(load: str) -> str:
        """The catalog name of a load in buckets."""
        return f"ledgerlane_{load.split('=', 1)[1]}"

    def _written(self, layer: str, table: str, rows: DataFrame, partition_by: Sequence[str],
                 buckets: tuple[int, str] | None = None, as_they_lie: bool = False) -> tuple[str, int]:
        """Write one load; its name and row count, the count taken while writing."""
        load = f"{_LOAD}={uuid.uuid4().hex}"
        path = f"{self._table(layer, table)}/{load}"
        if layer in self._held:
            self._waiting(layer, table).loads.append(load)
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        if buckets:
            # rows that lie in these buckets already are not moved
            number, key = buckets
            writer = counted.repartition(number, key).write.mode("errorifexists").bucketBy(number, key).sortBy(key)
            writer.format("parquet").option("compression", "zstd").option("path", path).saveAsTable(self._entry(load))
            return load, seen.get["rows"]
        if partition_by and not as_they_lie:
            # rows of a partition meet in as few tasks as the advisory partition size allows, so
            # that not every task writes a small file for every partition
            counted = counted.hint("rebalance", *partition_by)
        writer = counted.write.mode("errorifexists").option("compression", "zstd")
        writer.partitionBy(*partition_by).parquet(path)
        return load, seen.get["rows"]

    def write(self, layer: str, table: str, rows: DataFrame, partition_by: Sequence[str] = (),
              bucket_key: str | None = None) -> int:
        """Store a full load and return its row count.

        With ``bucket_key`` it is stored in as many buckets as the session has shuffle partitions.
        """
        buckets = (shuffle_partitions(self.spark), bucket_key) if bucket_key else None
        load, count = self._written(layer, table, rows, partition_by, buckets)
        new = {"schema": rows.schema.json(), "parts": [load], "buckets": buckets}
        self._commit(layer, table, lambda _: new)
        return count

    def replace(self, layer: str, table: str, rows: DataFrame, column: str, values: Iterable, *,
                kept: DataFrame | None = None, since: int | None = None) -> int:
        """Replace the partitions of a stored table for these values of ``column`` by ``rows``.

        Only they are written; the others keep their files. Readers see the old table or the new.
        ``kept`` are further rows of these partitions that are only copied, so they are written as they
        lie, without a shuffle. ``since`` is the commit the rows were derived from, the newest if not
        given: other partitions may have been replaced in the meantime, these may not.
        """
        base = self._table(layer, table)
        since = self.version(layer, table) if since is None else since
        written = [self._written(layer, table, rows, (column,))]
        if kept is not None:
            written.append(self._written(layer, table, kept, (column,), as_they_lie=True))
        gone = {f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for value in values}
        before = set(self._partitions(base, self._state(layer, table, since)["parts"], column))

        def derive(state: dict) -> dict:
            now = self._partitions(base, state["parts"], column)
            moved = {part.split("/")[1] for part in before.symmetric_difference(now)} & gone
            if state["number"] != since and moved:
                raise Conflict(f"{layer}.{table}: {', '.join(sorted(moved))} changed since commit {since}")
            parts = [part for part in now if part.split("/")[1] not in gone]
            return {**state, "parts": parts + self._partitions(base, [load for load, _ in written], column)}

        self._commit(layer, table, derive)
        return sum(count for _, count in written)

    def _partitions(self, base: str, parts: Iterable[str], column: str) -> list[str]:
        """Directories of single partitions."""
        found = []
        for part in parts:
            found += [part] if "/" in part else [
                f"{part}/{name}" for name in self._names(f"{base}/{part}") if name.startswith(f"{column}=")
            ]
        return found

    def exists(self, layer: str, table: str) -> bool:
        """Whether the table is stored, by this store object or an earlier session."""
        return self._state(layer, table) is not None

    def written(self, layer: str, table: str) -> bool:
        """Whether this store object has loaded the table."""
        return (layer, table) in self.fresh

    def read(self, layer: str, table: str, number: int | None = None) -> DataFrame:
        """The newest load, or the one of a commit that is still kept. The schema is known from the
        write, so no file is opened to find it."""
        state, base = self._state(layer, table, number), self._table(layer, table)
        if state is None:
            raise FileNotFoundError(f"no table {layer}.{table} under {self.root}")
        schema = StructType.fromJson(json.loads(state["schema"]))
        if not state["parts"]:
            return self.spark.createDataFrame([], schema)
        paths = [f"{base}/{part}" for part in state["parts"]]
        if state.get("buckets"):
            return self._in_buckets(state["parts"][0], paths[0], schema, *state["buckets"])
        if len(paths) == 1 and "/" not in state["parts"][0]:
            return self.spark.read.schema(schema).parquet(*paths)
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return rows.select(*schema.fieldNames())

    def _in_buckets(self, load: str, path: str, schema: StructType, number: int, key: str) -> DataFrame:
        entry = self._entry(load)
        if not self.spark.catalog.tableExists(entry):
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {entry} ({columns}) USING parquet "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {number} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(entry)

    def drop(self, layer: str) -> None:
        """Delete a layer that no reader needs any more."""
        self._files.delete(self._path(f"{self.root}/{layer}"), True)
        self.fresh = {stored for stored in self.fresh if stored[0] != layer}

    def discard(self) -> None:
        """Delete the store's whole root; for stores that live as long as their application."""
        self._files.delete(self._path(self.root), True)
        self.fresh.clear()
