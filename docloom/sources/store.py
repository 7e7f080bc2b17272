"""The chunk store: collections of Parquet files that a manifest names, so that a write is seen as a whole or not at all.

A collection is a folder with ``data`` and ``manifest``. What a batch writes goes to a new folder under ``data``; it counts only once a new
manifest, the next number, names it. A manifest is written under another name and then renamed, which fails if a writer was
faster: that write starts again from the newer manifest. So a failed append leaves nothing that is read, and readers keep what they began with.

Rows have an id. A batch that comes again takes the place of its earlier self, and rows whose ids are in the store already, in whatever
batch, take the place of the older ones: batches that hold them are written anew without them. A batch remembers the number its rows begin
with; the next one goes on from the highest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_TRIES = 5


@dataclass(frozen=True)
class Batch:
    """One write: its name, the folder of its rows, how many they are, the numbers from ``start`` up to ``end`` that it took, and what else was
    counted when it was written."""

    name: str
    folder: str
    rows: int
    start: int
    end: int
    measures: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    schema: str | None = None
    batches: tuple[Batch, ...] = field(default=())

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Manifest:
        held = json.loads(text)
        return cls(held["version"], held["schema"], tuple(Batch(**b) for b in held["batches"]))


class Conflict(RuntimeError):
    """Other writers were faster, each time or while rows were numbered."""


class Store:
    """Collections under ``path``, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [x.getPath().getName() for x in self._files.listStatus(at)] if self._files.exists(at) else []

    def _root(self, collection: str) -> str:
        if not collection or "/" in collection or collection.startswith("."):
            raise ValueError(f"no name of a collection: {collection!r}")
        return f"{self.path}/{collection}"

    def manifest(self, collection: str) -> Manifest | None:
        """The newest manifest; None if there is no such collection."""
        names = [n for n in self._names(f"{self._root(collection)}/manifest") if n.endswith(".json") and not n.startswith(".")]
        if not names:
            return None
        stream = self._files.open(self._path(f"{self._root(collection)}/manifest/{max(names)}"))
        try:
            return Manifest.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, collection: str, made: Manifest) -> bool:
        """Put a manifest in place; False if its number is taken."""
        folder = f"{self._root(collection)}/manifest"
        draft, final = self._path(f"{folder}/.{uuid.uuid4().hex}"), self._path(f"{folder}/{made.version:012d}.json")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(made.text().encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, final, plain)  # fails if the number is taken
        except Exception:
            self._files.delete(draft, False)
            if self._files.exists(final):
                return False
            raise
        return True

    def get_or_create(self, collection: str) -> Manifest:
        """The collection's manifest; an empty collection is made if there is none."""
        for _ in range(_TRIES):
            found = self.manifest(collection)
            if found is not None:
                return found
            if self._commit(collection, Manifest(1)):
                return Manifest(1)
        raise Conflict(collection)

    def collections(self) -> dict[str, int]:
        """Rows of each collection, from the manifests alone."""
        found = {name: self.manifest(name) for name in self._names(self.path)}
        return {name: sum(b.rows for b in m.batches) for name, m in found.items() if m is not None}

    def read(self, collection: str) -> DataFrame:
        """The rows of a collection; ValueError if there is none, or nothing was ever written to it."""
        held = self.manifest(collection)
        if held is None or held.schema is None:
            raise ValueError(f"no collection {collection!r} with rows in {self.path}")
        return self._rows(collection, held, held.batches)

    def _rows(self, collection: str, held: Manifest, batches: tuple[Batch, ...]) -> DataFrame:
        schema = StructType.fromJson(json.loads(held.schema))
        folders = [f"{self._root(collection)}/{b.folder}" for b in batches]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def next_number(self, collection: str, batch: str | None = None) -> int:
        """Where the numbers of a batch begin: where they began if it was written before, else after all others."""
        held = self.manifest(collection) or Manifest()
        own = [b.start for b in held.batches if b.name == batch]
        return own[0] if own else max((b.end for b in held.batches), default=0)

    def put(self, collection: str, df: DataFrame, batch: str, key: str = "id", number: str | None = None, start: int | None = None, measures: dict[str, Column] | None = None) -> Batch:
        """Write a batch, as the class says. Of rows of the same ``key`` within the batch one stays, the one of least digest. ``number`` names the
        column of numbers, if there is one, and ``start`` the number they were made to begin with. Rows, and ``measures`` (aggregates), are
        counted while they are written."""
        root, folder = self._root(collection), f"data/{uuid.uuid4().hex}"
        least = F.xxhash64(*[F.to_json(F.struct(c)) if t.startswith(("map", "variant")) else F.col(c) for c, t in df.dtypes])
        single = df.withColumn("__least", least).groupBy(key).agg(F.min_by(F.struct(*df.columns), "__least").alias("r")).select("r.*")
        seen = Observation()
        top = F.max(F.col(number).cast("long")) if number else F.lit(None).cast("long")
        counted = [c.cast("long").alias(f"m_{name}") for name, c in (measures or {}).items()]
        single.observe(seen, F.count(F.lit(1)).alias("rows"), top.alias("top"), *counted).write.parquet(f"{root}/{folder}")
        rows, highest = seen.get["rows"], seen.get["top"]
        written = self.spark.read.parquet(f"{root}/{folder}")
        for _ in range(_TRIES):
            held = self.get_or_create(collection)
            before = [b for b in held.batches if b.name == batch]
            others = tuple(b for b in held.batches if b.name != batch)
            first = before[0].start if before else max((b.end for b in others), default=0)
            if start is not None and start != first:
                raise Conflict(f"{collection}: numbers begin with {first}, not {start}")
            end = first + rows if highest is None else max(first, highest + 1)
            others = self._without(collection, held, others, written.select(key), key)
            made = Batch(batch, folder, rows, first, end, {name: seen.get[f"m_{name}"] or 0 for name in measures or {}})
            if self._commit(collection, replace(held, version=held.version + 1, schema=json.dumps(df.schema.jsonValue()), batches=(*others, made))):
                return made
        raise Conflict(collection)

    def _without(self, collection: str, held: Manifest, batches: tuple[Batch, ...], keys: DataFrame, key: str) -> tuple[Batch, ...]:
        """The batches, those that hold any of ``keys`` written anew without them."""
        if not batches:
            return ()
        named = [self._rows(collection, held, (b,)).withColumn("__batch", F.lit(k)) for k, b in enumerate(batches)]
        every = named[0]
        for more in named[1:]:
            every = every.unionByName(more)
        hit = sorted(r[0] for r in every.join(keys, key, "left_semi").select("__batch").distinct().collect())  # batches, not rows
        if not hit:
            return batches
        folder = f"data/{uuid.uuid4().hex}"
        rest = every.where(F.col("__batch").isin(hit)).join(keys, key, "left_anti")
        rest.write.partitionBy("__batch").parquet(f"{self._root(collection)}/{folder}")
        counts = {}
        if self._names(f"{self._root(collection)}/{folder}") and any(n.startswith("__batch=") for n in self._names(f"{self._root(collection)}/{folder}")):
            counts = {r[0]: r[1] for r in self.spark.read.parquet(f"{self._root(collection)}/{folder}").groupBy("__batch").count().collect()}
        return tuple(b if k not in hit else replace(b, folder=f"{folder}/__batch={k}", rows=counts[k]) for k, b in enumerate(batches) if k not in hit or k in counts)

    def vacuum(self, collection: str) -> int:
        """Remove folders and manifests that the newest manifest does not need; returns how many folders went. No other writer may be at work."""
        held = self.manifest(collection)
        if held is None:
            return 0
        root, used = self._root(collection), {b.folder.split("/")[1] for b in held.batches}
        gone = [n for n in self._names(f"{root}/data") if n not in used]
        for name in gone:
            self._files.delete(self._path(f"{root}/data/{name}"), True)
        for name in self._names(f"{root}/manifest"):
            if name != f"{held.version:012d}.json":
                self._files.delete(self._path(f"{root}/manifest/{name}"), False)
        return len(gone)

    def drop(self, collection: str) -> None:
        self._files.delete(self._path(self._root(collection)), True)


def put_numbered(store: Store, collection: str, batch: str, make: Callable[[int], DataFrame], number: str, **more) -> Batch:
    """Write what ``make`` builds from the number the batch begins with; built anew if another writer took that number."""
    for k in range(_TRIES):
        start = store.next_number(collection, batch)
        try:
            return store.put(collection, make(start), batch, number=number, start=start, **more)
        except Conflict:
            if k == _TRIES - 1:
                raise
    raise Conflict(collection)
