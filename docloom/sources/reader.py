"""A reader of one collection that remembers its chunks between calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from docloom.sources import sinks
from docloom.sources.store import Store


class ChunkReader:
    """Chunks of a collection, decoded and kept after the first scan, in memory or on the executors' disks. The collection must exist."""

    def __init__(self, store: Store, collection: str):
        if store.manifest(collection) is None:
            raise ValueError(f"no collection {collection!r} in {store.path}")
        self.store, self.collection = store, collection
        self._held: DataFrame | None = None
        self.version: int | None = None

    def chunks(self, force_reload: bool = False) -> DataFrame:
        """All chunks with numbers, lists and points as such. What a later write adds is seen after ``force_reload``, or when the store has grown and
        nothing was kept."""
        if self._held is None or force_reload:
            self.release()
            self.version = self.store.manifest(self.collection).version
            self._held = sinks.decoded(self.store.read(self.collection), "string").persist(StorageLevel.MEMORY_AND_DISK)
        return self._held

    def ordered(self, force_reload: bool = False) -> DataFrame:
        """The same in the order of their numbers."""
        return self.chunks(force_reload).orderBy("chunk_index", "id")

    def stale(self) -> bool:
        """Whether the store has a newer version than what is kept."""
        return self._held is not None and self.store.manifest(self.collection).version != self.version

    def release(self) -> None:
        if self._held is not None:
            self._held.unpersist()
        self._held = None
