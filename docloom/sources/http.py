"""A collection behind an HTTP address as a Spark source and sink: pages are read by many tasks, changes saved in one batch.

Reading: ``GET {url}/dataset/{collection}`` gives the whole collection as a JSON array; with option ``page_size`` the address gets ``offset`` and
``limit``, and its answer is {"total", "items"}: one partition a page. Writing: ``POST {url}/dataset/{collection}/batch-verify`` with {"changes"}, and
beside them "batch" and "part", so that a server can tell a part that comes again; when all parts are there, or if one is lost, the driver posts
{"batch", "parts", "commit"} or {"batch", "abort"} with no changes.

Defined results: an item's fields other than ``_id``, ``question``, ``answer`` and ``verified`` are in ``more``, as text, values that are no text as JSON; missing
ones are null; a request that keeps failing fails the job (``load`` then gives the sample rows); rows of a null item are changes of none and are
left out; no changes post nothing.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from docloom.operators.points import retrying

FORMAT = "docloom_http"
# The fields of an item and of a change, and the addresses of a collection.
FIELDS = ("_id", "question", "answer", "verified")
ITEMS = "_id string, question string, answer string, verified string, more map<string,string>"
CHANGES = "item_id string, old string, new string, timestamp string"
DATASET, SAVE = "/dataset/{}", "/dataset/{}/batch-verify"


def _ask(address: str, body: dict | None, tries: int, wait: float) -> object:
    """The JSON answer to a request, tried again while it fails."""

    def once() -> object:
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(address, data, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=60) as answer:  # noqa: S310 - the address is the user's
            return json.loads(answer.read() or b"null")

    return retrying(once, tries=tries, base=wait)


@dataclass
class _Options:
    address: str
    save: str
    page_size: int | None
    tries: int
    wait: float

    @classmethod
    def of(cls, options: dict) -> _Options:
        held = {k.lower(): v for k, v in options.items()}
        for name in ("url", "collection"):
            if not held.get(name):
                raise ValueError(f"option {name} is missing")
        url, collection = held["url"].rstrip("/"), urllib.parse.quote(held["collection"], safe="")
        return cls(url + DATASET.format(collection), url + SAVE.format(collection), int(held["page_size"]) if held.get("page_size") else None, int(held.get("tries", 3)), float(held.get("wait", 1.0)))


@dataclass
class _Page(InputPartition):
    offset: int | None


class _Reader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def _page(self, offset: int, limit: int) -> dict:
        return _ask(f"{self.options.address}?{urllib.parse.urlencode({'offset': offset, 'limit': limit})}", None, self.options.tries, self.options.wait)

    def partitions(self) -> list[InputPartition]:
        size = self.options.page_size
        if size is None:
            return [_Page(None)]
        return [_Page(k) for k in range(0, int(self._page(0, 0)["total"]), size)] or [_Page(0)]

    def read(self, page: _Page) -> Iterator[tuple]:
        if page.offset is None:
            items = _ask(self.options.address, None, self.options.tries, self.options.wait)
        else:
            items = self._page(page.offset, self.options.page_size)["items"]
        text = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
        for item in items:
            yield (*(text(item.get(f)) for f in FIELDS), {k: text(v) for k, v in item.items() if k not in FIELDS})


@dataclass
class _Part(WriterCommitMessage):
    part: str
    changes: int


class _Writer(DataSourceWriter):
    def __init__(self, options: _Options):
        self.options, self.batch = options, uuid.uuid4().hex

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        part = str(TaskContext.get().partitionId())  # the same if the task runs again
        changes = [{"itemId": r.item_id, "old": r.old, "new": r.new, "timestamp": r.timestamp} for r in rows if r.item_id is not None]
        if changes:
            _ask(self.options.save, {"changes": changes, "batch": self.batch, "part": part}, self.options.tries, self.options.wait)
        return _Part(part, len(changes))

    def commit(self, messages: list) -> None:
        parts = [m.part for m in messages if m is not None and m.changes]
        if parts:
            _ask(self.options.save, {"changes": [], "batch": self.batch, "parts": parts, "commit": True}, self.options.tries, self.options.wait)

    def abort(self, messages: list) -> None:
        _ask(self.options.save, {"changes": [], "batch": self.batch, "abort": True}, self.options.tries, self.options.wait)


class CollectionSource(DataSource):
    """Options: url, collection, page_size (the whole collection at once if not given), tries, wait (seconds before the second try)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ITEMS

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(_Options.of(self.options))

    def writer(self, schema: object, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("changes are only ever added")
        return _Writer(_Options.of(self.options))


def collection(spark: SparkSession, url: str, name: str, **options: object) -> DataFrame:
    """The items of a collection: _id, question, answer, verified, more."""
    spark.dataSource.register(CollectionSource)
    return spark.read.format(FORMAT).options(url=url, collection=name, **options).load()


def load(spark: SparkSession, url: str, name: str, samples: list[tuple], **options: object) -> DataFrame:
    """The items of a collection, or ``samples`` (rows of ``ITEMS``) where it can't be read or is empty."""
    try:
        items = collection(spark, url, name, **options)
        if not items.isEmpty():
            return items
    except (PySparkException, OSError, ValueError):
        pass
    return spark.createDataFrame(samples, ITEMS)


def save(changes: DataFrame, url: str, name: str, **options: object) -> bool:
    """Post changes (item_id, old, new, timestamp) as one batch; nothing is posted, and False returned, if there are none that change anything."""
    real = changes.where(~F.col("old").eqNullSafe(F.col("new"))).select(*[F.col(c).cast("string").alias(c) for c in ("item_id", "old", "new", "timestamp")])
    if real.isEmpty():
        return False
    changes.sparkSession.dataSource.register(CollectionSource)
    real.write.format(FORMAT).mode("append").options(url=url, collection=name, **options).save()
    return True
