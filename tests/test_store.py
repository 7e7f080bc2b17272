"""The chunk store: repeated and failed writes, ids that come again, numbers, writers at once; ingest and streams into it; caches."""

import pytest
from pyspark.sql import functions as F

from docloom.config import IngestConfig
from docloom.operators import sentences
from docloom.plans.ingest import RARE_TERMS, Models, ingest
from docloom.sources import sinks
from docloom.sources.cache import cached
from docloom.sources.reader import ChunkReader
from docloom.sources.store import Batch, Conflict, Manifest, Store
from docloom.streaming import ingest as streaming

SCHEMA = "id string, n long, v string"


def rows(df):
    return sorted((r.id, r.n, r.v) for r in df.collect())


def frame(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def test_batches_and_ids(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.manifest("c") is None and store.collections() == {}
    with pytest.raises(ValueError):
        store.read("c")
    assert store.get_or_create("c") == store.get_or_create("c") == Manifest(1)
    first = store.put("c", frame(spark, ("a", 0, "1"), ("b", 1, "1")), "one", number="n", measures={"ones": F.count_if(F.col("v") == "1")})
    assert (first.rows, first.start, first.end, first.measures) == (2, 0, 2, {"ones": 2})
    assert store.next_number("c") == 2 and store.next_number("c", "one") == 0
    store.put("c", frame(spark, ("c", 2, "2"), ("b", 3, "2")), "two", number="n")  # b comes again
    assert rows(store.read("c")) == [("a", 0, "1"), ("b", 3, "2"), ("c", 2, "2")]
    store.put("c", frame(spark, ("c", 2, "3"), ("b", 3, "3")), "two", number="n")  # the batch comes again
    assert rows(store.read("c")) == [("a", 0, "1"), ("b", 3, "3"), ("c", 2, "3")] and store.next_number("c") == 4
    store.put("c", frame(spark, ("a", 4, "4"), ("a", 4, "4")), "three", number="n")  # the last row of the first batch, twice
    assert rows(store.read("c")) == [("a", 4, "4"), ("b", 3, "3"), ("c", 2, "3")]
    assert [b.name for b in store.manifest("c").batches] == ["two", "three"] and store.collections() == {"c": 3}
    store.put("c", frame(spark), "none", number="n")
    assert store.vacuum("c") >= 4 and len(rows(store.read("c"))) == 3 and store.next_number("c") == 5
    with pytest.raises(ValueError):
        store.read("../c")
    store.drop("c")
    assert store.collections() == {}


def test_failed_and_rival_writes(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store.put("c", frame(spark, ("a", 0, "1")), "one", number="n")
    bad = frame(spark, ("z", 1, "1")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.put("c", bad, "two", number="n")
    assert rows(store.read("c")) == [("a", 0, "1")] and store.manifest("c").version == 2
    assert not store._commit("c", Manifest(2)) and not [n for n in store._names(f"{store.path}/c/manifest") if n.startswith(".") and not n.endswith(".crc")]
    rival, commit, seen = Store(spark, store.path), store._commit, []

    def slow(collection, made):
        if not seen:
            seen.append(rival.put("c", frame(spark, ("r", 1, "r")), "rival", number="n"))
        return commit(collection, made)

    monkeypatch.setattr(store, "_commit", slow)
    store.put("c", frame(spark, ("a", 5, "2")), "two", number="n")  # begins again from the rival's manifest
    assert rows(store.read("c")) == [("a", 5, "2"), ("r", 1, "r")]
    with pytest.raises(Conflict):
        store.put("c", frame(spark, ("q", 0, "2")), "late", number="n", start=1)
    assert isinstance(seen[0], Batch)


def embed(texts):
    return [[float(len(t)), 1.0] for t in texts]


def stored(store):
    return sorted((int(r.chunk_index), r.id, r.document, r.headers, r.start_char, r.end_char, r.header_levels, r.part_of_large_para, r.truncated, r.summary_points) for r in store.read("docs").collect())


def folder_of(tmp_path, *names):
    (tmp_path / "in").mkdir(exist_ok=True)
    for name in names:
        (tmp_path / "in" / name).write_text({"a.md": "# A > B\nshort", "b.txt": "x" * 70 + ". more words here to pack", "c.md": "no headers", "d.docx": "broken", "e.md": "# t\n### u\nlast", "f.bin": "?"}[name])
    return IngestConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), chunk_size=40)


def test_ingest_twice_gives_the_same_store(spark, tmp_path):
    config = folder_of(tmp_path, "a.md", "b.txt", "c.md", "d.docx")
    made = ingest(spark, config, embed)
    assert (made["failed_files"], made["total_chunks"], made["chunks_with_summaries"], made["failed_links"]) == (1, 5, 0, 0)
    first = stored(Store(spark, made["store"]))
    assert [r[2:9] for r in first] == [
        ("short", '["A > B"]', "0", "5", "[1]", False, False),
        ("x" * 40, "[]", "0", "0", "[]", True, True),
        ("x" * 30 + ".", "[]", "0", "0", "[]", True, False),
        ("more words here to pack.", "[]", "0", "0", "[]", True, False),
        ("no headers", "[]", "0", "10", "[]", False, False),
    ]
    again = ingest(spark, config, embed)
    assert again["total_chunks"] == 5 and stored(Store(spark, made["store"])) == first
    decoded = sinks.decoded(Store(spark, made["store"]).read("docs"), "string").orderBy("chunk_index").first()
    assert (decoded.headers, decoded.header_levels, decoded.end_char) == (["A > B"], [1], 5)


def test_links_in_batches_with_failing_calls(spark, tmp_path):
    config = IngestConfig(**{**folder_of(tmp_path, "b.txt").__dict__, "link": True})

    def relate(text, found, other):
        if other.startswith("more"):
            raise OSError("down")
        return [{"relates": True, "relation": "r", "common_topic": "t"}]

    made = ingest(spark, config, embed, {"summary": lambda text: [text[:3]], "relate": relate})
    assert made["chunks_with_summaries"] == 3 and made["failed_links"] == 1
    points = [r.summary_points for r in sinks.decoded(Store(spark, made["store"]).read("docs"), "string").orderBy("chunk_index").collect()]
    assert [(p[0].prev_link and p[0].prev_link.chunk_index, p[0].next_link and p[0].next_link.chunk_index) for p in points] == [(None, 1), (0, None), (1, None)]


def test_links_by_rare_terms(spark, tmp_path):
    """A summary of ranked sentences, relations by terms that few chunks share: no model server at all."""
    (tmp_path / "in").mkdir()
    for k, text in enumerate(["# one\nThe kestrel hovers over meadows.\n# two\nA kestrel eats voles here.\n# three\nNothing shared at all.", *["Plain filler words."] * 5]):
        (tmp_path / "in" / f"{k}.md").write_text(text)
    config = IngestConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), link=True)
    made = ingest(spark, config, embed, {"summary": sentences.ranked, "relate": RARE_TERMS})
    rows = sinks.decoded(Store(spark, made["store"]).read("docs"), "string").orderBy("chunk_index").collect()
    first, second, third = (r.summary_points[0] for r in rows[:3])
    assert (first.next_link.chunk_index, first.next_link.relation, first.next_link.common_topic) == (1, "shares 1 rare terms", "kestrel")
    assert second.prev_link.chunk_index == 0 and second.next_link is None and third.prev_link is None and first.text == "The kestrel hovers over meadows."
    assert made["failed_links"] == 0 and made["total_chunks"] == 8


def test_a_stream_killed_and_started_again(spark, tmp_path, monkeypatch):
    """Files come in two waves; the second batch is stored but its end is not recorded, so it comes again: the store is that of one run."""
    config, models = folder_of(tmp_path, "a.md", "b.txt"), Models(embed)
    run = lambda: streaming.ingest_to_store(spark, config, models, str(tmp_path / "check")).awaitTermination()
    run()
    folder_of(tmp_path, "c.md", "d.docx", "e.md", "f.bin")
    real, puts = streaming.store_batch, []

    def dies(*args):
        puts.append(real(*args))
        raise RuntimeError("killed")

    monkeypatch.setattr(streaming, "store_batch", dies)
    with pytest.raises(Exception, match="killed"):
        run()
    assert len(puts) == 1
    monkeypatch.setattr(streaming, "store_batch", real)
    run()
    run()  # nothing new
    whole = ingest(spark, IngestConfig(**{**config.__dict__, "output_dir": str(tmp_path / "whole")}), embed)
    place = lambda store: [(r[0], *r[2:]) for r in stored(store)]  # noqa: E731  ids name paths, which streams and batches write alike or not
    assert place(Store(spark, f"{config.output_dir}/store")) == place(Store(spark, whole["store"]))
    assert len({r[1] for r in stored(Store(spark, f"{config.output_dir}/store"))}) == 6


def test_caches_keep_one_row_a_key(spark, tmp_path):
    df, path = spark.createDataFrame([("a",), ("b",), ("b",)], "t string"), str(tmp_path / "cache")
    step = lambda rows: rows.withColumn("n", F.length("t"))
    (tmp_path / "cache" / "_temporary").mkdir(parents=True)  # a first write that was stopped
    for _ in range(2):
        assert cached(df, path, ["t"], step, ["n"]).count() == 3
    spark.read.parquet(path).write.mode("append").parquet(path + "2")
    for _ in range(2):
        spark.read.parquet(path).write.mode("append").parquet(path + "2")  # two runs at once
    assert sorted(map(tuple, cached(df, path + "2", ["t"], step, ["n"]).collect())) == [("a", 1), ("b", 1), ("b", 1)]


def test_reader_keeps_its_chunks(spark, tmp_path):
    config = folder_of(tmp_path, "a.md", "c.md")
    made = ingest(spark, config, embed)
    store = Store(spark, made["store"])
    with pytest.raises(ValueError, match="no collection"):
        ChunkReader(store, "other")
    reader = ChunkReader(store, "docs")
    assert reader.chunks() is reader.chunks() and reader.chunks().is_cached and not reader.stale()
    assert [r.document for r in reader.ordered().collect()] == ["short", "no headers"]
    folder_of(tmp_path, "e.md")
    ingest(spark, config, embed)
    assert reader.stale() and reader.chunks().count() == 2
    assert reader.chunks(force_reload=True).count() == 3 and not reader.stale()
    assert [r.headers for r in reader.ordered().collect()] == [["A > B"], [], ["t", "u"]]
    reader.release()


def test_contents_are_staged_once(spark, tmp_path, monkeypatch):
    """What is embedded is worked out from the staged chunks, not written beside them."""
    from docloom.config import IngestConfig
    from docloom.plans import ingest
    from docloom.sources.store import Store

    staged, columns = ingest.Staged, {}

    def seen(df, label, *more):
        columns[label] = df.columns
        return staged(df, label, *more)

    monkeypatch.setattr(ingest, "Staged", seen)
    files = spark.createDataFrame([("a.md", "# t\nsome words. more words.")], "path string, markdown string")
    store = Store(spark, str(tmp_path / "store"))
    ingest.store_batch(store, "b", files, IngestConfig(chunk_size=400), ingest.Models(lambda texts: [[float(len(t))] for t in texts]))
    assert "content" in columns["chunks"] and "embedded_text" not in columns["chunks"]
    row = store.read(IngestConfig().collection).first()
    assert row.embedding == [float(len(row.document))]
