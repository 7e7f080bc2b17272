import io
import json
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom import session
from docloom.config import DatasetConfig, IngestConfig, require_table
from docloom.operators import agents, points
from docloom.plans import dataset
from docloom.plans.ingest import ingest
from docloom.sources import reviews, sinks
from docloom.sources.converters import command, convert, folder
from docloom.sources.store import Store


def test_settings(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"input_dir": "in", "chunk_size": 7, "unknown": 1}))
    config = IngestConfig.load(str(path))
    assert (config.input_dir, config.chunk_size, config.formats[0]) == ("in", 7, ".pdf")
    with pytest.raises(ValueError, match="relate"):
        IngestConfig(link=True).check({"summary": len})
    assert DatasetConfig(data_source="pair").tools() == ["search_documentation", "get_linked_chunk", "search_codebase"]
    assert DatasetConfig(data_source="code").tools() == ["search_codebase"]
    with pytest.raises(ValueError):
        DatasetConfig(data_source="web").tools()
    with pytest.raises(ValueError, match="no table"):
        require_table(spark, str(tmp_path / "none"))


def test_shared_folder_is_named_on_a_cluster(spark, monkeypatch):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    named = {session.CHECKPOINT_KEY: "hdfs://x/y/", "spark.master": "yarn"}
    assert session.shared_dir(Session(**named)) == "hdfs://x/y"
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(Session(**{"spark.master": master}))
    own = Session(**{"spark.master": "local[4]", "spark.app.id": "a"})
    assert session.shared_dir(own) == session.shared_dir(own)


def slides(text, notes):
    out, a = io.BytesIO(), "xmlns:a='http://schemas.openxmlformats.org/drawingml/2006/main'"
    shown = lambda t: f"<x {a}><a:p><a:r><a:t>{t}</a:t></a:r></a:p></x>"
    with zipfile.ZipFile(out, "w") as z:
        for k, (t, n) in enumerate(zip(text, notes, strict=True), 1):
            z.writestr(f"ppt/slides/slide{k}.xml", shown(t))
            if n is not None:
                z.writestr(f"ppt/notesSlides/notesSlide{k}.xml", shown(n))
                z.writestr(f"ppt/slides/_rels/slide{k}.xml.rels", f"<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'><Relationship Id='r1' Target='../notesSlides/notesSlide{k}.xml'/></Relationships>")
    return out.getvalue()


def test_slide_notes_commands_and_empty_folders(spark, tmp_path):
    files = [("a.pptx", slides(["one", "two", "three"], ["say this", None, " "])), ("b.pdf", b"pages"), ("c.pdf", b"")]
    df = spark.createDataFrame([(p, bytearray(b)) for p, b in files], "path string, content binary")
    program = command(sys.executable, "-c", "import sys; d = sys.stdin.buffer.read(); sys.exit(3) if not d else print('# ' + d.decode())")
    got = {r.path: r for r in convert(df, {".pdf": program}).collect()}
    assert got["a.pptx"].markdown == "### Slide 1\none\n\nNotes:\nsay this\n\n### Slide 2\ntwo\n\n### Slide 3\nthree"
    assert got["b.pdf"].markdown == "# pages\n" and "CalledProcessError" in got["c.pdf"].error
    (tmp_path / "x.bin").write_text("?")
    (tmp_path / "y.htm").write_text("?")
    with pytest.raises(ValueError, match="no supported files"):
        folder(spark, str(tmp_path))


def test_ingest_keeps_what_it_has_seen(spark, tmp_path):
    src, calls = tmp_path / "in", tmp_path / "calls"
    src.mkdir(), calls.mkdir()
    (src / "b.md").write_text("# B\nfirst words. second words\n# C\nmore of it")
    (src / "a.txt").write_text("x" * 30 + "\n\n" + "y" * 30)
    (src / "c.docx").write_text("broken")

    def embed(texts):
        with open(calls / "n", "a") as f:
            f.write("".join(t + "\x00" for t in texts))
        return [[float(len(t)), 1.0] for t in texts]

    def relate(text, found, other):
        if other.startswith("first"):
            raise OSError("down")
        return [{"relates": True, "relation": "r", "common_topic": None}, {"relates": True}]

    config = IngestConfig(input_dir=str(src), output_dir=str(tmp_path / "out"), chunk_size=40, link=True, cache_dir=str(tmp_path / "cache"))
    models = {"summary": points.lead_sentences, "relate": relate}
    with pytest.raises(ValueError):
        ingest(spark, config, embed, {})
    made = ingest(spark, config, embed, models, timestamp="now")
    assert made["failed_files"] == 1 and made["total_chunks"] == 4 == made["chunks_with_summaries"]
    rows = sinks.decoded(Store(spark, made["store"]).read("docs"), "string").orderBy("chunk_index").collect()
    assert [r.chunk_index for r in rows] == [0, 1, 2, 3] and [r.document for r in rows] == ["x" * 30, "y" * 30, "first words. second words", "more of it"]
    link = lambda r, side: [p[side] and (p[side].chunk_index, p[side].relation) for p in r.summary_points]
    assert link(rows[0], "next_link") == [(1, "r")] and link(rows[1], "prev_link") == [(0, "r")] and link(rows[0], "prev_link") == [None]
    assert link(rows[2], "next_link") == [(3, "r"), (3, "")] and link(rows[3], "prev_link") == [None]
    whole = "".join(p.read_text() for p in sorted((tmp_path / "out" / "consolidated").glob("part-*")))
    assert whole.count("# SOURCE: ") == 2 and whole.index("a.txt") < whole.index("b.md")
    first = (calls / "n").read_text().split("\x00")[:-1]
    assert len(first) == 4
    (src / "0.md").write_text("new one")
    again = IngestConfig(input_dir=str(src), output_dir=str(tmp_path / "out2"), chunk_size=40, link=True, cache_dir=str(tmp_path / "cache"), cleanup_cache=True)
    made = ingest(spark, again, embed, models, timestamp="now")
    rows = sinks.decoded(Store(spark, made["store"]).read("docs"), "string").orderBy("chunk_index").collect()
    assert [r.document for r in rows][:2] == ["new one", "x" * 30] and len((calls / "n").read_text().split("\x00")[:-1]) <= 4 + 1 + 4
    assert not (tmp_path / "cache" / "markdown").exists()


def test_dataset_plan(spark, tmp_path):
    chunks = spark.createDataFrame([("c1", "one is. two is. three is"), ("c2", ""), ("c3", "alone")], "chunk_id string, content string")
    config = DatasetConfig(questions_per_chunk=3, easy_question_ratio=0.4)

    def answer(row):
        if "two" in row["question"]:
            raise OSError("down")
        return {"answer": row["question"].upper(), "trace": "t", "sources": ["z", row["chunk_id"]], "iterations": 1}

    def judge(row):
        return dict.fromkeys(agents.SCORES, 1.2 if "ALONE" in row["answer"] else 0.8)

    made = dataset.build(chunks, config, agents.first_questions, agents.keep_long, answer, judge, "now")
    rows = made.collect()
    assert [(r.id, r.question, r.question_type, r.source_chunks, r.metadata.rationale) for r in rows] == [("entry_0", "What is said by: one is", "easy", ["c1", "z"], "sentence 1")]
    assert abs(rows[0].quality_scores.overall - 0.8) < 1e-9
    assert agents.easy_count(10, 0.3) == 3 and agents.easy_count(7, 0.5) == 3
    sinks.write_json_array(made, "id", made.columns, str(tmp_path / "a"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*")))
    assert [e["id"] for e in json.loads(text)] == ["entry_0"]
    many = spark.range(57).select("id", F.when(F.col("id") % 2 == 0, "x").alias("v"))
    for df in (many, many.limit(0)):
        sinks.write_json_array(df, "id", df.columns, str(tmp_path / "b"))
        text = "".join(p.read_text() for p in sorted((tmp_path / "b").glob("part-*")))
        assert json.loads(text) == [{"id": r.id, "v": r.v} for r in df.orderBy("id").collect()]


def test_reviews(spark, tmp_path):
    samples = [("1", "q", "a", None), ("2", "q", "a", "flagged"), ("3", "q", "a", "approved")]
    items = reviews.load_items(spark, str(tmp_path / "none"), samples)
    assert items.count() == 3
    log = str(tmp_path / "log")
    empty = spark.createDataFrame([], reviews.CHANGES)
    assert not reviews.save_changes(empty, log)
    assert not reviews.save_changes(spark.createDataFrame([("1", 1, None, None, "t"), ("2", 2, "x", "x", "t")], reviews.CHANGES), log)
    assert reviews.save_changes(spark.createDataFrame([("1", 3, None, "approved", "t"), ("2", 4, "flagged", "rejected", "t")], reviews.CHANGES), log)
    assert reviews.save_changes(spark.createDataFrame([("1", 5, "approved", None, "t")], reviews.CHANGES), log)
    got = {r["_id"]: r.status for r in reviews.statuses(items, spark.read.parquet(log)).collect()}
    assert got == {"1": None, "2": "rejected", "3": "approved"}
    items.write.parquet(str(tmp_path / "items"))
    assert reviews.load_items(spark, str(tmp_path / "items"), []).count() == 3


def test_agent_rules_on_odd_rows(spark):
    rows = [(1, 0, "human", "ask", []), (1, 1, "ai", "", [("f", "{}"), (None, None)]), (1, 2, "tool", "r" * 600, []), (1, 3, "ai", "t", [("g", "1")]), (2, 0, "ai", None, None), (None, 1, "ai", "n", [("h", "2")])]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, content string, calls array<struct<name:string,args:string>>")
    steps = {(r.conv, r.step_number): r for r in agents.reasoning_steps(df, "conv", "turn").collect()}
    assert steps[1, 1].observation == steps[1, 2].observation == "r" * 500 + "..." and steps[1, 2].action == "unknown_tool" and steps[1, 1].thought == agents.DEFAULT_THOUGHT
    assert steps[1, 3].observation == "" and len(steps) == 4
    assert {r.conv for r in agents.synthesis_context(df, "conv", "turn").collect()} == {1, 2, None}
    assert agents.reasoning_steps(df.limit(0), "conv", "turn").count() == 0
    judged = agents.judged(spark.createDataFrame([(1,), (2,), (3,)], "id long"), lambda r: dict.fromkeys(agents.SCORES, {1: 0.5, 2: None, 3: -0.1}[r["id"]]), ["id"])
    assert {(r.id, r.status, r.overall) for r in judged.collect()} == {(1, "ok", 0.5), (2, "quarantined", None), (3, "quarantined", None)}

    def fails(row):
        raise ValueError("no")

    assert {r.status for r in agents.judged(spark.createDataFrame([(1,)], "id long"), fails, ["id"]).collect()} == {"error"}
