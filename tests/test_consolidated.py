"""The consolidated file after several runs, byte by byte."""

import pytest
from pyspark.sql import functions as F

from docloom.config import IngestConfig
from docloom.plans.ingest import ingest
from docloom.sources import consolidated
from docloom.sources.store import Store

SEP = b"\n\n" + b"=" * 80 + b"\n\n"
SCHEMA = "path string, suffix string, markdown string"


def plain(runs):
    """Append each document to the file, a separator before it if the file is not empty."""
    out = b""
    for k, docs in enumerate(runs):
        for path, suffix, text in sorted(docs):
            out += (SEP if out else b"") + f"# SOURCE: {path}\n# TIMESTAMP: t{k}\n# FORMAT: {suffix}\n---\n{text or ''}".encode()
    return out


def test_runs_append_byte_by_byte(spark, tmp_path):
    runs = [[(f"a/{k}.md", ".md", "é\r\n" * k + "\n") for k in range(30)], [], [("0.txt", ".txt", "日本" * 50_000), ("z.md", ".md", None), ("ß.md", ".md", "")]]
    store = Store(spark, str(tmp_path / "s"))
    for k, docs in enumerate(runs):
        consolidated.append(store, spark.createDataFrame(docs, SCHEMA).repartition(3), f"run{k}", F.lit(f"t{k}"))
    want = plain(runs)
    parts = sorted(consolidated.blocks(store).collect(), key=lambda r: r.offset)
    for r in parts:
        assert want[r.offset : r.offset + r.length] == r.block.encode()
    assert sum(r.length for r in parts) == len(want) == store.next_number("consolidated")
    consolidated.export(store, str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    assert b"".join(f.read_bytes() for f in files) == want + b"\n"


def test_the_last_run_again(spark, tmp_path):
    store, docs = Store(spark, str(tmp_path / "s")), [("a.md", ".md", "one")]
    df = spark.createDataFrame(docs, SCHEMA)
    for run in ("x", "y", "y"):
        consolidated.append(store, df, run, F.lit("t0"))
    rows = consolidated.blocks(store).orderBy("offset").collect()
    assert [r.run for r in rows] == ["x", "y"] and "".join(r.block for r in rows).encode() == plain([docs]) + SEP + plain([docs])
    with pytest.raises(ValueError, match="followed"):
        consolidated.append(store, df, "x", F.lit("t0"))


def test_ingest_appends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("one")
    config = IngestConfig(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"), append=True)
    for _ in range(2):
        made = ingest(spark, config, lambda texts: [[1.0] for _ in texts], timestamp="t0")
    whole = b"".join(f.read_bytes() for f in sorted((tmp_path / "out" / "consolidated").glob("part-*")))
    assert whole.count(b"# SOURCE: ") == 2 and whole.count(SEP) == 1 and whole.endswith(b"---\none\n") and made["total_chunks"] == 1
