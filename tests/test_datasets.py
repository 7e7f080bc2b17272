import duckdb
import pytest
from pyspark.sql import functions as F

from docloom.functions import tools
from docloom.operators import points
from docloom.sources import sinks


def test_tools(spark):
    def lookup(word: str, limit: int = 3) -> str:
        """Looks a word up.
        ---
        str word: what to look up
        int limit: at most so many
        """
        return word * limit

    tool = tools.described(lookup)
    assert [(p.kind, p.required, p.default) for p in tool.parameters.values()] == [("str", True, None), ("int", False, 3)]
    assert [f.nullable for f in tool.schema()] == [False, True]
    assert tools.catalogue([tool]) == "AVAILABLE TOOLS:\n\nTool: lookup\nDescription: Looks a word up.\nParameters:\n  - word (str): what to look up [REQUIRED]\n  - limit (int): at most so many [optional (default: 3)]\n"
    assert tools.catalogue([]) == "No tools available."
    tools.register(spark, tool)
    assert spark.sql("select lookup('ab', 2) as x").first().x == "abab"

    def wrong(a):
        """Text.
        ---
        str b: other
        """

    for bad in (wrong, lambda: None):
        with pytest.raises(ValueError):
            tools.described(bad)


def test_links_follow_verdicts_by_place(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [(True, None, "t"), (False, "r", "t"), (True, "r", "t")]), (2, ["a", None], [(True, "r", None)]), (3, [], [(True, "r", "t")]), (4, ["a"], None)], "id long, texts array<string>, v array<struct<relates:boolean,relation:string,common_topic:string>>")
    made = points.set_links(points.points(F.col("texts")), "next_link", F.col("v"), F.lit(9), F.lit(4))
    rows = {r.id: r for r in df.select("id", made.alias("p"), points.first_link(made, "next_link").alias("first"), points.topics(made, "next_link").alias("topics"), points.embedding_text(F.lit("c"), made).alias("text")).collect()}
    assert [(p.text, p.next_link and tuple(p.next_link)) for p in rows[1].p] == [("a", (9, 4, "", "t")), ("b", None)]
    assert [(p.text, p.next_link and tuple(p.next_link)) for p in rows[2].p] == [("a", (9, 4, "r", "")), ("", None)]
    assert rows[3].p == [] and rows[3].text == "c" and rows[3].first is None and rows[4].p[0].next_link is None
    assert rows[1].text == "c\n\n\nKey Points:\n1. a\n   (Leads to:  regarding t)\n2. b\n" and rows[1].topics == ["t"]


def test_models_in_batches(spark):
    df = spark.createDataFrame([(k, None if k == 3 else f"text {k}. more") for k in range(70)], "id long, text string").coalesce(1)

    def model(text):
        if text.startswith("text 5"):
            raise OSError("down")
        return points.lead_sentences(text)

    got = {r.id: r.summary for r in points.summarise(df, "text", model, base=0.0).collect()}
    assert got[5] == points.FAILED and got[3] == [] and got[6] == ["text 6", "more"]

    def vectors(texts):
        assert len(texts) <= 32
        return [[float(len(t))] for t in texts]

    assert {r.id: r.embedding for r in points.embed(df, "text", vectors).collect()} == {k: [0.0 if k == 3 else float(len(f"text {k}. more"))] for k in range(70)}
    calls = []
    with pytest.raises(ZeroDivisionError):
        points.retrying(lambda: calls.append(1) or 1 / 0, base=0.0)
    assert len(calls) == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(f"d{k}.md", None if k == 1 else f"text {k}") for k in range(5)], "path string, text string")
    blocks = sinks.consolidated(df, "path", sinks.block(F.col("path"), F.lit(".md"), F.col("text"), F.lit("now")))
    sinks.write_consolidated(blocks, "path", str(tmp_path / "md"))
    whole = "".join(p.read_text() for p in sorted((tmp_path / "md").glob("part-*")))
    head = "# SOURCE: d{0}.md\n# TIMESTAMP: now\n# FORMAT: .md\n---\n"
    assert whole == sinks.SEPARATOR.join(head.format(k) + ("" if k == 1 else f"text {k}") for k in range(5)) + "\n"
    sinks.write_jsonl(df, str(tmp_path / "jsonl"))
    assert duckdb.sql(f"select count(*) from read_json('{tmp_path}/jsonl/*.json')").fetchall() == [(5,)]
    empty = sinks.consolidated(df.where("false"), "path", F.col("text"))
    assert empty.count() == 0
