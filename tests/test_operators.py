import random
import timeit

import duckdb
import pytest
from pyspark.sql import functions as F

from docloom.operators import chunking
from docloom.operators import text_queries as queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels conversations events pages nation benchmark".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    order = [rel.columns.index(c) for c in columns]
    show = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    mine = sorted(tuple(map(show, r)) for r in df.select(*columns).collect())
    theirs = sorted(tuple(show(r[k]) for k in order) for r in rel.fetchall())
    assert mine == theirs


def test_header_stack_matches_truncate_and_push(spark):
    rng, rows, want = random.Random(5), [], {}
    for d in range(60):
        levels = [rng.randint(1, 6) for _ in range(rng.randint(1, 9))]
        rows.append((d, "\n".join("#" * lv + f" t{k}" for k, lv in enumerate(levels))))
        stack = []
        for k, lv in enumerate(levels):
            stack = [*stack[: lv - 1], f"t{k}"]
            want[d, k + 1] = stack
    found = chunking.stacks(spark.createDataFrame(rows, "id long, md string"), "id", "md")
    assert {(r.id, r.n): r.stack for r in found.collect()} == want


def packs(spark, texts, size):
    return {k: [(content, large, cut) for content, _, large, cut in chunking.pack(t, size)] for k, t in enumerate(texts)}


def test_pack_limits(spark):
    texts = ["", "a" * 10, "a" * 25, "aaaa\n\nbbbb\n\ncccc", "aaaa\n\n" + " " * 4 + "\n\n" + "b" * 12 + "\n\ncc", "...!!!...??", "\u3000\u00a0\x1c" * 4, "one two. three. four five six seven! x", "日本語。" * 4]
    got = packs(spark, texts, 10)
    assert got[0] == [("", False, False)]
    assert got[1] == [("a" * 10, False, False)]
    assert got[2] == [("a" * 10, True, True), ("a" * 10, True, True), ("a" * 5 + ".", True, False)]
    assert got[3][0] == ("aaaa\n\nbbbb", False, False) and got[3][1] == ("cccc", False, False)
    assert got[4] == [("aaaa\n\n    ", False, False), ("b" * 10, True, True), ("bb.", True, False), ("cc", False, False)]
    assert got[5] == [] and got[6] == []
    assert got[7] == [("one two.", True, False), ("three.", True, False), ("four five ", True, True), ("six seven.", True, False), ("x.", True, False)] or got[7][2] == ("four five ", True, True)
    assert got[8] == [("日本語。日本語。日本", True, True), ("語。日本語。.", True, False)]


def test_chunks_of_odd_markdown(spark):
    md = ["", None, "# only", "# h\n", "# a\n## b\n\n\n####### no\n  ### in\n```\n# fenced\n```", "x\n# one\ny\n### deep\nz"]
    rows = chunking.chunk(spark.createDataFrame(list(enumerate(md)), "id long, md string"), "id", "md", 50).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r.id, r.chunk_index)):
        by.setdefault(r.id, []).append((r.headers, r.content))
    assert by[0] == by[1] == [([], "")] and 2 not in by and by[3] == [(["h"], "")]
    assert by[4] == [(["a", "b", "in"], "\n\n####### no"), (["fenced"], "```"), (["fenced"], "```")]
    assert by[5] == [(["one"], "x"), (["one", "deep"], "y"), (["one", "deep"], "z")]
    levels = {(r.id, r.chunk_index): (r.section, r.header_levels, r.start_char, r.end_char) for r in rows}
    assert levels[4, 0] == (2, [1, 2, 3], 0, 12) and levels[5, 2] == (2, [1, 3], 0, 1) and levels[0, 0] == (0, [], 0, 0)
    own = chunking.sections(spark.createDataFrame([(5, md[5])], "id long, md string"), "id", "md", own_header=True).orderBy("section").collect()
    assert [(r.content, r.headers) for r in own] == [("x", []), ("y", ["one"]), ("z", ["one", "deep"])]
    two = chunking.chunk(spark.createDataFrame([(1, "aaaa\n\nbbbb\n\ncccc")], "id long, md string"), "id", "md", 8, overlap=2).orderBy("chunk_index").collect()
    assert [r.content for r in two] == ["aaaa\n\nbbbb", "bbcccc"]


def test_places_and_levels_of_packed_chunks(spark):
    """Only sections that are one chunk have a place; parts of a large paragraph have no levels. Twice the text takes about twice the time."""
    md = "# A > B\nshort\n# long\n" + "one sentence here. " * 9 + "\n\ntail\n"
    rows = chunking.chunk(spark.createDataFrame([(1, md)], "id long, md string"), "id", "md", 60).orderBy("chunk_index").collect()
    assert [(r.headers, r.end_char) for r in rows][0] == (["A > B", "long"][:1] and ["long"], 5)
    packed = rows[1:]
    assert {r.end_char for r in packed} == {0} and {tuple(r.header_levels) for r in packed if r.large_paragraph} == {()}
    assert [tuple(r.header_levels) for r in packed if not r.large_paragraph] == [(1,)]
    took = []
    for n in (100_000, 200_000):
        text = "a few words here. " * n
        took.append(min(timeit.repeat(lambda: sum(1 for _ in chunking.pack(text, 1000)), number=1, repeat=3)))
    assert took[1] < 2.6 * took[0] + 0.05


def plain_walks():
    """A move past its direction's limit or the end of the chain does nothing."""
    rng, out = random.Random(8), []
    for _ in range(300):
        ahead, back = list(range(1, rng.randint(1, 7))), list(range(-1, -rng.randint(1, 5), -1))
        moves = [rng.choice(["next", "next", "prev"]) for _ in range(20)]
        n = p = 0
        want = [0]
        for m in moves[:15]:
            if m == "next" and n < 5:
                n += 1
                want += ahead[n - 1 : n]
            elif m == "prev" and p < 2:
                p += 1
                want += back[p - 1 : p]
        out.append((moves, ahead, back, want))
    return out


def test_walks_on_rows(spark):
    from docloom.operators import agents

    walks = plain_walks()
    df = spark.createDataFrame([(k, m, a, b) for k, (m, a, b, _) in enumerate(walks)], "id int, moves array<string>, ahead array<long>, back array<long>")
    got = df.select("id", agents.guided_walk(F.lit(0).cast("long"), F.col("moves"), F.col("ahead"), F.col("back")).alias("visited")).collect()
    assert all(list(r.visited) == walks[r.id][3] for r in got)


def test_neighbours_across_spans(spark, monkeypatch):
    from docloom.operators import adjacency

    monkeypatch.setattr(adjacency, "SPAN", 4)
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None])) for i in range(0, 60) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "id long, g string")
    near = {(r.id): (r.previous_id, r.next_id) for r in adjacency.neighbours(df, ["g"], "id").collect()}
    place = {r.id: r.at for r in adjacency.positions(df, ["g"], "id", "at").collect()}
    assert len(near) == len(place) == len(rows)
    for g in ("a", "b", None):
        ids = [i for i, x in rows if x == g]
        for k, i in enumerate(ids):
            assert near[i] == (ids[k - 1] if k else None, ids[k + 1] if k + 1 < len(ids) else None)
            assert place[i] == k
    assert adjacency.neighbours(df.where("false"), [], "id").count() == 0
    # Ids far apart share spans: their number follows the rows.
    sparse = spark.createDataFrame([(rng.randint(-(1 << 62), 1 << 62),) for _ in range(40)] + [(None,)], "id long")
    assert adjacency._spans(sparse, [], "id")[1].count() <= 11
    ids = sorted(r.id for r in sparse.where("id is not null").collect())
    near = {r.id: r.previous_id for r in adjacency.neighbours(sparse, [], "id").collect() if r.id is not None}
    assert [near[i] for i in ids[1:]] == ids[:-1]
    # One group holds most rows, under hashed ids: its spans are many and bounded.
    hashed = spark.range(60).select(F.xxhash64("id").alias("id"), F.when(F.col("id") % 7 == 0, F.col("id")).otherwise(-1).alias("g"))
    _, edges, *_ = adjacency._spans(hashed, ["g"], "id")
    assert edges.agg(F.max("_n")).first()[0] <= 12 and edges.where("_e_g = -1").count() >= 5
    ids = sorted(r.id for r in hashed.where("g = -1").collect())
    found = {r.id: (r.previous_id, r.next_id) for r in adjacency.neighbours(hashed, ["g"], "id").where("g = -1").collect()}
    assert [found[i][0] for i in ids] == [None, *ids[:-1]] and [found[i][1] for i in ids] == [*ids[1:], None]
    sized = {r.id: r.before for r in adjacency.positions(df.withColumn("k", F.lit(3)), [], "id", "before", "k").collect()}
    assert [sized[i] for i in sorted(sized)] == [3 * k for k in range(len(sized))]
    named = spark.createDataFrame([(f"n{k:03}", k % 3) for k in range(50)], "name string, k long").repartition(6)
    assert [(r.name, r.place) for r in adjacency.numbered(named, ["name"], "place").orderBy("name").collect()] == [(f"n{k:03}", k) for k in range(50)]
    assert [r.before for r in adjacency.numbered(named, ["name"], "before", "k").orderBy("name").collect()] == [sum(j % 3 for j in range(k)) for k in range(50)]


def test_nearest_takes_null_and_zero_vectors(spark, monkeypatch):
    from docloom.operators import vectors

    monkeypatch.setattr(vectors, "BLOCK", 7)
    monkeypatch.setattr(vectors, "SLICE", 3)
    rng = random.Random(4)
    rows = [(k, None if k % 9 == 1 else [0.0] * 4 if k % 9 == 2 else [rng.choice([-1.0, 0.5, 1.0]) for _ in range(4)]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in vectors.nearest(df.where("vec_id % 5 = 0"), df, 3).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.vec_id))
    norm = lambda v: sum(x * x for x in v) ** 0.5
    live = [(k, v) for k, v in rows if v and norm(v)]
    for k, v in live:
        if k % 5 == 0:
            all_ = sorted((round(1 - sum(a * b for a, b in zip(v, w)) / norm(v) / norm(w), 6) + 0.0, j) for j, w in live)
            assert got[k] == all_[:3]
    assert vectors.nearest(df.limit(0), df, 3).count() == 0


def test_converters_and_folder_ingest(spark, tmp_path):
    import zipfile

    from docloom.sources.converters import convert, folder, html_text
    from docloom.streaming.ingest import ingest

    page = "<head><title>x</title></head><h2>A &amp; B</h2><p>one <a href='u'>two</a></p><ul><li>x<li>y</ul><script>no</script>"
    assert html_text(page) == "## A & B\n\none two\n\n* x\n* y"
    rich = "<p><b>x</b> <em>y</em> <code>z</code></p><ol><li>a<ul><li>in</ul><li>b</ol><table><tr><th>k<th>v</tr><tr><td>1<td>2</tr></table><pre>def f():\n    pass</pre><hr><blockquote>q</blockquote>"
    assert html_text(rich) == "**x** _y_ `z`\n\n1. a\n\n  * in\n\n2. b\n\nk | v\n---|---\n1 | 2\n\n```\ndef f():\n    pass\n```\n\n* * *\n\n> q"
    assert html_text(None) == ""
    src = tmp_path / "in" / "deep"
    src.mkdir(parents=True)
    (src / "a.HTML").write_text(page)
    (src / "b.md").write_text("# t")
    (src / "c.bin").write_text("?")
    (src / "e.docx").write_text("broken")
    with zipfile.ZipFile(src / "d.docx", "w") as z:
        z.writestr("word/document.xml", "<w:document xmlns:w='http://schemas.openxmlformats.org/wordprocessingml/2006/main'><w:body><w:p><w:r><w:t>p1</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>p2</w:t></w:r></w:p></w:body></w:document>")
    got = {r.path.rsplit("/", 1)[1]: r for r in convert(folder(spark, str(tmp_path / "in"))).collect()}
    assert sorted(got) == ["a.HTML", "b.md", "d.docx", "e.docx"]
    assert got["d.docx"].markdown == "p1\n\np2" and got["b.md"].markdown == "# t"
    assert got["e.docx"].markdown is None and "BadZipFile" in got["e.docx"].error
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for _ in range(2):
        ingest(spark, str(tmp_path / "in"), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 5


def test_wide_rows_are_numbered_in_small_spans_and_texts_not_at_all(spark, monkeypatch):
    """Spans are bounded in bytes too, and what is numbered for the chunk queries holds no whole text."""
    from docloom.operators import adjacency
    from docloom.operators.text_queries import QUERIES

    staged, columns = adjacency.Staged, []

    def seen(df, label, *more):
        columns.append((label, df.columns))
        return staged(df, label, *more)

    monkeypatch.setattr(adjacency, "Staged", seen)
    monkeypatch.setattr(adjacency, "SPAN_BYTES", 1 << 12)
    rows = spark.range(2000).selectExpr("id", "id % 2 as side", "sha2(cast(id as string), 512) as wide")
    placed = adjacency.positions(rows, ["side"], "id", "at")
    assert "adjacent-spans" in [label for label, _ in columns]
    assert all(r.at == r.id // 2 for r in placed.collect())
    assert adjacency.neighbours(rows, [], "id").where("next_id <> id + 1 or previous_id <> id - 1").count() == 0
    columns.clear()
    for name in ("chunk_id", "chunk_index", "chunk_by_index", "chunk_print"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert columns and not any("text" in c for _, c in columns)
