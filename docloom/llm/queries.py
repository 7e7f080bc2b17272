"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, dartminhash, media, mixing, ngram_lm, ordermin, pii, prefixtrie, quality, sharding, spelling, suffixdedup, toxicity
from docloom.llm.common import id_remainder
from docloom.session import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


# Production weights of the mixing query and stage: domains, languages and sources not listed weigh 1.
DOMAINS = 5
MIX_WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2}, "lang": {"en": 5, "de": 3, "fr": 3, "es": 2}, "source": {"src0": 2}}
MIX_FRACTION, MIX_EPOCHS, MIX_SEED = (3, 4), 2, 17


def mix_levels() -> dict[str, Column]:
    """A source's domain is fixed by its name."""
    source = F.coalesce(F.col("source"), F.lit(""))
    return {"domain": F.concat(F.lit("domain"), (F.conv(F.substring(F.md5(source), 1, 4), 16, 10).cast("int") % DOMAINS).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def op1_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.select(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_FRACTION, MIX_EPOCHS, MIX_SEED)
    return taken.select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"), F.col("mix_tokens").alias("n_tokens"), F.col("mix_budget").alias("budget"), F.col("mix_copies").alias("copies"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.compare_with_next(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ids = bpe.tokenise(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    back = bpe.detokenise(ids, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.classes(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels, folds=5, held_out=0))
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), folds=10, held_out=0)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.detect(table(spark, sf_dir, "documents"), redacted=False))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.train(docs, labels, folds=4, held_out=2))
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefixtrie.nodes(prefixtrie.rebuilt(table(spark, sf_dir, "conversations"), share))


#: Shards now, and with one more.
SHARDS, GROWN = sharding.layout(8), sharding.layout(9)


def op12_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS, GROWN)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_media_chunks, op2_mixing, op3_byte_bpe, op4_order_minhash, op5_dart_minhash, op6_toxicity, op7_elias_fano_lm, op8_pii, op9_suffix_dedup, op10_quality, op11_prefix_trie, op12_hash_tree, op13_spelling_variants)}


def _case(column: str, weights: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 1 END"


def _mixing_sql() -> str:
    """Water-filling level by level, then each leaf's epochs and prefix, in one statement."""
    levels, parts = ["domain", "lang", "source"], []
    for depth, level in enumerate(levels, 1):
        path, up = ", ".join(levels[:depth]), ", ".join(levels[: depth - 1])
        by = f"PARTITION BY {up}" if up else ""
        order = f"{by} ORDER BY cap / w, {level}"
        joined = f"c{depth} JOIN b{depth - 1} USING ({up})" if up else f"c{depth}, b0"
        parts.append(f"""
c{depth} AS (SELECT {path}, sum(supply * {MIX_EPOCHS})::DOUBLE AS cap, {_case(level, MIX_WEIGHTS[level])} AS w FROM leaf GROUP BY ALL),
l{depth} AS (SELECT *, (budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM {joined}),
w{depth} AS (SELECT *, max(CASE WHEN lev < cap / w THEN lev END) OVER ({by}) AS water FROM l{depth}),
b{depth} AS (SELECT {path}, CASE WHEN water IS NULL OR cap / w <= water THEN cap ELSE least(floor(greatest(water, 0) * w), cap) END::BIGINT AS budget FROM w{depth})""")
    return f"""
WITH doc AS (SELECT doc_id, 'domain' || (('0x' || substr(md5(coalesce(source, '')), 1, 4))::INTEGER % {DOMAINS}) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+'))::BIGINT AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply FROM doc GROUP BY ALL),
b0 AS (SELECT least(floor(sum(supply) * {MIX_FRACTION[0]} / {MIX_FRACTION[1]}), sum(supply) * {MIX_EPOCHS})::BIGINT AS budget FROM leaf),{",".join(parts)},
cut AS (SELECT *, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS full_passes, budget - CASE WHEN supply > 0 THEN budget // supply ELSE 0 END * supply AS rest FROM b3 JOIN leaf USING (domain, lang, source)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{MIX_SEED}:' || full_passes || ':' || coalesce(doc_id::VARCHAR, ''))) AS upto FROM doc JOIN cut USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, budget, (full_passes + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM run WHERE copies > 0"""


def _crc32_sql(text: str) -> str:
    """The checksum of a text's UTF-8 bytes, which DuckDB has no function for, as a fold over its hex digits."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    digits = f"hex(encode({text}))"
    code = f"list_transform(range(len({digits}) // 2), lambda i: ('0x' || substr({digits}, (2 * i + 1)::BIGINT, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code}), lambda c, b: xor(c >> 8, ({table}::BIGINT[])[xor(c & 255, b) + 1])), 4294967295)"


def _tree_sql(node, key: str) -> str:
    """The shard that a key gets in a tree, as nested cases."""
    if isinstance(node, tuple):
        return str(node[0])
    scores = {name: f"(-ln((('0x' || substr(md5('{name}/' || {key}), 1, 13))::BIGINT + 0.5) / {1 << 52}) / {sharding.weight(child)})" for name, child in sorted(node.items())}
    least = f"least({', '.join(scores.values())})"
    return "CASE " + " ".join(f"WHEN {score} = {least} THEN {_tree_sql(node[name], key)}" for name, score in scores.items()) + " END" if len(scores) > 1 else _tree_sql(*[(n, key) for n in node.values()][0])


def _sharding_sql() -> str:
    return f"""
WITH doc AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS text FROM documents),
sized AS (SELECT doc_id, key, strlen(text) + 1 AS size, {_crc32_sql("text")}::BIGINT AS text_crc32 FROM doc),
placed AS (SELECT *, ({_tree_sql(SHARDS, "key")})::INTEGER AS shard, ({_tree_sql(GROWN, "key")})::INTEGER AS grown_shard FROM sized)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5('slot/' || key || '/' || size || '/' || text_crc32), doc_id NULLS FIRST) - 1 AS slot, grown_shard FROM placed"""


def _trie_sql() -> str:
    """Every prefix of every rebuilt conversation by name, and sums over those it is a prefix of."""
    return f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, md5(length(role) || ':' || role || text) AS key, length(text) AS chars FROM said),
own AS (SELECT conv_id, list({{'key': key, 'chars': chars}} ORDER BY turn NULLS FIRST, key) AS turns FROM keyed GROUP BY conv_id),
part AS (SELECT conv_id, turns, ({_crc32_sql("conv_id::VARCHAR")} % 6)::BIGINT AS h FROM own),
built AS (SELECT p.conv_id, list_concat(coalesce(b.turns[1:p.h], []), p.turns[p.h + 1:]) AS turns FROM part p LEFT JOIN own b ON b.conv_id = p.conv_id - p.conv_id % 100),
prefix AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM built),
named AS (SELECT conv_id, depth, len(turns) AS upto, list_transform(turns[1:depth], lambda t: t.key) AS path, CASE WHEN depth > 0 THEN turns[depth].chars ELSE 0 END AS chars FROM prefix),
node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE upto = depth) AS ends FROM named GROUP BY path, depth),
child AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
whole AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (path)),
up AS (SELECT path[1:d] AS path, n_children, (n_convs - 1) * chars AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM whole)),
below AS (SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY path)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves, b.saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM whole w JOIN below b USING (path) LEFT JOIN node p ON w.depth > 0 AND p.depth = w.depth - 1 AND p.path = w.path[1:w.depth - 1]"""


def _spelling_sql() -> str:
    """Words by count; near pairs by what is left when a place is cut out; forms followed by recursion."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE run AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS word FROM documents),
folded AS (SELECT id, translate(word, '{upper}', '{upper.lower()}') AS word, count(*) AS n FROM run WHERE length(word) >= 7 GROUP BY ALL),
hashed AS (SELECT word, n, {_crc32_sql("id || ':' || word")} AS h FROM folded),
kept AS (SELECT CASE WHEN h % 31 = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n FROM hashed),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
place AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM place),
longer AS (SELECT DISTINCT c.word AS a, c.n AS an, v.word AS b, v.n AS bn FROM cut c JOIN vocab v ON c.rest = v.word),
near AS (SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a, b, bn FROM longer UNION ALL SELECT b, a, an FROM longer),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
form AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * v.n THEN r.near END AS form, CASE WHEN r.n >= 10 * v.n THEN r.n END AS form_n FROM vocab v LEFT JOIN ranked r ON r.word = v.word AND place = 1),
walk AS (SELECT word, word AS root, form AS next FROM form UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN form f ON f.word = w.next)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM form f JOIN walk w ON w.word = f.word AND w.next IS NULL"""


ORACLE_SQL: dict[str, str] = {"op2_mixing": _mixing_sql(), "op11_prefix_trie": _trie_sql(), "op12_hash_tree": _sharding_sql(), "op13_spelling_variants": _spelling_sql()}
