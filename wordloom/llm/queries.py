"""Queries of the numbered operators over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def sha256(text) -> F.Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


_LINES = r"""
WITH line AS (
  SELECT doc_id, i, t[i] AS line,
         lower_az(regexp_replace(t[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents), range(1, len(t) + 1) AS r(i)
), owner AS (
  SELECT key, min(doc_id) AS owner FROM line WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM line LEFT JOIN owner USING (key) GROUP BY doc_id
""".replace("lower_az(", "translate(").replace(", '', 'g')) AS key", ", '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key")


@query(_LINES)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.line_dedup import dedup_lines

    return dedup_lines(_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


@query()
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wordloom.llm.bpe import encode

    coded = encode(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"),
    )


@query()
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.mixing import mix

    mixed = mix(_documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.sharding import shards

    text = F.coalesce("text", F.lit(""))
    sized = _documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    placed = shards(sized, ["doc_id"], 8, ["doc_id", "text_crc32", "size"], ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.quality import BASE, STANDARD, ledger, passes

    return ledger(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"), (passes(BASE) & passes(STANDARD)).alias("kept"),
    )


_TOP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query(_TOP5)
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.topk import quantized, top_k

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", quantized("embedding").alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.secrets import BASE_RULES, scan
    from wordloom.plans.stages import new_folder

    found = scan(_documents(spark, sf_dir), new_folder(spark, "secret_ledger"))
    base = F.filter("spans", lambda s: s["rule_no"] < len(BASE_RULES))

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[counted(rule.kind) for rule in BASE_RULES],
        sha256(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.toxicity import fit, held_out, score

    docs = _documents(spark, sf_dir)
    index = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, index).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query()
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.suffix_dedup import dedup_passages

    return dedup_passages(_documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.jaccard_join import Measure, near_duplicates

    return near_duplicates(_documents(spark, sf_dir), Measure(words=4, percent=85))


_MERKLE = """
WITH RECURSIVE rows AS (
  SELECT doc_id, source, CAST(doc_id AS VARCHAR) AS d,
    coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM documents
), summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(d, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS crc
  FROM rows
), leaf AS (
  SELECT doc_id, source, sha256(strlen(d) || ':' || d || head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(strlen(d) || ':' || d || head || CASE WHEN text IS NULL THEN '-' WHEN crc % 5 = 0 THEN strlen(lowered) || ':' || lowered ELSE strlen(text) || ':' || text END) AS claimed
  FROM summed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaf
), lower_level AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM lower_level WHERE n > 1 GROUP BY tree, lvl, pos // 16
), subroots AS (SELECT tree, lvl, digest FROM lower_level WHERE n = 1
), upper_level AS (
  SELECT 0 AS lvl, tree AS pos, count(*) OVER () AS n, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_level WHERE n > 1 GROUP BY lvl, pos // 16
), runs AS (
  SELECT tree, lvl, pos // 16 AS run, string_agg(digest, '' ORDER BY pos) AS digests FROM lower_level WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, lvl, pos // 16, string_agg(digest, '' ORDER BY pos) FROM upper_level WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT doc_id, p.pos, p.tree, r.lvl, digests[1 : 64 * ((p.pos // (16 ** r.lvl)::BIGINT) % 16)] AS a, digests[64 * ((p.pos // (16 ** r.lvl)::BIGINT) % 16) + 65 :] AS b
  FROM placed p JOIN runs r ON r.tree = p.tree AND r.run = p.pos // (16 ** (r.lvl + 1))::BIGINT
  UNION ALL
  SELECT doc_id, p.pos, p.tree, 1000 + r.lvl, digests[1 : 64 * ((p.tree // (16 ** r.lvl)::BIGINT) % 16)], digests[64 * ((p.tree // (16 ** r.lvl)::BIGINT) % 16) + 65 :]
  FROM placed p JOIN runs r ON r.tree = -1 AND r.run = p.tree // (16 ** (r.lvl + 1))::BIGINT
), paths AS (
  SELECT tree, pos, string_agg(a || b, '' ORDER BY lvl) AS siblings, list({'a': a, 'b': b} ORDER BY lvl) AS path FROM steps GROUP BY tree, pos
), folded AS (
  SELECT p.tree, p.pos, 0 AS i, claimed AS now, path FROM placed p LEFT JOIN paths USING (tree, pos)
  UNION ALL
  SELECT tree, pos, i + 1, sha256(path[i + 1].a || now || path[i + 1].b), path FROM folded WHERE i < coalesce(len(path), 0)
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, u.digest AS root, sha256(coalesce(siblings, '')) AS proof_sha256, f.now AS folded_root, f.now = u.digest AS verified
FROM placed p JOIN subroots s USING (tree) JOIN (SELECT digest FROM upper_level WHERE n = 1) u ON true
JOIN folded f ON f.tree = p.tree AND f.pos = p.pos AND f.i = coalesce(len(f.path), 0) LEFT JOIN paths q ON q.tree = p.tree AND q.pos = p.pos
"""


@query(_MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.merkle import build, leaf_digest, proofs

    docs = _documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    columns = ["doc_id", "source", "lang", "n_chars"]
    claimed = F.when(tampered, leaf_digest(*columns, lowered))
    manifest = build(docs, F.col("source"), [F.col("doc_id")], F.col("doc_id"), leaf_digest(*columns, "text"), claimed)
    if manifest is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return proofs(manifest).withColumnRenamed("id", "doc_id")


_NEAR_VECTORS = """
WITH RECURSIVE fit AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
"""


@query(_NEAR_VECTORS)
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.embedding_dedup import near_vectors

    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.98)
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


_PHRASES = r"""
WITH piece AS (
  SELECT lang, row_number() OVER () AS piece, p FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), tokens AS (
  SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT lang, piece, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece)
), followed AS (
  SELECT lang, w AS w1, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM tokens WINDOW o AS (PARTITION BY piece ORDER BY i)
), n AS (SELECT lang, count(*) AS n FROM tokens GROUP BY lang
), f1 AS (SELECT lang, w1, count(*) AS a FROM followed GROUP BY ALL
), f2 AS (SELECT lang, w1, w2, count(*) AS a FROM followed WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM followed WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, 1 AS k, c.a, x.a AS l, y.a AS r
  FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND t.w1 = c.w1 AND t.w2 = c.w2 AND 100 * t.a >= 50 * c.a)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = c.lang AND t.w2 = c.w1 AND t.w3 = c.w2 AND 100 * t.a >= 50 * c.a)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 1, c.a, x.a, y.a
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 2, c.a, x.a, y.a
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3
), scored AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cuts
), kept AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000
"""


@query(_PHRASES)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordloom.llm.collocations import collocations

    return collocations(_documents(spark, sf_dir, "text", "lang")).drop("n_before", "n_after")
