"""The ``opN_<name>`` queries over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import WORD
from kiln.llm import (
    bpe,
    chat_format,
    context_tree,
    embedding_dedup,
    exact_dedup,
    language_id,
    mixing,
    periodic_runs,
    secrets,
    simhash,
    substring_dedup,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """Path of the public byte-level BPE file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_substring_dedup(spark, sf_dir):
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_embedding_dedup(spark, sf_dir):
    return embedding_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).drop("text")


@query
def op4_mixing(spark, sf_dir):
    mix, targets = mixing.mix_documents(table(spark, sf_dir, "documents"))
    mix = mix.withColumn("source", F.element_at("sources", 1))
    return mix.join(targets, mix["source"].eqNullSafe(targets["source"])).select(
        "doc_id", mix["source"], "size", "source_size", "target", (F.col("uses") * F.col("size")).alias("taken")
    )


@query
def op5_bpe(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), byte_bpe())


#: Tools of the chat query: parameters, types, whether required.
TOOLS = """
SELECT * FROM VALUES
  ('ask', 'text', 'string', true), ('ask', 'turn', 'integer', true), ('ask', 'words', 'integer', true),
  ('brief', 'text', 'string', true), ('brief', 'turn', 'integer', true), ('brief', 'tone', 'string', true)
AS tools(name, param, type, required)
"""


@query
def op6_chat_format(spark, sf_dir):
    """Every turn: user turns as calls, assistant turns as results, all other roles as messages.

    A user turn calls ``ask`` (``brief`` below ten words, whose schema its
    arguments miss) and waits for the user turn before it; its answer is the next
    turn if the assistant speaks there. Turns of other roles are plain messages at
    their own turn.
    """
    t = table(spark, sf_dir, "conversations")
    other = ~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))
    return linked_turns(spark, t, t.where(other).select("conv_id", F.col("turn").alias("call_id"), "role", F.col("text").alias("content")))


#: The earlier name of the query over every turn.
QUERIES["op6_chat_turns"] = op6_chat_format


def linked_turns(spark: SparkSession, t: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """User turns linked with the assistant turns after them, and ``messages``."""
    n = F.regexp_count("text", F.lit(WORD))
    user = t.where("role = 'user'").withColumn("words", n)
    calls = user.select(
        "conv_id",
        F.col("turn").alias("call_id"),
        F.when(F.col("turn") >= 2, F.col("turn") - 2).alias("after_id"),
        F.when(F.col("words") < 10, "brief").otherwise("ask").alias("name"),
        F.to_json(F.struct("words", "turn", "text")).alias("arguments"),
    )
    results = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    linked = chat_format.link_tool_calls(calls, results, spark.sql(TOOLS), messages)
    return linked.withColumn("errors", F.array_join("errors", "; "))


def public_pieces() -> list[str]:
    """Piece texts of the public piece vocabulary, without its control and byte pieces."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.where(~held_out), public_pieces())
    out = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), path=F.col("source"))


@query
def op9_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_lm_scoring(spark, sf_dir):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    out = context_tree.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return out.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` whose texts get a periodic tail where crc32(doc_id) ends in 0.

    With g = crc32 // 10 and n words, every word from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    n, g = F.col("n"), F.col("g")
    marked = docs.withColumns({"words": F.when(h % 10 == 0, words), "g": F.floor(h / 10).cast("long")}).withColumn("n", F.size("words").cast("long"))
    marked = marked.withColumn("a", F.when(n > 0, g % n)).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("long"))
    place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    changed = F.array_join(F.transform(place, lambda i: F.col("words")[i.cast("int")]), " ")
    return marked.withColumn("text", F.when(n > 0, changed).otherwise(F.col("text"))).drop("words", "g", "n", "a", "p")


@query
def op12_periodic_runs(spark, sf_dir):
    docs = with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = periodic_runs.collapse_runs(docs).withColumn("top", periodic_runs.longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_whitening(spark, sf_dir):
    out, _ = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


ORACLE_SQL["op10_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.norm) AS text_sha256 FROM t JOIN g ON t.norm = g.norm
"""

ORACLE_SQL["op1_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
wins AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS h
  FROM w, unnest(generate_series(1, len(words) - 49)) AS g(i) WHERE len(words) >= 50
),
owner AS (SELECT h, min(doc_id) AS least FROM wins GROUP BY h),
gone AS (
  SELECT DISTINCT wins.doc_id, i + k AS pos
  FROM wins JOIN owner ON wins.h = owner.h AND least < wins.doc_id, unnest(generate_series(0, 49)) AS s(k)
),
per AS (
  SELECT doc_id, pos, word FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w)
),
kept AS (
  SELECT per.doc_id, string_agg(word, ' ' ORDER BY per.pos) AS txt, count(*) AS n
  FROM per LEFT JOIN gone ON per.doc_id = gone.doc_id AND per.pos = gone.pos WHERE gone.pos IS NULL GROUP BY per.doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

ORACLE_SQL["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
       vec_id <= coalesce(least.b, vec_id) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN least ON vec_id = least.a
"""

LINKED_TURNS = r"""
WITH c AS (
  SELECT conv_id, turn AS call_id, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         ((turn - min(turn) OVER (PARTITION BY conv_id)) // 2)::BIGINT AS position
  FROM conversations WHERE role = 'user'
),
r AS (SELECT conv_id, turn - 1 AS call_id, text AS content FROM conversations WHERE role = 'assistant')
SELECT conv_id, call_id, position, CASE WHEN c.text IS NOT NULL THEN 'ok' END AS state,
  CASE WHEN c.text IS NULL THEN 'orphan' WHEN content IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
  CASE WHEN c.text IS NULL THEN NULL WHEN words < 10 THEN 'missing tone; unexpected words' ELSE '' END AS errors,
  '{' || CASE WHEN c.text IS NULL THEN '' ELSE '"arguments":{"text":' || to_json(c.text)::VARCHAR || ',"turn":' || call_id || ',"words":' || words || '},' END
  || CASE WHEN content IS NULL THEN '' ELSE '"content":' || to_json(content)::VARCHAR || ',' END || '"id":' || call_id
  || CASE WHEN c.text IS NULL THEN '' WHEN words < 10 THEN ',"name":"brief"' ELSE ',"name":"ask"' END || ',"type":"tool_call"}' AS message
FROM c FULL JOIN r USING (conv_id, call_id)
"""

#: Linked turns, and the turns of other roles.
ORACLE_SQL["op6_chat_format"] = ORACLE_SQL["op6_chat_turns"] = f"""
SELECT * FROM ({LINKED_TURNS}) AS linked
UNION ALL
SELECT conv_id, turn, NULL, NULL, 'message', NULL,
  '{{' || CASE WHEN text IS NULL THEN '' ELSE '"content":' || to_json(text)::VARCHAR || ',' END
  || CASE WHEN turn IS NULL THEN '' ELSE '"id":' || turn || ',' END
  || CASE WHEN role IS NULL THEN '' ELSE '"role":' || to_json(role)::VARCHAR || ',' END || '"type":"message"}}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""
