"""Queries of the operators of this folder, as the entry point registers them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm import bpe, chat, infill, jaccard, language, mixing, phrases, scoring, sharding, substring, topk, vectors, webtext
from ledgerloom.llm.common import documents, scratch, stored


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP1_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), lowest AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN lowest USING (vec_id) LEFT JOIN counted USING (vec_id)
"""


def op2_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.search(rows, F.col("vec_id") % 100 == 0)


OP2_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i]))::BIGINT AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e) WHERE q.vec_id % 100 = 0
)
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s) WHERE rank <= 10
"""


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted, then read back from the examples."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    examples = chat.prefix_targets(turns.unionByName(tricky))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example_no").alias("whole"), F.sort_array(F.collect_list(F.struct("example_no", loss.alias("loss")))).alias("parts"),
        F.sum(F.char_length("formatted")).alias("formatted_chars"))
    said = chat.read_turns(F.col("whole"))
    whole_loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return read.select(
        "conv_id", F.size(said).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(said, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length(whole_loss).cast("long").alias("loss_chars"), F.sha2(whole_loss, 256).alias("loss_sha256"), "formatted_chars")


OP3_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM turns
), sized AS (
    SELECT *, sum(15 + length(role) + length(role) - length(translate(role, '\\#<:', '')) + length(text) + length(text) - length(translate(text, '\\#<', '')))
        OVER (PARTITION BY conv_id ORDER BY k) AS upto
    FROM numbered
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


#: Where the public vocabulary files lie; the file that the queries use.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
VOCABULARY = "word_bpe_49k.json"


def op4_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    done = bpe.tokenize(docs, path or os.path.join(TOKENIZERS, VOCABULARY))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS sequence FROM docs, LATERAL unnest(range(1, len(words) - 33)) AS places(i)
), again AS (
    SELECT r, i FROM windows WHERE sequence IN (SELECT sequence FROM windows GROUP BY sequence HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT r, i + k AS place FROM again, range(0, 35) AS steps(k)
), placed AS (
    SELECT r, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM docs
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def fold(doc_id: str, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo `folds`; an id that is NULL counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 4) == 2)
    model = language.fit(docs.filter("not held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold 0 of 10 is held out; fold 1, which is training text too, settles the weights."""
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", fold("doc_id", 10) == 0)
    scored = scoring.score(docs, ~F.col("held_out"), fold("doc_id", 10) == 1)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
    SELECT DISTINCT r, md5(array_to_string(words[i:i + 4], ' ')) AS shingle
    FROM docs, LATERAL unnest(range(1, greatest(len(words) - 3, least(len(words), 1) + 1))) AS places(i)
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
    SELECT s.a, s.b FROM shared s JOIN sizes x ON x.r = s.a JOIN sizes y ON y.r = s.b WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
), reach AS (
    SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), lowest AS (
    SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.b GROUP BY reach.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM docs JOIN lowest USING (r) LEFT JOIN sizes USING (r)
"""


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources with the same share of characters, at the size of the input: the whole mixture is shuffled and written, its copies are returned."""
    return stored(mixing.mix(documents(spark, sf_dir)), "mixture").select("doc_id", "source", "n_copies", "copy_no", "shuffle_key")


OP10_SQL = """
WITH sizes AS (
    SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source
), shares AS (
    SELECT source, CASE WHEN size > 0 THEN (SELECT sum(size) FROM sizes) / (SELECT count(*) FROM sizes WHERE size > 0) / size ELSE 0 END AS rate FROM sizes
), means AS (
    SELECT source, greatest(ceil(rate / 64), 1)::INT AS strands, rate / greatest(ceil(rate / 64), 1) AS mean FROM shares
), terms AS (
    SELECT source, strands, k, CASE WHEN mean > 0 THEN exp(k * ln(mean) - mean - lgamma(k + 1)) ELSE (k = 0)::INT END AS p
    FROM means, LATERAL unnest(range(0, ceil(mean + sqrt(mean) * 12 + 30)::INT + 1)) AS r(k)
), tables AS (
    SELECT source, strands, list(c ORDER BY k) AS reached
    FROM (SELECT source, strands, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source, strands
), fixed AS (
    SELECT d.doc_id, d.source, t.strands, t.reached,
           '|' || coalesce('=' || d.doc_id, '-') || '|=' || md5(coalesce(d.text, '')) AS rest
    FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
), drawn AS (
    SELECT doc_id, source, rest, list_sum(list_transform(range(1, strands + 1), lambda s:
        len(list_filter(reached, lambda c: c <= ('0x' || md5('mix-1|=' || s || rest)[1:13])::BIGINT / 4503599627370496.0))))::INT AS n_copies
    FROM fixed
)
SELECT doc_id, source, n_copies, copy_no::INT AS copy_no,
       ('0x' || md5('mix-1:order|=' || copy_no || rest)[1:13])::BIGINT / 4503599627370496.0 AS shuffle_key
FROM drawn, LATERAL unnest(range(1, n_copies + 1)) AS c(copy_no)
"""


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


OP11_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(k), LATERAL unnest(range(1, len(w) - k + 2)) AS places(i)
), f AS (
    SELECT lang, k, phrase, lang || chr(10) || phrase AS name, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING k = 1 OR count(*) >= 30
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), halves AS (
    SELECT *, lang || chr(10) || array_to_string(w[1:j], ' ') AS head, lang || chr(10) || array_to_string(w[j + 1:k], ' ') AS tail
    FROM candidates, LATERAL unnest(range(1, k)) AS places(j)
), parts AS (
    SELECT name, f FROM f WHERE f >= 30
), cuts AS (
    SELECT h.lang, h.k, h.phrase, h.a, j, l.f AS l, r.f AS r, ((2000000::HUGEINT * h.a) // (l.f + r.f))::BIGINT AS score
    FROM halves h JOIN parts l ON l.name = h.head JOIN parts r ON r.name = h.tail
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_phrases AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
    FROM candidates, LATERAL unnest(range(2, k)) AS sizes(size), LATERAL unnest(range(1, k - size + 2)) AS places(i) GROUP BY ALL
), ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank
    FROM weakest w LEFT JOIN inner_phrases i ON i.lang = w.lang AND i.phrase = w.phrase WHERE i.longer IS NULL OR 100 * i.longer < 80 * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written into eight shards by their id, and read back from there."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharding.write_shards(docs, scratch(spark, "shards"), 8).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents in another order, and what is read back from them."""
    done = infill.fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.sha2("infilled", 256).alias("output_sha256"),
        F.sha2(infill.restore(F.col("infilled"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT *, len(units)::BIGINT AS n, list_transform(range(0, 4), lambda k: ('0x' || hex[8 * k + 1:8 * k + 8])::BIGINT) AS h FROM texts
), cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
           CASE WHEN text = '' OR h[3] % 100 >= 50 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix, coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
           coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_embedding_near_dedup, op2_voronoi_topk, op3_chat_format, op4_bpe, op5_substring_dedup, op6_html_extraction, op7_language_id, op8_lm_scoring, op9_ngram_jaccard_join, op10_source_mixing, op11_phrase_collocations, op12_sharding, op13_fill_in_middle)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": OP1_SQL, "op2_voronoi_topk": OP2_SQL, "op3_chat_format": OP3_SQL, "op5_substring_dedup": OP5_SQL, "op9_ngram_jaccard_join": OP9_SQL,
        "op10_source_mixing": OP10_SQL, "op11_phrase_collocations": OP11_SQL, "op13_fill_in_middle": OP13_SQL,
    }
