"""One registered query per operator, over whole tables, and the SQL it must equal where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.llm import (bpe, chat, decontamination, exact_dedup, licenses, line_dedup, ngram_join, periodic, quality,
                            sharding, spelling, substring_dedup, toxicity)
from orderpulse.llm.common import bound, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


def tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {"ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


@query("""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
controls AS (SELECT unnest(['\\', '<s>', '</s>', '<<SYS>>', '<</SYS>>', '[INST]', '[/INST]', '[ROLE]', '[/ROLE]']) AS c),
escapes AS (
  SELECT text AS body, sum((length(text) - length(replace(text, c, ''))) // length(c)) AS n
  FROM (SELECT text FROM turns UNION SELECT role FROM turns), controls GROUP BY text),
sized AS (
  SELECT t.*, length(t.text) + e.n + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4
    ELSE 20 + length(role) + r.n END AS chars
  FROM turns t JOIN escapes e ON e.body = t.text JOIN escapes r ON r.body = t.role)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars, 0::BIGINT AS rewrites, 0::BIGINT AS not_verbatim
FROM sized GROUP BY conv_id
""")
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_control_case(spark, load(spark, sf_dir, "conversations"))
    return chat.digest_conversations(chat.locate_turns(rows))


@query("""
WITH RECURSIVE word_lists AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM word_lists),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b, c.n = p.n AND c.n = q.n AS same FROM common c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE c.n * 10 >= 8 * (p.n + q.n - c.n)),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON a = other)
SELECT d.doc_id, least(d.doc_id, min(b) FILTER (WHERE same)) AS set_id,
       (SELECT min(other) FROM reached r WHERE r.doc_id = d.doc_id) AS class_id, count(b) AS n_links
FROM documents d LEFT JOIN links ON a = d.doc_id GROUP BY d.doc_id
""")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(load(spark, sf_dir, "documents")).drop("text_hash")


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(load(spark, sf_dir, "documents"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = load(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.fit_toxicity(docs, load(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op5_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(load(spark, sf_dir, "documents"), [1.0] * 40, [1.0] * 41)


@query("""
WITH word_lists AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 20], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS i FROM word_lists)),
repeats AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS cut FROM repeats, range(20) AS t(k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(cut), 0)::BIGINT AS n_removed,
       sha256(array_to_string([x FOR x, n IN w IF cut IS NULL OR NOT list_contains(cut, n - 1)], ' ')) AS kept_sha256
FROM word_lists LEFT JOIN gone USING (doc_id)
""")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, quality.grades_of_labels(load(spark, sf_dir, "labels")), levels=3)
    return quality.grade_documents(docs, model).select(
        "doc_id", "expected_grade", F.col("tails")[0].alias("p_good"), F.col("tails")[1].alias("p_best"), "selected")


@query()
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(load(spark, sf_dir, "documents"))
    labels = F.array_union("base_labels", F.transform("detections", lambda d: d["label"]))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))).alias("score"))


@query("""
WITH word_lists AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+') IF w <> ''] AS w
  FROM documents),
item_lists AS (
  SELECT item_id, w, least(5, len(w)) AS n
  FROM (SELECT item_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+') IF w <> ''] AS w
        FROM benchmark) WHERE len(w) > 0),
doc_shingles AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS s
  FROM word_lists, (SELECT DISTINCT n FROM item_lists)),
item_shingles AS (
  SELECT DISTINCT item_id, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS s
  FROM item_lists),
totals AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id),
matches AS (
  SELECT doc_id, item_id, count(*) AS n_found FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_found, n_found::DOUBLE / n_item AS containment
FROM matches JOIN totals USING (item_id) WHERE n_found * 10 >= n_item * 8
""")
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaked_items(
        load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("text_hash")


@query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load(spark, sf_dir, "documents").select("doc_id", "text"), **tokenizer()).select(
        "doc_id", bpe.n_tokens(F.col("token_ids")).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("""
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS l, unnest(range(len(parts))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
often AS (
  SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN often USING (k) GROUP BY doc_id
""")
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("""
WITH RECURSIVE steps AS (
  SELECT list((list_reduce(list_prepend(i, range(8)), lambda c, bit:
    xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))::BIGINT ORDER BY i) AS t FROM range(256) AS r(i)),
tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS w FROM documents),
counts AS (SELECT doc_id, w, count(*) AS n FROM tokens GROUP BY doc_id, w),
octets AS (
  SELECT doc_id, w, n, [('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode(doc_id || ':' || w)), '..')] AS o
  FROM counts),
hashes AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, o), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM octets, steps),
changed AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashes),
vocabulary AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS s
  FROM (SELECT word, unnest(range(length(word))) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, v.word FROM shorter a JOIN vocabulary v ON a.s = v.word
  UNION SELECT v.word, a.word FROM shorter a JOIN vocabulary v ON a.s = v.word),
best AS (
  SELECT p.word, count(*) AS n_near, (min((-v.n, near))) AS top FROM pairs p JOIN vocabulary v ON v.word = near GROUP BY p.word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 2 * n THEN top[2] END AS form,
         CASE WHEN -top[1] >= 2 * n THEN -top[1] END AS form_n FROM vocabulary LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root FROM formed UNION ALL
  SELECT walk.word, form FROM walk JOIN formed f ON f.word = walk.root WHERE form IS NOT NULL)
SELECT f.word, n, n_near, form, form_n, walk.root FROM formed f JOIN walk USING (word)
WHERE walk.root IN (SELECT word FROM formed WHERE form IS NULL)
""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.text_words(load(spark, sf_dir, "documents"))
    return spelling.spelling_groups(words.select(with_misspellings(F.col("id"), F.col("word")).alias("word")))


def with_misspellings(key: Column, word: Column) -> Column:
    """`word`, or for a fixed share of (key, word) the word without one of its code points."""
    chance = F.crc32(F.concat(key.cast("string"), F.lit(":"), word).cast("binary"))
    at = F.pmod(chance, F.length(word)).cast("int")
    return F.when(chance % 97 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = periodic.find_runs(docs.select("doc_id", with_periods(F.col("doc_id"), F.col("text")).alias("text")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = periodic.longest_run(F.col("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[longest[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * longest["length"] / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


def with_periods(key: Column, text: Column) -> Column:
    """`text`, or for a tenth of the keys its words, the last ones replaced by a stretch that repeats."""
    chance = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(chance / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.transform(words, lambda word, i: F.when(i < a, word).otherwise(words[a + F.pmod(i - a, p)]))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return F.when(chance % 10 == 0, F.array_join(bound(words, repeated), " ")).otherwise(text)
