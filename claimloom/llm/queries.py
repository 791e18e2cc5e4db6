"""The queries of the training-data operators, each over its whole table, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import decontaminate, fingerprints, hard_negatives, language, lines, mixing, packing, periodic_runs, quality, sharding, simhash, simple8b, topk
from claimloom.llm.common import WORD, doc_bucket, table, word_count
from claimloom.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in sequences of 4096 ids; every id bears loss, as documents have no prompt."""
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Ten highest inner products of every hundredth vector among all others."""
    return topk.top_k(table(spark, folder, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents mixed by words to weights 5, 2, 1 of their sources."""
    mixed = mixing.mix(table(spark, folder, "documents"), word_count("text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':42') AS k FROM documents
), weighed AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
    CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS w
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(w) OVER () AS all_w,
    row_number() OVER (ORDER BY 3 * source_size / w, encode(source) NULLS LAST) AS r FROM weighed
), marked AS (
  SELECT *, cap * (all_w - coalesce(sum(w) OVER earlier, 0)) <= w * (total - coalesce(sum(cap) OVER earlier, 0)) AS stopped
  FROM ranked WINDOW earlier AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, CASE WHEN stopped THEN cap
    ELSE w * (total - sum(CASE WHEN stopped THEN cap ELSE 0 END) OVER ()) / (all_w - sum(CASE WHEN stopped THEN w ELSE 0 END) OVER ()) END AS target
  FROM marked
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS e FROM placed
)
SELECT doc_id, size, source_size, target, CAST(e * size + greatest(0, least(size, budget - e * source_size - before)) AS BIGINT) AS taken
FROM epochs
"""


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document with the first line of its class, and whether it is kept."""
    return lines.classify_lines(table(spark, folder, "documents")).drop("text_hash")


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 40 shards of near-equal bytes, equal texts together as far as the sizes allow."""
    placed = sharding.shard_documents(table(spark, folder, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from labels of those whose id's crc32 is not 0 modulo 5."""
    docs = table(spark, folder, "documents")
    held_out = doc_bucket("doc_id", 5) == 0
    model = quality.learn(docs.where(~held_out), table(spark, folder, "labels"))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as Simple-8b files of byte-level ids, and what the files say about each."""
    files = f"{shared_dir(spark)}/tokens-{uuid4().hex[:12]}"
    simple8b.write_token_files(table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"), 0)
    read = simple8b.read_token_files(spark, files)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those whose id's crc32 is not 2 modulo 4."""
    docs = table(spark, folder, "documents")
    held_out = doc_bucket("doc_id", 4) == 2
    model = language.learn(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Documents linked at 4 or fewer differing bits of SimHashes of 4-word shingles."""
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, radius=4)


def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """What every document shares with the windows of ten words of all benchmark items."""
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    items = F.array_join("found.items", ",").cast("binary")
    return found.select("doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("bigint").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP11_SQL = r"""
WITH said AS (
  SELECT doc_id, row_number() OVER () AS place,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), asked AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), cut AS (
  SELECT item, w, least(10, len(w)) AS k, unnest(range(1, CAST(len(w) - least(10, len(w)) + 2 AS BIGINT))) AS i FROM asked WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM cut
), starts AS (
  SELECT place, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM said, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), met AS (
  SELECT place, i, s.k, item FROM starts s JOIN windows x ON x.k = s.k AND x.gram = array_to_string(s.w[i:i + s.k - 1], ' ')
), hits AS (
  SELECT place, count(DISTINCT word) AS n_hit FROM (SELECT place, unnest(range(i, i + k)) AS word FROM (SELECT DISTINCT place, i, k FROM met)) GROUP BY place
), named AS (
  SELECT place, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items FROM (SELECT DISTINCT place, item FROM met) GROUP BY place
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM said LEFT JOIN hits USING (place) LEFT JOIN named USING (place)
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that score between 80 % and all of what a positive of an anchor does."""
    relabelled = F.when(F.pmod(F.col("vec_id"), F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", relabelled)
    return hard_negatives.mine(vectors, F.pmod(F.col("vec_id"), F.lit(100)) == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


def _repeating(text: Column, key: Column) -> Column:
    """The text, but where its id's crc32 is a multiple of ten, with a stretch of its words repeated to the end.

    With g a tenth of that crc32 and n words: from word a = g % n on, the stretch's
    1 + floor((n - a) / (3 + g % 8)) words come again and again. A null id changes nothing.
    """
    code = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(code / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    begin = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    period = F.lit(1) + F.floor((n - begin) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("int")
    times = F.floor((n - begin) / period).cast("int") + 1
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, begin + 1, period), times)), F.lit(1), n - begin)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), begin), again), " ")
    return F.when((F.pmod(code, F.lit(10)) == 0) & (n > 0), changed).otherwise(text)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeating words in every document, and the document without the repetitions."""
    docs = table(spark, folder, "documents").withColumn("text", _repeating(F.col("text"), F.col("doc_id")))
    found = periodic_runs.detect(docs, ["doc_id"])
    row = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(row(r), F.lit("\n"))), "")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    best = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("best"), listed.alias("listed"), "collapsed")
    return best.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP13_SQL = r"""
WITH bytes AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b)) AS step
), coded AS (
  SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(4294967295, list_reduce(string_split(CAST(doc_id AS VARCHAR), ''), lambda c, x: xor(c >> 8, step[(xor(c, CAST(ascii(x) AS BIGINT)) & 255) + 1]), 4294967295)) AS h
  FROM documents, bytes
), turned AS (
  SELECT *, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM coded WHERE h % 10 = 0 AND len(w) > 0
), said AS (
  SELECT doc_id, place, list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) AS w FROM turned
  UNION ALL SELECT doc_id, place, w FROM coded WHERE place NOT IN (SELECT place FROM turned)
), words AS (
  SELECT place, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM said
), same AS (
  SELECT x.place, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.place = y.place AND x.word = y.word AND y.i > x.i WHERE 2 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT place, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY place, q ORDER BY i) AS g FROM same) GROUP BY place, q, g HAVING count(*) >= q AND count(*) + q >= 12
), runs AS (
  SELECT place, start, length, min(q) AS period FROM stretches GROUP BY place, start, length
), told AS (
  SELECT place, count(*) AS n_runs, max(ROW(length, -start, -period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY place
), gone AS (
  SELECT DISTINCT place, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT place, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (place, i) GROUP BY place
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(-best[2] AS BIGINT) AS start, CAST(best[1] AS BIGINT) AS length,
  CAST(-best[3] AS BIGINT) AS period, CAST(1000 * best[1] // -best[3] AS BIGINT) AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM said LEFT JOIN told USING (place) LEFT JOIN kept USING (place)
"""


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_top_k": op2_top_k,
    "op3_fingerprints": op3_fingerprints,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_sharding": op6_sharding,
    "op7_quality": op7_quality,
    "op8_token_files": op8_token_files,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_decontaminate": op11_decontaminate,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE: dict[str, str] = {
    "op2_top_k": OP2_SQL,
    "op4_mixing": OP4_SQL,
    "op11_decontaminate": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_periodic_runs": OP13_SQL,
}
