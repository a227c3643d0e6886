"""The operators as queries over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridfold.llm import ann, fingerprint, jaccard, langid, leaderboard, linededup, lm, mixing, packing, pii, quality, sharding, whitening
from gridfold.llm.tables import documents, embeddings, remainder


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(documents(spark, sf_dir)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(documents(spark, sf_dir), tokenizer_path()))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(embeddings(spark, sf_dir), F.col("vec_id") % 100 == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.clean(documents(spark, sf_dir))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(embeddings(spark, sf_dir))


def op12_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaderboard.change_feed(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("sale_lines", "vendors", "items")))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), remainder(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_packing": op2_packing,
    "op3_fingerprint": op3_fingerprint,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_ann": op5_ann,
    "op6_mixing": op6_mixing,
    "op7_language_id": op7_language_id,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_line_dedup": op9_line_dedup,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_leaderboard": op12_leaderboard,
    "op13_quality": op13_quality,
}

#: The line rule in DuckDB's SQL; words for what the operator's batches and runs do at once.
LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, rowid_, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
  FROM (SELECT doc_id, row_number() OVER () AS rowid_, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
),
hot AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rowid_) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(hot.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot ON keyed.k = hot.k GROUP BY rowid_
"""

#: The join by brute force: n-grams as texts, all pairs that share one, and the closure of their links.
JACCARD_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM docs
),
items AS (SELECT r, unnest(s) AS g FROM sets),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM items a JOIN items b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sets p ON p.r = x JOIN sets q ON q.r = y WHERE 100 * c >= 85 * (len(p.s) + len(q.s) - c)
),
reach(r, other) AS (SELECT r, r FROM docs UNION SELECT reach.r, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT any_value(p.doc_id) AS doc_id, any_value(len(p.s)) AS n_shingles, min(q.doc_id) AS component_id
FROM reach JOIN sets p ON p.r = reach.r JOIN sets q ON q.r = reach.other GROUP BY reach.r
"""

#: The feed by windows: revenue holds from a change to the next, boards are ranked on each of a nation's days. DuckDB has no
#: crc32, so its table is worked out from the polynomial.
LEADERBOARD_SQL = r"""
WITH RECURSIVE steps(k, c, n) AS (
  SELECT k, k, 0 FROM range(256) t(k) UNION ALL
  SELECT k, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, n + 1 FROM steps WHERE n < 8
),
polynomial AS (SELECT list(c ORDER BY k) AS t FROM steps WHERE n = 8),
keyed AS (
  SELECT *, concat(sale_id, ',', item_id, ',', vendor_id, ',', line_no) AS k FROM sale_lines
),
hashed AS (
  SELECT keyed.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]::BIGINT))) AS h FROM keyed, polynomial
),
days AS (SELECT *, coalesce(datediff('day', DATE '1970-01-01', shipped_at::DATE), 19723 + h % 150) AS s FROM hashed),
arrived AS (SELECT *, s + h % 7 + CASE WHEN h % 5 = 0 THEN 20 ELSE 0 END AS a FROM days),
batched AS (SELECT *, least(8, greatest(1, 1 + floor((a - 19723) * 8 / 180.0)))::INT AS batch FROM arrived),
latest AS (SELECT batch, max(s) AS s FROM batched GROUP BY batch),
bounds AS (SELECT b.batch, max(e.s) AS earlier FROM latest b LEFT JOIN latest e ON e.batch < b.batch GROUP BY b.batch),
deltas AS (
  SELECT v.nation_id, l.a, l.item_id, sum(CASE WHEN l.flag = 'swapped' THEN -1 ELSE 1 END * coalesce(floor(100 * l.amount + 0.5), l.quantity * floor(100 * i.price + 0.5), 0)) AS d
  FROM batched l JOIN bounds USING (batch) JOIN vendors v ON v.vendor_id = l.vendor_id AND v.nation_id IS NOT NULL JOIN items i ON i.item_id = l.item_id
  WHERE earlier IS NULL OR l.s + 15 >= earlier GROUP BY ALL
),
held AS (
  SELECT nation_id, item_id, a, sum(d) OVER (PARTITION BY nation_id, item_id ORDER BY a) AS r, lead(a, 1, 99999) OVER (PARTITION BY nation_id, item_id ORDER BY a) AS until FROM deltas
),
nation_days AS (SELECT nation_id, a, lag(a) OVER (PARTITION BY nation_id ORDER BY a) AS before FROM (SELECT DISTINCT nation_id, a FROM deltas)),
ranked AS (
  SELECT nation_id, d.a, item_id, row_number() OVER (PARTITION BY nation_id, d.a ORDER BY r DESC, item_id) AS k
  FROM nation_days d JOIN held h USING (nation_id) WHERE h.a <= d.a AND d.a < h.until AND r > 0 QUALIFY k <= 10
),
shifted AS (SELECT r.nation_id, d.a, item_id, k FROM ranked r JOIN nation_days d ON d.nation_id = r.nation_id AND d.before = r.a),
feed AS (
  SELECT nation_id, a, item_id, o.k AS old_rank, n.k AS new_rank FROM shifted o FULL JOIN ranked n USING (nation_id, a, item_id) WHERE o.k IS DISTINCT FROM n.k
)
SELECT f.nation_id, f.a::BIGINT AS arrival_day, f.item_id, least(8, greatest(1, 1 + floor((f.a - 19723) * 8 / 180.0)))::INT AS batch,
  CASE WHEN old_rank IS NULL THEN 'enter' WHEN new_rank IS NULL THEN 'exit' ELSE 'move' END AS change,
  old_rank::INT AS old_rank, new_rank::INT AS new_rank, h.r::BIGINT AS revenue
FROM feed f JOIN held h ON h.nation_id = f.nation_id AND h.item_id = f.item_id AND h.a <= f.a AND f.a < h.until
"""

ORACLE_SQL: dict[str, str] = {"op4_jaccard_join": JACCARD_SQL, "op9_line_dedup": LINE_SQL, "op12_leaderboard": LEADERBOARD_SQL}
