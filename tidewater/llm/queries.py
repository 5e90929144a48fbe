"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import jaccard, mixing, multi_index, packing, pieces, pii, ppm, quality, repetition, shallot, sharding, spelling, warc
from tidewater.llm.common import documents, id_bucket


def op1_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every whole text, sampled without replacement, with inclusion scores."""
    return pieces.encode_samples(documents(spark, sf_dir), k=2, keep=["doc_id"])


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of equal label by an inverted multi-index, cosine at least 0.98."""
    return multi_index.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.98)


def op3_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-pass external shuffle of all documents into 16 shards, row counts at most one apart."""
    docs = documents(spark, sf_dir)
    rows = sharding.external_shuffle(docs, shards=16)
    return rows.select(
        "doc_id",
        sharding.row_bytes(rows, "text").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and plain-text conversion records of all pages."""
    responses = warc.responses_from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.derive(responses, keep=["page_id"]).drop("record")


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text by boosted trees learned from the labels that are not held out."""
    docs = documents(spark, sf_dir).withColumn("held_out", F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False)))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_bucket("doc_id", 5) != 0)
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model, keep=["doc_id", "held_out"])
    return rows.withColumn("predicted", F.when(F.col("score") >= QUALITY_LEAST, 1).otherwise(0))


def op6_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard links (90 %) of all documents' 3-word shingle sets by a grouped prefix join."""
    return jaccard.jaccard_join(documents(spark, sf_dir), size=3, percent=90)


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol, line and repeat counts of every whole text and the suffix-array repetition verdict."""
    rows = repetition.repetition(documents(spark, sf_dir), "text", keep=["doc_id"])
    return rows.drop("repeat_spans")


def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text by PPM trees learned from the documents that are not held out."""
    docs = documents(spark, sf_dir).withColumn("held_out", F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False)))
    model = ppm.fit(docs.where(~F.col("held_out")))
    return ppm.predict(docs, model, "text", keep=["doc_id", "held_out"])


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; weights 5, 2, 1 in turn, targets at most 3 times the source."""
    plan = mixing.mix_plan(documents(spark, sf_dir), weights=(5, 2, 1), share=1.0, cap=3)
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced by keyed pseudonyms."""
    rows = pii.pseudonymize(documents(spark, sf_dir), "text", key=pii.session_key(spark), found_col="replaced")
    return rows.select("doc_id", "text", F.size("replaced").cast("bigint").alias("n_replaced"), F.array_sort(F.array_distinct(F.transform("replaced", lambda r: r["kind"]))).alias("kinds"))


def op11_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 8-means of all 64-component embeddings in integers, ten rounds, by Shallot search."""
    rows, centroids = shallot.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=8, rounds=10, width=64, scale=1024, salt="3")
    digests = spark.createDataFrame([(i, shallot.centroid_digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    return rows.join(F.broadcast(digests), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words that all documents use twice or more, by reduced-alphabet neighbourhoods."""
    found = spelling.words(documents(spark, sf_dir), least=7, every=31)
    return spelling.variants(found.where("n >= 2"), times=10)


def op13_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte-level BPE ids, cut and packed into sequences of at most 1024 tokens by the sum-of-squares rule."""
    import public_tokenizers

    cut = packing.cut_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return packing.pack(cut, capacity=1024).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: Documents that score less are rejected.
QUALITY_LEAST = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sample_pieces": op1_sample_pieces,
    "op2_multi_index": op2_multi_index,
    "op3_external_shuffle": op3_external_shuffle,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_quality_trees": op5_quality_trees,
    "op6_grouped_prefix_join": op6_grouped_prefix_join,
    "op7_repetition": op7_repetition,
    "op8_ppm_language": op8_ppm_language,
    "op9_mix_sources": op9_mix_sources,
    "op10_pseudonyms": op10_pseudonyms,
    "op11_shallot": op11_shallot,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_sum_of_squares": op13_sum_of_squares,
}

_TEXT_SQL = f"regexp_replace(regexp_replace(regexp_replace(payload, '{warc.BLANKS}', ' ', 'g'), '{warc.BREAKS}', chr(10), 'g'), '{warc.UNSEEN}', '', 'g')"
_NAMES_SQL = "MAP {" + ", ".join("'" + k + "': '" + v.replace("'", "''") + "'" for k, v in warc.ENTITIES.items()) + "}"


def _unescape_sql(text: str) -> str:
    """``text`` with character references decoded."""
    point = "CASE WHEN x[2] = '#' THEN CASE WHEN lower(x[3]) = 'x' THEN CAST('0x' || x[4:-2] AS BIGINT) ELSE CAST(x[3:-2] AS BIGINT) END END"
    char = f"CASE WHEN x[2] = '#' THEN CASE WHEN {point} BETWEEN 1 AND 1114111 AND NOT {point} BETWEEN 55296 AND 57343 THEN chr(CAST({point} AS INT)) ELSE x END ELSE coalesce(element_at({_NAMES_SQL}, x[2:-2])[1], x) END"
    found = f"[{char} for x in regexp_extract_all({text}, '{warc.REFERENCE}')]"
    return f"array_to_string([p[1] || coalesce(p[2], '') for p in list_zip(regexp_split_to_array({text}, '{warc.REFERENCE}'), {found})], '')"


def _digest_sql(data: str) -> str:
    digits = "".join(chr(c) for c in [*range(65, 91), *range(50, 56)])
    bits = f"(CAST('0x' || substr(sha1({data}), 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31"
    return f"'sha1:' || array_to_string(['{digits}'[CAST(({bits}) + 1 AS BIGINT)] for i in range(32)], '')"


def _uuid_sql(name: str) -> str:
    return f"'<urn:uuid:' || array_to_string([substr(md5({name}), p[1], p[2]) for p in [[1, 8], [9, 4], [13, 4], [17, 4], [21, 12]]], '-') || '>'"


_WARC_SQL = f"""
WITH source AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS payload FROM pages),
digested AS (SELECT *, {_digest_sql("payload")} AS payload_digest FROM source),
stripped AS (
  SELECT *, {_uuid_sql("'response' || chr(10) || coalesce(CAST(page_id AS VARCHAR), 'null') || chr(10) || coalesce(target_uri, 'null') || chr(10) || payload_digest")} AS refers_to,
         {_TEXT_SQL} AS bare, regexp_extract(payload, '(?is)<title[^>]*>([^<]*)</title', 1) AS raw_title FROM digested),
decoded AS (
  SELECT *, trim(regexp_replace({_unescape_sql("bare")}, '{warc.LINES}', chr(10), 'g'), ' ' || chr(10)) AS text,
         trim(regexp_replace({_unescape_sql("raw_title")}, '[\x09-\x0D\x20]+', ' ', 'g'), ' ') AS title,
         {_uuid_sql("'metadata' || chr(10) || refers_to")} AS meta_id, {_uuid_sql("'conversion' || chr(10) || refers_to")} AS text_id
  FROM stripped),
blocks AS (
  SELECT page_id, 'metadata' AS warc_type, meta_id AS record_id, text_id AS concurrent_to, refers_to, target_uri, payload_digest, 'application/warc-fields' AS content_type,
         array_to_string([x || chr(13) || chr(10) for x in [
           'source-header: HTTP/1.1 200 OK', 'source-header: Content-Type: text/html; charset=utf-8', 'source-header: Content-Length: ' || strlen(payload),
           'source-payload-digest: ' || payload_digest, 'source-payload-length: ' || strlen(payload),
           CASE WHEN raw_title <> '' THEN 'title: ' || title END, 'text-length: ' || strlen(text)] if x is not null], '') AS block
  FROM decoded
  UNION ALL
  SELECT page_id, 'conversion', text_id, meta_id, refers_to, target_uri, payload_digest, 'text/plain; charset=utf-8', text FROM decoded)
SELECT page_id, warc_type, record_id, refers_to, concurrent_to, target_uri, '{warc.DATE}' AS warc_date, content_type, CAST(strlen(block) AS BIGINT) AS content_length,
       {_digest_sql("block")} AS block_digest, payload_digest, block
FROM blocks
"""



def _shallot_sql(k: int, rounds: int, width: int, scale: int, salt: str) -> str:
    """Lloyd's rounds written out: in each all vectors meet all centroids."""
    near = "list_sum([(x[i] - v[i]) * (x[i] - v[i]) for i in range(1, {w} + 1)])".format(w=width)
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor({scale} * CAST(y AS DOUBLE)) AS BIGINT) for y in embedding] AS x FROM embeddings
  WHERE len(embedding) = {width} AND len([1 for y in embedding if y IS NOT NULL AND isfinite(CAST(y AS DOUBLE))]) = {width}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), x) - 1 AS INT) AS c, x AS v FROM kept QUALIFY c < {k})"""
    ]
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(x) AS x, arg_min(c, (d, c)) AS c FROM (SELECT r, x, c, {near} AS d FROM kept, c{i}) GROUP BY r),
c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(w, v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(m ORDER BY i) AS w FROM (
      SELECT c, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS f, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n,
             CASE WHEN f * n > s THEN f - 1 WHEN (f + 1) * n <= s THEN f + 1 ELSE f END AS m
      FROM a{i}, (SELECT unnest(range(1, {width} + 1)) AS i) GROUP BY c, i) GROUP BY c) USING (c))""")
    return f"""
WITH {", ".join(steps)},
done AS MATERIALIZED (
  SELECT any_value(vec_id) AS vec_id, arg_min(c, (d, c)) AS cluster, min(d) AS distance, arg_min(v, (d, c)) AS v
  FROM (SELECT r, vec_id, c, v, {near} AS d FROM kept, c{rounds}) GROUP BY r)
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(v, ',')) AS centroid_sha256
FROM done
"""


_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, [CAST('0x' || hex(b)[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(len(hex(b)) // 2)]),"
    " lambda c, y: xor(c >> 8, crc_table[(xor(c, y) & 255) + 1])), 4294967295)"
)

_SPELLING_SQL = f"""
WITH RECURSIVE tables AS MATERIALIZED (
  SELECT [list_reduce(list_prepend(CAST(n AS BIGINT), range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) for n in range(256)] AS crc_table),
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
           unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[{spelling.LETTERS}]{{7,}}')) AS run FROM documents)
  GROUP BY id, run),
hashed AS (SELECT run, times, {_CRC_SQL} AS h FROM (SELECT *, encode(id || ':' || run) AS b FROM runs), tables),
cut AS (SELECT times, CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
vocabulary AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
shorter AS MATERIALIZED (
  SELECT DISTINCT ON (word, mark) word, n, i, word[1:i] || word[i + 2:] AS mark FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)),
gaps AS MATERIALIZED (SELECT word, n, i, word[1:i] || word[i + 2:] AS mark FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.mark = b.mark AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON v.word = s.mark
  UNION ALL SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON v.word = s.mark),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, encode(other)) FILTER (WHERE first) AS other
  FROM (SELECT *, m = max(m) OVER (PARTITION BY word) AS first FROM near) GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT chain.word, chain.at FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NULL) c ON c.word = f.word
"""

ORACLE: dict[str, str] = {
    "op11_shallot": _shallot_sql(8, 10, 64, 1024, "3"),
    "op12_spelling_variants": _SPELLING_SQL,
    "op9_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || coalesce(text, ''))), 1, 8) AS BIGINT) AS draw
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight,
         3 * source_size AS full_size FROM per),
placed AS (
  SELECT *, row_number() OVER o AS place,
         CAST((SELECT sum(source_size) FROM per) - coalesce(sum(full_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM weighed WINDOW o AS (ORDER BY CAST(full_size AS DOUBLE) / weight, source ASC NULLS LAST)),
lev AS (SELECT arg_min(level, place) FILTER (WHERE level * weight < full_size) AS level FROM placed),
rates AS (
  SELECT p.source, p.source_size,
         CASE WHEN lev.level IS NULL OR lev.level * p.weight >= p.full_size THEN CAST(p.full_size AS DOUBLE) ELSE lev.level * p.weight END AS target
  FROM placed p, lev),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM rates)
SELECT s.doc_id, s.size, r.source_size, r.target, s.size * (CAST(floor(r.rate) AS BIGINT) + CASE WHEN s.draw / 4294967296.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS taken,
       s.source, r.rate,
       CAST(floor(r.rate) AS BIGINT) + CASE WHEN s.draw / 4294967296.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source
""",
    "op4_warc_derivatives": _WARC_SQL,
}
