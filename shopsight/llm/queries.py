"""One query for each operator over its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopsight.llm import byte_counts, centroids, exact_dedup, langid, licenses, mixing, packing, phrases, quality_rules, simhash, spm, token_files, urls

END_ID = 1
TOKEN_LIMIT = 1024
SEQUENCE = 4096
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]  # fixed values


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def token_files_query(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    shards = token_files.write_token_files(documents(spark, sf_dir), tokenizer or tokenizer_path("word_bpe_49k.json"), END_ID)
    read = token_files.read_token_files(shards)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    marked = docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out"))
    return langid.predicted(marked, model, ("doc_id", "held_out"))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(documents(spark, sf_dir))


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder for each hundred ids of a source, whose first document is the folder's license file."""
    name = F.when(F.col("doc_id") % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", F.col("source"), F.floor(F.col("doc_id") / 100).cast("string"), name)
    files = documents(spark, sf_dir).select(F.col("doc_id").alias("row"), path.alias("path"), "text")
    found = licenses.licensed(files)
    return found.select(F.col("row").alias("doc_id"), "path", "license", F.round("score", 6).alias("score"), "license_from")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(documents(spark, sf_dir))
    return found.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept", F.round("posterior", 6).alias("posterior"))


def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judged(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), listed)


def exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir)).drop("row")


def piece_query(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    return spm.digests(spm.encoded(documents(spark, sf_dir), model or tokenizer_path("piece_bpe_32k.model")))


def count_query(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return byte_counts.token_counts(documents(spark, sf_dir), tokenizer or tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def packing_query(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    pieces = packing.packed_pieces(documents(spark, sf_dir), tokenizer or tokenizer_path("word_bpe_49k.json"), END_ID, SEQUENCE)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir)).drop("source")


def centroid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.described(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def phrase_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(documents(spark, sf_dir))


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_files": token_files_query,
    "op2_language": language_query,
    "op3_simhash": simhash_query,
    "op4_licenses": license_query,
    "op5_quality": quality_query,
    "op6_urls": url_query,
    "op7_exact_copies": exact_query,
    "op8_pieces": piece_query,
    "op9_token_counts": count_query,
    "op10_packing": packing_query,
    "op11_mixing": mixing_query,
    "op12_centroids": centroid_query,
    "op13_phrases": phrase_query,
    "pipeline": pipeline_query,
}



def _time_sql(share: str, schedule: mixing.Schedule) -> str:
    """SQL of the time at which a source has given a share of its words."""
    total, done, cases = mixing.integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        need = f"(({share} - {done / total!r}::DOUBLE) * {total!r}::DOUBLE)"
        root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {2.0 * ((w1 - w0) / (t1 - t0))!r}::DOUBLE * {need}, 0::DOUBLE))"
        step = f"CASE WHEN {need} <= 0 THEN 0::DOUBLE ELSE 2::DOUBLE * {need} / ({w0!r}::DOUBLE + {root}) END"
        if area > 0:
            cases.append(f"WHEN {share} < {(done + area) / total!r}::DOUBLE THEN least({t0!r}::DOUBLE + {step}, {t1!r}::DOUBLE)")
        done += area
    return f"CASE {' '.join(cases)} ELSE 1::DOUBLE END"


def _centroid_sql(k: int, rounds: int, size: int) -> str:
    """SQL of the clustering with its rounds written out; all sums are whole numbers that doubles hold exactly."""
    nearest = """
n{r} AS MATERIALIZED (
  SELECT id, arg_min(c, {{'d': d, 'c': c}}) AS c, min(d) AS d FROM (
    SELECT id, c, list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m) AS d FROM kept, c{r}) GROUP BY id)"""
    means = """,
c{s} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(new, m) AS m FROM c{r} LEFT JOIN (
    SELECT c, list(mean ORDER BY i) AS new FROM (
      SELECT c, i, floor(sum(v[i]) / count(*)) AS mean FROM n{r} JOIN kept USING (id), range(1, {size} + 1) AS places(i) GROUP BY c, i) GROUP BY c) USING (c)),"""
    steps = "".join(nearest.format(r=r) + (means.format(r=r, s=r + 1, size=size) if r < rounds else "") for r in range(rounds + 1))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, [floor({centroids.SCALE} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {size} AND len([x FOR x IN embedding IF isfinite(x)]) = {size}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('{centroids.SALT}' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept) ORDER BY h, v LIMIT {k}
), {steps}
SELECT vec_id, n{rounds}.c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY n{rounds}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string([x::BIGINT FOR x IN m], ',')) AS centroid_sha256
FROM n{rounds} JOIN kept USING (id) JOIN c{rounds} USING (c)
"""


_WEIGHTS = ", ".join(f"{mixing.integral(s)!r}::DOUBLE" for s in mixing.SCHEDULES)
_TIMES = " ".join(f"WHEN {kind} THEN {_time_sql('share', s)}" for kind, s in enumerate(mixing.SCHEDULES))
_BLANK = r"[\x20\x09-\x0D]+"
ORACLES = {
    "op6_urls": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host, regexp_replace(rest, '^[^/?#]*', '') AS tail FROM parts
), urls AS (
  SELECT page_id, coalesce(translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(tail, '^([^?#]*)', 1), '') AS path FROM cut
), rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (page_id)
""",
    "op13_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM words, range(1, 5) AS lengths(k) WHERE len(w) >= k
), counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, cut, array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') AS head, array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ') AS tail
  FROM candidates c, range(1, 4) AS places(cut) WHERE cut < c.k
), scores AS (
  SELECT c.*, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head AND x.k = cut JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail AND y.k = c.k - cut
), lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scores) WHERE place = 1
), inside AS (
  SELECT lang, sub, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS sub FROM candidates, range(2, 4) AS sizes(m) WHERE m < k) GROUP BY ALL
), ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest s JOIN totals USING (lang) LEFT JOIN inside i ON i.lang = s.lang AND i.sub = s.phrase WHERE NOT coalesce(100 * longer >= 80 * a, false)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""",
    "op12_centroids": _centroid_sql(centroids.CLUSTERS, centroids.ROUNDS, centroids.SIZE),
    "op11_mixing": rf"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents
), sources AS (
  SELECT source, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.SCHEDULES)} AS kind, source_size, {mixing.MAX_REPEATS} * source_size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source)
), weighed AS (SELECT *, [{_WEIGHTS}][kind + 1] AS weight FROM sources
), filled AS (
  SELECT *, row_number() OVER o AS k, cap < weight * ((sum(cap) OVER () / {mixing.MAX_REPEATS} - coalesce(sum(cap) OVER p, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0))) AS over
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source), p AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), first_open AS (SELECT min(k) AS k FROM filled WHERE NOT over
), level AS (
  SELECT (sum(source_size) - coalesce(sum(cap) FILTER (f.k < o.k), 0))::DOUBLE / (sum(weight) FILTER (f.k >= o.k)) AS level FROM filled f, first_open o
), targets AS (SELECT source, kind, source_size, CASE WHEN cap < level * weight THEN cap::DOUBLE ELSE level * weight END AS target FROM weighed, level
), placed AS (
  SELECT r.*, kind, source_size, target, row_number() OVER () AS id,
    coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY h, r.doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, (begins + turn * source_size + size / 2::DOUBLE) / target AS share FROM placed, range({mixing.MAX_REPEATS}) AS turns(turn) WHERE 2 * (begins + turn * source_size) + size < 2::DOUBLE * target
), timed AS (SELECT *, CASE kind {_TIMES} END AS position FROM copies
), started AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY position, h, doc_id NULLS LAST, source NULLS LAST, begins, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM timed
), found AS (SELECT id, sum(size)::BIGINT AS taken, count(*)::INTEGER AS copies, min(position) AS first_position, min(start) AS first_start FROM started GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(copies, 0) AS copies, first_position, first_start
FROM placed LEFT JOIN found USING (id)
""",
    "op7_exact_copies": rf"""
WITH norm AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_BLANK}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM norm WINDOW w AS (PARTITION BY text_sha256)
""",
}
