"""The registered queries of the operators in this subpackage, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinolens.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return add


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.sentencepiece_codec import encoded_digests

    return encoded_digests(documents(spark, sf_dir))


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.quality import quality_scores

    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


LETTER_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATED = f"""WITH item_words AS (SELECT item_id, {LETTER_WORDS} AS ws FROM benchmark),
item_windows AS (SELECT DISTINCT item_id, least(13, len(ws)) AS size, ws[i : i + least(13, len(ws)) - 1] AS w
                 FROM item_words, range(1, 100000) r(i) WHERE len(ws) > 0 AND i <= len(ws) - least(13, len(ws)) + 1),
doc_words AS (SELECT doc_id, {LETTER_WORDS} AS ws FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
places AS (SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS i, ws FROM doc_words, sizes WHERE len(ws) >= size),
doc_windows AS (SELECT doc_id, size, i, ws[i : i + size - 1] AS w FROM places),
found AS (SELECT doc_id, d.size, i, item_id FROM doc_windows d JOIN item_windows b ON b.size = d.size AND b.w = d.w),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, range(0, 13) s(k) WHERE k < size GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op5_decontaminate", CONTAMINATED)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.decontaminate import contamination_report

    return contamination_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.simhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


REPEATED_WORDS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13),
windows AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS w FROM places),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (w), range(0, 13) s(k) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS line FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op1_substring_dedup", REPEATED_WORDS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.substring_dedup import repeated_words_report

    return repeated_words_report(documents(spark, sf_dir))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.suffix_dedup import repeated_bytes_report

    return repeated_bytes_report(documents(spark, sf_dir))


@query("op3_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.fingerprints import fingerprints

    return fingerprints(documents(spark, sf_dir))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.pii import personal_data_report

    return personal_data_report(documents(spark, sf_dir))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.token_counts import count_report

    return count_report(documents(spark, sf_dir))


@query("op8_licenses")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.licenses import license_report

    return license_report(documents(spark, sf_dir))


@query("op11_token_files")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.token_files import token_file_report

    return token_file_report(documents(spark, sf_dir))


def _clusters(rounds: int = 3, k: int = 16, dim: int = 64) -> str:
    """SQL of operator 13: every vector is compared with every centroid."""
    near = """(SELECT rn, vec_id, v, min(struct_pack(d := d, c := c)) AS b FROM
  (SELECT rn, vec_id, v, c, CAST(list_sum(list_transform(list_zip(v, p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept, {points}) GROUP BY rn, vec_id, v)"""
    steps = []
    for r in range(rounds):
        steps.append(f"near{r} AS {near.format(points=f'points{r}')}")
        steps.append(
            f"""points{r + 1} AS (SELECT c, coalesce(q, p) AS p FROM points{r} LEFT JOIN (SELECT c, list(m ORDER BY i) AS q FROM
  (SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (SELECT b.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM near{r}, range(1, {dim + 1}) t(i) GROUP BY 1, 2)) GROUP BY c) USING (c))"""
        )
    ctes = ",\n".join(steps)
    return f"""WITH kept AS (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INT) AS c, v AS p FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h, v FROM kept ORDER BY h, v LIMIT {k})),
{ctes},
last AS {near.format(points=f"points{rounds}")},
found AS (SELECT vec_id, b.c AS cluster, b.d AS distance FROM last),
sums AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM found GROUP BY cluster)
SELECT vec_id, cluster, distance, cluster_inertia, (SELECT CAST(sum(distance) AS BIGINT) FROM found) AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
FROM found JOIN sums USING (cluster) JOIN points{rounds} ON c = cluster"""


@query("op13_centroids", _clusters())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.centroids import cluster_report

    return cluster_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


PHRASES = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS rn,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, size, ws[i : i + size - 1] AS w, count(*) AS f
          FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM lists, range(1, 6) s(size) WHERE len(ws) >= size) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE size > 1 AND f >= 100),
parts AS (SELECT c.lang, c.w[i : i + s - 1] AS w, max(f) AS longer FROM candidates c, range(2, 5) t(s), range(1, 6) u(i) WHERE s < size AND i + s - 1 <= size GROUP BY ALL),
cuts AS (SELECT c.lang, c.w, c.f AS a, k, x.f AS l, y.f AS r, CAST(1000 * CAST(c.f AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score, n
         FROM candidates c JOIN totals USING (lang), range(1, 5) t(k), grams x, grams y
         WHERE k < c.size AND x.lang = c.lang AND x.w = c.w[1 : k] AND y.lang = c.lang AND y.w = c.w[k + 1 : c.size]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
kept AS (SELECT b.*, array_to_string(b.w, ' ') AS phrase FROM best b LEFT JOIN parts p ON p.lang = b.lang AND p.w = b.w WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept QUALIFY rank <= 2000"""


@query("op12_collocations", PHRASES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinolens.llm.phrases import collocations

    return collocations(documents(spark, sf_dir))
