"""The queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip_digests

    return round_trip_digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import NearDuplicates

    found = NearDuplicates(_table(spark, sf_dir, "documents"), words=2).components()
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc").eqNullSafe(F.col("component")).alias("kept"))


def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_count import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path()).withColumn("over_limit", F.col("n_tokens") > 1024)


def held_out(doc_id: Column) -> Column:
    """Rows that never train: a fifth, by the checksum of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, toxic_labels(spark, sf_dir)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_reputation import judge

    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page"), F.col("quality").alias("good"))
    judged = judge(_table(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_labelled", F.col("bound").cast("decimal(9,6)").alias("bound"))


def _op3_sql() -> str:
    from .url_reputation import CELLS, CUTOFF, LEVEL, LOOSEST, RULES, TIGHTEST, TWO_LABEL_SUFFIXES

    def fits(rule: str) -> str:
        domain, _, rest = rule.partition("/")
        return f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{rest}')"

    longest = sorted(RULES, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in longest)
    verdict = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in longest)
    tail = lambda n: f"array_to_string(string_split(host, '.')[-{n}:], '.')"
    strength = lambda t: f"(SELECT 1 / least(greatest(coalesce((sum(pow(k - n * m, 2) / (m * (1 - m))) - sum(n)) / nullif(sum(n * (n - 1)), 0), {LOOSEST}), {TIGHTEST}), {LOOSEST}) - 1 AS s FROM {t} WHERE n > 0)"
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
best AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h0 AS (
  SELECT host, count(good)::BIGINT AS n, coalesce(sum((good > 0)::INT), 0)::BIGINT AS k,
         CASE WHEN {tail(2)} IN {TWO_LABEL_SUFFIXES} THEN {tail(3)} ELSE {tail(2)} END AS domain,
         CASE WHEN {tail(2)} IN {TWO_LABEL_SUFFIXES} THEN {tail(2)} ELSE {tail(1)} END AS suffix
  FROM p LEFT JOIN best ON page_id = doc_id GROUP BY host),
d0 AS (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k FROM h0 GROUP BY ALL),
s1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM d0) AS m FROM d0 GROUP BY suffix),
s2 AS (SELECT suffix, (m * s + k) / (n + s) AS m FROM s1, {strength("s1")}),
d1 AS (SELECT d0.*, m FROM d0 JOIN s2 USING (suffix)),
d2 AS (SELECT domain, (m * s + k) / (n + s) AS m FROM d1, {strength("d1")}),
h1 AS (SELECT host, n, k, m FROM h0 JOIN d2 USING (domain)),
h2 AS (SELECT host, n, s, (m * s + k) / (n + s) AS mean FROM h1, {strength("h1")}),
h3 AS (SELECT host, n, mean * (n + s) AS a, (1 - mean) * (n + s) AS b, asin(sqrt(mean)) AS middle, 0.5 / sqrt(n + s) AS sd FROM h2),
h4 AS (SELECT *, greatest(middle - 8 * sd, 0) AS low, (least(middle + 8 * sd, pi() / 2) - greatest(middle - 8 * sd, 0)) / {CELLS} AS step FROM h3),
h5 AS (SELECT *, exp((2 * a - 1) * (ln(sin(low + (i + 0.5) * step)) - ln(sin(middle))) + (2 * b - 1) * (ln(cos(low + (i + 0.5) * step)) - ln(cos(middle)))) AS w FROM h4, range({CELLS}) AS c(i)),
h6 AS (SELECT *, sum(w) OVER (PARTITION BY host ORDER BY i ROWS UNBOUNDED PRECEDING) AS cum FROM h5),
h7 AS (SELECT *, {LEVEL} * max(cum) OVER (PARTITION BY host) AS target FROM h6),
h8 AS (SELECT host, n, pow(sin(max(low) + max(step) * sum(CASE WHEN cum <= target THEN 1.0::DOUBLE WHEN cum - w >= target THEN 0.0::DOUBLE ELSE (target - (cum - w)) / w END)), 2) AS bound FROM h7 GROUP BY host, n),
r AS (SELECT page_id, host, path, CASE {rule} END AS rule FROM p)
SELECT page_id, r.host, path, rule,
       CASE {verdict} WHEN bound >= {CUTOFF} THEN 'allow' ELSE 'block' END AS verdict, n AS n_labelled, bound::DECIMAL(9, 6) AS bound
FROM r JOIN h8 ON r.host = h8.host
"""


OP3_SQL = _op3_sql()


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import PhraseIndex, items_digest

    found = PhraseIndex(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), near=False).report()
    n_items = F.coalesce(F.size(F.col("items")), F.lit(0))
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", F.when(n_items > 0, n_items).otherwise(0).cast("long").alias("n_items"), items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP4_SQL = r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 10], ' ') AS win, least(len(w), 10) AS size FROM items, unnest(range(greatest(len(w) - 10, 0) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM wins),
runs AS (SELECT doc_id, i AS start, size, array_to_string(w[i + 1:i + size], ' ') AS win FROM low, sizes, unnest(range(greatest(len(w) - size + 1, 0))) AS t(i)),
found AS (SELECT doc_id, item_id, start, r.size FROM runs r JOIN wins USING (win, size)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + size)) AS pos FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""


def op4_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches, which the SQL of ``op4_decontaminate`` has no column for."""
    from .decontaminate import PhraseIndex, items_digest

    found = PhraseIndex(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).near_report()
    n_items = F.coalesce(F.size(F.col("near_items")), F.lit(0))
    return found.select(F.col("doc").alias("doc_id"), "n_near", "least_gap", F.when(n_items > 0, n_items).otherwise(0).cast("long").alias("n_near_items"), items_digest(F.col("near_items")).alias("near_items_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan

    return scan(_table(spark, sf_dir, "documents"))


def _op10_sql() -> str:
    from .license_scan import PHRASES, TEMPLATES, THRESHOLD, block_span, template_plans

    sets = ", ".join(f"('{label}', {words!r}, {need})" for label, words, need, _ in template_plans(TEMPLATES, {}, THRESHOLD))
    phrases = ", ".join(f"('{p}', '{label}', {p.split(' ')!r})" for p, label in PHRASES.items())
    span, word, gap = block_span(TEMPLATES), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n"
    low = "translate(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(13), 'abcdefghijklmnopqrstuvwxyz' || chr(10))"
    filled = lambda blocks: f"list_filter(list_transform({blocks}, lambda x: regexp_extract_all(x, '{word}')), lambda x: len(x) > 0)"
    return rf"""
WITH d AS (SELECT doc_id, {low} AS low, regexp_extract_all({low}, '{word}') AS w FROM documents),
phrases(phrase, label, p) AS (VALUES {phrases}),
templates(template, t, need) AS (VALUES {sets}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS pos
  FROM d, phrases WHERE contains(low, split_part(phrase, ' ', 1))),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_distinct(list(label)) AS labels FROM places GROUP BY doc_id),
cut AS (
  SELECT doc_id, {filled(f"regexp_split_to_array(low, '{gap}')")} AS paragraphs, {filled("string_split(low, chr(10))")} AS lines,
         list_transform(range(greatest(ceil(len(w) / {span})::BIGINT - 2, 0) + 1), lambda k: w[k * {span} + 1:(k + 2) * {span}]) AS windows
  FROM d),
blocks AS (SELECT doc_id, list_distinct(unnest(CASE WHEN len(paragraphs) > 1 THEN paragraphs WHEN len(lines) > 1 THEN list_concat(lines, windows) ELSE lines END)) AS b FROM cut),
more AS (
  SELECT doc_id, list_distinct(list(template)) AS labels, max(len(list_intersect(b, t)) / len(t)) AS score
  FROM blocks, templates WHERE len(list_intersect(b, t)) >= need GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, more.labels))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(more.score, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


OP10_SQL = _op10_sql()


def op5_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document that loses sentences; documents that lose none have no row."""
    from .span_dedup import repeated_sentences

    found = repeated_sentences(_table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_sentences"), F.size("removed").alias("n_removed"), F.col("removed").alias("removed_sentences"), F.col("origins").alias("origin_doc_ids"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    placed = shard(_table(spark, sf_dir, "documents"), 8)
    return placed.select(F.col("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    found = exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), F.col("doc").eqNullSafe(F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


OP6_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
       text_sha256
FROM t
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    names = {k.split("_")[0]: k for k in reversed(queries())}  # SQL belongs to the first query of its number
    return {names[k[:-4].lower()]: v for k, v in globals().items() if k.startswith("OP") and k.endswith("_SQL")}
