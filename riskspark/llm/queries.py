"""The registered queries of the text operators, with production parameters, and the SQL some are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import decontaminate, licenses, line_dedup, main_text, packing, periodic_runs, pii, quality_model, quality_rules, simhash, spelling, substring_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op9_substring_dedup",
    """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
wins AS (
  SELECT doc_id, s, sha256(array_to_string(list_slice(words, s, s + 49), ' ')) AS h
  FROM w, unnest(generate_series(1, len(words) - 49)) AS t(s)),
firsts AS (SELECT h, min(doc_id) AS low FROM wins GROUP BY h),
late AS (SELECT doc_id, s FROM wins JOIN firsts USING (h) WHERE doc_id > low),
gone AS (SELECT DISTINCT doc_id, s + k AS i FROM late, unnest(generate_series(0, 49)) AS t(k)),
per_word AS (SELECT doc_id, i, words[i] AS word FROM w, unnest(generate_series(1, len(words))) AS t(i)),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text, count(*) AS n
  FROM per_word p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
)
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.drop_repeated_passages(table(spark, folder, "documents"))


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), width=4, budget=4)
    found = found.select("doc_id", "fingerprint", "component_id")
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), capacity=1024, end_id=2)


@query("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")), threshold=0.5)


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_model.score(docs, quality_model.fit(docs, table(spark, folder, "labels")), threshold=0.3)


def _license_sql() -> str:
    notices = ", ".join(str(tuple(notice)) for notice in licenses.NOTICES)
    cut = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH notices AS (
  SELECT label, list_distinct({cut.format("text")}) AS tokens, CAST(ceil(len({cut.format("text")}) / 0.8 - 1e-9) AS BIGINT) AS width,
         string_split(must, ' ') AS must, string_split(lack, ' ') AS lack FROM (VALUES {notices}) AS v(label, text, must, lack)),
w AS (SELECT doc_id, {cut.format("coalesce(text, '')")} AS words FROM documents),
spots AS (SELECT doc_id, words, i FROM w, unnest(generate_series(1, len(words))) AS t(i) WHERE words[i] = 'license'),
base AS (
  SELECT doc_id, i - 2 AS start, CASE WHEN words[i - 1] = 'mit' THEN 'mit' ELSE 'apache' END AS label FROM spots WHERE i > 1 AND words[i - 1] IN ('mit', 'apache')
  UNION ALL SELECT doc_id, i - 3, 'gpl' FROM spots WHERE i > 2 AND words[i - 1] = 'public' AND words[i - 2] = 'general'),
told AS (SELECT w.doc_id, w.words, n.* FROM w, notices n WHERE list_has_all(w.words, n.must)),
placed AS (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM told),
windows AS (SELECT doc_id, label, tokens, must, lack, list_slice(words, i, i + width - 1) AS block FROM placed WHERE list_contains(tokens, words[i])),
blocks AS (
  SELECT doc_id, label, len(list_intersect(list_distinct(block), tokens)) / len(tokens) AS share FROM windows
  WHERE len(list_intersect(list_distinct(block), tokens)) >= ceil(0.8 * len(tokens) - 1e-9) AND list_has_all(block, must) AND NOT list_has_any(block, lack)),
every AS (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM blocks),
b AS (SELECT doc_id, count(*) AS n, min(start) AS lo, max(start) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
e AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY doc_id),
s AS (SELECT doc_id, max(share) AS share FROM blocks GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(e.labels, '') AS labels, CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(s.share, 0) END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id) LEFT JOIN s USING (doc_id)"""


@query("op5_license_scan", _license_sql())
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents")).drop("blocks")


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(table(spark, folder, "documents"))


@query("op7_pii")
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(table(spark, folder, "documents"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_rules.judge(docs, quality_rules.learn(docs, table(spark, folder, "labels")))


#: crc32 in SQL: the table of its 256 steps, and the checksum of a list of bytes.
CRC_STEPS = """steps AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) AS r(i)))"""
CRC_OF = "xor(list_reduce(list_prepend(4294967295, {bytes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _runs_sql() -> str:
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"""
WITH {CRC_STEPS},
cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
hashed AS (SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n, {CRC_OF.format(bytes=digits)} AS h FROM cut, steps),
chosen AS (SELECT *, h % 10 = 0 AND n > 0 AS hit, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed),
sized AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM chosen),
w AS (SELECT doc_id, n, CASE WHEN hit THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END)
                             ELSE words END AS words FROM sized),
per_word AS (SELECT doc_id, n, i, words[i + 1] AS word FROM w, unnest(range(n)) AS r(i)),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM per_word x JOIN per_word y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
whole AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM whole GROUP BY doc_id, s, l),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) AS place FROM runs) WHERE place = 1),
gone AS (SELECT DISTINCT doc_id, i FROM runs, unnest(range(s + q, s + l)) AS r(i)),
kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text FROM per_word p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT w.doc_id, w.n AS n_words, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op13_periodic_runs", _runs_sql())
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, folder, "documents"), least=24, edit=periodic_runs.stuttered)


def _spelling_sql() -> str:
    at = "strpos('123456789ABCDEF', substr(hex(encode(tagged)), {}, 1))"
    octets = f"list_transform(range(octet_length(encode(tagged))), lambda i: CAST(16 * {at.format('2 * i + 1')} + {at.format('2 * i + 2')} AS BIGINT))"
    return f"""
WITH RECURSIVE {CRC_STEPS},
spread AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, doc_id || ':' || run AS tagged, count(*) AS k FROM spread GROUP BY doc_id, run),
hashed AS (SELECT run, k, length(run) AS l, {CRC_OF.format(bytes=octets)} AS h FROM counted, steps),
edited AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % l) || substr(run, h % l + 2) ELSE run END AS word, k FROM hashed),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
holes AS (SELECT word, n, left(word, i) || '*' || substr(word, i + 2) AS hole, left(word, i) || substr(word, i + 2) AS less FROM v, unnest(range(length(word))) AS r(i)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN v b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN v b ON a.less = b.word),
ranked AS (SELECT word, other, other_n, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
          FROM v LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r USING (word)),
chain AS (SELECT word, word AS root, 0 AS depth FROM forms
          UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT word, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form) AS form, any_value(form_n) AS form_n, arg_max(root, depth) AS root
FROM forms JOIN chain USING (word) GROUP BY word"""


@query("op11_spelling_variants", _spelling_sql())
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, folder, "documents"), shortest=7, least=2, ratio=10, edit=spelling.misspelt)


@query("op12_html_main_text")
def op12_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_text(table(spark, folder, "pages"))
