"""The numbered queries over the test tables: thin reports on the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wideloom.llm import (
    class_lm, decontaminate, divergence, fingerprints, ngram_join, packing, quality, repeats, secrets, sharding,
    spelling, toxicity, url_filter)
from wideloom.llm.common import fold, prepared, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        if oracle is not None:
            ORACLES[name] = oracle

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))

        QUERIES[name] = run
        return fn

    return register


@query("op1_quality")
def op1(spark, table):
    docs, labels = table("documents"), table("labels")
    stats = stored(docs.select("doc_id", quality.statistics_of().alias("stats")), "quality")
    model = quality.fit(stats, labels.where(fold("doc_id") != 0))
    return (stats.select("doc_id", (fold("doc_id") == 0).alias("held_out"), model.score("stats").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


# All pairs that share an n-gram, counted in full; groups by following links.
JACCARD_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\r\x0b\x0c]+'), lambda w: w <> '') AS w
  FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM t),
u AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
  HAVING 5 * count(*) >= 4 * (any_value(a.n) + any_value(b.n) - count(*))
  UNION ALL SELECT a.doc_id, b.doc_id FROM g a JOIN g b ON len(a.s) = 0 AND len(b.s) = 0 AND a.doc_id <> b.doc_id),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.m),
c AS (SELECT doc_id, min(m) AS class_id FROM r GROUP BY doc_id), n AS (SELECT a AS doc_id, count(*) AS n_links FROM p GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM c LEFT JOIN n USING (doc_id)"""


@query("op2_ngram_jaccard_join", JACCARD_SQL)
def op2(spark, table):
    """doc_id, class_id (least doc_id of its group), n_links (other documents at 0.8 or more)."""
    return ngram_join.near_duplicates(table("documents")).select("doc_id", "class_id", "n_links")


@query("op3_secret_scan")
def op3(spark, table):
    found = secrets.secret_report(table("documents"))
    base = secrets.of_kinds("secrets", secrets.BASE_KINDS)
    counts = [F.size(secrets.of_kinds("secrets", [k])).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.encode(secrets.joined(base), "UTF-8"), 256).alias("base_sha256"),
                        secrets.joined("secrets").alias("spans"))


@query("op4_fingerprints")
def op4(spark, table):
    return fingerprints.edited_fingerprints(table("documents"))


@query("op5_benchmark_decontamination")
def op5(spark, table):
    """A row per document and benchmark item found in it: word span and edit distance in words."""
    return decontaminate.contaminated(table("documents"), table("benchmark"))


@query("op6_best_fit_packing")
def op6(spark, table):
    return packing.packed(table("documents"), added=True)


@query("op7_repeated_strings")
def op7(spark, table):
    return repeats.without_repeats(table("documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256", "shares_passage")


@query("op8_toxicity")
def op8(spark, table):
    docs, labels = table("documents"), table("labels")
    model = toxicity.fit(docs, labels.where(fold("doc_id") != 0))
    return (docs.select("doc_id", toxicity.held_out().alias("held_out"), model.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


# The host rules of the query's contract.
HOST_RULES = [url_filter.HostRule(*r) for r in (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"))]


def labelled_urls(table) -> DataFrame:
    """(url, block): URLs whose number is a labelled document; toxic or poor ones are to be blocked."""
    _, path = url_filter.host_and_path("url")
    numbered = table("pages").select("url", F.regexp_extract(path, r"/(\d{1,18})", 1).try_cast("bigint").alias("doc_id"))
    labels = table("labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("block"))
    return numbered.join(labels, "doc_id").select("url", "block")


@query("op9_url_filter")
def op9(spark, table):
    return url_filter.filtered(table("pages"), HOST_RULES, labelled_urls(table))


@query("op10_bounded_load_ring")
def op10(spark, table):
    return sharding.shard_documents(table("documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
o AS (SELECT k, lang, source, term, count(*) AS n FROM (SELECT k, lang, source, unnest(t) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, term, sum(n) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
c AS (SELECT lang, source, term, coalesce(n, 0)::HUGEINT AS n, sum(coalesce(n, 0)::HUGEINT) OVER (PARTITION BY lang, source) AS total, v
  FROM g JOIN kept USING (lang) LEFT JOIN s USING (lang, source, term) JOIN v USING (lang)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v) AS p FROM c),
l AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM l),
w AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term
  AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN w ON w.lang = a.lang AND w.source = a.source AND w.item = b.source),
term AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
every AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' FROM term)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 50"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13(spark, table):
    return divergence.source_divergence(table("documents"))


SPELLING_SQL = r"""
WITH RECURSIVE crc(t) AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))),
d AS (SELECT row_number() OVER () AS k, coalesce(doc_id::VARCHAR, '') AS doc, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+') AS r FROM documents),
o AS (SELECT k, doc, run, count(*) AS n FROM (SELECT k, doc, unnest(r) AS run FROM d) WHERE length(run) >= 7 GROUP BY ALL),
b AS (SELECT *, flatten(list_transform(string_split(doc || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
    ELSE [192 | (unicode(x) >> 6)::BIGINT, 128 | (unicode(x) & 63)::BIGINT] END)) AS bytes FROM o),
h AS (SELECT run, n, xor(4294967295, list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM b, crc),
e AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
c AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
x AS (SELECT c.word, w.word AS near FROM c JOIN w ON w.word = c.a || c.z),
p AS (SELECT * FROM x UNION SELECT near, word FROM x
  UNION SELECT c.word, o.word FROM c JOIN c o ON c.a || ' ' || c.z = o.a || ' ' || o.z WHERE c.word <> o.word),
f AS MATERIALIZED (SELECT w.word, w.n, count(v.word) AS n_near, first(v.word ORDER BY v.n DESC, v.word) AS form, max(v.n) AS form_n
  FROM w LEFT JOIN p ON p.word = w.word LEFT JOIN w v ON v.word = p.near GROUP BY w.word, w.n),
g AS MATERIALIZED (SELECT word, n, n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM f),
r(word, root, form) AS (SELECT word, word, form FROM g UNION ALL SELECT r.word, g.word, g.form FROM r JOIN g ON g.word = r.form)
SELECT g.word, g.form, r.root, g.n, g.n_near, g.form_n FROM g JOIN r ON r.word = g.word AND r.form IS NULL"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11(spark, table):
    return spelling.spelling_variants(table("documents"), least_letters=7, least=2, every=31, ratio=10).select(
        "word", "form", "root", "n", "n_near", "form_n")


@query("op12_class_lm")
def op12(spark, table):
    return class_lm.scored_documents(table("documents"), fold("doc_id", 7) == 2)
