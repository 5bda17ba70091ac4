"""The registered queries of the operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Fixed values of the query: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def register(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return put


WORDS_1 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register("op1_benchmark_decontamination", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORDS_1}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format('text')}, '{WORDS_1}') AS w
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT DISTINCT item, w[k:k + 9] AS g FROM b, unnest(range(1, greatest(2, len(w) - 8))) AS t(k) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
grams AS (SELECT r, k, n, w[k:k + n - 1] AS g FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(k) WHERE len(w) >= n),
hits AS (SELECT r, k, n, item FROM grams JOIN win USING (g)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + n)) AS t(p) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)""")
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.decontam import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        F.col("kept.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@register("op3_source_mixing", r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT source, source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS no FROM s),
w AS (SELECT *, [5, 2, 1][CAST(no % 3 AS INTEGER) + 1] AS weight, 2 * source_size AS cap FROM o),
tot AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS t FROM w),
r AS (SELECT a.*, coalesce(sum(cap) OVER q, 0)::DOUBLE AS below, (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER q, 0) AS above
      FROM w a WINDOW q AS (ORDER BY cap::DOUBLE / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT min_by(((SELECT t FROM tot) - below) / above::DOUBLE, cap::DOUBLE / weight) FILTER (cap::DOUBLE >= weight * (((SELECT t FROM tot) - below) / above::DOUBLE)) AS lvl FROM r),
g AS (SELECT source, no, source_size, CASE WHEN cap < weight * (SELECT lvl FROM lv) THEN cap::DOUBLE ELSE weight * (SELECT lvl FROM lv) END AS target FROM w),
x AS (SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5('42' || coalesce(':' || CAST(d.doc_id AS VARCHAR), '')), d.doc_id) AS k,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('42-offset:' || coalesce(d.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(floor(u + rate * k) - floor(u + rate * (k - 1)) AS BIGINT) * size AS taken FROM x""")
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.mixing import mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, ["doc_id"]).select(F.col("kept.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


_HOST = "split_part(split_part(split_part(substr(url, strpos(url, '://') + 3), '/', 1), '?', 1), '#', 1)"
_REST = "split_part(split_part(substr(url, strpos(url, '://') + 3), '?', 1), '#', 1)"


@register("op9_url_filters", f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
p AS (SELECT row_number() OVER () AS r, page_id,
             CASE WHEN strpos(url, '://') > 0 THEN {LOWER.format(_HOST)} ELSE '' END AS host,
             CASE WHEN strpos(url, '://') > 0 AND strpos({_REST}, '/') > 0 THEN substr({_REST}, strpos({_REST}, '/')) ELSE '' END AS path
      FROM pages),
j AS (SELECT p.r, any_value(p.page_id) AS page_id, any_value(p.host) AS host, any_value(p.path) AS path,
             max_by(k.host || k.path, length(k.host || k.path)) AS rule, max_by(k.verdict, length(k.host || k.path)) AS verdict
      FROM p LEFT JOIN rules k ON (p.host = k.host OR ends_with(p.host, '.' || k.host)) AND starts_with(p.path, k.path)
      GROUP BY p.r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j""")
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.urlrules import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


@register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.langid import fit, identify

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fit(docs), ["doc_id"])
    held_out = F.coalesce(F.crc32(F.col("kept.doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select(F.col("kept.doc_id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")


@register("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.simhash import near_dedup

    found = near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return found.select(F.col("kept.doc_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.quality import score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), ["doc_id"])
    held_out = F.coalesce(F.crc32(F.col("kept.doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select(F.col("kept.doc_id").alias("doc_id"), held_out.alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op7_token_binary")
def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sheaf.llm.tokens import read_token_files, token_folder, write_token_files

    folder = token_folder(spark)
    parts = write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(parts, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op8_approximate_nearest_neighbours")
def op8_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, 5)


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.sharding import shard_documents

    found = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return found.select(F.col("kept.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@register("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.passages import shared_passages

    found = shared_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumns({"n_words": F.col("end") - F.col("start"), "similarity": F.round("similarity", 6)})


_UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


@register("op11_fill_in_middle", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, regexp_extract_all(t, '{_UNITS}') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
             coalesce(array_to_string(u[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.fim import fill_in_middle, restore

    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return made.select(F.col("kept.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: CRC-32 of a list of bytes, its table made from the polynomial.
_CRC_TABLE = """tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
         FROM range(256) t(i))"""
_BYTES = "list_transform(range(length(hex({0})) // 2), lambda i: ('0x' || substr(hex({0}), CAST(2 * i + 1 AS INTEGER), 2))::BIGINT)"
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], " + _BYTES + "), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


@register("op12_spelling_variants", rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM r GROUP BY doc_id, w),
h AS (SELECT w, n, {_CRC.format("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)")} AS h FROM c, tab),
s AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word FROM h),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT DISTINCT word, p, substr(word, 1, p - 1) AS a, substr(word, p + 1) AS b
        FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS p FROM words)),
pairs AS (SELECT x.word AS word, y.word AS near FROM cut x JOIN cut y ON x.p = y.p AND x.a = y.a AND x.b = y.b AND x.word <> y.word
          UNION SELECT x.word, y.word FROM cut x JOIN words y ON y.word = x.a || x.b
          UNION SELECT y.word, x.word FROM cut x JOIN words y ON y.word = x.a || x.b),
best AS (SELECT p.word, count(*) AS n_near, min(struct_pack(l := -m.n, w := m.word)) AS b FROM pairs p JOIN words m ON m.word = p.near GROUP BY p.word),
f AS (SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN -b.l >= 2 * w.n THEN b.w END AS form,
             CASE WHEN -b.l >= 2 * w.n THEN -b.l END AS form_n FROM words w LEFT JOIN best ON best.word = w.word),
chain AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT chain.word, f.form, k + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, ends.root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n FROM f JOIN ends ON ends.word = f.word""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.variants import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheaf.llm.brown import fit, held_out, score_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return score_texts(docs, model, ["doc_id"]).select(
        F.col("kept.doc_id").alias("doc_id"), held_out(F.col("kept.doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.words.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
