"""The registered queries of this subpackage, with their SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import alignment, bpe, fill_middle, knn_quality, licenses, line_dedup, minhash, packing, secret_scan, sharding, topk, url_model, weak_rules
from lapsewise.llm.license_texts import DECLARATIONS, SPELLINGS, TEXTS

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ALIGNED = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query("op1_pack_first_fit")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


@query("op10_bpe_forced_boundaries")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = docs.select("doc_id", bpe.Tokenizer(spark, TOKENIZER).round_trip("text").alias("coded"))
    return coded.select(
        "doc_id",
        (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


@query("op3_minhash_b_bit")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_weak_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weak_rules.judged(table(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept posterior"
    return rows.select("doc_id", *(f"_rules.{n}" for n in names.split()))


@query("op5_knn_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = docs.select("doc_id", knn_quality.held_out().alias("held_out"), knn_quality.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


#: CRC-32 of a text's bytes by its table of 256 remainders; size is the bytes of the text plus 1.
OP2_SQL = """
WITH remainders AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS r
  FROM range(256) t(i)),
scored AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, coalesce(text, '') AS text, shard,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || shard), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS n
  FROM documents, range(17) s(shard)),
placed AS (
  SELECT doc_id, size, text, arg_min(shard, n) FILTER (WHERE shard < 16) AS shard, arg_min(shard, n) AS grown_shard
  FROM scored GROUP BY doc_id, size, text),
coded AS (
  SELECT doc_id, size, shard, grown_shard,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                         lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM placed, remainders)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM coded
"""


@query("op2_rendezvous_shards", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents", "doc_id", "text"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
full_lines AS (
  SELECT doc_id, i, regexp_replace(line, '^[\x09-\x0D ]+|[\x09-\x0D ]+$', '', 'g') AS line FROM lines WHERE regexp_matches(line, '[^\x09-\x0D ]')),
windows AS (
  SELECT doc_id, i AS first, lead(i, 2) OVER w AS last, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, first) AS nth FROM windows WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM ranked WHERE nth > 1),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text, count(g.i) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query("op6_line_windows", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


OP4_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.n, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.n <> b.n AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op4_segment_bounds_top_k", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP8_SQL = f"""
WITH known AS (SELECT unnest([{", ".join(f"{{'id': {_text(i)}, 'text': {_text(t)}}}" for i, t in [*TEXTS.items(), *((i, t) for t, i in DECLARATIONS.items())])}], recursive := true)),
source AS (SELECT NULL AS license_id, doc_id, text, row_number() OVER () AS n FROM documents
           UNION ALL SELECT id, NULL, text, -row_number() OVER () FROM known),
lines AS (
  SELECT n, unnest(string_split(lower(coalesce(text, '')), chr(10))) AS line,
         generate_subscripts(string_split(lower(coalesce(text, '')), chr(10)), 1) AS i FROM source),
forms AS (
  SELECT n, i, array_to_string(list_transform(string_split(trim(regexp_replace(line, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '),
                               lambda w: coalesce(MAP {{{", ".join(f"{_text(a)}: {_text(b)}" for a, b in SPELLINGS.items())}}}[w], w)), ' ') AS form
  FROM lines WHERE NOT regexp_matches(line, {_text(licenses.COPYRIGHT)})),
texts AS (
  SELECT s.n, license_id, doc_id, sha256(coalesce(string_agg(form, ' ' ORDER BY i) FILTER (WHERE form <> ''), '')) AS digest
  FROM source s LEFT JOIN forms f ON s.n = f.n GROUP BY ALL),
found AS (
  SELECT n, string_agg(DISTINCT license_id, ' ' ORDER BY license_id) AS ids FROM (
    SELECT f.n, t.license_id FROM forms f JOIN texts t ON t.n < 0 AND t.digest = sha256(f.form) WHERE f.n > 0 AND f.form <> '') GROUP BY n)
SELECT d.doc_id, d.digest, t.license_id, coalesce(ids, '') AS line_licenses
FROM texts d LEFT JOIN texts t ON t.n < 0 AND t.digest = d.digest LEFT JOIN found ON found.n = d.n WHERE d.n > 0
"""


@query("op8_license_digests", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents", "doc_id", "text"), licenses.known(spark))


def _level(k: int) -> str:
    shorter = [f"b.p{c}" if k > 1 else "1e0 / 256" for c in "10"]
    probs = ", ".join(f"(n{c} + {url_model.SMOOTH} * {p}) / (c{c} + {url_model.SMOOTH}) AS p{c}" for c, p in zip("10", shorter))
    join = f"JOIN w{k - 1} b ON substr(a.g, 2) = b.g" if k > 1 else ""
    return f"w{k} AS (SELECT a.g, {probs} FROM kept a {join} WHERE a.k = {k})"


_RULED = sorted(url_model.RULES, key=lambda r: -len(r[1] + r[2]))
_FITS = [(v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in _RULED]
_ORDER = url_model.ORDER
OP9_SQL = f"""
WITH loc AS (
  SELECT page_id, row_number() OVER () AS n, coalesce(url, '') AS url,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (
  SELECT page_id, n, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path FROM loc),
r AS (
  SELECT *, CASE {" ".join(f"WHEN {f} THEN '{rule}'" for _, rule, f in _FITS)} END AS rule,
         CASE {" ".join(f"WHEN {f} THEN '{v}'" for v, _, f in _FITS)} END AS ruled,
         substr(md5(url), 1, 1) IN ({", ".join(f"'{c}'" for c in url_model.CALIBRATION)}) AS held,
         list_concat(list_concat([{", ".join(["chr(2)"] * (_ORDER - 1))}], CASE WHEN url = '' THEN [] ELSE string_split(url, '') END), [chr(3)]) AS c FROM hp),
ends AS (SELECT n, c, ruled, held, unnest(range({_ORDER}, len(c) + 1)) AS i FROM r),
grams AS (SELECT n, i, k, ruled, held, array_to_string(list_slice(c, i - k + 1, i), '') AS g FROM ends, range(1, {_ORDER + 1}) t(k)),
counts AS (
  SELECT g, k, count(*) FILTER (WHERE ruled = 'allow') AS n1, count(*) FILTER (WHERE ruled = 'block') AS n0
  FROM grams WHERE ruled IS NOT NULL AND NOT held GROUP BY g, k),
around AS (SELECT *, sum(n1) OVER x AS c1, sum(n0) OVER x AS c0 FROM counts WINDOW x AS (PARTITION BY k, substr(g, 1, k - 1))),
kept AS (SELECT * FROM around WHERE n1 + n0 >= {url_model.LEAST}),
{", ".join(_level(k) for k in range(1, _ORDER + 1))},
weights AS ({" UNION ALL ".join(f"SELECT g, ln(p1) - ln(p0) AS w FROM w{k}" for k in range(1, _ORDER + 1))}),
best AS (SELECT n, i, coalesce(arg_max(w, k) FILTER (WHERE w IS NOT NULL), 0) AS w FROM grams LEFT JOIN weights USING (g) GROUP BY n, i),
steps AS (
  SELECT n, CAST(greatest(least(floor(round(sum(w) / count(*), 9) * {url_model.STEPS}), {url_model.RANGE}), -{url_model.RANGE}) AS BIGINT) AS step FROM best GROUP BY n),
known AS (
  SELECT step, count(*) FILTER (WHERE ruled = 'allow') AS n1, count(*) FILTER (WHERE ruled = 'block') AS n0
  FROM r JOIN steps USING (n) WHERE ruled IS NOT NULL AND held GROUP BY step),
cuts AS (
  SELECT step, sum(n1) OVER (ORDER BY step DESC) / sum(n1) OVER () + (sum(n0) OVER () - sum(n0) OVER (ORDER BY step DESC)) / sum(n0) OVER () AS right_,
         sum(n1) OVER () AS all1, sum(n0) OVER () AS all0 FROM known),
cut AS (SELECT step FROM cuts WHERE all1 > 0 AND all0 > 0 ORDER BY round(right_, 9) DESC, step LIMIT 1)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN (SELECT count(*) FROM cut) = 0 OR step >= (SELECT step FROM cut) THEN 'allow' ELSE 'block' END) AS verdict, step
FROM r JOIN steps USING (n)
"""


@query("op9_url_markov_ratio", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judged(table(spark, sf_dir, "pages", "page_id", "url"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
numbers AS (
  SELECT doc_id, text, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS p, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS s FROM d),
cut AS (
  SELECT doc_id, text, n, least(x, y) AS a, greatest(x, y) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR p >= 90 THEN 'plain'
              WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || left(text, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
                      ELSE '<S>' || substr(text, b + 1) || '<P>' || left(text, a) || '<M>' || substr(text, a + 1, b - a) END AS output FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM made
"""


@query("op13_fill_middle_chunks", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.transformed(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored("output", "form"), 256).alias("restored_sha256"),
    )


@query("op12_alignment_bitmaps")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents", "doc_id", "text"), *ALIGNED)


@query("op11_secret_novelty")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scanned(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_novel")
