"""The registered queries of this subpackage: each applies one operator with
its production parameters to its whole table and derives the result columns
from the operator's output."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.llm.common import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: DuckDB spellings of the word pattern and of a stripped, lower-cased text.
SQL_WORD = "'[^\\x20\\x09-\\x0D]+'"
SQL_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql.strip()
        return f
    return add


OP1 = f"""
WITH d AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), {SQL_WORD}) AS w FROM documents),
l AS (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
ln AS (SELECT doc_id, source, line, {SQL_LOWER.format(f"trim(line, {SQL_WHITE})")} AS k,
              len(regexp_extract_all(line, {SQL_WORD})) AS n FROM l WHERE regexp_matches(line, {SQL_WORD})),
dup AS (SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (SELECT doc_id, count(*) AS c FROM ln GROUP BY doc_id, line) GROUP BY doc_id),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM d, range(1, len(w) - 1) r(i)),
g2 AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + s) AS n_repeat_words FROM g2, range(0, 3) q(s) GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT doc_id) AS docs FROM documents GROUP BY source),
f AS (SELECT source, k, count(DISTINCT doc_id) AS c FROM ln GROUP BY source, k),
ov AS (SELECT f.source, f.k FROM f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
       WHERE c > 10 AND c > 0.001 * docs),
rm AS (SELECT doc_id, sum(n) AS removed FROM ln JOIN ov ON ln.k = ov.k AND ln.source IS NOT DISTINCT FROM ov.source GROUP BY doc_id),
s AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols FROM d)
SELECT s.doc_id, n_words, word_chars, n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words)
         AND n_words - coalesce(removed, 0) >= 0.5 * n_words AS kept
FROM s LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN rm USING (doc_id)"""


@query("op1_line_frequency", OP1)
def op1(spark, sf_dir):
    from wordloom.llm.line_frequency import line_frequency_rules
    out = line_frequency_rules(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


OP2 = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {SQL_WORD})) AS BIGINT) AS size,
                  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s AS (SELECT source, sum(size) AS n, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS w
      FROM d GROUP BY source),
c AS (SELECT *, 2.0::DOUBLE * n AS cap, 1.5::DOUBLE * sum(n) OVER () AS total FROM s),
r AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
lv AS (SELECT arg_min(level, cap / w) FILTER (level * w < cap) AS level FROM r),
t AS (SELECT source, n, least(cap, lv.level * w) AS target,
             CASE WHEN n > 0 THEN floor(least(cap, lv.level * w) / n) ELSE 0 END AS whole FROM r, lv),
o AS (SELECT d.*, t.n, t.target, t.whole, t.target - t.whole * t.n AS need,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, max(key) FILTER (need > 0 AND start + size / 2 <= need) OVER (PARTITION BY source) AS last FROM o)
SELECT doc_id, size, CAST(n AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN key <= last THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM e"""


@query("op2_mixing", OP2)
def op2(spark, sf_dir):
    from wordloom.llm.mixing import cycled_weights, mix
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, cycled_weights(docs)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op3_toxicity_chain")
def op3(spark, sf_dir):
    from wordloom.llm.toxicity import fit_chain, predict_chain
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit_chain(docs, read(spark, sf_dir, "labels"), {"low_quality": "quality = 0", "toxic": "toxic = 1"})
    return predict_chain(docs, chain).select("doc_id", "low_quality_prob", "low_quality", "toxic_prob", "toxic")


@query("op4_sentence_pieces")
def op4(spark, sf_dir):
    from wordloom.llm.sentence_pieces import encode_texts
    out = encode_texts(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
                      F.xxhash64("piece_ids").alias("ids_hash"), "round_trip")


#: The rules of op5.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


_URL = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
_HREF = """'(?i)\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)'"""
OP5 = f"""
WITH RECURSIVE rules(action, rh, rp) AS (VALUES {", ".join("('%s', '%s', '/%s')" % (a, *r.split("/", 1)) for a, r in URL_RULES)}),
p AS (SELECT page_id, {SQL_LOWER.format(f"coalesce(regexp_extract(url, {_URL}, 1), '')")} AS host,
             coalesce(regexp_extract(url, {_URL}, 2), '') AS path, html FROM pages),
fit AS (SELECT page_id, rh || rp AS rule, action, row_number() OVER (PARTITION BY page_id
          ORDER BY length(rh || rp) DESC, length(rh) DESC, action <> 'block', rh || rp) AS rn
        FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
j AS (SELECT p.*, f.rule, f.action FROM p LEFT JOIN fit f ON f.page_id = p.page_id AND f.rn = 1),
shares AS (SELECT host, avg(CAST(coalesce(action = 'allow', false) AS DOUBLE)) AS a,
                  avg(CAST(coalesce(action = 'block', false) AS DOUBLE)) AS b FROM j WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, {_HREF}, 1)) AS href FROM p),
pairs AS (SELECT src, {SQL_LOWER.format(f"regexp_extract(CASE WHEN starts_with(href, '//') THEN 'http:' || href ELSE href END, {_URL}, 1)")} AS dst
          FROM links WHERE contains(href, '//')),
sx AS (SELECT DISTINCT string_split(host, '.') AS s FROM p WHERE host <> '' AND NOT regexp_matches(host, '^[0-9.:]+$')),
up AS (SELECT DISTINCT array_to_string(s[i:], '.') AS host, array_to_string(s[i + 1:], '.') AS parent
       FROM sx, range(1, CAST(len(s) AS BIGINT) - 1) r(i)),
g AS (SELECT src, dst, count(*) AS n FROM (
        SELECT src, dst FROM pairs WHERE src <> '' AND dst <> '' AND src <> dst
        UNION ALL SELECT host, parent FROM up UNION ALL SELECT parent, host FROM up) GROUP BY ALL),
e AS (SELECT src AS host, dst AS t, n, 0 AS kind FROM g UNION ALL SELECT dst, src, n, 1 FROM g),
steps AS (SELECT host, t, kind, 0.85 * n / sum(n) OVER (PARTITION BY host, kind) AS w FROM e),
c(i, host, kind, x) AS (
  SELECT 0, host, 0, 0.15 * a FROM shares WHERE a > 0 UNION ALL SELECT 0, host, 1, 0.15 * b FROM shares WHERE b > 0
  UNION ALL SELECT i + 1, t, c.kind, sum(x * w) FROM c JOIN steps ON steps.host = c.host AND steps.kind = c.kind
            WHERE i < 80 GROUP BY i, t, c.kind),
v AS (SELECT host, sum(CASE WHEN kind = 0 THEN -x ELSE x END) AS d FROM c GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(action, CASE WHEN coalesce(v.d, 0) > 0.5 * 0.15 THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN v USING (host)"""


@query("op5_url_filter", OP5)
def op5(spark, sf_dir):
    from wordloom.llm.url_filter import filter_urls
    return filter_urls(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op6_license_scan")
def op6(spark, sf_dir):
    from wordloom.llm.license_scan import scan_licenses
    return scan_licenses(read(spark, sf_dir, "documents"))


OP7 = """
WITH v AS (SELECT vec_id, row_number() OVER () AS o, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.o ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id) WHERE rank <= 10"""


@query("op7_vector_file", OP7)
def op7(spark, sf_dir):
    from wordloom.llm.vector_file import exact_top_k
    rows = read(spark, sf_dir, "embeddings")
    return exact_top_k(rows, rows.filter("vec_id % 100 = 0"))


OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, {SQL_WORD}) AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS g
      FROM w, range(1, greatest(1, CAST(len(w) AS BIGINT) - 2) + 1) r(i) WHERE len(w) > 0),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT a AS doc_id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(min(r.root), w.doc_id) AS component_id
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY w.doc_id, s.n"""


@query("op8_ngram_join", OP8)
def op8(spark, sf_dir):
    from wordloom.llm.ngram_join import jaccard_components
    return jaccard_components(read(spark, sf_dir, "documents"))


OP9 = f"""
WITH l AS (SELECT doc_id, generate_subscripts(s, 1) AS pos, unnest(s) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (SELECT *, {SQL_LOWER.format(f"trim(line, {SQL_WHITE})")} AS k FROM l),
f AS (SELECT k, min(doc_id) AS first FROM k WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, f.first IS NOT NULL AND f.first <> doc_id AS gone FROM k LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query("op9_line_dedup", OP9)
def op9(spark, sf_dir):
    from wordloom.llm.line_dedup import line_dedup
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op10_language_id")
def op10(spark, sf_dir):
    from wordloom.llm.language_id import fit_languages, predict_language
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = fit_languages(docs.filter(~held_out))
    return predict_language(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


OP11 = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY points DESC, doc_id) AS rn FROM d),
g AS (SELECT t, count(*) AS group_size, min(doc_id) FILTER (rn = 1) AS keep_id FROM r GROUP BY t)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(t) AS text_sha256 FROM r JOIN g USING (t)"""


@query("op11_exact_dedup", OP11)
def op11(spark, sf_dir):
    from wordloom.llm.exact_dedup import exact_dedup
    out = exact_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP12 = f"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
             SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({SQL_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, CAST(m AS BIGINT) AS m, array_to_string(w[i:i+m-1], ' ') AS phrase, count(*) AS f
      FROM p, range(1, 6) ms(m), range(1, CAST(len(w) AS BIGINT) - m + 2) r(i) GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE m >= 2 AND f >= 100),
s AS (SELECT lang, array_to_string(w[i:i+k-1], ' ') AS phrase, max(a) AS f FROM c, range(2, m) q(k), range(1, m - k + 2) r(i) GROUP BY ALL),
k AS (SELECT c.* FROM c LEFT JOIN s USING (lang, phrase) WHERE s.f IS NULL OR 100 * s.f < 100 * a),
u AS (SELECT k.lang, k.phrase, a, cut, x.f AS l, y.f AS r, t.n, CAST((1000::HUGEINT * a * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM k JOIN range(1, 5) q(cut) ON cut < k.m JOIN t ON t.lang = k.lang
      JOIN g x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:cut], ' ')
      JOIN g y ON y.lang = k.lang AND y.phrase = array_to_string(w[cut + 1:k.m], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM u) WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) WHERE rank <= 2000"""


@query("op12_collocations", OP12)
def op12(spark, sf_dir):
    from wordloom.llm.collocations import collocations
    out = collocations(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op13_token_alignment")
def op13(spark, sf_dir):
    from wordloom.llm.token_alignment import token_alignment
    out = token_alignment(read(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
