"""The queries of this folder, bound to the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.llm import balance, forest, gnat, html, langid, lengths, lm, mixing, neargraph, packing, repair, simhash, urls
from opslens.llm.common import crc_mod

#: Fixed values: the rules of the URL query as (host, path, verdict).
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark, sf_dir):
    text = html.extract(F.col("html"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", text.alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op2_pruned_graph(spark, sf_dir):
    return neargraph.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op4_best_fit(spark, sf_dir):
    packed = packing.pack(table(spark, sf_dir, "documents"))
    rows = packed.pieces.select("uid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return rows.join(packed.places, "uid").drop("uid")


def op5_curriculum(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "coverage")


def op7_backoff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 5) == 1).alias("held_out")))


def op8_simhash(spark, sf_dir):
    return simhash.classes(table(spark, sf_dir, "documents")).select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op9_rp_forest(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0))


def op10_lengths(spark, sf_dir):
    return lengths.by_limit(lengths.histogram(table(spark, sf_dir, "documents")))


def op11_cost_balanced(spark, sf_dir):
    pieces = balance.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_cost")


def op12_gnat_codes(spark, sf_dir):
    coded, books = gnat.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_glr_repair(spark, sf_dir):
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {
        "op1_main_text": op1_main_text,
        "op2_pruned_graph": op2_pruned_graph,
        "op3_url_rules": op3_url_rules,
        "op4_best_fit": op4_best_fit,
        "op5_curriculum": op5_curriculum,
        "op6_language": op6_language,
        "op7_backoff": op7_backoff,
        "op8_simhash": op8_simhash,
        "op9_rp_forest": op9_rp_forest,
        "op10_lengths": op10_lengths,
        "op11_cost_balanced": op11_cost_balanced,
        "op12_gnat_codes": op12_gnat_codes,
        "op13_glr_repair": op13_glr_repair,
    }


_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
n AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS l FROM v),
pairs AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM n p JOIN n q
  ON p.vec_id <> q.vec_id AND list_inner_product(p.x, q.x) / (p.l * q.l) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS k FROM pairs GROUP BY a)
SELECT e.vec_id, COALESCE(d.k, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

_OP3 = f"""
WITH r AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
                                ELSE regexp_replace(substr(url, strpos(url, '://') + 3), '(?s)[?#].*$', '') END AS rest FROM pages),
p AS (SELECT page_id, translate(split_part(rest, '/', 1), {_A_Z}) AS host,
             CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM r),
j AS (SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""

_OP5 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM s),
g AS (SELECT *, [5, 2, 1][nth % 3 + 1] AS weight FROM w),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, nth) AS pos FROM g),
f AS (SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
                - 2.0::DOUBLE * CAST(COALESCE(sum(source_size) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
             CAST(sum(weight) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_weight FROM o),
c AS (SELECT *, 2.0::DOUBLE * source_size * open_weight <= weight * rest AS is_full FROM f),
l AS (SELECT min(pos) AS first_at FROM c WHERE NOT is_full),
t AS (SELECT c.source, c.source_size, CASE WHEN c.is_full OR v.pos IS NULL THEN 2.0::DOUBLE * c.source_size ELSE c.weight * v.rest / v.open_weight END AS target
      FROM c CROSS JOIN l LEFT JOIN c v ON v.pos = l.first_at),
b AS (SELECT *, COALESCE(sum(size) OVER (PARTITION BY source ORDER BY md5(COALESCE(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle FROM d)
SELECT doc_id, size, source_size, target,
       CAST(size * ((size > 0 AND middle <= target)::INT + (size > 0 AND source_size + middle <= target)::INT) AS BIGINT) AS taken
FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source
"""


def _op12() -> str:
    """All distances, round by round; SQL has no tree."""
    def nearest(book: str) -> str:
        far = "list_sum(list_transform(list_zip(p.s, c.s), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return (f"SELECT id, part, min({{'d': CAST({far} AS BIGINT), 'e': c.entry}}) AS m, any_value(p.s) AS s "
                f"FROM p JOIN {book} c USING (part) GROUP BY id, part")

    rounds = ""
    for r in (1, 2):
        rounds += f"""
a{r} AS MATERIALIZED ({nearest(f"c{r - 1}")}),
u{r} AS (SELECT part, entry, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS s FROM (
  SELECT part, m.e AS entry, pos, CAST(sum(s[pos]) AS BIGINT) AS t, count(*) AS n FROM a{r}, unnest(range(1, len(s) + 1)) g(pos) GROUP BY ALL)
  GROUP BY part, entry),
c{r} AS MATERIALIZED (SELECT part, entry, COALESCE(u.s, c.s) AS s FROM c{r - 1} c LEFT JOIN u{r} u USING (part, entry)),"""
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT id, part, x[part * (len(x) // 16) + 1:(part + 1) * (len(x) // 16)] AS s FROM v, unnest(range(16)) g(part)),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, s FROM p WHERE id <= 64),{rounds}
a3 AS ({nearest("c2")}),
codes AS (SELECT id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a3 GROUP BY id),
books AS (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY part, entry)) AS h FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN codes USING (id) CROSS JOIN books
"""


#: The states are those of s?(ua)+: nothing yet, after s, after u, after a.
_OP13 = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(b, range(8)), lambda a, i: xor(a >> 1, (a & 1) * 3988292384))) AS t),
k AS (SELECT *, COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
h AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
             xor(list_reduce(list_prepend(4294967295, list_transform(string_split(id, ''), lambda c: CAST(ord(c) AS BIGINT))),
                             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM k, tab),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM h, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) g(copy) WHERE kind <> 0),
o AS (SELECT *, row_number() OVER w AS n, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER w AS before
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
f AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 't' ELSE '' END AS fault FROM o),
counts AS (SELECT conv_id, CAST(COALESCE(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS total FROM f GROUP BY conv_id),
ins(a, b, edits, lines) AS (VALUES
    ('0', '0', '', []::VARCHAR[]), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []),
    ('0', 'u', 'I', ['user:']), ('s', 'u', 'I', ['user:']), ('a', 'u', 'I', ['user:']), ('u', 'a', 'I', ['assistant:']),
    ('0', 'a', 'II', ['user:', 'assistant:']), ('s', 'a', 'II', ['user:', 'assistant:'])),
nexts(a, initial, b) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '0' AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': []::VARCHAR[]} AS m FROM counts
  UNION ALL
  SELECT conv_id, n, state, min(m) AS m FROM (
    SELECT dp.conv_id, f.n, e.state, {'cost': dp.m.cost + 5 * len(ins.edits) + e.cost, 'audit': dp.m.audit || ins.edits || e.edit,
                                      'lines': dp.m.lines || ins.lines || e.line} AS m
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.n = dp.n + 1 JOIN ins ON ins.a = dp.state,
    LATERAL (
      SELECT ins.b AS state, 2 AS cost, 'D' AS edit, []::VARCHAR[] AS line
      UNION ALL SELECT x.b, CASE f.fault WHEN 't' THEN 5 ELSE 0 END, 'K', [f.role || ':' || f.text] FROM nexts x
        WHERE x.a = ins.b AND x.initial = f.initial AND f.fault NOT IN ('b', 'd')
      UNION ALL SELECT x.b, CASE f.fault WHEN 't' THEN 6 ELSE 1 END, 'R', [CASE x.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text]
        FROM nexts x WHERE x.a = ins.b AND x.initial IN ('u', 'a') AND f.fault NOT IN ('b', 'd')) e)
  GROUP BY conv_id, n, state),
ends AS (SELECT dp.conv_id, min({'cost': m.cost + 5 * len(ins.edits), 'audit': m.audit || ins.edits, 'lines': m.lines || ins.lines}) AS m
         FROM dp JOIN counts c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.total = dp.n JOIN ins ON ins.a = dp.state AND ins.b IN ('0', 'a')
         GROUP BY dp.conv_id)
SELECT i.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate, COALESCE(truncated, 0) AS truncated,
       COALESCE(illegal, 0) AS illegal, COALESCE(m.cost, 0) AS cost, COALESCE(m.audit, '') AS audit,
       sha256(COALESCE(array_to_string(m.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
"""


def oracle_sql() -> dict[str, str]:
    """Those that SQL can express: no vocabulary, no XXH64, no parser, and no approximate search."""
    return {"op2_pruned_graph": _OP2, "op3_url_rules": _OP3, "op5_curriculum": _OP5, "op12_gnat_codes": _op12(), "op13_glr_repair": _OP13}
