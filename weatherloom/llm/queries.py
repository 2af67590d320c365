"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherloom.llm import (
    chat, decontaminate, language, licences, mixing, negatives, periodic, pii, quality, redirects, repeats, secrets, simhash,
)
from weatherloom.llm.registry import ORACLES, QUERIES, query, table
from weatherloom.llm.text import sha256_hex, words

__all__ = ["ORACLES", "QUERIES"]


@query("op1_simhash_near_dedup")
def op1(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


_OP2_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t FROM documents
),
w AS MATERIALIZED (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
),
rep AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
cover AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
raw_line AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
line AS MATERIALIZED (
  SELECT r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM raw_line
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM line GROUP BY r),
normal AS MATERIALIZED (
  SELECT d.host, d.t, l.r, len(l.ws) AS n, translate(array_to_string(l.ws, ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS form
  FROM line l JOIN d USING (r)
),
frequent AS (SELECT host, form FROM normal WHERE n <= 25 GROUP BY host, form HAVING count(DISTINCT t) > 20),
gone AS (SELECT r, sum(n) AS n FROM normal JOIN frequent USING (host, form) GROUP BY r),
m AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
    length(regexp_replace(d.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
    coalesce(gone.n, 0)::BIGINT AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN cover USING (r) LEFT JOIN gone USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * (n_words - removed_words) >= 5 * n_words AS kept
FROM m
"""


@query("op2_quality_rules", _OP2_SQL)
def op2(spark, sf_dir):
    return quality.verdicts(table(spark, sf_dir, "documents")).drop("host", "ta", "tb")


_OP4_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
),
b AS MATERIALIZED (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
),
win AS MATERIALIZED (
  SELECT DISTINCT item, array_to_string(ws[i:i + 12], ' ') AS form, len(ws[i:i + 12]) AS n
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
),
size AS (SELECT DISTINCT n FROM win),
gram AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS form
  FROM (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, size WHERE len(ws) >= n)
),
hit AS MATERIALIZED (SELECT r, i, g.n, item FROM gram g JOIN win USING (form, n)),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
),
met AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(met.n, 0)::BIGINT AS n_items,
  sha256(coalesce(met.ids, '')) AS items_sha256,
  coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN met USING (r)
"""


@query("op4_benchmark_decontamination", _OP4_SQL)
def op4(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop("ta", "tb")


@query("op3_mixing_sources")
def op3(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op10_pii_pseudonyms")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonyms(docs)


_OP5_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
agg AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<|im_start|>') + length('<|im_end|>') + 2 + length(role) + length(text)
      + length(regexp_replace(text,
        '\\\\|<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|<s>|</s>|\\[INST\\]|\\[/INST\\]|<<SYS>>|<</SYS>>', '\\0#', 'g'))
      - length(text)) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars
FROM agg
"""


@query("op5_chat_formatting", _OP5_SQL)
def op5(spark, sf_dir):
    smuggled = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", smuggled), (-1, 1, "assistant", smuggled)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_events(chat.streamed_events(rows)))


@query("op7_secret_scan")
def op7(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


# lines, then sentences: a mark goes before and one behind the spaces between two
_OP6_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
line AS (
  SELECT r, doc_id, li, line, coalesce(sum(length(line) + 1) OVER (
    PARTITION BY r ORDER BY li ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS li FROM d)
),
cut AS (
  SELECT r, doc_id, li, off, string_split(regexp_replace(line, '([.!?])([\x20\t]+)', '\1' || chr(1) || '\2' || chr(2), 'g'), chr(1)) AS parts
  FROM line
),
part AS (
  SELECT *, coalesce(sum(length(replace(part, chr(2), ''))) OVER (
    PARTITION BY r, li ORDER BY pi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    greatest(instr(part, chr(2)) - 1, 0) AS lead, part[instr(part, chr(2)) + 1:] AS body
  FROM (SELECT r, doc_id, li, off, unnest(parts) AS part, generate_subscripts(parts, 1) AS pi FROM cut)
),
unit AS MATERIALIZED (
  SELECT r, doc_id, row_number() OVER (PARTITION BY r ORDER BY li, pi) AS n, off + before + lead AS lo,
    off + before + lead + length(body) AS hi, len(ws) AS words, array_to_string(ws, ' ') AS form
  FROM (SELECT *, regexp_extract_all(lower(body), '[^\x20\x09-\x0D]+') AS ws FROM part) WHERE len(ws) > 0
),
again AS (
  SELECT *, n - row_number() OVER (PARTITION BY r ORDER BY n) AS run FROM (
    SELECT *, row_number() OVER (PARTITION BY form ORDER BY doc_id, n) AS k, min(doc_id) OVER (PARTITION BY form) AS first_id FROM unit)
  WHERE k > 1
),
sized AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY r, run, form ORDER BY n) = 1
    THEN greatest(words, len(regexp_extract_all(form, '[""" + repeats.UNSPACED + r"""]')) // 2) ELSE 0 END AS size FROM again
)
SELECT doc_id, min(first_id) AS first_doc_id, min(lo)::INTEGER AS start, max(hi)::INTEGER AS "end",
  count(*) AS n_units, sum(words)::BIGINT AS n_words
FROM sized GROUP BY r, doc_id, run HAVING sum(size) >= 25
"""


@query("op6_substring_dedup", _OP6_SQL)
def op6(spark, sf_dir):
    return repeats.repeats(table(spark, sf_dir, "documents")).drop("text_hash")


_TEMPLATES_SQL = ", ".join(
    "('{}', {}, '{}')".format(licence, i, text.replace("'", "''")) for i, (licence, text) in enumerate(licences.TEMPLATES)
)
_OP9_SQL = r"""
WITH template(licence, template, text) AS (VALUES """ + _TEMPLATES_SQL + r"""),
template_tf AS (
  SELECT licence, template, term, count(*) AS tf
  FROM (SELECT licence, template, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM template)
  GROUP BY ALL
),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    CASE WHEN doc_id % 10000 = 0 THEN (doc_id // 10000) || '/LICENSE'
      WHEN doc_id % 100 = 0 THEN (doc_id // 10000) || '/' || (doc_id // 100) || '/LICENSE'
      ELSE (doc_id // 10000) || '/' || (doc_id // 100) || '/' || doc_id || '.txt' END AS path
  FROM documents
),
n AS (SELECT count(*)::DOUBLE AS n FROM d),
df AS (
  SELECT term, count(*) AS df FROM (
    SELECT unnest(list_distinct(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS term FROM d)
  WHERE term IN (SELECT term FROM template_tf) GROUP BY term
),
idf AS MATERIALIZED (
  SELECT term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf
  FROM (SELECT DISTINCT term FROM template_tf) LEFT JOIN df USING (term), n
),
template_w AS (SELECT licence, template, term, tf * idf AS w FROM template_tf JOIN idf USING (term)),
template_norm AS (SELECT template, sqrt(sum(w * w)) AS norm FROM template_w GROUP BY template),
said AS MATERIALIZED (
  SELECT DISTINCT r, s FROM (
    SELECT r, unnest(string_split(regexp_replace(t, '([.!?])[\x20\t]+', '\1' || chr(10), 'g'), chr(10))) AS s FROM d)
  WHERE regexp_matches(s, '""" + licences.ANCHOR + r"""')
),
said_w AS MATERIALIZED (
  SELECT s, term, count(*) * coalesce(any_value(idf), ln(1 + any_value(n)) + 1) AS w
  FROM (SELECT s, unnest(regexp_extract_all(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT s FROM said)) CROSS JOIN n
  LEFT JOIN idf USING (term) GROUP BY s, term
),
cosines AS (
  SELECT s, licence, round(sum(a.w * b.w / norm) / any_value(own), 6) AS c
  FROM said_w a JOIN template_w b USING (term) JOIN template_norm USING (template)
  JOIN (SELECT s, sqrt(sum(w * w)) AS own FROM said_w GROUP BY s) USING (s)
  GROUP BY s, licence, template
),
best AS (
  SELECT s, licence, c FROM cosines QUALIFY row_number() OVER (PARTITION BY s ORDER BY c DESC, licence) = 1 AND c >= 0.6
),
own AS (
  SELECT r, licence, c FROM said JOIN best USING (s) QUALIFY row_number() OVER (PARTITION BY r ORDER BY c DESC, licence) = 1
),
stated AS MATERIALIZED (
  SELECT doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, own.licence, own.c FROM d LEFT JOIN own USING (r)
),
speaking AS (
  SELECT dir, min(licence) AS licence FROM stated WHERE path LIKE '%/LICENSE' AND licence IS NOT NULL GROUP BY dir
)
SELECT doc_id, path, s.licence AS own_licence, s.c AS cosine, coalesce(s.licence, near.licence, up.licence) AS licence,
  CASE WHEN s.licence IS NULL THEN coalesce(near.dir, up.dir) END AS inherited_from
FROM stated s LEFT JOIN speaking near ON near.dir = s.dir LEFT JOIN speaking up ON up.dir = regexp_extract(s.dir, '^(.*)/[^/]*$', 1)
"""


@query("op9_licence_scan", _OP9_SQL)
def op9(spark, sf_dir):
    """Documents as files of a tree: a directory for each hundred ids below one for each ten
    thousand, the first document of each being its licence file."""
    doc = F.col("doc_id")
    top = F.floor(doc / 10_000).cast("string")
    sub = F.concat(top, F.lit("/"), F.floor(doc / 100).cast("string"))
    path = (
        F.when(doc % 10_000 == 0, F.concat(top, F.lit("/LICENSE")))
        .when(doc % 100 == 0, F.concat(sub, F.lit("/LICENSE")))
        .otherwise(F.concat(sub, F.lit("/"), doc.cast("string"), F.lit(".txt")))
    )
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


@query("op8_language_id")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs, language.train(docs))


_OP11_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT a.r AS anchor, a.id AS anchor_id, c.id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.id % 50 = 0
),
p AS (
  SELECT anchor, anchor_id, id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place
  FROM s WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY anchor, place ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query("op11_hard_negatives", _OP11_SQL)
def op11(spark, sf_dir):
    finite = "not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    rows = table(spark, sf_dir, "embeddings").where(f"embedding is not null and {finite}")
    return negatives.mine(rows.selectExpr(
        "vec_id as id", "if(vec_id % 7 = 0, (label + 1) % 10, label) as label",
        "transform(embedding, x -> floor(256 * double(x))) as v", "vec_id % 50 = 0 as is_anchor",
    ))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    """One document in ten, by hash, gets words that repeat from some place on."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", hashed.alias("h"), F.expr("h div 10").alias("g"))
    chosen = docs.where("h % 10 = 0").withColumn("ws", words(F.col("text"))).withColumn("n", F.size("ws"))
    place = F.when(F.col("n") > 0, F.expr("int(g % n)")).otherwise(0)
    chosen = chosen.withColumn("a", place).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    again = F.flatten(F.array_repeat(F.expr("slice(ws, a + 1, p)"), F.expr("int(ceil((n - a) / p))")))
    text = F.array_join(F.slice(F.concat(F.expr("slice(ws, 1, a)"), again), 1, F.greatest("n", F.lit(1))), " ")
    docs = docs.where("h % 10 <> 0 or h is null").select("doc_id", "text").union(chosen.select("doc_id", text.alias("text")))
    found = periodic.periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("a"), (-r["period"]).alias("q"))))
    rows = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.concat(F.array_join(rows, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed"
    ).select(
        "doc_id", "n_runs", (-F.col("best.a")).alias("start"), F.col("best.n").alias("length"), (-F.col("best.q")).alias("period"),
        F.expr("(1000 * best.n) div -best.q").alias("exponent_milli"),
        sha256_hex(F.col("listed")).alias("runs_sha256"), sha256_hex(F.col("collapsed")).alias("collapsed_sha256"),
    )


URL_RULES = [
    redirects.Rule("com", "/", True),
    redirects.Rule("example.com", "/en/", False),
    redirects.Rule("www.example.com", "/en/", True),
    redirects.Rule("net", "/es/", False),
    redirects.Rule("net", "/fr/", False),
]

_OP13_SQL = r"""
WITH RECURSIVE p AS MATERIALIZED (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END AS rest FROM pages
),
tag AS (
  SELECT rest AS base, unnest(regexp_extract_all(
    regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM p WHERE rest IS NOT NULL AND regexp_matches(html, '(?i)canonical|http-equiv')
),
said AS (
  SELECT base, replace(trim(CASE
    WHEN regexp_matches(tag, '(?is)^<link\b.*\srel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b.*\shttp-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)\scontent\s*=\s*["'']?\s*[\d.]*\s*[;,]\s*url\s*=\s*["'']?([^"''>]*)', 1) END), '&amp;', '&') AS link
  FROM tag
),
target AS (
  SELECT base, CASE WHEN regexp_matches(link, '^(?i:https?)://') THEN substring(link, instr(link, '://') + 3)
    WHEN link LIKE '//%' THEN substring(link, 3)
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN link LIKE '/%' THEN regexp_extract(base, '^[^/?#]*') || link
    WHEN link LIKE '?%' THEN regexp_extract(base, '^[^?#]*') || link
    WHEN link LIKE '#%' THEN base
    ELSE regexp_extract(base, '^[^/?#]*') || '/' || regexp_extract(regexp_extract(base, '^[^/?#]*([^?#]*)', 1), '^/?(.*/)?[^/]*$', 1) || link END AS rest
  FROM said WHERE link <> ''
),
plain AS (
  SELECT rest, regexp_replace(regexp_replace(trim(rest), '#.*$', ''), '^[^/?#@]*@', '') AS bare
  FROM (SELECT rest FROM p UNION SELECT rest FROM target UNION SELECT base FROM target) WHERE rest IS NOT NULL
),
address AS MATERIALIZED (
  SELECT rest, host || CASE path WHEN '' THEN '/' ELSE path END || regexp_extract(bare, '^[^?]*(\?.+)?$', 1) AS address
  FROM (SELECT *, regexp_replace(translate(regexp_extract(bare, '^[^/?]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '\.?(?::(?:80|443))?$', '') AS host, regexp_extract(bare, '^[^/?]*([^?]*)', 1) AS path FROM plain)
  WHERE host <> ''
),
usual AS (
  SELECT address, path || CASE search WHEN '' THEN '' ELSE '?' || search END AS form
  FROM (SELECT address,
      regexp_replace(regexp_replace(regexp_replace(regexp_extract(address, '^[^?]*'),
        '/index\.(?:html?|php)$', '/'), '\.html?$', ''), '^([^/]+/.*[^/])/$', '\1') AS path,
      regexp_replace(regexp_replace(regexp_extract(address, '^[^?]*\?(.*)$', 1),
        '(?:^|&)(?:utm_[a-z]+|gclid|fbclid|msclkid|mc_[ce]id|ref)=[^&]*', '', 'g'), '^&+', '') AS search
    FROM (SELECT DISTINCT address FROM address))
),
edge AS (
  SELECT x.address AS a, y.address AS b FROM target t JOIN address x ON x.rest = t.base JOIN address y ON y.rest = t.rest
  UNION SELECT address, form FROM usual
),
sym AS MATERIALIZED (SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b),
name AS (SELECT address AS a, rest FROM address UNION SELECT form, form FROM usual),
hp AS MATERIALIZED (
  SELECT a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM name
),
rule(rule_host, rule_path, allow) AS (VALUES ('com', '/', true), ('example.com', '/en/', false), ('www.example.com', '/en/', true),
  ('net', '/es/', false), ('net', '/fr/', false)),
ruled AS (
  SELECT host, path, rule_host || rule_path AS rule, allow FROM (SELECT DISTINCT host, path FROM hp) JOIN rule
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC) = 1
),
node AS MATERIALIZED (SELECT a, bool_or(allow) AS allow FROM hp JOIN ruled USING (host, path) GROUP BY a),
reach(a, b) AS (SELECT DISTINCT address, address FROM address UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
alias AS (SELECT reach.a, bool_or(node.allow) AS allow FROM reach JOIN node ON node.a = reach.b GROUP BY reach.a),
page AS (
  SELECT page_id, rest, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p
)
SELECT page_id, host, path, rule, CASE WHEN coalesce(ruled.allow, alias.allow, true) THEN 'allow' ELSE 'block' END AS verdict
FROM page LEFT JOIN ruled USING (host, path) LEFT JOIN address USING (rest) LEFT JOIN alias ON alias.a = address.address
"""


@query("op13_url_filters", _OP13_SQL)
def op13(spark, sf_dir):
    judged = redirects.judge(table(spark, sf_dir, "pages"), URL_RULES)
    names = F.array(*[F.lit(r.host + r.path) for r in URL_RULES])
    return judged.select(
        "page_id", "host", "path", F.get(names, F.col("rule")).alias("rule"),
        F.when(F.col("allowed"), "allow").otherwise("block").alias("verdict"),
    )
