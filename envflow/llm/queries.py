"""The registered queries of the operators: each reads its whole table and applies its operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.llm import content_sort, decontamination, importance, jaccard_join, minhash, packing, pii, quality, secrets, spelling, substring_dedup, url_filters, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql_rule(host: str, path: str, what: int) -> str:
    arms = []
    for rule in sorted(url_filters.RULES, key=lambda r: -len(r[0])):
        domain, _, prefix = rule[0].partition("/")
        arms.append(f"WHEN ({host} = '{domain}' OR {host} LIKE '%.{domain}') AND starts_with({path}, '/{prefix}') THEN '{rule[what]}'")
    return f"CASE {' '.join(arms)} END"


def _sql_url(url: str) -> dict[str, str]:
    rest = f"CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) END"
    host = f"coalesce(translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{url_filters.UPPER}', '{url_filters.LOWER}'), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    node_host = rf"regexp_replace(regexp_replace({host}, '^[^@]*@', ''), '^www\.|:(80|443)$', '', 'g')"
    asked = rf"regexp_replace(regexp_replace(regexp_extract({rest}, '^[^?#]*\?([^#]*)', 1), '(?i)(^|&)(utm_[a-z]+|gclid|fbclid)=[^&]*', '', 'g'), '^&', '')"
    alias = f"CASE WHEN {host} <> '' THEN {node_host} || regexp_replace({path}, '/+$', '') || CASE WHEN {asked} <> '' THEN '?' || {asked} ELSE '' END END"
    return {"host": host, "path": path, "alias": alias}


def _sql_attribute(tag: str, name: str) -> str:
    pattern = url_filters.attribute_pattern(name).replace("'", "''")
    return "trim(" + " || ".join(f"regexp_extract({tag}, '{pattern}', {i})" for i in (1, 2, 3)) + ", ' ')"


def _sql_resolved(to: str, base: str) -> str:
    """The address that to means on a page at base, as resolved() has it."""
    rest = f"CASE WHEN strpos({base}, '://') > 0 THEN substr({base}, strpos({base}, '://') + 3) ELSE '' END"
    scheme, host, path = f"regexp_extract({base}, '^([^:/?#]*):', 1)", f"regexp_extract({rest}, '^([^/?#]*)', 1)", f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    own, asked = f"regexp_extract({to}, '^([^?#]*)', 1)", rf"regexp_extract({to}, '^[^?#]*(\?.*)?$', 1)"
    folder = f"regexp_replace({path}, '[^/]*$', '') || CASE WHEN {path} = '' THEN '/' ELSE '' END"
    joined = f"CASE WHEN starts_with({own}, '/') THEN {own} ELSE {folder} || {own} END"
    step = "CASE WHEN b[1] = '..' THEN CASE WHEN len(a) > 1 THEN a[1:len(a) - 1] ELSE a END WHEN b[1] = '.' THEN a ELSE a || b END"
    short = f"CASE WHEN regexp_matches({joined}, '(^|/)\\.\\.?(/|$)') THEN array_to_string(list_reduce(list_transform(string_split({joined}, '/'), lambda x: [x]), lambda a, b: {step}), '/') ELSE {joined} END"
    inside = f"CASE WHEN {host} <> '' THEN {scheme} || '://' || {host} || CASE WHEN {own} = '' THEN {path} ELSE {short} END || {asked} END"
    return f"CASE WHEN regexp_matches({to}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {to} WHEN starts_with({to}, '//') THEN {scheme} || ':' || {to} WHEN regexp_matches({to}, '^([A-Za-z][A-Za-z0-9+.-]*:|#|$)') THEN NULL ELSE {inside} END"


def _op1_sql() -> str:
    """The links by the operator's own patterns, without their possessive marks, which this engine needs not and has not."""
    plain = lambda pattern: pattern.replace("++", "+").replace("*+", "*").replace("'", "''")
    u, to = _sql_url("url"), _sql_url("t")
    tag = lambda name: _sql_attribute("tag", name)
    link = f"CASE WHEN regexp_matches({tag('rel')}, '{url_filters.REL}') THEN {tag('href')} END"
    named = f"regexp_matches(lower({tag('property')} || ' ' || {tag('name')}), '(^|{url_filters.SPACE})og:url({url_filters.SPACE}|$)')"
    refresh = f"regexp_extract(regexp_replace({tag('content')}, '{plain(url_filters.DELAY)}', ''), '{plain(url_filters.FIRST)}', 1)"
    meta = f"CASE WHEN {named} THEN {tag('content')} WHEN lower({tag('http-equiv')}) = 'refresh' THEN {refresh} END"
    node = ("regexp_extract(b, '^([^/?#]*)', 1)", "regexp_extract(b, '^[^/?#]*([^?#]*)', 1)")
    based = _sql_attribute(f"regexp_extract(html, '{plain(url_filters.BASE)}')", "href")
    return f"""
WITH RECURSIVE p AS (SELECT page_id, url, html, {u['host']} AS host, {u['path']} AS path, {u['alias']} AS alias FROM pages),
j AS (SELECT *, {_sql_rule('host', 'path', 0)} AS rule, {_sql_rule('host', 'path', 1)} AS own FROM p),
m AS (SELECT alias, url, coalesce({based}, '') AS based, unnest(regexp_extract_all(html, '{plain(url_filters.TAGS)}')) AS tag FROM p WHERE regexp_matches(html, '{url_filters.MARKED}')),
n AS (SELECT DISTINCT alias, url, based, coalesce(CASE WHEN regexp_matches(tag, '^<{url_filters.any_case('link')}') THEN {link} ELSE {meta} END, '') AS said FROM m),
o AS (SELECT alias, said, coalesce({_sql_resolved('based', 'url')}, url) AS base FROM n),
t AS (SELECT alias, {_sql_resolved('said', 'base')} AS t FROM o),
d AS (SELECT DISTINCT alias AS a, {to['alias']} AS b FROM t),
e AS (SELECT a, b FROM d WHERE a <> b UNION SELECT b, a FROM d WHERE a <> b),
reach AS (SELECT DISTINCT alias AS a, alias AS b FROM j WHERE own IS NULL AND alias IS NOT NULL UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
owns AS (SELECT alias AS b, own FROM j WHERE own IS NOT NULL UNION SELECT b, {_sql_rule(*node, 1)} FROM e),
theirs AS (SELECT a, min(own) AS own FROM reach JOIN owns USING (b) GROUP BY a)
SELECT page_id, host, path, rule, coalesce(j.own, theirs.own, 'allow') AS verdict
FROM j LEFT JOIN theirs ON j.own IS NULL AND j.alias = theirs.a"""


ORACLES["op1_url_filters"] = _op1_sql()


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substring_dedup.remove_repeats(docs, 35, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS m
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
twice AS (SELECT m FROM x GROUP BY m HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM x SEMI JOIN twice USING (m)),
one AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)"""


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.compared(table(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"), 85, 4)


ORACLES["op4_jaccard_join"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filters.UPPER}', '{url_filters.LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) >= 4 THEN w[i:i + 3] ELSE w END, ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (s) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents")).drop("found")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("payload")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, h, strlen(h) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY h) AS again, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN again THEN first END AS refers_to FROM f"""


@query
def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.train(docs, labels, held_in=~quality.held_out())
    scored = quality.score(docs, machine)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op11_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n"""


def _sql_crc32(text: str, table: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes: a fold over its bytes with a table of 256 entries."""
    byte = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)"


#: A row with the table k of crc32: eight steps of the reflected polynomial for each byte.
_SQL_CRC_TABLE = "SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS k"


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_importance_resampling"] = rf"""
WITH crc AS MATERIALIZED ({_SQL_CRC_TABLE}),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{importance.UPPER}', '{importance.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS MATERIALIZED (SELECT regexp_extract_all(translate(coalesce(text, ''), '{importance.UPPER}', '{importance.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
known AS MATERIALIZED (SELECT w, {_sql_crc32('w', 'k')} % 10000 AS bucket FROM (SELECT DISTINCT w FROM (SELECT unnest(w) AS w FROM d UNION ALL SELECT unnest(w) FROM b)), crc),
f AS MATERIALIZED (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(w) AS w FROM d) JOIN known USING (w)),
s AS (SELECT bucket, count(*) AS s FROM f GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS w FROM b) JOIN known USING (w) GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE / ((s + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN g USING (bucket) GROUP BY 1),
x AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM x LEFT JOIN r USING (doc_id)"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE crc AS MATERIALIZED ({_SQL_CRC_TABLE}),
u AS MATERIALIZED (SELECT doc_id, r, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents WHERE text IS NOT NULL) WHERE length(r) >= 5 GROUP BY ALL),
h AS (SELECT r, n, {_sql_crc32("(doc_id || ':' || r)", 'k')} AS h FROM u, crc),
o AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, CAST(h % length(r) AS INTEGER)) || substr(r, CAST(h % length(r) AS INTEGER) + 2) ELSE r END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
c AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM w)),
p AS (SELECT x.word AS a, y.word AS b FROM c x JOIN c y ON x.cut = y.cut AND x.i = y.i AND x.word <> y.word AND length(x.word) = length(y.word)
      UNION SELECT c.word, w.word FROM c JOIN w ON c.cut = w.word UNION SELECT w.word, c.word FROM c JOIN w ON c.cut = w.word),
q AS (SELECT a, b, y.n AS bn, row_number() OVER (PARTITION BY a ORDER BY y.n DESC, b) AS r, count(*) OVER (PARTITION BY a) AS k FROM p JOIN w y ON y.word = b),
f AS MATERIALIZED (SELECT word, n, coalesce(k, 0) AS n_near, CASE WHEN bn >= 2 * n THEN b END AS form, CASE WHEN bn >= 2 * n THEN bn END AS form_n FROM w LEFT JOIN q ON a = word AND r = 1),
walk AS (SELECT word, word AS root FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, root FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)"""
