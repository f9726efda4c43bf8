"""The registered queries of this package. Each applies one operator, with its production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.decontaminate import contaminated_words
from barloom.llm.fingerprints import edited_fingerprints, written
from barloom.llm.lengths import length_histogram, limit_table
from barloom.llm.neardup import near_duplicates
from barloom.llm.packing import pack
from barloom.llm.pii import BASE, KINDS, with_spans
from barloom.llm.quality import quality_scores
from barloom.llm.resampling import resample
from barloom.llm.secret_scan import BASE as SECRET_BASE
from barloom.llm.secret_scan import KINDS as SECRET_KINDS
from barloom.llm.secret_scan import with_secrets
from barloom.llm.tokens import token_counts
from barloom.llm.toxicity import toxicity_scores
from barloom.llm.trie import conversation_trie
from barloom.llm.urls import judge_pages
from barloom.llm.warc import archive_pages


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_words(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.col("pii_spans").alias("s"))

    def of(*kinds):
        return F.filter("s", lambda s: s["kind"].isin(*kinds))

    def listed(*kinds):
        return F.array_join(F.transform(of(*kinds), lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(*BASE), 256).alias("base_sha256"),
        listed(*KINDS).alias("spans"),
        F.array_max(F.transform("s", lambda s: s["score"])).alias("top_score"),
    )


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return edited_fingerprints(read(spark, sf_dir, "documents"), blocks).select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_counts(read(spark, sf_dir, "documents")))


def op7_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_table(length_histogram(token_counts(read(spark, sf_dir, "documents"))))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read(spark, sf_dir, "conversations"), group=20).drop("name")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_secrets(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.col("secret_spans").alias("s"))

    def of(kinds):
        return F.filter("s", lambda s: s["kind"].isin(*kinds))

    def listed(kinds):
        return F.array_join(F.transform(of(kinds), lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(of([kind])).cast("bigint").alias(f"n_{kind}") for kind in SECRET_BASE],
        F.sha2(listed(SECRET_BASE), 256).alias("base_sha256"),
        listed([kind.name for kind in SECRET_KINDS]).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_pii, op3_minhash_neardup, op4_url_filter, op5_fingerprints, op6_best_fit_packing, op7_warc_normaliser, op8_toxicity,
        op9_quality, op10_token_counts, op11_importance_resampling, op12_conversation_trie, op13_secret_scan,
    )
}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
passages AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i:
        array_to_string(w[i:i + 9], ' '))) AS words
    FROM b WHERE len(w) > 0),
runs AS (
    SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM passages) WHERE len(w) >= k)),
hits AS (SELECT r, item_id, i, runs.k FROM runs JOIN passages ON runs.words = passages.words AND runs.k = passages.k),
hit_words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM hits) GROUP BY r),
hit_items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

_NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT r, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM d WHERE len(w) > 0),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
    SELECT a.r AS r1, b.r AS r2, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
links AS (
    SELECT r1, r2 FROM common JOIN sizes x ON x.r = r1 JOIN sizes y ON y.r = r2 WHERE 100 * c >= 75 * (x.n + y.n - c)),
steps AS (SELECT r1 AS a, r2 AS b FROM links UNION ALL SELECT r2, r1 FROM links),
reached AS (SELECT r AS a, r AS b FROM d UNION SELECT reached.a, steps.b FROM reached JOIN steps ON reached.b = steps.a),
least_id AS (SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN d ON d.r = reached.b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least_id USING (r) LEFT JOIN sizes USING (r)
"""

_HOST = "translate(regexp_extract(coalesce({0}, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce({0}, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's')"
_PLAIN = (
    f"CASE WHEN regexp_matches({_PATH}, '/\\.\\.?(/|$)') THEN list_reduce(list_concat([''], string_split(regexp_replace({_PATH}, '/(\\.\\.?)$', '/\\1/'), '/')[2:]), "
    f"lambda done, s: CASE WHEN s = '.' THEN done WHEN s = '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || s END) ELSE {_PATH} END"
)
_ADDRESS = (
    f"CASE WHEN contains({{0}}, '://') THEN {_HOST} || rtrim({_PLAIN}, '/') || "
    "coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract({0}, '^[^#]*?\\?([^#]*)', 1, 's'), '&'), "
    "lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref|sessionid)=')), '&'), ''), '') END"
)
_RULED = """SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule"""
_SAYS = "CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END"

_URL_FILTER = rf"""
WITH RECURSIVE page AS (
    SELECT row_number() OVER () AS r, page_id, url, html, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, {_ADDRESS.format("url")} AS address
    FROM pages),
tags AS (
    SELECT url, path, address, unnest(list_concat(
        list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?i)<link\b[^>]*>'), lambda t:
            regexp_matches(t, '(?i)\brel\s*=\s*("([^"]*\s)?canonical(\s[^"]*)?"|''([^'']*\s)?canonical(\s[^'']*)?''|canonical[\s/>])')),
            lambda t: regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
        list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?i)<meta\b[^>]*>'), lambda t:
            regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')), lambda t: regexp_extract(t, '(?i)\burl\s*=\s*''?([^"''\s>]+)', 1))
    )) AS written FROM page WHERE address IS NOT NULL),
read AS (
    SELECT url, path, address, replace(replace(replace(replace(replace(replace(replace(replace(written, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
        '&apos;', ''''), '&#39;', ''''), '&#38;', '&'), '&#x26;', '&'), '&amp;', '&') AS target FROM tags WHERE written <> ''),
joined AS (
    SELECT address, CASE
        WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
        WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
        WHEN target LIKE '//%' THEN 'x:' || target
        WHEN target LIKE '/%' THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's') || target
        WHEN target LIKE '?%' THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's') || path || target
        WHEN target LIKE '#%' THEN url
        ELSE regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's') || coalesce(nullif(regexp_extract(path, '^(.*/)', 1, 's'), ''), '/') || target END AS j
    FROM read),
targets AS (
    SELECT address, regexp_extract(j, '^(.*?://[^/?#]*)', 1, 's') || {_PLAIN.format("j")} || regexp_extract(j, '^.*?://[^?#]*(.*)$', 1, 's') AS target
    FROM joined WHERE j IS NOT NULL),
links AS (SELECT address AS a, {_ADDRESS.format("target")} AS b, target FROM targets),
steps AS (SELECT a, b FROM links WHERE b IS NOT NULL UNION SELECT b, a FROM links WHERE b IS NOT NULL),
reached AS (SELECT DISTINCT address AS a, address AS b FROM page WHERE address IS NOT NULL
    UNION SELECT reached.a, steps.b FROM reached JOIN steps ON reached.b = steps.a),
ruled AS ({_RULED} FROM page),
said AS (
    SELECT address, {_SAYS} AS verdict FROM ruled
    UNION SELECT address, {_SAYS} FROM ({_RULED} FROM (SELECT b AS address, {_HOST.format("target")} AS host, {_PATH.format("target")} AS path FROM links))),
grouped AS (SELECT a AS address, min(verdict) AS verdict FROM reached JOIN said ON said.address = reached.b GROUP BY a)
SELECT page_id, host, path, rule, coalesce({_SAYS}, grouped.verdict, 'allow') AS verdict FROM ruled LEFT JOIN grouped USING (address)
"""

_RECORDS = """
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
kept AS (SELECT payload_digest, max(page_id) AS page FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page IS NOT NULL AND page IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page IS DISTINCT FROM page_id THEN page END AS refers_to
FROM p LEFT JOIN kept USING (payload_digest)
"""

# The checksum's table from its polynomial, and a checksum over the bytes of a text ``{0}``.
_CRC_TABLE = """
    steps(n, v, k) AS (SELECT range, range, 0 FROM range(256)
        UNION ALL SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
    crc AS (SELECT list(v ORDER BY n) AS t FROM steps WHERE k = 8)"""
_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen({0}) + 1), "
    "lambda i: ('0x' || substr(hex(encode({0})), 2 * i - 1, 2))::BIGINT)), "
    "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
)

_RESAMPLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest(w) AS word FROM b),
vocabulary AS (SELECT word, {_CRC.format("word")} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN vocabulary USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN vocabulary USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (S_all + 10000) AS DOUBLE)
        / CAST((s + 1) * (T_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket), (SELECT count(*) AS S_all FROM dw), (SELECT count(*) AS T_all FROM bw)),
weights AS (SELECT r, sum(gain) AS weight FROM dw JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY r),
scores AS (
    SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
            + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM d LEFT JOIN weights USING (r)),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scores LEFT JOIN drawn USING (r)
"""

_TRIE = rf"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (
    SELECT conv_id, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said, turn,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(said)) - 1 AS pos FROM turns),
convs AS (
    SELECT conv_id AS c, conv_id - conv_id % 20 AS base, {_CRC.format("CAST(conv_id AS VARCHAR)")} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc),
joined AS (
    SELECT c, 0 AS part, pos, said, words FROM convs JOIN own ON own.conv_id = base AND pos < h
    UNION ALL SELECT c, 1, pos, said, words FROM convs JOIN own ON own.conv_id = c AND pos >= h),
built AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, said, words FROM joined),
paths(c, depth, path, words) AS (
    SELECT c, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT) FROM convs
    UNION ALL SELECT paths.c, built.depth, sha256(path || sha256(said)), built.words FROM paths JOIN built ON built.c = paths.c AND built.depth = paths.depth + 1),
parents AS (SELECT p.*, q.path AS above FROM paths p LEFT JOIN paths q ON q.c = p.c AND q.depth = p.depth - 1),
nodes AS (SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(words) AS words FROM parents GROUP BY depth, path),
children AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, path)),
below(depth, path, level, node) AS (
    SELECT depth, path, depth, path FROM nodes
    UNION ALL SELECT below.depth, below.path, n.depth, n.path FROM below JOIN nodes n ON n.above = below.node AND n.depth = below.level + 1),
totals AS (
    SELECT below.depth, below.path, sum((n_convs - 1) * words) AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
    FROM below JOIN counted ON counted.depth = below.level AND counted.path = below.node GROUP BY ALL),
ends AS (
    SELECT depth, path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends
    FROM (SELECT c, max(depth) AS depth, max_by(path, depth) AS path FROM paths GROUP BY c) GROUP BY depth, path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.n_children AS BIGINT) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM counted n JOIN totals USING (depth, path) LEFT JOIN ends USING (depth, path) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.above
"""

ORACLE = {
    "op1_decontamination": _DECONTAMINATION,
    "op3_minhash_neardup": _NEAR_DUPLICATES,
    "op4_url_filter": _URL_FILTER,
    "op7_warc_normaliser": _RECORDS,
    "op11_importance_resampling": _RESAMPLING,
    "op12_conversation_trie": _TRIE,
}
