"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.chat import format_chats
from shelfwise.llm.collocations import collocations
from shelfwise.llm.common import bucket, read
from shelfwise.llm.decontaminate import contamination
from shelfwise.llm.exact_dedup import exact_copies
from shelfwise.llm.language import identify, train_language
from shelfwise.llm.language_model import score_language_model
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.packing import VECTOR, pack
from shelfwise.llm.quality import THRESHOLD, score_quality
from shelfwise.llm.simhash import near_copies
from shelfwise.llm.spelling import spelling_variants, word_counts
from shelfwise.llm.url_filter import ALLOW, BLOCK, filter_urls
from shelfwise.llm.warc import read_warc, write_warc
from shelfwise.session import shared_dir


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), nameless=True)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), capacities=VECTOR).drop("ids")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "lines", "removed_lines", "text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = bucket("doc_id", 4) == 2
    model = train_language(docs.where(~held_out).select("text", "lang"))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = score_language_model(read(spark, sf_dir, "documents"), train=bucket("doc_id", 7) != 2)
    return scores.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(bucket("doc_id", 5) != 0)
    scores = score_quality(read(spark, sf_dir, "documents"), labels.select("doc_id", F.col("quality").alias("label")))
    return scores.select(
        "doc_id",
        (bucket("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


# In one of so many pairs of a document and a word, the word loses a letter.
SLIP_EVERY = 199


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(read(spark, sf_dir, "documents"), slip_every=SLIP_EVERY))


# The stated rules: host, path, verdict.
URL_RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents")).withColumnRenamed("grp", "lang")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_simhash,
        op2_decontaminate,
        op3_best_fit_packing,
        op4_warc,
        op5_chat_format,
        op6_exact_dedup,
        op7_line_dedup,
        op8_language_id,
        op9_lm_score,
        op10_quality,
        op11_spelling_variants,
        op12_url_filters,
        op13_collocations,
    )
}

_OP2 = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, w[i : i + 9] AS gram, len(w[i : i + 9]) AS size
    FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s(i)
    WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT size FROM windows
), doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), starts AS (
    SELECT doc_id, i, size, w[i : i + size - 1] AS gram
    FROM doc_words, sizes, unnest(range(1, len(w) - size + 2)) AS s(i)
), hits AS (
    SELECT doc_id, i, starts.size, item_id FROM starts JOIN windows USING (gram)
), hit_words AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, size FROM hits), unnest(range(0, size)) AS s(k) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP4 = r"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), newest AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM newest
"""

# Line sets joined on words of their prefixes; each set is told by its first place and those of similar sets.
_OP7 = r"""
WITH parts AS MATERIALIZED (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no
    FROM documents WHERE text IS NOT NULL
), worded AS MATERIALIZED (
    SELECT *, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '[ 	-]+'), lambda w : w <> ''))) AS ws FROM parts
), sets AS MATERIALIZED (
    SELECT ws, len(ws) AS n, row_number() OVER () AS id, min((doc_id, no)) AS first FROM worded WHERE len(ws) > 0 GROUP BY ws
), tokens AS (
    SELECT id, n, unnest(ws) AS w FROM sets
), ranked AS (
    SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY f, w) AS place
    FROM tokens JOIN (SELECT w, count(*) AS f FROM tokens GROUP BY w) USING (w)
), prefixes AS (
    SELECT * FROM ranked WHERE place <= n - (n * 80 + 99) // 100 + 1
), pairs AS (
    SELECT DISTINCT x.id AS a, y.id AS b FROM prefixes x JOIN prefixes y
      ON x.w = y.w AND x.id <> y.id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), shared AS (
    SELECT a, s.n + t.n AS both_n, len(list_intersect(s.ws, t.ws)) AS common, t.first
    FROM pairs JOIN sets s ON s.id = a JOIN sets t ON t.id = b
), earlier AS (
    SELECT a AS id, min(first) AS first FROM shared WHERE 100 * common >= 80 * (both_n - common) GROUP BY a
), decided AS (
    SELECT worded.doc_id, worded.no, worded.line,
           coalesce(least(sets.first, coalesce(earlier.first, sets.first)) < (worded.doc_id, worded.no), false) AS gone
    FROM worded LEFT JOIN sets USING (ws) LEFT JOIN earlier USING (id)
), freed AS (
    SELECT doc_id, count(*)::INTEGER AS lines, count(*) FILTER (gone)::INTEGER AS removed_lines,
           coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text
    FROM decided GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(lines, 0) AS lines, coalesce(removed_lines, 0) AS removed_lines,
       CASE WHEN documents.text IS NOT NULL THEN freed.text END AS text
FROM documents LEFT JOIN freed USING (doc_id)
"""

_OP6 = r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

# The checksum goes byte by byte through the usual table of 256 remainders, which is worked out first.
_OP11 = r"""
WITH RECURSIVE remainders AS MATERIALIZED (
    SELECT list(r ORDER BY b) AS t FROM (
        SELECT b, list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, i : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS r
        FROM range(256) AS x(b)
    )
), runs AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents
    ) GROUP BY ALL
), bytes AS (
    SELECT run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs
), hashed AS (
    SELECT run, times, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i :
            ((strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1)::BIGINT)),
        lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM bytes, remainders
), words AS MATERIALIZED (
    SELECT word, sum(times)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, times
        FROM hashed
    ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cut AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS s(i)
), pairs AS (
    SELECT x.word, y.word AS near FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION SELECT x.word, y.word FROM cut x JOIN words y ON x.rest = y.word
    UNION SELECT y.word, x.word FROM cut x JOIN words y ON x.rest = y.word
), nearest AS (
    SELECT pairs.word, count(*) AS n_near, arg_min(near, (-n, near)) AS best, max(n) AS best_n
    FROM pairs JOIN words ON words.word = near GROUP BY pairs.word
), forms AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
    FROM words LEFT JOIN nearest USING (word)
), steps AS (
    SELECT word, word AS root, 0 AS step FROM forms
    UNION ALL
    SELECT steps.word, forms.form, step + 1 FROM steps JOIN forms ON forms.word = steps.root WHERE forms.form IS NOT NULL
), roots AS (
    SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

_OP12 = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), numbered AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), ranked AS (
    SELECT numbered.*, rule_host || rule_path AS rule, rule_verdict,
           row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
    FROM numbered LEFT JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM ranked WHERE place = 1
"""

_OP13 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, w[i : i + size - 1] AS gram, count(*) AS f
    FROM words, unnest([1, 2, 3, 4]) AS z(size), unnest(range(1, len(w) - size + 2)) AS s(i)
    GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE len(gram) = 1 GROUP BY lang
), often AS MATERIALIZED (
    SELECT * FROM grams WHERE f >= 30
), cuts AS (
    SELECT c.lang, c.gram, c.f AS a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
    FROM often c, unnest(range(1, len(c.gram))) AS s(k)
    JOIN often x ON x.lang = c.lang AND x.gram = c.gram[1 : k]
    JOIN often y ON y.lang = c.lang AND y.gram = c.gram[k + 1 :]
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), covers AS (
    SELECT lang, gram[i : i + size - 1] AS gram, max(f) AS longer
    FROM often, unnest([2, 3]) AS z(size), unnest(range(1, len(gram) - size + 2)) AS s(i)
    WHERE size < len(gram) GROUP BY ALL
), kept AS (
    SELECT scored.*, array_to_string(gram, ' ') AS phrase
    FROM scored LEFT JOIN covers USING (lang, gram) WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": _OP2,
    "op4_warc": _OP4,
    "op6_exact_dedup": _OP6,
    "op7_line_dedup": _OP7,
    "op11_spelling_variants": _OP11,
    "op12_url_filters": _OP12,
    "op13_collocations": _OP13,
}
