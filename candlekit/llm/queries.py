"""The queries of this package over the given tables, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlekit.llm import bloom_cascade as B
from candlekit.llm import merkle_fixity as M
from candlekit.llm.bounded_ring import shard_rows
from candlekit.llm.collocations import mine_collocations
from candlekit.llm.containment_search import contained_items
from candlekit.llm.curriculum_mix import mix_sources
from candlekit.llm.exact_dedup import exact_dedup
from candlekit.llm.filter_audit import audit_filters
from candlekit.llm.jaccard_join import jaccard_components
from candlekit.llm.language_masks import identify, train
from candlekit.llm.piece_encoding import decode_tokens, encode_texts, read_model
from candlekit.llm.suffix_dedup import without_repeated_strings
from candlekit.llm.window_dedup import without_repeated_windows
from candlekit.session import stage

SHARDS = 8
#: Where the vocabulary files are, and the model of op12.
TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = "piece_bpe_32k.model"
ARCHIVE_PAGES = 4096


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def warc_records(pages: DataFrame) -> DataFrame:
    """archive, offset, length, digest, record_id of the pages written as WARC records,
    ARCHIVE_PAGES to a file, in the order of page_id; also url, and cut_digest: the digest
    if half of the payload is lost.

    Pages without page_id go to files of their own, by a hash of the url.
    """
    nameless = -1 - F.pmod(F.xxhash64("url"), F.lit(1024))
    record = M.warc_record(F.col("url"), F.col("html"))
    half = M.warc_record(F.col("url"), F.expr("left(html, length(html) div 2)"))
    rows = pages.select(
        F.col("page_id").alias("record_id"),
        "url",
        F.coalesce(F.floor(F.col("page_id") / ARCHIVE_PAGES), nameless).alias("archive"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
        F.sha2(half, 256).alias("cut_digest"),
    )
    before = Window.partitionBy("archive").orderBy("record_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def merkle_fixity(spark, folder):
    """A replica in which the hash of the url decides on damage: a payload is cut by half,
    a record is lost, or a copy of it stands at the next byte."""
    original = stage(warc_records(spark.read.parquet(f"{folder}/pages.parquet")), "warc-records")
    draw = F.substring(F.md5("url"), 1, 1)
    columns = ["archive", "offset", "length", "digest", "record_id"]
    kept = original.filter(F.coalesce(draw != "1", F.lit(True)))
    replica = kept.withColumn("digest", F.when(draw == "0", F.col("cut_digest")).otherwise(F.col("digest")))
    stray = original.filter(draw == "2").withColumn("offset", F.col("offset") + 1)
    found = M.audit_replicas(original, replica.select(*columns).unionByName(stray.select(*columns)))
    return found.withColumnRenamed("record_id", "page_id")


def curriculum_mix(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "source", "text")
    # Range-sorted by the first pass over each document; those that are not taken come last.
    return mix_sources(docs, carry=["doc_id"]).orderBy(F.array_min("positions").asc_nulls_last(), "doc_id")


def bounded_ring(spark, folder):
    text = F.coalesce("text", F.lit(""))
    rows = _documents(spark, folder).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    sharded = shard_rows(rows, SHARDS, tie="text_crc32")
    return sharded.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def bloom_cascade(spark, folder):
    """Listed are the addresses that some page is reached by with a ref parameter."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    url = F.col("url")
    listed = pages.filter(url.rlike(r"[?&]ref=")).select(F.concat(B.url_host(url), B.url_path(url)).alias("address"))
    return B.judge_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def containment_search(spark, folder):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contained_items(_documents(spark, folder), benchmark)


def jaccard_join(spark, folder):
    return jaccard_components(_documents(spark, folder).select("doc_id", "text"))


def window_dedup(spark, folder):
    cut = without_repeated_windows(_documents(spark, folder).select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def exact_copies(spark, folder):
    groups = exact_dedup(_documents(spark, folder).select("doc_id", "text"))
    return groups.withColumnRenamed("digest", "text_sha256")


def suffix_dedup(spark, folder):
    cut = without_repeated_strings(_documents(spark, folder).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def language_masks(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "text", "lang")
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    held_out = part == 2
    model = train(docs.filter(~held_out).select("text", "lang"))
    judged = identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def filter_audit(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "text", "source")
    return audit_filters(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def piece_encoding(spark, folder):
    model = read_model(f"{TOKENIZERS}/{PIECE_MODEL}")
    encoded = encode_texts(_documents(spark, folder).select("doc_id", "text"), model)
    decoded = decode_tokens(encoded.select("doc_id", "tokens"), model)
    return decoded.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def collocations(spark, folder):
    return mine_collocations(_documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_merkle_fixity": merkle_fixity,
    "op2_curriculum_mix": curriculum_mix,
    "op3_bounded_ring": bounded_ring,
    "op4_bloom_cascade": bloom_cascade,
    "op5_containment_search": containment_search,
    "op6_jaccard_join": jaccard_join,
    "op7_window_dedup": window_dedup,
    "op8_exact_dedup": exact_copies,
    "op9_suffix_dedup": suffix_dedup,
    "op10_language_masks": language_masks,
    "op11_filter_audit": filter_audit,
    "op12_piece_encoding": piece_encoding,
    "op13_collocations": collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op1_merkle_fixity": """
        WITH sized AS (
            SELECT page_id, page_id // 4096 AS archive, substr(md5(url), 1, 1) AS draw,
                   strlen('WARC/1.0') + 2 + strlen('WARC-Type: response') + 2 + strlen('WARC-Target-URI: ') + strlen(url)
                   + 2 + strlen('Content-Length: ') + strlen(CAST(strlen(html) AS VARCHAR)) + 4 + strlen(html) + 4 AS length
            FROM pages),
        placed AS (
            SELECT *, COALESCE(SUM(length) OVER (PARTITION BY archive ORDER BY page_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized)
        SELECT archive, CAST(start + CASE draw WHEN '2' THEN 1 ELSE 0 END AS BIGINT) AS "offset", page_id,
               CAST(length AS BIGINT) AS length,
               CASE draw WHEN '0' THEN 'altered' WHEN '1' THEN 'missing' ELSE 'extra' END AS kind
        FROM placed WHERE draw IN ('0', '1', '2')
    """,
    "op4_bloom_cascade": r"""
        WITH parsed AS (
            SELECT page_id, url,
                   translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM (SELECT page_id, COALESCE(url, '') AS url FROM pages)),
        listed AS (SELECT DISTINCT host || path AS address FROM parsed WHERE regexp_matches(url, '[?&]ref=')),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
            FROM parsed)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN host || path IN (SELECT address FROM listed) THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op5_containment_search": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM benchmark),
        doc_shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
        item_shingles AS (
            SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM items WHERE len(w) > 0)),
        sizes AS (SELECT item_id, COUNT(*) AS n_item FROM item_shingles GROUP BY item_id),
        shared AS (
            SELECT doc_id, item_id, COUNT(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n_shared, n_item FROM shared JOIN sizes USING (item_id) WHERE 10 * n_shared >= 8 * n_item
    """,
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, COALESCE(text, '') AS body FROM documents),
        g AS (SELECT body, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)
    """,
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS body,
                   regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        firsts AS (SELECT body, MIN(doc_id) AS first_id FROM d GROUP BY body),
        marks AS (
            SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                   MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        judged AS (
            SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
                   CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * len(regexp_extract_all(d.body, '[A-Z]')) > 2 * length(d.body) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(d.body, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN d.doc_id > first_id THEN 16 ELSE 0 END AS failed
            FROM d JOIN firsts ON d.body = firsts.body LEFT JOIN marks ON d.doc_id = marks.doc_id),
        counts AS (
            SELECT part, failed, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM judged GROUP BY part, failed),
        letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
            FROM letters a JOIN letters b ON a.bit <> b.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
            JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
        before AS (
            SELECT filter_order, instr(filter_order, x.letter) AS step, x.bit,
                   COALESCE((SELECT SUM(y.bit) FROM letters y
                             WHERE instr(filter_order, y.letter) < instr(filter_order, x.letter)), 0) AS gone
            FROM orders CROSS JOIN letters x),
        steps AS (
            SELECT part, filter_order, step, bit,
                   SUM(CASE WHEN (failed & CAST(gone + bit AS INTEGER)) = 0 THEN n ELSE 0 END) AS kept,
                   SUM(CASE WHEN (failed & CAST(gone AS INTEGER)) = 0 AND (failed & bit) <> 0 THEN n ELSE 0 END) AS removed,
                   SUM(CASE WHEN (failed & CAST(gone AS INTEGER)) <> 0 AND (failed & bit) <> 0 THEN n ELSE 0 END) AS redundant,
                   SUM(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
                   SUM(CASE WHEN (failed & CAST(gone AS INTEGER)) = 0 AND (failed & bit) <> 0 THEN good ELSE 0 END) AS good_lost,
                   SUM(CASE WHEN (failed & CAST(gone AS INTEGER)) = 0 AND (failed & bit) <> 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM counts CROSS JOIN before GROUP BY part, filter_order, step, bit),
        totals AS (SELECT part, bit, SUM(removed) AS shapley FROM steps GROUP BY part, bit)
        SELECT steps.part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
        FROM steps JOIN totals ON steps.part = totals.part AND steps.bit = totals.bit
    """,
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
                SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex(
                    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, COUNT(*) AS f
            FROM places CROSS JOIN (VALUES (1), (2), (3), (4)) AS lengths(k)
            WHERE i + k - 1 <= len(w) GROUP BY ALL),
        totals AS (SELECT lang, SUM(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
        frequent AS (SELECT * FROM grams WHERE f >= 30),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
        cuts AS (
            SELECT c.lang, c.k, c.phrase, c.f AS a, j, x.f AS l, y.f AS r, (2000000 * c.f::HUGEINT) // (x.f + y.f) AS score
            FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) AS c
            JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
            JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
        worst AS (
            SELECT * FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM cuts) AS c
            WHERE place = 1),
        inner_parts AS (
            SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, f
            FROM (SELECT *, unnest(range(1, k - m + 2)) AS s
                  FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates) AS c) AS c),
        outer_counts AS (SELECT lang, phrase, MAX(f) AS f FROM inner_parts GROUP BY lang, phrase),
        ranked AS (
            SELECT worst.*, ROW_NUMBER() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, worst.phrase) AS rank
            FROM worst LEFT JOIN outer_counts o ON o.lang = worst.lang AND o.phrase = worst.phrase
            WHERE o.f IS NULL OR 100 * o.f < 80 * a)
        SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
               CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
    """,
}
