"""The registered query of every operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe_trie,
    chat_format,
    embedding_dedup,
    jaccard_join,
    language_id,
    lexical_search,
    packing,
    phrase_mining,
    quality_rules,
    substring_dedup,
    toxicity,
    url_filters,
    vector_search,
)
from ledgerloom.llm.common import table, tokenizer_file


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


#: The conversation that the query adds: both texts hold marks and an escape character.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(added)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, fetched on days made from their ids, against entries made from their hosts.

    The tables hold no list: every host is listed for 90 days, every parent domain for 30.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("day", F.col("page_id") * 37 % 365)
    hosts = (
        pages.select(url_filters.host_of(F.col("url")).alias("host"), "page_id")
        .groupBy("host").agg(F.min("page_id").alias("first"))
    )
    parents = (
        hosts.select(F.regexp_replace("host", r"^[^.]*\.", "").alias("host"), "first")
        .groupBy("host").agg(F.min("first").alias("first"))
    )

    def entries(of: DataFrame, start, days: int) -> DataFrame:
        listed = of.select("host", start.alias("day"), F.lit(True).alias("listed"))
        left = of.select("host", (start + days).alias("day"), F.lit(False).alias("listed"))
        return listed.unionByName(left)

    every = entries(hosts, F.col("first") * 7 % 200, 90).unionByName(
        entries(parents, F.col("first") % 50 + 300, 30)
    )
    return url_filters.judged(captures, every)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine(table(spark, sf_dir, "documents"))


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_chat_format": op3_chat_format,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_vector_search": op12_vector_search,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op3_chat_format": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        sized AS (
            SELECT conv_id, turn, role, text,
                length(text) + 4 * (length(text) - length(replace(text, '&', '')))
                    + 3 * (length(text) - length(replace(text, '<', '')))
                    + 4 * (length(text) - length(replace(text, '#', ''))) AS chars,
                length(role) + 4 * (length(role) - length(replace(role, '&', '')))
                    + 3 * (length(role) - length(replace(role, '<', '')))
                    + 4 * (length(role) - length(replace(role, '#', '')))
                    + 6 * (length(role) - length(replace(role, ':', ''))) AS role_chars,
                lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text)
                    IS NOT DISTINCT FROM role AS joins
            FROM said
        )
        SELECT conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
                AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars + CASE WHEN joins THEN 7 ELSE 14 + role_chars END) AS BIGINT)
                AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op8_url_filters": r"""
        WITH captures AS (
            SELECT page_id, page_id * 37 % 365 AS day, nullif(regexp_extract(lower(trim(url)),
                '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '') AS host
            FROM pages
        ),
        hosts AS (SELECT host, min(page_id) AS first FROM captures GROUP BY host),
        parents AS (
            SELECT regexp_replace(host, '^[^.]*\.', '') AS host, min(first) AS first
            FROM hosts GROUP BY 1
        ),
        entries AS (
            SELECT host, first * 7 % 200 AS day, true AS listed FROM hosts
            UNION ALL SELECT host, first * 7 % 200 + 90, false FROM hosts
            UNION ALL SELECT host, first % 50 + 300, true FROM parents
            UNION ALL SELECT host, first % 50 + 330, false FROM parents
        ),
        days AS (
            SELECT host, day, bool_or(listed) AS listed,
                lead(day) OVER (PARTITION BY host ORDER BY day) AS next_day
            FROM entries WHERE host IS NOT NULL AND day IS NOT NULL GROUP BY host, day
        )
        SELECT c.page_id, c.host, c.day, count(e.host) AS n_listed, count(e.host) > 0 AS blocked
        FROM captures c LEFT JOIN days e
            ON e.listed AND e.day <= c.day AND (c.host = e.host OR c.host LIKE '%.' || e.host)
            AND (e.next_day IS NULL OR c.day < e.next_day)
        GROUP BY c.page_id, c.host, c.day
    """,
    "op11_phrase_mining": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words FROM (
                SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
                FROM (
                    SELECT lang, unnest(string_split_regex(translate(text,
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[.,;:!?\x0A-\x0D]')) AS piece
                    FROM documents
                )
            ) WHERE len(words) > 0
        ),
        totals AS (SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
        starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS p FROM pieces),
        grams AS (
            SELECT lang, list_slice(words, p, p + size - 1) AS words, count(*) AS f
            FROM starts, range(1, 6) s(size)
            WHERE p + size - 1 <= len(words)
            GROUP BY ALL HAVING count(*) >= 100
        ),
        cuts AS (
            SELECT g.lang, g.words, g.f AS a, unnest(range(1, len(g.words))) AS k
            FROM grams g WHERE len(g.words) > 1
        ),
        scores AS (
            SELECT c.lang, c.words, c.a, c.k, x.f AS l, y.f AS r, t.n,
                1000 * CAST(c.a AS HUGEINT) * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
            FROM cuts c JOIN totals t USING (lang)
            JOIN grams x ON x.lang = c.lang AND x.words = list_slice(c.words, 1, c.k)
            JOIN grams y ON y.lang = c.lang AND y.words = list_slice(c.words, c.k + 1, len(c.words))
        ),
        lowest AS (
            SELECT * FROM scores
            QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
        ),
        inside AS (
            SELECT lang, list_slice(words, p, p + size - 1) AS words, max(a) AS most
            FROM (SELECT lang, words, a, unnest(range(1, len(words))) AS p FROM lowest),
                range(2, 5) s(size)
            WHERE size < len(words) AND p + size - 1 <= len(words)
            GROUP BY ALL
        ),
        kept AS (
            SELECT l.* FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.words = l.words
            WHERE i.most IS NULL OR 100 * i.most < 100 * l.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM (SELECT *, array_to_string(words, ' ') AS phrase FROM kept)
        QUALIFY rank <= 2000
    """,
    "op13_lexical_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ),
        found AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(tf) AS n FROM found GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM found, total GROUP BY term, docs
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        sums AS (
            SELECT a.item_id, f.doc_id, CAST(sum(w.w * ((1000000000 * f.tf) //
                (1000 * f.tf + 8 * (100 - 90 + CAST(90 * s.n * t.docs AS BIGINT) // t.all_terms))))
                AS BIGINT) AS score
            FROM asked a JOIN found f USING (term) JOIN weights w USING (term)
            JOIN sizes s USING (doc_id), total t
            GROUP BY a.item_id, f.doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT)
            AS rank, doc_id, score
        FROM sums WHERE score > 0 QUALIFY rank <= 10
    """,
}
