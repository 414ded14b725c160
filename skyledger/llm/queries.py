"""The operators applied to their whole tables, one registered query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    alignment,
    hadamard,
    langid,
    lattice,
    mixing,
    packing,
    secrets,
    setsketch,
    texts,
    tokenfiles,
    topk,
    warc,
    weighted,
    wordtokens,
)
from skyledger.sources.paths import Staging

Query = Callable[[SparkSession, str], DataFrame]

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SUBWORDS = public_tokenizers.path("piece_bpe_32k.model")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.with_edits(texts.documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts.documents(spark, sf_dir).withColumn("size", texts.word_count(F.col("text")))
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts.documents(spark, sf_dir)
    held_out = texts.remainder(F.col("doc_id"), 4) == 2
    return langid.identify(docs, langid.train(docs, ~held_out), held_out)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(texts.documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordtokens.count_tokens(texts.documents(spark, sf_dir), WORDS, limit=2048)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Staging(spark).folder
    tokenfiles.write(texts.documents(spark, sf_dir), folder, BYTES, end_id=0)
    return tokenfiles.read(spark, folder, tokenfiles.ids_crc32, "ids_crc32")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(topk.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return topk.search(rows.select("vec_id", whole.alias("vector")), queries=F.col("vec_id") % 50 == 0, k=5)


def op8_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(texts.documents(spark, sf_dir), texts.remainder(F.col("doc_id"), 7) == 2, SUBWORDS)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(texts.documents(spark, sf_dir), BYTES, capacity=2048, end_id=0)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = setsketch.near_duplicates(texts.documents(spark, sf_dir), percent=75).rows
    # Here kept is a matter of ids: rows that repeat the least id of a component are all kept.
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("kept")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.archived(pages, Staging(spark).folder, "page_id", "url", "html", least_bytes=0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(texts.documents(spark, sf_dir), BYTES, SUBWORDS)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(topk.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return hadamard.compress(rows, whole, parts=16, entries=64, rounds=2)


def queries() -> dict[str, Query]:
    found = [
        op1_fingerprints,
        op2_mixing,
        op3_language_id,
        op4_secrets,
        op5_token_counts,
        op6_token_files,
        op7_top_k,
        op8_lattice_scores,
        op9_packing,
        op10_near_duplicates,
        op11_warc,
        op12_alignment,
        op13_vector_codes,
    ]
    return {f.__name__: f for f in found}


# Ties go to the smaller vec_id; a shorter vector has zeros at its end. Rows that repeat a vec_id are told apart.
TOP_K = """
WITH usable AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), weights AS (
    SELECT row, vec_id, unnest(range(len(embedding))) AS term, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS weight FROM usable
), scores AS (
    SELECT q.row AS query_row, q.vec_id AS query_id, c.row, c.vec_id, sum(q.weight * c.weight)::BIGINT AS score
    FROM weights q JOIN weights c ON q.term = c.term AND q.row <> c.row
    WHERE q.vec_id % 50 = 0
    GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


NEAR_DUPLICATES = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM split
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


# Base 32 takes five bits a letter: five hexadecimal digits are four letters.
WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), digests AS (
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes, list_reduce(list_transform(range(8), lambda i:
        list_reduce(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            (((('0x' || substr(hex, 5 * i + 1, 5))::INTEGER >> b) & 31) + 1)::BIGINT, 1)), lambda x, y: x || y)),
        lambda x, y: x || y) AS payload_digest
    FROM payloads
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM digests
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""


def _vector_codes(rounds: int = 2) -> str:
    """Each round: distances to all entries, the nearest entry, the floors of means."""

    def assigned(books: str) -> str:
        return f"""
        SELECT vec_id, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance FROM (
            SELECT p.vec_id, p.part, e.entry, sum((p.x - e.x) * (p.x - e.x))::BIGINT AS distance
            FROM components p JOIN {books} e USING (part, place) GROUP BY ALL
        ) GROUP BY vec_id, part"""

    steps = []
    for r in range(rounds):
        steps += [
            f"assigned{r} AS ({assigned(f'books{r}')})",
            f"""books{r + 1} AS (
        SELECT part, place, entry, CASE WHEN n > 0 THEN ((s - ((s % n) + n) % n) // n)::BIGINT ELSE x END AS x FROM (
            SELECT b.part, b.place, b.entry, any_value(b.x) AS x, count(c.x) AS n, coalesce(sum(c.x), 0)::BIGINT AS s
            FROM books{r} b LEFT JOIN assigned{r} a USING (part, entry)
            LEFT JOIN components c ON c.vec_id = a.vec_id AND c.part = b.part AND c.place = b.place
            GROUP BY b.part, b.place, b.entry
        ))""",
        ]
    steps.append(f"final AS ({assigned(f'books{rounds}')})")
    following = ", ".join(steps)
    return f"""
    WITH kept AS (
        SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS number, len(embedding) // 16 AS size FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), flat AS (
        SELECT vec_id, number, size, unnest(range(len(embedding))) AS i, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept
    ), components AS (
        SELECT vec_id, number, i // size AS part, i % size AS place, x FROM flat
    ), books0 AS (
        SELECT part, place, number AS entry, x FROM components WHERE number < 64
    ), {following}, coded AS (
        SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error FROM final GROUP BY vec_id
    ), shown AS (
        SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM books{rounds}
    )
    SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded c JOIN kept USING (vec_id), shown
    """


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {"op7_top_k": TOP_K, "op10_near_duplicates": NEAR_DUPLICATES, "op11_warc": WARC, "op13_vector_codes": _vector_codes()}
