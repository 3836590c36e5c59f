"""One query per operator: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import bpe, chat, cotrain, neardup, packing, pii, quality_rules, runs, search, shard, substrings, warc, whitening
from logweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, {1 + 10 * w}, 10))::BIGINT >> {35 - 5 * k}) & 31)::INT + 1, 1)"
    for w in range(4)
    for k in range(8)
)


@query(
    f"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw, sha1(coalesce(html, '')) AS sha FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM p)
    SELECT page_id, octet_length(raw) AS payload_bytes, {BASE32} AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f
    """
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC archives of all pages, normalised and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


PLANTED = [(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]


MARKS = sorted({r[k] for r in chat.TEMPLATE["roles"].values() for k in ("open", "name_end", "close") if k in r})


def escaped_length(text: str) -> str:
    """Each backslash and each start of a mark grows by one; no mark overlaps itself."""
    return f"length({text})" + "".join(
        f" + (length({text}) - length(replace({text}, '{m}', ''))) // {len(m)}" for m in ["\\", *MARKS]
    )


def role_length() -> str:
    known = {k: r for k, r in chat.TEMPLATE["roles"].items() if k != "*"}
    cases = " ".join(f"WHEN '{k}' THEN {len(r['open']) + len(r['close'])}" for k, r in known.items())
    other = sum(len(chat.TEMPLATE["roles"]["*"][k]) for k in ("open", "name_end", "close"))
    return f"CASE role {cases} ELSE {other} + {escaped_length('role')} END"


@query(
    f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t),
    s AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM o)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
        cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
        cast(sum({role_length()} + {escaped_length('text')}) AS BIGINT) AS formatted_chars,
        bool_and(CASE WHEN k = 1 THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
            WHEN before = 'user' THEN role = 'assistant' ELSE false END) AND arg_max(role, k) = 'assistant' AS valid
    FROM s GROUP BY conv_id
    """
)
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_turns(turns.unionByName(own)))


@query()
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 16 shards of equal row counts."""
    return shard.digests(table(spark, sf_dir, "documents"))


@query()
def op5_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the co-trained quality classifier."""
    return cotrain.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and weakly supervised verdict for all documents."""
    return quality_rules.score(table(spark, sf_dir, "documents"))


@query()
def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms for personal numbers and dates (the session's key,
    or a fixed one for test tables)."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.session_key(spark, "test tables")).select("doc_id", "text")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


@query(
    f"""
    WITH t AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY ALL),
    dl AS (SELECT doc_id, sum(n) AS len FROM tf GROUP BY doc_id),
    c AS (SELECT (SELECT count(*) FROM documents) AS docs, (SELECT sum(n) FROM tf) / (SELECT count(*) FROM documents) AS mean),
    idf AS (SELECT term, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS w FROM tf, c GROUP BY term, docs),
    s AS (
        SELECT q.doc_id AS query_id, d.doc_id,
            round(sum(q.n * w * (d.n * 2.2) / (d.n + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
        FROM tf q JOIN tf d USING (term) JOIN idf USING (term) JOIN dl ON dl.doc_id = d.doc_id, c
        WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, d.doc_id)
    SELECT query_id, cast(rank AS integer) AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    WHERE rank <= 10
    """
)
def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents by BM25 for every document with an id divisible by 20."""
    return search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by rank and decoded."""
    return bpe.digests(table(spark, sf_dir, "documents"))


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w, row_number() OVER () AS k FROM documents),
    win AS (
        SELECT k, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s
        FROM (SELECT k, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
    again AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1),
    gone AS (SELECT DISTINCT k, unnest(range(i, i + 35)) AS i FROM again),
    word AS (SELECT k, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
    kept AS (
        SELECT k, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
        FROM word ANTI JOIN gone USING (k, i) GROUP BY k)
    SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (k)
    """
)
def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 35-word windows that occur again."""
    return substrings.digests(table(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the four leading components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten becomes periodic from some word on, by its id's checksum;
    a null id leaves its words as they are."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


# The checksum's table by bits, then byte by byte over the id's digits.
CRC_TABLE = "list_reduce(list_prepend(b, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, x: xor(crc_table[(xor(c, x) & 255) + 1], c >> 8)))"""


@query(
    f"""
    WITH crc AS (SELECT list({CRC_TABLE} ORDER BY b) AS crc_table FROM range(256) r(b)),
    d AS (
        SELECT doc_id, {WORDS} AS w, row_number() OVER () AS k, CASE WHEN doc_id IS NULL THEN 1 ELSE {CRC} END AS h
        FROM documents, crc),
    e AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
    f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
    word AS (
        SELECT k, n, i, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
        FROM (SELECT *, unnest(range(n)) AS i FROM f)),
    pair AS (
        SELECT x.k, y.i - x.i AS q, x.i FROM word x JOIN word y
        ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
    stretch AS (
        SELECT k, q, min(i) AS start, count(*) + q AS length
        FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pair)
        GROUP BY k, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
    run AS (SELECT k, start, length, min(q) AS period FROM stretch GROUP BY k, start, length),
    best AS (
        SELECT * FROM run QUALIFY row_number() OVER (
            PARTITION BY k ORDER BY length::DOUBLE / period DESC, start, period) = 1),
    said AS (SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM run GROUP BY k),
    gone AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM run),
    kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (k, i) GROUP BY k)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
        sha256(coalesce(said.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM d LEFT JOIN best USING (k) LEFT JOIN said USING (k) LEFT JOIN kept USING (k)
    """
)
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, some of them made periodic first."""
    return runs.runs(table(spark, sf_dir, "documents"), change=repeated_tail, finish=runs.as_digests, schema=runs.DIGESTS)
