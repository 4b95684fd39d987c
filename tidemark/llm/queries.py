"""One query for each operator over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.common import documents
from tidemark.llm.conversations import damaged, repair_conversations
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.fingerprints import as_text, fingerprints
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.masked_lm import score_language, train_language_model
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.negatives import hard_negatives
from tidemark.llm.packing import pack_texts
from tidemark.llm.passages import dedup_passages
from tidemark.llm.pii import KINDS, find_pii
from tidemark.llm.quality import score_quality, train_quality
from tidemark.llm.toxicity import score_toxicity, train_toxicity
from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return fn

    return register


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(key: str, folds: int) -> Column:
    return F.crc32(F.col(key).cast("string")) % folds


# Equal to the operator without its sketches: all pairs that share a shingle, and their closure.
NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(
    range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.other) AS component_id, min(r.other) = s.doc_id AS kept
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""


@query("op1_minhash_near_dedup", NEAR_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, percent=85)


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


@query("op3_masked_lm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_language(docs, train_language_model(docs))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_toxicity(docs, labels(spark, sf_dir), keep=fold("_key", 5) != 0)
    return score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
        F.size("sentences").cast("long").alias("n_offending"),
    )


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack_texts(documents(spark, sf_dir), tokenizer, public_tokenizers.PATTERN)


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe_round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_quality(docs, labels(spark, sf_dir), keep=fold("_key", 3) != 1)
    return score_quality(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s.base & (s.kind == kind))).cast("long")

    base = F.filter("pii", lambda s: s.base)
    return find_pii(documents(spark, sf_dir)).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )


@query(
    "op10_line_dedup",
    """
    WITH split AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
      FROM documents
    ), pairs AS (
      SELECT doc_id, i AS last, lag(i) OVER doc AS first, lag(line) OVER doc || chr(10) || line AS body
      FROM split WHERE trim(translate(line, chr(9) || chr(13), '')) <> ''
      WINDOW doc AS (PARTITION BY doc_id ORDER BY i)
    ), late AS (
      SELECT doc_id, first, last FROM pairs WHERE first IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, last) > 1
    ), gone AS (
      SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM late
    )
    SELECT s.doc_id, coalesce(string_agg(s.line, chr(10) ORDER BY s.i) FILTER (g.i IS NULL), '') AS text,
      count(*) AS n_lines, count(g.i) AS n_removed
    FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i GROUP BY s.doc_id
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


@query(
    "op11_substring_dedup",
    """
    WITH words AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
      FROM documents
    ), windows AS (
      SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS body
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
    ), late AS (
      SELECT doc_id, i FROM windows
      QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1
    ), gone AS (
      SELECT DISTINCT doc_id, i + j AS i FROM late CROSS JOIN (SELECT unnest(range(20)) AS j) places
    ), listed AS (
      SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
    ), kept AS (
      SELECT w.doc_id, w.w, coalesce(len(l.gone), 0) AS n_removed, l.gone
      FROM words w LEFT JOIN listed l ON l.doc_id = w.doc_id
    )
    SELECT doc_id, len(w) AS n_words, n_removed, sha256(array_to_string(
      CASE WHEN n_removed = 0 THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
    FROM kept
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


# Cells as text, cost in nine digits before the audit, so that the least text is the least cell;
# c[1] to c[4] are those of what came so far: nothing, then a turn of system, user, assistant.
_NO_CELL = "'~'"


def _then(cell: str, cost: int, letter: str) -> str:
    return f"CASE WHEN {cell} = '~' THEN '~' ELSE printf('%09d', substr({cell}, 1, 9)::BIGINT + {cost}) || substr({cell}, 10) || '{letter}' END"


def _turn(role: str, froms: list[int]) -> list[str]:
    """Cells that lead to a turn of this role, by keeping or re-roling row r."""
    extra = "CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END"
    out = []
    for i in froms:
        cell = f"c[{i}]"
        keep = f"printf('%09d', substr({cell}, 1, 9)::BIGINT + {extra}) || substr({cell}, 10) || 'K'"
        rerole = f"printf('%09d', substr({cell}, 1, 9)::BIGINT + 1 + {extra}) || substr({cell}, 10) || 'R'"
        change = "'~'" if role == "s" else rerole
        out.append(
            f"CASE WHEN {cell} = '~' OR r.fault IN ('blank', 'duplicate') THEN '~' "
            f"WHEN r.initial = '{role}' THEN {keep} ELSE {change} END"
        )
    return out


def _all_turns() -> str:
    cells = [[], _turn("s", [1]), _turn("u", [1, 2, 4]), _turn("a", [3])]
    return "[" + ", ".join(f"least({', '.join([_then(f'c[{i + 1}]', 2, 'D'), _NO_CELL, *cells[i]])})" for i in range(4)) + "]"


_INSERT_USER = f"least(c[3], {_then('c[1]', 5, 'I')}, {_then('c[2]', 5, 'I')}, {_then('c[4]', 5, 'I')})"
_INSERT_ASSISTANT = f"least(c[4], {_then('c[3]', 5, 'I')})"

# Bit by bit over the id and the turn, which are ASCII.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda s: ascii(s)::BIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

REPAIR_SQL = f"""
WITH named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32} % 20 AS f
  FROM conversations
), turns AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, unnest(CASE f WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM named
), numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body
  FROM turns
), judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'initial': initial, 'fault': fault, 'role': role, 'text': text}} ORDER BY i) AS rows
  FROM judged GROUP BY conv_id
), parsed AS (
  SELECT *, list_reduce(list_prepend({{'initial': '', 'fault': 'none', 'role': '', 'text': '', 'c': ['000000000', '~', '000000005I', '000000010II']}},
    list_transform(rows, lambda r: {{'initial': r.initial, 'fault': r.fault, 'role': r.role, 'text': r.text, 'c': ['~', '~', '~', '~']}})),
    lambda acc, r: {{'initial': '', 'fault': '', 'role': '', 'text': '', 'c':
      list_transform(list_transform(list_transform([acc.c], lambda c: {_all_turns()}),
        lambda c: [c[1], c[2], {_INSERT_USER}, c[4]]), lambda c: [c[1], c[2], c[3], {_INSERT_ASSISTANT}])[1]}}).c AS c
  FROM told
), chosen AS (
  SELECT *, substr(least(c[1], c[4]), 1, 9)::BIGINT AS cost, substr(least(c[1], c[4]), 10) AS audit FROM parsed
), letters AS (
  SELECT conv_id, rows, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS k FROM chosen WHERE audit <> ''
), placed AS (
  SELECT conv_id, letter, k, rows[(sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY k))::BIGINT] AS r FROM letters
), outputs AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS o,
    first_value(letter = 'K' AND r.initial = 's') OVER (PARTITION BY conv_id ORDER BY k) AS system_first
  FROM placed WHERE letter <> 'D'
), lines AS (
  SELECT conv_id, k, CASE letter WHEN 'K' THEN r.role ELSE CASE WHEN (o - system_first::INT) % 2 = 0 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE letter WHEN 'I' THEN '' ELSE r.text END AS line
  FROM outputs
), repaired AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS body FROM lines GROUP BY conv_id
)
SELECT n.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(c.cost, 0) AS cost, coalesce(c.audit, '') AS audit,
  sha256(coalesce(r.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) n
LEFT JOIN chosen c ON c.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM n.conv_id
"""


@query("op12_conversation_repair", REPAIR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query(
    "op13_hard_negatives",
    """
    WITH parts AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
      FROM parts a JOIN parts b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
    ), positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
      (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
      s.other_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
      AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
    QUALIFY rank <= 3
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)
