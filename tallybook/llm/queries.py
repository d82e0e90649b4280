"""The operators as registered queries, and what SQL can say of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import decontaminate, digests, langid, licences, mixing, negatives, pages, pii, quality, repair, simhash, suffixes, warc
from tallybook.llm.common import read
from tallybook.sources.workspace import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

# The bits of SimHash near-dedup.
SHINGLE, MAX_DISTANCE = 3, 3


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: of each hundred ids of a source the first is ``source/hundred/LICENSE``, others lie a language below."""
    docs = read(spark, sf_dir, "documents")
    folder = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string"))
    below = F.concat_ws("/", folder, "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.when(F.col("doc_id") % 100 == 0, F.concat(folder, F.lit("/LICENSE"))).otherwise(below)
    found = licences.scan_licences(docs.select("doc_id", path.alias("path"), "text"))
    return found.select("doc_id", "path", "licence", "origin", F.round("cosine", 9).alias("cosine"), "line", "from_path")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.transform("leaks", lambda leak: leak["item_id"]).alias("item_ids"),
        F.coalesce(F.array_min(F.transform("leaks", lambda leak: leak["edits"])), F.lit(-1).cast("long")).alias("least_edits"),
    )


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=SHINGLE, max_distance=MAX_DISTANCE)
    return classes.select("doc_id", simhash.hex_print("print").alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = langid.identify_language(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return known.select("doc_id", langid.held_out("doc_id").alias("held_out"), "language.*")


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(read(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages"), path)
    found = warc.read_warc(spark, path).where("type is not null")
    return found.select(
        warc.page_number("record_id", "long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.page_number("refers_to", "long").alias("refers_to"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def _count(kind: str) -> Column:
    return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii_spans", lambda s: s["kind"] != pii.TERM)
    return found.select(
        "doc_id",
        *[_count(kind) for kind in pii.KINDS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("pii_spans")).alias("spans"),
    )


def op10_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.compare_with_next(read(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return repair.summarised(conversations, repair.repair(repair.damaged(conversations)))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_licences": op1_licences,
    "op2_decontaminate": op2_decontaminate,
    "op3_suffixes": op3_suffixes,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_pages": op6_pages,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_pii": op9_pii,
    "op10_digests": op10_digests,
    "op11_repair": op11_repair,
    "op12_negatives": op12_negatives,
    "op13_quality": op13_quality,
}


def _least(*options: str) -> str:
    """The cheapest of some ways, of equal ones that with the least audit; a way is {c: cost, a: audit, t: text}."""
    return f"list_sort([{', '.join(options)}])[1]"


def _way(before: str, cost: str, letter: str = "", line: str = "''") -> str:
    return f"{{'c': {before}.c + {cost}, 'a': {before}.a || '{letter}', 't': {before}.t || {line}}}"


_NEVER = "{'c': 1000000000, 'a': '', 't': ''}"
_USER, _ASSISTANT = "'user:' || chr(10)", "'assistant:' || chr(10)"
_OWN = "r.role || ':' || r.text || chr(10)"
_TO_USER, _TO_ASSISTANT = "'user:' || r.text || chr(10)", "'assistant:' || r.text || chr(10)"


def _taken(to: str, befores: list[str], role_line: str) -> str:
    """Ways to a state by a row: deleted, kept if its role fits, or given the role."""
    ways = [_way(f"i.{to}", "2", "D")]
    for before in befores:
        ways.append(f"CASE WHEN r.gone OR r.initial <> '{to}' THEN {_NEVER} ELSE {_way(f'i.{before}', 'r.more', 'K', _OWN)} END")
        if to != "s":
            ways.append(f"CASE WHEN r.gone THEN {_NEVER} ELSE {_way(f'i.{before}', 'r.more + 1', 'R', role_line)} END")
    return _least(*ways)


# A checksum bit by bit: each byte is mixed in, then shifted out in eight steps.
_CRC32 = """xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split({name}, ''),
  lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda h, x: CASE WHEN x >= 0 THEN xor(h, x) ELSE xor(h >> 1, 3988292384 * (h & 1)) END), 4294967295)"""

# Row by row: z, s, u, a are the best ways to end with nothing, a system, a user, an assistant turn.
_REPAIR = f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
harmed AS (SELECT *, {_CRC32.format(name='name')} % 20 AS harm FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed WHERE harm <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS earlier,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?')
              THEN 'truncated' END AS fault
  FROM numbered),
r AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), FALSE) AS gone,
         CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM faulty),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS rows
  FROM r GROUP BY conv_id),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': 0, 'a': '', 't': ''}} AS z, {_NEVER} AS s, {_NEVER} AS u, {_NEVER} AS a FROM counted
  UNION ALL
  SELECT i.conv_id, r.n, {_way('i.z', '2', 'D')} AS z, {_taken('s', ['z'], "''")} AS s,
         {_taken('u', ['z', 's', 'a'], _TO_USER)} AS u, {_taken('a', ['u'], _TO_ASSISTANT)} AS a
  FROM (
    SELECT conv_id, n, z, s,
           {_least('u', *[_way(q, '5', 'I', _USER) for q in 'zsa'])} AS u,
           {_least('a', _way('u', '5', 'I', _ASSISTANT), *[_way(q, '10', 'II', _USER + ' || ' + _ASSISTANT) for q in 'zs'])} AS a
    FROM walk) i
  JOIN r ON r.conv_id IS NOT DISTINCT FROM i.conv_id AND r.n = i.n + 1),
ended AS (
  SELECT w.conv_id,
         {_least('z', 'a', _way('u', '5', 'I', _ASSISTANT), _way('s', '10', 'II', _USER + ' || ' + _ASSISTANT))} AS best
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows = w.n)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
       sha256(CASE WHEN length(best.t) > 0 THEN left(best.t, length(best.t) - 1) ELSE '' END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), TRUE)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
   AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op7_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        t AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM p LEFT JOIN t ON p.payload_digest = t.payload_digest AND payload_bytes >= 1000
    """,
    "op11_repair": _REPAIR,
    "op12_negatives": _NEGATIVES,
}
