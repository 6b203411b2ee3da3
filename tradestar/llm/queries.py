"""The registered queries of this package: thin digests of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.suffix_dedup import remove_repeats
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, carry=["doc_id"]).select("doc_id", "dedup.n_bytes", "dedup.n_removed", "dedup.n_spans",
                                       "dedup.kept_sha256")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.simhash import near_copies
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_copies(docs, n_words=3, radius=3).select(
        "doc_id", F.lower(F.lpad(F.hex("near.fp"), 16, "0")).alias("fingerprint"), "near.component_id")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tradestar.llm.packing import pack
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False).select("doc_id", "piece.*")


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tradestar.llm.bpe import encode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                  carry=["doc_id"], with_ids=False).select("doc_id", "bpe.*")


def remainder(column: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.toxicity import fit, score
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), learn=remainder("id", 4) != 2)
    return score(docs, model, carry=["doc_id"]).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "toxicity.score", "toxicity.predicted",
        "toxicity.evidence")


@query
def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.merkle import with_neighbours
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_neighbours(docs, carry=["doc_id"]).select("doc_id", "merkle.*")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.quality import score
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, table(spark, sf_dir, "labels"), learn=remainder("id", 5) != 0, carry=["doc_id"]).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "quality.score", "quality.predicted")


@query
def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.line_rules import clean
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean(docs, carry=["doc_id"], with_text=False).select("doc_id", "rules.*")


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.pii import KINDS, find, listed
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("long")
    return find(docs).select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:-1]],
                             F.sha2(listed(F.col("pii.base")), 256).alias("base_sha256"),
                             listed(F.col("pii.spans")).alias("spans"))


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.licenses import scan
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    one = lambda c: F.array_join(f"license.{c}", ",").alias(c)
    return scan(docs).select("doc_id", "license.n_words", "license.n_base", "license.first_word",
                             "license.last_word", one("base_labels"), one("labels"), "license.score")


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.warc import read, write
    archive = write(table(spark, sf_dir, "pages"), scratch_path(spark, "llm", "warc"))
    return read(archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


ORACLE["op11_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, strlen(body)::BIGINT AS n, lower(sha1(body)) AS h,
             min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, n AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
           ((strpos('0123456789abcdef', substr(h, CAST(i * 5 // 4 + 1 AS BIGINT), 1)) - 1) * 16
            + strpos('0123456789abcdef', substr(h || '0', CAST(i * 5 // 4 + 2 AS BIGINT), 1)) - 1)
           // (1 << CAST(3 - i * 5 % 4 AS INTEGER))) % 32) AS BIGINT), 1) FOR i IN range(32)], 'string_agg', '')
           AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, true AS verified
FROM d
"""


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradestar.llm.divergence import audit
    return audit(table(spark, sf_dir, "documents"))


ORACLE["op13_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
           FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT doc) >= 10),
own AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
vocab AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
groups AS (SELECT g.lang, g.source, coalesce(sum(o.n), 0)::HUGEINT AS total
           FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN own o USING (lang, source) GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (g.total + 2 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + 2)) // (v.total + 2 * v.v) AS q
      FROM groups g JOIN vocab v USING (lang) JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(x.value, 0)::BIGINT AS value
          FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
          LEFT JOIN pairs x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
          UNION ALL
          SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                            ORDER BY value DESC, encode(item))::INTEGER AS rank FROM every)
WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tradestar.llm.alignment import align
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                 with_groups=False).select("doc_id", "align.*")
