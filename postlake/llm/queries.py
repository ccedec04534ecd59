"""The queries of the operators in this package, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the labels whose crc32(doc_id) mod 5 is not 0; every text scored."""
    from postlake.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.encode import encode_digests
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.linededup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", F.coalesce(F.array_join("_removed", ","), F.lit("")).alias("removed_lines"),
        F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"))


@query
def op6_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.multiindex import nearest, usable
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document next to its edited text and to the next document."""
    from postlake.llm import fingerprint as fp
    pairs = fp.with_next(table(spark, sf_dir, "documents"))
    made = pairs.withColumn("edited", fp.edited(F.col("text"), F.col("next_text"))).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("sketch").alias("own"), fp.sketch(F.col("edited")).alias("changed"), F.col("next_sketch").alias("following"))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", fp.shown(F.col("own")).alias("fingerprint"),
        fp.shown(F.col("changed")).alias("edited_fingerprint"),
        fp.resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        fp.resemblance(F.col("own"), F.col("following")).alias("near_next"),
        fp.distinct_shingles(F.col("own")).alias("n_shingles"))


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.neardup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), 4, 85).drop("row")


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.licenses import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.secrets import secret_digests
    return secret_digests(table(spark, sf_dir, "documents"))


#: The rules that op11 judges by.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


@query
def op11_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that a rule decides are the labelled ones; hosts without a deciding rule get their posterior."""
    from postlake.llm.reputation import judge
    return judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op12_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.interaction import audit
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_balltree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postlake.llm.balltree import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def reputation_sql() -> str:
    from postlake.llm.reputation import DEVIATIONS, LEAST_SPREAD, MOST_SPREAD, THRESHOLD
    rules = ", ".join(f"('{said}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for said, rule in URL_RULES)

    def level(name: str, source: str, keys: str) -> str:
        own = "prior * (1 - prior)"
        return f"""{name}_sums AS (SELECT sum(n * (k / n - prior) * (k / n - prior) - {own}) FILTER (n > 0) AS beyond,
          sum({own} * (n - 1)) FILTER (n > 0) AS room FROM {source}),
        {name}_weight AS (SELECT 1 / CASE WHEN coalesce(room, 0) > 0
          THEN least(greatest(coalesce(beyond, 0) / room, {LEAST_SPREAD}), {MOST_SPREAD}) ELSE {MOST_SPREAD} END - 1 AS weight FROM {name}_sums),
        {name} AS (SELECT {keys}, n, k, prior * weight + k AS a, (1 - prior) * weight + n - k AS b,
          (prior * weight + k) / ((prior * weight + k) + ((1 - prior) * weight + n - k)) AS mean FROM {source}, {name}_weight)"""

    return f"""
    WITH rules(said, rule, rule_host, rule_path) AS (VALUES {rules}),
    cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    judged AS (SELECT page_id, host, path,
      (SELECT max_by(rule, length(rule)) FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule FROM split),
    said AS (SELECT judged.*, rules.said FROM judged LEFT JOIN rules USING (rule)),
    bare AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':\\d*$', '') AS name FROM said),
    hosts AS (SELECT host, count(said)::DOUBLE AS n, (count(*) FILTER (said = 'block'))::DOUBLE AS k,
      any_value(CASE WHEN regexp_matches(name, '^\\d+(\\.\\d+){{3}}$') OR name LIKE '[%' THEN name
        ELSE array_to_string(list_slice(string_split(name, '.'), -2, -1), '.') END) AS domain,
      any_value(CASE WHEN regexp_matches(name, '^\\d+(\\.\\d+){{3}}$') OR name LIKE '[%' THEN '' ELSE string_split(name, '.')[-1] END) AS suffix
      FROM bare GROUP BY host),
    all_suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM hosts) AS prior FROM hosts GROUP BY suffix),
    {level("by_suffix", "all_suffixes", "suffix")},
    all_domains AS (SELECT suffix, domain, sum(hosts.n) AS n, sum(hosts.k) AS k, any_value(by_suffix.mean) AS prior FROM hosts JOIN by_suffix USING (suffix) GROUP BY suffix, domain),
    {level("by_domain", "all_domains", "suffix, domain")},
    all_hosts AS (SELECT host, hosts.n, hosts.k, by_domain.mean AS prior FROM hosts JOIN by_domain USING (suffix, domain)),
    {level("by_host", "all_hosts", "host")},
    bounds AS (SELECT host, mean - {DEVIATIONS} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM by_host)
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN bound > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict FROM said JOIN bounds USING (host)"""


ORACLES["op11_reputation"] = reputation_sql()

ORACLES["op12_interaction"] = r"""
    WITH letters(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
      FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31
      AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
    steps AS (SELECT filter_order, s.step, bits[s.step] AS own, coalesce(list_sum(bits[1:s.step - 1]), 0)::BIGINT AS before
      FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
    texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    words AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
    firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    masks AS (SELECT part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
      + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN coalesce(doc_id > first_id, false) THEN 16 ELSE 0 END AS mask,
      coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
    counted AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL),
    made AS (SELECT part, filter_order, step, own,
      sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
      sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN n ELSE 0 END)::BIGINT AS removed,
      sum(CASE WHEN mask & before > 0 AND mask & own > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
      sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
      sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
      sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM counted, steps GROUP BY ALL)
    SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
      (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM made"""

ORACLES["op13_balltree"] = r"""
    WITH pattern AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS p),
    low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    held AS (SELECT doc_id, regexp_extract_all(text, p) AS terms FROM low, pattern),
    full_docs AS (SELECT doc_id, len(terms)::BIGINT AS n, terms FROM held WHERE len(terms) > 0),
    totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM full_docs),
    counts AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM full_docs) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term), totals),
    item_terms AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p)) AS term FROM benchmark, pattern) GROUP BY ALL),
    scores AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // words)))))::BIGINT AS score
      FROM item_terms JOIN weights USING (term) JOIN counts USING (term), totals GROUP BY item_id, doc_id)
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""
