"""The queries of this package (``QUERIES``) and DuckDB SQL for those that SQL expresses (``ORACLES``).

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import common, decontaminate, divergence, exact_dedup, lexical, near_dedup, packing, simhash, substring_dedup, suffix_dedup, token_counts, token_files, toxicity, warc
from cabflow.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


@query(
    "op8_exact_dedup",
    "SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, "
    "doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256, "
    "CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes "
    "FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))",
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(common.table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


PAGES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
  min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to FROM f
"""


@query("op4_warc", PAGES)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(common.table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    records = warc.read_archives(spark, manifest, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(common.table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    token_files.write_token_ids(common.table(spark, sf_dir, "documents"), path, tokenizer("byte_bpe_50k.json"))
    return token_files.add_crc(token_files.read_token_ids(spark, path))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def toxicity_scorer(docs: DataFrame, labels: DataFrame) -> toxicity.Scorer:
    """Fitted on the rows that are not held out."""
    return toxicity.train(docs.filter(~toxicity.held_out()), labels.filter(~toxicity.held_out()))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_scorer(docs, common.table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(common.table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(common.table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find_classes(common.table(spark, sf_dir, "documents")).drop("node")


@query("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.find_components(common.table(spark, sf_dir, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
q AS (SELECT DISTINCT item_id, text FROM benchmark),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM q),
item AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
sums AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms)) AS all_terms FROM d),
posting AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM item) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), sums),
score AS (SELECT item_id, r, doc_id, CAST(sum(times * weight * ((1000000000 * tf) //
    (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // all_terms))))) AS BIGINT) AS score
  FROM item JOIN posting USING (term) JOIN w USING (term), sums GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""


@query("op13_lexical_search", SEARCH)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


AUDIT = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
whole AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
cell AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, source, sum(n) AS n FROM cell GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(s.n, 0) + 2 * w.v) AS p,
  1 + CAST(1000000000 AS HUGEINT) * (k.total + 2) // (w.n + 2 * w.v) AS q
  FROM grp g JOIN kept k ON k.lang = g.lang JOIN whole w ON w.lang = g.lang
  LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN size s ON s.lang = g.lang AND s.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT g.lang, g.source, h.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source),
term AS (SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
best AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM term)
SELECT lang, source, 'pair' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL SELECT lang, source, 'term', item, value, rank FROM best WHERE rank <= 10
"""


@query("op12_source_divergence", AUDIT)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(common.table(spark, sf_dir, "documents"))
