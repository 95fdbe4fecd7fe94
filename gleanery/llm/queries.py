"""Each operator over its whole table, as registered; digests are derived here from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import archive, bpe, language, mixing, packing, pii, prefix_trie, quality, rollup, simhash, token_files, tokens, turns, vectors
from gleanery.sources.scratch import scratch_path, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), root)
    return token_files.read_tokens(spark, root).withColumnRenamed("key", "doc_id")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS[:5], "base_failed", "kept")


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


#: For repeatable results; a real run passes a secret.
_KEY = b"test tables only"


@query
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), _KEY)


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy, root = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arcs = archive.write_arcs(table(spark, sf_dir, "pages"), legacy)
    records = archive.read_warcs(spark, root, archive.convert(spark, legacy, arcs, root))
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND least < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND least < page_id THEN least END AS refers_to
FROM f"""


@query
def op6_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, loaded under one tokenizer; those not in English moved to another; exact copies taken out.

    The second batch is sent twice, as a retry would.
    """
    docs = table(spark, sf_dir, "documents").withColumn("digest", F.sha2("text", 256))
    both = {"n_byte": tokens.BYTE_BPE, "n_word": tokens.WORD_BPE}
    counts = written(rollup.counted(docs, both).select("doc_id", "source", "lang", "digest", *both), "counts")
    first, second = F.lit("byte_bpe_50k"), F.lit("word_bpe_49k")
    moved = ~F.col("lang").eqNullSafe("en")
    load = counts.select(F.lit("insert").alias("op"), "source", "lang", first.alias("version"), F.col("n_byte").alias("n_tokens"))
    revised = counts.filter(moved).select(
        F.lit("revise").alias("op"), "source", "lang", second.alias("version"), F.col("n_word").alias("n_tokens"),
        F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), first.alias("old_version"), F.col("n_byte").alias("old_n_tokens"),
    )
    kept = counts.groupBy("digest").agg(F.min("doc_id").alias("kept"), F.count("*").alias("copies")).filter("copies > 1")
    copies = counts.join(kept, "digest").filter("doc_id <> kept").select(
        F.lit("delete").alias("op"), "source", "lang",
        F.when(moved, second).otherwise(first).alias("version"), F.when(moved, F.col("n_word")).otherwise(F.col("n_byte")).alias("n_tokens"),
    )
    own = rollup.Rollups(spark, scratch_path(spark, "rollups"))
    for batch, changes in (("load", load), ("retokenise", revised), ("copies", copies), ("retokenise", revised)):
        own.commit(batch, changes)
    own.compact()
    return own.totals()


def _damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults: one in twenty each is dropped, emptied, cut short, repeated, or given to the user."""
    space = F.lit(" ")
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), space) if isinstance(c, str) else c for c in ("conv_id", F.lit(":"), "turn")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))).drop("col")


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found, repaired = turns.repair(_damaged(conversations))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = conversations.select("conv_id").distinct()
    reports = found.join(turns.digests(repaired).withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    joined = ids.alias("i").join(reports.withColumnRenamed("conv_id", "_conv"), F.col("i.conv_id").eqNullSafe(F.col("_conv")), "left")
    return joined.select(
        "i.conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _rebuilt(conversations: DataFrame) -> DataFrame:
    """Strings of conversations whose first turns, up to eight, are those of the conversation with the next lower multiple of 5 as id."""
    width = prefix_trie.WIDTH
    own = written(prefix_trie.strings(conversations), "conversations")
    donors = own.toDF("_donor", "_key", "_sizes")
    h = F.col("h")
    asked = own.withColumns({"_donor": F.col("conv_id") - F.col("conv_id") % 5, "h": (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")})
    joined = asked.join(donors, "_donor", "left").withColumns({"_key": F.coalesce("_key", F.lit(bytearray())), "_sizes": F.coalesce("_sizes", F.array().cast("array<int>"))})
    key = F.concat(F.substring("_key", F.lit(1), h * width), F.substring("key", h * width + 1, F.length("key")))
    sizes = F.concat(F.slice("_sizes", F.lit(1), h), F.slice("sizes", h + 1, F.size("sizes")))
    return joined.select("conv_id", key.alias("key"), sizes.alias("sizes"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_rebuilt(table(spark, sf_dir, "conversations")))


# CRC-32 of the decimal id, bit by bit: a byte is xor-ed in, then eight marks shift.
_CRC = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))"""

SQL["op12_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce("role", ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce("role", ''), text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), named AS (SELECT *, CAST(conv_id AS VARCHAR) AS c FROM own),
asked AS (SELECT conv_id, turns, {_CRC} % 9 AS h FROM named),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(list_slice(d.turns, 1, a.h), []), list_slice(a.turns, a.h + 1, len(a.turns))) AS turns
  FROM asked a LEFT JOIN own d ON d.conv_id = a.conv_id - a.conv_id % 5
), prefixes AS (
  SELECT conv_id, len(turns) AS whole, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), keyed AS (
  SELECT conv_id, whole, depth, sha256(CAST(to_json(list_slice(turns, 1, depth)) AS VARCHAR)) AS node,
         CASE WHEN depth > 0 THEN sha256(CAST(to_json(list_slice(turns, 1, depth - 1)) AS VARCHAR)) END AS parent,
         CASE WHEN depth > 0 THEN octet_length(encode(turns[depth].t)) ELSE 0 END AS size
  FROM prefixes
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = whole), '') AS ends
  FROM keyed GROUP BY node
), families AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f USING (node)),
above AS (
  SELECT DISTINCT k.node, a.node AS top FROM keyed k JOIN keyed a ON a.conv_id = k.conv_id AND a.depth <= k.depth
), sums AS (
  SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
  FROM above JOIN full_nodes USING (node) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = n.parent"""


@query
def op13_bit_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))
