"""The registered queries of these operators, with their checking SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakevault.llm import bitslice, chat, exact_dedup, fast_trie, near_dedup, packing, periodic_runs, poisson_mix, run_index, secrets, substring_dedup, toxicity, warc
from lakevault.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return register


@_query(
    "op10_exact_dedup",
    r"""
    WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM n WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.dedup_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


MIX_POWER, MIX_SEED = 0.7, 17


@_query(
    "op9_poisson_mix",
    f"""
    WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    rates AS (SELECT source, pow(n::DOUBLE, {MIX_POWER}) / sum(pow(n::DOUBLE, {MIX_POWER})) OVER () * sum(n) OVER ()::DOUBLE / n AS rate FROM sizes),
    pieces AS (SELECT source, greatest(1, ceil(rate / 8))::INT AS pieces, rate / greatest(1, ceil(rate / 8)) AS mean FROM rates),
    cdf(source, k, p, c) AS (
        SELECT source, 0, exp(-mean), exp(-mean) FROM pieces
        UNION ALL SELECT cdf.source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1)
        FROM cdf JOIN pieces ON cdf.source IS NOT DISTINCT FROM pieces.source WHERE k < 63),
    draws AS (
        SELECT doc_id, d.source, ('0x' || substr(md5('{MIX_SEED}|' || doc_id || '|' || i), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
        FROM documents d JOIN pieces p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(generate_series(1, p.pieces)) AS i) s),
    counts AS (SELECT doc_id, count(*) AS n FROM draws JOIN cdf ON draws.source IS NOT DISTINCT FROM cdf.source AND c <= u GROUP BY doc_id),
    copies AS (SELECT doc_id, unnest(generate_series(1, n)) AS copy FROM counts)
    SELECT d.*, copy::INT AS copy, ('0x' || substr(md5('order|{MIX_SEED}|' || doc_id || '|' || copy), 1, 15))::BIGINT AS shuffle_key
    FROM copies JOIN documents d USING (doc_id)
    """,
)
def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.mix(table(spark, sf_dir, "documents"), power=MIX_POWER, seed=MIX_SEED)


@_query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
    k AS (SELECT *, octet_length(encode(t)) AS payload_bytes, sha1(t) AS payload_digest FROM p),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS keeper FROM k)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
    FROM g
    """,
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_records(spark, warc.archive_pages(table(spark, sf_dir, "pages")))


@_query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query(
    "op8_bitslice_top_k",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op8_bitslice_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.search_table(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)

PLANTED = r"\### Assistant: </turn> ok"


@_query("op4_chat_windows")
def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], given.schema)
    return chat.read_back(chat.format_windows(given.unionByName(planted)))


@_query("op6_secret_ownership")
def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_table(table(spark, sf_dir, "documents"))


@_query("op7_toxic_severity")
def op7_toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@_query("op2_near_dedup")
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


@_query("op1_repeated_passages")
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@_query("op11_run_index")
def op11_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_index.repeats(table(spark, sf_dir, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed")
    return rows.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def repeating(words: list[bytes], doc_id: int) -> list[bytes]:
    """A tenth of the documents, picked by their id, go on from some word in a period."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@_query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t if t is None or i is None or zlib.crc32(str(i).encode()) % 10 else b" ".join(repeating(t.encode().split(), i)).decode() for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = periodic_runs.periodic_runs(docs.mapInArrow(plant, "doc_id long, text string"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))))
    return rows.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.expr("longest.length * 1000 div -longest.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, turn, role, text)`` of the rebuilt conversations, numbered anew, and all their ids."""
    given = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int").alias("taken")
    numbered = given.select("conv_id", F.row_number().over(order).alias("turn"), "role", "text")
    own = numbered.withColumn("taken", taken).filter("turn > taken").drop("taken")
    ids = given.select("conv_id").distinct()
    heads = given.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.row_number().over(order).alias("turn"), "role", "text").filter("turn <= 5")
    receivers = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), taken)
    first = receivers.join(heads, "base").filter("turn <= taken").select("conv_id", "turn", "role", "text")
    return first.unionByName(own), ids


@_query(
    "op12_fast_trie",
    """
    WITH given AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT c, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''),
            lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) % 6 AS h
        FROM (SELECT DISTINCT c FROM given) d),
    turns AS (SELECT i.c, g.k, g.role, g.text FROM ids i JOIN given g ON g.c = i.c - i.c % 100 AND g.k <= i.h
        UNION ALL SELECT i.c, g.k, g.role, g.text FROM ids i JOIN given g ON g.c = i.c AND g.k > i.h),
    placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, length(text) AS chars,
            sha256(string_agg(length(role) || '|' || role || length(text) || '|' || text, '') OVER (PARTITION BY c ORDER BY k)) AS name FROM turns),
    paths AS (SELECT c, 0 AS d, '' AS name, 0 AS chars FROM ids UNION ALL SELECT c, d, name, chars FROM placed),
    ends AS (SELECT c, max(d) AS stop FROM paths GROUP BY c),
    nodes AS (SELECT name, any_value(d) AS depth, any_value(chars) AS chars, min(c) AS least, count(*) AS n_convs,
            sha256(coalesce(string_agg(CASE WHEN d = stop THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
        FROM paths JOIN ends USING (c) GROUP BY name),
    links AS (SELECT DISTINCT u.name AS upper, l.name AS lower, l.d - u.d AS far FROM paths u JOIN paths l ON u.c = l.c AND u.d <= l.d),
    children AS (SELECT upper AS name, count(*) AS n FROM links WHERE far = 1 GROUP BY upper),
    below AS (SELECT upper AS name, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
        FROM links JOIN nodes x ON x.name = lower LEFT JOIN children c ON c.name = lower GROUP BY upper)
    SELECT x.least::BIGINT AS conv_id, x.depth::BIGINT AS depth, p.least::BIGINT AS parent_conv_id, x.n_convs::BIGINT AS n_convs,
        coalesce(c.n, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, x.ends_sha256
    FROM nodes x JOIN below b USING (name) LEFT JOIN children c USING (name)
    LEFT JOIN links l ON l.lower = x.name AND l.far = 1 LEFT JOIN nodes p ON p.name = l.upper
    """,
)
def op12_fast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fast_trie.trie(*rebuilt(table(spark, sf_dir, "conversations")))
