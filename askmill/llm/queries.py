"""The queries over the operators of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmill.llm import (
    compact_windows,
    edit_pigeonhole,
    fill_middle,
    jump_shards,
    license_scan,
    piece_codec,
    quality_trees,
    residue_gemm,
    super_minhash,
    syncmers,
    token_files,
    toxicity,
    url_trie,
)
from askmill.llm.common import saved, table
from askmill.session import work_path

#: The folder of the public tokenizers; None: the installed package's own.
TOKENIZERS: str | None = None


def tokenizer_file(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def held_out(key: str = "doc_id"):
    """The rows whose labels are never learnt from."""
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 4 == 2


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"), held_out())
    return toxicity.with_score(docs, model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


@query()
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write(
        table(spark, folder, "documents"),
        work_path(spark, "token-files"),
        tokenizer_file("word_bpe_49k.json"),
        end_id=2,
    )
    return token_files.read(manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32")
    )


@query()
def op4_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    # Slots need the rows twice: written once without the texts, so that those are read once.
    dealt = saved(jump_shards.shard(narrow, 40), "dealt")
    return jump_shards.number_slots(dealt, ["doc_id", "text_crc32", "size"])


@query()
def op5_super_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return super_minhash.group(table(spark, folder, "documents"), percent=85)


@query()
def op6_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.compare_edits(table(spark, folder, "documents"))


@query()
def op7_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return compact_windows.repeated(table(spark, folder, "documents"))


@query()
def op8_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    coded = piece_codec.encode(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.crc32("tokens").alias("ids_crc32"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        "parity",
    )


# The rules of the URL query.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query(
    """
    WITH cut AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id,
            coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM cut
    ), rules(rule, host_part, path_part, verdict) AS (
        VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
            ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
            ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
    ), fits AS (
        SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, length(host_part) DESC) AS place
        FROM parts JOIN rules
        ON (host = host_part OR ends_with(host, '.' || host_part)) AND starts_with(path, path_part)
    )
    SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
    FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
    """
)
def op9_url_trie(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "pages").select("page_id", "url")
    return url_trie.judge(urls, URL_RULES).drop("url")


@query()
def op10_edit_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    return edit_pigeonhole.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op11_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trees = quality_trees.train(docs, table(spark, folder, "labels"), held_out())
    return quality_trees.judge(docs, trees)


@query(
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS whole
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label,
            list_dot_product(a.whole, v.whole)::BIGINT AS score
        FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
    ), positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
        (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
        n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
    FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
        AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
    """
)
def op12_residue_gemm(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residue_gemm.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query(
    r"""
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
    ), cut AS (
        SELECT doc_id, text, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
            ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4,
            regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
        FROM hashed
    ), placed AS (
        SELECT *, len(units) AS n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM cut
    ), parts AS (
        SELECT *, array_to_string(list_slice(units, 1, a), '') AS p, array_to_string(list_slice(units, a + 1, b), '') AS m,
            array_to_string(list_slice(units, b + 1, n), '') AS s
        FROM placed
    )
    SELECT doc_id, n::BIGINT AS n, form,
        CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts
    """
)
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(table(spark, folder, "documents"))
