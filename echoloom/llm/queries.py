"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.llm import (
    bpe,
    collocations,
    cross_entropy,
    divergence,
    exact,
    fill_middle,
    golay,
    html_blocks,
    machine,
    mixing,
    nbsvm,
    norm_topk,
    ring,
    sampling,
)
from echoloom.workspace import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_source_mixing")
def op1_source_mixing(spark, sf_dir):
    """Slot of every document when a source weighs the square root of its size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs, mixing.tempered_weights(docs))


@query("op2_cross_entropy")
def op2_cross_entropy(spark, sf_dir):
    """Target: the texts of ``benchmark``; background: all documents."""
    docs = table(spark, sf_dir, "documents")
    models = cross_entropy.fit_models(docs, table(spark, sf_dir, "benchmark"))
    return cross_entropy.score_documents(docs, models)


@query("op3_quality_nbsvm")
def op3_quality_nbsvm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = sampling.held_out(F.col("doc_id"), 3, 1)
    model = nbsvm.fit_quality(docs, table(spark, sf_dir, "labels"), ~out)
    return nbsvm.score_quality(docs, model).select(
        "doc_id", out.alias("held_out"), "score", "predicted"
    )


@query("op4_html_blocks")
def op4_html_blocks(spark, sf_dir):
    return html_blocks.extract_text(table(spark, sf_dir, "pages"))


@query("op5_ring_shards")
def op5_ring_shards(spark, sf_dir):
    value = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # Stored once, so that texts are read once.
    docs = materialize(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            (F.octet_length(value) + 8).cast("bigint").alias("size"),
            F.crc32(value).alias("text_crc32"),
        ),
        "sizes",
    )
    return ring.assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


@query("op6_simhash_golay")
def op6_simhash_golay(spark, sf_dir):
    found = golay.near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


@query(
    "op7_exact_refinement",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op7_exact_refinement(spark, sf_dir):
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"), all_digests=True)
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op8_toxicity_machine")
def op8_toxicity_machine(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = sampling.held_out(F.col("doc_id"), 5, 0)
    model = machine.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~out)
    return machine.score_toxicity(docs, model).select(
        "doc_id", out.alias("held_out"), "score", "predicted"
    )


@query("op9_bpe_prefix")
def op9_bpe_prefix(spark, sf_dir):
    vocabulary = bpe.read_vocabulary(spark, VOCABULARY)
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), vocabulary)


@query("op10_distribution_divergence")
def op10_distribution_divergence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.references(docs))


@query(
    "op11_norm_buckets",
    """WITH whole AS (SELECT vec_id, min(list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x))) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
    pairs AS (SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
      FROM whole q JOIN whole p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
    SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM ranked WHERE r <= 5""",
)
def op11_norm_buckets(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return norm_topk.top_products(vectors, F.col("vec_id") % 50 == 0, 5, scale=256)


@query(
    "op12_fill_middle",
    """WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
      sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    drawn AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
      CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM cut),
    placed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM placed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(text) AS restored_sha256 FROM parts""",
)
def op12_fill_middle(spark, sf_dir):
    changed = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return changed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


@query(
    "op13_suffix_collocations",
    r"""WITH pieces AS (SELECT row_number() OVER () AS piece, lang, words FROM (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS words
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents))
      WHERE len(words) > 0),
    starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
    grams AS (SELECT lang, words[i : i + m - 1] AS p, m FROM (SELECT *, unnest(range(1, 6)) AS m FROM starts) WHERE i + m - 1 <= len(words)),
    f AS (SELECT lang, p, m, count(*) AS a FROM grams GROUP BY lang, p, m HAVING count(*) >= 100),
    sizes AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
    cuts AS (SELECT lang, p, m, a, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
    halves AS (SELECT c.lang, c.p, c.m, c.a, k, l.a AS l, r.a AS r, n,
        CAST(1000 AS HUGEINT) * c.a * n // (CAST(l.a AS HUGEINT) * r.a) AS score
      FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = c.p[1 : k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1 :]
        JOIN sizes s ON s.lang = c.lang),
    lowest AS (SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    inner_ AS (SELECT lang, p[1 : m - 1] AS p, a FROM f WHERE m >= 3 UNION ALL SELECT lang, p[2 : m] AS p, a FROM f WHERE m >= 3),
    longer AS (SELECT lang, p, max(a) AS b FROM inner_ GROUP BY lang, p),
    kept AS (SELECT lowest.*, array_to_string(lowest.p, ' ') AS phrase FROM lowest LEFT JOIN longer USING (lang, p)
      WHERE b IS NULL OR 100 * b < 100 * lowest.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
)
def op13_suffix_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))
