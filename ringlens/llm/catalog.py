"""One query per operator over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.llm import (
    chunk_prints,
    collocations,
    embeddings,
    exact_search,
    html_text,
    language,
    packing,
    pieces,
    pii,
    secret_scan,
    simhash,
    spelling,
    toxicity,
)
from ringlens.session import share_code

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        @wraps(run)
        def shared(spark: SparkSession, sf_dir: str) -> DataFrame:
            share_code(spark)
            return run(spark, sf_dir)

        CATALOG[name] = Query(shared, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_simhash")
def op1_simhash(spark, sf):
    return simhash.simhash_groups(table(spark, sf, "documents"))


@query("op2_sentence_pieces")
def op2_sentence_pieces(spark, sf):
    """Ids of every document, their digest, and whether decoding gives the text back."""
    found = pieces.encode_texts(table(spark, sf, "documents"), tokenizer("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "ids_crc32", "round_trip")


EXACT_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) r WHERE rank <= 10
"""


@query("op3_exact_top_k", EXACT_TOP_K)
def op3_exact_top_k(spark, sf):
    return exact_search.top_k(table(spark, sf, "embeddings"))


@query("op4_secret_scan")
def op4_secret_scan(spark, sf):
    return secret_scan.find_secrets(table(spark, sf, "documents"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"))


@query("op6_language_id")
def op6_language_id(spark, sf):
    return language.language_ids(table(spark, sf, "documents"))


EMBEDDING_GROUPS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, CAST((SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS BIGINT) AS n_links,
  c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""


@query("op7_embedding_dedup", EMBEDDING_GROUPS)
def op7_embedding_dedup(spark, sf):
    return embeddings.embedding_groups(table(spark, sf, "embeddings"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.OrdinalModel:
    grades = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), toxicity.severity_grade().alias("grade"))
    return toxicity.train(docs, grades)


@query("op8_toxicity")
def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.toxicity(docs, toxicity_model(spark, sf, docs))


@query("op9_personal_data")
def op9_personal_data(spark, sf):
    docs = table(spark, sf, "documents")
    return pii.find_personal_data(docs, pii.train(docs))


@query("op10_html_text")
def op10_html_text(spark, sf):
    return html_text.extract_text(table(spark, sf, "pages"))


@query("op11_document_fingerprints")
def op11_document_fingerprints(spark, sf):
    return chunk_prints.document_fingerprints(table(spark, sf, "documents"))


COLLOCATIONS = """
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL
), p AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w
), spans AS (
  SELECT lang, w, i, unnest(range(1, 6)) AS k FROM starts
), f AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM spans WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM f WHERE k >= 2
), inner_phrases AS (
  SELECT lang, phrase AS longer, f, i, j, array_to_string(w[i:j], ' ') AS phrase
  FROM c, (SELECT a.i, b.j FROM range(1, 6) a(i), range(1, 6) b(j) WHERE a.i < b.j) s WHERE j <= k AND j - i + 1 < k
), dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_phrases o ON o.lang = c.lang AND o.phrase = c.phrase WHERE 100 * o.f >= 100 * c.f
), kept AS (
  SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = c.lang AND d.phrase = c.phrase)
), cuts AS (
  SELECT lang, phrase, f AS a, k, w, unnest(range(1, k)) AS cut FROM kept
), priced AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, t.n,
    CAST(1000::HUGEINT * c.a * t.n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ') JOIN totals t ON t.lang = c.lang
), least AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS pick FROM priced) x WHERE pick = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
) y WHERE rank <= 2000
"""


@query("op12_collocations", COLLOCATIONS)
def op12_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"))


@query("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
