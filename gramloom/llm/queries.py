"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from gramloom.llm import bpe, fingerprint, html, language, merkle, mixing, neardup, packing, pii, quality, search, secrets, toxicity
from gramloom.llm.common import fold, spread, table, texts_of
from gramloom.llm.spans import listed
from gramloom.session import fresh_dir


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    docs = spread(texts_of(table(spark, sf_dir, "documents")))
    encoded = docs.select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids")), 256).alias("decoded_sha256"))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                                                 F.col("html").cast("string").alias("html"))
    field = html.learn(pages)
    texts = spread(pages).select("page_id", "url", html.main_text(F.col("html"), field).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likenesses."""
    return fingerprint.compare_with_edits(texts_of(table(spark, sf_dir, "documents")))


#: Shares of all tokens that the domains shall have.
TARGETS = {"good": 0.95, "poor": 0.05}


def domains_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain): good or poor by the labels of quality."""
    return labels_of(spark, sf_dir, "quality").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("domain"))


def fitted_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: tuple[str, ...] = ()) -> tuple[mixing.Mixture, DataFrame]:
    """The mixture for these documents, and their stored statistics (doc_id, n_tokens, x)."""
    folder = fresh_dir(spark, "mixing")
    mixing.with_statistics(texts_of(docs), F.col("text"), "n_tokens", "x").drop("text").write.parquet(folder)
    stated = spark.read.parquet(folder)
    return mixing.fit(stated, mixing.learn(stated, domains_of(spark, sf_dir)), TARGETS, keep), stated


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, domain probabilities, rate and whole copies of every document."""
    mixture, stated = fitted_mixture(spark, table(spark, sf_dir, "documents"), sf_dir)
    if len(mixture.domains) < 2:
        rows = stated.select("doc_id", "n_tokens", F.lit(None).cast("double").alias("p_good"), F.lit(1.0).alias("rate"))
    else:
        p = stated.withColumn("p", mixture.probabilities(F.col("x")))
        rows = p.select("doc_id", "n_tokens", F.col("p")[mixture.domains.index("good")].alias("p_good"), mixture.rate(F.col("p")).alias("rate"))
    return rows.withColumn("copies", mixing.copies(F.col("rate"), F.col("doc_id")))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and survival of every document."""
    return neardup.near_duplicates(spread(texts_of(table(spark, sf_dir, "documents"))), fresh_dir(spark, "neardup"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and verdict for every document; the trees learn from the labels of quality."""
    trees = quality.learn(table(spark, sf_dir, "documents"), labels_of(spark, sf_dir, "quality"))
    docs = spread(texts_of(table(spark, sf_dir, "documents")))
    return docs.select("doc_id", quality.judge(F.col("text"), trees).alias("found")).select("doc_id", "found.*")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents of folds 0 and 2 of 3."""
    docs = table(spark, sf_dir, "documents")
    learnt = language.learn(docs.where(fold(3) != 1).select("doc_id", "text", "lang"))
    found = spread(texts_of(docs)).select("doc_id", (fold(3) == 1).alias("held_out"),
                                          language.identify(F.col("text"), learnt).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def labels_of(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """(doc_id, label) of the table labels; of repeated labels the largest."""
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("int").alias(column))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.learn(table(spark, sf_dir, "documents"), labels_of(spark, sf_dir, "toxic").where(fold(5) != 0))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the fixed formats, and all spans."""
    found = secrets.find(texts_of(table(spark, sf_dir, "documents")), fresh_dir(spark, "secrets"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), count("random"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base formats, and all spans."""
    docs = texts_of(table(spark, sf_dir, "documents"))
    found = pii.find(docs, fresh_dir(spark, "pii"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of folds 1 to 4 of 5."""
    model = toxicity_model(spark, sf_dir)
    found = spread(texts_of(table(spark, sf_dir, "documents"))).select(
        "doc_id", (fold(5) == 0).alias("held_out"), toxicity.score(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.score").alias("score"),
                        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
                        F.col("found.passages").alias("passages"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into pieces and packed into sequences of at most 2048 ids."""
    docs = spread(texts_of(table(spark, sf_dir, "documents")))
    # the ranks of byte_bpe_50k.json's vocabulary: the same ids as the tokenizers library gives (tests/llm/test_packing.py)
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), spark)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and whether each row's proof still gives the root after tampering.

    Where 7 divides the unsigned crc32 of the decimal doc_id, the tampered row has n_chars + 1 (nulls stay).
    """
    docs = table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string")), F.lit(7)) == 0
    fields = {f: F.col(f) for f in merkle.FIELDS}
    fields["n_chars"] = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(docs, merkle.leaf(fields), spark)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all rows of documents for every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spark)


ALL = [op1_html, op2_fingerprint, op3_mixing, op4_neardup, op5_quality, op6_language, op7_secrets, op8_pii, op9_toxicity, op10_bpe,
       op11_packing, op12_merkle, op13_search]

_TERMS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op13_search": f"""
WITH d AS (SELECT row_number() OVER () AS key, doc_id, {_TERMS.format('text')} AS t FROM documents),
dn AS (SELECT key, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
tot AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM dn),
tf AS (SELECT key, term, count(*) AS tf FROM (SELECT key, unnest(t) AS term FROM d WHERE len(t) > 0) GROUP BY key, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark)
      GROUP BY item_id, term),
w AS (SELECT q.item_id, q.term, q.q, CAST(floor(1000 * ln((2.0 * tot.big_n + 2) / (2.0 * df.df + 1))) AS BIGINT) AS w
      FROM q JOIN df USING (term), tot),
s AS (SELECT w.item_id, dn.key, dn.doc_id,
             sum(w.q * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * dn.n * tot.big_n) // tot.big_l)))) AS score
      FROM w JOIN tf USING (term) JOIN dn USING (key), tot GROUP BY w.item_id, dn.key, dn.doc_id),
r AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT CAST(item_id AS BIGINT) AS item_id, CAST(rank AS INTEGER) AS rank, CAST(doc_id AS BIGINT) AS doc_id,
       CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10""",
}
