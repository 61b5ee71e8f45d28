"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.llm import (
    bpe,
    fingerprint,
    htmltext,
    langid,
    lattice,
    minhash,
    mixing,
    negatives,
    packing,
    prefixtrie,
    quality,
    secretscan,
    warc,
)
from headway.llm.common import crc_mod, fresh_folder, small_batches, table


def op1_quality(spark, sf_dir):
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_warc(spark, sf_dir):
    small_batches(spark)
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest",
                      "record_type", "refers_to")


def op3_fingerprint(spark, sf_dir):
    small_batches(spark)
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secretscan.scan(docs.select("doc_id", "text"), fresh_folder(spark, "secrets"))
    kinds = [r.kind for r in secretscan.BASE]
    base = F.filter("found", lambda f: f["kind"] < len(kinds))

    def count(order):
        return F.size(F.filter("found", lambda f: f["kind"] == order)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(kinds)]
    return found.select(F.col("path").alias("doc_id"), *counts,
                        F.sha2(secretscan.spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        secretscan.spans_text(F.col("found")).alias("spans"))


#: The target mixture of the query: weights per level, 1 where nothing is said.
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2},
               "lang": {"en": 4, "fr": 2, "de": 2}, "source": {"src0": 2}}


def domain_of(source):
    """The domain of the synthetic tables' sources: src<n> by n modulo 3."""
    n = F.regexp_extract(source, r"^src(\d+)$", 1).try_cast("int") % 3
    return F.when(n == 0, "web").when(n == 1, "books").when(n == 2, "code").otherwise("other")


def op5_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain_of(F.col("source")))
    return mixing.mix(docs, MIX_WEIGHTS, lambda total: total * 4 // 5, max_epochs=3, seed=1,
                      keep=("doc_id", "domain", "lang", "source"))


def op6_minhash(spark, sf_dir):
    small_batches(spark)
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)
    return found.withColumnRenamed("id", "doc_id")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed tokenizer package keeps a file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_packing(spark, sf_dir):
    small_batches(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_language(spark, sf_dir):
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = langid.train(docs.where(~held_out))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_html(spark, sf_dir):
    small_batches(spark)
    return htmltext.extract_main_text(table(spark, sf_dir, "pages"))


def op10_lattice(spark, sf_dir):
    small_batches(spark)
    found = lattice.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op11_trie(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations")
    return prefixtrie.prefix_nodes(prefixtrie.rebuilt(chats), chats.count())


def op12_bpe(spark, sf_dir):
    small_batches(spark)
    path = tokenizer_path("byte_bpe_50k.json")
    coded = bpe.encode(table(spark, sf_dir, "documents"), path)
    back = bpe.decode(coded, path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op13_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), lambda key: key % 50 == 0)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_fingerprint": op3_fingerprint,
    "op4_secrets": op4_secrets,
    "op5_mixing": op5_mixing,
    "op6_minhash": op6_minhash,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_html": op9_html,
    "op10_lattice": op10_lattice,
    "op11_trie": op11_trie,
    "op12_bpe": op12_bpe,
    "op13_negatives": op13_negatives,
}
