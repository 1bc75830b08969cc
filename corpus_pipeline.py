"""The corpus pipeline over ``documents``: quality classifier, quality rules, near-dedup, mixing
and BPE. Every stage works on all that the one before it kept, and its output is written as
Parquet and read again.

Every stage takes null and empty texts (no words: the quality rules reject them), repeated rows, null
ids and an empty table; columns besides doc_id, text and source are carried along unread. Their
names must not start with ``__``."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipcast.llm import bpe, mixing, near_dedup, quality_clf, quality_rules
from shipcast.llm.common import discard, documents, scratch_folder, whole_text

# Near copies from this similarity on, in per cent, are one group: the general limit of near-duplicate
# stages on five-word shingles (op8_near_dedup has a limit of its own).
NEAR_PERCENT = 80


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    stats = quality_clf.text_statistics(whole_text())
    training = quality_clf.labelled_rows(docs.select("doc_id", stats.alias("stats")),
                                         documents(spark, sf_dir, "labels"))
    model = quality_clf.fit(quality_clf.checkpointed(training))
    kept = docs.withColumn("__score", quality_clf.score(stats, model)).where("__score >= 0.5")
    return kept.drop("__score")


def rules(spark, docs, sf_dir):
    """Documents that no quality rule rejects."""
    return quality_rules.quality_filter(docs)


def deduplicate(spark, docs, sf_dir):
    """Of every group of near copies the document of the smallest id."""
    return near_dedup.drop_near_duplicates(docs, NEAR_PERCENT)


def mix_sources(spark, docs, sf_dir):
    """Whole documents, as often as their source's target takes them."""
    return mixing.mix_documents(docs)


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every document."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_decode(docs, path, public_tokenizers.PATTERN)
    return bpe.digests(encoded, F.col("ids"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("MinHash near-dedup", deduplicate),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode),
]

# A fitted classifier and hashed signatures have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other; a stage's table goes once the next one is written."""
    docs, last = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        out, folder = stage(spark, docs, sf_dir), scratch_folder(spark)
        out.write.parquet(folder)
        docs = spark.read.schema(out.schema).parquet(folder)
        if last:
            discard(spark, last)
        last = folder
    return STAGES[-1][1](spark, docs, sf_dir)
