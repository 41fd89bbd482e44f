"""The corpus pipeline: five stages over `documents`, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import pieces, quality_model, secret_scan, shingle_sets, simhash, source_mix
from quire.llm._io import save, table

#: The near-duplicate stage links all texts whose sets of five-word shingles have a Jaccard similarity
#: of 80 percent or more. Fingerprints alone, within any usable number of bits, lose some of those.
WORDS, ALIKE = 5, 80


def _whole(docs: DataFrame) -> DataFrame:
    """docs with each row in one column `doc`, so that no column of a stage can clash with one of the documents."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose quality score reaches the threshold; null and empty texts are scored like any other."""
    forest = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_model.scorer(forest)(F.col("text")) >= quality_model.THRESHOLD)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, one with the smallest id.

    Of rows with that id and one text one stays, and so of rows without id; an id whose texts are in
    several groups stands for each group whose smallest id it is. Null and empty texts are one group.
    """
    rows = save(simhash.near_duplicates(docs, words=WORDS, alike=ALIKE), "classes")
    least = rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "node", "component_id").agg(F.count(F.lit(1)).alias("times"))
    kept = least.groupBy("root").agg(F.min(F.struct("node", "component_id", "times")).alias("k"))
    kept = save(kept.select(F.col("k.node").alias("keep_node"), F.col("k.component_id").alias("keep_id"), F.col("k.times").alias("times")), "kept")
    named = _whole(docs).select("doc", F.col("doc.doc_id").alias("id"), shingle_sets.node(F.col("doc.text")).alias("node"))
    named = named.join(kept, (F.col("node") == F.col("keep_node")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi")
    if not kept.filter("times > 1").isEmpty():
        named = named.dropDuplicates(["id", "node"])
    return named.select("doc.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets found in its text masked and n_chars counted again; null and empty texts stay as they are."""
    ledger = save(secret_scan.scan_new(docs, rules=secret_scan.MASKED, content_col="text"), "ledger")
    named = _whole(docs).withColumn("blob", secret_scan.address(F.col("doc.text")))
    marked = named.join(save(secret_scan.findings(ledger, secret_scan.MASKED), "findings"), F.col("blob") == F.col("found_blob"), "left")
    masked = F.when(F.col("spans").isNotNull(), secret_scan.masked(F.col("doc.text"), F.col("spans"))).otherwise(F.col("doc.text"))
    new = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("spans").isNotNull(), F.length("masked").cast("long")).otherwise(F.col("doc.n_chars"))
    return marked.withColumn("masked", masked).select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice, as whole rows.

    Rows alike in id, source and text are interchangeable: the first stands for all copies taken of
    them. Null and empty texts have size 0 and are taken as their place has it; a null source is one of its own.
    """
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest"))
    rows = save(docs.select(row.alias("id"), "source", source_mix.word_count(F.col("text")).alias("size")), "sizes")
    taken = source_mix.mix(rows).groupBy("id", "source").agg(F.sum("copies").alias("times"), F.count(F.lit(1)).alias("alike")).filter("times > 0")
    taken = save(taken.select(F.col("id.id").alias("mix_id"), F.col("id.digest").alias("mix_digest"), F.col("source").alias("mix_source"), "times", "alike"), "taken")
    on = F.col("doc.doc_id").eqNullSafe(F.col("mix_id")) & F.col("doc.source").eqNullSafe(F.col("mix_source")) & (F.xxhash64("doc.text") == F.col("mix_digest"))
    whole = _whole(docs)
    out = whole.join(taken.filter("alike = 1"), on)
    if not (several := taken.filter("alike > 1")).isEmpty():
        out = out.unionByName(whole.join(several, on).dropDuplicates(["mix_id", "mix_source", "mix_digest"]))
    return out.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids and round_trip of every row; null and empty texts have no ids."""
    return pieces.encode(docs, pieces.Vocabulary.load())


STAGES = [
    ("quality_classifier", classify),
    ("simhash_near_dedup", deduplicate),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: A trained model, shingle sets at this scale and a vocabulary are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every document that the stages keep, as often as the mix takes it.

    Each stage's rows are written to the shared folder and read again before the next. Empty tables
    give none; repeated ids and extra columns of any name are carried through.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
