"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, pieces; each stage calls one operator.

A stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it below the shared folder and reads it back as the
next stage's docs. All but the last return the columns of documents. Rows with null or repeated ids, null and empty
texts, empty tables and extra columns pass every stage by the rules below.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelkit.llm import decontam, jaccard, language, pieces, secret_scan
from gavelkit.llm.common import may_be_in, new_name
from gavelkit.llm.queries import table, teaching_rows
from gavelkit.session import pinned


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: those without a letter, and those that fit two languages alike, go."""
    return language.accepted(docs, language.fit(teaching_rows(docs)))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the row with the group's smallest doc_id.

    Documents without words are similar to nothing and stay. Of rows that repeat both id and text one stays. A null id is
    never the smallest; in a group of null ids alone, each different text stays.
    """
    tag, id_, mine = (new_name(docs, x) for x in ("gk_text", "gk_id", "gk_tag"))
    tagged = docs.withColumn(tag, F.xxhash64("text"))
    found = pinned(jaccard.similar(tagged.select("doc_id", "text", tag), tag=tag), "similar")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    keys = [F.col("doc_id").alias(id_), F.col(tag).alias(mine)]
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col(tag).eqNullSafe(F.col(mine))
    gone = pinned(found.where(~stays).select(*keys).distinct(), "copies")
    again = pinned(found.where(stays & (F.col("n_shingles") > 0)).groupBy(*keys).count().where("count > 1").drop("count"), "repeats")
    # only rows that one of the two may name are joined: the texts of the others aren't shuffled
    row = lambda i, t: F.xxhash64(F.col(i), F.col(t))
    named = may_be_in(gone.unionByName(again).select(row(id_, mine)))(row("doc_id", tag))
    rest = tagged.where(named).join(gone, same, "left_anti")
    repeats = rest.join(again, same, "left_semi").dropDuplicates(["doc_id", tag])
    return tagged.where(~named).unionByName(rest.join(again, same, "left_anti")).unionByName(repeats).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go; a document without a hit stays as it is.

    The verdict depends on the text alone, so rows are found again by a hash of their text, whatever their ids are.
    """
    name = new_name(docs, "gk_gone")
    found = decontam.contamination(docs.select(F.xxhash64("text").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = pinned(found.where("contaminated").select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(gone, F.xxhash64(docs["text"]) == F.col(name), "left_anti")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what the scan finds is replaced by a mark, and n_chars follows where a text changed."""
    before = new_name(docs, "gk_before")
    out = secret_scan.redacted(docs.withColumn(before, F.col("text")))
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(before))
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit integers) and digests of ids and decoded text."""
    out = pieces.with_pieces(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.col("pieces.ids")
    digests = F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("pieces.decoded").cast("binary"), 256).alias("decoded_sha256")
    return out.select("doc_id", (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"), ids.alias("ids"), *digests)


STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("pieces", encode_pieces),
]

#: SQL can't state the compression of the first stage nor the merges of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
