"""A corpus pipeline over documents: quality, toxicity, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers as public
from pyspark.sql import DataFrame, SparkSession, functions as F

from cytoframe.llm import minhash_dedup, packing, quality, toxicity
from cytoframe.llm.common import Scratch, give_back, table, temporary, unpacked_row, whole_row

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score is at least 0.5, each judged by its own whole text; null and empty texts are scored as
    such, repeated rows stay or go together. Without labels of both classes all stay; an empty table stays empty."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below 0.7, each judged by its own whole text; null and empty texts get the rate of
    such examples, repeated rows stay or go together. Without labels all stay; an empty table stays empty."""
    give_back()
    model, vectors = toxicity.fit(docs, table(spark, sf_dir, "labels"), carry=tuple(docs.columns))
    return toxicity.keep_clean(vectors, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, most_broadcast: int = 400_000) -> DataFrame:
    """One row, of the smallest id, of each group of near copies (five-word shingles, 0.8 or more).

    Rows of one id are one document, of which the row of the smallest text stays (of equal texts that with the smallest
    JSON); rows without an id are known by their text, and stay where no document with an id is like them. Texts
    without words are like nothing but rows of their id. Columns may have any names and types. Up to `most_broadcast`
    keys whose rows go or are repeated are broadcast; of more, all rows are shuffled to them.
    """
    give_back()
    by_text = F.xxhash64("text").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    keyed = docs.select(whole_row(docs).alias("row"), F.coalesce(docs["doc_id"].cast("long"), by_text).alias("key"), docs["text"].alias("text"))
    found = minhash_dedup.near_duplicates(keyed.select("key", "text"), width=5, percent=80, id_col="key")
    # most keys have one row, which stays: only the others are joined, so that whole rows need not be shuffled
    keys = found.groupBy("key").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).where("not kept or rows > 1")
    keys, n, repeated = Scratch(spark, "kept").observed(keys, "keys", F.count("*"), F.count_if("kept"))
    gone = keys.select("key")
    alone = keyed.join(F.broadcast(gone) if n <= most_broadcast else gone, "key", "left_anti").select("row") if n else keyed.select("row")
    if repeated:
        again = keys.where("kept").select("key")
        again = keyed.join(F.broadcast(again) if n <= most_broadcast else again, "key", "left_semi")
        first = again.groupBy("key").agg(F.min_by("row", F.struct("text", F.to_json("row"))).alias("row"))
        alone = alone.unionByName(first.select("row"))
    return alone.select(*unpacked_row(alone, "row"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row's whole text in sequences of at most 2048 tokens. Null and empty texts are one id, null
    ids and repeated rows are packed each for itself; an empty table has no piece."""
    return packing.pack_documents(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


STAGES = [("quality_classifier", quality_classifier), ("toxicity", toxicity_filter), ("minhash_near_dedup", near_duplicates), ("packing", sequence_packing)]
#: Trained models, tokenizers and similarity joins are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; its scratch tables are then removed."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        with temporary():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
