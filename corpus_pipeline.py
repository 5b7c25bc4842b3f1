"""The corpus pipeline: documents through five stages, each written and reread.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents, whatever those are, as long as doc_id,
text, lang and source are among them. Decisions are joined back on the id and
the text's hash. Null ids and texts, repeated rows and empty tables are
handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm import bpe, line_dedup, mixing, ngram_join, quality
from lakeloom.llm.base import NO_ID, id_of, text_of, written
from lakeloom.session import configure

MIX_RATE = 0.5
KEY = ["doc", "text_key"]


def _rows(docs: DataFrame) -> DataFrame:
    """(doc, text_key, row): the key of each row and the row itself."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(F.coalesce(id_of(), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_of()).alias("text_key"), row)


def _columns(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    return rows.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    configure(spark)
    judged = quality.judge(docs, public_tokenizers.path("piece_bpe_32k.model"))
    kept = judged.where("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text_key")
    return _columns(_rows(docs).join(kept, KEY, "left_semi"), docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which no word is left; n_chars follows."""
    configure(spark)
    rows = _rows(docs).join(line_dedup.keep_bitmaps(docs), KEY, "left")
    cut = F.col("keep_bitmap").isNotNull()
    rows = rows.withColumn("cut", line_dedup.cut_text(F.when(cut, F.col("row.text")), F.col("keep_bitmap")))
    rows = rows.where(~cut | F.col("cut").rlike(mixing.WORD))
    changed = {"text": F.when(cut, F.col("cut")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length("cut").cast("long")).otherwise(F.col("row.n_chars"))
    return _columns(rows, docs, **changed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, and of that id's texts the least hash, stays."""
    configure(spark)
    linked = ngram_join.link_components(docs)
    least = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("component_key"))
    stay = linked.where(least).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text_key")
    rows = _rows(docs).join(stay, KEY, "left_semi")
    # rows repeating an id and text are copies of each other: one of them stays
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0)))
    return _columns(rows.withColumn("nth", first).where("nth = 1"), docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by their cell's raked probability."""
    configure(spark)
    return _columns(mixing.mix(docs, rate=MIX_RATE).where("kept"), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): ids as little-endian unsigned 32-bit integers and what they decode to."""
    configure(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mixing),
    ("BPE encoding and decoding", token_ids),
]
#: SQL cannot express the fertility bands and the tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
