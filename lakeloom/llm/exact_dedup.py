"""Exact dedup (operator 8, DataFrame functions only).

Deterministic block naming: each text is cut into blocks of a fixed number of
bytes. Equal blocks are sorted together and get one integer name; then the
names of adjacent pairs are named the same way, level by level, until a
document has a single name. Two documents with the same number of blocks have
the same final name exactly when their bytes are equal: names come from
comparing whole blocks, so there are no collisions.

A block that a third of all rows share is no hot key: naming first works
within salts (the sort of a salt and block streams, nothing is collected) and
only each salt's representative goes on to the global naming. Names are
occurrence numbers, so they are joined back as integers; text is moved twice,
whatever the number of levels.

Defined results: null text counts as empty; rows repeating an id and text are
copies of one another, one of them stays; a null id is the smallest. Row
numbers are taken in the job that writes the first table, after which they
stay. The input is read once. Other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.base import id_of, shuffle_partitions, text_of, written

BLOCK_BYTES = 8192


def _locally_named(rows: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """``local``: the first occurrence with equal keys within a salt."""
    w = Window.partitionBy("salt", *keys).orderBy("occ")
    return rows.withColumn("salt", F.pmod(F.xxhash64("occ"), F.lit(salts))).withColumn("local", F.first("occ").over(w)).drop("salt")


def _named(local: DataFrame, reps: DataFrame, keys: list[str]) -> DataFrame:
    """(uid, pos, name): each occurrence with the first one of all salts' representatives."""
    names = reps.withColumn("name", F.first("local").over(Window.partitionBy(*keys).orderBy("local"))).select("local", "name")
    return local.select("uid", "pos", "local").join(names, "local").select("uid", "pos", "name")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, text_sha256, n_blocks, name), one row per input row.

    (n_blocks, name) is equal exactly for equal texts.
    """
    salts = max(16, shuffle_partitions(docs.sparkSession))
    raw = docs.select(F.monotonically_increasing_id().alias("uid"), id_of(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    cut = F.expr(f"transform(sequence(0L, greatest(octet_length(t) - 1L, 0L) div {block_bytes}L), i -> substring(cast(t as binary), cast(i * {block_bytes} + 1 as int), {block_bytes}))")
    blocks = raw.select("uid", "doc_id", F.sha2("t", 256).alias("sha"), cut.alias("b")).select(
        "uid", "doc_id", "sha", F.size("b").alias("n_blocks"), F.posexplode("b").alias("pos", "block")
    )
    first = F.col("pos") == 0
    occurrences = blocks.select(
        "uid", "n_blocks", "pos", "block", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.unhex("sha")).alias("sha"), F.monotonically_increasing_id().alias("occ")
    )
    local = _locally_named(occurrences, ["block"], salts)
    is_rep = F.col("occ") == F.col("local")
    level = written(local.withColumn("block", F.when(is_rep, F.col("block"))), "block-names")
    heads = level.where("pos = 0").select("uid", "doc_id", F.lower(F.hex("sha")).alias("text_sha256"), "n_blocks")
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    names = written(_named(level, level.where("block IS NOT NULL").select("local", "block"), ["block"]), "names")
    done = names.where("pos = 0").select("uid", "name")
    if most > 1:
        longer = heads.where("n_blocks > 1").select("uid", "n_blocks")
        done = names.join(longer, "uid", "left_anti").select("uid", "name")
        names = names.join(longer, "uid").withColumn("left", F.col("n_blocks"))
    while most > 1:
        odd = F.col("pos") % 2 == 1
        pairs = (
            names.groupBy("uid", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max(F.when(~odd, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"), F.max("left").alias("left"))
            .select("uid", "pos", "a", "b", F.shiftright(F.col("left") + 1, 1).alias("left"), F.monotonically_increasing_id().alias("occ"))
        )
        level = written(_locally_named(pairs, ["a", "b"], salts), "pair-names")
        reps = level.where(F.col("occ") == F.col("local")).select("local", "a", "b")
        renamed = _named(level, reps, ["a", "b"]).join(level.select("uid", "pos", "left"), ["uid", "pos"])
        names = written(renamed, "names")
        done = done.union(names.where("left = 1").select("uid", "name"))
        names = names.where("left > 1")
        most = (most + 1) // 2
    return heads.join(done, "uid")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): of equal texts the largest id stays."""
    rows = written(identities(docs, block_bytes, id_col, text_col), "identities")
    key = ["n_blocks", "name"]
    best = F.max(F.struct("doc_id", "uid"))
    groups = rows.groupBy(*key).agg(best.alias("keep"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    groups = written(groups, "groups")  # a bare table on both sides, so that a hot group's join can be split
    joined = rows.join(groups, key, "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("uid") == F.col("keep.uid"))).alias("kept"),
        "text_sha256",
    )
