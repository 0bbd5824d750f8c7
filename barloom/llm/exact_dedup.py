"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step looks only at rows that the step before could not tell apart. The first two
work on a narrow table (id, length, hash of a prefix); only rows that share both with
another row are read in full. Which ones these are is broadcast as a set of at most
``BUCKETS`` hash buckets, so texts are hashed where they lie and never shuffled; beyond
that many groups more rows are hashed than need be, with the same result. Groups meet as
counts that every task reduces first, and the counts are written out, so that joins
against them can be split by adaptive execution where a third of all rows is one text.
"""

from pyspark.sql import Column, DataFrame, functions as F

from barloom.operators.columns import compute_once
from barloom.operators.keyed import landed

PREFIX_CHARS = 256
#: Bound on the numbers broadcast to pick the rows that are read in full.
BUCKETS = 1 << 18
#: Fixed value: the white space that counts as one space.
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    """(doc_id, length, prefix, norm) of every row; the white space is replaced once a row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    rows = compute_once(rows, {"norm": normalised(F.col("_text"))})
    return rows.select(
        "doc_id",
        F.octet_length("norm").alias("length"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"),
        "norm",
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("length", "prefix"), F.lit(BUCKETS))


def _in_question(keys: DataFrame) -> DataFrame:
    """Buckets of the lengths and prefixes that several rows share: at most ``BUCKETS`` numbers.

    Few enough to broadcast for certain, so no text is shuffled to find the rows to read.
    A row that only shares a bucket is hashed too, and then turns out to be alone.
    """
    lengths = _repeated(keys, ["length"], "dedup-lengths")
    alike = keys.join(lengths, "length", "left_semi")
    prefixes = _repeated(alike, ["length", "prefix"], "dedup-prefixes")
    buckets = prefixes.select(_bucket().alias("bucket")).distinct()
    return F.broadcast(landed(buckets.withColumn("asked", F.lit(True)), "dedup-buckets"))


def _repeated(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return landed(counts.filter(F.col("_n") > 1).drop("_n"), name)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    hash_all: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, keep_id, group_size, kept.

    Of equal normalised texts the smallest id stays. ``text_hash`` is null where length
    and prefix already told the row from all others, unless ``hash_all`` asks for it.
    Null texts count as empty. A null id is larger than any other; rows that repeat an
    id with the same text are copies of each other, of which one stays. An empty table
    gives no rows.
    """
    keys = landed(_keyed(docs, id_col, text_col, prefix_chars).drop("norm"), "dedup-keys")
    return _groups(docs, _in_question(keys), id_col, text_col, prefix_chars, hash_all)


def _counted(docs, buckets, id_col, text_col, prefix_chars, hash_all):
    """Rows with their hash where asked for, (doc_id, text_hash, copies), and (text_hash, keep_id, group_size)."""
    # Only now whole texts, and only those of rows still in question.
    texts = _keyed(docs, id_col, text_col, prefix_chars).withColumn("bucket", _bucket())
    texts = texts.join(buckets, "bucket", "left").withColumn("asked", F.col("asked").isNotNull())
    needed = F.lit(True) if hash_all else F.col("asked")
    rows = texts.select("doc_id", "asked", F.when(needed, digest(F.col("norm"))).alias("text_hash"))
    rows = landed(rows, "dedup-rows")
    copies = rows.filter("asked").groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies"))
    copies = landed(copies, "dedup-copies")
    groups = copies.groupBy("text_hash").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return rows, copies, landed(groups, "dedup-groups")


def _groups(docs, buckets, id_col, text_col, prefix_chars, hash_all):
    rows, copies, groups = _counted(docs, buckets, id_col, text_col, prefix_chars, hash_all)
    found = copies.join(groups, "text_hash")
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    found = found.withColumn("kept", first).drop("copies", "_copy")
    alone = rows.filter("NOT asked").select(
        "text_hash",
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return found.unionByName(alone)


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; only texts in question are shuffled.

    Columns may have any names: while rows are judged they lie in a struct of their own.
    """
    keys = landed(_keyed(docs, id_col, text_col, prefix_chars).drop("norm"), "dedup-keys")
    buckets = _in_question(keys)
    _, copies, groups = _counted(docs, buckets, id_col, text_col, prefix_chars, False)
    # No aggregate follows this join by text, so a hot text can be split in it.
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("stays")
    decided = copies.join(groups.filter(F.col("group_size") > 1), "text_hash").select("doc_id", "text_hash", stays, "copies")
    decided = landed(decided, "dedup-decided")
    rows = docs.select(F.struct("*").alias("row"))
    rows = compute_once(rows, {"norm": normalised(F.col("row")[text_col])})
    prefix = F.xxhash64(F.substring("norm", 1, prefix_chars))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.octet_length("norm"), prefix), F.lit(BUCKETS)))
    asked = F.broadcast(buckets.select("bucket"))
    free = rows.join(asked, "bucket", "left_anti").select("row.*")
    rows = rows.join(asked, "bucket", "left_semi")
    rows = rows.select("row", F.col("row")[id_col].alias("id"), digest(F.col("norm")).alias("hash"))
    kept = _without(rows, decided.filter(~F.col("stays")), "left_anti")
    again = decided.filter(F.col("stays") & (F.col("copies") > 1))
    if again.isEmpty():  # a written table: this reads its first row
        return free.unionByName(kept.select("row.*"))
    once = _without(kept, again, "left_semi").dropDuplicates(["id", "hash"])
    kept = _without(kept, again, "left_anti").unionByName(once)
    return free.unionByName(kept.select("row.*"))


def _without(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"))
    return rows.join(keys, rows["id"].eqNullSafe(keys["key_id"]) & (rows["hash"] == keys["key_hash"]), how)
