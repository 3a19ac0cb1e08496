"""Exact deduplication by merging sorted digest runs in a tree (DataFrame functions only).

Every row of the input becomes (digest, identifier). A scan partition is a run. In each round the runs of
`fan_in` neighbouring partitions meet: equal digests, verified by length and a second hash, collapse to the
smallest identifier and the number of rows. A round deals (run, digest) pairs over all tasks, so a text that a
third of all rows repeat costs one record for each run, never one hot task. After log(partitions) rounds one
run is left, which holds one record for each different text.

Texts are equal when they are identical after each run of ASCII white space became one space; null counts as
empty. Null identifiers rank last; rows that repeat identifier and text rank by their place in the input.
An empty table gives an empty result. Other columns are carried by `drop_exact_copies` and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.llm.common import stored, text_column

FAN_IN = 8
KEY = ["digest", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def text_digests(docs: DataFrame) -> DataFrame:
    """run, row, doc_id and the digest columns of every row."""
    text = docs.select(F.col("doc_id"), normalised(text_column()).alias("norm"))
    return text.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.octet_length("norm").alias("n_bytes"),
        F.xxhash64("norm").alias("check"),
    )


def merged_runs(digests: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """One record for each different text: least (its first row) and copies, after rounds of run merging."""
    merged = digests.select(
        "run", *KEY, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row").alias("least"), F.lit(1).cast("long").alias("copies")
    )
    while True:
        merged = merged.groupBy("run", *KEY).agg(F.min("least").alias("least"), F.sum("copies").alias("copies"))
        if runs <= 1:
            return merged.drop("run")
        runs = -(-runs // fan_in)
        merged = merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))


def exact_copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and row of every row of `docs`."""
    digests = stored(text_digests(docs), "digests")
    last = digests.agg(F.max("run")).first()[0]  # of the runs written, not of a plan that may count other splits
    merged = stored(merged_runs(digests, 1 if last is None else last + 1), "merged-runs")
    return (
        digests.join(merged, KEY)
        .select(
            "doc_id",
            F.col("least.doc_id").alias("keep_id"),
            F.col("copies").alias("group_size"),
            (F.col("row") == F.col("least.row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "row",
        )
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows to drop are found on narrow columns; texts move once, to meet the list of dropped rows. Rows that
    repeat identifier and text of the row that stays are collapsed to one of them.
    """
    found = stored(exact_copies(docs).select("doc_id", "text_sha256", "kept"), "copies")
    tagged = docs.withColumn("_dd_id", F.col("doc_id")).withColumn("_dd_sha", F.sha2(normalised(text_column()), 256))
    rows = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    rows = rows.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "kept", "n")
    same = F.col("_dd_id").eqNullSafe(F.col("_id")) & (F.col("_dd_sha") == F.col("_sha"))
    gone = rows.where(~F.col("kept") | (F.col("n") > 1))
    out = tagged.join(gone.select("_id", "_sha"), same, "left_anti")
    again = stored(rows.where(F.col("kept") & (F.col("n") > 1)).select("_id", "_sha"), "repeated-rows")
    if not again.isEmpty():
        out = out.unionByName(tagged.join(again, same, "left_semi").dropDuplicates(["_dd_id", "_dd_sha"]))
    return out.drop("_dd_id", "_dd_sha")
