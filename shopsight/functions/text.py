"""Text statistics and lexicon sentiment, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.functions.values import as_column, flag, right_closed_bins

SPACE = r"(?U)\s+"


def words(text: Column | str) -> Column:
    """Pieces between runs of Unicode white space."""
    return F.filter(F.split(as_column(text), SPACE), lambda w: w != "")


def count_pattern(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(as_column(text), F.lit(pattern))


def capitals_share(text: Column | str) -> Column:
    """Upper-case letters over letters; 0 without letters."""
    text = as_column(text)
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(text, r"\P{Lu}+", ""))
    return F.when(letters > 0, capitals / letters).otherwise(0.0)


def text_columns(text: Column | str, prefix: str = "review") -> dict[str, Column]:
    body = F.coalesce(as_column(text), F.lit(""))
    return {
        f"has_{prefix}_comment": flag(body.rlike(r"(?U)\S")),
        f"{prefix}_text_length": F.length(body),
        f"{prefix}_word_count": F.size(words(body)),
        f"{prefix}_exclamation_count": count_pattern(body, "!"),
        f"{prefix}_question_count": count_pattern(body, r"\?"),
        f"{prefix}_caps_ratio": capitals_share(body),
    }


def add_text_features(df: DataFrame, text: str = "review_comment_message", prefix: str = "review") -> DataFrame:
    return df.withColumns(text_columns(text, prefix))


def tokens(text: Column | str) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(as_column(text)), r"[^\p{L}]+"), lambda w: w != "")


SMALL_LEXICON = 200_000


def lexicon_sentiment(df: DataFrame, id_column: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean polarity and subjectivity of the known words per id; ids without any get zeros.

    lexicon: word, polarity, subjectivity. A lexicon of up to SMALL_LEXICON words is sent to every task and
    the sums leave each task once per text. A larger one is joined by shuffle, and then tokens are counted
    per (id, word) first, so a very common word is combined on the map side.
    """
    scores = lexicon.select("word", "polarity", "subjectivity")
    words_of = df.select(id_column, F.explode(tokens(text)).alias("word"))
    if scores.limit(SMALL_LEXICON + 1).count() <= SMALL_LEXICON:
        known = words_of.join(F.broadcast(scores), "word").withColumn("_n", F.lit(1))
    else:
        known = words_of.groupBy(id_column, "word").agg(F.count("*").alias("_n")).join(scores, "word")
    means = known.groupBy(id_column).agg(
        (F.sum(F.col("polarity") * F.col("_n")) / F.sum("_n")).alias("_polarity"),
        (F.sum(F.col("subjectivity") * F.col("_n")) / F.sum("_n")).alias("_subjectivity"),
    )
    return (
        df.join(means, id_column, "left")
        .withColumn("sentiment_polarity", F.coalesce("_polarity", F.lit(0.0)))
        .withColumn("sentiment_subjectivity", F.coalesce("_subjectivity", F.lit(0.0)))
        .drop("_polarity", "_subjectivity")
    )


def sentiment_label(polarity: Column | str) -> Column:
    """Negative up to -0.1, neutral up to 0.1, positive above."""
    return right_closed_bins(polarity, [-1.01, -0.1, 0.1, 1.01], ["negative", "neutral", "positive"])
