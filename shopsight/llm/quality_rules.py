"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them (DataFrame functions only).

Each rule looks at one measure of a text and votes good (1), bad (-1) or abstains (0). Documents with equal votes
are one row of a table of vote patterns, at most 3 ** rules rows however large the corpus. On it, EM estimates for each
rule how often its votes are bad ones on good and on bad documents, and the share of good ones; a rule that abstains says
nothing. It starts from rules whose bad votes are seldom wrong and whose good votes say little, as each rule sees one
kind of fault, so good and bad can't change places. Each kind of fault is seen by more than one rule. A document's verdict is the posterior probability that it is good, given all of its votes.

Measures of whole texts, words between ASCII white space: n_words, word_chars (code points in words), n_symbols
(characters of `[#*$%&|<>]`), n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in
windows of five words that occur twice or more in the text). Windows are compared by 64-bit hashes inside one text.

Null text has no words. Texts without words fail the base test. Rows that repeat are judged each; an empty table gives
an empty result. `kept_documents` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.llm.common import stored, text_column

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
THRESHOLD = 0.5
ROUNDS = 25
START_ALARM, START_FALSE_ALARM, START_SHARE = 0.3, 0.001, 0.8
SMOOTHING = 1.0
BLANK = r"[\x20\x09-\x0D]+"
VOTES = ["symbols", "marks", "lines", "repeats", "word_length", "capitals", "cries", "sentences"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _covered(pairs: str) -> Column:
    """Words in windows that occur more than once, from the sorted (hash, place) pairs of one text's windows.

    Sorted pairs put equal windows side by side; each place of such a window covers the words up to the next
    place, at most `WINDOW`.
    """
    same = lambda x, i: F.coalesce(x["h"] == F.get(F.col(pairs), i)["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(pairs, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )


def measures(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`keep` columns (default doc_id), the measures, and further counts that the rules look at."""
    keep = ["doc_id"] if keep is None else keep
    texts = docs.select(*keep, text_column().alias("_t"))
    cut = texts.select(
        *keep,
        "_t",
        F.array_remove(F.split("_t", BLANK), "").alias("_words"),
        F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_replace("_t", BLANK, "").alias("_dense"),
    )
    without = lambda signs: (F.char_length("_dense") - F.char_length(F.regexp_replace("_dense", signs, ""))).cast("long")
    hashed = cut.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length("_dense").cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        without(r"[A-Z]").alias("n_capitals"),
        without(r"[!?]").alias("n_cries"),
        without(r"[.]").alias("n_stops"),
        F.transform(F.col("_words"), lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    whole = F.slice("_hashes", 1, F.greatest(F.size("_hashes") - (WINDOW - 1), F.lit(0)))
    window = lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + k) for k in range(1, WINDOW)])
    windowed = hashed.withColumn("_windows", F.transform(whole, window)).drop("_hashes")
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    paired = windowed.withColumn("_pairs", F.when(some, pairs)).drop("_windows")
    return paired.withColumn("n_repeat_words", F.coalesce(_covered("_pairs"), F.lit(0).cast("long"))).drop("_pairs")


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("byte")


def rules() -> dict[str, Column]:
    """The votes as expressions over the measures."""
    symbols, lines, repeats = _share("n_symbols", "n_words"), _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")
    length, capitals, cries = _share("word_chars", "n_words"), _share("n_capitals", "word_chars"), _share("n_cries", "n_words")
    stops, words = _share("n_stops", "n_words"), F.col("n_words")
    long_enough = words >= 50
    marks = _share("n_symbols", "word_chars")
    return {
        "symbols": _vote(symbols, (symbols < 0.02) & long_enough, symbols > 0.3),
        "marks": _vote(marks, (marks < 0.005) & long_enough, marks > 0.05),
        "lines": _vote(lines, (lines == 0) & (F.col("n_lines") >= 2) & long_enough, (lines > 0.3) & (F.col("n_dup_lines") >= 3)),
        "repeats": _vote(repeats, (repeats < 0.1) & long_enough, (repeats > 0.15) & (F.col("n_repeat_words") >= 25)),
        "word_length": _vote(length, length.between(3.5, 9) & long_enough, (length < 2) | (length > 16)),
        "capitals": _vote(capitals, (capitals < 0.2) & long_enough, capitals > 0.5),
        "cries": _vote(cries, (cries < 0.1) & long_enough, cries > 0.5),
        "sentences": _vote(stops, stops.between(0.02, 0.3) & long_enough, (stops < 0.002) & (words >= 200)),
    }


def votes(measured: DataFrame) -> DataFrame:
    """`measured` with one column v_<rule> for each vote."""
    return measured.withColumns({f"v_{name}": vote for name, vote in rules().items()})


def _posterior(share: float, odds: list[float]) -> Column:
    """Probability of good; odds[3 * r + v + 1] is the log-likelihood ratio of vote v of rule r, `cells` names those cast.

    The ratios are one array literal, so that every round runs the same generated code.
    """
    table = F.lit(odds)
    prior = F.lit([math.log(share / (1 - share))])
    return 1 / (1 + F.exp(-F.aggregate("cells", F.get(prior, F.lit(0)), lambda acc, i: acc + F.get(table, i))))


def vote_model(voted: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """v_* and posterior for each pattern of votes that occurs in `voted`."""
    columns = [f"v_{name}" for name in VOTES]
    cells = F.array(*[F.col(c).cast("int") + (3 * r + 1) for r, c in enumerate(columns)])
    patterns = stored(voted.groupBy(*columns).agg(F.count("*").alias("n")).withColumn("cells", cells).coalesce(1), "vote-patterns")
    good, bad, share = [START_FALSE_ALARM] * len(columns), [START_ALARM] * len(columns), START_SHARE
    ratios = lambda: [x for g, b in zip(good, bad, strict=True) for x in (math.log(g / b), 0.0, math.log((1 - g) / (1 - b)))]
    for _ in range(rounds):
        weighed = patterns.select("cells", "n", (F.col("n") * _posterior(share, ratios())).alias("g"))
        sums = weighed.select(F.explode("cells").alias("cell"), "n", "g").groupBy("cell").agg(F.sum("g").alias("g"), F.sum(F.col("n") - F.col("g")).alias("b"))
        found = {row.cell: (row.g, row.b) for row in sums.collect()}  # three cells for each rule
        if not found:
            break
        counts = [found.get(k, (0.0, 0.0)) for k in range(3 * len(columns))]
        rate = lambda r, side: (counts[3 * r][side] + SMOOTHING) / (counts[3 * r][side] + counts[3 * r + 2][side] + 2 * SMOOTHING)
        good, bad = ([rate(r, side) for r in range(len(columns))] for side in (0, 1))
        total_good, total_bad = (sum(c[side] for c in counts[:3]) for side in (0, 1))
        was, share = share, (total_good + SMOOTHING) / (total_good + total_bad + 2 * SMOOTHING)
        if abs(share - was) < 1e-9:
            break
    return patterns.select(*columns, _posterior(share, ratios()).alias("posterior"))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judged(docs: DataFrame, keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """`keep` columns, measures, votes, posterior, base_failed and kept of every row; each text is read once."""
    voted = stored(votes(measures(docs, keep)), "votes")
    model = vote_model(voted)
    columns = [f"v_{name}" for name in VOTES]
    joined = voted.join(F.broadcast(model), columns)  # at most 3 ** rules rows
    return joined.withColumn("base_failed", _base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def kept_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    Rows are written with their votes: each text is measured once, and neither the model nor the filter goes back
    to the measures.
    """
    names = docs.columns
    boxed = docs.select("text", F.struct(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]).alias("_row"))
    voted = stored(votes(measures(boxed, ["_row"])).withColumn("_failed", _base_failed()), "voted-rows")
    kept = vote_model(voted).where(F.col("posterior") >= threshold).drop("posterior")
    passed = voted.where(~F.col("_failed")).join(F.broadcast(kept), [f"v_{name}" for name in VOTES], "left_semi")
    return passed.select(*[F.col("_row")[f"c{i}"].alias(n) for i, n in enumerate(names)])
