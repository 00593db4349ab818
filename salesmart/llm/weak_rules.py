"""Document quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule votes for a document (1), against it (-1) or abstains (0). The vote patterns are counted
over all documents; expectation-maximisation over the counts estimates, without labels, how often
documents are good and how often each rule is right about good and about bad ones. The posterior
probability of being good then decides, instead of a demand that all rules pass.

There are at most 3 to the power of the number of rules patterns, whatever the input, so they are
one bounded row, over which the iterations run as one expression. Everything is SQL functions.

Word windows are compared by 64-bit hashes within one text. Defined cases: a null text is an empty
one, which fails the base; repeated rows count and are judged each; an empty table gives no rows.
Other columns pass through, but for those named like a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored

# Fixed patterns: what parts words, and what counts as a symbol.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# A word of letters with a mark after it at most, and frequent short words of the corpus' languages.
CLEAN_WORD = r"^\p{L}+[.,;:?!]?$"
FUNCTION_WORDS = [
    "a", "and", "by", "for", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with",
    "das", "dem", "den", "der", "die", "ein", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "au", "des", "du", "elle", "est", "et", "la", "le", "les", "pour", "qui", "sur", "une",
    "al", "con", "de", "del", "el", "en", "es", "las", "los", "para", "por", "que", "se", "su", "un", "una", "y",
]

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
ITERATIONS = 40
KEEP_AT = 0.5

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_clean", "n_function"]


def _times(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, characters, ""))).cast("long")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without `text`, with the counts in FEATURES.

    Each text's windows are an array of hashes of WINDOW = 5 consecutive words; where any repeats,
    the windows are sorted with their places, equal neighbours give the places of repeated
    windows, and the words those cover are counted.
    """
    keep = [c for c in docs.columns if c.lower() not in {text.lower(), *FEATURES}]
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.select(*keep, value.alias("_text"))
    df = df.select(
        "*",
        F.filter(F.split("_text", SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(NOT_SPACE)).alias("_lines"),
    )
    df = df.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _times(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        _times(F.col("_text"), r"\p{Lu}").alias("n_upper"),
        _times(F.col("_text"), "!").alias("n_marks"),
        F.size(F.filter("_words", lambda w: w.rlike(CLEAN_WORD))).cast("long").alias("n_clean"),
        F.size(F.filter("_words", lambda w: w.isin(FUNCTION_WORDS))).cast("long").alias("n_function"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    rest = lambda name, start: F.slice(name, start, F.size(name))
    hashed = lambda a, b: F.xxhash64(a, b)
    known = [*keep, *[c for c in FEATURES if c != "n_repeat_words"]]
    df = df.select(*known, "_h", F.zip_with("_h", rest("_h", 2), hashed).alias("_2"))
    df = df.select(*known, "_h", F.zip_with("_2", rest("_2", 3), hashed).alias("_4"))
    df = df.select(*known, F.zip_with("_4", rest("_h", 5), hashed).alias("_5"))
    df = df.select(*known, F.slice("_5", 1, F.greatest(F.size("_5") - (WINDOW - 1), F.lit(0))).alias("_windows"))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*known, F.when(repeats, placed).alias("_placed"))
    pairs = F.zip_with("_placed", rest("_placed", 2), lambda x, y: F.when(x.h == y.h, F.array(x.i, y.i)))
    df = df.select(*known, F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))).alias("_places"))
    covers = F.zip_with("_places", rest("_places", 2), lambda x, y: F.least(F.coalesce(y - x, F.lit(WINDOW)), F.lit(WINDOW)).cast("long"))
    covered = F.aggregate(covers, F.lit(0).cast("long"), lambda total, n: total + n)
    return df.select(*known, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def votes() -> list[Column]:
    """The rules. Their levels are far from what prose has on the one side and junk on the other."""
    words, lines = F.col("n_words"), F.col("n_lines")

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return [
        rule(words >= 20, words < 5),
        rule(100 * F.col("n_repeat_words") <= 5 * words, 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * words),
        rule(100 * F.col("n_symbols") <= 5 * words, 100 * F.col("n_symbols") > 30 * words),
        rule(100 * F.col("n_dup_lines") <= 10 * lines, 100 * F.col("n_dup_lines") > 30 * lines),
        rule(100 * F.col("n_upper") <= 10 * F.col("word_chars"), 100 * F.col("n_upper") > 40 * F.col("word_chars")),
        rule(100 * F.col("n_marks") <= 5 * words, 100 * F.col("n_marks") > 30 * words),
        rule(100 * F.col("n_clean") >= 85 * words, 100 * F.col("n_clean") < 60 * words),
        rule(100 * F.col("n_function") >= 10 * words, 100 * F.col("n_function") < 2 * words),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def pattern(rules: list[Column]) -> Column:
    """The votes as digits of one number to the base 3."""
    return sum(((vote + 1) * 3**j for j, vote in enumerate(rules)), F.lit(0)).cast("int")


# The model is a struct: `prior` of good, `right_good[j]` and `right_bad[j]`, the probabilities that
# rule j, when it votes, is right about a good and a bad document.
POSTERIOR = """1 / (1 + exp(least(600, greatest(-600,
    aggregate(zip_with({votes}, zip_with({model}.right_good, {model}.right_bad, (g, b) -> struct(g, b)),
        (v, m) -> case v when 1 then ln((1 - m.b) / m.g) when -1 then ln(m.b / (1 - m.g)) else 0D end),
      ln((1 - {model}.prior) / {model}.prior), (total, x) -> total + x)))))"""

# One more virtual vote of each kind keeps every probability inside (0, 1).
ITERATION = """transform(array(transform(patterns, p -> struct(p.votes, p.n, {posterior} as good))), posts -> struct(
  (aggregate(posts, 0D, (t, p) -> t + p.n * p.good) + 1) / (aggregate(posts, 0D, (t, p) -> t + p.n) + 2) as prior,
  transform(sequence(0, {last}), j -> (aggregate(posts, 1D, (t, p) -> t + if(p.votes[j] = 1, p.n * p.good, 0D)))
    / (aggregate(posts, 2D, (t, p) -> t + if(p.votes[j] != 0, p.n * p.good, 0D)))) as right_good,
  transform(sequence(0, {last}), j -> (aggregate(posts, 1D, (t, p) -> t + if(p.votes[j] = -1, p.n * (1 - p.good), 0D)))
    / (aggregate(posts, 2D, (t, p) -> t + if(p.votes[j] != 0, p.n * (1 - p.good), 0D)))) as right_bad))[0]"""

START = """struct(0.8D as prior, transform(sequence(0, {last}), j -> 0.95D) as right_good,
  transform(sequence(0, {last}), j -> 0.3D) as right_bad)"""


def posteriors(counts: DataFrame, n_rules: int) -> DataFrame:
    """(pattern, posterior) from (pattern, n), which has 3 ** n_rules rows at most."""
    last = n_rules - 1
    digits = f"transform(sequence(0, {last}), j -> cast(floor(pattern / power(3, j)) % 3 - 1 as int))"
    listed = counts.select(F.struct("pattern", F.expr(digits).alias("votes"), F.col("n").cast("double").alias("n")).alias("p"))
    row = listed.agg(F.sort_array(F.collect_list("p")).alias("patterns"))  # a bounded row
    step = ITERATION.format(last=last, posterior=POSTERIOR.format(votes="p.votes", model="model"))
    start = START.format(last=last)
    row = row.selectExpr("patterns", f"aggregate(sequence(1, {ITERATIONS}), {start}, (model, i) -> {step}) as fitted")
    good = POSTERIOR.format(votes="p.votes", model="fitted")
    return row.selectExpr(f"inline(transform(patterns, p -> struct(p.pattern, {good} as posterior)))")


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without `text`, with FEATURES, base_failed, votes' posterior and kept."""
    rules = votes()
    drop = [c for c in docs.columns if c.lower() in ("pattern", "posterior", "base_failed", "kept")]
    counted = stored(features(docs.drop(*drop), text).withColumn("pattern", pattern(rules)), "features")
    counts = counted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    model = posteriors(counts, len(rules))
    scored = counted.join(F.broadcast(model), "pattern")  # a row for each pattern
    failed = base_failed()
    return scored.select("*", failed.alias("base_failed"), (~failed & (F.col("posterior") >= KEEP_AT)).alias("kept")).drop("pattern")
