"""Quality rules as weak supervision: rules vote, expectation-maximisation weighs them.

All-must-pass filtering rejects a document for any single rule.  Here each rule in
`RULES` votes or abstains: a fault rule votes "bad" or abstains, a merit rule votes
"good" or abstains.  A document's class, good or bad, is hidden.  Expectation-maximisation
estimates from all documents, without a label, the share of good documents and how
often each rule votes on good and on bad documents, and so its accuracy:

* documents with equal votes are alike, so the votes are first counted per pattern.
  There are at most 2 ** len(RULES) patterns whatever the corpus, and the counts are
  partial sums before any shuffle, so no group of documents meets in a task;
* an iteration is one aggregate over the pattern table: the expectation step is a
  column (the posterior of each pattern), the maximisation step a row of sums;
* posteriors enter the sums as whole billionths, so that sums don't depend on the order
  of rows and reruns agree.

A vote's log-odds is the logarithm of its rule's rate on good over that on bad
documents.  Votes are taken as independent given the class, and an abstention adds
nothing: documents fail in many ways, so the rules that a bad document passes say
little for it.  (With evidence from abstentions the two classes part by whichever fault
sets off most rules, and documents with other faults count as good.)  `quality` is the
posterior probability of "good".  The rates have a prior of ``PRIOR`` documents at the
start values, which also keeps the two classes from changing places.

Everything is DataFrame functions: word hashes, window hashes and line sets are array
expressions on the row of the document, nothing is exploded and no text is shuffled.
Windows are compared by a 64-bit hash of their 8 word hashes; two different windows of
one text would have to collide to be taken for equal.

Edge cases: null and empty texts have no words (all counts 0; only the length rule
votes, for bad); null ids are documents like others; repeated rows count each; an empty
table gives an empty result; a text is one row's arrays, so very long texts need about
60 bytes of memory a word; a posterior of exactly ``KEEP_AT`` counts as good; other
columns aren't read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

SPACE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
LETTER = r"\p{L}"
SENTENCE_END = r"[.!?][\"')\x5D\x20\x09-\x0D]*$"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
KEEP_AT = 0.5

GOOD, BAD = "good", "bad"
#: (name, vote, feature, condition): a rule votes where its condition holds.
RULES = (
    ("short", BAD, "n_words", "{x} < 20"),
    ("odd_word_length", BAD, "word_length", "{x} < 3 OR {x} > 10"),
    ("symbols", BAD, "symbols", "{x} > 0.1"),
    ("repeated_lines", BAD, "repeated_lines", "{x} > 0.3"),
    ("repeated_words", BAD, "repeated_words", "{x} > 0.3"),
    ("no_letters", BAD, "letters", "{x} < 0.8"),
    ("few_letters", BAD, "letter_share", "{x} < 0.75"),
    ("capitals", BAD, "capitals", "{x} > 0.3"),
    ("digits", BAD, "digits", "{x} > 0.2"),
    ("no_sentences", BAD, "sentences", "{x} < 0.3"),
    ("monotone", BAD, "variety", "{x} < 0.2"),
    ("long_word", BAD, "longest", "{x} > 100"),
    ("long_enough", GOOD, "n_words", "{x} >= 50"),
    ("sentences", GOOD, "sentences", "{x} >= 0.8"),
    ("varied", GOOD, "variety", "{x} >= 0.4"),
    ("usual_word_length", GOOD, "word_length", "{x} BETWEEN 4 AND 8"),
)
ITERATIONS = 15
GOOD_SHARE = 0.8
#: Start values: how often a rule of each kind votes on (good, bad) documents.
RATES = {BAD: (0.02, 0.3), GOOD: (0.9, 0.5)}
PRIOR = 4.0
UNIT = 10 ** 9   # posteriors are summed in whole billionths
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, ``COUNTS``, and the rules' other features), a row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("key"), text.alias("t"))
    d = d.select("key", "t", F.array_remove(F.split("t", SPACE), "").alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(HAS_WORD)).alias("l"))
    d = d.select("key", "t", "w", "l", F.size("w").cast("long").alias("n_words"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    # element by element: a slice would copy the whole array for every window
    windows = F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]))
    d = d.withColumn("v", F.when(F.size("h") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # windows by hash, only where some hash comes twice
    by_hash = F.array_sort(F.transform("v", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    d = d.withColumn("s", F.when(F.size(F.array_distinct("v")) < F.size("v"), by_hash))
    same = lambda x, i: F.get("s", i - 1)["h"].eqNullSafe(x["h"]) | F.get("s", i + 1)["h"].eqNullSafe(x["h"])
    at = F.array_sort(F.transform(F.filter("s", same), lambda x: x["p"]))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    words, chars, lines = F.col("n_words"), F.col("word_chars"), F.size("l")
    d = d.withColumns({
        "word_chars": F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_letters": F.size(F.filter("w", lambda x: x.rlike(LETTER))),
        "n_letter_chars": F.regexp_count("t", F.lit(LETTER)), "n_capitals": F.regexp_count("t", F.lit(r"\p{Lu}")), "n_digits": F.regexp_count("t", F.lit("[0-9]")),
        "n_ends": F.size(F.filter("l", lambda x: x.rlike(SENTENCE_END))),
        "n_distinct": F.size(F.array_distinct("h")), "longest": F.array_max(F.transform("w", lambda x: F.length(x)))})
    return d.select(
        "key", *COUNTS, F.try_divide(chars, words).alias("word_length"), F.try_divide("n_symbols", words).alias("symbols"),
        F.when(lines >= 5, F.col("n_dup_lines") / lines).alias("repeated_lines"),
        F.when(words >= WINDOW, F.col("n_repeat_words") / words).alias("repeated_words"),
        F.try_divide("n_letters", words).alias("letters"), F.try_divide("n_letter_chars", chars).alias("letter_share"), F.try_divide("n_capitals", chars).alias("capitals"),
        F.try_divide("n_digits", chars).alias("digits"), F.when(lines >= 3, F.col("n_ends") / lines).alias("sentences"),
        F.when(words >= 20, F.col("n_distinct") / words).alias("variety"), "longest")


def votes() -> list[Column]:
    """A column per rule: whether it votes (false: it abstains, also where its feature is null)."""
    return [F.coalesce(F.expr(when.format(x=feature)), F.lit(False)).alias(f"vote_{name}") for name, _, feature, when in RULES]


VOTES = [f"vote_{name}" for name, *_ in RULES]


def posterior(model: dict) -> Column:
    """P(good | votes) of a row with the columns of `votes`."""
    z = F.lit(math.log(model["good"] / (1 - model["good"])))
    for vote, (on_good, on_bad) in zip(VOTES, model["rates"]):
        z = z + F.when(F.col(vote), F.lit(math.log(on_good / on_bad))).otherwise(F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-z))


def start_model() -> dict:
    return {"good": GOOD_SHARE, "rates": [RATES[kind] for _, kind, *_ in RULES]}


def fit(patterns: DataFrame, iterations: int = ITERATIONS) -> dict:
    """The share of good documents and each rule's rates on (good, bad) documents, from
    ``patterns``: the columns of `votes` and ``n`` (documents with these votes)."""
    model = start_model()
    exact = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0))
    n = F.col("n").cast("decimal(20,0)")
    for _ in range(iterations):
        p = patterns.withColumn("q", F.floor(posterior(model) * UNIT))
        good, bad = n * F.col("q"), n * (F.lit(UNIT) - F.col("q"))
        sums = [exact(good).alias("good"), exact(bad).alias("bad")]
        for vote in VOTES:
            sums += [exact(F.when(F.col(vote), good)).alias(f"good_{vote}"), exact(F.when(F.col(vote), bad)).alias(f"bad_{vote}")]
        t = {k: int(x) / UNIT for k, x in p.agg(*sums).first().asDict().items()}
        rate = lambda hits, of, start: (hits + PRIOR * start) / (of + PRIOR)
        model = {"good": rate(t["good"], t["good"] + t["bad"], GOOD_SHARE),
                 "rates": [(rate(t[f"good_{v}"], t["good"], RATES[kind][0]), rate(t[f"bad_{v}"], t["bad"], RATES[kind][1]))
                           for v, (_, kind, *_) in zip(VOTES, RULES)]}
    return model


def accuracies(model: dict) -> dict[str, float]:
    """Per rule, the share of its votes that are right."""
    out = {}
    for (name, kind, *_), (on_good, on_bad) in zip(RULES, model["rates"]):
        good, bad = model["good"] * on_good, (1 - model["good"]) * on_bad
        out[name] = (good if kind == GOOD else bad) / (good + bad)
    return out


def cast_votes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(key, ``COUNTS``, a vote per rule) of every document, and the documents per pattern of votes."""
    seen = materialize(counts(docs, id_col, text_col).select("key", *COUNTS, *votes()), "rule-votes")
    return seen, materialize(seen.groupBy(*VOTES).agg(F.count(F.lit(1)).alias("n")), "rule-patterns")


def judge(docs: DataFrame, id_col: str, text_col: str, iterations: int = ITERATIONS) -> DataFrame:
    """(key, ``COUNTS``, a vote per rule, quality) of every document."""
    seen, patterns = cast_votes(docs, id_col, text_col)
    return seen.withColumn("quality", posterior(fit(patterns, iterations)))
