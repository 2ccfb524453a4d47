"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at one property of a text and votes good (1), bad (-1) or abstains (0). How often
a rule is right is not set by hand: expectation-maximisation over the counts of all vote patterns
estimates it, together with the share of good texts, and a text's posterior probability of being
good decides. At most 3 ** (number of rules) patterns exist, whatever the number of documents.

Words are the runs of characters outside U+0020 and U+0009 to U+000D. A null or empty text has no
words and fails the base rules, as does one with under 50 words or with more than half of its
words in repeated three-word windows. Ties at the threshold are kept. Repeated rows get equal
results, other columns pass through or are ignored, an empty table gives an empty one.
"""

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.sources.workspace import materialise

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Base rules: fewer words, or a larger share in percent of words in repeated windows, fail.
MIN_WORDS, MAX_REPEATED = 50, 50
ROUNDS = 15
#: Right votes, abstentions and wrong votes that each rule is assumed to have given beforehand.
RIGHT, NONE, WRONG = 8.0, 8.0, 2.0
#: Posterior probability from which a text is kept.
KEEP = 0.5


def measured(df: DataFrame, text: str = "text", out: str = "_rules", keep_text: bool = True) -> DataFrame:
    """The rows, with or without their text, and a struct of what the rules look at.

    Arrays are columns between the steps, and each is used at least twice in the next one: an
    expression used once inside a lambda would be moved into it and made anew for each element.
    """
    # the row travels as one struct, so that its columns' names don't matter
    own = [c for c in df.columns if c != out and (keep_text or c != text)]
    full, words = F.col("_text"), F.col("_words")
    without = lambda pattern: F.length(F.regexp_replace(full, pattern, ""))
    nothing = lambda kind: F.array().cast(f"array<{kind}>")

    step = df.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    step = step.withColumn("_lines", F.filter(F.split(full, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""))
    step = step.select(
        "_row",
        F.struct(
            without(SPACE).cast("long").alias("word_chars"),
            (F.length(full) - without("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.length(full) - without("[.!?]")).cast("long").alias("n_marks"),
            without(r"[\p{L}\p{N}\x20\x09-\x0D]+").cast("long").alias("n_special"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        ).alias("_numbers"),
        F.btrim(full, F.lit(SPACE_CHARS)).alias("_trim"),
    )
    step = step.withColumn("_words", F.when(F.col("_trim") == "", nothing("string")).otherwise(F.split("_trim", SPACE))).drop("_trim")

    # a window is its hash, whose lowest bits make room for its place; sorted, equal ones are neighbours
    room = F.ceil(F.log2(F.greatest(F.size(words), F.lit(1 << 20)).cast("double")))
    step = step.withColumn("_low", F.pow(F.lit(2.0), room).cast("long") - 1)
    low = F.col("_low")
    window = lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    placed = lambda w, i: window(w, i).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))
    windows = F.greatest(F.size(words) - 2, F.lit(0))
    step = step.withColumn("_sorted", F.sort_array(F.transform(F.slice(words, F.lit(1), windows), placed)))
    order = F.col("_sorted")
    alike = lambda x, y: F.coalesce(x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(low)) == 0, F.lit(False))
    step = step.withColumn(
        "_twice", F.filter(order, lambda x, k: alike(x, F.get(order, k + 1)) | alike(x, F.get(order, k - 1)))
    ).drop("_sorted")

    # two different windows with one hash: then the windows' words themselves are sorted
    twice = F.col("_twice")
    place = lambda x: x.bitwiseAND(low).cast("int")
    word_at = lambda x, k: F.get(words, place(x) + k)
    other = lambda x, y: (word_at(x, 0) != word_at(y, 0)) | (word_at(x, 1) != word_at(y, 1)) | (word_at(x, 2) != word_at(y, 2))
    clash = F.exists(
        F.transform(twice, lambda x, k: alike(x, F.get(twice, k - 1)) & F.coalesce(other(x, F.get(twice, k - 1)), F.lit(False))),
        lambda x: x,
    )
    spelled = F.array_sort(F.transform(
        F.slice(words, F.lit(1), windows),
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")),
    ))
    step = step.withColumn("_spelled", F.when(clash, spelled))
    exact = F.col("_spelled")
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    repeated = F.filter(exact, lambda x, k: same(x, F.get(exact, k + 1)) | same(x, F.get(exact, k - 1)))
    places = F.when(exact.isNull(), F.transform(twice, place)).otherwise(F.transform(repeated, lambda x: x["i"]))
    covered = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2))))
    numbers = lambda *names: [F.col(f"_numbers.{n}") for n in names]
    result = F.struct(
        F.size(words).cast("long").alias("n_words"),
        *numbers("word_chars", "n_symbols", "n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        *numbers("n_marks", "n_special", "n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
    )
    return step.select(*(F.col(f"_row.`{c}`") for c in own), result.alias(out))


def base_failed(at: str = "_rules") -> Column:
    n, repeated = F.col(f"{at}.n_words"), F.col(f"{at}.n_repeat_words")
    return (n < MIN_WORDS) | (repeated * 100 > n * MAX_REPEATED)


def votes(at: str = "_rules") -> dict[str, Column]:
    """The votes. A rule abstains between its limits; finding no repetition says nothing good."""
    get = lambda name: F.col(f"{at}.{name}")
    n = F.greatest(get("n_words"), F.lit(1))
    symbols, repeats, length = get("n_symbols") / n, get("n_repeat_words") / n, get("word_chars") / n
    sentences, variety = get("n_marks") / n, get("n_distinct") / n
    special = get("n_special") / F.greatest(get("word_chars"), F.lit(1))
    doubled = get("n_dup_lines") / F.greatest(get("n_lines"), F.lit(1))

    def vote(bad: Column, good: Column = F.lit(False)) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "symbols": vote(symbols > 0.1, symbols <= 0.02),
        "special": vote(special > 0.12, special <= 0.06),
        "word_length": vote(~length.between(3.0, 10.0), length.between(3.5, 7.0)),
        "sentences": vote((sentences < 0.005) | (sentences > 0.6), sentences.between(0.02, 0.25)),
        "repeats": vote(repeats > 0.25),
        "lines": vote(doubled > 0.3),
        "variety": vote(variety < 0.2),
    }


def fit(patterns: DataFrame) -> tuple[float, dict[str, tuple[float, float]]]:
    """The share of good texts, and each rule's weight in log odds when it votes bad and good.

    ``patterns`` has a column for each rule and the count of each combination: at most 3 ** rules rows, whatever
    the number of texts, which are brought over once. A rule is never trusted to mean the opposite of its vote.
    """
    rules = [c for c in patterns.columns if c != "count"]
    counts = [(tuple(r[c] for c in rules), r["count"]) for r in patterns.collect()]
    share, weights = 0.5, {r: (math.log(WRONG / RIGHT), math.log(RIGHT / WRONG)) for r in rules}
    for _ in range(ROUNDS if counts else 0):
        sums = Counter()
        for pattern, count in counts:
            odds = math.log(share / (1 - share)) + sum({-1: weights[r][0], 1: weights[r][1]}.get(v, 0.0) for r, v in zip(rules, pattern))
            mass = {"good": count / (1 + math.exp(-odds))}
            mass["bad"] = count - mass["good"]
            for kind, m in mass.items():
                sums[kind] += m
                for r, v in zip(rules, pattern):
                    sums[r, kind, v] += m
        share = (sums["good"] + RIGHT) / (sums["good"] + sums["bad"] + RIGHT + RIGHT)
        share = min(max(share, 0.05), 0.95)

        def odds_of(rule: str, vote: int) -> float:
            assumed = (RIGHT, WRONG) if vote == 1 else (WRONG, RIGHT)
            of_good, of_bad = ((sums[rule, kind, vote] + a) / (sums[kind] + RIGHT + NONE + WRONG) for kind, a in zip(("good", "bad"), assumed))
            return math.log(of_good / of_bad)

        weights = {r: (min(odds_of(r, -1), 0.0), max(odds_of(r, 1), 0.0)) for r in rules}
    return share, weights


def posterior(share: float, weights: dict[str, tuple[float, float]], vote) -> Column:
    odds = F.lit(math.log(share / (1 - share)))
    for rule, (bad, good) in weights.items():
        odds = odds + F.when(vote(rule) == 1, good).when(vote(rule) == -1, bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judged(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows, with or without their text, and a struct ``_rules``: the base numbers, base_failed, posterior and kept.

    The rows are written once with their numbers, so the texts are measured once. The accuracies
    are estimated on all texts that pass the base rules; the others are rejected anyway.
    """
    rows = materialise(measured(df, text, keep_text=keep_text), "measured")
    cast = votes()
    patterns = rows.where(~base_failed()).groupBy(*(v.alias(r) for r, v in cast.items())).count()
    share, weights = fit(patterns)
    chance = posterior(share, weights, cast.__getitem__)
    return rows.withColumn("_rules", F.struct(
        "_rules.*", base_failed().alias("base_failed"), chance.alias("posterior"),
        (~base_failed() & (chance >= KEEP)).alias("kept"),
    ))
