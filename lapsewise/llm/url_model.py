"""URL verdicts from rules, and from two character models where no rule fits, in DataFrame functions only.

URLs that a rule allows or blocks are the accepted and rejected examples. For each kind, runs of up
to ``ORDER`` characters are counted over all examples but the calibration share, and give a smoothed
variable-order Markov model: a longer context is used where the runs were seen often enough, and its
probabilities are interpolated with those of the next shorter one. A URL's score is the mean, over
its characters, of the difference between the two log-likelihoods. The threshold is the one with the
best balanced accuracy on the calibration share, found on counts of score steps.

Every run seen LEAST times is kept, whatever the size of the input, so a model grows with its examples.
Weights are looked up for the distinct runs, each level next to the one that is a character shorter,
and joined to the positions by the longest run; Spark decides whether a side is small enough to be
broadcast.

A null URL, or one without ``://``, has an empty host and path and is scored as it is (null: empty).
A host is what stands up to the path, port included, A-Z lower-cased. Without examples of both kinds
every URL without a rule is allowed. Ties between thresholds go to the lowest. Repeated rows get
equal verdicts, extra columns are ignored, an empty table gives an empty one.
"""

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapsewise.operators.joins import join_lookup
from lapsewise.sources.workspace import materialise

#: Verdict, host and start of the path of each rule.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
ORDER = 5
#: A run seen less often is left to the shorter contexts.
LEAST = 2
#: Weight of the shorter context's probability, in observations.
SMOOTH = 2.0
START, END = "\x02", "\x03"
#: Score steps for one unit of log-likelihood, and the steps told apart on either side of 0.
STEPS, RANGE = 200, 4000
#: First digit of a URL's digest that puts it into the calibration share: 3 of 16.
CALIBRATION = "012"
RUNS = [f"g{k}" for k in range(1, ORDER + 1)]


def located(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    pages = pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumn("host", F.regexp_extract("_rest", r"^([^/?#]*)", 1))
    path = F.regexp_extract(F.expr("substring(_rest, length(host) + 1)"), r"^([^?#]*)", 1)
    lowered = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    return pages.withColumn("path", path).withColumn("host", lowered).drop("_rest")


def ruled(rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits host and path: a struct of its text and verdict, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def runs(rows: DataFrame, *keep: str) -> DataFrame:
    """A row for each character and the end of ``_url``: the runs of 1 to ORDER characters that end there."""
    padded = F.concat(
        F.array_repeat(F.lit(START), ORDER - 1), F.when(F.col("_url") == "", F.array().cast("array<string>")).otherwise(F.split("_url", "")), F.array(F.lit(END))
    )
    rows = rows.select(*keep, padded.alias("_c"))
    chars = F.col("_c")
    at = F.sequence(F.lit(ORDER - 1), F.size(chars) - 1)
    ends = F.transform(at, lambda i: F.struct(*(F.concat(*(F.get(chars, i - n) for n in range(k - 1, -1, -1))).alias(f"g{k}") for k in range(1, ORDER + 1))))
    return rows.where(F.size(chars) > 0).select(*keep, F.inline(ends))


def model(examples: DataFrame) -> DataFrame:
    """g, and w: the log of how much likelier the run's last character is among accepted URLs.

    ``examples`` has _url and good. Every run seen at least LEAST times comes out.
    """
    found = runs(examples, "good").select("good", F.explode(F.array(*RUNS)).alias("g"))
    counts = found.groupBy("g").agg(F.count_if("good").alias("n1"), F.count_if(~F.col("good")).alias("n0"))
    counts = counts.withColumn("k", F.length("g"))
    # a context has at most as many rows as there are characters
    context = W.partitionBy("k", F.expr("substring(g, 1, k - 1)"))
    around = counts.select("*", *(F.sum(n).over(context).alias(f"{n}_context") for n in ("n1", "n0")))
    kept = materialise(around.where(F.col("n1") + F.col("n0") >= LEAST), "runs")

    def smoothed(kind: str, shorter: Column) -> Column:
        return (F.col(f"n{kind}") + SMOOTH * shorter) / (F.col(f"n{kind}_context") + SMOOTH)

    level = materialise(kept.where("k = 1").select("g", *(smoothed(c, F.lit(1 / 256)).alias(f"p{c}") for c in "10")), "level")
    table = level
    for k in range(2, ORDER + 1):
        # a kept run's end is kept, as it is seen at least as often
        end = level.select(F.col("g").alias("_end"), F.col("p1").alias("_p1"), F.col("p0").alias("_p0"))
        longer = kept.where(F.col("k") == k).join(end, F.expr("substring(g, 2)") == F.col("_end"))
        level = materialise(longer.select("g", *(smoothed(c, F.col(f"_p{c}")).alias(f"p{c}") for c in "10")), "level")
        table = table.union(level)
    return materialise(table.select("g", (F.ln("p1") - F.ln("p0")).alias("w")), "model")


def longest_known(seen: DataFrame, weights: DataFrame) -> DataFrame:
    """g and w for each run of ORDER characters in ``seen``: the weight of its longest end in the model, else 0."""
    found = None
    for k in range(1, ORDER + 1):
        ends = seen.select(F.expr(f"right(g, {k})").alias("g")).distinct()
        own = weights.where(F.length("g") == k).select("g", "w")
        if found is None:
            found = ends.join(own, "g", "left").select("g", F.coalesce("w", F.lit(0.0)).alias("w"))
        else:
            shorter = found.select(F.col("g").alias("_end"), F.col("w").alias("_w"))
            ends = ends.join(shorter, F.expr("substring(g, 2)") == F.col("_end"))
            found = ends.join(own, "g", "left").select("g", F.coalesce("w", "_w").alias("w"))
    return found


def scored(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """_row and step: the mean log-likelihood difference of ``_url`` in whole steps."""
    ends = runs(rows, "_row").select("_row", F.col(f"g{ORDER}").alias("g"))
    seen = materialise(ends.groupBy("g").agg(F.count("*").alias("_n")), "seen")
    known = materialise(longest_known(seen.select("g"), weights).join(seen, "g"), "weights")
    ends = join_lookup(ends, known, ["g"], "_n", ["_row"])
    mean = F.round(F.sum("w") / F.count("*"), 9)
    step = F.greatest(F.least(F.floor(mean * STEPS), F.lit(RANGE)), F.lit(-RANGE))
    return ends.groupBy("_row").agg(step.cast("long").alias("step"))


def threshold(steps: DataFrame) -> int | None:
    """The lowest step from which accepting has the best balanced accuracy; None if a kind is missing."""
    counts = steps.groupBy("step").agg(F.count_if("good").alias("n1"), F.count_if(~F.col("good")).alias("n0"))
    # at most 2 * RANGE + 1 rows
    from_here, below = W.orderBy("step").rowsBetween(0, W.unboundedFollowing), W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    right = F.sum("n1").over(from_here) / F.sum("n1").over(everything) + F.coalesce(F.sum("n0").over(below), F.lit(0)) / F.sum("n0").over(everything)
    both = (F.sum("n1").over(everything) > 0) & (F.sum("n0").over(everything) > 0)
    best = counts.select("step", F.when(both, F.round(right, 9)).alias("right")).where("right IS NOT NULL").orderBy(F.desc("right"), "step").first()
    return best and best["step"]


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, and the step of the score."""
    rows = located(pages.select(page_id, F.coalesce(url, F.lit("")).alias("_url")), "_url")
    rows = rows.withColumn("_rule", ruled(rules)).withColumn("_row", F.monotonically_increasing_id())
    rows = materialise(rows, "urls")
    held = F.substring(F.md5(F.col("_url").cast("binary")), 1, 1).isin(*CALIBRATION)
    examples = rows.where(F.col("_rule").isNotNull()).withColumn("good", F.col("_rule.verdict") == "allow")
    weights = model(examples.where(~held))
    steps = materialise(scored(rows, weights), "steps")
    known = examples.where(held).select("_row", "good").join(steps, "_row")
    limit = threshold(known)
    own = F.lit("allow") if limit is None else F.when(F.col("step") >= limit, "allow").otherwise("block")
    out = rows.join(steps, "_row")
    return out.select(page_id, "host", "path", "_rule.rule", F.coalesce("_rule.verdict", own).alias("verdict"), "step")
