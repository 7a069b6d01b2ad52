"""URL filters: rules first, then a character language-model ratio, in DataFrame functions only.

Two character models, one of accepted and one of rejected URLs (as the rules decide them), are smoothed
variable-order Markov models over the whole URL after the first ``://`` in its own characters (the host lower-cased):
counts of contexts of 0 to ORDER characters, each order interpolated with the next shorter one (Witten-Bell: weight
by how many different characters follow the context). A context of more than one character counts only where
SUPPORT characters of the training URLs follow it, so contexts grow longer as the URLs grow more. A URL's score
is the mean over its characters of the log ratio. The limit is calibrated on rule-decided URLs that the models
were not fitted on: the lowest score that still lets all but MISSED of the accepted ones pass.

The model is a table keyed by gram that grows with the URLs; scores join it, by broadcast only where it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.sizes import broadcast_if_small
from ..plans.staging import staged

ORDER = 6
SUPPORT = 4
#: what stands before a URL, and how many characters are taken for equally likely where nothing is known
PAD = "\x02"
UNKNOWN = 256
MISSED = 0.02
HELD_OUT = 5
#: host suffix and path prefix -> verdict
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From what follows the first ``://``, so that a later one in a query is never taken for it."""
    rest = F.regexp_extract(url, r"(?s)://(.*)", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _characters(url: Column) -> Column:
    """What follows the first ``://``, query and fragment too, with the host lower-cased."""
    rest = F.regexp_extract(url, r"(?s)://(.*)", 1)
    host = host_of(url)
    return F.coalesce(F.concat(host, F.substring(rest, F.length(host) + 1, F.length(rest))), F.lit(""))


def _grams(urls: DataFrame, *carry: str) -> DataFrame:
    """A row (gram: ORDER characters of context and the character) for every character of ``s``."""
    padded = F.concat(F.lit(PAD * ORDER), F.col("s"))
    at = F.explode(F.sequence(F.lit(1), F.length("s")))
    return (urls.where(F.length("s") > 0).select(*carry, padded.alias("padded"), at.alias("at"))
            .select(*carry, F.substring("padded", F.col("at"), F.lit(ORDER + 1)).alias("gram")))


def _model(grams: DataFrame) -> DataFrame:
    """(gram, ratio) for every gram of ``grams`` (gram, says, n): log p(accepted) - log p(rejected). Grams whose
    ``says`` is null are wanted, but teach nothing. Every order is one aggregate, one window over the characters
    that follow a context, and one join with the next shorter grams."""
    shorter = None
    for k in range(ORDER + 1):
        level = (grams.groupBy(F.substring("gram", ORDER - k + 1, k).alias("c"), F.substring("gram", ORDER - k + 1, k + 1).alias("g"))
                 .agg(F.sum(F.when(F.col("says") == "allow", F.col("n"))).alias("a"), F.sum(F.when(F.col("says") == "block", F.col("n"))).alias("b")))
        following = Window.partitionBy("c")
        level = level.select("g", "a", "b", *[f(x).over(following).alias(name + x) for x in "ab" for name, f in (("n", F.sum), ("k", F.count))])
        if shorter is None:
            level = level.withColumns({"pa": F.lit(1.0 / UNKNOWN), "pb": F.lit(1.0 / UNKNOWN)})
        else:
            level = level.join(shorter, F.substring("g", 2, k) == F.col("h"))
        known = F.coalesce("na", F.lit(0)) + F.coalesce("nb", F.lit(0)) >= (SUPPORT if k > 1 else 1)

        def probability(x: str) -> Column:
            own, kinds = F.coalesce(x, F.lit(0)), F.col(f"k{x}")
            return F.when(known & (F.col(f"n{x}") > 0), (own + kinds * F.col(f"p{x}")) / (F.col(f"n{x}") + kinds)).otherwise(F.col(f"p{x}"))
        shorter = level.select(F.col("g").alias("h"), probability("a").alias("pa"), probability("b").alias("pb"))
    return shorter.select(F.col("h").alias("gram"), (F.log("pa") - F.log("pb")).alias("ratio"))


def _held(s: Column) -> Column:
    """URLs that calibrate the limit and are not counted in the models."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long") % HELD_OUT == 0


def judged(pages: DataFrame, rules=RULES, missed: float = MISSED) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the model's; null where the URL has no character).

    A null URL, or one without ``://``, has an empty host and path, fits no rule and gets no score; the
    model has no evidence against it and it is allowed. So is every URL if the rules accept or reject no
    URL at all. Repeated rows count each. Other columns are ignored; an empty table gives no rows."""
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), _characters(url).alias("s"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = staged(rows.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"),
                              F.col("s")), "urls")
    # equal strings are counted once
    urls = rows.groupBy("s", "says").agg(F.count(F.lit(1)).alias("n"))
    held = _held(F.col("s"))
    grams = staged(_grams(urls.withColumn("says", F.when(~held, F.col("says"))), "says", "n")
                   .groupBy("gram", "says").agg(F.sum("n").alias("n")), "grams")
    model = staged(_model(grams), "model")
    scored = (_grams(rows.select("s").distinct(), "s").join(broadcast_if_small(model, 32 << 20), "gram")
              .groupBy("s").agg(F.round(F.avg("ratio"), 6).alias("score")))
    scored = staged(rows.join(scored, "s", "left").withColumn("held", _held(F.col("s"))).drop("s"), "scored")
    # how many held-out accepted URLs lie at each rounded score: bounded by the bins, not by the URLs
    bins = (scored.where("held and says = 'allow' and score is not null").groupBy(F.round("score", 3).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    along = Window.partitionBy(F.lit(0)).orderBy("bin")
    limit = (bins.withColumn("below", F.sum("n").over(along) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy(F.lit(0))))
             .where(F.col("below") <= missed * F.col("all")).agg(F.max("bin").alias("limit")))
    known = rows.agg(F.count(F.when(F.col("says") == "block", 1)).alias("blocked"))
    judge = F.when((F.col("score") >= F.col("limit")) | F.col("score").isNull() | F.col("limit").isNull() | (F.col("blocked") == 0), "allow").otherwise("block")
    full = scored.crossJoin(F.broadcast(limit)).crossJoin(F.broadcast(known))  # one row each: global aggregates
    return full.select("page_id", "host", "path", "rule", F.coalesce("says", judge).alias("verdict"), "score")
