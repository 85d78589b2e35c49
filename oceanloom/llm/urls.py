"""Operator 13, URL filters: rules, and for the rest the ratio of two smoothed variable-order character Markov models.

The models learn from every distinct URL that a rule accepts or rejects.  Order k backs off to order k - 1::

    P_k(x | c) = (n(c x) + BACK_OFF * P_{k-1}(x | c')) / (n(c) + BACK_OFF),   c' = c without its first character

so where a context is seen little, a shorter one decides.  The log-likelihood difference of a URL is a sum over the grams
that it holds, each with a share of its own (see ``gram_shares``), so scoring is a join and a sum.  Grams of very many
URLs, fewer than SHARE by proof, are joined from a broadcast table; no key of the shuffled rest is that frequent.

The difference is divided by the URL's length.  The limit that verdicts are made by is calibrated on a fold of the ruled URLs
that the models don't learn from.  DataFrame functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oceanloom.llm.common import cut, join_to_rows, remove, shared_folder

#: Fixed values: (host, path, verdict) of the rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
ORDER, BACK_OFF = 4, 4.0
#: Grams of more than this part of all gram occurrences come from a broadcast table.
SHARE = 1 << 16
#: A fold of this many is kept from the models for calibration.
FOLDS = 5
#: Width and reach of the histogram of differences that the limit is chosen from; beyond the reach the last bins count.
BIN, REACH = 0.01, 10.0
#: Shares are whole multiples of this, so that their sums don't depend on an order.
UNIT = 1e-6
START, END = "\x02", "\x03"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def spelled(url: Column) -> Column:
    """What the models read: lower case, each digit as 0, every character beyond visible ASCII as ~, between a start and an end."""
    return F.concat(F.lit(START), F.regexp_replace(F.translate(F.lower(F.coalesce(url, F.lit(""))), "123456789", "000000000"), r"[^\x21-\x7e]", "~"), F.lit(END))


def grams(urls: DataFrame, order: int) -> DataFrame:
    """``gram`` beside the other columns: every run of up to order + 1 characters that ends after the start, as often as it stands."""
    at = urls.select("*", F.explode(F.sequence(F.lit(2), F.length("spelled"))).alias("p"))
    runs = at.select("*", F.explode(F.sequence(F.lit(0), F.least(F.lit(order), F.col("p") - 1))).alias("k"))
    return runs.select(*[c for c in urls.columns if c != "spelled"], F.substring("spelled", F.col("p") - F.col("k"), F.col("k") + 1).alias("gram"))


def gram_counts(urls: DataFrame, order: int) -> DataFrame:
    """``gram, a, r, n``: occurrences in accepted and rejected URLs that the models learn from, and in all."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return grams(urls.select("spelled", "learn"), order).groupBy("gram").agg(one(F.col("learn") == "allow").alias("a"), one(F.col("learn") == "block").alias("r"), F.count("*").alias("n"))


def _toward(a: Column, r: Column, back_off: float) -> Column:
    """What backing off from a context adds to the difference."""
    return F.log(F.lit(back_off) / (a + back_off)) - F.log(F.lit(back_off) / (r + back_off))


def gram_shares(counts: DataFrame, starts: tuple[int, int], order: int, back_off: float) -> tuple[DataFrame, Column]:
    """``gram, share`` of the grams that the models know, and the share of a URL's start.

    With d(g) the log ratio of g's last character after the others, and e(c) what backing off from context c adds, a place's
    log ratio is the sum over its contexts of e(c), and for each gram g = c x seen there of d(g) - d(g') - e(c).  So a gram's
    share is d(g) - d(g') - e(c), and e(g), since g is the next place's context where it isn't the longest or the end.
    A gram's suffix is seen wherever the gram is.
    """
    known = counts.where("a + r > 0")
    n_a, n_r = starts
    levels, before = [], None
    for k in range(order + 1):
        level = known.where(F.length("gram") == k + 1)
        context = F.expr("substring(gram, 1, length(gram) - 1)")
        if k == 0:
            total = level.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("ca"), F.coalesce(F.sum("r"), F.lit(0)).alias("cr"))
            level = level.crossJoin(F.broadcast(total)).withColumns({"pa": F.lit(1 / 256), "pr": F.lit(1 / 256)})  # one row
        else:
            by = Window.partitionBy("context")  # a row for each character at most
            level = level.withColumn("context", context).withColumns({"ca": F.sum("a").over(by), "cr": F.sum("r").over(by)})
            level = level.withColumn("suffix", F.expr("substring(gram, 2)")).join(before, "suffix")
        chance = lambda n, total, shorter: (F.col(n) + back_off * F.col(shorter)) / (F.col(total) + back_off)
        ratio = F.log(chance("a", "ca", "pa")) - F.log(chance("r", "cr", "pr"))
        gain = ratio - (F.log("pa") - F.log("pr")) - _toward(F.col("ca"), F.col("cr"), back_off)
        leads = F.when(F.col("gram").endswith(END) | F.lit(k == order), F.lit(0.0)).otherwise(_toward(F.col("a"), F.col("r"), back_off))
        level = level.select("gram", (gain + leads).alias("share"), chance("a", "ca", "pa").alias("na"), chance("r", "cr", "pr").alias("nr"))
        levels.append(level.select("gram", F.round(F.col("share") / UNIT).cast("bigint").alias("share")))
        before = level.select(F.col("gram").alias("suffix"), F.col("na").alias("pa"), F.col("nr").alias("pr"))
    shares = levels[0]
    for level in levels[1:]:
        shares = shares.unionByName(level)
    return shares, F.round(_toward(F.lit(n_a), F.lit(n_r), back_off) / UNIT).cast("bigint")


def valued_grams(counts: DataFrame, shares: DataFrame) -> DataFrame:
    """``gram, share, hot`` of all grams, 0 for those that no model knows; fewer than SHARE are hot."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    return counts.select("gram", "n").join(shares, "gram", "left").select("gram", F.coalesce("share", F.lit(0)).alias("share"), (F.col("n") * SHARE > total).alias("hot"))


def differences(urls: DataFrame, valued: DataFrame, per_place: Column, at_start: Column, order: int) -> DataFrame:
    """``key, score``: the log-likelihood difference of each distinct URL, divided by its length and end."""
    hot, cold = valued.where("hot").drop("hot"), valued.where("NOT hot AND share <> 0").drop("hot")
    each = grams(urls.select("key", "spelled"), order)
    often = each.join(F.broadcast(hot), "gram").groupBy("key").agg(F.sum("share").alias("s"))
    seldom = each.join(F.broadcast(hot.select("gram")), "gram", "left_anti").join(cold, "gram").groupBy("key").agg(F.sum("share").alias("s"))
    length = F.length("spelled") - 1
    own = urls.select("key", (at_start + per_place * length).alias("s"), length.alias("length"))
    summed = own.unionByName(often.withColumn("length", F.lit(None).cast("int"))).unionByName(seldom.withColumn("length", F.lit(None).cast("int")))
    return summed.groupBy("key").agg((F.sum("s") * UNIT / F.max("length")).alias("score"))


def calibrated_limit(scored: DataFrame) -> float:
    """The lower edge of the histogram bin from which on accepting keeps most of the accepted and least of the rejected, by rate.

    Empty bins count too, so a limit may lie between both sorts.  Equal limits: the one nearest to 0, then the lower.  Without both sorts in the fold the limit is 0.
    """
    place = F.floor(F.least(F.greatest(F.col("score"), F.lit(-REACH)), F.lit(REACH)) / BIN).cast("int")
    one = lambda v: F.sum(F.when(F.col("verdict") == v, 1).otherwise(0))
    filled = scored.groupBy(place.alias("bin")).agg(one("allow").alias("a"), one("block").alias("r"))
    edge = round(REACH / BIN)
    bins = scored.sparkSession.range(-edge, edge + 1).select(F.col("id").cast("int").alias("bin")).join(F.broadcast(filled), "bin", "left").na.fill(0)
    every = Window.orderBy("bin").rowsBetween(Window.currentRow, Window.unboundedFollowing)  # 2,001 bins at most
    rates = bins.withColumns({"fa": F.sum("a").over(every), "fr": F.sum("r").over(every)}).crossJoin(F.broadcast(bins.agg(F.sum("a").alias("ta"), F.sum("r").alias("tr"))))
    best = rates.where("ta > 0 AND tr > 0").orderBy(F.desc(F.round(F.col("fa") / F.col("ta") - F.col("fr") / F.col("tr"), 9)), F.abs("bin"), "bin").first()
    return best["bin"] * BIN if best else 0.0


def judge(pages: DataFrame, rules: tuple = RULES, order: int = ORDER, back_off: float = BACK_OFF) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row; ``score`` is null where a rule decides.

    A null URL counts as empty; null and empty URLs and those without ``://`` have neither host nor path, so no rule fits and the
    models decide.  Where no rule has decided anything every score is 0, and URLs are allowed.  Repeated rows each have a result.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host, path = parts(F.col("url"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    read = pages.select(F.col("page_id").cast("bigint").alias("page_id"), url.alias("url")).select("page_id", "url", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), verdict.alias("verdict"))
    folder = f"{shared_folder(spark)}/urls-{uuid.uuid4().hex}"
    try:
        key = F.unhex(F.md5("url"))
        held = F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("bigint") % FOLDS == 0
        distinct = read.groupBy("url", "verdict").agg(F.count("*").alias("n")).select(key.alias("key"), spelled(F.col("url")).alias("spelled"), "verdict", F.when(~held, F.col("verdict")).alias("learn"), "n")
        distinct.write.parquet(f"{folder}/urls")
        urls = spark.read.parquet(f"{folder}/urls")
        gram_counts(urls, order).write.parquet(f"{folder}/counts")
        counts = spark.read.parquet(f"{folder}/counts")
        one = lambda of, v: F.coalesce(F.sum(F.when(F.col("learn") == v, of)), F.lit(0)).alias(v)
        starts, places = (urls.agg(one(of, "allow"), one(of, "block")).first() for of in (F.lit(1), F.length("spelled") - 1))
        shares, at_start = gram_shares(counts, tuple(starts), order, back_off)
        per_place = F.round(_toward(F.lit(places[0]), F.lit(places[1]), back_off) / UNIT).cast("bigint")
        valued_grams(counts, shares).write.parquet(f"{folder}/grams")
        wanted = urls.where("verdict IS NULL OR learn IS NULL")
        differences(wanted, spark.read.parquet(f"{folder}/grams"), per_place, at_start, order).join(wanted.select("key", "verdict", "n"), "key").write.parquet(f"{folder}/scores")
        scores = spark.read.parquet(f"{folder}/scores")
        limit = calibrated_limit(scores.where("verdict IS NOT NULL"))
        open_urls = scores.where("verdict IS NULL").select("key", "n", "score")
        rows = read.select("page_id", "host", "path", "rule", F.col("verdict").alias("own"), F.when(F.col("verdict").isNull(), key).alias("key"))
        undecided = join_to_rows(rows.where("own IS NULL"), open_urls, "key", "n", ["score"])
        judged = undecided.withColumn("verdict", F.when(F.col("score") >= limit, "allow").otherwise("block"))
        decided = rows.where("own IS NOT NULL").withColumns({"verdict": F.col("own"), "score": F.lit(None).cast("double")})
        out = ("page_id", "host", "path", "rule", "verdict", "score")
        return cut(judged.select(*out).unionByName(decided.select(*out)))
    finally:
        remove(spark, folder)
