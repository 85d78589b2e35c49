"""Operator 3, secret scans: pattern rules, and two character Markov models compared by log-likelihood ratio.

One model knows random strings, the other ordinary identifiers; both are tables
of character pairs trained from labelled samples: random are what the pattern
rules find in a bounded sample of documents and generated random strings,
ordinary are the long words of a bounded sample of documents without such finds.
DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oceanloom.llm.common import id_and_text

# The pattern rules; group 2 of the first is the secret itself.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The lengths asked of the other two stand in their patterns: their matches are runs to the end, so dropping short ones is the same.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGN = 6
KINDS = ("assign", "access", "hex", "markov")

#: A run of these characters, this long, is scored by the models; MARK stands for what an assignment covers.
MARK = "\x01"
CANDIDATE = r"[A-Za-z0-9+/_=\x01-]{16,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{8,}"
#: Which of them are labelled ordinary: words, joined or camel-cased, in one case, with a short number at most.
#: Quantifiers are possessive, and only strings of up to LONGEST_ORDINARY characters are tried.
ORDINARY_SHAPE = r"^(?:[A-Z]?[a-z]++(?:[_/+=-]?[A-Z]?[a-z]++)*+|[A-Z]++(?:[_/+=-][A-Z]++)*+)[_-]?[0-9]{0,2}$"
LONGEST_ORDINARY = 64
#: Documents of each sort in the training sample, and strings taken from each of them.
SAMPLE_DOCS, SAMPLE_STRINGS, GENERATED = 2_000, 32, 2_000
#: Log-likelihood ratio that a secret reaches in sum and for each character pair.
LEAST_SUM, LEAST_MEAN = 10.0, 0.4
#: Matches whose positions are added up together.
BLOCK = 256
FIRST, SPAN = 43, 80  # '+' to 'z'
BACK_OFF = 10.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value found once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Array of ``p, w, i``: each piece between matches, the match after it, and its group; the last has no match."""
    whole, inner = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    return F.arrays_zip(F.split(text, pattern, -1).alias("p"), whole.alias("w"), inner.alias("i"))


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of ``s, e, g, m`` for each match: start, end (exclusive, in code points), length of the group, the match.

    The lengths of pieces and matches add up to positions.  They are added within blocks, and the blocks' sums over all
    blocks, since an array that grows by one element at a time would cost the square of the number of matches.
    """
    empty = "array<struct<s:int,e:int,g:int,m:string>>"

    def placed(block: Column, start: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            s = acc["at"] + x["p"]
            here = F.struct(s.alias("s"), (s + x["w"]).alias("e"), x["g"].alias("g"), x["m"].alias("m"))
            return F.struct((s + F.coalesce(x["w"], F.lit(0))).alias("at"), F.when(x["w"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(here))).alias("out"))

        return F.aggregate(block, F.struct(start.alias("at"), F.array().cast(empty).alias("out")), step, lambda acc: acc["out"])

    def starts(blocks: Column) -> Column:
        total = lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x["p"] + F.coalesce(x["w"], F.lit(0)))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(blocks, first, lambda acc, b: F.struct((acc["at"] + total(b)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    lengths = F.transform(_matches(text, pattern, group), lambda x: F.struct(F.length(x["p"]).alias("p"), F.length(x["w"]).alias("w"), F.length(x["i"]).alias("g"), x["w"].alias("m")))
    cut = lambda parts: F.transform(F.sequence(F.lit(1), F.size(parts), F.lit(BLOCK)), lambda k: F.slice(parts, k, F.lit(BLOCK)))
    walk = _let(lengths, lambda parts: _let(cut(parts), lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), placed))))
    return F.when(text.rlike(pattern), walk).otherwise(F.array().cast(empty))


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """Matches of the three rules, leftmost and non-overlapping within a rule; short ones drop after matching."""
    return F.filter(located(text, ASSIGN, 2), lambda x: x["g"] >= LEAST_ASSIGN), located(text, ACCESS), located(text, HEX)


def marked(text: Column) -> Column:
    """The text with MARK for every character of an assignment that counts, and line breaks for MARKs of its own."""
    own = F.when(text.contains(MARK), F.translate(text, MARK, "\n")).otherwise(text)
    one = lambda x: F.concat(x["p"], F.when(F.length(x["i"]) >= LEAST_ASSIGN, F.repeat(F.lit(MARK), F.length(x["w"]))).otherwise(F.coalesce(x["w"], F.lit(""))))
    return F.when(own.rlike(ASSIGN), F.array_join(F.transform(_matches(own, ASSIGN, 2), one), "")).otherwise(own)


def _pairs(strings: DataFrame) -> DataFrame:
    """``label, a, b, n``: how often each pair of neighbouring characters occurs."""
    codes = strings.select("label", F.transform(F.split("value", ""), F.ascii).alias("c"))
    at = codes.where(F.size("c") > 1).select("label", "c", F.explode(F.sequence(F.lit(0), F.size("c") - 2)).alias("k"))
    return at.select("label", F.get("c", F.col("k")).alias("a"), F.get("c", F.col("k") + 1).alias("b")).groupBy("label", "a", "b").count()


def training_strings(docs: DataFrame) -> DataFrame:
    """``label, value``: 1 for random strings, 0 for ordinary identifiers; bounded by the module's sample sizes."""
    spark, text = docs.sparkSession, F.col("text")
    rule = text.rlike(ASSIGN) | text.rlike(ACCESS)

    def sample(rows: DataFrame, values: Column, label: int) -> DataFrame:
        few = rows.select(F.xxhash64("doc_id", "text").alias("o"), F.slice(values, 1, SAMPLE_STRINGS).alias("v")).where("size(v) > 0").orderBy("o", "v").limit(SAMPLE_DOCS)
        return few.select(F.lit(label).alias("label"), F.explode("v").alias("value"))

    found = F.concat(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)))
    random = sample(docs.where(rule), F.filter(found, lambda v: (F.length(v) >= 12) & v.rlike("[0-9]")), 1)
    ordinary = sample(docs.where(~rule), F.filter(F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0)), lambda v: (F.length(v) <= LONGEST_ORDINARY) & v.rlike(ORDINARY_SHAPE)), 0)
    digest = F.sha2(F.concat(F.lit("random:"), F.col("id")), 256)
    made = spark.range(GENERATED).select(
        F.lit(1).alias("label"),
        F.when(F.col("id") % 4 == 0, F.substring(digest, 1, 40)).when(F.col("id") % 4 == 1, F.upper(F.substring(F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", ""), 1, 24)))
        .otherwise(F.substring(F.base64(F.unhex(digest)), 1, 32)).alias("value"),
    )
    return random.unionByName(ordinary).unionByName(made)


def train(docs: DataFrame) -> list[float]:
    """The log-likelihood ratio, random to ordinary, of every pair of characters: SPAN * SPAN numbers.

    A pair's probability backs off to its second character's own, so a first character hardly seen says little by itself.
    """
    counts = [[0.0] * (SPAN * SPAN) for _ in (0, 1)]
    for r in _pairs(training_strings(docs)).collect():  # at most two times SPAN squared rows
        if 0 <= r["a"] - FIRST < SPAN and 0 <= r["b"] - FIRST < SPAN:
            counts[r["label"]][(r["a"] - FIRST) * SPAN + r["b"] - FIRST] += r["count"]

    def log_chances(n: list[float]) -> list[float]:
        alone = [sum(n[b::SPAN]) + 0.5 for b in range(SPAN)]
        total = sum(alone)
        rows = [sum(n[a * SPAN : (a + 1) * SPAN]) for a in range(SPAN)]
        return [math.log((n[k] + BACK_OFF * alone[k % SPAN] / total) / (rows[k // SPAN] + BACK_OFF)) for k in range(SPAN * SPAN)]

    ordinary, random = map(log_chances, counts)
    return [round(x - y, 3) for x, y in zip(random, ordinary, strict=True)]


def log_likelihood_ratio(value: Column, table: list[float]) -> Column:
    """Sum over the value's character pairs; a pair outside the table counts 0."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")  # folded to one constant
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - F.lit(FIRST))
    pair = lambda a, b: F.coalesce(F.get(ratios, a * SPAN + b), F.lit(0.0))
    return F.aggregate(F.zip_with(codes, F.slice(codes, 2, 1 << 30), pair), F.lit(0.0), lambda acc, x: acc + x)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans`` of every whole text.

    Spans are ``kind:start:end`` by start, then in the order of KINDS, joined by commas; ``base_sha256`` is the digest of those of
    the three rules.  The models add runs that no rule's span touches.  A null text counts as empty: no spans, and the digest of
    the empty string; repeated rows each have their result.
    """
    own = id_and_text(docs)
    table = train(own)
    assign, access, hexes = base_spans(F.col("text"))
    found = own.select("doc_id", assign.alias("a"), access.alias("k"), hexes.alias("h"), located(marked(F.col("text")), CANDIDATE).alias("c"))
    tagged = lambda c, kind: F.transform(c, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))
    based = found.select("doc_id", *[F.size(c).cast("bigint").alias(n) for c, n in (("a", "n_assign"), ("k", "n_access"), ("h", "n_hex"))], F.array_sort(F.concat(tagged(F.col("a"), 0), tagged(F.col("k"), 1), tagged(F.col("h"), 2))).alias("base"), "c")

    def secret(x: Column) -> Column:
        ratio = log_likelihood_ratio(x["m"], table)
        return x["m"].rlike("[A-Za-z]") & (ratio >= F.greatest(F.lit(LEAST_SUM), F.lit(LEAST_MEAN) * F.length(x["m"])))

    # The other two rules' spans lie whole within one run.
    free = lambda x: ~x["m"].contains(MARK) & ~x["m"].rlike(ACCESS) & ~x["m"].rlike(HEX)
    scored = based.withColumn("m", F.when(F.size("c") > 0, tagged(F.filter("c", lambda x: free(x) & secret(x)), 3)).otherwise(F.array().cast("array<struct<s:int,k:int,e:int>>")))
    names = F.array(*map(F.lit, KINDS))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.get(names, x["k"]), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")
    return scored.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size("m").cast("bigint").alias("n_markov"), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.array_sort(F.concat("base", "m"))).alias("spans"),
    )
