"""Operator 4, line dedup: an exact set-similarity join of lines, at Jaccard 0.8, that removes later matches.

A line is its set of lower-cased words, ordered from rare to common (by the level of the
count of a word's hash class, of 65,536, over all documents; any order that all lines
share keeps the join exact).  Two sets that reach the threshold differ in so few
words that, in their shared order, some two neighbouring common words have no
differing word between them within a prefix of each; these neighbours are the
signatures.  Lines that share one are candidates, if their lengths and the
signature's positions, and the parities of the sets, still allow the threshold, and are verified.

A line needs one match only, so the likeliest candidate goes first: the first three lines of each signature
are set against all its lines, and of these candidates each line has the one of nearest parity verified.  Only lines that this doesn't
settle meet all lines before them.  There, signatures of many lines make a pair at its least shared signature, as far as the
lines' least few tell, since near copies share most of theirs.  Lines of the same text, but for case and
outer spaces, match the first of them and stay out of the join.  DataFrame functions only.

Null texts have no lines.  Null ids come after the others of the same size, spread by a hash of the text; rows of one id stand in the order of their texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oceanloom.llm.common import cut, remove, settings, shared_folder

SIMILARITY = 0.8
CLASS_BITS = 16
CLASSES = 1 << CLASS_BITS
#: Levels of rarity a doubling of the count, and the most (one byte, below 128).
LEVELS, MOST_LEVEL = 4, 126
HASH_BITS = 56
#: Bits of a signature; texts at any scale have far fewer signatures, and a clash only makes a pair to verify.
SIGNATURE_BITS = 48
#: A set's parities: 64 bits, and 128 for sets of so many words, since with 64 bits most unrelated sets of over 100 words pass.
PARITY_BITS, WIDE_FROM = 64, 80
#: The largest size and place that are told apart.
FULL = (1 << 16) - 1
#: Rows that may be broadcast, as one number each (about 32 MB); larger sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Signatures of so many lines make a pair once; of a line's signatures there, so many are compared to see where.
CROWDED, LEAST_FEW = 16, 8
#: There, parities of so many times 64 bits are compared as well.
FINE_PARTS = 4
#: So many lines of each signature, the first in order, are set against all its lines.
HUBS = 3
LEAST_PARTITIONS = 64
#: Rows without an id have this bit set in their lines' numbers; their ``doc`` is a hash of the text from FIRST_NULL on.
NULL_BIT, FIRST_NULL = 62, 1 << 62
#: Shuffle files go when a job ends, instead of at Spark's next collection: what later steps read has been written by then.  Java's
#: own case mapping takes less time than the other.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.icu.caseMappings.enabled": "false"}
#: White space besides the plain space and the line break.
OTHER_SPACES = ("\t", "\x0b", "\f", "\r")


Keep = Callable[[DataFrame], DataFrame]
#: A line's place and what the filters need of it.
ABOUT = ("doc", "line", "about", "odd", "wide")


def _own(suffix: str = "") -> dict[str, Column]:
    return {c: F.col(c + suffix) for c in ABOUT}


def _is_later(x: dict[str, Column], y: dict[str, Column]) -> Column:
    return (x["doc"] > y["doc"]) | ((x["doc"] == y["doc"]) & (x["line"] > y["line"]))


def _if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _holds_any(text: Column, *parts: str) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def _class_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - CLASS_BITS)


def rarity_levels(rows: DataFrame) -> bytes:
    """The level of each word class, higher for more common ones, over all words of all ``numbered`` texts; a byte a class."""
    word = rows.select(F.explode(F.split(F.lower(F.replace("text", F.lit("\n"), F.lit(" "))), " ")).alias("w")).where("w != ''")
    counts = {r["c"]: r["count"] for r in word.groupBy(_class_of(F.xxhash64("w")).alias("c")).count().collect()}
    return bytes(min(MOST_LEVEL, 1 + int(LEVELS * log2(1 + counts.get(c, 0)))) for c in range(CLASSES))


def word_hashes(line: Column) -> Column:
    """The hashes of the line's distinct words; spaces at an end or beside each other make no word."""
    return F.array_remove(F.array_distinct(F.transform(F.split(F.lower(line), " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def word_keys(line: Column, levels: bytes) -> Column:
    """The line's distinct words as numbers whose order is the rarity order: the class's level, then 56 bits of hash.

    Each distinct word is looked up once, in a constant array whose few values share their objects.  The default can't occur: it says that no
    element is null, so that plain numbers are sorted.
    """
    of_class = F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")
    level = lambda h: F.coalesce(F.get(of_class, _class_of(h).cast("int")), F.lit(0).cast("bigint"))
    return F.sort_array(F.transform(word_hashes(line), lambda h: F.shiftleft(level(h), HASH_BITS).bitwiseOR(h.bitwiseAND((1 << HASH_BITS) - 1))))


def _placed(rows: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """The rows with ``doc`` and ``nth``, which name a row; rows without an id are spread by their text."""
    spread = F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(FIRST_NULL))
    flag = F.when(doc_id.isNull(), F.lit(1 << (NULL_BIT - 32))).otherwise(F.lit(0)).cast("bigint")
    repeated = rows.groupBy(doc_id.alias("id")).count().where("count > 1").limit(1).count()
    rows = rows.withColumn("doc", F.coalesce(doc_id, spread)).withColumn("nth", flag)
    if repeated:
        rows = rows.withColumn("nth", F.col("nth") + F.row_number().over(Window.partitionBy("doc", "nth").orderBy(text)) - 1)
    return rows


def numbered(docs: DataFrame) -> DataFrame:
    """``doc, nth, text``: rows of one id are told apart by their place in the order of texts.  Texts have plain spaces for other
    white space in a line.
    """
    own = _placed(docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text")), F.col("id"), F.col("text"))
    spaced = F.when(_holds_any(F.col("text"), *OTHER_SPACES), F.translate("text", "".join(OTHER_SPACES), " " * len(OTHER_SPACES))).otherwise(F.col("text"))
    return own.select("doc", "nth", spaced.alias("text"))


def lines(rows: DataFrame) -> DataFrame:
    """``doc, line, value`` of the lines that hold a word; a line's number also holds the row's place among equal ids."""
    each = rows.select("doc", "nth", F.posexplode(F.split("text", "\n")).alias("p", "value"))
    return each.where(F.trim("value") != "").select("doc", (F.shiftleft("nth", 32) + F.col("p")).alias("line"), "value")


def _most_neighbours(n: Column, t: float) -> Column:
    """The most of 2(n-o) + (m-o) + 1 over all whole m >= tn, where o is the least whole number of shared words, t/(1+t) * (n+m) or more.

    With s = n+m this is n + 1 + s - 3o.  Without rounding s - 3o falls by q - 1 for each word, q = 3t/(1+t), and rounding takes less than 3 off,
    so no s that lies more than 3/(q-1) above the least one has the most.
    """
    share = t / (1 + t)
    least = n + F.ceil(n * t - 1e-9)
    each = [least + k - 3 * F.ceil((least + k) * share - 1e-9) for k in range(int(3 / (3 * share - 1)) + 2)]
    return (n + 1 + F.greatest(*each)).cast("int")


def signatures(keyed: DataFrame, similarity: float) -> DataFrame:
    """``sig, doc, line, about, odd, wide`` from ``doc, line, k``; about holds the set's size and the signature's place in
    its order (16 bits), odd the parity of its words in each of 64 hash classes, wide that of half its words (for large sets).

    Sets of n and m words at Jaccard t share o >= t/(1+t) * (n+m) words.  The first unbroken neighbours end by word
    2(n-o) + (m-o) + 2 of the first set; ``_most_neighbours`` has the most of this.  With q = 3t/(1+t): a set of one word is its own
    signature.  Unbroken neighbours are sure where q(n+m) > n+m+1, so for all sets of two words or more where q > 5/4; below
    that, each of the first n - tn + 1 words is a signature.
    """
    q = 3 * similarity / (1 + similarity)
    n, neighbours = F.size("k"), q > 1.25
    count = F.greatest(F.lit(1), F.least(n - 1, _most_neighbours(n, similarity)) if neighbours else F.least(n, F.floor(n * (1 - similarity) + 1e-9).cast("int") + 1))
    one = F.lit(1).cast("bigint")
    bits = lambda words: F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseXOR(F.call_function("shiftleft", one, w.bitwiseAND(PARITY_BITS - 1).cast("int"))))
    half = F.filter("k", lambda w: w.bitwiseAND(PARITY_BITS) != 0)
    marked = keyed.select("doc", "line", "k", bits(F.col("k")).alias("odd"), F.when(n >= WIDE_FROM, bits(half)).otherwise(0).alias("wide"))  # before the explode, or they would be found again for each signature
    at = marked.select("doc", "line", "k", "odd", "wide", F.explode(F.sequence(F.lit(0), count - 1)).alias("i"))
    sig = F.shiftrightunsigned(F.xxhash64(F.get("k", "i"), *([F.get("k", F.col("i") + 1)] if neighbours else [])), 64 - SIGNATURE_BITS)
    most = F.lit(FULL).cast("bigint")
    about = F.shiftleft(F.least(F.size("k").cast("bigint"), most), 16).bitwiseOR(F.least(F.col("i").cast("bigint"), most))
    return at.select(sig.alias("sig"), "doc", "line", about.alias("about"), "odd", "wide")


def _may_match(t: float, x: dict[str, Column], y: dict[str, Column]) -> Column:
    """Length, positional and parity filters between two lines' ``about, odd, wide``.

    Up to the first shared word and from it on there must be enough words to share.  The bits that differ between two sets'
    parities can't outnumber the words that differ.  Sizes and places of FULL or more are not known, and pass.
    """
    n, m = (F.shiftrightunsigned(c["about"], 16) for c in (x, y))
    i, j = (c["about"].bitwiseAND(FULL) for c in (x, y))
    length = F.least(n, m) >= t * F.greatest(n, m) - 1e-9
    bound = F.least(i, j) + F.least(n - i, m - j)
    odd, wide = x["odd"].bitwiseXOR(y["odd"]), x["wide"].bitwiseXOR(y["wide"])
    odd = F.when((n >= WIDE_FROM) & (m >= WIDE_FROM), F.bit_count(odd.bitwiseXOR(wide)) + F.bit_count(wide)).otherwise(F.bit_count(odd))
    near = (bound * (1 + t) >= t * (n + m) - 1e-9) & (odd <= (n + m) * ((1 - t) / (1 + t)) + 1e-9)
    return length & (near | (n >= FULL) | (m >= FULL))


def _both_of(pairs: DataFrame) -> DataFrame:
    return pairs.select("doc", "line").unionByName(pairs.select(F.col("doc0").alias("doc"), F.col("line0").alias("line")))


def _words_of(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """``doc, line, k`` of the lines wanted, each once; no other line is read as words or moved."""
    of_docs = rows.join(_if_small(wanted.select("doc").distinct()), "doc", "left_semi")
    some = lines(of_docs).join(_if_small(wanted), ["doc", "line"], "left_semi")
    return some.select("doc", "line", word_hashes(F.col("value")).alias("k"))


def _beside(pairs: DataFrame, held: DataFrame, column: str) -> DataFrame:
    """The pairs with both lines' column, the earlier line's as ``<column>0``."""
    earlier = held.select(F.col("doc").alias("doc0"), F.col("line").alias("line0"), F.col(column).alias(f"{column}0"))
    return pairs.join(held, ["doc", "line"]).join(earlier, ["doc0", "line0"])


def _equal(rows: DataFrame, keep: Keep) -> DataFrame:
    """``doc, line`` of every line whose text, but for case and outer spaces, an earlier line has.

    Texts are compared by 128 bits of hash.  Counts and firsts are found before the shuffle, and the join has one row a text on
    its other side, so that a text that most rows share can be split.
    """
    low = F.trim(F.lower("value"))
    each = keep(lines(rows).select("doc", "line", F.xxhash64(low).alias("h"), F.xxhash64(F.lit(1), low).alias("g")))
    first = each.groupBy("h", "g").agg(F.min(F.struct("doc", "line")).alias("m"), F.count("*").alias("size")).where("size > 1")
    first = keep(first.select("h", "g", F.col("m.doc").alias("doc0"), F.col("m.line").alias("line0")))
    return each.join(_if_small(first), ["h", "g"]).where("doc != doc0 or line != line0").select("doc", "line")


def _verified(pairs: DataFrame, held: DataFrame, t: float) -> DataFrame:
    """``doc, line`` of the pairs whose Jaccard reaches t; held has the lines' words."""
    both = _beside(pairs, held, "k").withColumn("_s", F.size(F.array_intersect("k", "k0")))
    return both.where(F.col("_s") / (F.size("k") + F.size("k0") - F.col("_s")) >= t).select("doc", "line")


def _fine(k: Column, part: int) -> Column:
    """The parity of a set's words in 64 hash classes of 64 * FINE_PARTS."""
    here = F.filter(k, lambda w: F.shiftrightunsigned(w, 6).bitwiseAND(FINE_PARTS - 1) == part)
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("bigint"), w.bitwiseAND(63).cast("int"))
    return F.aggregate(here, F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseXOR(bit(w)))


def later_matches(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc, line`` of every line that matches an earlier one.

    Earlier is by ``doc_id``, then by place in the text; a line that is itself removed still counts as earlier.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"

    def keep(df: DataFrame) -> DataFrame:
        """The frame as a table in the shared folder, which takes less time and space than a checkpoint."""
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    try:
        with settings(spark, SETTINGS):
            return cut(_later_matches(docs, similarity, keep))
    finally:
        remove(spark, folder)


def _spokes(signed: DataFrame, similarity: float) -> DataFrame:
    """Two sorts of rows, from the signatures of several lines.

    Rows with ``doc0, line0, gap`` pair a line with one of the signature's first HUBS lines that stands before it and may match
    it; gap is the share of parity bits that differ.  Rows without name the lines of signatures of more lines (``sig, doc, line,
    about, odd, wide, size``); those of HUBS + 1 lines or fewer have nothing beyond their pairs.
    """
    order = Window.partitionBy("sig").orderBy("doc", "line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    several = signed.withColumn("size", F.count("*").over(Window.partitionBy("sig"))).where("size > 1").withColumn("v", F.struct(*ABOUT))
    hubs = several.select("sig", "v", "size", *[F.nth_value("v", k).over(order).alias(f"h{k}") for k in range(1, HUBS + 1)])
    beside = F.when(F.col("size") > HUBS + 1, F.array(F.lit(None), *[f"h{k}" for k in range(1, HUBS + 1)])).when(F.col("size") > 2, F.array(*[f"h{k}" for k in range(1, HUBS + 1)])).otherwise(F.array("h1"))
    own = {c: F.col(f"v.{c}") for c in ABOUT}
    hub = {c: F.col(f"h.{c}") for c in ABOUT}
    gap = F.bit_count(own["odd"].bitwiseXOR(hub["odd"])) / (F.shiftrightunsigned(own["about"], 16) + F.shiftrightunsigned(hub["about"], 16))
    rows = hubs.select("sig", "v", "size", F.explode(beside).alias("h")).where(F.col("h").isNull() | (_is_later(own, hub) & _may_match(similarity, own, hub)))
    return rows.select("sig", "v.*", "size", hub["doc"].alias("doc0"), hub["line"].alias("line0"), gap.alias("gap"))


def _renamed(rows: DataFrame) -> DataFrame:
    """Rows of signatures as the earlier lines of pairs."""
    return rows.select("sig", *[F.col(c).alias(f"{c}0") for c in ABOUT])


def _partners(open_lines: DataFrame, crowd: DataFrame, able: Column, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """The open lines' rows that an earlier row of their signature may match, and these earlier rows (``doc0, line0, ..``).

    Most lines of a signature only happen to share it.  A match passes the filters at each signature that both lines have, so
    every row of it is here; a row is one at most, however many it may match.
    """
    before = _renamed(crowd).withColumnRenamed("sig", "sig0")
    here = (F.col("sig") == F.col("sig0")) & able
    later = keep(open_lines.join(before, here, "left_semi"))
    return later, keep(before.join(later, here, "left_semi")).withColumnRenamed("sig0", "sig")


def _later_matches(docs: DataFrame, similarity: float, keep: Keep) -> DataFrame:
    spark = docs.sparkSession
    rows = numbered(docs)
    levels = rarity_levels(rows)
    same = keep(_equal(rows, keep))
    fresh = lines(rows).join(_if_small(same), ["doc", "line"], "left_anti")
    keyed = fresh.select("doc", "line", word_keys(F.col("value"), levels).alias("k"))
    # Signatures outnumber the documents by far, so they get more partitions than a small table has by setting.
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), LEAST_PARTITIONS)
    signed = signatures(keyed, similarity).repartition(partitions, "sig")
    spokes = keep(_spokes(signed, similarity))

    pairs = spokes.where("doc0 IS NOT NULL").select("doc", "line", "doc0", "line0", "gap")
    nearest = pairs.groupBy("doc", "line").agg(F.min(F.struct("gap", "doc0", "line0")).alias("m"))
    tried = keep(nearest.select("doc", "line", "m.doc0", "m.line0"))
    settled = keep(_verified(tried, keep(_words_of(keep(_both_of(tried).distinct()), rows)), similarity))

    # What is still open meets all lines before it.
    still = _if_small(settled)
    crowd = spokes.where("doc0 IS NULL").drop("doc0", "line0", "gap")
    open_lines = keep(crowd.join(still, ["doc", "line"], "left_anti"))
    able = _is_later(_own(), _own("0")) & _may_match(similarity, _own(), _own("0"))
    few = F.col("size") < CROWDED
    in_few = open_lines.where(few).join(_renamed(crowd.where(few)), "sig").where(able)

    names = ["doc", "line", "doc0", "line0"]
    single = keep(pairs.join(still, ["doc", "line"], "left_anti").select(*names).unionByName(in_few.select(*names)).distinct().join(tried, names, "left_anti"))

    later, earlier = _partners(open_lines.where(~few), crowd.where(~few), able, keep)
    least = later.select("doc", "line", "sig").unionByName(earlier.select(F.col("doc0").alias("doc"), F.col("line0").alias("line"), "sig"))
    least = keep(least.groupBy("doc", "line").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, LEAST_FEW).alias("least")))
    held = keep(_words_of(keep(_both_of(single).unionByName(least.select("doc", "line")).distinct()), rows))
    fine = [f"fine{k}" for k in range(FINE_PARTS)]
    told = keep(least.join(held, ["doc", "line"]).select("doc", "line", "least", *[_fine(F.col("k"), k).alias(c) for k, c in enumerate(fine)]))
    elsewhere = F.coalesce(F.array_min(F.array_intersect("least", "least0")) < F.col("sig"), F.lit(False))
    differing = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}0"))) for c in fine)
    n, m = (F.shiftrightunsigned(c, 16) for c in ("about", "about0"))
    apart = (differing > (n + m) * ((1 - similarity) / (1 + similarity)) + 1e-9) & (n < FULL) & (m < FULL)
    told0 = told.select(*[F.col(c).alias(f"{c}0") for c in told.columns])
    in_many = later.join(told, ["doc", "line"]).join(earlier.join(told0, ["doc0", "line0"]), "sig").where(able & ~elsewhere & ~apart)
    rest = keep(single.unionByName(in_many.select(*names)).distinct())
    found = keep(_verified(rest, held, similarity).distinct())
    return same.unionByName(settled).unionByName(found)


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, line_no`` of every line that matches an earlier one; line numbers from 0."""
    found = later_matches(docs, similarity)
    without_id = F.shiftright("line", NULL_BIT) == 1
    return found.select(F.when(~without_id, F.col("doc")).alias("doc_id"), F.col("line").bitwiseAND((1 << 32) - 1).alias("line_no"))


def drop_later_lines(docs: DataFrame, similarity: float = SIMILARITY, text_length: str | None = "n_chars") -> DataFrame:
    """All rows with the later matches taken out of their texts; lines without words stay.

    A row may end up with an empty text; null texts stay null.  The column named by ``text_length``, if there, follows the text.
    """
    found = later_matches(docs, similarity)
    gone = found.groupBy(F.col("doc").alias("_d"), F.shiftright("line", 32).alias("_n")).agg(F.collect_list(F.col("line").bitwiseAND((1 << 32) - 1).cast("int")).alias("_gone"))
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    placed = _placed(row, F.col("_row.doc_id").cast("bigint"), F.coalesce("_row.text", F.lit("")))
    small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # bounds the arrays' numbers too
    joined = placed.join(F.broadcast(gone) if small else gone, (F.col("doc") == F.col("_d")) & (F.col("nth") == F.col("_n")), "left")
    left = F.filter(F.split("_row.text", "\n"), lambda x, k: ~F.array_contains(F.col("_gone"), k))
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(F.array_join(left, "\n"))
    columns = []
    for c in names:
        value = text if c == "text" else F.when(F.col("_gone").isNull(), F.col("_row").getField(c)).otherwise(F.length(text).cast("bigint")) if c == text_length else F.col("_row").getField(c)
        columns.append(value.alias(c))
    return joined.select(*columns)
