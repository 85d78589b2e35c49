"""Operator 9, MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A text's set is its five-word shingles, each weighted by its count times its inverse document frequency.  Near copies count once in
these frequencies (or what the copies of a large group share would be common, and part them): of the texts that share a first, shorter
band key only the one of least name counts.  The weight is ln((N + SPREAD) / df) / ln(SPREAD) and 1 at most, with df of N such texts: shingles
of less than one text in SPREAD weigh alike, and a few texts hardly change a weight.  ``idf=False`` weighs by counts alone.

Each of 80 samples picks one shingle and level with chance proportional to weight; four samples make a band
key.  Texts that share a key are candidates: first against the key's hub
(its text that meets most others), then, outside the hub's class, against a second hub, at a cost in proportion to the key's
texts.  Where a key's texts still lie in several classes, pairs across classes are compared too, once each, unless what both
share with a hub rules a link out; that part can grow faster than the key's texts.  Only verified pairs join classes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oceanloom.llm import textnum
from oceanloom.llm.common import cut, id_and_text, remove, shared_folder, small_batches

SIMILARITY = 0.8
BANDS, ROWS = 20, 4
POOL_BITS = 12
PIECE = 2048
#: Shingles are common from one text in so many on; smoothing is by as many texts without them.
SPREAD = 1024
#: Bands of the first keys, under which near copies count once.
FIRST_BANDS = 5
#: Shingles and texts that are counted together in a task; candidates reach a quarter of the common share in such a block.
BLOCK_SHINGLES, BLOCK_TEXTS, LEEWAY = 1 << 22, 1 << 14, 4
#: Rows of a batch in which a block's counts are reported.
REPORT_ROWS = 1 << 16
#: For rounding of sums of weights.
SLACK = 1e-5
#: Rows of text names that may be broadcast; larger sides are shuffled.
BROADCAST_ROWS = 200_000


#: Ascending hashes of the common shingles, and their inverse document frequencies as shares of the largest.
Frequencies = tuple[np.ndarray, np.ndarray]
NONE_COMMON: Frequencies = (np.zeros(0, np.uint64), np.zeros(0, np.float32))


def weighted_set(text: str, common: Frequencies = NONE_COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Ascending shingle hashes and their weights: the counts, times the inverse document frequency of common ones."""
    shingles, tf = textnum.text_shingles(text)
    weights = tf.astype(np.float32)
    if len(common[0]) and len(shingles):
        at = np.minimum(np.searchsorted(common[0], shingles), len(common[0]) - 1)
        weights *= np.where(common[0][at] == shingles, common[1][at], np.float32(1))
    return shingles, weights


def shared_weight(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return float(np.minimum(a[1][x], b[1][y]).astype(np.float64).sum())


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima; 0 if a set is empty (equal texts are joined without it)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    least = shared_weight(a, b)
    return least / (float(a[1].astype(np.float64).sum()) + float(b[1].astype(np.float64).sum()) - least)


@lru_cache(2)
def _draws(samples: int, seed: int = 11) -> tuple[np.ndarray, ...]:
    """For each sample a pool of draws: r, beta, ln c - r (r and c from Gamma(2, 1), beta uniform), and the value at weight 1; and odd multipliers to choose from it.

    Shingles that choose the same draw at the same weight tie, and the least hash wins, for every text alike.
    """
    rng = np.random.default_rng(seed)
    shape = (samples, 1 << POOL_BITS)
    r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
    beta = rng.random(shape, np.float32)
    log_c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32) - r
    odd = rng.integers(1, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return r.ravel(), beta.ravel(), log_c.ravel(), (log_c + beta * r).ravel(), odd[:, None], (np.arange(samples, dtype=np.uint64) << np.uint64(POOL_BITS))[:, None]


def samples(shingles: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """n consistent weighted samples: hashes of the chosen (shingle, level).

    level = floor(ln w / r + beta); the shingle with the least ln c - r (level - beta + 1) is chosen, of equal ones the one of least
    hash.  At weight 1, which most shingles have, the level is 0 and the value a draw's own: it is looked up.
    """
    r_pool, beta_pool, log_c_pool, at_one, odd, start = _draws(n)
    best, chosen, at_level = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64), np.zeros(n, np.int64)
    rows, ones = np.arange(n), weights == 1
    for single, own in ((True, shingles[ones]), (False, shingles[~ones])):
        log_w = None if single else np.log(weights[~ones]).astype(np.float32)
        for at in range(0, len(own), PIECE):
            h = own[at : at + PIECE]
            place = h[None, :] * odd
            place >>= np.uint64(64 - POOL_BITS)
            place += start
            place = place.view(np.int64)
            if single:
                value = at_one.take(place, mode="clip")
                k = value.argmin(1)
                level = np.zeros(n, np.int64)
            else:
                r, beta = r_pool.take(place, mode="clip"), beta_pool.take(place, mode="clip")
                levels = np.floor(log_w[None, at : at + PIECE] / r + beta)
                value = log_c_pool.take(place, mode="clip") - (levels - beta) * r
                k = value.argmin(1)
                level = levels[rows, k].astype(np.int64)
            least = value[rows, k]
            better = (least < best) | ((least == best) & (h[k] < chosen))
            best, chosen, at_level = np.where(better, least, best), np.where(better, h[k], chosen), np.where(better, level, at_level)
    return textnum.mix(chosen ^ (at_level.view(np.uint64) * np.uint64(textnum.BASE)))


def band_keys(shingles: np.ndarray, weights: np.ndarray, bands: int, rows: int) -> np.ndarray:
    if not len(shingles):
        return np.zeros(0, np.int64)
    s = samples(shingles, weights, bands * rows).reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for k in range(rows):
        key = textnum.mix(key * np.uint64(textnum.BASE) + s[:, k])
    return key.view(np.int64)


def _signatures(docs: DataFrame, bands: int, rows: int, common: Frequencies = NONE_COMMON) -> DataFrame:
    """``doc_id, node, keys, weight``; a node is a text, named by its md5."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, keys, sums = [], [], []
            for text in b.column("text").to_pylist():
                s, w = weighted_set(text, common)
                nodes.append(hashlib.md5(text.encode()).hexdigest())
                keys.append(band_keys(s, w, bands, rows))
                sums.append(float(w.astype(np.float64).sum()))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "node": nodes, "keys": pa.array(keys, pa.list_(pa.int64())), "weight": pa.array(sums, pa.float64())})

    return docs.mapInArrow(each, "doc_id BIGINT, node STRING, keys ARRAY<BIGINT>, weight DOUBLE")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text`` of the nodes asked for, each once.  If they are few enough to broadcast, no other text moves."""
    few = nodes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    named = docs.select(F.md5("text").alias("node"), "text")
    return named.join(F.broadcast(nodes) if few else nodes, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def _counted_once(docs: DataFrame, rows: int) -> DataFrame:
    """``node`` of the texts that count in document frequencies: those that no text of lesser name shares a first key with."""
    nodes = cut(_signatures(docs, FIRST_BANDS, rows).groupBy("node").agg(F.first("keys").alias("keys")).where(F.size("keys") > 0))
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    led = keyed.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("size")).where("size > 1")
    return cut(nodes.select("node").join(keyed.join(led, "key").where("node != least").select("node").distinct(), "node", "left_anti"))


def frequent(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that stand there at least so often, ascending, and how often.  The hashes are sorted in place: ``np.unique`` with counts takes five times their memory."""
    hashes.sort()
    first = hashes[: max(0, len(hashes) - least + 1)]
    often = first[first == hashes[least - 1 :]]
    often = often[np.diff(often, prepend=~often[:1]) != 0]
    return often, np.searchsorted(hashes, often, "right") - np.searchsorted(hashes, often)


def likely_common(texts: Iterator[np.ndarray], share: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block of texts the shingles of more than one text in ``share``, and their counts; texts are arrays of distinct shingles.

    What remains goes with the last full block: in few texts each shingle would reach its share.  No more than two blocks are held, in one array.
    """
    held = np.empty(2 * BLOCK_SHINGLES + BLOCK_SHINGLES // 4, np.uint64)  # a block ends with a whole text
    full = full_texts = end = n = 0  # where the full block ends, and the one that is being filled
    for own in texts:
        if end + len(own) > len(held):
            held = np.concatenate([held[:end], np.empty(len(own) + BLOCK_SHINGLES, np.uint64)])
        held[end : end + len(own)] = own
        end, n = end + len(own), n + 1
        if end - full >= BLOCK_SHINGLES or n - full_texts >= BLOCK_TEXTS:
            if full_texts:
                yield frequent(held[:full], full_texts // share + 1)
                held[: end - full] = held[full:end]
                end, n = end - full, n - full_texts
            full, full_texts = end, n
    if n:
        yield frequent(held[:end], n // share + 1)


def common_shingles(docs: DataFrame, rows: int = ROWS, spread: int = SPREAD) -> Frequencies:
    """The shingles of more than (N + spread) / spread of the N texts that count, and their weights.

    A shingle that common reaches its share in some block of texts; blocks report those that reach a quarter of it, so that their
    sums miss less than a quarter of a common shingle's texts.  Tasks have at least a full block of texts, however
    the table is dealt out.  What this leaves, at most spread * 4/3 times
    a text's mean number of shingles, is counted exactly over all texts and goes to the driver and the tasks.
    """
    counting = _counted_once(docs, rows)
    n = counting.count()
    if not n:
        return NONE_COMMON
    spark, folder = docs.sparkSession, f"{shared_folder(docs.sparkSession)}/texts-{uuid.uuid4().hex}"
    out = "h BIGINT, df BIGINT"

    def rows_of(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "df"])

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (np.frombuffer(own, np.uint64) for b in batches for own in b.column("shingles").to_pylist())
        for hashes, counts in likely_common(texts, LEEWAY * spread):
            for at in range(0, len(hashes), REPORT_ROWS):
                yield rows_of(hashes[at : at + REPORT_ROWS], counts[at : at + REPORT_ROWS])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([textnum.text_shingles(t)[0].tobytes() for t in b.column("text").to_pylist()], pa.binary())], ["shingles"])

    def exactly(wanted: np.ndarray):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(len(wanted), np.int64)
            for b in batches:
                for own in b.column("shingles").to_pylist():
                    h = np.frombuffer(own, np.uint64)
                    at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                    counts[at[wanted[at] == h]] += 1
            yield rows_of(wanted[counts > 0], counts[counts > 0])

        return each

    try:
        _texts(docs, counting).select("text").mapInArrow(shingled, "shingles BINARY").write.option("compression", "none").parquet(folder)
        texts = spark.read.schema("shingles BINARY").parquet(folder)
        summed = texts.coalesce(max(1, n // BLOCK_TEXTS)).mapInArrow(likely, out).groupBy("h").agg(F.sum("df").alias("df"))
        wanted = summed.where(F.col("df") * (spread * LEEWAY) >= (LEEWAY - 1) * n).where("df > 1").select("h").toArrow()
        wanted = np.sort(wanted.column("h").to_numpy().view(np.uint64))
        if not len(wanted):
            return NONE_COMMON
        counted = texts.mapInArrow(exactly(wanted), out).groupBy("h").agg(F.sum("df").alias("df"))
        counted = counted.where(F.col("df") * spread > n + spread).toArrow()
    finally:
        remove(spark, folder)
    h, df = counted.column("h").to_numpy().view(np.uint64), counted.column("df").to_numpy()
    order = np.argsort(h)
    return h[order], (np.log((n + spread) / df[order]) / np.log(spread)).astype(np.float32)


def _measured(pairs: DataFrame, docs: DataFrame, similarity: float, common: Frequencies = NONE_COMMON) -> DataFrame:
    """``a, b, shared, similar`` of pairs of nodes: the weight they share, and whether their weighted Jaccard reaches the similarity."""
    texts = _texts(docs, cut(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()))
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, tuple] = ("", (np.zeros(0), np.zeros(0)))
        for batch in batches:
            shared, similar = [], []
            for b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b")), strict=True):
                if last[0] != b:
                    last = (b, weighted_set(text_b, common))
                own = weighted_set(text_a, common)
                shared.append(shared_weight(own, last[1]))
                similar.append(weighted_jaccard(own, last[1]) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.float64()), pa.array(similar, pa.bool_())], ["a", "b", "shared", "similar"])

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(each, "a STRING, b STRING, shared DOUBLE, similar BOOLEAN")


def _lone_mass(docs: DataFrame, nodes: DataFrame, common: Frequencies = NONE_COMMON) -> DataFrame:
    """``node, alone``: the weight of a node's shingles that no other of these nodes holds."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, text in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True):
                shingles, w = weighted_set(text, common)
                yield pa.RecordBatch.from_pydict({"h": pa.array(shingles.view(np.int64)), "node": pa.array([node] * len(shingles), pa.string()), "w": pa.array(w.astype(np.float64))})

    held = _texts(docs, nodes).mapInArrow(each, "h BIGINT, node STRING, w DOUBLE")
    return held.groupBy("h").agg(F.count("*").alias("n"), F.first("node").alias("node"), F.first("w").alias("w")).where("n = 1").groupBy("node").agg(F.sum("w").alias("alone"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of the nodes in ``edges(a, b)``; a component is named by its least node.

    Least labels spread over edges, with a jump to the label's own label in each round, so rounds grow with the logarithm of a
    chain's length; each round is written to the checkpoint folder.
    """
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        up = step.select(F.col("node").alias("c"), F.col("c").alias("cc"))
        step = cut(step.join(up, "c", "left").select("node", "old", F.least(F.col("c"), F.coalesce("cc", "c")).alias("component")))
        labels = step.select("node", "component")
        if step.where("old != component").limit(1).count() == 0:
            return labels


def _mixed(placed: DataFrame) -> DataFrame:
    """Keys whose nodes lie in more than one class."""
    return placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, idf: bool = True) -> DataFrame:
    """``doc_id, node, class_node, class_id`` of every row.

    Rows of one class are linked by texts of at least that weighted Jaccard similarity, or have equal texts; ``class_id`` is the
    least ``doc_id`` of the class (null if all its ids are null).  Texts of fewer than five words are one shingle; texts without
    words are in a class only with their equals.
    """
    small_batches(docs.sparkSession)
    own = id_and_text(docs)
    common = common_shingles(own, rows) if idf else NONE_COMMON
    signed = cut(_signatures(own, bands, rows, common))
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("keys").alias("keys"), F.first("weight").alias("weight"))
    keyed = cut(nodes.select("node", "weight", F.explode("keys").alias("key")))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = cut(keyed.join(sizes, "key"))
    central = met.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = met.join(central, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub"), F.col("hub.met").alias("hub_met"))
    spoked = cut(met.join(hubs, "key"))
    ordered = [F.greatest("node", "hub"), F.least("node", "hub")]
    measured = cut(_measured(cut(spoked.where("node != hub").select(ordered[0].alias("a"), ordered[1].alias("b")).distinct()), own, similarity, common))
    first = measured.where("similar").select("a", "b")
    found = components(first)

    # A key with texts outside its hub's class gets a second hub, the one of them that meets most others.
    placed = spoked.join(found, "node", "left").join(central, "node").select("node", "weight", "key", "hub", "met", F.coalesce("component", "node").alias("component"))
    outer = placed.join(placed.where("node = hub").select("key", F.col("component").alias("_c")), "key").where("component != _c")
    others = outer.groupBy("key").agg(F.max(F.struct("met", "node", "component")).alias("o")).select("key", F.col("o.node").alias("hub2"), F.col("o.component").alias("_c2"))
    pairs = placed.join(others, "key").where("component != _c2").select(F.greatest("node", "hub2").alias("a"), F.least("node", "hub2").alias("b")).distinct()
    more = cut(_measured(cut(pairs.join(measured, ["a", "b"], "left_anti")), own, similarity, common).where("similar").select("a", "b"))
    first = cut(first.unionByName(more))
    found = components(first)

    # Where a key's texts still lie in several classes, the pairs across classes are tested too, but for those whose weights rule
    # a link out.  Two texts share no more than the lesser of what each shares with a third text, and the lesser of what each has
    # beside that; there, shingles that no other open text holds don't count.  The third texts are the key's hub and, where both
    # texts have met the same, the hub that meets most others of all that a text has met.
    placed = spoked.join(found, "node", "left").select("node", "weight", "key", "hub", "hub_met", F.coalesce("component", "node").alias("component"))
    open_keys = cut(placed.join(_mixed(placed), "key", "left_semi"))
    lone = _lone_mass(own, cut(open_keys.select("node").distinct()), common)
    able = open_keys.join(lone, "node", "left").withColumn("common", F.col("weight") - F.coalesce("alone", F.lit(0.0)))
    able = able.where(F.col("common") >= (similarity - SLACK) * F.col("weight")).join(measured.select("a", "b", "shared").withColumnsRenamed({"a": "_a", "b": "_b"}), (ordered[0] == F.col("_a")) & (ordered[1] == F.col("_b")), "left")
    inside = F.when(F.col("node") == F.col("hub"), F.col("weight")).otherwise(F.col("shared"))
    able = cut(able.select("key", "node", "weight", "component", "hub", "hub_met", "common", inside.alias("inside")))
    marks = able.groupBy("node").agg(F.max(F.struct("hub_met", "hub", "inside")).alias("m")).select("node", F.col("m.hub").alias("mark"), F.col("m.inside").alias("mark_inside"))
    able = cut(able.join(_mixed(able), "key", "left_semi").join(marks, "node").join(nodes.select("node", "keys"), "node"))
    left, right = (able.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "weight", "component", "common", "inside", "mark", "mark_inside", "keys")]) for s in "ab")

    def may_link(shared: str) -> Column:
        beside = [F.greatest(F.col(f"common_{s}") - F.col(f"{shared}_{s}"), F.lit(0.0)) for s in "ab"]
        most = F.least(f"{shared}_a", f"{shared}_b") + F.least(*beside)
        return most * (1 + similarity) >= (similarity - SLACK) * (F.col("weight_a") + F.col("weight_b"))

    can_link = (F.col("component_a") > F.col("component_b")) & may_link("inside") & ((F.col("mark_a") != F.col("mark_b")) | may_link("mark_inside"))
    once = F.array_min(F.array_intersect("keys_a", "keys_b")) == left["key"]  # a pair is made at the least of its keys only
    across = left.join(right, (left["key"] == right["key"]) & can_link & once).select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()
    second = cut(_measured(cut(across.join(first, ["a", "b"], "left_anti")), own, similarity, common).where("similar").select("a", "b"))
    if second.limit(1).count():
        found = components(first.unionByName(second))

    named = nodes.select("node", "least_id").join(found, "node", "left").select("node", "least_id", F.coalesce("component", "node").alias("class_node"))
    ids = named.groupBy("class_node").agg(F.min("least_id").alias("class_id"))
    of_node = named.join(ids, "class_node").select("node", "class_node", "class_id")
    return signed.select("doc_id", "node").join(of_node, "node").select("doc_id", "node", "class_node", "class_id")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, idf: bool = True) -> DataFrame:
    """One row of each class stays: that of the least id (of repeated rows and equal ids one), all columns as they were."""
    kept = classes(docs, similarity, idf=idf).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    winners = kept.groupBy("class_node").agg(F.min(F.struct("doc_id", "node")).alias("w")).select(F.col("w.doc_id").alias("_w_id"), F.col("w.node").alias("_w_node"))
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_node"))
    joined = row.join(winners, F.col("_id").eqNullSafe(F.col("_w_id")) & (F.col("_node") == F.col("_w_node")), "left_semi")
    order = Window.partitionBy("_node", "_id").orderBy("_id")
    return joined.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").select("_row.*")
