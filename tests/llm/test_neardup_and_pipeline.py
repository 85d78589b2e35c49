"""Near duplicates against exact weighted Jaccard over all pairs; the pipeline stage by stage."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
from llm_cases import awkward, empty, syllables

import corpus_pipeline
from oceanloom.llm import decontaminate, linededup, neardup, textnum
from oceanloom.llm.registry import QUERIES


def partition(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def families(seed=2):
    """Texts in families of near copies, some in chains, and texts that share one long passage only."""
    rng = random.Random(seed)
    docs, passage = [], syllables(rng, 60)
    for _ in range(12):
        words = syllables(rng, 150).split()
        for _ in range(rng.randint(1, 9)):
            docs.append(" ".join(words))
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = syllables(rng, 1)
    docs += [f"{syllables(rng, 90)} {passage} {syllables(rng, 90)}" for _ in range(25)]
    return list(enumerate(docs))


def common_by_loops(docs, spread=neardup.SPREAD):
    """Weights of the common shingles, counted text after text; of texts that share a first key the one of least name counts."""
    keys = {}
    for text in {t for _, t in docs}:
        if (own := neardup.weighted_set(text))[0].size:
            keys[hashlib.md5(text.encode()).hexdigest()] = text, set(neardup.band_keys(*own, neardup.FIRST_BANDS, neardup.ROWS).tolist())
    counting = [t for name, (t, k) in keys.items() if not any(other < name and k & theirs for other, (_, theirs) in keys.items())]
    df = Counter(h for t in counting for h in textnum.text_shingles(t)[0].tolist())
    n = len(counting)
    return {h: math.log((n + spread) / c) / math.log(spread) for h, c in df.items() if c > (n + spread) / spread}


def classes_by_all_pairs(docs, common, similarity=0.8):
    bags = [(i, t, {h: c * common.get(h, 1.0) for h, c in zip(*(x.tolist() for x in textnum.text_shingles(t)), strict=True)}) for i, t in docs]

    def alike(a, b):
        least = sum(min(w, b[h]) for h, w in a.items() if h in b)
        return least > 0 and least / (sum(a.values()) + sum(b.values()) - least) >= similarity - 1e-9

    links = [(i, j) for (i, t, a), (j, u, b) in itertools.combinations(bags, 2) if t == u or alike(a, b)]
    return partition(links, [i for i, _ in docs])


def test_classes_equal_all_pairs(spark):
    docs = families()
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    common = common_by_loops(docs)
    assert len(common) > 50  # the passage that 25 texts share
    assert {r.doc_id: r.class_id for r in neardup.classes(df).collect()} == classes_by_all_pairs(docs, common)
    assert {r.doc_id: r.class_id for r in neardup.classes(df, idf=False).collect()} == classes_by_all_pairs(docs, {})


def test_near_copies_count_once_and_passages_are_common(spark):
    """A passage in a third of the texts weighs less; what 120 near copies of one text share weighs as much as anything rare."""
    rng = random.Random(5)
    passage, base = syllables(rng, 50), syllables(rng, 200).split()
    texts = [f"{syllables(rng, 60)} {passage}" for _ in range(100)] + [syllables(rng, 90) for _ in range(200)]
    for k in range(120):
        words = list(base)
        words[(k * 7) % 200] = syllables(rng, 1)
        texts.append(" ".join(words))
    docs = list(enumerate(texts)) + [(1000 + k, texts[0]) for k in range(50)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(7)
    for spread in (4, 16, neardup.SPREAD):
        h, w = neardup.common_shingles(df, spread=spread)
        want = common_by_loops(docs, spread)
        assert h.tolist() == sorted(want) and np.allclose(w, [want[x] for x in sorted(want)], atol=1e-6)
        passage_set, base_set = (set(textnum.text_shingles(t)[0].tolist()) for t in (passage, " ".join(base)))
        assert passage_set <= set(want)
        if spread == 4:
            assert not base_set & set(want)
    _, got = neardup.weighted_set(passage, (h, w))
    assert (got < 0.7).all()
    assert neardup.common_shingles(empty(spark).select("doc_id", "text"))[0].size == 0


def test_similarity_is_that_of_counted_shingles():
    rng = random.Random(8)
    words = syllables(rng, 120).split()
    texts = " ".join(words + words[:30]), " ".join(words[:100] + syllables(rng, 20).split())
    bags = [Counter(zip(*(t.lower().split()[k:] for k in range(5)), strict=False)) for t in texts]
    want = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    assert abs(neardup.weighted_jaccard(*map(neardup.weighted_set, texts)) - want) < 1e-6


def test_samples_equal_the_formula():
    """The least ln c - r (floor(ln w / r + beta) - beta + 1), one shingle after the other."""
    rng = np.random.default_rng(6)
    h = np.sort(textnum.mix(np.arange(5000, dtype=np.uint64)))
    w = np.where(rng.random(5000) < 0.8, 1, rng.integers(2, 9, 5000)).astype(np.float32)
    got = neardup.samples(h, w, 12)
    r, beta, log_c_less_r, _, odd, start = neardup._draws(12)
    for k in range(12):
        best = None
        for x, weight in zip(h, w, strict=True):
            at = int(((x * odd[k, 0]) >> np.uint64(64 - neardup.POOL_BITS)) + start[k, 0])
            level = np.floor(np.log(weight) / r[at] + beta[at])
            value = log_c_less_r[at] - (level - beta[at]) * r[at]
            if best is None or value < best[0]:
                best = (value, x, int(level))
        assert got[k] == textnum.mix(np.array([best[1] ^ np.uint64(best[2] * textnum.BASE % (1 << 64))]))[0]


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op9_neardup"](spark, sf).collect()}
    assert got == classes_by_all_pairs(docs, common_by_loops(docs))


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(0)
    h = textnum.mix(np.arange(400, dtype=np.uint64))
    w = rng.uniform(1, 4, 400).astype(np.float32)
    a, b = (h[:300], w[:300]), (h[60:], w[60:])
    agree = np.mean(neardup.samples(*a, 2000) == neardup.samples(*b, 2000))
    assert abs(agree - neardup.weighted_jaccard(a, b)) < 0.04


def test_pairs_at_the_threshold_share_a_band():
    missed = 0
    for k in range(1500):
        h = textnum.mix(np.arange(k * 200, k * 200 + 180, dtype=np.uint64))
        a, b = (np.sort(x) for x in (h[:160], np.concatenate([h[20:160], h[160:175]])))  # 140 of 175 shingles: 0.8
        keys = [neardup.band_keys(x, np.ones(len(x), np.float32), neardup.BANDS, neardup.ROWS) for x in (a, b)]
        missed += not len(np.intersect1d(*keys))
    assert missed == 0


def test_components_of_chains_and_stars(spark):
    edges = [(f"{k:03}", f"{k + 1:03}") for k in range(40)] + [("x00", f"x{k:02}") for k in range(1, 30)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(edges, "a STRING, b STRING")).collect()}
    assert set(got.values()) == {"000", "x00"} and len(got) == 71


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = neardup.classes(df).collect()
    assert len(rows) == df.count()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.node, (r.class_node, r.class_id)) == (r.class_node, r.class_id)
    texts = {r.doc_id: r.text or "" for r in df.where("doc_id < 6 OR doc_id > 6").collect()}
    same = {r.doc_id: r.class_id for r in rows if r.doc_id in texts}
    assert all(same[a] == same[b] for a in texts for b in texts if texts[a] == texts[b])
    assert same[11] == same[12] and same[3] == 3  # a long text and the same with one word more; one word alone
    out = neardup.drop_near_duplicates(df)
    assert out.columns == df.columns and out.count() == len({r.class_node for r in rows})
    assert neardup.drop_near_duplicates(empty(spark)).count() == 0


def test_stages_do_what_they_say(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, docs = [n for n, _ in corpus_pipeline.STAGES], documents
    assert names == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir).persist()
        assert after.columns == documents.columns and after.dtypes == documents.dtypes
        seen[name] = ({r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in after.collect()})
        docs = after
    toxic = {r.doc_id for r in QUERIES["op2_toxicity"](spark, sf_dir).where("predicted = 1").collect()}
    before, after = seen["toxicity"]
    assert set(before) - set(after) == toxic
    before, after = seen["line dedup"]
    frame = spark.createDataFrame(sorted(before.items()), "doc_id BIGINT, text STRING")
    gone = {(r.doc_id, r.line_no) for r in linededup.removed_lines(frame).collect()}
    assert after == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in before.items()}
    before, after = seen["MinHash near-dedup"]
    frame = spark.createDataFrame(sorted(before.items()), "doc_id BIGINT, text STRING")
    assert set(after) == {r.class_id for r in neardup.classes(frame).collect()}
    before, after = seen["benchmark decontamination"]
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    frame = spark.createDataFrame(sorted(before.items()), "doc_id BIGINT, text STRING")
    assert set(before) - set(after) == {r.doc_id for r in decontaminate.leaks(frame, items).collect()}


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 < r.length <= 1024 for r in rows)


def test_stages_on_awkward_rows(spark, sf_dir):
    for start in (awkward(spark), empty(spark)):
        docs = start.select("doc_id", "text", "lang", "source", "n_chars")
        sizes = [docs.count()]
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            docs = spark.createDataFrame(out.collect(), out.schema) if name != "packing" else out
            sizes.append(docs.count())
        assert sizes[0] == sizes[1] == sizes[2] > sizes[3] >= sizes[4] > 0 if sizes[0] else not any(sizes)


def test_only_this_subpackage_names_itself():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent / "oceanloom"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and re.search(r"oceanloom[. ]llm|import llm", p.read_text())]
