"""Candidates for common shingles don't grow with the number of partitions."""

import tracemalloc

import numpy as np

from oceanloom.llm import neardup


def test_few_texts_in_many_partitions_are_one_block(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 40), k -> substr(sha2(concat(id, '-', k), 256), 1, 8))) AS text").repartition(60)
    parts, plain = [], type(docs).mapInArrow

    def watched(self, func, *rest, **more):
        if func.__name__ == "likely":
            parts.append(self.rdd.getNumPartitions())
        return plain(self, func, *rest, **more)

    monkeypatch.setattr(type(docs), "mapInArrow", watched)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    neardup.common_shingles(neardup.id_and_text(docs))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts == [1]


def test_blocks_are_counted_in_little_more_than_their_own_memory(monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 1 << 18)
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 1 << 63, 4000, dtype=np.uint64)
    texts = [np.unique(np.concatenate([rng.integers(1, 1 << 63, 300, dtype=np.uint64), rng.choice(pool, 60)])) for _ in range(1800)]
    texts[5:5] = [np.zeros(0, np.uint64), rng.integers(1, 1 << 63, 1 << 20, dtype=np.uint64)]  # one without shingles, one larger than two blocks

    def by_unique(own, share):  # as it was: ended blocks, the last full one with what remains
        blocks, block, held = [], [], 0
        for x in own:
            block.append(x)
            held += len(x)
            if held >= neardup.BLOCK_SHINGLES:
                blocks, block, held = [*blocks, block], [], 0
        for b in [*blocks[:-1], [*blocks[-1], *block]]:
            h, n = np.unique(np.concatenate(b), return_counts=True)
            yield h[n * share > len(b)], n[n * share > len(b)]

    expected = list(by_unique(texts, 200))
    assert len(expected) > 1
    assert [(h.tolist(), n.tolist()) for h, n in neardup.likely_common(iter(texts), 200)] == [(h.tolist(), n.tolist()) for h, n in expected]
    plain = [t for t in texts if len(t) < 1000]
    tracemalloc.start()
    list(neardup.likely_common(iter(plain), 200))
    ours = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    list(by_unique(plain, 200))
    before = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ours < 2 * (2 * neardup.BLOCK_SHINGLES * 8) < before / 1.5
