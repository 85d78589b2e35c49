"""Fingerprints, licences, quality features and the pipeline, each against plain loops that share no code with them."""

import math
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from llm_cases import awkward_texts, syllables
from test_native_ops import removed_by_loop
from test_text_ops import documents, features_by_rules

from oceanloom.llm import fingerprints, licenses, quality, toxicity
from oceanloom.llm.registry import QUERIES

M64 = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


GEAR, DIGIT = {}, {}


def chunk_set(text):
    """Distinct (digest, length) of the chunks: the hash is rolled character by character, and cut points are met in order."""
    out, h, start = set(), 0, 0
    values = []
    for k, c in enumerate(text):
        if c not in GEAR:
            GEAR[c], DIGIT[c] = mixed(ord(c) + 7) >> 32, mixed(ord(c) + 1)
        values.append(GEAR[c])
        h = (h << 1) + GEAR[c]
        if k >= 16:
            h -= values[k - 16] << 16
        here = h & 0xFFFFFFFF
        size = k + 1 - start
        bits = 7 if size < 32 else 3
        if len(text) - start > 8 and size >= 8 and (here >> (32 - bits) == 0 or size == 128) or k + 1 == len(text):
            total, power = 0, 1
            for x in text[start : k + 1]:
                total = (total + DIGIT[x] * power) & M64
                power = (power * 0x9E3779B97F4A7C15) & M64
            out.add((mixed((total + size) & M64) >> 32, size))
            start = k + 1
    return out


def printed(found):
    return "".join(f"{d:08x}{n:02x}" for d, n in sorted(found))


def likeness(a, b):
    x, y = (sum(n for _, n in s) for s in (a, b))
    return sum(n for _, n in a & b) / min(x, y) if min(x, y) else float(max(x, y) == 0)


def test_fingerprints_query_equals_a_rolling_loop(spark, sf_dir):
    docs = sorted(documents(spark, sf_dir), reverse=True)
    got, known = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, sf_dir).collect()}, {}
    own = lambda t: known[t] if t in known else known.setdefault(t, chunk_set(t))
    for k, (i, t) in enumerate(docs):
        if len(t) > 20_000:
            continue  # the loop's time; one long text is compared below
        nxt = docs[(k + 1) % len(docs)][1]
        edited = own(t[: len(t) - len(t) // 3] + nxt[: len(t) // 3])
        r = got[i]
        assert (r.fingerprint, r.edited_fingerprint) == (printed(own(t)), printed(edited))
        assert abs(r.near_edited - likeness(own(t), edited)) < 1e-9
        assert len(nxt) > 20_000 or abs(r.near_next - likeness(own(t), own(nxt))) < 1e-9


def test_fingerprints_of_odd_texts_equal_a_rolling_loop():
    for text in [t for t in awkward_texts() if t] + ["a" * 5000, "ab" * 999, "\U0001f600é\n" * 500]:
        assert fingerprints.as_text(fingerprints.fingerprint(text)) == printed(chunk_set(text))


def licence_words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def test_licences_query_equals_a_search_of_all_places(spark, sf_dir):
    docs = [(i, licence_words(t)) for i, t in documents(spark, sf_dir)]
    templates = [(label, licence_words(text), [licence_words(p) for p in phrases]) for label, text, phrases in licenses.TEMPLATES]
    known = {w for _, t, ps in templates for x in (t, *ps) for w in x}
    df = Counter(w for _, ws in docs for w in set(ws) & known)
    idf = {w: math.log1p(len(docs) / max(df[w], 0.5)) for w in known}
    got = {r.doc_id: r for r in QUERIES["op10_licenses"](spark, sf_dir).collect()}
    found_any = 0
    for i, ws in docs:
        labels, best = set(), 0.0
        if not known.isdisjoint(ws):
            for label, own, phrases in templates:
                total, starts = sum(idf[w] for w in own), set()
                for p, w in enumerate(ws):
                    if w in idf:
                        starts |= {p - q + d for q, x in enumerate(own) if x == w for d in range(-2, 3)}
                for s in starts:
                    covered = sum(idf[w] for q, w in enumerate(own) if w in ws[max(s + q - 2, 0) : max(s + q + 3, 0)]) / total
                    best = max(best, covered)
                    if covered >= 0.8 - 1e-9:
                        window = ws[max(s - 2, 0) : s + len(own) + 2]
                        if all(any(window[k : k + len(p)] == p for k in range(len(window))) for p in phrases):
                            labels.add(label)
        r = got[i]
        base = {x for x in r.base_labels.split(",") if x}
        assert {x for x in r.labels.split(",") if x} == labels | base, (i, r.labels, labels)
        if best >= 0.8:
            assert abs(r.score - min(best, 1.0)) < 1e-6
        else:
            assert r.score <= max(best, 0.5 if base else 0.0) + 1e-6
        found_any += bool(labels)
    assert found_any


def plain_features(text):
    """Character triples and words hashed one by one."""
    out = [0.0] * 4096
    for k in range(len(text) - 2):
        a, b, c = map(ord, text[k : k + 3])
        out[mixed((a + b * 0x110000 + c * (0x110000 * 0x110000 & M64)) & M64) >> 53] += 1 / max(len(text), 1)
    words = re.findall(r"[^\W_]+", text.lower())
    n = max(len(words), 1)
    hashes = []
    for w in words:
        total, power = 0, 1
        for x in w:
            total = (total + mixed(ord(x) + 1) * power) & M64
            power = (power * 0x9E3779B97F4A7C15) & M64
        hashes.append(mixed((total + len(w)) & M64))
    for h in hashes:
        out[2048 + (h >> 54)] += 1 / n
    out[4095] += sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    out[4094] += min(len(set(words)) / n, 1.0)
    out[4093 - min(int(math.log2(n + 1)), 12)] += 0.5
    out = [math.sqrt(x) for x in out]
    return np.array(out) / math.sqrt(sum(x * x for x in out))


def test_quality_features_equal_a_loop_up_to_the_names_of_words():
    """Which place a hash names is the operator's own; triples below, flags above and the multiset of word shares must agree."""
    rng = random.Random(5)
    for text in ["one two two three", syllables(rng, 200), "Émile été 你好 clef clef", "x", *[t for t in awkward_texts()[5:9] if t]]:
        a, b = quality.features(text), plain_features(text)
        assert np.allclose(a[:2048], b[:2048], atol=1e-5) and np.allclose(np.sort(a[2048:]), np.sort(b[2048:]), atol=1e-5)


def shingle_counts(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return Counter(tuple(words[k : k + min(5, len(words))]) for k in range(len(words) - min(5, len(words)) + 1)) if words else Counter()


def test_pipeline_equals_loops(spark, tmp_path):
    """Every stage over what the one before kept: rules for toxicity, loops for lines and pairs, sets for leaks, the tokenizer for pieces."""
    rng = random.Random(21)
    texts = [syllables(rng, rng.randint(30, 90)) for _ in range(60)]
    insult = "zargblof"
    shared = [syllables(rng, 9) for _ in range(6)]
    texts = [t if k % 3 else t[:150] + "\n" + shared[k % 6] + "\n" + (shared[(k + 1) % 6] if k % 2 else "own end") for k, t in enumerate(texts)]
    for k in range(24):
        texts[k] += f" you {insult} thing."
    items = [syllables(rng, 30) for _ in range(4)]
    texts += [f"{syllables(rng, 40)} {items[0].upper()} {syllables(rng, 5)}", f"{items[1]}", f"{syllables(rng, 20)} {items[2][:60]}"]
    near = syllables(rng, 150).split()
    texts += [" ".join(near), " ".join(near[:140] + ["changed"] * 3 + near[143:]), " ".join(["start", *near]), " ".join(near), "", "   ", "short one"]
    docs = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)] + [(500, None, None, None, None)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    folder = str(tmp_path)
    spark.createDataFrame(docs, schema).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k < 24)) for k in range(60)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")

    frame, kept = spark.read.parquet(f"{folder}/documents.parquet"), {d: t for d, t, *_ in docs}
    scorer = toxicity.train(frame, spark.read.parquet(f"{folder}/labels.parquet"))
    chance = lambda t: 1 / (1 + math.exp(-(scorer.coefficients[0] + float(np.dot(features_by_rules(t or "", scorer.lexicon), scorer.coefficients[1:])))))
    kept = {d: t for d, t in kept.items() if chance(t) < 0.5}
    assert not any(insult in (t or "") for t in kept.values()) and len(kept) == len(docs) - 24
    gone = removed_by_loop(sorted(kept.items()))
    kept = {d: t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in kept.items()}
    assert gone
    ids, sets = sorted(kept), {d: shingle_counts(kept[d] or "") for d in kept}
    group = {d: d for d in ids}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for x, a in enumerate(ids):
        for b in ids[:x]:
            least, most = sum((sets[a] & sets[b]).values()), sum((sets[a] | sets[b]).values())
            if (kept[a] or "") == (kept[b] or "") or (most and least / most >= 0.8):
                ra, rb = root(a), root(b)
                group[max(ra, rb)] = min(ra, rb)
    kept = {d: t for d, t in kept.items() if root(d) == d}
    grams = [set(shingle_counts(t)) for t in items]
    kept = {d: t for d, t in kept.items() if not any(len(g & set(shingle_counts(t or ""))) >= 0.8 * len(g) for g in grams)}
    assert 60 not in kept and 61 not in kept and 62 in kept
    from tokenizers import Tokenizer

    exact, docs_of = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    rows = corpus_pipeline.run(spark, folder).collect()
    for r in rows:
        docs_of.setdefault(r.doc_id, []).append(r)
    assert set(docs_of) == set(kept)
    for d, pieces in docs_of.items():
        n = len(exact.encode(kept[d] or "", add_special_tokens=False).ids) + 1
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, n)
            at += r.length
        assert at == n
