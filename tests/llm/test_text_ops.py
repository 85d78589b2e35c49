"""Fingerprints, toxicity, quality, packing and licences against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import awkward, awkward_texts, empty, syllables

from oceanloom.llm import fingerprints, licenses, packing, quality, textnum, toxicity
from oceanloom.llm.registry import QUERIES
from oceanloom.llm.tokens import byte_encoder

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def documents(spark, sf_dir):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def test_word_hashes_agree_with_words_and_blocks(monkeypatch):
    text = " ".join(t for t in awkward_texts()[5:12] if t)
    words = re.findall(r"[^\W_]+", text.lower())
    whole = textnum.word_hashes(text)
    names = {}
    assert len(whole) == len(words) and all(names.setdefault(w, h) == h for w, h in zip(words, whole.tolist(), strict=True)) and len(set(names.values())) == len(names)
    monkeypatch.setattr(textnum, "BLOCK", 64)
    assert (textnum.word_hashes(text) == whole).all()


def test_fingerprints_query_on_all_rows(spark, sf_dir):
    docs = sorted(documents(spark, sf_dir), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    prints = {}
    for k, (i, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and 0 <= min(r.near_edited, r.near_next) and max(r.near_edited, r.near_next) <= 1
    long = [r for r in got.values() if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.98


def test_chunks_join_and_survive_a_shift():
    text = awkward_texts()[11]
    assert "".join(fingerprints.chunks(text)) == text
    moved = "inserted at the start " + text
    a, b = fingerprints.fingerprint(text), fingerprints.fingerprint(moved)
    assert fingerprints.likeness(a, b) > 0.99
    assert (fingerprints.from_text(fingerprints.as_text(a)) == a).all()
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint("")) == 1.0


@pytest.mark.parametrize("block", [130, 256, 1000])
def test_chunks_do_not_depend_on_blocks(monkeypatch, block):
    text = awkward_texts()[11][:20_000] + "aaaaaaaa" * 300 + awkward_texts()[6]
    ends, print_ = fingerprints.cut_points(textnum.codepoints(text)), fingerprints.fingerprint(text)
    monkeypatch.setattr(textnum, "BLOCK", block)
    assert (fingerprints.cut_points(textnum.codepoints(text)) == ends).all() and (fingerprints.fingerprint(text) == print_).all()
    assert fingerprints.likeness(print_, fingerprints.fingerprint("shifted by this " + text)) > 0.98


def test_a_text_longer_than_a_block_is_like_its_shifted_self():
    long = awkward_texts()[11]
    text = (long + "\n") * (textnum.BLOCK // len(long) + 1) + "an end of its own"
    assert len(text) > textnum.BLOCK and "".join(fingerprints.chunks(text)) == text
    a, b = (fingerprints.fingerprint(t) for t in (text, "put before " + text))
    assert fingerprints.likeness(a, b) > 0.99


def test_likeness_equals_sets_of_chunks():
    """By the chunks' texts: the length of distinct chunks that both hold, over that of the smaller text's."""
    rng = random.Random(7)
    for _ in range(30):
        a = syllables(rng, rng.randint(0, 300))
        b = a[rng.randint(0, len(a)) :] + syllables(rng, rng.randint(0, 100))
        x, y = (set(fingerprints.chunks(t)) for t in (a, b))
        size = [sum(map(len, s)) for s in (x, y)]
        want = sum(map(len, x & y)) / min(size) if min(size) else float(max(size) == 0)
        assert abs(fingerprints.likeness(fingerprints.fingerprint(a), fingerprints.fingerprint(b)) - want) < 1e-9


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints_of_awkward_rows(spark, ranges):
    df = awkward(spark)
    rows = fingerprints.compare_edited(df, ranges).collect()
    assert len(rows) == df.count() and all(r.edited_sha256 for r in rows)
    assert fingerprints.fingerprints(df).count() == df.count()
    assert fingerprints.compare_edited(empty(spark)).count() == 0 == fingerprints.fingerprints(empty(spark)).count()
    alone = fingerprints.compare_edited(df.where("doc_id = 12")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_composed_grammar():
    m = toxicity.grammar()

    def read(*symbols):
        q, out = 0, []
        for a in symbols:
            q, b, w = m.step[q][a]
            out.append((b, w))
        return out[-1]

    I, T, N, R, O = toxicity.INSULT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.OTHER  # noqa: E741
    assert read(O, I) == (I, 0.0)
    assert read(T, O, I) == (I, toxicity.AIMED)
    assert read(N, O, I) == (N, toxicity.NEGATED)
    assert read(N, O, O, O, I) == (I, 0.0)
    assert read(R, O, I) == (R, toxicity.REPORTED)
    assert read(T, toxicity.THREAT) == (I, toxicity.AT_A_THREAT + toxicity.AIMED)


def test_toxicity_held_out_accuracy_and_fold(spark, sf_dir):
    got = QUERIES["op2_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in test]) > 0.95
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_toxicity_scores_stems_and_discounts():
    s = toxicity.Scorer({"zarg": 4.0, "blof*": 3.0}, [-3.0, 2.0, 2.5, 1.0, 0.5, 0.1, 0.1, 0.1, 0.1])
    plain, aimed, negated, reported = (s.score(t) for t in ("it is zarg here.", "you blofish thing.", "this is not zarg.", "he said zarg."))
    assert min(plain, aimed) > 0.5 > s.score("nothing of it. blo zargon.") and plain > negated and plain > reported
    assert s.score("") == s.score("clean words only")


def test_an_aimed_threat_counts_without_a_learned_word(spark):
    threats = ["I will kill you", "Ich werde dich umbringen.", "tomorrow they will shoot all of them"]
    discounted = ["I will not kill you", "he said he would kill you"]
    fine = ["kill the process", "to shoot a long film before noon with you", "clean words only", "you and him"]
    s = toxicity.Scorer({"zarg": 4.0}, [-3.0, *[1.0] * toxicity.FEATURES])
    assert min(map(s.score, threats)) > 0.5 and {s.score(t) for t in fine} == {s.score("")}
    assert s.features("I will not kill you")[toxicity.NEG] > 0 and s.features("he said he would kill you")[toxicity.REP] > 0
    assert s.features("I will not kill you")[toxicity.AIM] == s.features("he said he would kill you")[toxicity.AIM] == 0
    learned = toxicity.Scorer({"kill": 9.0})
    assert learned.features("kill you").tolist() == learned.features("you kill").tolist() and learned.features("kill it")[toxicity.PLAIN] == np.log1p(9.0)
    rows = [(k, f"{syllables(random.Random(k), 20)} {'it is zarg' if k % 3 == 0 else 'it is'}") for k in range(120)] + list(enumerate(threats + fine + discounted, 1000))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)], "doc_id BIGINT, toxic INT")
    assert {r.text for r in toxicity.reject_toxic(df, labels).where("doc_id >= 1000").collect()} == {*fine, *discounted}
    assert {r.text for r in toxicity.reject_toxic(df, labels.where("false")).where("doc_id >= 1000").collect()} >= set(fine)
    assert not {r.text for r in toxicity.reject_toxic(df, labels.where("false")).collect()} & set(threats)


def test_inflected_threats_and_targets_after_insults():
    """Scores by the prior alone; a learned lexicon only adds to them."""
    s = toxicity.Scorer({"clown": 6.0, "zarg*": 5.0}, list(toxicity.PRIOR))
    clean = s.score("clean words only")
    for t in ("I will kill you", "I am killing you", "you will be killed", "je vous tuerai", "I will hurt you", "we will burn your house down", "te mataremos mañana", "ihr werdet erschossen", "je te brûlerai"):
        assert s.score(t) > 0.5 > clean, t
    for t in ("the fire burned the house", "she was killed in 1945", "it hurts", "burning wood", "he said you will be killed", "you will not be killed"):
        assert s.score(t) < 0.5, t
    assert {s.score(t) for t in ("she was killed in 1945", "burning wood", "the fire burned the house")} == {clean}
    assert s.score("clown you") == s.score("clown, all of you") == s.score("you clown") > s.score("a clown") > clean
    assert s.score("clown and then a lot of words before you") == s.score("a clown")
    assert s.features("kill you clown").argmax() == toxicity.AIM and s.score("you are not a clown") >= clean


def test_weights_of_sorts_keep_their_order():
    """Labels that contradict the grammar: negated and reported clauses in toxic texts only, plain ones in clean texts too."""
    rng = np.random.default_rng(7)
    for trial in range(20):
        x = rng.exponential(size=(200, toxicity.FEATURES)) * (rng.random((200, toxicity.FEATURES)) < 0.3)
        y = (rng.random(200) < 1 / (1 + np.exp(-x @ rng.normal(size=toxicity.FEATURES) * 2))).astype(float)
        w = toxicity.fit_sorts(x, y)
        for part in (1, 5):
            plain, aimed, negated, reported = w[part : part + 4]
            assert min(plain, aimed - plain, negated, reported) >= -1e-9 and max(negated, reported) <= max(toxicity.DISCOUNTED * plain, 0) + 1e-9, w
    free = toxicity.fit_logistic(np.zeros((50, toxicity.FEATURES)), np.array([0.0, 1.0] * 25), toxicity.PRIOR)
    assert np.allclose(free[1:], toxicity.PRIOR[1:]) and abs(free[0]) < 1e-3


def features_by_rules(text, lexicon):
    """The grammar's sums clause by clause, each transducer's rule said in words: no automaton, no search for entries."""
    def entry(word):
        return max([lexicon.get(word, 0.0), *(lexicon.get(f"{word[:n]}*", 0.0) for n in toxicity.STEM_LENGTHS if len(word) > n)])

    total = [0.0] * 8
    for clause in re.split(r"[.!?;\n]+", text.lower()):
        words = toxicity._WORD.findall(clause)
        addressed = any(w in toxicity.SECOND_PERSON for w in words)
        kinds = ["threat" if w in toxicity.THREAT_WORDS or (addressed and w in toxicity.THREAT_FORMS) else "insult" if entry(w) > 0 else "target" if w in toxicity.TARGET_WORDS else "negation" if w in toxicity.NEGATION_WORDS
                 else "report" if w in toxicity.REPORT_WORDS or w in "\"«»„“”" else "other" for w in words]
        score, matched, aimed, negated, reported = 0.0, False, False, False, False
        for k, (word, kind) in enumerate(zip(words, kinds, strict=True)):
            if kind not in ("insult", "threat"):
                continue
            before = kinds[:k]
            at, own, target_after = "target" in before, entry(word), False
            if kind == "threat" and not at:
                ahead = kinds[k + 1 : k + 2 + toxicity.THREAT_REACH]
                until = [a for a in ahead if a in ("threat", "target")][:1]
                target_after = until == ["target"]
            if kind == "threat" and (at or target_after):
                own = max(own, toxicity.OF_A_THREAT)
            if own <= 0:
                continue
            if kind == "insult" and not at:
                # The next word of abuse within reach would take the target, and a threat that waits for it takes it for both.
                ahead = kinds[k + 1 : k + 2 + toxicity.INSULT_REACH]
                until = next((d for d, a in enumerate(ahead) if a in ("insult", "threat", "target")), None)
                if until is not None and ahead[until] == "target":
                    place = k + 1 + until
                    taken = any(kinds[q] == "threat" and place - q - 1 <= toxicity.THREAT_REACH and "threat" not in kinds[q + 1 : place] for q in range(k))
                    score, aimed = score + (0.0 if taken else toxicity.AIMED), True
            near = next((d for d, a in enumerate(reversed(before)) if a == "negation"), None)
            hits = sum(a in ("target", "report", "other", "threat", "insult") for a in before[len(before) - (near or 0) :]) if near is not None else 99
            is_negated = near is not None and hits < toxicity.NEGATION_REACH
            is_reported = not is_negated and "report" in before
            weight = own + (toxicity.NEGATED if is_negated else 0.0) + (toxicity.REPORTED if is_reported else 0.0)
            weight += toxicity.AT_A_THREAT if kind == "threat" and (at or target_after) else 0.0
            weight += toxicity.AIMED if at or target_after else 0.0
            score, matched = score + weight, True
            aimed, negated, reported = aimed or at or target_after, negated or is_negated, reported or is_reported
        if matched:
            sort = toxicity.REP if reported else toxicity.NEG if negated else toxicity.AIM if aimed else toxicity.PLAIN
            total[sort] += max(score, 0.0)
            total[4 + sort] += 1
    return np.log1p(total)


def test_toxicity_features_equal_the_rules_on_all_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.train(docs, labels)
    texts = [t for _, t in documents(spark, sf_dir)]
    some = sorted(scorer.lexicon)[:3]
    texts += [f"{a} {b} {c}." for a in ("you", "not", "he said", "the") for b in (*(e.rstrip("*") for e in some), "kill", "word", "killed", "burn") for c in ("you", "kill them", "it all now", "", "and then you", f"{some[0].rstrip('*')} of you", "burning your house")]
    different = [t for t in texts if not np.allclose(scorer.features(t), features_by_rules(t, scorer.lexicon))]
    assert not different, different[:3]


def test_toxicity_of_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(12)] + [(None, 1, 1), (3, None, None), (99, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")
    none = labels.where("false")
    for given in (labels, none):
        assert toxicity.score(df, toxicity.train(df, given)).count() == df.count()
        assert toxicity.reject_toxic(df, given).columns == df.columns
    assert toxicity.reject_toxic(empty(spark), none).count() == 0
    assert toxicity.reject_toxic(df, none).count() == df.count()


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 4 != 0"))
    rows = quality.grade(docs, model).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    assert np.mean([r.keep == bool(r.quality) for r in rows]) > 0.9


def test_ordinal_regression_orders_thresholds_and_recovers_grades():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 6)).astype(np.float32)
    z = x @ np.array([2, -1, 0.5, 0, 0, 1]) + rng.logistic(size=1500)
    y = np.digitize(z, [-2, 0, 2])
    m = quality.fit(x, y)
    assert (np.diff(m.thresholds) > 0).all()
    p = m.probabilities(x)
    assert np.allclose(p.sum(1), 1) and np.corrcoef(p @ np.arange(4), y)[0, 1] > 0.75


def test_grades_equal_the_formula_on_all_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rated = labels.selectExpr("doc_id", "quality * 2 + cast(doc_id % 2 as int) as stars")
    model = quality.train(docs, rated, "stars")
    assert model.grades == [0.0, 1.0, 2.0, 3.0] and (np.diff(model.thresholds) > 0).all()
    texts = dict(documents(spark, sf_dir))
    for r in quality.grade(docs, model, reach=2).collect():
        z = float(quality.features(texts[r.doc_id]) @ model.weights)
        upto = [0.0, *(1 / (1 + math.exp(z - t)) for t in model.thresholds), 1.0]
        chance = [b - a for a, b in zip(upto, upto[1:], strict=False)]
        assert abs(r.expected_grade - sum(g * c for g, c in zip(model.grades, chance, strict=True))) < 1e-4
        assert abs(r.tail_probability - sum(chance[2:])) < 1e-4 and r.keep == (r.tail_probability >= 0.5)
    stars = {r.doc_id: r.stars for r in rated.collect()}
    got = [(stars[r.doc_id], r.expected_grade) for r in quality.grade(docs, model).collect() if r.doc_id in stars]
    assert np.mean([e for s, e in got if s >= 2]) > np.mean([e for s, e in got if s < 2]) + 1.0


def test_fit_has_the_best_likelihood_nearby():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)).astype(np.float32)
    y = np.digitize(x @ np.array([1.5, -1, 0, 0.5]) + rng.logistic(size=400), [-1, 1])
    m = quality.fit(x, y)

    def cost(w, cuts):
        p = quality.OrdinalModel([0, 1, 2], w, cuts).probabilities(x)[np.arange(400), y]
        return -np.log(np.maximum(p, 1e-12)).mean() + 1.5e-4 * float((w * w).sum())

    best = cost(m.weights, m.thresholds)
    assert all(best <= cost(m.weights + rng.normal(0, 0.05, 4), m.thresholds + np.sort(rng.normal(0, 0.05, 2))) + 1e-4 for _ in range(50))


def test_many_grades_become_ordered_ranges(spark):
    rows = [(k, syllables(random.Random(k), 5) + " good" * (k % 50)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    rated = spark.createDataFrame([(k, k % 50) for k in range(400)], "doc_id BIGINT, quality INT")
    limits, means = quality.graded_ranges(rated.selectExpr("doc_id", "cast(quality as double) as grade"))
    assert 2 < len(limits) <= quality.MOST_GRADES and limits == sorted(limits) and means == sorted(means)
    model = quality.train(docs, rated)
    assert model.grades[-1] > 45 and model.grades[0] < 5
    rows = quality.grade(docs, model).collect()
    assert np.corrcoef([r.expected_grade for r in rows], [r.doc_id % 50 for r in rows])[0, 1] > 0.8


def test_quality_of_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(k, k % 3) for k in range(12)] + [(None, 1), (3, None)], "doc_id BIGINT, quality INT")
    rows = quality.grade(df, quality.train(df, labels)).collect()
    assert len(rows) == df.count() and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    assert quality.grade(empty(spark), quality.train(df, labels.where("false"))).count() == 0


def exact_ids():
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY)
    return lambda text: exact.encode(text, add_special_tokens=False).ids


def check_pieces(rows, docs):
    encode = exact_ids()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text in docs:
        ids = np.array([*encode(text), 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def check_sequences(rows):
    by_sequence, padding = {}, 0
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding


def test_packing_query_on_all_rows(spark, sf_dir):
    rows = QUERIES["op7_packing"](spark, sf_dir).collect()
    check_pieces(rows, documents(spark, sf_dir))
    assert check_sequences(rows) == 0


def test_packing_of_awkward_rows(spark):
    df = awkward(spark)
    rows = packing.pack(df, VOCABULARY, RANKS, docs_per_group=5).collect()
    unique = [(r.doc_id, r.text or "") for r in df.where("doc_id IS NOT NULL AND doc_id != 6").collect()]
    check_pieces(rows, unique)
    check_sequences(rows)
    encode = exact_ids()
    total = sum(len(encode(r.text or "")) + 1 for r in df.collect())
    assert sum(r.length for r in rows) == total
    assert packing.pack(empty(spark), VOCABULARY, RANKS).count() == 0


def test_fast_ids_equal_the_tokenizers():
    exact, fast = exact_ids(), byte_encoder(VOCABULARY, RANKS, special=True)
    rng = random.Random(8)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x1F300, 0x1FA00), 10, 32, 32])) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for text in [t for t in awkward_texts() if t] + odd + ["a <|endoftext|> b", "<|", "  double  spaces\t\ttabs\r\n", "don't we'll I'VE", "１２３ ½ ² ﬁ", "\u2003\u2003x", " " * 5000 + "x", "x" + "\n" * 4095 + "y"]:
        assert fast(text) == exact(text)


def test_packing_of_texts_of_one_character(spark):
    """Runs of millions of a character, white space too, don't end the job."""
    n = 5_000_000
    texts = [" " * n, "\n" * n, "a" * n, "7" * 100_000, "." * 100_000, "x " + "\t " * 200_000 + "y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(6)
    rows = packing.pack(df, VOCABULARY, RANKS).collect()
    check_pieces(rows, list(enumerate(texts)))
    assert check_sequences(rows) == 0


def test_first_fit_decreasing_equals_a_plain_loop():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 300):
        sizes = rng.integers(1, 1024, n).tolist()
        bins, room = [], []
        for k in sorted(range(n), key=lambda k: (-sizes[k], k)):
            b = next((b for b, r in enumerate(room) if r >= sizes[k]), None)
            if b is None:
                b = len(bins)
                bins.append([])
                room.append(1024)
            bins[b].append(k)
            room[b] -= sizes[k]
        assert packing.first_fit_decreasing(sizes, 1024) == bins
        closed = packing.close_bins(bins, sizes, 1024)
        assert all(t & (t - 1) == 0 for t in (sum(p[2] for p in s) for s in closed))
        assert sum(p[2] for s in closed for p in s) == sum(sizes)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_licences(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hits, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                hits.append(k)
                labels.add(label)
    return len(words), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def test_licences_query_on_all_rows(spark, sf_dir):
    want = {i: base_licences(t) for i, t in documents(spark, sf_dir)}
    rows = QUERIES["op10_licenses"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)


def test_licence_templates_need_place_and_phrase(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    texts = ["x y z " + mit + " more", " ".join(sorted(mit.split())), "Licensed under CC BY-NC 4.0.", "THE MIT LICENSE and the MIT License", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[0].labels == "mit" and got[0].score > 0.95 and got[0].n_base == 0
    assert got[1].labels == "" and got[2].labels == "cc-by-nc-4.0"
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].base_labels) == (2, 1, 5, "mit")
    assert (got[4].n_words, got[4].first_word, got[4].labels, got[4].score) == (0, None, "", 0.0)


def test_licences_of_a_file_with_all_templates(spark):
    named = [(f"t{k}", text, phrases) for k, (_, text, phrases) in enumerate(licenses.TEMPLATES)]
    notice = " some other words in between ".join(text for _, text, _ in named)
    df = spark.createDataFrame([(1, notice), (2, "filler " * 5000 + notice)], "doc_id BIGINT, text STRING")
    for r in licenses.scan(df, named).collect():
        assert {label for label, _, _ in named} <= set(r.labels.split(","))


def test_licence_search_equals_all_places():
    known = licenses.vocabulary(licenses.TEMPLATES)
    rng = np.random.default_rng(5)
    for _ in range(6):
        index = licenses.Index(licenses.TEMPLATES, known, rng.choice([0.3, 1.0, 1.0, 1.2, 3.0], len(known.hashes)))
        for t, ids in enumerate(index.texts):
            for _ in range(12):
                edited = [w if rng.random() > 0.18 else -1 for w in ids.tolist()]
                edited[(k := rng.integers(len(edited))) : k] = [-1] * rng.integers(4)
                text = np.array([-1] * 4 + edited + [-1] * 4)
                by_place = [_covered(index, t, text, o) for o in range(-len(ids), len(text))]
                if max(by_place) >= licenses.COVERAGE:
                    assert index.matches(text)[1] >= max(by_place) - 1e-9


def _covered(index, t, text, offset):
    own = index.texts[t]
    near = [text[max(offset + k - licenses.DRIFT, 0) : max(offset + k + licenses.DRIFT + 1, 0)] for k in range(len(own))]
    return sum(index.idf[w] for w, some in zip(own, near, strict=True) if w in some) / index.idf[own].sum()


def test_licences_of_awkward_rows(spark):
    assert licenses.scan(awkward(spark)).count() == awkward(spark).count()
    assert licenses.scan(empty(spark)).count() == 0
    got = {(r.doc_id, r.n_words, r.labels, r.score) for r in licenses.scan(awkward(spark)).where("doc_id < 4").collect()}
    assert got == {(0, 0, "", 0.0), (1, 0, "", 0.0), (2, 0, "", 0.0), (3, 1, "", 0.0)}
