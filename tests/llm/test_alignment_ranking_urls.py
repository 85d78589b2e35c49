"""Alignment, ranking and URL filters against brute force, on the given tables and on awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from compare import assert_same
from llm_cases import awkward, awkward_texts, empty, syllables

from oceanloom.llm import alignment, ranking, urls
from oceanloom.llm.common import join_to_rows
from oceanloom.llm.registry import ORACLE_SQL, QUERIES, _urls_sql
from oceanloom.llm.tokens import piece_encoder, piece_tokens

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]


def plain_alignments(texts):
    """Ids, token bytes and groups of each text by the tokenizers' own libraries, then counts over all of them."""
    import sentencepiece
    from tokenizers import Tokenizer

    exact, model = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    exact.encode_special_tokens = True
    latin = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    byte_of = {chr(c): c for c in latin} | {chr(256 + k): c for k, c in enumerate(sorted(set(range(256)) - set(latin)))}
    out = []
    for text in texts:
        want = (" " + (text or "")).encode()
        a, b = (exact.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        bytes_a = [bytes(byte_of[c] for c in exact.id_to_token(k)) for k in a]
        bytes_b = [bytes([int(p[3:-1], 16)]) if model.is_byte(k) else p.replace("\u2581", " ").encode() for k, p in ((k, model.id_to_piece(k)) for k in b)]
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out.append(None)
            continue
        ends_a, ends_b = ({sum(map(len, t[: k + 1])): k for k in range(len(t))} if len(t) < 3000 else dict(zip(np.cumsum([len(x) for x in t]).tolist(), range(len(t)), strict=True)) for t in (bytes_a, bytes_b))
        common, groups, p, q = sorted(ends_a.keys() & ends_b.keys()), [], 0, 0
        for e in common:
            groups.append((a[p : ends_a[e] + 1], b[q : ends_b[e] + 1]))
            p, q = ends_a[e] + 1, ends_b[e] + 1
        out.append((len(a), len(b), groups, [(a[ends_a[e]], b[ends_b[e]]) for e in common]))
    counts = Counter(link for x in out if x for link in x[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for x in out:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        digest = hashlib.sha256(";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups).encode()).hexdigest()
        rows.append((n_a, n_b, len(groups), len(links), sum(counts[link] == most[link[1]] for link in links), sum(counts[link] for link in links), digest))
    return rows


def check_alignment(df, rows):
    docs = df.select("doc_id", "text").collect()
    want = Counter((d.doc_id, *w) for d, w in zip(docs, plain_alignments([d.text for d in docs]), strict=True))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows) == want


def test_alignment_query_on_all_rows(spark, sf_dir):
    check_alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"), QUERIES["op11_alignment"](spark, sf_dir).collect())


def test_alignment_of_awkward_rows(spark):
    df = awkward(spark).select("doc_id", "text", "lang", "n_chars", "h")
    more = ["<|endoftext|> </s> <s> <unk> <0x41>", "a\u2581b", "two  spaces   three", " leading", "trailing ", "\n\n\t\r\n", "ﬁ ½ \u00a0nbsp \u3000wide", "\U0001f468\u200d\U0001f469\u200d\U0001f467 née", "x" * 3000, "don't stop", "\u2581", " "]
    many = [(100 + k, t) for k, t in enumerate(more)] + [(200 + k, "the same text of a third of all rows") for k in range(20)]
    df = df.select("doc_id", "text").unionByName(spark.createDataFrame(many, "doc_id BIGINT, text STRING"))
    check_alignment(df, alignment.align(df, *FILES).collect())
    assert alignment.align(empty(spark), *FILES).count() == 0
    only_null = spark.createDataFrame([(1, None), (2, "")], "doc_id BIGINT, text STRING")
    assert sorted(tuple(r) for r in alignment.align(only_null, *FILES).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_rare_pairs_are_joined(spark, monkeypatch):
    """With the share at 2 hardly any pair is hot, so nearly all go through the join; the default at this size looks up all."""
    monkeypatch.setattr(alignment, "SHARE", 2)
    df = awkward(spark).select("doc_id", "text")
    check_alignment(df, alignment.align(df, *FILES).collect())


def test_piece_units_equal_whole_texts():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    encode, rng = piece_encoder(model, piece_tokens(model)), random.Random(3)
    texts = [t for t in awkward_texts() if t] + ["".join(chr(rng.choice([32, 32, 10, rng.randrange(33, 127), rng.randrange(0xA1, 0x2000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    for text in texts + [" " * 20 + "a", "a" + " " * 33, "1 000  000"]:
        ids = model.encode(text)
        assert encode(text) == ids or (encode(text) is None and model.decode(ids) != text)


def test_rows_meet_their_keys_once(spark):
    """Keys of many rows and of few, keys that no row has, rows without a key."""
    from pyspark.sql import functions as F

    rows = spark.range(9000).select("id", F.encode(F.when(F.col("id") < 6000, "often").when(F.col("id") < 8990, F.concat(F.lit("k"), F.col("id").cast("string"))), "utf-8").alias("key"))
    per_key = rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).withColumn("v", F.length("key")).unionByName(spark.createDataFrame([(bytearray(b"unused"), 1, 6)], "key BINARY, n BIGINT, v INT"))
    got = join_to_rows(rows, per_key, "key", "n", ["v"]).select("id", "v").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == [(k, 5 if k < 6000 else 5 if k < 8990 else None) for k in range(9000)]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_ranks(docs, items, top=10):
    found = [(d, [t.translate(LOWER) for t in TERM.findall(text or "")]) for d, text in docs]
    found = [(d, t, Counter(t)) for d, t in found if t]
    total, length = len(found), sum(len(t) for _, t, _ in found)
    df, out, wanted = Counter(t for _, _, c in found for t in c), set(), {}
    for i, text in items:
        wanted.setdefault(i, set()).update(t.translate(LOWER) for t in TERM.findall(text or ""))
    for i, terms in wanted.items():
        scores = []
        for d, t, tf in found:
            m = 100 - 90 + (90 * len(t) * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in terms if x in tf)
            if s > 0:
                scores.append((-s, d is None, d))
        for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top]):
            out.add((i, k + 1, d, -s))
    return out


def ranked(rows):
    got = [tuple(r) for r in rows]
    assert len(got) == len(set(got))
    return set(got)


def test_ranking_of_awkward_rows(spark):
    df = awkward(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()] + [(300 + k, "tie Émile Été ka tes") for k in range(25)] + [(90, "tie Émile Été ka tes"), (90, "tie Émile Été ka tes")]
    items = [(1, "tie tie TIE"), (2, "Émile É"), (3, None), (4, "... !"), (None, "ka lo"), (5, "ka lomir absent"), (5, "tes"), (6, "x one two 𝄞"), (7, "ka"), (8, "no such words"), (-1, awkward_texts()[11])]
    data, asked = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(5), spark.createDataFrame(items, "item_id BIGINT, text STRING")
    want = plain_ranks(docs, items)
    assert ranked(ranking.rank(data, asked).collect()) == want
    assert {x[:3] for x in want} >= {(1, 1, 90), (1, 2, 90), (1, 3, 300)}
    for d, i in ((empty(spark), asked), (data, asked.where("false")), (spark.createDataFrame([(1, None), (2, "")], "doc_id BIGINT, text STRING"), asked)):
        assert ranking.rank(d, i).count() == 0


def test_blocks_of_items_give_the_same_ranks(spark, sf_dir, monkeypatch):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300), spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(12)
    want = plain_ranks([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(ranking, "TILE_DOCS", 7)
    assert ranked(ranking.rank(docs, items).collect()) == want
    assert sum(1 for _ in ranking.item_blocks(items)) == 3


def test_narrow_tiles_stay_exact():
    """Weights near the limit make tiles narrow; sums of products then exceed 2**53 only as integers."""
    rng = np.random.default_rng(5)
    weights = rng.integers(1 << 28, 1 << 29, 400)
    held = np.concatenate([rng.choice(400, 250, replace=False) for _ in range(6)])
    items = np.repeat(np.arange(6), 250)
    owner, term = np.repeat(np.arange(9), 150), np.concatenate([rng.choice(400, 150, replace=False) for _ in range(9)])
    impact = rng.integers(900_000, 999_999, len(term))
    scorer = ranking.Scorer(weights, items, held, 6)
    assert scorer.width < 32 and scorer.width * (1 << 29) * 1_000_000 < 1 << 54
    got = scorer(owner, term, impact, 9)
    for i in range(6):
        own = set(held[items == i].tolist())
        for d in range(9):
            assert got[i, d] == sum(int(weights[t]) * int(x) for t, x in zip(term[owner == d], impact[owner == d], strict=True) if int(t) in own)


def test_ties_at_the_edge_of_a_tile_go_by_id():
    scores = np.array([[5, 7, 5, 5, 0, 5, 9]])
    ids, has = np.array([40, 1, 10, 30, 2, 0, 3]), np.array([True, True, True, True, True, False, True])
    (s, d, h), = ranking.best_of(scores, ids, has, 4)
    assert d.tolist() == [3, 1, 10, 30] and s.tolist() == [9, 7, 5, 5] and h.all()


def plain_judgements(pages, rules=urls.RULES, order=urls.ORDER, back=urls.BACK_OFF):
    """Place by place: each model's chance by backing off order by order, and the log of their ratio."""
    rows = []
    for page, url in pages:
        url = url or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
        fitting = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fitting, default=(0, None, None))
        read = "\x02" + re.sub(r"[^\x21-\x7e]", "~", re.sub("[0-9]", "0", url.lower())) + "\x03"
        held = int(hashlib.md5(url.encode()).hexdigest()[:8], 16) % urls.FOLDS == 0
        rows.append((page, url, host, path, rule, verdict, read, held))
    models = {}
    for v in ("allow", "block"):
        seen = {(r[1], r[6]) for r in rows if r[5] == v and not r[7]}
        models[v] = Counter(s[p - k : p + 1] for _, s in seen for p in range(1, len(s)) for k in range(min(order, p) + 1)), Counter(s[p - k : p] for _, s in seen for p in range(1, len(s)) for k in range(min(order, p) + 1))

    def log_chance(v, s, p):
        grams, contexts = models[v]
        chance = 1 / 256
        for k in range(min(order, p) + 1):
            chance = (grams[s[p - k : p + 1]] + back * chance) / (contexts[s[p - k : p]] + back)
        return math.log(chance)

    scores = {r[1]: sum(log_chance("allow", r[6], p) - log_chance("block", r[6], p) for p in range(1, len(r[6]))) / (len(r[6]) - 1) for r in rows}
    fold = {(r[1], r[5]) for r in rows if r[5] and r[7]}
    bins = [(math.floor(max(-urls.REACH, min(urls.REACH, scores[u])) / urls.BIN), v) for u, v in fold]
    limit, sizes = 0.0, Counter(v for _, v in bins)
    if len(sizes) == 2:
        gain = lambda b: round(sum(x >= b for x, v in bins if v == "allow") / sizes["allow"] - sum(x >= b for x, v in bins if v == "block") / sizes["block"], 9)
        limit = min(range(-1000, 1001), key=lambda b: (-gain(b), abs(b), b)) * urls.BIN
    return {(r[0], r[1]): (r[2], r[3], r[4], r[5] or ("allow" if scores[r[1]] >= limit else "block"), None if r[4] else scores[r[1]]) for r in rows}, limit


def check_urls(pages, rows):
    want, limit = plain_judgements(pages)
    by_id = {}
    for (page, _), w in want.items():
        by_id.setdefault(page, []).append(w)
    assert len(rows) == len(pages)
    for r in rows:
        near = [w for w in by_id[r.page_id] if (r.host, r.path, r.rule) == w[:3] and (r.score is None) == (w[4] is None) and (w[4] is None or abs(r.score - w[4]) < 2e-4)]
        assert near, r
        assert any(r.verdict == w[3] for w in near) or abs(r.score - limit) < 2e-4


def test_urls_query_on_all_rows(spark, sf_dir):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    check_urls(pages, QUERIES["op13_urls"](spark, sf_dir).collect())


AWKWARD_URLS = [
    None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "https://Example.COM/en/x?y#z", "https://www.example.com/en/", "https://a.www.example.com/en/1", "http://notexample.com/en/", "http://xcom/",
    "http://a.net/es/", "http://a.net/es", "http://a.net/fr/q://b", "http://a.net?x=/es/", "http://h#f/en/", "ftp://user@host.org:21/ä/é", "http://例え.org/パス", "a://b://c.com/d", "http://w.org/" + "long/" * 2_000, "http://com/\n/x", "HTTP://WWW.EXAMPLE.COM/EN/",
]


def test_awkward_urls(spark):
    rng = random.Random(2)
    made = [f"http://{syllables(rng, 1)}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr'])}/{rng.randint(1, 99)}" for _ in range(120)]
    pages = list(enumerate(AWKWARD_URLS + made)) + [(500 + k, "http://one.org/very/common") for k in range(60)] + [(None, "http://two.org/"), (None, None), (7, "http://again.org/"), (3, "://"), (3, "://")]
    df = spark.createDataFrame([(*p, "html", "host", 1, "k") for p in pages], "page_id BIGINT, url STRING, html STRING, host STRING, n INT, key STRING")
    check_urls(pages, urls.judge(df).collect())
    assert urls.judge(df.where("false")).count() == 0
    unruled = urls.judge(df.where("page_id >= 500")).collect()
    assert {(r.verdict, r.score) for r in unruled} == {("allow", 0.0)}


def test_rare_grams_are_joined(spark, sf_dir, monkeypatch):
    """With the share at 8 nearly all grams go through the join."""
    monkeypatch.setattr(urls, "SHARE", 8)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    check_urls([(r.page_id, r.url) for r in pages.collect()], urls.judge(pages).collect())


def test_models_tell_hosts_apart(spark):
    """URLs that no rule fits go with the hosts and paths that they look like."""
    rng = random.Random(6)
    good = [f"https://{syllables(rng, 1)}-library.com/books/{syllables(rng, 1)}" for _ in range(300)]
    bad = [f"https://win-casino-{syllables(rng, 1)}.net/es/bonus/{syllables(rng, 1)}" for _ in range(300)]
    open_good, open_bad = ([f"https://{w}{syllables(rng, 1)}.org/{p}/{syllables(rng, 1)}" for _ in range(50)] for w, p in (("old-library-", "books"), ("win-casino-", "bonus")))
    rows = urls.judge(spark.createDataFrame(list(enumerate(good + bad + open_good + open_bad)), "page_id BIGINT, url STRING")).collect()
    right = sum(r.verdict == ("allow" if r.page_id < 650 else "block") for r in rows if r.page_id >= 600)
    assert right >= 97


def test_no_python_for_urls(spark, sf_dir, monkeypatch):
    """Neither the last plan nor any that is written on the way runs Python."""
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (plans.append(self._df._jdf.queryExecution().executedPlan().toString()), write(self, *a, **b))[1])
    monkeypatch.setattr(urls, "cut", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), df)[1])
    urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    assert len(plans) == 5 and not any(re.search("Python|Pandas|InArrow", p) for p in plans)


@pytest.mark.parametrize("name", ["op12_ranking", "op13_urls"])
def test_sql_is_registered(name):
    assert name in ORACLE_SQL


def test_urls_sql_on_awkward_rows(spark):
    import duckdb

    df = spark.createDataFrame([(k, u) for k, u in enumerate(AWKWARD_URLS[:20] + ["http://a.org/x", "https://b.com/y", "https://c.example.com/en/z"])], "page_id BIGINT, url STRING")
    con = duckdb.connect()
    con.register("pages", df.toPandas().astype({"url": object}))
    assert_same(urls.judge(df), con, _urls_sql())
