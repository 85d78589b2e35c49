"""The queries of this subpackage, ``opN_<name>`` and the pipeline, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.llm import alignment, chat, decontaminate, fingerprints, licenses, linededup, neardup, packing, quality, ranking, secrets, toxicity, urls
from oceanloom.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text, its edited text and the next document's, by chunk fingerprints.  Null texts are empty; rows without an id come last; repeated rows follow each other."""
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score by a grammar learned outside the held-out fold.  Null and empty texts score as one without a matched clause; rows without an id aren't held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of the three rules and of the Markov models in every text.  Null and empty texts have none; repeated rows each have their result."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that an earlier line matches.  Null texts and lines without words have none; rows without an id give lines without one."""
    return linededup.removed_lines(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it holds.  Items without words and null or empty texts give no row; repeated rows give one."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", F.round("containment", 6).alias("containment"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered.  Rows without an id are conversations of one turn; null roles and texts are empty."""
    return chat.render(table(spark, sf_dir, "conversations"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences.  A null or empty text is its closing id alone; repeated rows are packed each."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's expected grade and chance of the highest.  Null and empty texts have no features and get the thresholds' own chances."""
    docs = table(spark, sf_dir, "documents")
    return quality.grade(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's class.  Equal texts, null and empty ones together, are one class; a class of rows without ids has no id."""
    found = neardup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("is_representative"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and licence templates in every text.  Null and empty texts have no words and score 0; repeated rows each have their result."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two vocabularies in every text.  Null and empty texts, and those that the pieces don't give back, have none; repeated rows each have their result."""
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")))


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents.  Null and empty texts have no terms; items without terms have no rows; rows of one item id are one item."""
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL, by rule or by the models.  Null URLs are empty; repeated rows each have their result."""
    return urls.judge(table(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6))


#: Equal sets of (role, text) lists and their prefixes, by lists instead of hashes.
CHAT_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations),
c AS (SELECT conv_id, list(struct_pack(r := r, x := x) ORDER BY turn NULLS FIRST, r, x) AS l FROM t GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN concat_ws(chr(0), coalesce(CAST(turn AS VARCHAR), ''), r, x) END),
m AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, l FROM c GROUP BY l)
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns, n_copies, array_to_string(list_transform(l, lambda s: '<|' || s.r || '|>' || chr(10) || s.x || chr(10)), '') AS text
FROM m WHERE NOT EXISTS (SELECT 1 FROM m b WHERE len(b.l) > len(m.l) AND b.l[1] = m.l[1] AND b.l[1:len(m.l)] = m.l)"""

#: Exact containment of every item in every document, without a search.
LEAKS_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5), LATERAL (SELECT array_to_string(w[i:i+4], ' ') AS s)),
bs AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5), LATERAL (SELECT array_to_string(w[i:i+4], ' ') AS s)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, round(count(*) / n_shingles, 6) AS containment
FROM bs JOIN ds USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles"""

#: Lines as word sets, candidates by a word of both prefixes in the order of rarity, all of them verified.
LINES_SQL = """
WITH l AS (SELECT doc_id, unnest(range(len(v))) AS line_no, unnest(v) AS v FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS v FROM documents)),
s AS (SELECT doc_id, line_no, doc_id * 1000000 + line_no AS pos, list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(v), '[\\t\\x0b\\f\\r]', ' ', 'g'), ' '), lambda w: w <> ''))) AS k FROM l),
u AS (SELECT k, len(k) AS n, min(pos) AS pos FROM s WHERE len(k) > 0 GROUP BY k),
w AS (SELECT pos, n, unnest(k) AS w FROM u),
c AS (SELECT w, count(*) AS c FROM w GROUP BY w),
p AS (SELECT pos, n, w FROM w JOIN c USING (w) QUALIFY row_number() OVER (PARTITION BY pos ORDER BY c, w) <= floor(n * 0.2 + 1e-9) + 1),
x AS (SELECT DISTINCT a.pos AS a, b.pos AS b FROM p a JOIN p b USING (w) WHERE a.pos < b.pos AND a.n >= 0.8 * b.n - 1e-9 AND b.n >= 0.8 * a.n - 1e-9),
y AS (SELECT x.a, x.b, len(list_intersect(ua.k, ub.k)) AS s, ua.n + ub.n AS n FROM x JOIN u ua ON ua.pos = x.a JOIN u ub ON ub.pos = x.b),
f AS (SELECT b AS pos, min(a) AS first FROM y WHERE s / (n - s) >= 0.8 GROUP BY b)
SELECT s.doc_id, s.line_no FROM s JOIN u USING (k) LEFT JOIN f ON f.pos = u.pos WHERE s.pos > least(u.pos, coalesce(f.first, u.pos))"""

#: Terms, counts and scores of all documents that hold a term of an item.
RANKING_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
k AS (SELECT count(*) AS nn, sum(len(w))::BIGINT AS ll FROM d WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
f AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM d) WHERE t IN (SELECT t FROM b) GROUP BY ALL),
h AS (SELECT t, count(*) AS df FROM f GROUP BY t),
s AS (SELECT item_id, r, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM b JOIN f USING (t) JOIN h USING (t) CROSS JOIN k GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10"""


def _urls_sql() -> str:
    """The rules, and the models level by level: each gram's log ratio, then a URL's sum over places of the longest gram known and of what backing off adds."""
    n, u = urls.BACK_OFF, urls.UNIT
    off = lambda a, r: f"(ln({n} / ({a} + {n})) - ln({n} / ({r} + {n})))"
    levels = ["l0 AS (SELECT c.gram, c.a, c.r, sum(c.a) OVER () AS ca, sum(c.r) OVER () AS cr, 1e0 / 256 AS pa, 1e0 / 256 AS pr FROM c WHERE len(gram) = 1)"]
    for k in range(urls.ORDER + 1):
        if k:
            levels.append(f"l{k} AS (SELECT c.gram, c.a, c.r, sum(c.a) OVER x AS ca, sum(c.r) OVER x AS cr, m.pa, m.pr FROM c JOIN m{k - 1} m ON m.gram = c.gram[2:] WHERE len(c.gram) = {k + 1} WINDOW x AS (PARTITION BY c.gram[:-2]))")
        levels.append(f"m{k} AS (SELECT l.gram, l.a, l.r, l.ca, l.cr, l.pa AS qa, l.pr AS qr, (l.a + {n} * l.pa) / (l.ca + {n}) AS pa, (l.r + {n} * l.pr) / (l.cr + {n}) AS pr FROM l{k} l)")
    shares = " UNION ALL ".join(
        f"SELECT gram, CAST(round((ln(pa) - ln(pr) - (ln(qa) - ln(qr)) - {off('ca', 'cr')} + CASE WHEN gram[-1] = chr(3) OR {k} = {urls.ORDER} THEN 0e0 ELSE {off('a', 'r')} END) / {u}) AS BIGINT) AS share FROM m{k}" for k in range(urls.ORDER + 1)
    )
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    longest = sorted(urls.RULES, key=lambda x: -len(x[0] + x[1]))
    case = lambda f: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{f(h, p, v)}'" for h, p, v in longest) + " END"
    return f"""
WITH p AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(url, '') AS url, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages)),
j AS (SELECT *, {case(lambda h, p, v: h + p)} AS rule, {case(lambda h, p, v: v)} AS ruled FROM p),
u AS (SELECT DISTINCT url, ruled, CASE WHEN ('0x' || md5(url)[1:8])::BIGINT % {urls.FOLDS} <> 0 THEN ruled END AS learn, chr(2) || regexp_replace(translate(lower(url), '123456789', '000000000'), '[^\x21-\x7e]', '~', 'g') || chr(3) AS s FROM j),
g AS (SELECT url, ruled, learn, s[p - k:p] AS gram FROM (SELECT *, unnest(range(least({urls.ORDER}, p - 1) + 1)) AS k FROM (SELECT *, unnest(range(2, len(s) + 1)) AS p FROM u))),
c AS (SELECT gram, count(*) FILTER (WHERE learn = 'allow') AS a, count(*) FILTER (WHERE learn = 'block') AS r FROM g GROUP BY gram HAVING a + r > 0),
{", ".join(levels)},
w AS ({shares}),
e AS (SELECT CAST(round({off("count(*) FILTER (WHERE learn = 'allow')", "count(*) FILTER (WHERE learn = 'block')")} / {u}) AS BIGINT) AS first,
  CAST(round({off("coalesce(sum(len(s) - 1) FILTER (WHERE learn = 'allow'), 0)", "coalesce(sum(len(s) - 1) FILTER (WHERE learn = 'block'), 0)")} / {u}) AS BIGINT) AS each FROM u),
z AS (SELECT url, ruled, CAST(first + each * (len(s) - 1) + coalesce(t, 0) AS DOUBLE) * {u} / (len(s) - 1) AS score FROM u CROSS JOIN e LEFT JOIN (SELECT url, sum(share) AS t FROM g JOIN w USING (gram) GROUP BY url) USING (url) WHERE learn IS NULL),
q AS (SELECT CAST(floor(least(greatest(score, -{urls.REACH}), {urls.REACH}) / {urls.BIN}) AS INT) AS bin, count(*) FILTER (WHERE ruled = 'allow') AS a, count(*) FILTER (WHERE ruled = 'block') AS r FROM z WHERE ruled IS NOT NULL GROUP BY bin),
v AS (SELECT bin, sum(coalesce(a, 0)) OVER (ORDER BY bin DESC) AS fa, sum(coalesce(r, 0)) OVER (ORDER BY bin DESC) AS fr, sum(a) OVER () AS ta, sum(r) OVER () AS tr
  FROM (SELECT unnest(range(-{round(urls.REACH / urls.BIN)}, {round(urls.REACH / urls.BIN)} + 1)) AS bin) LEFT JOIN q USING (bin)),
o AS (SELECT coalesce((SELECT bin * {urls.BIN} FROM v WHERE ta > 0 AND tr > 0 ORDER BY round(fa / ta - fr / tr, 9) DESC, abs(bin), bin LIMIT 1), 0e0) AS limit_at)
SELECT page_id, host, path, rule, coalesce(j.ruled, CASE WHEN score >= limit_at THEN 'allow' ELSE 'block' END) AS verdict, CASE WHEN rule IS NULL THEN round(score, 6) END AS score
FROM j JOIN u USING (url) LEFT JOIN z USING (url) CROSS JOIN o"""


QUERIES = {
    f.__name__: f
    for f in (op1_fingerprints, op2_toxicity, op3_secrets, op4_linededup, op5_decontaminate, op6_chat, op7_packing, op8_quality, op9_neardup, op10_licenses, op11_alignment, op12_ranking, op13_urls)
} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL: dict[str, str] = ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}) | {
    "op4_linededup": LINES_SQL, "op5_decontaminate": LEAKS_SQL, "op6_chat": CHAT_SQL, "op12_ranking": RANKING_SQL, "op13_urls": _urls_sql(),
}
