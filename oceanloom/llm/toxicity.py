"""Operator 2, toxicity: a weighted finite-state grammar of abusive clauses.

Words become classes (insult, threat, target, negation, report, other) through a
lexicon learned from labelled rows; its entries are whole words or stems, so
inflected and compounded forms count.  Four transducers over classes, for
insults and threats, targets, negation and reported speech, are composed into
one machine, which reads a clause and ends in the sort of match: plain, aimed at
a target, negated, or reported.  A document's score is a logistic function of its
matched clauses' weights, by sort.  Isolated words outside a matched clause don't score.
Threat words need not be learned: they count where they are aimed at a target, inflected ones where the clause
addresses somebody.  An insult or a threat may come before its target.  The weights are fitted to the labelled rows
alone, around a prior that holds where these have no clause of a sort; negated and reported clauses never weigh less than
nothing, nor more than half of plain ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.llm.common import id_and_text, small_batches

#: At most so many labelled rows of each class are learned from, those with the smallest hash of their id.
TRAINING_ROWS = 5_000
STEM_LENGTHS = (3, 4, 5, 6, 7)
FOLDS, HELD_OUT = 5, 0

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)

# Closed-class words of four languages; words of abuse are learned, these only shape the grammar.
TARGET_WORDS = set("you your yours yourself he she they him her them his their du dich dir ihr euch dein sie ihn tu toi te vous ton tes ils elle tú usted ustedes vosotros tus ellos ellas".split())
NEGATION_WORDS = set("not no never nor without isn't aren't wasn't don't didn't won't nicht kein keine keinen nie niemals pas jamais aucun aucune sans nunca jamás tampoco ningún ninguna sin".split())
REPORT_WORDS = set("said says quoted quote reported according claimed wrote called alleged sagte sagt angeblich zitiert laut dit disait selon prétend affirme dijo dice según afirma llamó".split())
THREAT_WORDS = set("kill murder strangle stab shoot umbringen töten erschießen tuer égorger matar apuñalar".split())
SECOND_PERSON = set("you your yours yourself yourselves du dich dir ihr euch dein deine deinen euer tu toi te vous ton ta tes votre vos tú ti os usted ustedes vosotros tus vuestro vuestra".split())
#: Other forms of threat words, and other threat words: a stem, then the endings that it takes.
THREAT_FORMS = {
    stem + end
    for stem, *ends in map(
        lambda x: x.split(","),
        "kill,s,ed,ing murder,s,ed,ing strangl,es,ed,ing stab,s,bed,bing shoot,s,ing hurt,,s,ing burn,,s,ed,ing,t chok,e,es,ed,ing slaughter,,s,ed,ing behead,,s,ed,ing "
        "umbring,e,st,t umgebracht, umzubringen, töt,e,est,et getötet, erschieß,e,t erschossen, erwürg,e,t,en erwürgt, verbrenn,e,t,en verbrannt, verprügel,,n,t "
        "tuer,ai,as,a,ons,ez,ont,ais,ait égorg,erai,era,erons,eront étrangl,er,erai,era,erons,eront brûl,er,erai,era,erons,eront poignard,er,erai,era,erons,eront "
        "mat,aré,arás,ará,aremos,arán,arte,aros,arlo apuñal,aré,ará,aremos,arán,arte,aros quem,aré,ará,aremos,arán,arte,aros degoll,ar,aré,ará,aremos,arán,arte estrangul,ar,aré,ará,aremos,arán,arte".split(),
    )
    for end in ends
}

_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"«»„“”]")
_CLAUSE = re.compile(r"[.!?;\n]+")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``step[state][symbol]`` is (next state, output symbol, weight)."""

    step: tuple[tuple[tuple[int, int, float], ...], ...]


def transducer(states: int, moves: dict[tuple[int, int], tuple[int, int, float]]) -> Transducer:
    """Moves not named keep the state and copy the symbol, at weight 0."""
    step = tuple(tuple(moves.get((q, a), (q, a, 0.0)) for a in range(6)) for q in range(states))
    return Transducer(step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The second reads what the first writes; states are pairs, numbered as they are reached from (0, 0)."""
    number, order = {(0, 0): 0}, [(0, 0)]
    step = []
    for p, q in order:
        row = []
        for a in range(6):
            p2, b, w1 = first.step[p][a]
            q2, c, w2 = second.step[q][b]
            if (p2, q2) not in number:
                number[p2, q2] = len(order)
                order.append((p2, q2))
            row.append((number[p2, q2], c, w1 + w2))
        step.append(tuple(row))
    return Transducer(tuple(step))


#: Weights of the four transducers, on top of an entry's own log-odds.
AIMED, NEGATED, REPORTED, AT_A_THREAT = 1.0, -0.5, -0.5, 0.5
NEGATION_REACH = 3
#: Between a threat or an insult and a target after it there may be so many words; both the same, since a threat without a target passes as an insult.
THREAT_REACH = INSULT_REACH = 3
#: Stands for the log-odds of an aimed threat, learned or not: about those of a word in 1,500 toxic texts of 5,000 and in no clean one.
OF_A_THREAT = 8.0


def grammar() -> Transducer:
    """threat after target, or up to three words before it > target anywhere before the insult, or up to three words after it > negation up to three words back > reported speech opened before."""
    aims: dict[tuple[int, int], tuple[int, int, float]] = {(0, TARGET): (1, TARGET, 0.0), (1, THREAT): (1, INSULT, AT_A_THREAT), (0, THREAT): (2, INSULT, 0.0)}
    for q in range(2, THREAT_REACH + 3):  # a threat waits for its target
        aims |= {(q, a): (q + 1 if q <= THREAT_REACH + 1 else 0, a, 0.0) for a in (INSULT, NEGATION, REPORT, OTHER)}
        aims |= {(q, THREAT): (2, INSULT, 0.0), (q, TARGET): (1, TARGET, AT_A_THREAT)}
    threats = transducer(THREAT_REACH + 3, aims)
    later: dict[tuple[int, int], tuple[int, int, float]] = {(0, TARGET): (1, TARGET, 0.0), (1, INSULT): (1, INSULT, AIMED), (0, INSULT): (2, INSULT, 0.0)}
    for q in range(2, INSULT_REACH + 3):  # what has no target yet waits for one
        later |= {(q, a): (q + 1 if q <= INSULT_REACH + 1 else 0, a, 0.0) for a in (NEGATION, REPORT, OTHER, THREAT)}
        later |= {(q, INSULT): (2, INSULT, 0.0), (q, TARGET): (1, TARGET, AIMED)}
    targets = transducer(INSULT_REACH + 3, later)
    moves: dict[tuple[int, int], tuple[int, int, float]] = {(q, NEGATION): (NEGATION_REACH, NEGATION, 0.0) for q in range(NEGATION_REACH + 1)}
    for q in range(1, NEGATION_REACH + 1):
        moves |= {(q, a): (q - 1, a, 0.0) for a in (TARGET, REPORT, OTHER, THREAT)}
        moves[q, INSULT] = (q - 1, NEGATION, NEGATED)  # the insult leaves as a negated one
    negations = transducer(NEGATION_REACH + 1, moves)
    reports = transducer(2, {(0, REPORT): (1, REPORT, 0.0), (1, INSULT): (1, REPORT, REPORTED)})
    return compose(compose(compose(threats, targets), negations), reports)


PLAIN, AIM, NEG, REP = range(4)
FEATURES = 8
#: Negated and reported clauses weigh at most so much of plain ones.
DISCOUNTED = 0.5
#: Where labelled rows say nothing: the intercept, then the weights of plain, aimed, negated and reported clauses' sums and numbers.
PRIOR = [-3.0, 1.0, 2.0, 0.25, 0.25, 0.0, 0.0, 0.0, 0.0]


class Scorer:
    """Finds lexicon entries and threats in a text, runs the grammar over the clauses that hold one, and adds up their weights by sort."""

    def __init__(self, lexicon: dict[str, float], coefficients: list[float] | None = None):
        self.lexicon, self.coefficients, self.machine = lexicon, coefficients, grammar()
        self.finder = ahocorasick.Automaton()
        for entry in {e.rstrip("*") for e in lexicon} | THREAT_WORDS | THREAT_FORMS:
            self.finder.add_word(entry, entry)
        self.finder.make_automaton()

    def weight(self, word: str) -> float:
        best = self.lexicon.get(word, 0.0)
        for n in STEM_LENGTHS:
            if len(word) > n:
                best = max(best, self.lexicon.get(f"{word[:n]}*", 0.0))
        return best

    def clauses(self, low: str) -> Iterator[str]:
        """The clauses with a word that starts like an entry or a threat."""
        done = 0
        for last, entry in self.finder.iter(low):
            at = last - len(entry) + 1
            if at < done or (at and low[at - 1].isalnum()):
                continue
            begin = max(m + 1 for m in (low.rfind(c, done, at) for c in ".!?;\n")) if at > done else at
            begin = max(begin, done)
            m = _CLAUSE.search(low, at)
            done = m.start() if m else len(low)
            yield low[begin:done]

    def features(self, text: str) -> np.ndarray:
        """Sums, by sort, of the clauses' weights and of their numbers, on a scale that grows slowly with long texts."""
        total = np.zeros(FEATURES)
        if not text:
            return total
        for clause in self.clauses(text.lower()):
            state, score, sort = 0, 0.0, -1
            aimed = negated = reported = False
            waiting = (0.0, INSULT, 0.0)
            words = _WORD.findall(clause)
            addressed = not SECOND_PERSON.isdisjoint(words)
            for word in words:
                own = self.weight(word)
                symbol = (
                    THREAT if word in THREAT_WORDS or (addressed and word in THREAT_FORMS) else INSULT if own > 0 else TARGET if word in TARGET_WORDS
                    else NEGATION if word in NEGATION_WORDS else REPORT if word in REPORT_WORDS or word in "\"«»„“”" else OTHER
                )
                state, out, w = self.machine.step[state][symbol]
                if symbol == THREAT and w > 0:
                    own = max(own, OF_A_THREAT)
                elif symbol == THREAT:
                    waiting = (own, out, w)
                elif symbol == TARGET and w == AIMED:  # a waiting insult's, which has been added, or a waiting threat's that is past its reach
                    if sort >= 0:
                        score, aimed = score + w, True
                elif symbol == TARGET and w > 0:  # the waiting threat's; what it was worth unaimed has been added
                    before, out, less = waiting
                    own, w = max(OF_A_THREAT, before), w - before + (0.0 if before > 0 else less)
                if own > 0:
                    score += own + w
                    sort = 0
                    negated, reported, aimed = negated or out == NEGATION, reported or out == REPORT, aimed or w >= AIMED or symbol == TARGET
            if sort >= 0:
                sort = REP if reported else NEG if negated else AIM if aimed else PLAIN
                total[sort] += max(score, 0.0)
                total[4 + sort] += 1.0
        return np.log1p(total)

    def score(self, text: str) -> float:
        c = self.coefficients
        z = c[0] + float(self.features(text) @ np.asarray(c[1:]))
        return 1.0 / (1.0 + math.exp(-max(min(z, 30.0), -30.0)))


def _words(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEM_LENGTHS if len(w) > n}


def choose_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int, tested: int) -> dict[str, float]:
    """Entries far more common in toxic texts than chance allows, over all features tested, with their log-odds."""
    total, out = toxic + clean, []
    if not toxic or not clean:
        return {}
    rate = toxic / total
    needed = math.log(max(tested, 1) / 0.5)
    for feature, t, c in counts:
        n = t + c
        p = t / n
        if p <= 0.85 or t < 3:
            continue
        surprise = n * (p * math.log(p / rate) + ((1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else 0.0))
        if surprise >= needed:
            out.append((t, feature, math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))))
    out.sort(key=lambda x: (-x[0], x[1]))
    return {f: w for _, f, w in out}


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: list[float], held: dict[int, float] | None = None, rounds: int = 200, ridge: float = 0.05) -> list[float]:
    """Newton steps on a few features toward the prior; the intercept comes first and is hardly drawn there.  Weights in ``held`` stay as given."""
    a, held = np.hstack([np.ones((len(x), 1)), x]), held or {}
    w, keep = np.array(prior, float), np.full(a.shape[1], ridge)
    keep[0] = 1e-6
    w[list(held)] = list(held.values())
    free = [k for k in range(a.shape[1]) if k not in held]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a[:, free] * (p * (1 - p))[:, None]).T @ a[:, free] + np.diag(keep[free])
        move = np.linalg.solve(h, a[:, free].T @ (y - p) - keep[free] * (w - prior)[free])
        w[free] += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return w.tolist()


def fit_sorts(x: np.ndarray, y: np.ndarray) -> list[float]:
    """The weights of the sorts: plain ones not below 0, aimed ones not below plain ones, negated and reported ones between 0 and half of these.

    A weight beyond its bound is put there, and the others are fitted again.
    """
    zero: set[int] = set()
    tied: dict[int, float] = {}  # these are so much of the plain weight of their part
    while True:
        columns = x.copy()
        for k, share in tied.items():
            columns[:, k - k % 4] += share * x[:, k]
        w = fit_logistic(columns, y, PRIOR, {k + 1: 0.0 for k in zero | tied.keys()})
        for k, share in tied.items():
            w[k + 1] = share * w[k - k % 4 + 1]
        before = len(zero) + len(tied)
        for k in range(FEATURES):
            own, plain, sort = w[k + 1], w[k - k % 4 + 1], k % 4
            if k in zero or k in tied:
                continue
            if sort != AIM and own < 0:
                zero.add(k)
            elif (sort == AIM and own < plain) or (sort in (NEG, REP) and own > plain * DISCOUNTED):
                tied[k] = 1.0 if sort == AIM else DISCOUNTED
        if len(zero) + len(tied) == before:
            return w


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``text, toxic``: at most ``rows`` labelled texts of each class, none of the held-out fold; each text once.

    The ids are chosen first, so the join carries a bounded set of them to the texts and no text moves that isn't chosen.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    chosen = None
    for k in (0, 1):
        some = usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    picked = id_and_text(docs).join(F.broadcast(chosen), "doc_id")  # at most 2 x ``rows`` rows
    return picked.groupBy(F.sha2("text", 256).alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("h")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Scorer:
    """Learn the lexicon, then the weights of the sorts of clause."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = training_rows(docs, labels, rows).persist()
    try:
        sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        toxic, clean = sizes.get(1, 0), sizes.get(0, 0)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for b in batches:
                for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                    seen[1 if y else 0].update(_words(text))
            names = list(seen[1])  # what no toxic text holds can't become an entry
            yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "t": pa.array([seen[1][x] for x in names], pa.int64()), "c": pa.array([seen[0][x] for x in names], pa.int64())})
            rest = [x for x in seen[0] if x not in seen[1]]
            for at in range(0, len(rest), 50_000):
                part = rest[at : at + 50_000]
                yield pa.RecordBatch.from_pydict({"feature": pa.array(part, pa.string()), "t": pa.array([0] * len(part), pa.int64()), "c": pa.array([seen[0][x] for x in part], pa.int64())})

        per_feature = sample.mapInArrow(count, "feature STRING, t BIGINT, c BIGINT").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t >= 3")
        likely = per_feature.where("t > 0.85 * (t + c)")
        tested = per_feature.count()
        # Words and stems that stand in three toxic texts of the sample at least, and hardly in clean ones: the sample bounds them.
        counts = [(r["feature"], r["t"], r["c"]) for r in likely.collect()]
        scorer = Scorer(choose_lexicon(counts, toxic, clean, tested))

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_pydict({"x": pa.array([scorer.features(t).tolist() for t in b.column("text").to_pylist()], pa.list_(pa.float64())), "toxic": b.column("toxic")})

        described = sample.mapInArrow(describe, "x ARRAY<DOUBLE>, toxic INT").collect()  # at most 2 x ``rows`` rows of 8 numbers
    finally:
        sample.unpersist()
    if toxic and clean:
        x, y = (np.array(v) for v in zip(*[(r["x"], float(r["toxic"])) for r in described], strict=True))
        scorer.coefficients = fit_sorts(x, y)
    else:
        scorer.coefficients = list(PRIOR)
    return scorer


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id, score``: every whole text; nothing else of a row is read.

    A null or empty text scores as one without a matched clause; repeated rows each have their score.
    """
    small_batches(docs.sparkSession)
    lexicon, coefficients = scorer.lexicon, scorer.coefficients

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(lexicon, coefficients)
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "score": pa.array([own.score(t) for t in b.column("text").to_pylist()], pa.float64())})

    return id_and_text(docs).mapInArrow(each, "doc_id BIGINT, score DOUBLE")


def reject_toxic(docs: DataFrame, labels: DataFrame, at: float = 0.5, rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is below ``at``, all columns as they were.

    The score is found where the row is read: nothing is shuffled.
    """
    scorer = train(docs, labels, rows)
    spark = docs.sparkSession
    small_batches(spark)
    lexicon, coefficients, column = scorer.lexicon, scorer.coefficients, docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(lexicon, coefficients)
        for b in batches:
            yield b.filter(pa.array([own.score(t or "") < at for t in b.column(column).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
