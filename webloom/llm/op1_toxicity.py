"""Toxicity by a weighted finite-state pattern grammar.

A lexicon of insults (words and word beginnings, with weights) is learned from labels. One
automaton over characters finds its entries in a text; each clause with a match, and each
with a threat word, is then read token by token by one machine, the composition of weighted transducers for negation, reported
speech and targets. It is built once: its states are the reachable combinations of theirs, an arc's weight is the product
of theirs and its output the first of theirs in that order. Negation and reported
speech discount what they cover, a target beside an insult or threat strengthens it. A clause says what its heaviest path
through an insult or threat puts out. So it is clauses that are scored, by what they say, and a document's score is a logistic function
of its matched clauses by kind. The weights of the kinds are fitted to labels as well, drawn
to the grammar's prior weights.

Learning uses at most ``POSITIVES`` and ``NEGATIVES`` labelled documents, those of least id
hash: a bounded sample, in which near copies count once. Scoring is one scan of all texts, whole, without a shuffle; the
model has the entries that the sample gives evidence of, and is broadcast.

Null and empty texts have no clauses and get the score of the intercept. A label that
repeats counts once; null labels are not learned from. Without a positive label nothing is
toxic: all scores are 0. Repeated rows get equal scores. Other columns are kept by ``score``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.storage import join_checked, stored

POSITIVES, NEGATIVES = 4000, 8000
LEAST = 3  # labelled texts with an entry
HELD = 50_000  # entries that a task holds while it counts
BEGINNINGS = (4, 5, 6, 7)  # lengths of word beginnings that may be entries
THRESHOLD = 0.3
SCORE = "_toxicity"
GAIN = 30.0  # likelihood ratio of an entry: one chance find in tens of millions

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»]")
_CLAUSE_END = re.compile(r"[.!?;:,\n]")

# Word classes of the grammar, in the languages served.
TARGETS = frozenset("you your yours you're he she him her they them du dich dir ihr euch sie tu te toi vous il elle ils usted ustedes él ella ellos".split())
# stems of threats: a word of at most LONGER letters more is one, too
THREATS = frozenset("kill hurt murder stab shoot strangl töt ermord erschieß umbring umgebracht tuer étrangl frapp assassin matar golpea asesin".split())
NEGATIONS = frozenset("not never no isn't aren't wasn't don't doesn't didn't nobody nicht kein keine nie jamais pas nunca jamás".split())
REPORTS = frozenset("said say told tell call quot wrote writ claim sagt nannt nennt behaupt schrieb disait appel écrit prétend dijo dice llam escrib".split())
LONGER = 4

KINDS = ("plain", "targeted", "negated", "reported", "threat")
# Entries that clean texts hold at times are weak: what counts is how dense their clauses are.
STRONG = 1.0
FEATURES = (*KINDS, "weak", "dense")
PRIOR = np.array([6.0, 7.0, 2.0, 2.0, 6.0, 1.0, 4.0])  # weights before labels are seen
DENSE_CHARS = 300
PRIOR_STRENGTH = 0.5
START = -3.0


def sketch(text: str | None) -> int:
    """Least hash of three neighbouring words: near copies mostly share it, other texts do not."""
    words = _WORD.findall((text or "").lower())
    grams = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return min(zlib.crc32(g.encode()) << 32 | zlib.adler32(g.encode()) for g in grams) >> 1


def words_of(text: str) -> set[str]:
    """Entries that a text could match: its words, marked ``=``, and their beginnings."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add("=" + word)
        for n in BEGINNINGS:
            if len(word) > n:
                found.add(word[:n])
    return found


def choose_entries(counts: pd.DataFrame, positives: int, negatives: int) -> dict[str, float]:
    """Weighted lexicon from the document counts (entry, pos, neg) of features."""
    if not positives or not negatives or counts.empty:
        return {}
    c = counts.assign(pos=counts.pos.astype(float), neg=counts.neg.astype(float))
    rate = (c.pos + c.neg) / (positives + negatives)
    gain = 2 * (
        c.pos * np.log(np.maximum(c.pos, 0.5) / (rate * positives))
        + c.neg * np.log(np.maximum(c.neg, 0.5) / (rate * negatives))
    )
    odds = np.log((c.pos + 0.5) / (positives + 1)) - np.log((c.neg + 0.5) / (negatives + 1))
    c = c.assign(odds=odds, gain=gain)[(odds > 2) & (c.pos >= LEAST) & (gain > GAIN)]
    entries: dict[str, float] = {}
    for e in c.sort_values(["gain", "entry"], ascending=[False, True]).itertuples():
        plain = e.entry.lstrip("=")
        if not any(plain[:n] in entries for n in BEGINNINGS if n <= len(plain)):
            entries[e.entry] = float(min(1.5, e.odds / 4))
    return entries


# --- the grammar ------------------------------------------------------------------------


CLASSES = "IHYNRQW"  # insult, threat, target, negation, report, quotation mark, other word


@dataclass(frozen=True)
class Transducer:
    """A weighted machine over word classes. Arcs: (state, class) -> (state, output, weight). A word class without
    an arc leads to ``otherwise[state]``, puts out nothing and weighs 1. The start is state 0."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    otherwise: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, kind: str) -> tuple[int, str, float]:
        return self.arcs.get((state, kind)) or (self.otherwise.get(state, state), "", 1.0)

    def compose(self, other: Transducer) -> Transducer:
        """Both at once, over their reachable pairs of states: weights multiply, and this one's output goes first."""
        names, arcs, waiting = {(0, 0): 0}, {}, [(0, 0)]
        while waiting:
            pair = waiting.pop()
            for kind in CLASSES:
                (a, said, x), (b, told, y) = self.step(pair[0], kind), other.step(pair[1], kind)
                if (a, b) not in names:
                    names[a, b] = len(names)
                    waiting.append((a, b))
                arcs[names[pair], kind] = names[a, b], said or told, x * y
        return Transducer(arcs)


# After a negation, an insult or threat within three words is denied.
NEGATION = Transducer(
    {**{(s, "N"): (3, "", 1.0) for s in range(4)}, **{(s, k): (0, "negated", 1 / 3) for s in (1, 2, 3) for k in "IH"}},
    {3: 2, 2: 1, 1: 0},
)
# After a word of saying, or within quotation marks, what follows in the clause is reported.
REPORT = Transducer({
    (0, "R"): (1, "", 1.0), (0, "Q"): (2, "", 1.0), (2, "Q"): (0, "", 1.0), **{(s, k): (s, "reported", 1 / 3) for s in (1, 2) for k in "IH"},
})
# A target up to four words before an insult or threat is addressed.
TARGET = Transducer(
    {**{(s, "Y"): (4, "", 1.0) for s in range(5)}, **{(s, k): (s, "targeted", 7 / 6) for s in (1, 2, 3, 4) for k in "IH"}},
    {4: 3, 3: 2, 2: 1, 1: 0},
)
CLAUSE = NEGATION.compose(REPORT).compose(TARGET)


def read_clause(tokens: list[tuple[str, float]], machine: Transducer = CLAUSE) -> tuple[str, float]:
    """Kind and weight of a clause of (class, weight): what its heaviest insult or threat puts out. A threat counts
    only in a clause with a target."""
    state, best, kind, own = 0, 0.0, "", 0.0
    addressed = any(c == "Y" for c, _ in tokens)
    for c, weight in tokens:
        state, said, factor = machine.step(state, c)
        if c == "I" or c == "H" and addressed:
            if c == "H" and said in ("", "targeted"):
                said = "threat"
            if weight * factor > best:
                best, kind, own = weight * factor, said or "plain", weight
    return kind, own


def _stem_in(word: str, stems: frozenset[str]) -> bool:
    return any(word[:n] in stems for n in range(max(3, len(word) - LONGER), len(word) + 1))


class Grammar:
    """Finds the clauses of a text that match, by one pass of the lexicon's automaton."""

    def __init__(self, entries: dict[str, float]):
        self.entries = entries
        self.automaton = ahocorasick.Automaton()
        for entry, weight in entries.items():
            plain = entry.lstrip("=")
            known = self.automaton.get(plain, (0, 0.0, 0.0))
            whole = entry.startswith("=")
            self.automaton.add_word(plain, (len(plain), weight if whole else known[1], known[2] if whole else weight))
        for word in THREATS:  # stems: where a longer word begins with one, ``token`` decides
            known = self.automaton.get(word, (0, 0.0, 0.0))
            self.automaton.add_word(word, (len(word), known[1], known[2] or 1.0))
        self.automaton.make_automaton()

    def places(self, text: str):
        for end, (n, whole, beginning) in self.automaton.iter(text):
            first = end - n + 1
            if first and (text[first - 1].isalpha() or text[first - 1] in "'’" and first > 1 and text[first - 2].isalpha()):
                continue
            inner = end + 1 < len(text) and text[end + 1].isalpha()
            if not inner or beginning:
                yield first

    def token(self, word: str) -> tuple[str, float]:
        weight = self.entries.get("=" + word, 0.0)
        for n in BEGINNINGS:
            if len(word) >= n:
                weight = max(weight, self.entries.get(word[:n], 0.0))
        if weight:
            return "I", weight
        for kind, members in (("Y", TARGETS), ("N", NEGATIONS)):
            if word in members:
                return kind, 1.0
        for kind, stems in (("H", THREATS), ("R", REPORTS)):
            if _stem_in(word, stems):
                return kind, 1.0
        return ("Q", 0.0) if word in '"“”«»' else ("W", 0.0)

    def kinds(self, text: str | None) -> np.ndarray:
        """Weight of the matched clauses of a text by kind, then of the weak ones, whole and per length."""
        total = np.zeros(len(FEATURES))
        if not text:
            return total
        lower = text.lower().replace("’", "'")
        behind = 0
        for at in self.places(lower):
            if at < behind:
                continue
            first = at
            while first > behind and lower[first - 1] not in ".!?;:,\n":
                first -= 1
            end = _CLAUSE_END.search(lower, at)
            behind = end.end() if end else len(lower)
            kind, weight = read_clause([self.token(t) for t in _TOKEN.findall(lower, first, behind)])
            if kind and weight >= STRONG:
                total[KINDS.index(kind)] += weight
            elif kind:
                total[5] += weight * PRIOR[KINDS.index(kind)] / PRIOR[0]
        total[6] = total[5] / (1 + len(lower) / DENSE_CHARS)
        return total


def saturated(totals: np.ndarray) -> np.ndarray:
    return 1 - np.exp(-2 * totals)


@dataclass
class Model:
    entries: dict[str, float]
    weights: np.ndarray
    intercept: float

    def scores(self, totals: np.ndarray) -> np.ndarray:
        if not self.entries:
            return np.zeros(len(totals))
        return 1 / (1 + np.exp(-(self.intercept + saturated(totals) @ self.weights)))


def fit_kinds(totals: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights of the kinds by Newton steps, drawn to the prior."""
    x = np.c_[saturated(totals), np.ones(len(totals))]
    prior = np.r_[PRIOR, START]
    strength = np.r_[np.full(len(PRIOR), PRIOR_STRENGTH), 0.01]
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - strength * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(strength), slope)
        w = w + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


# --- on Spark ----------------------------------------------------------------------------


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, positives: int, negatives: int) -> DataFrame:
    """At most so many ids of either label, those of least hash."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    return known.filter("label = 1").orderBy(*order).limit(positives).unionAll(
        known.filter("label = 0").orderBy(*order).limit(negatives)
    )


def _entry_counts(texts: DataFrame) -> DataFrame:
    """``entry, pos, neg``: texts of either label that hold an entry, of entries with at least ``LEAST`` of label 1.

    Those are counted first, so only few entries are counted in the other texts. Counters are handed on as
    soon as they have ``HELD`` entries, however long the texts are.
    """
    def count(batches):
        held = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(words_of(text or ""))
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["entry", "n"])
                    held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["entry", "n"])

    def of(label: int) -> DataFrame:
        return texts.filter(F.col("label") == label).select("text").mapInArrow(count, "entry string, n bigint")

    pos = stored(of(1).groupBy("entry").agg(F.sum("n").alias("pos")).filter(F.col("pos") >= LEAST))
    neg = join_checked(of(0), pos.select("entry"), ["entry"], "left_semi").groupBy("entry").agg(F.sum("n").alias("neg"))
    both = pos.join(neg, "entry", "left").fillna(0, "neg")
    # an entry of no more positives than negatives cannot be chosen
    return both.filter(F.col("pos") > F.col("neg"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Lexicon and weights from a bounded sample of the labelled documents given."""
    sample = labelled_sample(labels, label, POSITIVES, NEGATIVES)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # one text of each group of near copies, so that a word's count is of independent texts
    sketched = F.pandas_udf(lambda texts: texts.map(sketch), "bigint")
    texts = stored(
        texts.withColumn("sketch", sketched("text")).groupBy("sketch", "label")
        .agg(F.min_by("text", F.struct("doc_id", F.xxhash64("text"))).alias("text"))
    )

    counts = _entry_counts(texts)
    seen = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    if not seen.get(0) or not seen.get(1):
        return Model({}, PRIOR, START)
    entries = choose_entries(counts.toPandas(), seen[1], seen[0])

    def read(batches):
        grammar = Grammar(entries)
        for batch in batches:
            rows = np.array([grammar.kinds(t) for t in batch["text"]]).reshape(-1, len(FEATURES))
            yield pd.DataFrame(rows, columns=FEATURES).assign(label=batch["label"].to_numpy())

    read_schema = ", ".join(f"{k} double" for k in FEATURES)
    found = texts.mapInPandas(read, f"{read_schema}, label int").groupBy(*FEATURES, "label").count().toPandas()
    found = found.sort_values([*FEATURES, "label"]).loc[lambda t: t.index.repeat(t["count"])]
    weights, intercept = fit_kinds(found[list(FEATURES)].to_numpy(), found["label"].to_numpy())
    return Model(entries, weights, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the column ``SCORE``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.entries, model.weights, model.intercept))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        own = Model(*shared.value)
        grammar = Grammar(own.entries)
        return pd.Series(own.scores(np.array([grammar.kinds(t) for t in texts]).reshape(-1, len(FEATURES))))

    return docs.withColumn(SCORE, scored.asNondeterministic()(F.col("text")))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and decision of each document; labels of the held-out quarter are not used."""
    docs = docs.select("doc_id", "text")
    model = train(docs, labels.filter(~held_out(F.col("doc_id"), 4, 2)))
    scored = score(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Documents below the threshold, with all their columns."""
    return score(docs, model).filter(F.col(SCORE) < THRESHOLD).drop(SCORE)
