"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer turns words into symbols (insult, threat, target, negation,
report, other), an insult or threat with a weight.  Four small transducers rewrite
a clause's symbols in turn: negation denies what follows it closely, reported
speech quotes the rest of the clause, a target next to an insult aims it, a
threat verb before a target becomes a threat.  They are composed into one machine
that scores whole clauses; a document's score is a logistic function of its
clauses' scores.

All is learned from a bounded sample of labelled rows (the first SAMPLE_ROWS by hash of
id): the lexicon's insults, words and stems far commoner in toxic documents than
in others; then what each output symbol of the machine counts for in a clause,
starting from and held near GAIN, so that a symbol the sample lacks keeps its value
there; last the logistic function.  Every document is scored on its whole text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release
from ._util import ALNUM, LOWER, held_out, quoted, table, text_bytes

#: Most labelled rows learned from; how sure a word must be (root of the likelihood ratio) and its least log odds.
SAMPLE_ROWS, LEAST_Z, LEAST_ODDS = 20_000, 4.0, math.log(8)
#: Characters of the stems learned besides whole words; the longest that fits counts.
STEMS = (4, 5, 6)
#: Weight of words listed here that the sample does not know, and the most weight of any.
LISTED_WEIGHT, MOST_WEIGHT = 3.0, 6.0
THRESHOLD = 0.3

#: Words of each symbol, in English, Spanish, French and German.
WORDS = {
    "insult": "idiot idiots idiota idiote moron morons stupid stupide estúpido imbecile imbécil dumb dummkopf trottel scum loser losers pathetic worthless disgusting trash garbage clown fool abschaum connard salaud pendejo",
    "threat": "kill hurt destroy attack beat stab shoot murder töten schlagen verletzen tuer frapper détruire matar golpear destruir",
    "target": "you your yours youre ur he she him her they them these those everyone tu usted ustedes vous toi ils elles du ihr dich euch sie",
    "negation": "not no never nobody none cannot dont didnt isnt arent wasnt doesnt nicht kein keine nie pas jamais nunca jamás ningún",
    "report": "said says saying told claimed claims wrote writes called calls reported quoted quote dijo dice escribió dit écrit sagte sagt schrieb",
}
SYMBOLS = ("insult", "threat", "target", "negation", "report", "other", "denied", "quoted", "aimed", "menace")
#: What a clause's score gains for each symbol, times the word's weight, before anything is learned.
GAIN = {"insult": 1.0, "aimed": 1.5, "menace": 2.0, "threat": 0.25, "denied": 0.3, "quoted": 0.5}
SCORED = {symbol: i for i, symbol in enumerate(GAIN)}
_CLAUSE = re.compile(rb"[.!?;:\n]+")


@dataclass
class Transducer:
    """Deterministic and sequential: (state, symbol) to (next state, symbol, factor); a missing arc keeps the symbol and goes to `otherwise`."""

    arcs: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)
    otherwise: dict[int, int] = field(default_factory=lambda: {0: 0})

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol)) or (self.otherwise[state], symbol, 1.0)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What `second` makes of the output of `first`; factors multiply."""
    number = {(0, 0): 0}
    todo, out = [(0, 0)], Transducer({}, {})
    while todo:
        pair = todo.pop()
        for symbol in SYMBOLS:
            a, middle, x = first.step(pair[0], symbol)
            b, last, y = second.step(pair[1], middle)
            if (a, b) not in number:
                number[a, b] = len(number)
                todo.append((a, b))
            out.arcs[number[pair], symbol] = (number[a, b], last, x * y)
        out.otherwise[number[pair]] = number[pair]
    return out


def _scope(opener: str, changes: dict[str, tuple[str, float]], reach: int | None) -> Transducer:
    """Within `reach` symbols after an opener (None: to the clause's end) symbols change."""
    states = reach or 1
    machine = Transducer({}, {0: 0} | {s: 0 if reach and s == states else s + 1 if reach else s for s in range(1, states + 1)})
    for state in range(states + 1):
        machine.arcs[state, opener] = (1, opener, 1.0)
        for symbol, (new, factor) in changes.items() if state else ():
            machine.arcs[state, symbol] = (machine.otherwise[state], new, factor)
    return machine


def grammar() -> Transducer:
    """Negation, reported speech, threats and targets, composed."""
    negation = _scope("negation", {"insult": ("denied", 1.0), "threat": ("denied", 1.0)}, 3)
    reported = _scope("report", {"insult": ("quoted", 1.0), "threat": ("quoted", 1.0)}, None)
    threats = _scope("threat", {"target": ("menace", 1.0)}, 3)
    targets = _scope("target", {"insult": ("aimed", 1.0)}, 4)
    # a threat's object is the menace; it still is a target for what follows
    targets.arcs |= {(s, "menace"): (1, "menace", 1.0) for s in targets.otherwise}
    return compose(compose(compose(negation, reported), threats), targets)


class Lexicon(dict):
    """Word to (symbol, weight) or None, by the word itself or else its longest stem; remembers what it was asked."""

    def __init__(self, weights: dict[str, float], most: int = 300_000) -> None:
        super().__init__()
        listed = {w: (symbol, LISTED_WEIGHT) for symbol, words in WORDS.items() for w in words.split()}
        learned = {w: ("insult", min(x, MOST_WEIGHT)) for w, x in weights.items()}
        self.known, self.most = listed | {w: (listed[w][0], x[1]) if w in listed else x for w, x in learned.items()}, most

    def __missing__(self, word: bytes) -> tuple[str, float] | None:
        if len(self) >= self.most:
            self.clear()
        text = word.decode(errors="replace")
        keys = (text, *(f"{text[:k]}*" for k in sorted(STEMS, reverse=True) if len(text) >= k))
        found = self[word] = next((self.known[k] for k in keys if k in self.known), None)
        return found


class Scorer:
    """The lexicon composed with the grammar; machine: another grammar than the whole one, for comparison."""

    def __init__(self, weights: dict[str, float], gains: list[float] | None = None, machine: Transducer | None = None) -> None:
        self.lexicon, self.machine = Lexicon(weights), machine or grammar()
        self.gains = np.array(list(GAIN.values()) if gains is None else gains)

    def _matches(self, words: list[bytes]) -> bool:
        return any(x[0] in ("insult", "threat") for x in map(self.lexicon.__getitem__, words) if x is not None)

    def masses(self, words: list[bytes]) -> list[float]:
        """Weight of each scored symbol that the machine puts out for a clause."""
        state, total, held = 0, [0.0] * len(SCORED), LISTED_WEIGHT
        for word in words:
            symbol, weight = self.lexicon[word] or ("other", 1.0)
            if symbol == "threat":
                held = weight
            state, out, factor = self.machine.step(state, symbol)
            if out in SCORED:
                total[SCORED[out]] += factor * (held if out == "menace" else weight)
        return total

    def clause(self, words: list[bytes]) -> float:
        return float(np.array(self.masses(words)) @ self.gains)

    def clauses(self, text: bytes) -> np.ndarray:
        """masses() of each clause that matches, a row each."""
        rows = []
        if self._matches(text.translate(ALNUM).split()):
            for part in _CLAUSE.split(text.translate(LOWER)):
                words = part.translate(ALNUM).split()
                if self._matches(words):
                    rows.append(self.masses(words))
        return np.array(rows).reshape(-1, len(SCORED))

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Best clause, all clauses and number of clauses that match, the last two by logarithm."""
        scores = self.clauses(text) @ self.gains
        return (float(scores.max()), math.log1p(scores.sum()), math.log1p(len(scores))) if len(scores) else (0.0, 0.0, 0.0)


def _stems(words: Column, k: int) -> Column:
    return F.transform(F.filter(words, lambda x: F.length(x) >= k), lambda x: F.concat(F.substring(x, 1, k), F.lit("*")))


def learn_words(docs: DataFrame, text_col: str, label_col: str) -> dict[str, float]:
    """Log odds ratios of words and stems (`stem*`) that speak for label 1.

    docs: a bounded sample.  Documents that share a MinHash over three-word shingles (near
    copies, as a rule) count as one between them, each with its own label and words.
    """
    lower = F.translate(F.coalesce(quoted(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    w = F.col("words")
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    # written, so that no filter on the join's key moves below the array functions
    each = materialize(docs.select(words.alias("words"), quoted(label_col).cast("double").alias("y")).withColumn("group", F.array_min(shingles)))
    held = each.groupBy("group").agg((1.0 / F.count("*")).alias("part"))  # no more rows than the sample, hence the broadcast
    each = each.join(F.broadcast(held), "group")
    patterns = F.array_distinct(F.concat(w, *(_stems(w, k) for k in STEMS)))
    count = each.agg(F.sum(F.col("y") * F.col("part")), F.sum((1 - F.col("y")) * F.col("part"))).first()
    ones, rest = count[0] or 0.0, count[1] or 0.0
    if not ones or not rest:
        return {}
    tally = each.select(F.explode(patterns).alias("word"), "y", "part").groupBy("word").agg(F.sum(F.col("y") * F.col("part")).alias("a"), F.sum((1 - F.col("y")) * F.col("part")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / F.lit(ones + 1.0)) - F.log((F.col("b") + 0.5) / F.lit(rest + 1.0))
    n, share = F.col("a") + F.col("b"), ones / (ones + rest)
    part = lambda c, p: F.when(c > 0, c * F.log(c / (n * F.lit(p)))).otherwise(0.0)
    sure = F.sqrt(F.greatest(2 * (part(F.col("a"), share) + part(F.col("b"), 1 - share)), F.lit(0.0)))
    return {r.word: r.w for r in tally.where((odds >= LEAST_ODDS) & (sure >= LEAST_Z)).select("word", F.round(odds, 9).alias("w")).collect()}


def learn_gains(masses: np.ndarray, y: np.ndarray) -> list[float]:
    """What each scored symbol counts for, from the masses of whole documents: a logistic fit held near GAIN, none below 0.

    The unit is what a plain insult counts for by GAIN, so gains stay comparable with it.
    """
    prior = np.array(list(GAIN.values()))
    unit = fit_logistic((masses @ prior)[:, None], y)
    if unit[1] <= 0:
        return prior.tolist()
    return np.maximum(fit_logistic(masses, y, around=np.concatenate((unit[:1], unit[1] * prior)))[1:] / unit[1], 0.0).tolist()


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, around: np.ndarray | None = None) -> np.ndarray:
    """Intercept and coefficients, by Newton steps that are halved until they help; a ridge keeps separable classes finite, or all near `around`."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    x = np.column_stack((np.ones(len(x)), x / scale))
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    centre = np.zeros(x.shape[1]) if around is None else around * np.concatenate(([1.0], scale))
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + (w - centre) @ penalty @ (w - centre) / 2
    w = centre.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ (w - centre))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w / np.concatenate(([1.0], scale))


@dataclass
class Model:
    words: dict[str, float]
    coefficients: list[float]
    gains: list[float] = field(default_factory=lambda: list(GAIN.values()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS, machine: Transducer | None = None) -> Model:
    """Learn from at most `rows` labelled documents, those of smallest hash of id; of documents with one id the one of smallest hash of text.

    Null ids and null labels teach nothing; an id labelled twice counts as 1 if it is
    1 anywhere.  Without both labels present the lexicon is the fixed one and
    every document without a match scores the labels' mean (0 without labels).
    What reaches the driver are words that pass both bounds and a few numbers for each row.
    """
    known = labels.select(quoted(id_col).alias("__id"), quoted(label_col).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)").groupBy("__id").agg(F.max("__y").alias("__y"))
    sample = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)  # bounded by `rows`, hence the broadcast
    text = F.coalesce(quoted(text_col), F.lit(""))
    found = docs.select(quoted(id_col).alias("__id"), text.alias("__text")).join(F.broadcast(sample), "__id")
    mine = materialize(found.groupBy("__id").agg(F.max("__y").alias("__y"), F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text")))
    words = learn_words(mine, "__text", "__y")

    def measured(gains: list[float] | None) -> tuple[np.ndarray, np.ndarray]:
        got = mine.mapInArrow(_measure(words, gains, machine), "x array<double>, y int").toArrow()
        x = np.array(got.column("x").to_pylist(), float).reshape(got.num_rows, len(SCORED) if gains is None else 3)
        return x, got.column("y").to_numpy().astype(float)

    try:
        masses, y = measured(None)
        if not len(y):
            return Model(words, [-30.0, 5.0, 1.0, 1.0])
        if y.min() == y.max():
            p = min(max(float(y.mean()), 1e-9), 1 - 1e-9)
            return Model(words, [math.log(p / (1 - p)), 0.5, 0.5, 0.0])
        gains = learn_gains(masses, y)
        x, y = measured(gains)
        return Model(words, fit_logistic(x, y).tolist(), gains)
    finally:
        release(mine)


def _measure(words: dict[str, float], gains: list[float] | None, machine: Transducer | None):
    """x: without gains the masses of a whole document, else its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(words, gains, machine)
        for batch in batches:
            texts = text_bytes(batch.column("__text"))
            x = [scorer.clauses(t).sum(axis=0).tolist() if gains is None else list(scorer.features(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("__y")], ["x", "y"])

    return run


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None, machine: Transducer | None = None) -> DataFrame:
    """docs with score (double, 0 to 1) and predicted (int, 1 at the threshold or above).

    A null or empty text has no clause and scores what every text without a
    match does; texts of any length are scored whole.  Repeated rows get a row each,
    and rows with one text the same score.  An empty table gives no rows.  Columns of docs
    with one of the new names are replaced.  keep: the columns to return, all if None.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    frame = docs.select(F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"), quoted(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, w = Scorer(model.words, model.gains, machine), np.array(model.coefficients)
        for batch in batches:
            x = np.array([scorer.features(t) for t in text_bytes(batch.column("text"))], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30))))], ["row", "score"])

    out = frame.mapInArrow(run, frame.select("row").schema.add("score", "double"))
    return out.select(*(F.col("row")[c].alias(c) for c in kept), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4, 2))
    out = score_toxicity(docs, train(docs, labels), keep=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
