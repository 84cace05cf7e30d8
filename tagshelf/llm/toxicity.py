"""Toxicity: a weighted finite-state grammar over clauses, its weights learned from labels.

A lexical transducer turns words into classes: insults and threats with a weight, targets,
negations, words of reported speech. Composed with it are transducers that rewrite an
insult or threat as negated, reported or aimed at a target, depending on what came before
in its clause. What a document scores is a logistic function of the weights of its matched
clauses, by kind. The weights of words and word beginnings, and of the kinds, come from
labelled documents.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..sources.scratch import materialize
from .common import ArrowFunction, by_value, giving_back, id_and_text, texts_of

by_value(__name__)

# Small word lists of the grammar in the languages of the corpus.
TARGETS = frozenset("""you your yours he she they him her them his their we us these those people everyone
    tu toi vous votre il elle ils elles leur eux gens du dich dir ihr euch sie er ihn ihnen leute
    usted ustedes vosotros él ella ellos ellas su gente""".split())
NEGATIONS = frozenset("""not no never none nobody neither nor isn't aren't wasn't weren't don't doesn't didn't
    ne pas jamais aucun aucune nicht nie niemals kein keine keinen nunca jamás tampoco ningún ninguna""".split())
REPORTS = frozenset("""said says saying called calls wrote writes quoted quote reported reports alleged claimed
    dit disait appelé écrit cité sagte sagt nannte schrieb zitierte dijo dice llamó escribió citó""".split())
THREATS = frozenset("""kill murder destroy hurt strangle stab shoot beat burn hang tuer frapper détruire brûler
    töten umbringen schlagen zerstören verbrennen matar golpear destruir quemar""".split())

WORD = r"[\p{L}\p{M}]+(?:['’][\p{L}]+)*"
CLAUSE_END = frozenset(".!?;:\n|")
TOKEN = rf"{WORD}|[.!?;:\n|]"

# Beginnings of words with so many letters are learned like words.
STEMS = range(4, 9)
# A word or beginning is learned if it is in this share of the toxic documents at least,
# and in at least MIN_TOXIC of them. A document has a limited number of words, so this
# also bounds how many candidates there are: words of a document x stems / share.
MIN_SHARE, MIN_TOXIC = 0.004, 3
# Learned if surely so much more frequent in toxic documents, as the logarithm of a ratio
# of odds that is lowered by so many standard errors.
MIN_WEIGHT, DOUBT = 2.5, 1.5
# A beginning has to be in so many times as many toxic documents as any word that has it.
SHARED = 1.5
# At most so many entries, the heaviest first.
MAX_ENTRIES = 20_000

# Words whose weight a task keeps at hand.
KNOWN_WORDS = 200_000

KINDS = ("insult", "aimed_insult", "negated_insult", "reported_insult",
         "threat", "aimed_threat", "negated_threat", "reported_threat")
# What a document is scored by, and the least weight of each. A match counts as one of its kind
# and of those that ask for less: an aimed one is direct, a direct one is a match. So with
# no weight below 0 the order is that of the grammar, whatever the labels say: aimed, direct
# (more by what is here at least), then negated and reported ones; and threats count
# where no label tells of any.
FEATURES = {"insult": 0.0, "direct_insult": 0.5, "aimed_insult": 0.0,
            "threat": 0.0, "direct_threat": 0.5, "aimed_threat": 0.25, "heaviest": 0.0, "matches": 0.0}


class Model(NamedTuple):
    """Weights of words and of beginnings (ended by ``*``); weights of ``FEATURES``; intercept."""

    lexicon: dict[str, float]
    weights: list[float]
    intercept: float


# ---- the grammar -----------------------------------------------------------

class Transducer(NamedTuple):
    """State 0 is the first; a symbol without an entry is passed on and leads to ``rest[state]``."""

    moves: dict[tuple[int, str], tuple[int, str]]
    rest: dict[int, int]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.moves.get((state, symbol)) or (self.rest[state], symbol)


def within(trigger: str, reach: int, renamed: Mapping[str, str]) -> Transducer:
    """Rename symbols up to ``reach`` symbols after a trigger; 0 is for the rest of the clause."""
    if not reach:
        moves = {(s, trigger): (1, trigger) for s in (0, 1)} | {(1, a): (1, b) for a, b in renamed.items()}
        return Transducer(moves, {0: 0, 1: 1})
    moves = {(s, trigger): (reach, trigger) for s in range(reach + 1)}
    moves |= {(s, a): (s - 1, b) for s in range(1, reach + 1) for a, b in renamed.items()}
    return Transducer(moves, {s: max(0, s - 1) for s in range(reach + 1)})


def compose(first: Transducer, second: Transducer, symbols: frozenset[str]) -> Transducer:
    """The transducer that feeds what ``first`` puts out to ``second``."""
    number = {(0, 0): 0}
    moves, rest, todo = {}, {}, [(0, 0)]
    while todo:
        a, b = pair = todo.pop()
        for symbol in symbols:
            to_a, said = first.step(a, symbol)
            to_b, heard = second.step(b, said)
            if (to_a, to_b) not in number:
                number[to_a, to_b] = len(number)
                todo.append((to_a, to_b))
            moves[number[pair], symbol] = (number[to_a, to_b], heard)
        rest[number[pair]] = 0
    return Transducer(moves, rest)


def grammar() -> Transducer:
    """Negation binds first, then reported speech, then the target."""
    symbols = frozenset({"insult", "threat", "target", "negation", "report", "other"})
    negation = within("negation", 3, {"insult": "negated_insult", "threat": "negated_threat"})
    report = within("report", 0, {"insult": "reported_insult", "threat": "reported_threat"})
    target = within("target", 4, {"insult": "aimed_insult", "threat": "aimed_threat"})
    return compose(compose(negation, report, symbols), target, symbols)


def matched(text: str, lexicon: Mapping[str, float], known: dict[str, float], machine: Transducer) -> list[float]:
    """Sums of the weights of a text's matches by kind; the heaviest direct one, and the number of these."""
    lowered = text.lower()
    hits = {w for w in set(regex.findall(WORD, lowered)) if _weight(w, lexicon, known) or w in THREATS}
    found = dict.fromkeys(KINDS, 0.0)
    heaviest, n = 0.0, 0
    if hits:
        state = 0
        for token in regex.findall(TOKEN, lowered):
            if token in CLAUSE_END:
                state = 0
                continue
            state, kind = machine.step(state, _symbol(token, hits, known))
            if kind in found:
                weight = known.get(token) or 1.0
                found[kind] += weight
                if not kind.startswith(("negated", "reported")):
                    heaviest, n = max(heaviest, weight), n + 1
    return [*found.values(), heaviest, n]


def evidence(found: Sequence[float]) -> list[float]:
    """``FEATURES`` of a text from its matches."""
    by_kind = dict(zip(KINDS, found))
    out = []
    for what in ("insult", "threat"):
        aimed = by_kind[f"aimed_{what}"]
        direct = aimed + by_kind[what]
        every = direct + by_kind[f"negated_{what}"] + by_kind[f"reported_{what}"]
        out += [math.log1p(every), math.log1p(direct), math.log1p(aimed)]
    heaviest, n = found[len(KINDS):]
    return [*out, heaviest, math.log1p(n)]


def _symbol(token: str, hits: set[str], known: Mapping[str, float]) -> str:
    if token in hits:
        return "insult" if known.get(token) else "threat"
    if token in NEGATIONS:
        return "negation"
    if token in REPORTS:
        return "report"
    return "target" if token in TARGETS else "other"


def _weight(word: str, lexicon: Mapping[str, float], known: dict[str, float]) -> float:
    """The heaviest of a word and its beginnings, kept in ``known``; grammar words weigh nothing."""
    weight = known.get(word)
    if weight is None:
        if len(known) > KNOWN_WORDS:
            known.clear()
        plain = word in NEGATIONS or word in REPORTS or word in TARGETS
        weight = 0.0 if plain else max(lexicon.get(e, 0.0) for e in entries_of(word))
        known[word] = weight
    return weight


def entries_of(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in STEMS if n <= len(word)]]


# ---- learning --------------------------------------------------------------

def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents that are not ``held_out``.

    ``labels`` is (doc_id, toxic 0 or 1); of repeated ones the largest counts, NULLs do
    not. Texts are the only input. Every labelled document counts; what is gathered on
    the driver are the entries of the lexicon, bounded as said at ``MIN_SHARE``.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    texts = lookup_join(id_and_text(docs).filter(F.col("doc_id").isNotNull() & ~held_out()), known, "doc_id")
    texts = materialize(texts)
    sizes = {row.toxic: row.n for row in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return Model({}, [0.0] * len(FEATURES), 20.0 if n_toxic else -20.0)
    lexicon = _lexicon(texts, n_toxic, n_clean)
    features = materialize(texts.mapInArrow(
        _featurer(lexicon, ["toxic"]), "toxic boolean, features array<double>"))
    table = features.select(F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("features"))
    least = Matrices.dense(1, len(FEATURES), list(FEATURES.values()))
    fitted = LogisticRegression(regParam=1e-3, maxIter=50, lowerBoundsOnCoefficients=least).fit(table)
    # What no labelled text has is left at 0 by the fit.
    weights = [max(w, at_least) for w, at_least in zip(fitted.coefficients.toArray().tolist(), FEATURES.values())]
    return Model(lexicon, weights, float(fitted.intercept))


def _lexicon(texts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    least = max(MIN_TOXIC, math.ceil(MIN_SHARE * n_toxic))
    seen = (texts.filter("toxic").mapInArrow(_counter(None), "entry string, n long")
            .groupBy("entry").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
    toxic = {row.entry: row.n for row in seen.collect()}
    clean = dict.fromkeys(toxic, 0)
    clean.update((row.entry, row.n) for row in texts.filter("not toxic")
                 .mapInArrow(_counter(frozenset(toxic)), "entry string, n long")
                 .groupBy("entry").agg(F.sum("n").alias("n")).collect())
    # A beginning says more than a word only if several words share it.
    of_one: Counter[str] = Counter()
    for word in toxic:
        if not word.endswith("*"):
            for entry in entries_of(word)[1:]:
                of_one[entry] = max(of_one[entry], toxic[word])
    shared = [e for e in toxic if toxic[e] >= SHARED * of_one[e]]
    weights = {e: _surely(toxic[e], n_toxic, clean[e], n_clean) for e in shared}
    best = sorted(((w, e) for e, w in weights.items() if w >= MIN_WEIGHT), reverse=True)[:MAX_ENTRIES]
    return {e: w for w, e in best}


def _surely(toxic: int, n_toxic: int, clean: int, n_clean: int) -> float:
    """The logarithm of the odds ratio, less ``DOUBT`` times its standard error."""
    def odds(n, total):
        return math.log((n + 0.5) / (total - n + 0.5))
    error = math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return odds(toxic, n_toxic) - odds(clean, n_clean) - DOUBT * error


def _counter(wanted: frozenset[str] | None) -> ArrowFunction:
    """(entry, documents that have it), per Arrow batch; only ``wanted`` entries if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in texts_of(batch):
                words = set(regex.findall(WORD, text.decode().lower()))
                found = {e for w in words for e in entries_of(w)}
                counts.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["entry", "n"])
    return giving_back(run)


def _featurer(lexicon: dict[str, float], keep: list[str]) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = grammar(), {}
        for batch in batches:
            rows = [evidence(matched(t.decode(), lexicon, known, machine)) for t in texts_of(batch)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.list_(pa.float64()))], [*keep, "features"])
    return giving_back(run)


# ---- scoring ---------------------------------------------------------------

def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score double from 0 to 1, predicted int) of each row of (doc_id, text).

    Row by row, without a shuffle. A NULL or empty text has no match and the score of a
    text without any. Repeated rows are repeated; no rows give none.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    features = id_and_text(docs).mapInArrow(_featurer(model.lexicon, ["doc_id"]),
                                            f"doc_id {kind}, features array<double>")
    weights = F.array(*[F.lit(float(w)) for w in model.weights])
    total = F.aggregate(F.zip_with("features", weights, lambda x, w: x * w), F.lit(model.intercept), lambda s, x: s + x)
    scored = features.select("doc_id", (1 / (1 + F.exp(-total))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are.

    A text decides for its row: of rows of one id only those with a toxic text go.
    """
    # Columns go to the tasks by place, so that their names cannot clash with anything.
    placed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = placed.mapInArrow(_rejecter(model, docs.columns.index("text")), placed.schema)
    return kept.toDF(*docs.columns)


def _rejecter(model: Model, at: int) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = grammar(), {}
        for batch in batches:
            rows = (evidence(matched(t.decode(), model.lexicon, known, machine)) for t in texts_of(batch, f"c{at}"))
            clean = [sum(map(operator.mul, row, model.weights), model.intercept) < 0 for row in rows]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return giving_back(run)
