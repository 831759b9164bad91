"""Toxicity scores from a learned lexicon that also catches misspelled terms.

The lexicon holds whole words and stems which labelled toxic documents use and clean
ones do not.  It is kept as a trie; the Levenshtein automaton of each term and the
trie form one automaton, whose states are built as texts need them.  Every hit gets
a context score: hits in quotation marks or after words that report speech count
apart from plain hits, and the densest window of plain hits counts too.  A logistic
model on those counts gives the score.

How it runs: lexicon and model are fitted on a bounded sample of labelled rows
(``SAMPLE_ROWS``, the lowest hashes of their ids).  Scoring is one pass over all
documents without a shuffle; lexicon and model are bounded by the sample.

Defined cases: a null or empty text has no hit and gets the model's lowest score;
without labelled rows of both classes the lexicon is ``extra_terms`` and the model
its starting point; several labels of one id count as toxic if one does; a null
label is no label; repeated documents are scored each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import WORD_BYTES, batches, col, trimmed, unused, words, written

#: Labelled rows used for fitting, at most.
SAMPLE_ROWS = 12_000
#: Words before and after a hit that count as its context.
WINDOW = 12
#: Words that report speech (English, German, French, Spanish).
REPORTING = frozenset(w.encode() for w in (
    "said says saying wrote quote quoted quotes called named word term insult slur "
    "sagte sagt schrieb zitat nannte wort dit disait cite citation mot "
    "dijo dice cita palabra").split())
_QUOTED = re.compile(rb'"[^"\n]*"|\xe2\x80\x9c[^\n]*?\xe2\x80\x9d|\xe2\x80\x9e[^\n]*?\xe2\x80\x9c'
                     rb"|\xc2\xab[^\n]*?\xc2\xbb")
#: Starting point of the model: bias, plain hits, misspelled hits, quoted hits, densest window.
#: One plain hit is over 0.5, a quoted one is not.
PRIOR = np.array([-4.0, 6.5, 5.5, 0.8, 0.5])
FEATURES = ["plain", "misspelled", "quoted", "densest"]


def edits_allowed(term: str, support: int = 1 << 30) -> int:
    """Edits a misspelling of a term may have: short or rare terms must match."""
    n = len(term)
    return 0 if n < 5 or support < 20 else 1 if n < 8 else 2


class LexiconAutomaton:
    """Trie of terms crossed with their Levenshtein automata, states made on demand.

    ``terms`` maps a term to (is a stem, edits allowed).  A stem matches any word
    that begins with it, without edits.  States hold ``HELD`` places in the trie
    together, at most; beyond it they are dropped and made anew as words need them."""

    HELD = 200_000

    def __init__(self, terms: dict[str, tuple[bool, int]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[bool, int]] = {}
        self.reach = [0]  # most edits that a term below allows
        for term, (stem, edits) in terms.items():
            at = 0
            self.reach[0] = max(self.reach[0], edits)
            for ch in term:
                nxt = self.children[at].get(ch)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[at][ch] = nxt
                    self.children.append({})
                    self.reach.append(0)
                at = nxt
                self.reach[at] = max(self.reach[at], edits)
            old = self.ends.get(at, (False, 0))
            self.ends[at] = (old[0] or stem, max(old[1], edits))
        self._start = self._closed({(0, 0)})
        self._forget()

    def _forget(self) -> None:
        self.states = {self._start: 0}
        self.sets = [self._start]
        self.moves: list[dict[str, int]] = [{}]
        self.accepts = [self._accept(self._start)]
        self.held = len(self._start)

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        """With all skips of term letters, and for each node the fewest edits."""
        best: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, e = todo.pop()
            if node >= 0 and e > self.reach[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            if node >= 0:
                todo.extend((child, e + 1) for child in self.children[node].values())
        return frozenset(best.items())

    def _accept(self, items: frozenset) -> int:
        """Edits of the best term that ends here; -1 for none."""
        best = 99
        for node, e in items:
            if node == -1:
                return 0
            if node in self.ends and e <= self.ends[node][1]:
                best = min(best, e)
        return best if best < 99 else -1

    def _step(self, state: int, ch: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            if node == -1:  # inside a word that began with a stem
                out.add((-1, 0))
                continue
            child = self.children[node].get(ch)
            if child is not None:
                out.add((child, e))
            if e < self.reach[node]:  # an edit that some term below allows
                out.add((node, e + 1))
                out.update((child, e + 1) for child in self.children[node].values())
        out |= {(-1, 0) for node, e in out if e == 0 and self.ends.get(node, (False,))[0]}
        items = self._closed(out)
        if not items:
            target = -1
        elif items in self.states:
            target = self.states[items]
        else:
            target = len(self.sets)
            self.states[items] = target
            self.sets.append(items)
            self.moves.append({})
            self.accepts.append(self._accept(items))
            self.held += len(items)
        self.moves[state][ch] = target
        return target

    def edits(self, word: str) -> int:
        """Fewest edits from the word to a term that allows them; -1 for none."""
        if self.held > self.HELD:
            self._forget()
        state, moves = 0, self.moves
        for ch in word:
            nxt = moves[state].get(ch)
            if nxt is None:
                nxt = self._step(state, ch)
            if nxt < 0:
                return -1
            state = nxt
        return self.accepts[state]


class Scanner:
    """Counts a text's hits.  ``innocent``: words near a term that clean texts use."""

    CACHE = 100_000

    def __init__(self, terms: dict[str, tuple[bool, int]], innocent: set[bytes]):
        self.terms, self.innocent = terms, innocent
        self._ready()

    def _ready(self):
        self.automaton = LexiconAutomaton(self.terms)
        self.known: dict[bytes, int] = {w: -1 for w in self.innocent}

    def __getstate__(self):
        return {"terms": self.terms, "innocent": self.innocent}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        w = words(text)
        known = self.known
        fresh = set(w).difference(known)
        if fresh:
            if len(known) + len(fresh) > self.CACHE:
                self.known = known = {x: -1 for x in self.innocent}
                fresh = set(w).difference(known)
            edits = self.automaton.edits
            for x in fresh:
                known[x] = edits(x.decode("utf-8", "replace"))
        at = [k for k, x in enumerate(w) if known[x] >= 0]
        if not at:
            return (0.0, 0.0, 0.0, 0.0)
        quoted = self._quoted(text, w, at)
        plain = [k for k in at if k not in quoted]
        exact = sum(known[w[k]] == 0 for k in plain)
        densest = first = 0
        for k, x in enumerate(plain):  # the window that ends here begins at first
            while x - plain[first] > WINDOW:
                first += 1
            densest = max(densest, k + 1 - first)
        return (math.log1p(exact), math.log1p(len(plain) - exact), math.log1p(len(quoted)),
                math.log1p(densest))

    def _quoted(self, text: str, w: list[bytes], at: list[int]) -> set[int]:
        data = text.encode("utf-8", "surrogatepass")
        spans = [m.span() for m in _QUOTED.finditer(data)]
        out = {k for k in at if any(x in REPORTING for x in w[max(0, k - 4):k])}
        if spans:
            flags = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32
            starts = np.flatnonzero(np.diff(np.concatenate(([0], flags))) == 1)
            begins = [a for a, _ in spans]
            for k in at:
                i = int(np.searchsorted(begins, starts[k], side="right")) - 1
                if i >= 0 and starts[k] < spans[i][1]:
                    out.add(k)
        return out


# -- fitting ---------------------------------------------------------------------

def _word_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, clean documents, context) of a part of the sample.
    Contexts tell real uses of a word from copies of one text."""
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64()),
                        ("context", pa.int64())])

    def rows():
        for part in parts:
            clean: Counter[bytes] = Counter()
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                w = words(text)
                if not toxic:
                    clean.update(set(w))
                    continue
                first = {x: k for k, x in reversed(list(enumerate(w)))}
                for x, k in first.items():
                    around = b" ".join(w[max(0, k - 1):k] + w[k + 1:k + 2])
                    yield (x.decode("utf-8", "replace"), 1, 0,
                           int.from_bytes(around[-6:].rjust(6, b"."), "big"))
            for x, n in clean.items():
                yield x.decode("utf-8", "replace"), 0, n, None

    yield from batches(rows(), schema, 50_000)


def labelled_sample(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id",
                    text: str = "text", toxic: str = "toxic", held_out: int = 5,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents (text, toxic) that are not held out."""
    named = (labels.select(col(doc_id).alias("doc_id"), col(toxic).cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .where(F.crc32(F.col("doc_id").cast("string")) % held_out != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
            .join(F.broadcast(named), "doc_id")  # ``rows`` ids at most
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .select("text", "toxic"))


def learn_lexicon(sample: DataFrame, extra_terms: dict[str, tuple[bool, int]] | None = None
                  ) -> tuple[dict[str, tuple[bool, int]], set[bytes]]:
    """Terms, and the words of clean texts that misspelling would confuse with them."""
    counts = (sample.mapInArrow(trimmed(_word_rows), "word string, toxic long, clean long, context long")
              .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                                   F.count_distinct("context").alias("uses")))
    counts = written(counts)
    pure = F.col("toxic") >= 4 * F.col("clean")
    terms = {r["word"]: (False, edits_allowed(r["word"], r["toxic"])) for r in
             counts.where(pure & (F.col("toxic") >= 5) & (F.col("uses") >= 5)
                          & (4 * F.col("uses") >= F.col("toxic")) & (F.length("word") > 2))
             .collect()}  # each is in five sampled documents or more
    # Stems: prefixes of which nearly every word is toxic, with several letters following.
    prefixes = F.explode(F.transform(F.sequence(F.lit(3), F.least(F.lit(9), F.length("word") - 1)),
                                     lambda n: F.substring("word", F.lit(1), n)))
    stems = (counts.where(F.length("word") > 3)
             .select(prefixes.alias("stem"), "word", "toxic", "clean", "uses")
             .groupBy("stem").agg(
                 F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                 F.count("*").alias("n"), F.count_if(pure).alias("pure_words"), F.sum("uses").alias("uses"),
                 F.count_distinct(F.substring("word", F.length("stem") + 1, F.lit(1))).alias("ways"))
             .where(pure & (F.col("toxic") >= 8) & (F.col("uses") >= 8) & (F.col("n") >= 4)
                    & (F.col("pure_words") >= 0.9 * F.col("n"))
                    & (F.col("ways") >= 3))
             .collect())
    found = {r["stem"] for r in stems}
    begins = lambda t, n: any(t[:k] in found for k in range(1, n))
    # The shortest stem of several that extend each other.
    chosen = [s for s in sorted(found) if not begins(s, len(s))]
    terms = {t: v for t, v in terms.items() if not begins(t, len(t) + 1)}
    terms |= {s: (True, 0) for s in chosen}
    terms |= extra_terms or {}
    automaton = LexiconAutomaton(terms)

    def confused(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            near = [x for x in part.column(0).to_pylist() if automaton.edits(x) > 0]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["word"])

    innocent = counts.where("clean > 0").select("word").mapInArrow(trimmed(confused), "word string").collect()
    return terms, {r["word"].encode() for r in innocent}


def fit(features: np.ndarray, toxic: np.ndarray, strength: float = 2.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards ``PRIOR``."""
    w = PRIOR.copy()
    if len(set(toxic.tolist())) < 2:
        return w
    x = np.column_stack([np.ones(len(features)), features])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (toxic - p) - strength * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    # More hits never lower a score.
    w[1:] = np.maximum(w[1:], 0.0)
    return w


class ToxicityModel:
    def __init__(self, scanner: Scanner, weights: Iterable[float]):
        self.scanner, self.weights = scanner, [float(v) for v in weights]

    def score(self, text: str | None) -> float:
        w = self.weights
        z = w[0] + sum(a * b for a, b in zip(w[1:], self.scanner.features(text)))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def train(docs: DataFrame, labels: DataFrame, *, extra_terms=None, **options) -> ToxicityModel:
    sample = written(labelled_sample(docs, labels, **options))
    terms, innocent = learn_lexicon(sample, extra_terms)
    scanner = Scanner(terms, innocent)

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            got = [scanner.features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(g[k]) for g in got], pa.float64()) for k in range(4)]
                + [part.column("toxic").cast(pa.int32())], names=[*FEATURES, "toxic"])

    rows = sample.mapInArrow(trimmed(measure), ", ".join(f"{f} double" for f in FEATURES) + ", toxic int")
    got = sorted(tuple(r) for r in rows.collect())  # SAMPLE_ROWS rows of five numbers at most
    x = np.array(got, float).reshape(len(got), 5)
    return ToxicityModel(scanner, fit(x[:, :4], x[:, 4]))


def with_score(docs: DataFrame, model: ToxicityModel, *, text: str = "text",
               name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of the whole text."""
    # Plain data: a broadcast is unpickled without the package's classes.
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.scanner.terms, model.scanner.innocent, model.weights))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, innocent, weights = shared.value
        own = ToxicityModel(Scanner(terms, innocent), weights)
        for part in parts:
            texts = part.column(part.schema.names.index(text))
            got = pa.array([own.score(t.as_py()) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, got], names=[*part.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(trimmed(score), schema)


def below(docs: DataFrame, model: ToxicityModel, *, text: str = "text", bound: float = 0.5) -> DataFrame:
    """``docs`` scored under ``bound``, columns unchanged."""
    name = unused(docs, "_toxicity")
    return with_score(docs, model, text=text, name=name).where(col(name) < bound).drop(name)


def toxicity_report(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id",
                    text: str = "text", held_out: int = 5, **options) -> DataFrame:
    model = train(docs, labels, doc_id=doc_id, text=text, held_out=held_out, **options)
    own = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    return with_score(own, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % held_out == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` less those scored 0.5 or more, columns unchanged."""
    model = train(docs, labels, text=text, **options)
    return below(docs, model, text=text)
