"""Quality rules whose cutoffs are certified on labelled documents.

A document is measured (words, symbols, repeated lines and windows of words).  Base
rules reject outright.  Each further rule rejects above a cutoff, which is chosen for
each stratum (the language) so that good documents are rejected at a rate of ``RISK`` at
most, at a confidence of 1 - ``ERROR`` for all strata together:

* Labelled texts are halved by a digest of the text, so copies stay on one side; a text
  counts once in its stratum, and as good if one of its labels says so.
* On the first half a path of settings is built.  It begins with no rule; each step
  lowers the one cutoff whose newly rejected texts have the most bad ones for each good
  one, as long as they have more bad than good ones.  Each setting rejects what those
  before it reject.
* On the other half the settings are tested in the order of the path, each with the
  exact binomial bound (Clopper-Pearson): a setting stands if so few good texts are
  rejected that a rate above ``RISK`` would give as few with probability ``ERROR`` /
  number of strata at most (Bonferroni).  The first that fails ends the path, so testing
  several settings in order needs no further correction.  The last that stands is taken.

How it runs: one pass measures all documents into a slim table.  Labelled rows are
reduced to how many cutoffs of each rule they exceed; a stratum's table of such counts
has a bounded number of rows (``RULES``) however many labels there are, and a task
chooses its cutoffs.  Cutoffs are a row for each stratum.

Defined cases: a null or empty text has no words and fails the base; a null stratum is a
stratum; one without enough labels, or without labels, keeps what passes the base; null
labels are no labels; several labels of an id count as good if one is; equal rows are
judged each; without labels nothing is certified; texts of any length are measured whole;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, pieces, written

#: Good documents that rules may reject, and the chance that this is exceeded anywhere.
RISK = 0.05
ERROR = 0.05
#: Words of a window.
WINDOW = 5
MIN_WORDS = 10
#: Share of repeated words, in percent, above which the base fails.
MAX_REPEATED = 20

#: Rule: what is measured, and its cutoffs from the strictest on; above one it rejects.
RULES = {
    "symbols_a_word": ("try_divide(n_symbols, n_words)", (0.05, 0.1, 0.2, 0.4, 0.8, 1.6)),
    "long_words": ("try_divide(word_chars, n_words)", (6.5, 7.0, 7.5, 8.0, 9.0, 11.0)),
    "short_words": ("-try_divide(word_chars, n_words)", (-4.0, -3.5, -3.0, -2.5, -2.0)),
    "equal_lines": ("try_divide(n_dup_lines, n_lines)", (0.05, 0.1, 0.2, 0.3, 0.5)),
    "repeated_words": ("try_divide(n_repeat_words, n_words)", (0.02, 0.05, 0.1, 0.15)),
    "few_words": ("-n_words", (-50.0, -30.0, -20.0, -15.0)),
}

_SPACE = bytes(32 if b in b"\t\n\x0b\x0c\r " else b for b in range(256))
#: Bytes that begin no character.
_INNER = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b"\t\n\x0b\x0c\r "

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers: equal pairs, and only those, get the same."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated_words(words: np.ndarray) -> int:
    """Words inside a window of five that occurs again, of numbered words."""
    if len(words) < WINDOW:
        return 0
    two = _paired(words[:-1], words[1:])
    if two.max() + 1 == len(two):
        return 0
    four = _paired(two[:-2], two[2:])
    windows, times = np.unique(four[:-1] * (int(words.max()) + 1) + words[4:],
                               return_inverse=True, return_counts=True)[1:]
    again = np.flatnonzero(times[windows] > 1)
    change = np.bincount(again, minlength=len(words) + 1) - np.bincount(again + WINDOW, minlength=len(words) + 1)
    return int((np.cumsum(change) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """``MEASURES`` of a text in UTF-8."""
    if not text:
        return (0,) * len(MEASURES)
    number: dict = defaultdict(count().__next__)
    words = [np.fromiter(map(number.__getitem__, found), np.int64, len(found))
             for found in (p.split() for p in pieces(text.translate(_SPACE)))]
    numbers = words[0] if len(words) == 1 else np.concatenate(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (len(numbers), len(text.translate(None, _BLANKS + _INNER)), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(numbers))


def _measured(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        *kept, text = part.columns
        rows = np.array([measure(t) for t in text.cast(pa.binary()).to_pylist()], np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c) for c in rows.T]],
                                         names=[*part.schema.names[:-1], *MEASURES])


def measures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, digest of the text, ``MEASURES`` and base_failed, a row for each document."""
    read = docs.select(col(doc_id).alias("doc_id"), col(stratum).cast("string").alias("stratum"),
                       F.xxhash64(col(text).cast("string")).alias("digest"), col(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    got = read.mapInArrow(_measured, f"doc_id {kind}, stratum string, digest long, "
                          + ", ".join(f"{m} long" for m in MEASURES))
    return got.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def binomial_tail(k: int, n: int, p: float) -> float:
    """Chance of at most ``k`` of ``n`` at rate ``p``."""
    if k >= n:
        return 1.0
    if k + 1 > p * (n + 1):  # more terms below than above: sum the others
        return 1.0 - sum(_terms(k + 1, n, p, 1))
    return math.fsum(_terms(k, n, p, -1))


def _terms(k: int, n: int, p: float, step: int) -> Iterator[float]:
    """Binomial probabilities from ``k`` away from the middle, until they add nothing."""
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(p) + (n - k) * math.log1p(-p))
    while 0 <= k <= n and term > 1e-300:
        yield term
        if step < 0:
            term *= k / (n - k + 1) * (1 - p) / p
        else:
            term *= (n - k) / (k + 1) * p / (1 - p)
        k += step


def upper_bound(k: int, n: int, error: float) -> float:
    """The rate at which ``k`` of ``n`` or fewer have probability ``error`` (Clopper-Pearson)."""
    if k >= n:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(k, n, middle) > error else (low, middle)
    return high


def path_of_settings(levels: np.ndarray, good: np.ndarray, weight: np.ndarray,
                     off: list[int]) -> list[list[int]]:
    """Settings, each stricter than the one before.  A setting holds a cutoff's place for
    each rule (0 the strictest, ``off`` none); a row is rejected where its level is higher."""
    now, path = list(off), []
    rejected = np.zeros(len(levels), dtype=bool)
    while True:
        best = None
        for rule, place in enumerate(now):
            for k in range(place - 1, -1, -1):
                new = ~rejected & (levels[:, rule] > k)
                bad, lost = int(weight[new & ~good].sum()), int(weight[new & good].sum())
                if bad > lost and (best is None or bad * (best[1] + 1) > best[0] * (lost + 1)):
                    best = (bad, lost, rule, k)
        if best is None:
            return path
        now[best[2]] = best[3]
        rejected |= levels[:, best[2]] > best[3]
        path.append(list(now))


def certified(path: list[list[int]], levels: np.ndarray, weight: np.ndarray, risk: float,
              error: float) -> tuple[list[int] | None, int, int]:
    """The last setting that stands on good rows, tested in order, with what it rejects
    and of how many."""
    n, taken, lost = int(weight.sum()), None, 0
    for setting in path:
        k = int(weight[(levels > np.array(setting)).any(axis=1)].sum()) if len(levels) else 0
        if binomial_tail(k, n, risk) > error:
            break
        taken, lost = setting, k
    return taken, lost, n


def _chooser(risk: float, error: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    off = [len(cutoffs) for _, cutoffs in RULES.values()]

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        levels = rows[list(RULES)].to_numpy(np.int64)
        good, held, weight = (rows[c].to_numpy() for c in ("good", "held_out", "n"))
        path = path_of_settings(levels[~held], good[~held], weight[~held], off)
        test = held & good
        taken, lost, n = certified(path, levels[test], weight[test], risk, error)
        out = {rule: [cutoffs[k] if k < len(cutoffs) else None]
               for (rule, (_, cutoffs)), k in zip(RULES.items(), taken or off)}
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], **out, "n_tested": [n], "n_lost": [lost],
                             "bound": [upper_bound(lost, n, error) if n else 1.0]})

    return choose


def certified_cutoffs(measured: DataFrame, labels: DataFrame, *, risk: float = RISK, error: float = ERROR,
                      label_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """A row for each labelled stratum: the cutoff of every rule (null: the rule is off),
    good texts tested, those rejected, and the upper bound of their rate."""
    known = (labels.select(col(label_id).alias("labelled"), col(quality).cast("int").alias("quality"))
             .where("quality is not null").groupBy("labelled").agg(F.max("quality").alias("quality")))
    levels = [sum((F.expr(value) > F.lit(c)).cast("int") for c in cutoffs).alias(rule)
              for rule, (value, cutoffs) in RULES.items()]
    texts = (measured.where("not base_failed").join(known, F.col("doc_id") == F.col("labelled"))
             .groupBy("stratum", "digest", *levels).agg((F.max("quality") > 0).alias("good")))
    held_out = F.pmod(F.xxhash64(F.lit("holdout"), F.col("digest")), F.lit(2)) == 1
    counts = written(texts.groupBy("stratum", held_out.alias("held_out"), "good", *RULES)
                     .agg(F.count("*").alias("n")))
    strata = counts.select("stratum").distinct().count()
    schema = ("stratum string, " + ", ".join(f"{rule} double" for rule in RULES)
              + ", n_tested long, n_lost long, bound double")
    return counts.groupBy("stratum").applyInPandas(_chooser(risk, error / max(strata, 1)), schema)


def verdict(rules: Iterable[str] = RULES) -> Column:
    """Whether any certified cutoff of the row's stratum is exceeded."""
    out = F.lit(False)
    for rule in rules:
        out = out | F.coalesce(F.expr(RULES[rule][0]) > F.col(f"cut.{rule}"), F.lit(False))
    return out


def quality_report(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   stratum: str = "lang", **options) -> DataFrame:
    """doc_id, the measures, base_failed and kept, a row for each document."""
    measured = written(measures(docs, doc_id=doc_id, text=text, stratum=stratum))
    cutoffs = written(certified_cutoffs(measured, labels, **options))
    cut = cutoffs.select(F.col("stratum").alias("of"), F.struct(*RULES).alias("cut"))
    judged = measured.join(cut, F.col("stratum").eqNullSafe(F.col("of")), "left")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", F.when(F.col("base_failed"), False).otherwise(~verdict()).alias("kept"))
