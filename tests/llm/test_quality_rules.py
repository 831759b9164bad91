"""Quality rules: measures, binomial bounds and cutoffs against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_ORACLE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillflow.llm import common
from tillflow.llm import quality_rules as qr

SCHEMA = "doc_id long, text string, lang string"


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    inside = {j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(inside))


def failed(m):
    return m[0] < 10 or 100 * m[5] > 20 * m[0]


TEXTS = st.text(alphabet="ab \n\t\r\x0b\x0c#|é日\x1c\x85  ", max_size=120)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_measures(text):
    assert qr.measure(text.encode()) == plain_measures(text)


def test_measures_of_long_texts_in_pieces(monkeypatch):
    rnd = random.Random(3)
    text = "".join(rnd.choice(["ab", "cd", "é", " ", " ", "\n", "|"]) for _ in range(4000))
    whole = qr.measure(text.encode())
    assert whole == plain_measures(text)
    monkeypatch.setattr(common, "PIECE", 7)
    assert qr.measure(text.encode()) == whole
    assert qr.measure(None) == qr.measure(b"") == (0,) * 6
    assert qr.measure(b"x" * 3_000_000)[:2] == (1, 3_000_000)


def exact_tail(k, n, p):
    p = Fraction(p)
    return sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1))


def test_binomial_bounds_are_exact():
    for n in (1, 5, 40, 200):
        for k in {0, 1, n // 20, n // 4, n - 1, n}:
            for p in (0.01, 0.05, 0.3, 0.9):
                assert qr.binomial_tail(k, n, p) == pytest.approx(float(exact_tail(k, n, p)), abs=1e-12, rel=1e-9)
            if k < n:
                bound = qr.upper_bound(k, n, 0.02)
                assert float(exact_tail(k, n, bound)) == pytest.approx(0.02, rel=1e-6)
    assert qr.upper_bound(3, 3, 0.1) == 1.0
    assert qr.binomial_tail(49_000, 1_000_000, 0.05) < 1e-5 < qr.binomial_tail(49_500, 1_000_000, 0.05)


def plain_cutoffs(texts, strata):
    """Cutoffs for (level vectors on both halves) of a stratum, by trying each setting."""
    off = [len(c) for _, c in qr.RULES.values()]
    reject = lambda level, s: any(x > k for x, k in zip(level, s))
    fit = [(v, g) for v, held, g in texts if not held]
    test = [v for v, held, g in texts if held and g]
    now, taken = off, None
    standing = True
    while True:
        options = []
        for rule in range(len(off)):
            for k in range(now[rule]):
                s = now[:rule] + [k] + now[rule + 1:]
                new = [g for v, g in fit if reject(v, s) and not reject(v, now)]
                bad, lost = new.count(False), new.count(True)
                if bad > lost:
                    options.append((Fraction(bad, lost + 1), -rule, k, s))
        if not options:
            return taken or off
        now = max(options, key=lambda o: o[:3])[3]
        k = sum(reject(v, now) for v in test)
        standing = standing and (k < len(test) or not test) and exact_tail(k, len(test), 0.05) <= Fraction(0.05) / strata
        if standing:
            taken = now


def plain_report(rows, labels, halves):
    """rows: (doc_id, text, lang); labels: doc_id -> quality; halves: text -> held out."""
    value = [lambda m: m[2] / m[0], lambda m: m[1] / m[0], lambda m: -m[1] / m[0], lambda m: m[4] / m[3],
             lambda m: m[5] / m[0], lambda m: -m[0]]
    measured = {t: plain_measures(t) for _, t, _ in rows}
    level = {t: [sum(f(m) > c for c in cutoffs) for f, (_, cutoffs) in zip(value, qr.RULES.values())]
             for t, m in measured.items() if not failed(m)}
    texts = defaultdict(dict)
    for doc, t, lang in rows:
        if doc in labels and t in level:
            texts[lang][t] = texts[lang].get(t, False) or labels[doc] == 1
    cuts = {lang: plain_cutoffs([(level[t], halves[t], g) for t, g in held.items()], len(texts))
            for lang, held in texts.items()}
    out = []
    for doc, t, lang in rows:
        m = measured[t]
        kept = not failed(m) and not (lang in cuts and any(x > k for x, k in zip(level[t], cuts[lang])))
        out.append((doc, m[0], m[1], m[2], m[4], m[5], failed(m), kept))
    return Counter(out), cuts


def halves_of(spark, texts):
    held = F.pmod(F.xxhash64(F.lit("holdout"), F.xxhash64("text")), F.lit(2)) == 1
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", held.alias("h")).collect()
    return {r["text"]: r["h"] for r in rows}


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                               "n_repeat_words", "base_failed", "kept").collect())


def some_documents(seed, n=1500):
    """Languages whose bad texts show by symbols, by long words, hardly, or not at all."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        lang = rnd.choice(["aa", "aa", "bb", "cc", None])
        good = rnd.random() < 0.75
        words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(8, 60))]
        if not good and lang == "aa":
            words = [w + "#" * rnd.randint(0, 2) for w in words]
        if not good and lang in ("bb", None):
            words = [w * 2 for w in words]
        text = " ".join(words)
        rows.append((k, text, lang))
        if rnd.random() < 0.8:
            labels.append((k, int(good)))
    rows += [(n, None, "aa"), (n + 1, "", "zz"), (n + 2, rows[0][1], "zz"), (0, rows[1][1], "bb"), rows[5]]
    return rows, labels + [(0, 1), (3, None)]


def test_report_equals_plain_version(spark):
    rows, labels = some_documents(7)
    known = {}
    for doc, q in labels:
        if q is not None:
            known[doc] = max(q, known.get(doc, 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("stratum", "good", "n", "cut", "digest", "n_words"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = found(qr.quality_report(docs, spark.createDataFrame(labels, "doc_id long, quality int")))
    want, cuts = plain_report(rows, known, halves_of(spark, {t for _, t, _ in rows}))
    assert got == want
    off = [len(c) for _, c in qr.RULES.values()]
    assert cuts["aa"] != off and cuts["bb"] != off  # something is certified, and something is not
    assert sum(1 for r in got if not r[6] and not r[7]) > 100


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    got = found(entry.queries()["op12_quality_rules"](spark, SF_ORACLE))
    assert got == plain_report(rows, known, halves_of(spark, {t for _, t, _ in rows}))[0]


def test_false_rejections_stay_below_the_risk():
    """Labels that say nothing: with 0.95 of certainty no certified rate is over the risk."""
    rnd = np.random.default_rng(2)
    off = [len(c) for _, c in qr.RULES.values()]
    over = 0
    for _ in range(200):
        levels = rnd.integers(0, 7, size=(400, len(off))) * (rnd.random((400, len(off))) < 0.05)
        levels = np.minimum(levels, off)
        good, held, one = rnd.random(400) < 0.6, rnd.random(400) < 0.5, np.ones(400, np.int64)
        path = qr.path_of_settings(levels[~held], good[~held], one[~held], off)
        taken, _, _ = qr.certified(path, levels[held & good], one[held & good], 0.05, 0.05)
        if taken:  # the true rate, of the distribution the levels come from
            free = np.prod([1 - 0.05 * sum(x > k for x in range(7) if min(x, o) > k) / 7 for k, o in zip(taken, off)])
            over += 1 - free > 0.05
    assert over <= 20


def test_empty_tables_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    empty = qr.quality_report(spark.createDataFrame([], SCHEMA), none)
    assert empty.count() == 0
    rows, _ = some_documents(8, 40)
    got = found(qr.quality_report(spark.createDataFrame(rows, SCHEMA), none))
    assert all(r[7] == (not r[6]) for r in got)
