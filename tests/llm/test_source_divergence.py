"""Source divergence against a plain count by string, with colliding digests and small tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL
from oracle_check import compare
from pyspark.sql import functions as F

from tillflow.llm import common
from tillflow.llm import source_divergence as sd

SCHEMA = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs):
    """(lang, source, part, item) -> (value, rank), by counting strings."""
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        sources[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = {}
    for lang, names in sources.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)

        def shares(c):
            whole = sum(c[t] for t in kept) + 2 * len(kept)
            return [1 + 10 ** 9 * (c[t] + 2) // whole for t in kept]

        p = {s: shares(counts[lang, s]) for s in names}
        q = shares(sum((counts[lang, s] for s in names), Counter()))
        gap = lambda x, y: (x - y) ** 2 // (x + y)
        for s in names:
            parts = {"pair": [(o, sum(map(gap, p[s], p[o]))) for o in names - {s}],
                     "term": [(t, gap(x, y)) for t, x, y in zip(kept, p[s], q) if counts[lang, s][t] and x > y]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items[:10] if part == "term" else items, 1):
                    out[lang, s, part, item] = (value, rank)
    return out


def found(df):
    rows = df.collect()
    out = {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in rows}
    assert len(out) == len(rows)
    return out


def some_documents(seed, n=240):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ab", "Äh", "no", "ça", "Z") for b in ("", "le", "ren", "ß", "日本")] + ["é1è", "x-y"]
    rows = [(k, " ".join(rnd.choice(vocabulary[:rnd.randint(3, 27)]) for _ in range(rnd.randint(0, 30))),
             rnd.choice(["en", "en", "de", None, ""]), rnd.choice([f"s{i}" for i in range(7)] + ["s0", "s0", None]))
            for k in range(n)]
    return rows + [(n, None, "xx", "lone"), (n + 1, "", "xx", None), (n + 2, "rare word", "yy", "s1"), rows[0], rows[0]]


def test_equals_plain_counts(spark):
    rows = some_documents(1)
    got = found(sd.divergence_report(spark.createDataFrame(rows, SCHEMA), min_docs=5))
    assert got == plain(rows, 5)
    assert ("xx", "lone", "pair", "") in got and got["xx", "lone", "pair", ""] == (0, 1)


@pytest.mark.parametrize("values", [1, 6])
def test_colliding_digests_are_split(spark, values):
    """All terms share one digest, or six: the strings decide."""
    rows = some_documents(2)
    got = found(sd.divergence_report(spark.createDataFrame(rows, SCHEMA), min_docs=4,
                                     digest=lambda t: sum(t) % values))
    assert got == plain(rows, 4)


def test_small_blocks_tables_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 2)
    monkeypatch.setattr(sd, "BUCKET_TERMS", 3)
    monkeypatch.setattr(common, "PIECE", 5)
    monkeypatch.setattr(sd, "STEP", 40)
    rows = some_documents(3)
    got = found(sd.divergence_report(spark.createDataFrame(rows, SCHEMA).repartition(5), min_docs=3, held=20))
    assert got == plain(rows, 3)


def test_pieces_cut_between_terms():
    data = b"a bb  ccc dddddddddd e"
    for size in range(1, 30):
        assert b"".join(common.pieces(data, size)) == data
        assert [w for p in common.pieces(data, size) for w in p.split()] == data.split()
    assert list(common.pieces(b"", 4)) == [b""]


def test_ties_long_texts_and_clashing_columns(spark):
    rows = [(k, " ".join(f"{a}{b}" for a in "abcdef" for b in "uvwxyz") + " zz" * 40 * (k % 2),
             "en", f"s{k % 2}") for k in range(24)]
    rows += [(99, "aa " * 400_000 + "u" * 200_000, "en", "s1")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "digest", "variant", "n", "docs", "p", "q", "total", "rank", "number"):
        df = df.withColumn(name, F.lit("clash"))
    got = found(sd.divergence_report(df))
    assert got == plain(rows, 10)
    assert [i for (_, s, part, i), _ in sorted(got.items(), key=lambda x: x[1][1]) if s == "s0" and part == "term"] == [
        f"{a}{b}" for a in "abcdef" for b in "uvwxyz"][:10]


def test_empty_table(spark):
    empty = sd.divergence_report(spark.createDataFrame([], SCHEMA))
    assert empty.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                            ("value", "bigint"), ("rank", "int")]
    assert empty.count() == 0


def test_counting_does_not_read_the_strings(spark, monkeypatch):
    """Of the written counts, the plan of the cells scans digests and numbers only."""
    plans, write = [], sd.written

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(sd, "written", watched)
    sd.divergence_report(spark.createDataFrame(some_documents(4), SCHEMA), min_docs=3)
    cells = [p for p in plans if "Window" in p][0]
    assert "ReadSchema: struct<lang:string,source:string,digest:bigint,n:bigint>" in cells
    assert "term" not in cells


def test_query_equals_sql(spark):
    r = compare(spark, "op11_source_divergence", SF_SMALL)
    assert r["ok"], r
