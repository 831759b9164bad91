"""Token alignment against a plain account of bytes, tokens and pairs."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tillflow.llm import token_alignment as ta
from tillflow.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER

SCHEMA = "doc_id long, text string"
with open(BYTE_TOKENIZER, "rb") as file:
    BY_RANK = ta.byte_tokens(file.read())
BY_FILE = Tokenizer.from_file(BYTE_TOKENIZER)
BY_FILE.encode_special_tokens = True


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECE_TOKENIZER)


def a_bytes(a, ids):
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    table = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    return [bytes(table[c] for c in a.id_to_token(i)) for i in ids]


def b_bytes(b, ids):
    return [bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i in ids for p in [b.id_to_piece(i)]]


def plain(tokenizers, rows):
    """Rows of the report, by ranges of bytes."""
    a, b = tokenizers
    groups_of = []
    for _, text in rows:
        groups = []
        if text:
            whole = b" " + text.encode()
            sides = []
            for ids, data in ((x, f(t, x)) for t, f, x in (
                    (a, a_bytes, a.encode(" " + text, add_special_tokens=False).ids), (b, b_bytes, b.encode(text)))):
                ends = np.cumsum([len(d) for d in data])
                sides.append((list(zip(ids, ends)), b"".join(data) == whole))
            if all(ok for _, ok in sides):
                (x, _), (y, _) = sides
                begin = 0
                for end in sorted({e for _, e in x} & {e for _, e in y}):
                    groups.append(tuple([i for i, e in side if begin < e <= end] for side in (x, y)))
                    begin = end
        groups_of.append(groups)
    links = [Counter((i, j) for x, y in groups for i in x for j in y) for groups in groups_of]
    count = Counter(p for c in links for p in c)
    best = Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (doc, _), groups, c in zip(rows, groups_of, links):
        name = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(c.values()),
                    sum(n for (i, j), n in c.items() if count[i, j] == best[i]),
                    sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(name.encode()).hexdigest() if groups else ""))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                               "groups_sha256").collect())


ODD = ["", None, " ", "a", "  two blanks ", "\n\n\t", "<|endoftext|> and </s><s><unk>", "<0x41> is not a byte",
       "naïve café – “quotes”", "日本語のテキスト", "👩‍👩‍👧 emoji \U0001F600", "▁ mark", "é combined",
       "ﬁ ligature   hard blank", "0123456789" * 30, "a" * 300, "-" * 77 + "=" * 45, "x\x00y\x07", "ﷺ",
       "The quick brown fox", "The quick brown fox", "ab" * 5000, "​‍﻿", "line\r\nline\r\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_ranks_give_the_ids_of_the_file(texts):
    a = BY_FILE
    assert BY_RANK.encode(texts) == [
        a.encode(" " + t, add_special_tokens=False).ids for t in texts]
    for t, ids in zip(texts, BY_RANK.encode(texts)):
        assert b"".join(BY_RANK.data[k] for k in ids) == b" " + t.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 400), unique=True), st.lists(st.integers(0, 400), unique=True, min_size=1))
def test_gallop_finds_every_place(short, long):
    short, long = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    assert ta.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
    x, y = ta.common_ends(short, long)
    assert short[x].tolist() == sorted(set(short.tolist()) & set(long.tolist())) == long[y].tolist()


def test_large_groups_give_the_same_links():
    rnd = random.Random(1)
    for _ in range(50):
        sizes = np.array([[rnd.randint(1, 6), rnd.randint(1, 6)] for _ in range(rnd.randint(1, 8))]).T
        a, b = (np.array([rnd.randint(0, 3) for _ in range(s.sum())]) for s in sizes)
        def total(limit):
            c = Counter()
            *links, times = ta.group_links(a, b, *sizes, limit=limit)
            for g, x, y, n in zip(*links, np.ones(len(links[0]), int) if times is None else times):
                c[g, x, y] += n
            return c
        assert total(0) == total(5) == total(100)


def test_equals_plain_account(spark, tokenizers):
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice("ab é\n日<>0.👍") for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    rows = [(k % 70, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for chars, heavy in ((50, 3), (10_000, 1 << 16), (10 ** 9, 1)):
        got = found(ta.alignment_report(df, BYTE_TOKENIZER, PIECE_TOKENIZER, batch_chars=chars, heavy=heavy))
        assert got == plain(tokenizers, rows)


def test_given_documents(spark, tokenizers):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert found(entry.queries()["op13_token_alignment"](spark, SF_SMALL)) == plain(tokenizers, rows)


def test_empty_table_and_clashing_columns(spark, tokenizers):
    empty = ta.alignment_report(spark.createDataFrame([], SCHEMA), BYTE_TOKENIZER, PIECE_TOKENIZER)
    assert empty.count() == 0 and empty.columns[-1] == "groups_sha256"
    df = spark.createDataFrame([("x", "hello there")], "doc_id string, text string")
    for name in ("row", "pairs", "times", "pair", "best", "documents", "n_a", "link"):
        df = df.withColumn(name, F.lit(1))
    assert found(ta.alignment_report(df, BYTE_TOKENIZER, PIECE_TOKENIZER)) == plain(tokenizers, [("x", "hello there")])
