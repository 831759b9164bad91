"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and
extra columns whose names clash with its own."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tillflow.llm import (
    chat_format,
    decontaminate,
    html_text,
    license_scan,
    line_dedup,
    mixing,
    near_text,
    near_vectors,
    pseudonymize,
    toxicity,
)

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
CLASHING = ["row", "key", "_key", "_text", "_row", "doc", "version", "size", "copies", "source_size", "target",
            "chunk", "class", "score", "_toxicity", "spans", "items", "n_words", "removed", "n_lines", "line",
            "block", "path", "license", "pseudonyms", "k", "id", "t1", "lang", "dir", "_new", "n_chars"]
SCHEMA = "doc_id bigint, text string, source string, " + ", ".join(f"{c} int" for c in CLASHING)
ROWS = [(1, "one two three four five six seven eight nine ten eleven", "a"),
        (1, "one two three four five six seven eight nine ten eleven", "a"),
        (2, None, "a"), (3, "", None), (4, " \n\t \n", None), (None, "zero idiot\nzero idiot", "b"),
        (5, LONG, "b"), (6, "...,,,!!!", "b"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *([9] * len(CLASHING))) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [("x", "three four five"), (None, None), ("y", "!!"), ("x", "two three four five six seven eight nine ten eleven"),
         ("z", "One, TWO three four five six seven eight nine ten ELEVEN twelve")],
        "item_id string, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (1, 1), (5, None), (None, 1), (6, 0)], "doc_id bigint, toxic int")


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect() if r["doc_id"] is not None}


def test_mixing(docs, none):
    got = mixing.mixture_report(docs).collect()
    assert len(got) == len(ROWS)
    sizes = {r["doc_id"]: r["size"] for r in got}
    assert (sizes[1], sizes[2], sizes[3], sizes[4], sizes[5]) == (11, 0, 0, 0, 120_000)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert {r["target"] for r in got if r["source_size"] == 0} == {0.0}  # the null source has no words
    assert mixing.mixture_report(none).count() == 0
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(none).count() == 0


def test_decontamination(docs, none, benchmark, spark):
    got = decontaminate.contamination_report(docs, benchmark)
    assert got.count() == len(ROWS)
    r = by_id(got)
    # item x by both its windows, item z by none of its ten-word windows but the first two
    assert r[1]["n_words"] == 11 and r[1]["n_hit"] == 11 and r[1]["n_items"] == 2 and r[1]["contaminated"]
    assert r[2]["n_words"] == 0 and not r[2]["contaminated"] and r[5]["n_words"] == 120_000
    assert decontaminate.contamination_report(none, benchmark).count() == 0
    empty = spark.createDataFrame([], benchmark.schema)
    assert not any(x["contaminated"] for x in decontaminate.contamination_report(docs, empty).collect())
    cut = decontaminate.decontaminated(docs, benchmark)
    assert cut.columns == docs.columns
    assert sorted(x["doc_id"] or 0 for x in cut.collect()) == [0, 0, 2, 3, 4, 5, 6]  # of 1 nothing is left


def test_near_duplicates(docs, none):
    got = near_text.near_duplicate_report(docs)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    assert all(r["class_id"] == r["doc_id"] for r in rows)  # wordless ones are classes of their own
    one = near_text.without_near_duplicates(docs)
    assert one.columns == docs.columns and one.count() == len(ROWS) - 1
    assert near_text.near_duplicate_report(none).count() == 0
    assert near_text.without_near_duplicates(none).count() == 0


def test_line_dedup(docs, none):
    got = line_dedup.line_dedup_report(docs)
    assert got.count() == len(ROWS)
    r = by_id(got)
    assert r[1]["n_lines"] == 1 and r[1]["n_removed"] == 0  # both rows of one id keep it
    assert r[4]["n_lines"] == 0 and r[5]["n_lines"] == 1
    null_id = [x for x in got.collect() if x["doc_id"] is None and x["n_lines"]]
    assert null_id[0]["removed"] == [1]
    kept = line_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    texts = {x["text"] for x in kept.collect()}
    assert "zero idiot" in texts and LONG in texts and None in texts
    assert line_dedup.line_dedup_report(none).count() == 0 and line_dedup.deduplicated(none).count() == 0


def test_pseudonyms(docs, none):
    got = pseudonymize.pseudonym_report(docs, "k")
    assert got.count() == len(ROWS) and {r["text"] for r in got.collect()} == {r[1] for r in ROWS}
    assert pseudonymize.pseudonym_report(none, "k").count() == 0


def test_licenses(docs, none):
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    got = license_scan.scan_licenses(docs, path=path)
    assert got.count() == len(ROWS) and {r["license"] for r in got.collect()} == {None}
    assert license_scan.scan_licenses(none, path=path).count() == 0


def test_toxicity(docs, none, labels, spark):
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity_report(none, labels).count() == 0
    unlabelled = spark.createDataFrame([], labels.schema)
    extra = {"idiot": (False, 1)}
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_report(docs, unlabelled, extra_terms=extra).collect()
              if r["doc_id"] is not None}
    assert not any(scores.values())
    clean = toxicity.without_toxic(docs, unlabelled, extra_terms=extra)
    assert clean.columns == docs.columns and clean.count() == len(ROWS) - 1  # "zero idiot" goes


def test_html(spark):
    schema = "page_id bigint, url string, html string, lines int, key int, text int"
    rows = [(1, "http://a/x", None, 1, 1, 1), (2, None, "<p>a</p>", 1, 1, 1), (3, "no url", "", 1, 1, 1),
            (3, "no url", "", 1, 1, 1), (None, "http://a/y", "<p>" + "long " * 200_000, 1, 1, 1),
            (4, "http://a/z", "<p>cut off <b", 1, 1, 1)]
    got = html_text.main_text(spark.createDataFrame(rows, schema))
    r = {x["page_id"]: x for x in got.collect()}
    assert got.count() == 6 and r[1]["text"] == "" and r[2]["text"] == "a" and r[4]["text"] == "cut off"
    assert r[None]["n_chars"] == 999_999
    assert html_text.main_text(spark.createDataFrame([], schema)).count() == 0


def test_chats(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, part int, formatted string"
    rows = [(1, 1, "assistant", None, 0, ""), (1, 0, "user", "hi", 0, ""), (None, 0, None, "x" * 3_000_000, 0, ""),
            (2, 0, "user", "a", 0, ""), (2, 0, "user", "a", 0, ""), (2, None, "system", "s", 0, "")]
    got = {r["conv_id"]: r for r in chat_format.chat_report(spark.createDataFrame(rows, schema)).collect()}
    assert {k: v["n_turns"] for k, v in got.items()} == {1: 2, 2: 3, None: 1}
    assert got[1]["loss_chars"] == 0 and got[None]["formatted_chars"] > 3_000_000
    assert chat_format.chat_report(spark.createDataFrame([], schema)).count() == 0


def test_vectors(spark):
    schema = "vec_id bigint, embedding array<double>, label int, cell int, task int, id int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]),
            (7, [inf, 1.0]), (8, [1.0, 0.0, 0.0]), (9, []), (2, [2.0, 0.0]), (None, [-1.0, 0.0])]
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.range_join(
        spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], schema)).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
         (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (None, 0, None, True)], key=str)
    assert near_vectors.range_join(spark.createDataFrame([], schema)).count() == 0


def test_form_around_the_body_is_its_frame():
    text = lambda page: "\n".join(x for x, _ in html_text.blocks(page))
    body = "<article><h1>Title</h1><p>The body of the page.</p><form><p>Your mail</p></form></article>"
    got = text(f'<body><form id="f" method="post"><nav>Menu</nav>{body}<footer>Foot</footer></form></body>')
    assert got == "Title\nThe body of the page."
    assert text(f"<body><form><p>Search here</p></form>{body}</body>") == got
    assert text(f"<FORM><main>{body}</main></FORM>") == got


def test_end_tags_without_a_partner_cost_no_search():
    begin = time.perf_counter()
    got = html_text.blocks("<article>" + "<div>" * 20_000 + "x" + "</p>" * 20_000 + "</article>")
    assert [x for x, _ in got] == ["x"] and time.perf_counter() - begin < 5


def test_vectors_of_extreme_length_link_by_direction(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1.0, 1.01]), (4, [-1e200, 1e200]), (5, [5e-324, 5e-324]),
            (6, [0.0, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           near_vectors.range_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1), 4: (0, 4), 6: (0, 6)}
