from __future__ import annotations

import random
import re

import pytest

from tablegate.llm import decontam
from tablegate.llm.text import SEPARATORS, UNSPACED, character_class
from tests.llm.tables import EXTRA, awkward, awkward_rows, empty, prose, with_extras


def split(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    solo, apart = character_class(UNSPACED), character_class(SEPARATORS)
    return re.findall(f"[{solo}]|[^\x00-\x2f\x3a-\x60\x7b-\x7f{solo}{apart}]+", lower)


def brute(docs, items):
    """All spans on all diagonals."""
    out = {}
    for d, text in docs:
        x = split(text)
        for b, item in items:
            y = split(item)
            spans = []
            if 0 < len(y) < decontam.SPAN:
                spans = [(i, i + len(y)) for i in range(len(x) - len(y) + 1) if x[i : i + len(y)] == y]
            for shift in range(-len(y), len(x)) if len(y) >= decontam.SPAN else ():
                for i in range(max(0, shift), min(len(x), len(y) + shift) - decontam.SPAN + 1):
                    if sum(x[i + k] == y[i + k - shift] for k in range(decontam.SPAN)) >= decontam.SPAN - decontam.SUBSTITUTED:
                        spans.append((i, i + decontam.SPAN))
            if spans:
                out[(d, b)] = (min(a for a, _ in spans), max(e for _, e in spans), len(spans))
    return out


def tables():
    draw = random.Random(9)
    items = [(k, " ".join(draw.choice("abc") + str(draw.randint(0, 3)) for _ in range(draw.choice([4, 5, 8, 11, 12, 13, 20, 40])))) for k in range(24)]
    items += [(30, prose(1, 30)), (31, None), (32, ""), (None, prose(8, 14))]
    docs = []
    for k in range(40):
        words = split(items[draw.randrange(24)][1])
        words = [w if draw.random() > 0.1 else "zz" for w in words]
        cut = words[draw.randint(0, 3) : len(words) - draw.randint(0, 3)]
        docs.append((1000 + k, prose(k, draw.randint(0, 12)) + " " + ", ".join(cut).upper() + "! " + prose(k, draw.randint(0, 9))))
    return docs, items


@pytest.mark.parametrize("together", [decontam.TOGETHER, 60])
def test_leaks_are_those_of_all_spans(spark, monkeypatch, together):
    monkeypatch.setattr(decontam, "TOGETHER", together)  # 60: several passes over the documents
    docs, items = tables()
    docs += [(i, t) for i, t in dict(awkward_rows()).items() if t is None or len(t) < 9000]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS spans")
    got = decontam.leaks(with_extras(spark, docs), benchmark).collect()
    want = brute(docs, items)
    assert len(want) > 25
    assert {(r.doc_id, r.item_id): (r.first_word, r.end_word, r.spans) for r in got} == want and len(got) == len(want)


def test_short_quoted_and_unspaced_items_are_found(spark):
    items = [(1, "what is the capital"), (2, "日本の首都はどこですか"), (3, "Name the river that flows through the old town"), (4, "yes"), (5, "¿Qué es?"), (6, "...")]
    docs = [(1, "So: What is the CAPITAL of it?"), (2, "次の問題は日本の首都はどこですか。答えは東京です"), (3, "He asked “Name the river that flows through the old town”—and left"), (4, "yes"), (5, "“qué es”"), (6, "Qué, es... … nothing")]
    docs += [(7, "what is the only capital"), (8, "yesterday"), (9, "...")]
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): (r.first_word, r.end_word, r.spans) for r in got.collect()} == want
    assert want.keys() == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5)}


def test_leaking_documents_go_with_all_columns_kept(spark):
    docs, items = awkward(spark), [(1, prose(8, 25))]
    got = decontam.without_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["doc_id", "text", *[c for c in EXTRA]]
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(i) for i, _ in awkward_rows() if i not in (-4, 60, 30, 31))


def test_nothing_leaks_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(awkward(spark), none).count() == 0
    assert decontam.leaks(empty(spark), spark.createDataFrame([(1, prose(1, 30))], none.schema)).count() == 0
    assert decontam.without_leaks(awkward(spark), none).count() == len(awkward_rows())
