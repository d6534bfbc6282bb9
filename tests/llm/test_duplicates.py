"""Near-duplicates, lines and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tablegate.llm import fingerprint, linededup, neardup
from tablegate.llm.components import components
from tablegate.llm.text import UNSPACED, character_class
from tests.llm.tables import awkward, awkward_rows, edited, empty, prose, with_extras


def shingled(text, size):
    lower = bytes(range(65, 91)), bytes(range(97, 123))
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(*lower)))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def linked(rows, size, percent):
    """Components by comparing all pairs."""
    sets = [(i, shingled(t, size)) for i, t in rows]
    groups = Groups([i for i, _ in rows if i is not None])
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and 100 * len(x & y) >= percent * len(x | y):
                groups.join(a, b)
    return groups, sets


@pytest.mark.parametrize("size", [1, 2, 5])
def test_near_duplicates_are_those_of_all_pairs(spark, size):
    rows = awkward_rows()
    rows += [(100 + k, edited(prose(77, 90), k, 0.02 * (k % 6))) for k in range(40)]  # around the threshold
    rows += [(200 + k, prose(200 + k, 4)) for k in range(20)]
    groups, sets = linked(rows, size, 80)
    got = neardup.near_duplicates(with_extras(spark, rows), size, 80).collect()
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), len(s)) for i, s in sets)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == groups.find(r.doc_id) and r.kept == (r.component_id == r.doc_id)
    nameless = {(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None}
    assert (0, None, True) in nameless  # null text
    assert (len(shingled(prose(1, 120), size)), groups.find(3), False) in nameless  # equals documents 3 and 5


def test_crowds_lose_no_link(spark, monkeypatch):
    """Regions larger than what is looked ahead, cut into several blocks, with chains of links inside."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "NEAR", 2)
    monkeypatch.setattr(neardup, "ALIKE", 1)
    monkeypatch.setattr(neardup, "RANDOM", 0)
    rows, text = [], prose(5, 80)
    for k in range(60):
        text = edited(text, 500 + k, 0.03)
        rows.append((k, text))
    rows += [(100 + k, edited(prose(6, 80), k, 0.05)) for k in range(60)]
    groups, _ = linked(rows, 2, 80)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: groups.find(i) for i, _ in rows}
    assert 1 < len({r.component_id for r in got}) < 120


def test_signatures_estimate_similarity():
    sets = [np.unique(neardup.random_words(k, 400)) for k in range(2)]
    sets.append(np.unique(np.concatenate([sets[0][:360], sets[1][:40]])))
    a, b, c = neardup.minhash(sets)
    assert (a == b).sum() <= 2 and abs((a == c).mean() - 360 / 440) < 0.15


def test_components_are_the_graph_s(spark):
    draw = random.Random(2)
    edges = [(k, k + 1) for k in range(300)]  # a chain
    edges += [(1000, 1000 + k) for k in range(1, 50)]  # a star
    edges += [(draw.randint(2000, 2100), draw.randint(2000, 2100)) for _ in range(60)] + edges[:5] + [(b, a) for a, b in edges[:5]]
    groups = Groups({n for e in edges for n in e})
    for a, b in edges:
        groups.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: groups.find(n) for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nothing_has_no_duplicates(spark):
    assert neardup.near_duplicates(empty(spark), 2).count() == 0
    assert linededup.duplicates(empty(spark)).count() == 0
    assert fingerprint.compare_edited(empty(spark)).count() == 0


def lines_gone(rows, least):
    solo = character_class(UNSPACED)
    word = re.compile(f"[{solo}]|[^\x20\x09-\x0d{solo}]+")
    lines = sorted({(i is not None, i or 0, k, tuple(word.findall(x))) for i, t in rows for k, x in enumerate((t or "").split("\n"))})
    lines = [x for x in lines if x[3]]
    out = {}
    for at, (known, i, k, own) in enumerate(lines):
        for known_b, j, m, other in lines[:at]:
            x, y = sorted((own, other), key=len)
            if x == y or len(x) >= least and (len(x) == len(y) and sum(a != b for a, b in zip(x, y)) == 1 or len(y) - len(x) == 1 and any(y[:p] + y[p + 1 :] == x for p in range(len(y)))):
                out[(i if known else None, k)] = (j if known_b else None, m)
                break
    return out


def line_rows():
    draw = random.Random(4)
    lines = [" ".join(draw.choice("ab") for _ in range(draw.randint(1, 9))) for _ in range(60)]
    lines += ["", "  ", "six words in this line here", "six  words in\tthis line here ", "Six words in this line here", "six words in this line"]
    lines += [f"page {k} of the long book by somebody" for k in range(12)] + ["page of the long book by somebody"]
    return [(draw.randint(0, 30), "\n".join(draw.choice(lines) for _ in range(draw.randint(0, 6)))) for _ in range(25)] + [(None, lines[-1] + "\nx"), (99, None)]


@pytest.mark.parametrize("least", [1, 4, 6])
def test_lines_that_go_are_those_of_all_pairs(spark, least):
    rows = list({i: t for i, t in line_rows()}.items())
    got = linededup.duplicates(with_extras(spark, rows), least).collect()
    assert {(r.doc_id, r.line_no): (r.copy_of_doc, r.copy_of_line) for r in got} == lines_gone(rows, least)


@pytest.mark.parametrize("space", ["\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", "\x1f"])
def test_only_ascii_white_space_ends_a_word(space):
    assert linededup.near(f"le prix est de 10{space}000 euros", f"le prix est de 12{space}500 euros")
    assert not linededup.near(f"le prix est de 10{space}000 euros", "le prix est de 10 000 euros")


def test_lines_with_other_white_space(spark):
    rows = [(k, f"le prix du livre est de {10 + k}{space}{k}00 euros ici") for k, space in enumerate("\u00a0\u2003\u3000\u0085\x1c\x1f\u00a0", 1)]
    got = linededup.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line_no): (r.copy_of_doc, r.copy_of_line) for r in got} == lines_gone(rows, linededup.MIN_WORDS) == {(k, 0): (1, 0) for k in range(2, 8)}


def test_short_and_unspaced_lines(spark):
    rows = [(1, "All rights reserved.\n一二三四五六七八九十は漢字の数です"), (2, "x\nAll  rights reserved. "), (3, "一二三四五六七八九十は漢字の数です\nAll rights reserved!"), (4, "一二三四五六七八九十が漢字の数です"), (5, "日本語\n\n"), (6, "日本話\n \n日本語")]
    got = {(r.doc_id, r.line_no): (r.copy_of_doc, r.copy_of_line) for r in linededup.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == lines_gone(rows, linededup.MIN_WORDS) == {(2, 1): (1, 0), (3, 0): (1, 1), (4, 0): (1, 1), (6, 2): (5, 0)}


def test_awkward_lines(spark):
    rows = awkward_rows()
    got = linededup.duplicates(awkward(spark)).collect()
    short = [(i, t) for i, t in rows if t is None or len(t) < 50_000]
    want = lines_gone(short, linededup.MIN_WORDS)
    mine = {(r.doc_id, r.line_no): (r.copy_of_doc, r.copy_of_line) for r in got}
    assert {k: v for k, v in mine.items() if k[0] not in (30, 31)} == want
    assert {k[1] for k in mine if k[0] == 31} == set(range(400))  # the very long text's copy goes whole
    assert not [k for k in mine if k[0] == 30]


def test_lines_are_taken_out(spark):
    rows = [(1, "first line\nsecond\nthird", "a", 23), (2, "x\ny", "b", 3), (3, None, None, None), (None, "p\nq", "c", 3), (4, "only", "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line string, n_chars long")
    gone = spark.createDataFrame([(1, 1), (None, 0), (4, 0)], "doc_id long, line_no int")
    got = linededup.without(docs, gone)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert sorted(map(str, got.collect())) == sorted(
        map(str, spark.createDataFrame([(1, "first line\nthird", "a", 16), (2, "x\ny", "b", 3), (3, None, None, None), (None, "q", "c", 1), (4, "", "d", 0)], docs.schema).collect())
    )


@pytest.mark.parametrize("a, b, same", [("a b", "a b", True), ("a b", "a c", True), ("a b", "a", True), ("a", "a b", True), ("", "a", True), ("x a b", "a b y", False), ("a b c", "b c a", False)])
def test_one_word_apart(a, b, same):
    assert linededup.near(a, b) is same


def walked(text):
    """The sampled characters of a walk, one step after another."""
    n = len(text)
    steps = int(fingerprint.walk_lengths(np.array([n]))[0])
    level = int(fingerprint.levels(np.array([steps]))[0])
    at, out = 0, []
    for j in range(steps):
        code = 0 if at >= n else (ord(text[at]) * 0x9E3779B1 % 2**32 >> 24) % 255 + 1
        if fingerprint._STEPS.upto(steps).depth[j] >= level:
            out.append(code * 7 % 256 % 16)
        at += int(fingerprint._WALK[j % fingerprint._PERIOD][code])
    return level, out


def test_fingerprints_are_the_walk_s():
    texts = ["", "a", "abc", "é日本", prose(1, 20), prose(2, 700), prose(3, 3000), prose(1, 20)]
    got = fingerprint.fingerprints(texts)
    assert [(k, v.tolist()) for k, v in got] == [walked(t) for t in texts]
    assert fingerprint.as_text(got[4]) == fingerprint.as_text(got[7])
    assert [x.tolist() for x in (fingerprint.from_text(fingerprint.as_text(got[6]))[1],)] == [got[6][1].tolist()]
    assert fingerprint.likeness(got[0], got[0]) == 1 and fingerprint.likeness(got[0], got[1]) == 0
    coarse = fingerprint.at_level(got[5], got[5][0] + 1)
    assert 0 < len(coarse) < len(got[5][1])


def test_walks_read_the_last_character(monkeypatch):
    monkeypatch.setattr(fingerprint, "SAMPLES", 1 << 40)  # every step is kept
    slow = chr(min(range(33, 1000), key=lambda c: fingerprint._WALK[:, (c * 0x9E3779B1 % 2**32 >> 24) % 255 + 1].mean()))
    bases = ["a", "_" * 5, slow * 40, prose(6, 300), "_" * 100_000, slow * 300_000, prose(5, 20_000)]
    texts = [t + end for t in bases for end in ("é", "語")]
    together = fingerprint.fingerprints(texts)
    code = lambda c: ((ord(c) * 0x9E3779B1 % 2**32 >> 24) % 255 + 1) * 7 % 256 % 16
    for text, (level, values) in zip(texts, together):
        rest = values[np.flatnonzero(values != 0)[-1]]
        assert level == 0 and rest == code(text[-1]) != code("_"), len(text)
        assert len(values) >= fingerprint.walk_lengths(np.array([len(text)]))[0]
    assert len(together[10][1]) > fingerprint.walk_lengths(np.array([300_001]))[0]
    monkeypatch.undo()
    alone = [fingerprint.fingerprints([t])[0] for t in texts]
    for (k, x), (m, y) in zip(alone, fingerprint.fingerprints(texts)):
        assert k == m and x.tolist() == y.tolist()


def test_likeness_follows_edits():
    base = prose(3, 400)
    prints = fingerprint.fingerprints([base, edited(base, 1, 0.02), edited(base, 2, 0.3), prose(4, 400), "inserted " + base])
    like = [fingerprint.likeness(prints[0], p) for p in prints]
    assert like[0] == 1 > like[1] > like[2] > like[3] and like[1] > 0.5 and like[4] > 0.8 and like[3] < 0.3


@pytest.mark.parametrize("chunk", [fingerprint.CHUNK_CHARS, 500])
def test_every_text_meets_the_next(spark, monkeypatch, chunk):
    monkeypatch.setattr(fingerprint, "CHUNK_CHARS", chunk)
    rows = [(i, t) for i, t in awkward_rows() if t is None or len(t) < 9000]
    got = fingerprint.compare_edited(with_extras(spark, rows).repartition(5)).collect()
    named = sorted(((i, t or "") for i, t in rows if i is not None))
    following = [t for _, t in named[1:]] + [named[0][1]]
    own = [(i, t, f) for (i, t), f in zip(named, following)] + [(None, t or "", "") for i, t in rows if i is None]
    want = []
    for i, t, f in own:
        changed = t[: len(t) - len(t) // 4] + f[: len(t) // 4]
        a, b, c = fingerprint.fingerprints([t, changed, f])
        sha = hashlib.sha256(changed.encode()).hexdigest()
        want.append((str(i), len(t), sha, fingerprint.as_text(a), fingerprint.as_text(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c)))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_bands_find_near_texts(spark):
    rows = [(k, prose(k, 200)) for k in range(30)] + [(100 + k, edited(prose(k, 200), k, 0.01)) for k in range(10)]
    rows += [(200, prose(3, 200)), (201, prose(3, 200)), (300, ""), (301, "")]
    made = zip(rows, fingerprint.fingerprints([t for _, t in rows]))
    prints = spark.createDataFrame([(i, fingerprint.as_text(p)) for (i, _), p in made], "doc_id long, fingerprint string")
    found = {(r.doc_id, r.earlier_id): r.likeness for r in fingerprint.near_earlier(prints, 0.6).collect()}
    assert found[(200, 3)] == found[(201, 3)] == found[(301, 300)] == 1
    assert all((100 + k, k) in found for k in range(10)) and all(b % 100 == a % 100 or a in (200, 201, 301) for a, b in found)


@pytest.mark.parametrize("block", [1024, 5])
def test_pairs_under_one_header_are_those_of_all_pairs(spark, monkeypatch, block):
    """Bands of many, whose smallest member most are unlike, on texts that begin alike and differ below."""
    monkeypatch.setattr(fingerprint, "BLOCK", block, raising=False)
    header = prose(70, 150)
    rows = [(k, header + " " + prose(k, 160)) for k in range(12)]
    rows += [(100 + 20 * v + k, header + " " + edited(prose(k, 160), 40 * v + k, 0.01 * v)) for k in range(12) for v in (1, 2)]
    rows += [(300 + k, edited(header, k, 0.05) + " " + prose(4, 300)) for k in range(4)]  # differ above only
    made = dict(zip((i for i, _ in rows), fingerprint.fingerprints([t for _, t in rows])))
    want = {(a, b): fingerprint.likeness(made[a], made[b]) for a in made for b in made if b < a}
    texts = {i: fingerprint.as_text(p) for i, p in made.items()}
    first = {i: min(j for j in texts if texts[j] == t) for i, t in texts.items()}  # stands for those with its fingerprint
    want = {(a, b): share for (a, b), share in want.items() if share >= 0.8 and first[b] == b and first[a] in (a, b)}
    prints = spark.createDataFrame([(i, fingerprint.as_text(p)) for i, p in made.items()], "doc_id long, fingerprint string")
    rows = fingerprint.near_earlier(prints, 0.8).collect()
    assert {(r.doc_id, r.earlier_id): r.likeness for r in rows} == pytest.approx(want) and len(rows) == len(want) >= 20
    assert {a for a, _ in want} & {300 + k for k in range(4)}
    firsts = {}
    for a, b in sorted(want):
        firsts.setdefault(a, b)
    assert len(want) > len(firsts)  # more than one partner a document
