from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablegate.llm import packing, tokenizing, tokens
from tablegate.llm.queries import vocabulary
from tablegate.llm.tokenizing import Encoder
from tests.llm.tables import awkward, awkward_rows, empty

BYTES, PLAIN = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


def library(path, texts, end):
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, end], "<u4") for e in found]


@pytest.mark.parametrize("path", [BYTES, PLAIN])
def test_cut_texts_have_the_ids_of_whole_ones(path):
    draw = random.Random(1)
    signs = [" ", " ", "\n", "a", "B", "'s", "'", "9", "é", "!", ".", "\t", "\u00a0", "\x1c", "\u2003", "\0", "Σ", "<|endoftext|>", "ab", "\u0301", "ſ"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 24))) for _ in range(3000)]
    texts += [t or "" for _, t in awkward_rows()]
    encoder = Encoder(path)
    assert encoder.cuts
    want = [x[:-1].tobytes() for x in library(path, texts, 0)]
    assert encoder.encode(texts) == want
    assert encoder.encode(texts) == want  # from memory


@pytest.mark.parametrize("path", [BYTES, PLAIN])
def test_runs_of_letters_have_the_ids_of_whole_texts(path):
    draw = random.Random(2)
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()] + list("abcdeAB" * 40)
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 9))) for _ in range(4000)]
    texts = [" ".join(words[i : i + 50]) + "." for i in range(0, 4000, 50)] + ["İ ſt ŉ ΑΣ ΣΑ straße"]
    encoder = Encoder(path)
    assert encoder.wordwise
    assert encoder.encode(texts) == [x[:-1].tobytes() for x in library(path, texts, 0)]


@pytest.mark.parametrize("path", [BYTES, PLAIN])
def test_words_go_to_the_model_once(path, monkeypatch):
    monkeypatch.setattr(tokenizing, "KEPT_WORDS", 0)  # every call begins a generation
    encoder, asked, texts = Encoder(path), [], []
    words, whole = encoder._words, encoder._library
    monkeypatch.setattr(encoder, "_words", lambda own: (asked.extend(own), words(own))[1])
    monkeypatch.setattr(encoder, "_library", lambda own: (texts.extend(own), whole(own))[1])
    own = ["", "thndster", "größe", "alpha"]
    encoder.encode([" ".join(own)])
    assert set(own[1:]) <= set(asked) and not any(w in t for w in own[1:] for t in texts)
    asked.clear()
    assert encoder.encode([" ".join(w + "," for w in own)])[0] == library(path, [" ".join(w + "," for w in own)], 0)[0][:-1].tobytes()
    assert not set(asked) & set(own[1:])


@pytest.mark.parametrize("most_words, most_bytes", [(0, 1 << 30), (10, 1 << 30), (1000, 2000), (1000, 0)])
@pytest.mark.parametrize("path", [BYTES, PLAIN])
def test_what_is_remembered_is_bounded_in_words_and_bytes(path, most_words, most_bytes, monkeypatch):
    monkeypatch.setattr(tokenizing, "KEPT_WORDS", most_words)
    monkeypatch.setattr(tokenizing, "KEPT_BYTES", most_bytes)
    monkeypatch.setattr(tokenizing, "KEPT_SIGNS", 2)
    encoder, draw = Encoder(path), random.Random(3)
    texts = ["ab, ab. ab! cd? " + "x1" * draw.randint(1, 900) + "\t\tgrün," + "".join(draw.choice("abé") for _ in range(9)) for _ in range(60)]
    want = [x[:-1].tobytes() for x in library(path, texts, 0)]
    for i in range(0, 60, 4):
        assert encoder.encode(texts[i : i + 4]) == want[i : i + 4]
        assert len(encoder.parts) <= max(most_words, 40) and encoder.parts.nbytes + encoder.ids.nbytes <= max(most_bytes, 100)
    assert len(set(encoder.parts.to_pylist())) == len(encoder.parts) == len(encoder.ids)


@pytest.mark.parametrize("token", ["chung", "g."])
@pytest.mark.parametrize("path", [BYTES, PLAIN])
def test_a_vocabulary_with_letters_as_a_token_of_their_own(path, token, tmp_path):
    found = Tokenizer.from_file(path)
    found.add_tokens([token])
    found.save(str(tmp_path / "named.json"))
    encoder, texts = Encoder(str(tmp_path / "named.json")), ["achtung chung abchungen. x chung"]
    assert not encoder.cuts
    assert encoder.encode(texts) == [np.array(found.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@given(st.lists(st.integers(0, 2**32 - 1)))
@settings(max_examples=200, deadline=None)
def test_values_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = tokens.pack_values(values)
    assert len(control) == -(-len(values) // 4)
    assert tokens.unpack_values(control, data, len(values)).tolist() == values.tolist()


def test_frames_round_trip_and_rank_by_frequency():
    ids = [np.array(x, "<u4").tobytes() for x in ([7, 7, 9], [], [9, 7, 70000])]
    numbers, bounds, flat = tokens.unframe(tokens.frame([1, None, -3], ids))
    assert numbers == [1, None, -3] and bounds.tolist() == [0, 3, 3, 6] and flat.tolist() == [7, 7, 9, 9, 7, 70000]
    assert tokens.ranked(flat)[0].tolist() == [7, 9, 70000]
    with pytest.raises(ValueError):
        tokens.unframe(b"XXXX" + tokens.frame([1], ids[:1])[4:])


def test_files_hold_every_document_in_order(spark, monkeypatch):
    rows = awkward_rows()
    index = tokens.write(awkward(spark), PLAIN, 2, tokens.files_folder(spark))
    got = [r.asDict() for r in tokens.read(index, with_ids=True).orderBy("start").collect()]
    known = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert known == sorted(known) and [r["doc_id"] for r in got][:3] == [None] * 3
    want = sorted((-(10**9) if i is None else i, x.tobytes()) for (i, _), x in zip(rows, library(PLAIN, [t for _, t in rows], 2)))
    assert sorted((-(10**9) if r["doc_id"] is None else r["doc_id"], bytes(r["ids"])) for r in got) == want
    total = 0
    for r in got:
        assert r["start"] == total and r["n_tokens"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        total += r["n_tokens"]


def test_no_documents_no_files(spark):
    assert tokens.read(tokens.write(empty(spark), PLAIN, 2, tokens.files_folder(spark))).count() == 0
    assert packing.packed(empty(spark), BYTES).count() == 0


def test_cut():
    assert packing.cut(2048, 2048) == [(0, 2048)] and packing.cut(1, 2048) == [(0, 1)]
    assert packing.cut(4096, 2048) == [(0, 2048), (2048, 2048)]
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_fullest_is_the_best_subset_sum(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    chosen = packing.fullest(room, counts)
    assert sum(x * n for x, n in chosen) == max(s for s in sums if s <= room)
    assert all(n <= counts[x] for x, n in chosen)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
@settings(max_examples=100, deadline=None)
def test_plan_places_everything_once(histogram):
    used = dict.fromkeys(histogram, 0)
    for sequences, chosen in packing.plan(histogram, 64):
        assert sum(x * n for x, n in chosen) <= 64
        for x, n in chosen:
            used[x] += sequences * n
    assert used == histogram


@pytest.mark.parametrize("together", [packing.RANKED_TOGETHER, 2])
def test_packs_all_pieces_gapless(spark, monkeypatch, together):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", together)  # 2: lengths are ranked in groups
    rows = awkward_rows()
    got = [r.asDict() for r in packing.packed(awkward(spark), BYTES, 0, 256, with_ids=True).collect()]
    texts: dict[int, list] = {}
    for r in got:
        texts.setdefault(r["copy"], []).append(r)
    whole = [b"".join(bytes(p["ids"]) for p in sorted(ps, key=lambda p: p["piece"])) for ps in texts.values()]
    assert sorted(whole) == sorted(x.tobytes() for x in library(BYTES, [t for _, t in rows], 0))
    for pieces in texts.values():
        pieces.sort(key=lambda p: p["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert [(p["start"], p["length"]) for p in pieces] == packing.cut(sum(p["length"] for p in pieces), 256)
    bins: dict[int, list] = {}
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r["length"] for r in got) // 256) + 1
