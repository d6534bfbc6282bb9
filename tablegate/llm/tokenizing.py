"""Token ids of whole texts by the tokenizers library, with ids of words met before taken from memory.

A text is cut where no token can cross, the library encodes each distinct piece once, and the ids of a text are
those of its pieces in order. What may be cut depends on the vocabulary's pre-tokenizer, so that the ids are the
ones the library gives for the whole text.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

FIRST = " "  # marks the first part of a text; no part holds a space itself
KEPT_WORDS, KEPT_BYTES = 1_000_000, 96 << 20  # parts remembered by a worker, and their size with their ids
KEPT_SIGNS = 10_000  # signs after words, remembered apart
TOGETHER = 2000  # words that the library gets, or normalizes, as one text
SETTLED = re.compile("[A-Za-zªµºÀ-ÖØ-öø-\u012f\u0131-\u024f]+")  # letters in all versions of Unicode, but dotted I
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that byte-level vocabularies spell as themselves
HIDDEN = sorted({*range(256)} - SHOWN)  # the others, which they spell from U+0100 on
SPELLING = "".join(chr(b if b in SHOWN else 256 + HIDDEN.index(b)) for b in range(256))
SPACE = SPELLING[32]
ENDINGS = "!\"#$%&()*+,-./:;=?@[]^_`{|}~"  # ASCII signs but the apostrophe and angle brackets


def _strings(column: pa.LargeStringArray) -> list[str]:
    """The strings of a column without nulls, by numpy, which makes them several times as fast as to_pylist."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """ids of texts as little-endian unsigned 32-bit integers, the same as ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            settings = json.load(f)
        kind = settings.get("pre_tokenizer") or {}
        spaced = any(c.isspace() for t in settings.get("added_tokens", []) for c in t["content"])
        stripped = any(t.get("lstrip") or t.get("rstrip") for t in settings.get("added_tokens", []))
        steps = kind.get("pretokenizers", [kind])
        self.keeps_spaces = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space")
        drops = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and "\\s" in json.dumps(steps[0])
        plain = not settings.get("normalizer") if self.keeps_spaces else True
        named = any(all(c.isalpha() or c in ENDINGS for c in t["content"]) for t in settings.get("added_tokens", []))
        self.cuts = bool((self.keeps_spaces and plain or drops) and not spaced and not stripped and not named)
        # whether a run of letters is one word to the model, spelled byte by byte
        before, runs, _ = str((steps[0].get("pattern") or {}).get("Regex")).partition("|[\\p{L}]+|")
        lettered = bool(runs) and bool(steps[0].get("invert")) and all(x[:1] == "'" for x in before.split("|"))
        bytewise = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        lettered = lettered and len(steps) == 2 and bytewise.items() <= steps[1].items()
        self.wordwise = bool(self.cuts and (self.keeps_spaces or lettered))
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        ending = (settings.get("model") or {}).get("end_of_word_suffix") or ""
        self.edges = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that begin a word, or end one
        for token, number in self.tokenizer.get_vocab().items():
            self.edges[number] = token.startswith("\u0120") if self.keeps_spaces else bool(ending) and token.endswith(ending)
        self._remember(pa.array([], pa.large_string()), pa.array([], pa.large_binary()))
        self.signs: dict[str, bytes] = {}

    def _remember(self, parts: pa.LargeStringArray, ids: pa.LargeBinaryArray) -> None:
        """What is known from now on: distinct parts, and their ids (null if a part isn't safe to cut after)."""
        self.parts, self.ids = parts, ids

    def _library(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _parts(self, texts: Sequence[str]) -> pa.ListArray:
        """What stands between spaces, for each text. A line break starts a part, or is a space where these are dropped."""
        return pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " \n" if self.keeps_spaces else " "), " ")

    def _piece(self, part: str) -> str:
        """The characters of the text that a part stands for."""
        if not self.keeps_spaces or part[:1] == "\n":
            return part
        return part[1:] if part[:1] == FIRST else " " + part

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of runs of letters. The library's model gets each as it is spelled, where that is sure to be one word of it."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if SETTLED.fullmatch(w)] if self.wordwise else []
        for start in range(0, len(plain), TOGETHER):
            own = plain[start : start + TOGETHER]
            text = " ".join(own)
            normal = self.normalizer.normalize_str(text) if self.normalizer else text
            spelled = codecs.charmap_decode(normal.encode(), "strict", SPELLING)[0].split(SPACE)
            if len(spelled) != len(own) or normal is not text and not all(map(SETTLED.fullmatch, normal.split(" "))):
                continue
            if self.keeps_spaces:
                spelled = [SPACE + x for x in spelled]
            out.update((w, array("I", [t.id for t in self.model.tokenize(x)]).tobytes()) for w, x in zip(own, spelled))
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self._together(rest)))
        return out

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of runs of letters. Many go to the library as one text, whose ids are cut where a token begins or ends a
        word; should it cut otherwise than they were put together, each goes alone."""
        out: list[bytes] = []
        for start in range(0, len(words), TOGETHER):
            own = words[start : start + TOGETHER]
            text = " " + " ".join(own) if self.keeps_spaces else " ".join(own)
            body = self._library([text])[0]
            edges = np.flatnonzero(self.edges[np.frombuffer(body, "<u4")]) * 4
            bounds = [*edges.tolist(), len(body)] if self.keeps_spaces else [0, *(edges + 4).tolist()]
            if len(edges) == len(own) and bounds[0] == 0 and bounds[-1] == len(body):
                out += [body[a:b] for a, b in zip(bounds, bounds[1:])]
            else:
                out += self._library([self._piece(w) for w in own])
        return out

    def _where(self, parts: pa.LargeStringArray) -> np.ndarray:
        """Where distinct parts stand among those remembered, -1 for new ones. The few are hashed, the many looked up."""
        found = pc.index_in(self.parts, value_set=parts).fill_null(-1).to_numpy()
        place, hits = np.full(len(parts), -1, np.int64), np.flatnonzero(found >= 0)
        place[found[hits]] = hits
        return place

    def _places(self, parts: pa.LargeStringArray) -> np.ndarray:
        """Where distinct parts stand among those remembered; new ones are learned."""
        place = self._where(parts)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = np.arange(len(self.parts), len(self.parts) + len(new))
            self._learn(parts.take(pa.array(new)))
        return place

    def _learn(self, new: pa.LargeStringArray) -> None:
        """Remember the ids of new parts; letters and the signs after them are tokens apart, so each is looked up once.

        A part that isn't safe to cut after, as it ends in white space or holds some, is remembered as null.
        """
        stems = pc.utf8_rtrim(new, ENDINGS)
        lettered = pc.and_(pc.utf8_is_alpha(stems), pc.invert(pc.match_substring_regex(stems, r"[\x{2000}-\x{10FFFF}]")))
        stems, whole = stems.filter(lettered), new.filter(lettered)
        words = stems.dictionary_encode()
        place = self._where(words.dictionary)
        unknown = words.dictionary.filter(pa.array(place < 0))
        asked = _strings(unknown)
        found = self._words(asked)
        fresh = pa.array([found[w] for w in asked], pa.large_binary())
        place[place < 0] = np.arange(len(self.ids), len(self.ids) + len(fresh))
        bodies = pa.concat_arrays([self.ids, fresh]).take(pa.array(place[words.indices.to_numpy()]))
        signs = [part[n:] for part, n in zip(_strings(whole), pc.utf8_length(stems).to_numpy().tolist())]
        if len(self.signs) > KEPT_SIGNS:
            self.signs = {}
        more = [x for x in dict.fromkeys(signs) if x not in self.signs]
        self.signs.update(zip(more, self._library(more)))
        ended = pa.array([self.signs[x] for x in signs], pa.large_binary())
        others, safe = _strings(new.filter(pc.invert(lettered))), []
        if self.keeps_spaces:
            safe = [bool((part[1:] or part).isprintable() and part) for part in others]
        told = iter(self._library([self._piece(part) for part, x in zip(others, safe or [True] * len(others)) if x]))
        rest = pa.array([next(told) if x else None for x in safe or [True] * len(others)], pa.large_binary())
        both = pa.concat_arrays([pc.binary_join_element_wise(bodies, ended, pa.scalar(b"", pa.large_binary())), rest])
        own = both.take(pa.array(np.argsort(np.argsort(~lettered.to_numpy(zero_copy_only=False), kind="stable"))))
        apart = pc.invert(pc.is_in(unknown, value_set=whole))  # words that only stand before signs
        self._remember(
            pa.concat_arrays([self.parts, new, unknown.filter(apart)]), pa.concat_arrays([self.ids, own, fresh.filter(apart)])
        )

    def _merged(self, parts: list[str], unsafe: list[bool]) -> bytes:
        """Ids of a text of which some parts aren't safe to cut after: those go together with what follows."""
        runs, held = [], ""
        for part, kept in zip(parts, unsafe):
            held += self._piece(part)
            if not kept:
                runs.append(held)
                held = ""
        return b"".join(self._library([*runs, held]))

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.cuts or not texts:
            return self._library(texts)
        lists = self._parts(texts)
        bounds, coded = lists.offsets.to_numpy(), lists.flatten().dictionary_encode()
        distinct, order = coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy()
        if self.keeps_spaces:  # no space precedes the first part of a text, which is another thing to encode
            first = distinct.take(pa.array(order[bounds[:-1]]))
            first = pc.binary_join_element_wise(pa.scalar(FIRST, pa.large_string()), first, pa.scalar("", pa.large_string()))
            first, order = first.dictionary_encode(), order.copy()
            order[bounds[:-1]] = first.indices.to_numpy() + len(distinct)
            distinct = pa.concat_arrays([distinct, first.dictionary])
        place = self._places(distinct)
        joined = self.ids.take(pa.array(place[order]))  # the parts' ids stand one after another in its data
        merged = []
        if joined.null_count:
            unsafe = joined.is_null().to_numpy(zero_copy_only=False)
            merged = np.flatnonzero(np.add.reduceat(unsafe, bounds[:-1], dtype=np.int64))
            joined = joined.fill_null(b"")
        cuts = np.frombuffer(joined.buffers()[1], np.int64)[bounds].tolist()
        body = memoryview(joined.buffers()[2] or b"")
        out = [bytes(body[a:b]) for a, b in zip(cuts, cuts[1:])]
        for k in merged:
            own = lists[int(k)].as_py()
            own = [FIRST + own[0], *own[1:]] if self.keeps_spaces else own
            out[k] = self._merged(own, unsafe[bounds[k] : bounds[k + 1]].tolist())
        if len(self.parts) > KEPT_WORDS or self.parts.nbytes + self.ids.nbytes > KEPT_BYTES:
            self._remember(distinct, self.ids.take(pa.array(place)))  # anew, from the words of these texts
            if self.parts.nbytes + self.ids.nbytes > KEPT_BYTES:
                self._remember(self.parts[:0], self.ids[:0])
        return [b"" if not t else o for t, o in zip(texts, out)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Let go of the words remembered; called when a worker turns to other work."""
    _encoders.clear()


def encoded(path: str, texts: Sequence[str], limit: int = 4 << 20) -> Iterator[bytes]:
    """Ids of texts in order, encoded a few MB at a time."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= limit or i + 1 == len(texts):
            yield from encoder(path).encode([t or "" for t in texts[start : i + 1]])
            start, held = i + 1, 0
