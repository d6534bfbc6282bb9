"""Line deduplication by a deletion-neighbourhood join over words.

Two lines are near if one word replaced, added or taken away makes one the other, or none at all. Lines that are near
share a key: a line with one word left out equals the other line with the word at the same place left out, or the other
line whole. So every line emits the hash of itself and of each of its variants with one word left out; lines that meet
under a variant are compared word by word. Of each meeting only the earliest line and the whole line, if there is one,
are compared with the others, as everybody else is near one of these or nobody there: work is linear in the variants.

Before that, lines that can't have a near one are set aside without loss: of two near lines, the shorter's first or
last half of words is unchanged in both, so a line whose halves nobody shares emits no variants.

Lines are ordered by (doc_id, line number), null doc_ids first. A line goes if an earlier line is near it, whether or
not that one stays. Between lines of fewer than ``MIN_WORDS`` words, or such a line and a longer one, only equal words
count as near, as one word is too much of them; blank lines always stay. Words stand between ASCII white space; in scripts
that put no spaces between words each character is a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches, kept
from tablegate.llm.text import UNSPACED, buffers, character_class, chunks, mix, random_words, words

MIN_WORDS = 6
HOT_SHARE = 10_000
_SOLO = character_class(UNSPACED)
_WORD = re.compile(f"[{_SOLO}]|[^\x20\x09-\x0d{_SOLO}]+")  # as the keys have it: no other white space ends a word
_BASE = int(random_words(31, 1)[0]) | 1
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Lines:
    """The lines of some texts that have enough words, as spans of a flat array of word hashes."""

    def __init__(self, column: pa.Array, min_words: int) -> None:
        data, offsets = buffers(column)
        found = words(data, offsets, lower=False, by_script=True)
        breaks = np.flatnonzero(data == 10)
        line = np.searchsorted(breaks, found.starts)
        texts = np.repeat(np.arange(len(offsets) - 1), np.diff(found.bounds))
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (texts[1:] != texts[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(line))
        long = ends - starts >= min_words
        self.starts, self.ends = starts[long], ends[long]
        self.text = texts[self.starts]
        before = np.searchsorted(breaks, offsets[:-1])
        self.number = (line[self.starts] - before[self.text]).astype(np.int32)
        self.hashes, self.first_byte, self.last_byte = found.hashes, found.starts, found.ends
        self.up, self.down = _powers(_BASE, len(line) + 1), _powers(_BACK, len(line) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes * self.up[: len(line)])])

    def part(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Order-sensitive hash of the words from a to b, whatever their place."""
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def whole(self) -> np.ndarray:
        return named(self.part(self.starts, self.ends), self.ends - self.starts)

    def halves(self) -> np.ndarray:
        """(line, 4): first and last halves, as cut if the line is the shorter one and if a longer one by one word."""
        n = self.ends - self.starts
        keys = []
        for size in (n // 2, (n - 1) // 2):
            keys.append(mix(named(self.part(self.starts, self.starts + size), size) ^ np.uint64(1)))
            keys.append(mix(named(self.part(self.ends - size, self.ends), size) ^ np.uint64(2)))
        return np.stack(keys, 1)

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place left out, hash) of every line without one of its words."""
        sizes = self.ends - self.starts
        line = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start, end = self.starts[line], self.ends[line]
        at = start + place
        left = self.part(start, at) + self.part(at + 1, end) * self.up[place]
        return line, place, named(left, sizes[line] - 1)


def named(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return mix(hashes + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _kind(docs: DataFrame) -> str:
    """The type of doc_id: a struct stays one, which lets rows without an id of their own have a key; all else is long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return kind if kind.startswith("struct<") else "bigint"


def _rows(docs: DataFrame) -> DataFrame:
    return bounded_batches(docs).select(F.col("doc_id").cast(_kind(docs)).alias("doc_id"), F.col("text").cast("string").alias("text"))


def occurrences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line_no, line, k0..k3) of every line with a word; line is a hash of its words, k its halves' if it has
    enough words to be near another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            lines = Lines(piece.column(1), 1)
            halves, short = lines.halves().view(np.int64), lines.ends - lines.starts < min_words
            columns = [piece.column(0).take(pa.array(lines.text)), pa.array(lines.number), pa.array(lines.whole().view(np.int64))]
            columns += [pa.array(np.ascontiguousarray(halves[:, k]), mask=short) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line_no", "line", "k0", "k1", "k2", "k3"])

    return _rows(docs).mapInArrow(run, f"doc_id {_kind(docs)}, line_no int, line long, k0 long, k1 long, k2 long, k3 long")


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (line, doc_id, line_no, body): the line whole, at place -1, and without each of its words."""
    for piece in chunks(batches, "body", 1 << 18):
        lines = Lines(piece.column(3), 1)
        own = lines.whole()
        at, place, left = lines.variants()
        row = np.concatenate([lines.text, lines.text[at]])
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([own, left]).view(np.int64)),
                pa.array(np.concatenate([np.full(len(own), -1), place]).astype(np.int32)),
                piece.column(0).take(take),
                piece.column(1).take(take),
                piece.column(2).take(take),
            ],
            ["key", "place", "line", "doc_id", "line_no"],
        )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key, place and line order: (line, other) that may be near, each line with few others.

    The whole line of a key (place -1) meets the earliest line of every place, and all of them meet it; lines with the
    same place left out meet the earliest of them. State is one row per run, so a key may have any number of lines.
    """
    key = place = own = lead = None
    for batch in batches:
        k, p, n = (batch.column(c).to_numpy() for c in (0, 1, 2))
        if not len(k):
            continue
        new_key = np.ones(len(k), bool)
        new_key[1:] = k[1:] != k[:-1]
        new_key[0] = key is None or k[0] != key
        alone = new_key & np.append(new_key[1:], False)  # most keys have one line; the last may go on in the next batch
        firsts, seconds = [], []
        for i in np.flatnonzero(~alone):
            if new_key[i]:
                key, place, own, lead = k[i], None, None, None
            if p[i] == -1:
                own = n[i] if own is None else own
            else:
                if own is not None and n[i] != own:
                    firsts += [n[i], own]
                    seconds += [own, n[i]]
                if p[i] != place:
                    place, lead = p[i], n[i]
                elif n[i] != lead:
                    firsts.append(n[i])
                    seconds.append(lead)
        if firsts:
            yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64())], ["line", "other"])


def near(a: str, b: str) -> bool:
    """Whether two lines are equal or one word apart, compared word by word."""
    x, y = _WORD.findall(a), _WORD.findall(b)
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    same = next((i for i, (v, w) in enumerate(zip(x, y)) if v != w), len(x))
    return x[same + (len(x) == len(y)) :] == y[same + 1 :]


def duplicates(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line_no, copy_of_doc, copy_of_line) of every line that goes and the earliest line near it.

    Line numbers count from 0 and lines end at line feeds; words are what stands between ASCII white space, case kept.
    Null and empty texts have no lines. Rows that repeat a doc_id and hold the same line at the same number are one
    occurrence. A document's own lines count too. Columns other than doc_id and text are not looked at.
    """
    found = kept(occurrences(docs, min_words), "lines")
    first = F.min(F.struct("doc_id", "line_no")).alias("first")
    classes = found.groupBy("line").agg(first, F.count(F.lit(1)).alias("n"), *[F.first(k).alias(k) for k in ("k0", "k1", "k2", "k3")])
    classes = kept(classes.select("line", "first.doc_id", "first.line_no", "n", "k0", "k1", "k2", "k3"), "line-classes")
    halves = classes.select("line", F.explode(F.array_distinct(F.array("k0", "k1", "k2", "k3"))).alias("key"))
    halves = halves.filter("key IS NOT NULL")
    shared = halves.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    plausible = halves.join(shared, "key", "left_semi").select("line").distinct()
    plausible = classes.join(plausible, "line", "left_semi").select("line", "doc_id", "line_no")

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            lines = Lines(piece.column(1), min_words)
            data, _ = buffers(piece.column(1))
            raw = data.tobytes()
            spans = zip(lines.first_byte[lines.starts], lines.last_byte[lines.ends - 1])
            columns = [
                pa.array(lines.whole().view(np.int64)),
                piece.column(0).take(pa.array(lines.text)),
                pa.array(lines.number),
                pa.array([raw[a:b].decode() for a, b in spans], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["line", "doc_id", "line_no", "body"])

    whole = _rows(docs).mapInArrow(bodies, f"line long, doc_id {_kind(docs)}, line_no int, body string")
    w, p = whole.alias("w"), plausible.alias("p")
    same = F.expr("w.line = p.line AND w.line_no = p.line_no AND w.doc_id <=> p.doc_id")
    texts = kept(w.join(p, same, "left_semi").dropDuplicates(["line"]), "plausible-lines")
    emitted = texts.mapInArrow(_emit, f"key long, place int, line long, doc_id {_kind(docs)}, line_no int")
    sorted_keys = ["key", "place", F.col("doc_id").asc_nulls_first(), "line_no", "line"]
    meetings = emitted.repartition("key").sortWithinPartitions(*sorted_keys).mapInArrow(_meet, "line long, other long").distinct()

    one = texts.select("line", F.struct("doc_id", "line_no").alias("at"), "body")
    other = texts.select(F.col("line").alias("other"), F.struct("doc_id", "line_no").alias("other_at"), F.col("body").alias("other_body"))

    @F.pandas_udf("boolean")
    def verified(a, b):
        import pandas as pd

        return pd.Series([near(x, y) for x, y in zip(a, b)], dtype=bool)

    pairs = meetings.join(one, "line").join(other, "other").filter(F.col("other_at") < F.col("at"))
    pairs = pairs.filter(verified("body", "other_body"))
    earlier = kept(pairs.groupBy("line").agg(F.min("other_at").alias("earlier")), "near-lines")

    placed = classes.join(earlier, "line", "left").select("line", F.struct("doc_id", "line_no").alias("first"), "earlier", "n")
    # Lines that each make up a ten-thousandth of all, of which there are at most HOT_SHARE, come to their places by a
    # broadcast; the others by a shuffle in which no line is heavy.
    total = classes.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE >= total
    places, hot = found.select("line", F.struct("doc_id", "line_no").alias("at")), F.broadcast(placed.filter(is_hot))
    rest = places.join(hot.select("line"), "line", "left_anti").join(placed.filter(~is_hot), "line")
    every = places.join(hot, "line").unionAll(rest)
    of = F.coalesce(F.least("earlier", "first"), "first").alias("of")
    gone = every.filter(F.col("earlier").isNotNull() | (F.col("at") > F.col("first"))).select("at", of)
    return gone.select("at.doc_id", "at.line_no", F.col("of.doc_id").alias("copy_of_doc"), F.col("of.line_no").alias("copy_of_line")).distinct()


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs with the given (doc_id, line_no) lines taken out of ``text``; everything else as it was, null texts too.

    A document all of whose lines went has an empty text. Rows that share a doc_id (or have none) are taken as one document:
    a line number that goes, goes in each; who wants them apart gives every row a doc_id of its own, a struct if need be,
    here and to ``duplicates``. n_chars, if there is such a column, is set to the new length.
    """
    gone_lines, rest = f"gone_{uuid4().hex}", f"rest_{uuid4().hex}"  # no column of the caller's has such a name
    lists = gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias(gone_lines))  # of one document's lines
    d, g = bounded_batches(docs).alias("d"), lists.alias("g")
    joined = d.join(g, F.expr("d.doc_id <=> g.doc_id"), "left")

    @F.pandas_udf("string")
    def cut(texts, numbers):
        import pandas as pd

        out = []
        for text, dropped in zip(texts, numbers):
            if dropped is None or text is None:
                out.append(text)
                continue
            away = set(dropped)
            out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in away))
        return pd.Series(out, dtype=object)

    # Called nondeterministic, lest a filter on the result has Spark compute it once more.
    gone_any = F.col(gone_lines).isNotNull()
    made = joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], f"g.{gone_lines}")
    made = made.withColumn(rest, cut.asNondeterministic()(F.when(gone_any, F.col("text")), F.col(gone_lines)))
    columns = []
    for c in docs.columns:
        own = F.col(f"`{c}`")
        if c == "text":
            own = F.when(gone_any, F.col(rest)).otherwise(own)
        elif c == "n_chars":
            own = F.when(gone_any, F.length(rest)).otherwise(own).cast(docs.schema[c].dataType)
        columns.append(own.alias(c))
    return made.select(*columns)
