"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import decontam, fingerprint, importance, knn, langid, lexical, licenses, linededup, neardup, packing, quality, tokens, warc
from tablegate.llm.text import SEPARATORS, UNSPACED

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A public vocabulary file; the library ships none of its own."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _registered(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


@_registered
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    done = packing.packed(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_registered
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = tokens.write(docs, vocabulary("word_bpe_49k.json"), 2, tokens.files_folder(spark))
    return tokens.read(index).select("doc_id", "start", "n_tokens", "ids_crc32")


@_registered
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(_table(spark, sf_dir, "documents"))


@_registered
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=2, percent=80)


ORACLE["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [w] ELSE list_transform(range(1, len(w)), lambda i: w[i:i + 1]) END) AS s
    FROM words WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), numbered AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reached r ON r.a = d.doc_id GROUP BY d.doc_id, n
"""


@_registered
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op2_warc"] = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), lasts AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM lasts
"""


def fold(key: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds))


@_registered
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    network = langid.learn(docs.filter(fold("doc_id", 4) != 2))
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return langid.predict(docs.select("doc_id", "text"), network).select("doc_id", held_out, "lang_pred", "score")


@_registered
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    known = labels.filter((fold("doc_id", 5) != 0) & F.col("label").isin(0, 1))
    known = langid.bounded_sample(known, "doc_id", quality.SAMPLE_DOCS)
    weights = quality.learn(docs.join(F.broadcast(known), "doc_id"))  # SAMPLE_DOCS rows of a number and a label
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return quality.predict(docs, weights).select("doc_id", held_out, "score", "predicted")


def _in_sql(ranges: tuple[tuple[int, int], ...]) -> str:
    """Ranges of code points as they stand in the brackets of a regular expression of DuckDB."""
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


def _between(ranges: list[tuple[int, int]]) -> tuple[tuple[int, int], ...]:
    """The code points beyond ASCII that no range has."""
    found, at = [], 0x80
    for a, b in [*ranges, (0x110000, 0x110000)]:
        if a > at:
            found.append((at, a - 1))
        at = max(at, b + 1)
    return tuple(found)


@_registered
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.duplicates(_table(spark, sf_dir, "documents"))


ORACLE["op8_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS body,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents
), lines AS (
    SELECT doc_id, line_no, w FROM (
        SELECT doc_id, line_no, regexp_extract_all(body, '[SOLO]|[^\x20\x09-\x0DSOLO]+') AS w FROM split)
    WHERE len(w) >= 1
), classes AS (
    SELECT w, min({'d': doc_id, 'l': line_no}) AS first_at FROM lines GROUP BY w
), variants AS (
    SELECT w, first_at, i, list_concat(w[:i - 1], w[i + 1:]) AS v
    FROM (SELECT w, first_at, unnest(range(1, len(w) + 1)) AS i FROM classes WHERE len(w) >= 6)
), near AS (
    SELECT b.w, a.first_at AS other FROM variants b JOIN variants a ON a.v = b.v AND a.i = b.i AND a.first_at < b.first_at
    UNION ALL SELECT b.w, a.first_at FROM variants b JOIN classes a ON a.w = b.v AND len(a.w) >= 6 WHERE a.first_at < b.first_at
    UNION ALL SELECT b.w, a.first_at FROM classes b JOIN variants a ON a.v = b.w AND len(b.w) >= 6 WHERE a.first_at < b.first_at
), earlier AS (
    SELECT w, min(other) AS earlier FROM near GROUP BY w
)
SELECT DISTINCT l.doc_id, CAST(l.line_no AS INT) AS line_no,
       least(coalesce(e.earlier, c.first_at), c.first_at).d AS copy_of_doc, CAST(least(coalesce(e.earlier, c.first_at), c.first_at).l AS INT) AS copy_of_line
FROM lines l JOIN classes c USING (w) LEFT JOIN earlier e USING (w)
WHERE e.earlier IS NOT NULL OR c.first_at < {'d': l.doc_id, 'l': l.line_no}
""".replace("SOLO", _in_sql(UNSPACED))


@_registered
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLE["op9_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[SOLO]|[0-9a-zWORDS]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[SOLO]|[0-9a-zWORDS]+') AS w FROM benchmark
), places AS (
    SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), item_places AS (
    SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM b WHERE len(w) >= 12
), apart AS (
    SELECT unnest([3, 6, 9]) AS g
), seeds AS (
    SELECT doc_id, i, g, hash(w[i:i + 2], w[i + g:i + g + 2]) AS h FROM places, apart WHERE i + g + 2 <= len(w)
), item_seeds AS (
    SELECT item_id, i, g, hash(w[i:i + 2], w[i + g:i + g + 2]) AS h FROM item_places, apart WHERE i + g + 2 <= len(w)
), diagonals AS (
    SELECT DISTINCT s.doc_id, t.item_id, s.i - t.i AS shift FROM seeds s JOIN item_seeds t USING (g, h)
), spans AS (
    SELECT doc_id, item_id, shift, d.w AS dw, b.w AS bw,
           unnest(range(greatest(1, 1 + shift), least(len(d.w), len(b.w) + shift) - 10)) AS i
    FROM diagonals JOIN d USING (doc_id) JOIN b USING (item_id)
), good AS (
    SELECT doc_id, item_id, i - 1 AS first, i + 11 AS last FROM spans
    WHERE list_sum(list_transform(range(0, 12), lambda k: CAST(dw[i + k] = bw[i + k - shift] AS INT))) >= 10
    UNION ALL
    SELECT doc_id, item_id, i - 1, i - 1 + len(b.w) FROM places JOIN b ON len(b.w) BETWEEN 1 AND 11 AND places.w[i] = b.w[1]
    WHERE places.w[i:i + len(b.w) - 1] = b.w
)
SELECT doc_id, item_id, CAST(min(first) AS INT) AS first_word, CAST(max(last) AS INT) AS end_word, count(*) AS spans
FROM good GROUP BY doc_id, item_id
""".replace("SOLO", _in_sql(UNSPACED)).replace("WORDS", _in_sql(_between(sorted([*UNSPACED, *SEPARATORS]))))


@_registered
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.learn(docs))


@_registered
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _crc_steps() -> str:
    """The effect of one byte on an empty crc32 register, as a list in SQL."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return str(table)


# The crc32 of an n-gram from those of its words: bytes that follow are zeros to the register, and add their own.
ORACLE["op11_importance_resampling"] = r"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') FROM benchmark
), hexed AS (
    SELECT word, octet_length(encode(word)) AS n, hex(encode(word)) AS h FROM (SELECT DISTINCT unnest(w) AS word FROM texts)
), bytes AS (
    SELECT word, n, list_transform(range(0, n), lambda i: CAST((strpos('0123456789ABCDEF', substr(h, CAST(2 * i + 1 AS INT), 1)) - 1) * 16
           + strpos('0123456789ABCDEF', substr(h, CAST(2 * i + 2 AS INT), 1)) - 1 AS BIGINT)) AS body FROM hexed
), crcs AS (
    SELECT word, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, body), lambda c, b: xor(STEPS[(xor(c, b) & 255) + 1], c >> 8))) AS crc FROM bytes
), spaced AS (
    SELECT word, n, crc, xor(crc, list_reduce(list_prepend(3916222277::BIGINT, range(0, n)), lambda c, i: xor(STEPS[(c & 255) + 1], c >> 8))) AS after_space FROM crcs
), places AS (
    SELECT kind, id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts
), ones AS (
    SELECT kind, id, crc, lead(n) OVER o AS n2, lead(after_space) OVER o AS s2, lead(n, 2) OVER o AS n3, lead(after_space, 2) OVER o AS s3
    FROM places JOIN spaced USING (word) WINDOW o AS (PARTITION BY kind, id ORDER BY i)
), twos AS (
    SELECT *, CASE WHEN n2 IS NOT NULL THEN xor(s2, list_reduce(list_prepend(crc, range(0, n2 + 1)), lambda c, k: xor(STEPS[(c & 255) + 1], c >> 8))) END AS crc2 FROM ones
), threes AS (
    SELECT *, CASE WHEN n3 IS NOT NULL THEN xor(s3, list_reduce(list_prepend(crc2, range(0, n3 + 1)), lambda c, k: xor(STEPS[(c & 255) + 1], c >> 8))) END AS crc3 FROM twos
), features AS (
    SELECT kind, id, crc % 10000 AS bucket FROM threes UNION ALL SELECT kind, id, crc2 % 10000 FROM threes WHERE crc2 IS NOT NULL
    UNION ALL SELECT kind, id, crc3 % 10000 FROM threes WHERE crc3 IS NOT NULL
), counts AS (
    SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM features GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts
), weights AS (
    SELECT id AS doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id
), scored AS (
    SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(len(w), 0) >= 20 AS takes_part,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM texts LEFT JOIN weights ON doc_id = id WHERE kind = 'd'
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY takes_part ORDER BY score DESC, doc_id) AS place, count(*) FILTER (takes_part) OVER () AS taking FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN takes_part AND place <= 5 * taking // 100 THEN place END AS rank FROM ranked
""".replace("STEPS", _crc_steps())


@_registered
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)


ORACLE["op12_exact_top_k"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_registered
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


ORACLE["op13_lexical_search"] = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM documents
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
), lengths AS (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), whole AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM lengths
), postings AS (
    SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, whole GROUP BY term, documents
), valued AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // length))) AS value
    FROM postings JOIN lengths USING (doc_id) JOIN weights USING (term), whole
), scored AS (
    SELECT item_id, doc_id, CAST(sum(value) AS BIGINT) AS score FROM asked JOIN valued USING (term) GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
