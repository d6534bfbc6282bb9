"""The registered queries: against their SQL, or against brute force on whole tables."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tablegate.llm import fingerprint, linededup, neardup, packing
from tablegate.llm.queries import ORACLE, REGISTRY, vocabulary
from tablegate.llm.store import kept
from tests.llm.tables import awkward_rows, edited, empty, prose
from tests.llm.test_decontam import brute
from tests.llm.test_duplicates import linked

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small():
    return {t: pq.read_table(f"{SMALL}/{t}.parquet").to_pylist() for t in ("documents", "benchmark", "pages")}


def test_every_operator_is_registered_once():
    assert sorted(int(q[2:].split("_")[0]) for q in REGISTRY) == list(range(1, 14))
    import __spark_entry__

    assert {*REGISTRY, "pipeline"} <= __spark_entry__.queries().keys() and ORACLE.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = REGISTRY[name](spark, SMALL)
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(names)
    key = lambda row: tuple(map(str, row))
    assert sorted(map(key, got.select(names).collect())) == sorted(map(key, found.fetchall()))


def test_op5_is_all_pairs(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small["documents"]]
    groups, sets = linked(rows, 2, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in REGISTRY["op5_minhash_near_dedup"](spark, SMALL).collect()}
    assert got == {i: (len(s), groups.find(i), groups.find(i) == i) for i, s in sets}


def test_op4_and_op7_are_the_library_s(spark, small):
    rows = sorted((r["doc_id"], r["text"]) for r in small["documents"])
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json")).encode_batch([t for _, t in rows], add_special_tokens=False)
    start = 0
    got = {r.doc_id: r for r in REGISTRY["op7_token_files"](spark, SMALL).collect()}
    for (i, _), e in zip(rows, library):
        ids = np.array([*e.ids, 2], "<u4")
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")).encode_batch([t for _, t in rows], add_special_tokens=False)
    ids = {i: np.array([*e.ids, 0], "<u4") for (i, _), e in zip(rows, library)}
    packed = REGISTRY["op4_best_fit_packing"](spark, SMALL).collect()
    assert len({r.sequence_id for r in packed}) <= -(-sum(map(len, ids.values())) // 2048) + 1
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())


def test_op10_tells_edits_from_others(spark, small):
    got = REGISTRY["op10_document_fingerprints"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in small["documents"]}
    assert {r.doc_id: r.n_chars for r in got} == {i: len(t) for i, t in texts.items()}
    assert all(r.fingerprint == fingerprint.as_text(fingerprint.fingerprints([texts[r.doc_id]])[0]) for r in got[::20])
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.98


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents in two languages with copies, shared lines and leaks, beside a benchmark."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    german = lambda k, n: prose(k, n).translate(str.maketrans("aeou", "äöüß"))
    rows = [(k, (prose if k % 2 else german)(k, 60), "en" if k % 2 else "de") for k in range(60)]
    rows += [(100 + k, prose(k, 60).replace(" ", "\n", 1), "en") for k in range(1, 21, 2)]
    rows += [(200 + k, edited(prose(k, 60), k, 0.01 * (k % 5)), None) for k in range(1, 41, 2)]
    rows += [(300 + k, prose(300 + k, 20) + "\nthe same boilerplate line stands in many documents\n" + prose(400 + k, 9), "en") for k in range(10)]
    rows += [(400, prose(900, 25) + " " + prose(77, 40), "en"), (401, prose(901, 25).upper() + "\n" + prose(902, 30), "en")]
    rows += [(500 + k, t, None) for k, (_, t) in enumerate(awkward_rows()) if t is None or len(t) < 9000]
    docs = spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows], empty(spark).schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, prose(900, 25)), (2, prose(901, 25))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_do_their_whole_job(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, benchmark = docs.columns, [(1, prose(900, 25)), (2, prose(901, 25))]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        result = kept(stage(spark, docs, corpus), name)
        after = {r.doc_id: r.text for r in result.collect()} if name != "best_fit_packing" else {}
        if name == "language_id":
            gone = before.keys() - after.keys()
            assert gone >= {i for i, t in before.items() if not any(c.isalpha() for c in t or "")} and all(i >= 500 for i in gone)
            assert all(before[i] == t for i, t in after.items())
        elif name == "line_dedup":
            dropped = {(r.doc_id, r.line_no) for r in linededup.duplicates(docs).collect()}
            want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in dropped) for i, t in before.items()}
            assert after == {i: t for i, t in want.items() if t.strip()} and len(after) < len(before)
            assert sum("boilerplate" in t for t in after.values()) == 1
        elif name == "near_dedup":
            groups, _ = linked(list(before.items()), 5, neardup.PERCENT)
            assert after == {i: t for i, t in before.items() if groups.find(i) == i} and len(after) < len(before)
        elif name == "decontamination":
            leaking = {d for d, _ in brute(list(before.items()), benchmark)}
            assert leaking >= {400, 401} and after == {i: t for i, t in before.items() if i not in leaking}
        if after:
            assert result.columns == columns
        docs = result if after else docs
    assert {r.doc_id for r in result.collect()} == {r.doc_id for r in docs.collect()}
    assert result.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= packing.CAPACITY


def test_rows_without_or_with_shared_ids_are_documents_of_their_own(spark, corpus):
    line = "the same boilerplate line stands in many documents"
    texts = [prose(900, 25), prose(501, 40), prose(502, 40), prose(502, 40), f"{line}\n{prose(503, 30)}", f"{line}\n{prose(504, 30)}"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i in (None, 7) for t in texts], empty(spark).schema).coalesce(1)
    cut = {f"{line}\n{prose(k, 30)}": prose(k, 30) for k in (503, 504)}
    run = lambda name: sorted((str(r.doc_id), r.text) for r in dict(corpus_pipeline.STAGES)[name](spark, docs, corpus).collect())
    assert run("decontamination") == sorted((str(i), t) for i in (None, 7) for t in texts[1:])
    assert run("near_dedup") == sorted(("7", t) for t in dict.fromkeys(texts))
    got = run("line_dedup")
    assert sorted(t for _, t in got) == sorted([texts[0], texts[1], texts[2], texts[4], cut[texts[5]]]) and {i for i, _ in got} == {"None"}


def test_columns_of_the_caller_s_stay(spark, corpus):
    names = ["__row", "__language", "__score", "__gone", "__cut", "row", "component_id"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet").selectExpr("*", *[f"'mine' AS {n}" for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, corpus)
        assert result.columns == docs.columns and result.select(*names).distinct().collect() == [("mine",) * len(names)], name


def test_stages_take_empty_tables(spark, corpus):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), corpus).count() == 0, name


def test_pipeline_runs(spark):
    result = corpus_pipeline.run(spark, SMALL)
    assert result.count() > 100 and result.columns[:2] == ["doc_id", "piece"]
