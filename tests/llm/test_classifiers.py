"""The trained operators: gradients, held-out accuracy, awkward rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablegate.llm import langid, licenses, quality
from tablegate.llm.queries import REGISTRY, fold
from tablegate.llm.text import buffers
from tests.conftest import SF_DIR
from tests.llm.tables import EXTRA, awkward, awkward_rows, empty, prose


def test_gradients_are_the_slopes_of_the_loss():
    draw = np.random.default_rng(1)
    network = langid.Network(["a", "b", "c"])
    network.weights = {k: (v + draw.normal(size=v.shape) * 0.2).astype(np.float64) for k, v in network.weights.items()}
    data = draw.integers(97, 101, (7, 4)).astype(np.uint8)
    labels, weight = np.array([0, 1, 2, 1]), draw.random((7, 4))
    _, found = network.gradients(data, labels, weight)
    for name, slope in found.items():
        for at in list(np.ndindex(slope.shape))[:: max(1, slope.size // 20)] + [(98, 3), (99, 17)] * (name[:2] == "in"):
            was = network.weights[name][at]
            losses = []
            for step in (1e-3, -1e-3):
                network.weights[name][at] = was + step
                losses.append(network.gradients(data, labels, weight)[0])
            network.weights[name][at] = was
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(slope[at], rel=0.03, abs=2e-5)


def test_windows_hold_every_byte_once():
    texts = ["", "a" * 95, "b" * 96, "c" * 97, "é" * 100, None]
    data, offsets = buffers(pa.array(texts))
    windows, owner = langid.windows_of(data, offsets)
    for i, text in enumerate(texts):
        assert windows[owner == i].tobytes().rstrip(b"\0") == (text or "").encode()
    assert np.bincount(owner, minlength=6).tolist() == [0, 1, 1, 2, 3, 0]


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return langid.learn(docs.filter(fold("doc_id", 4) != 2))


def test_languages_of_held_out_documents(spark, network):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter(fold("doc_id", 4) == 2)
    got = langid.predict(docs, network)
    assert got.columns == [*docs.columns, "lang_pred", "score"]
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97


def test_languages_of_awkward_rows(spark, network):
    docs = awkward(spark)
    got = langid.predict(docs, network).collect()
    assert len(got) == len(awkward_rows()) and set(langid.predict(docs, network).columns) == {"doc_id", "text", *EXTRA}
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and (0 < r.score <= 1 if letters else r.score == 0)
    again = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in got}
    assert again[(50, docs.filter("doc_id = 50").first().text)] and len({r.score for r in got if r.doc_id in (23, 24)}) == 1


def test_nothing_to_learn_languages_from(spark):
    assert langid.learn(empty(spark)) is None
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    assert langid.learn(docs) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(empty(spark), None).count() == 0


def test_one_language(spark):
    docs = spark.createDataFrame([(1, "some words here", "en"), (2, "and more words", "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, langid.learn(docs)).collect()} == {("en", 1.0)}


def test_quality_of_held_out_documents(spark):
    got = REGISTRY["op1_quality"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labelled = docs.select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, 1).when(F.col("doc_id") > 20, 0).when(F.col("doc_id") == 12, 7).alias("label"))
    weights = quality.learn(labelled)
    assert np.abs(weights).max() > 0
    got = quality.predict(docs, weights)
    assert set(got.columns) == set(docs.columns) and got.count() == len(awkward_rows())
    rows = got.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1  # the bias
    assert not quality.learn(labelled.filter("label = 1")).any() and not quality.learn(labelled.limit(0)).any()
    assert quality.predict(empty(spark), weights).count() == 0


def test_scores_are_sparse_dot_products():
    weights = np.random.default_rng(2).normal(size=1 << quality.BITS).astype(np.float32)
    texts = ["", "a b b", "x! x! 12 x! x!", "é a", None]
    data, offsets = buffers(pa.array(texts))
    numbers, bounds, same, again = quality.features(data, offsets)
    assert np.diff(bounds).tolist() == [0, 5, 17, 3, 0] and same.tolist() == [0, 1 / 3, 0, 0, 0]
    assert again.tolist() == [0, 0, 0, 0, 0] or again[2] >= 0
    for i, score in enumerate(quality.scores(weights, data, offsets)):
        own = weights[numbers[bounds[i] : bounds[i + 1]]].astype(float)
        total = quality.SCALE * ((own.mean() if len(own) else 0) + weights[quality.SAME] * same[i] + weights[quality.AGAIN] * again[i])
        assert score == pytest.approx(1 / (1 + np.exp(-(total + weights[quality.BIAS]))), abs=1e-5)


def test_repeats_are_counted():
    data, offsets = buffers(pa.array(["a b c a b c a b c", "a b c d", "a b c"]))
    hashes, bounds = quality._words(data, offsets)
    assert quality._repeats(hashes, bounds).tolist() == [4, 0, 0]


@pytest.fixture(scope="module")
def licence_model(spark):
    return licenses.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_notices_are_found_and_only_notices(spark, licence_model):
    plain = "the words of this line say that a version of the work is free and that all may use it"
    rows = [(k, f"{plain}\n{t.upper() if k % 2 else t}.\n{plain}") for k, t in enumerate(x for f in sorted(licenses.TEMPLATES) for x in licenses.TEMPLATES[f])]
    want = {(k, 1, f) for k, f in enumerate(f for f in sorted(licenses.TEMPLATES) for _ in licenses.TEMPLATES[f])}
    long = (plain + " ") * 12
    rows += [(900, plain), (901, long + "Released under the MIT License. " + long), (902, "the MIT of all rights"), (903, "public license general")]
    got = {(r.doc_id, r.line_no, r.family) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).collect()}
    assert len(want & got) >= 0.9 * len(want) and not {g for g in got if g[0] in (900, 902, 903)}
    assert (901, 0, "MIT") in got and {g[2] for g in got - want - {(901, 0, "MIT")}} <= set(licenses.TEMPLATES)


def test_notices_of_the_documents(spark, licence_model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL", "All rights reserved.": "proprietary",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    want = {(r.doc_id, k, known[x]) for r in docs.collect() for k, x in enumerate(r.text.split("\n")) if x in known}
    assert {(r.doc_id, r.line_no, r.family) for r in licenses.scan(docs, licence_model).collect()} == want


def test_wrapped_and_dual_notices(spark, licence_model):
    wrapped = {
        "MIT": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files",
        "BSD": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following\n * conditions are met:",
        "GPL": "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as published by\n// the Free Software Foundation",
        "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General\nPublic License as published by the Free Software Foundation",
        "proprietary": "All rights\nreserved.",
    }
    dual = {
        "Licensed under the MIT License or the Apache License, Version 2.0": {"MIT", "Apache-2.0"},
        "Licensed under CC BY-NC 4.0. All rights reserved.": {"CC-BY-NC", "proprietary"},
        "This work is licensed under the GNU Lesser General Public License, version 3": {"LGPL"},
    }
    rows = [(k, f"some words before\n\nand beside\n{t}\nand after") for k, t in enumerate([*wrapped.values(), *dual])]
    rows += [(50, "Released under the MIT License.\n" * 40 + "\nall rights\n\nreserved")]
    want = {(k, 3, f) for k, f in enumerate(wrapped)} | {(len(wrapped) + k, 3, f) for k, own in enumerate(dual.values()) for f in own}
    want |= {(50, k, "MIT") for k in range(40)}
    got = [(r.doc_id, r.line_no, r.family) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).collect()]
    assert set(got) == want and len(got) == len(want)


def test_every_template_is_found(spark, licence_model):
    rows = [(k, f"x\n{t}.") for k, t in enumerate(t for f in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[f])]
    want = {(k, 1, f) for k, f in enumerate(f for f in sorted(licenses.TEMPLATES) for _ in licenses.TEMPLATES[f])}
    got = {(r.doc_id, r.line_no, r.family) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).collect()}
    assert got == want


def test_awkward_rows_hold_no_notice(spark, licence_model):
    assert licenses.scan(awkward(spark), licence_model).count() == 0
    assert licenses.scan(empty(spark), licenses.learn(empty(spark))).count() == 0
    rows = [(None, "Released under the MIT License."), (1, "x\n\nReleased under the MIT License."), (1, "x\n\nReleased under the MIT License.")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).collect()
    assert sorted((str(r.doc_id), r.line_no, r.family) for r in got) == [("1", 2, "MIT"), ("1", 2, "MIT"), ("None", 0, "MIT")]


def test_samples_are_bounded_whatever_ids_say(spark):
    rows = [(k, f"{prose(k, 8)}", "en") for k in range(200)] + [(500, prose(1, 5), "en")] * 100
    for ids in (lambda k: k, lambda k: None, lambda k: 7):
        df = spark.createDataFrame([(ids(k), t, lang) for k, t, lang in rows], "doc_id long, text string, lang string")
        taken = [sorted(map(str, langid.bounded_sample(df.repartition(n), "doc_id", 20).collect())) for n in (1, 7)]
        assert len(taken[0]) == 20 and taken[0] == taken[1]
    assert langid.bounded_sample(df.limit(0), "doc_id", 20).count() == 0


def test_networks_don_t_depend_on_partitions(spark):
    rows = [(k % 5, prose(k, 40) if k % 2 else prose(k, 40).translate(str.maketrans("aeou", "äöüß")), "en" if k % 2 else "de") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, seven = (langid.learn(df.repartition(n), 30) for n in (1, 7))
    assert all(np.array_equal(a, b) for a, b in zip(one.weights.values(), seven.weights.values()))


def test_licences_are_told_apart(spark, licence_model):
    apart = "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3"
    want = {
        "Licensed under the Mozilla Public License, Version 2.0": {"MPL-2.0"},
        "This program is made available under the terms of the Eclipse Public License 2.0": {"EPL-2.0"},
        "Licensed under the EUPL, Version 1.2": {"EUPL-1.2"},
        f"This program is free software: {apart}": {"AGPL"},
        "SPDX-License-Identifier: AGPL-3.0-or-later": {"AGPL"},
        "SPDX-License-Identifier: LGPL-3.0-or-later": {"LGPL"},
        "SPDX-License-Identifier: ISC": {"ISC"},
        "SPDX-License-Identifier: BSD-2-Clause": {"BSD"},
        "Licensed under CC BY-ND 4.0": {"CC-BY-ND"},
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": {"CC-BY-NC-SA"},
        "The MIT License (MIT)": {"MIT"},
        "MIT License\n\nCopyright (c) 2024 Somebody\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": {"MIT"},
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": {"GPL"},
        # of licences that it doesn't know it names none
        "Licensed under the Unlicense, Version 2.0": set(),
        "Licensed under the Server Side Public License, Version 1.0": set(),
        "SPDX-License-Identifier: Zlib": set(),
        "This work is licensed under the Open Data Commons Open Database License, version 1": set(),
        "Licensed under the Aladdin Free Public License, Version 9": set(),
        "Licensed under the Microsoft Public License, Version 2.0": set(),
    }
    for model in (licence_model, licenses.learn(empty(spark))):
        df = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
        got: dict[int, set[str]] = {}
        for r in licenses.scan(df, model).collect():
            got.setdefault(r.doc_id, set()).add(r.family)
        assert {t: got.get(k, set()) for k, t in enumerate(want)} == want
