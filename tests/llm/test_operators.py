"""Each operator against its contract done plainly, on rows with nulls, repeats, ties and odd texts."""

import hashlib
import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fraudloom.llm import hnsw, licenses, linededup, mixing, quality_model, quality_rules, queries, simhash, tokencount, tokenfile
from fraudloom.llm.tokenfile import EliasFano

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _texts():
    rnd = random.Random(5)
    words = ["the", "of", "Été", "don't", "naïve", "日本", "x1", "license", "MIT", "und", "ran.", "ñandú", "C++", "12"]
    prose = [" ".join(rnd.choice(words) + str(rnd.randint(0, 60)) for _ in range(rnd.randint(55, 90))) for _ in range(12)]
    odd = [None, "", " \n\t", "a", "<|endoftext|>mid<|endoftext|> x", "İ ß é́ \x1c\x85", "  two  spaces \n x ",
           "Released under the MIT License. CC BY-NC 4.0\nApache License, Version 2.0 " * 3, "a " * 200, "b" * 3000]
    lines = ["A shared LINE of text  \nown 1", "a shared line of text\nown 2\n a shared line of text", "short\nshort\n\n"]
    near = prose[0].split()
    near[7] = "other"
    return [*prose, *odd, *lines, prose[1], prose[1], " ".join(near), "*** $$$ %%% " * 30]


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "en", [None, "a", "b", "c"][i % 4], len(t or "")) for i, t in enumerate(_texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def _got(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_bpe(docs, pairs):
    assert _got(queries.encoded_digests(docs)) == sorted(brute.byte_bpe(pairs))


def test_near_vectors(spark):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base[:5] + 0.02, base[:3], base[:1] * 9]))]
    rows += [(100, None), (101, []), (102, [0.0] * 8), (103, [None] + [1.0] * 7), (104, [float("nan")] * 8), (105, [1.0, 2.0])]
    found = hnsw.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert _got(found, "vec_id", "n_links", "component_id", "kept") == sorted(brute.near_vectors(rows))


def test_graph_recall():
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(200, 16))
    x = np.repeat(centres, 10, axis=0) + rnd.normal(size=(2000, 16)) * 0.02
    x /= np.linalg.norm(x, axis=1)[:, None]
    shard = hnsw.Shard(np.arange(len(x)), np.ones(len(x), int), x)
    beam = shard.audited_beam(x[::20], 0.95, 0.99)
    found = sum(len(r) for r, _ in shard.links(x[::20], 0.95, beam))
    assert found >= 0.99 * (x[::20] @ x.T >= 0.95).sum()


def test_search_enters_node_zero_once():
    graph = hnsw.Graph.__new__(hnsw.Graph)
    graph.x = np.eye(6, dtype=np.float32) + 1
    # node 0 stands ahead of the padding of every list
    graph.layers = [np.array([[1, 2, 3, 4, 5, -1], [0, 2, 3, 4, 5, -1], *[[0, 1, -1, -1, -1, -1]] * 4], np.int32)]
    ids, _ = graph.search(graph.x[1:3], 6, 0, np.array([1, 2]), 6)
    assert [sorted(row) for row in ids.tolist()] == [list(range(6))] * 2


@pytest.mark.parametrize("group", [0, 200])
def test_audit_sees_lost_pairs_beside_self_matches_and_a_large_group(group):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(400, 32))
    x = np.concatenate([x, x[:3] + 0.01 * rnd.normal(size=(3, 32)), x[-1] + 0.01 * rnd.normal(size=(group, 32))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    keys, crowd = np.arange(len(x)), np.arange(len(x)) >= 403

    class Narrow(hnsw.Shard):
        """Beams below 32 find matches with oneself and the group only."""

        def links(self, questions, least, beam):
            for rows, nodes in self.scan(questions, least):
                same = (questions[rows] * self.unit[nodes]).sum(axis=1) > 1 - 1e-12
                found = same | crowd[nodes] | (beam >= 32)
                yield rows[found], nodes[found]

    shard = Narrow(keys, np.ones(len(x), int), x)
    assert shard.audited_beam(x, 0.95, 0.99, own=keys) == 32
    assert shard.audited_beam(x[10:20], 0.95, 0.99, own=keys[10:20]) == 32  # no links of their own


@pytest.mark.parametrize("most", [0, 1 << 24])
@pytest.mark.parametrize("dense", [0, 10, 60])
def test_link_found_from_one_end_counts_at_both(dense, most):
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(60, 8))
    x = np.concatenate([x, x + 0.05 * rnd.normal(size=(60, 8)), x[:20] + 0.05 * rnd.normal(size=(20, 8))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = x[rnd.permutation(len(x))]
    copies = rnd.integers(1, 4, len(x))

    class OneWay(hnsw.Shard):
        """Finds links of later questions only; the first ``dense`` questions are left to scans."""

        def asked(self, questions, least, beam):
            numbers = (questions @ x.T).argmax(axis=1)
            left = numbers < dense
            for rows, nodes in self.scan(questions, least):
                keep = ~left[rows] & (numbers[rows] > self.keys[nodes])
                yield rows[keep], nodes[keep], np.flatnonzero(left)

    links = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    truth = brute.Groups()
    for a, b in zip(*np.nonzero(links)):
        truth.join(int(a), int(b))
    made = [OneWay(np.arange(len(x))[k::2], copies[k::2], x[k::2]) for k in (0, 1)]
    n, groups = np.zeros(len(x), int), brute.Groups()
    for first, second in ((0, 0), (0, 1), (1, 1)):
        s, t = made[first], made[second]
        n_s, n_t, root = hnsw.joint_links(s, t, 0.95, (16, 16), most)
        n[first::2] += n_s
        n[second::2] += n_t
        keys = s.keys if s is t else np.concatenate([s.keys, t.keys])
        for a, b in zip(keys.tolist(), keys[root].tolist()):
            groups.join(a, b)
    assert n.tolist() == (links @ copies).tolist() and links.sum() > 100
    assert [groups.root(i) for i in range(len(x))] == [truth.root(i) for i in range(len(x))]


def test_near_vectors_by_graphs_alone(spark):
    rnd = np.random.default_rng(11)
    x = rnd.normal(size=(2400, 16))
    x = np.concatenate([x, x[:150] + 0.1 * rnd.normal(size=(150, 16)), x[-1] + 0.05 * rnd.normal(size=(200, 16))])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>").repartition(3)
    found = hnsw.near_vectors(rows, min_shards=2, scan_share=1.0).orderBy("vec_id").collect()
    true = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = np.array([r.n_links for r in found])
    crowd = true > 20
    assert (got <= true).all() and crowd.sum() > 190 and ((true > 0) & ~crowd).sum() > 250
    for some in (crowd, (true > 0) & ~crowd):
        recall = (got[some] / true[some]).mean()
        print("recall", recall, some.sum())
        assert recall >= 0.99
    assert all((r.n_links > 0) or r.kept for r in found)


def test_licenses(docs, pairs):
    found = licenses.scan_licenses(docs)
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(_got(found, *columns), key=str) == sorted(brute.license_base(pairs), key=str)
    labels = {r.doc_id: r.labels for r in found.collect()}
    assert labels[19] == "apache-2,cc-by-nc,mit"
    assert found.where("score < 0 or score > 1 or (labels = '') <> (score = 0)").count() == 0
    assert len(licenses.signatures()) > 300


_SOFTWARE = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."
_WRITTEN = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal"),
    ("mit", "The above copyright notice and this permission notice shall be included in\n * all copies or substantial portions of the Software.\n" + _SOFTWARE),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("bsd-0", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _SOFTWARE.title()),
    ("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"),
    ("bsd,bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the University of X nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "3. All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License."),
    ("apache-2", "# you may not use this file except in compliance with the License."),
    ("apache-2", "software\n// distributed under the License is distributed on an \"AS IS\" BASIS,"),
    ("gpl-3", "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("gpl-2", "the GNU General Public License as published by the Free Software Foundation, version 2"),
    ("gpl", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("lgpl-2.1", "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("lgpl-3", "the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("agpl-3", "the GNU Affero General Public License as published by the Free Software Foundation, either version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which"),
    ("epl-1", "the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("cddl", "The contents of this file are subject to the terms of the Common Development and Distribution License (the License)."),
    ("zlib", "In no event will the authors be held liable for any damages arising from the use of this software."),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("openssl", "This product includes software developed by the OpenSSL Project for use in"),
    ("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("postgresql", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement"),
    ("cc0", "The person has dedicated the work to the public domain by waiving"),
    ("proprietary", "Unauthorized copying of this file, via any medium is strictly prohibited"),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License"),
    ("mit", "// SPDX-License-Identifier: MIT"), ("mit", "License: MIT"), ("mit-0", "SPDX-License-Identifier: MIT-0"),
    ("apache-2,mit", "SPDX-License-Identifier: MIT OR Apache-2.0"), ("bsd-3", "\"license\": \"BSD-3-Clause\","),
    ("gpl-2", "/* SPDX-License-Identifier: GPL-2.0-or-later */"), ("isc", "license = \"ISC\""),
    ("", "A mit of wool, under 3 covers; version 2 of the plan was 1.1 pages."), ("", "You may use this file as you like."),
]


def test_written_notices_and_headers(spark):
    cases = _WRITTEN + [(label, f"x\n# SPDX-License-Identifier: {words.upper().replace(' ', '-')}\ny")
                        for label, words in licenses.IDENTIFIERS] + [
        (label, f'  "license": "{words.replace(" ", "-")}"') for label, words in licenses.IDENTIFIERS]
    rows = [(i, text) for i, (_, text) in enumerate(cases)]
    found = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    wrong = []
    for i, labels in found.items():
        base = {"cc-by-nc"} if "CC-BY-NC" in cases[i][1].upper() else set()  # a base phrase is always reported
        if set(filter(None, labels.split(","))) != base | set(filter(None, cases[i][0].split(","))):
            wrong.append((cases[i], labels))
    assert not wrong and len(cases) > 150
    # every keyword is more than a number or two letters
    assert all(len(k) > 2 and not k.replace(" ", "").isdigit() for _, _, _, k, _ in licenses.signatures())


def test_contained_match_of_same_or_worse_priority_is_suppressed(spark):
    text = "Licensed under the GNU General Public License, version 3."
    found = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert found.labels == "gpl-3"


def test_lines(docs, pairs):
    expected = [(d, n, k, text or "") for d, n, k, text in brute.dedup_lines(pairs)]
    assert [(a, b, c, d or "") for a, b, c, d in _got(linededup.dedup_lines(docs).fillna("", ["text"]), "doc_id", "n_lines", "n_dropped", "text")] == sorted(expected)


def test_lines_of_one_key_over_many_partitions(spark):
    rows = [(i, "the very same line\nown line number %d" % i) for i in range(400)]
    found = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert found.where("n_dropped = 0").select("doc_id").collect() == [(0,)]


def test_elias_fano():
    rnd = np.random.default_rng(1)
    for values in ([], [0], [5, 5, 5], np.sort(rnd.integers(0, 1 << 40, 3000)), np.arange(1000)):
        made = EliasFano.from_bytes(EliasFano.build(np.array(values, np.uint64)).to_bytes())
        assert list(made) == list(values)
        assert all(made.select(i) == v for i, v in list(enumerate(values))[::37])


def test_token_files(docs, pairs):
    manifest = tokenfile.write_token_files(docs, queries.WORD_BPE, 1, segment_ids=500)
    assert manifest.count() > 4
    assert _got(tokenfile.read_token_files(manifest)) == sorted(brute.token_files(pairs))


@pytest.mark.parametrize("hot", [None, 77])
def test_token_files_of_one_id_are_shared_by_tasks(spark, hot):
    rnd = random.Random(4)
    rows = [(i if i % 3 else hot, " ".join(str(rnd.randint(0, 999)) for _ in range(30))) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    manifest = tokenfile.write_token_files(table, queries.WORD_BPE, 1)
    found = tokenfile.read_token_files(manifest).orderBy("start").collect()
    plain = {t: n for _, n, t in ((d, n, c) for d, _, n, c in brute.token_files([(i, t) for i, (_, t) in enumerate(rows)]))}
    assert [r.start for r in found] == list(np.cumsum([0] + [r.n_tokens for r in found])[:-1])
    named = [r.doc_id for r in found if r.doc_id is not None]
    assert named == sorted(named) and len(found) == 900 and found[0].doc_id is None or hot
    assert Counter((r.doc_id, r.ids_crc32, r.n_tokens) for r in found) == Counter(
        (d, c, plain[c]) for (d, _), (_, _, _, c) in zip(rows, brute.token_files([(i, t) for i, (_, t) in enumerate(rows)])))
    assert manifest.where("n_docs > 0").count() > 4


def test_encoder_equals_the_library_on_latin_and_other_texts():
    encoder = tokenfile.ChunkEncoder(tokenfile.Tokenizer.from_file(queries.WORD_BPE), 2, remember=50)
    chars = [chr(c) for c in range(0x21, 0x260)] + list("日本İ’«ΣσѢﬁ\u0301\u1e9e\ua7f1 \n\t\x85\xa0\u3000")
    rnd = random.Random(6)
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    texts += ["".join((c, c.upper(), "a", c)) for c in chars] + ["it's IT'S", "", " \n ", "<|endoftext|> <|startoftext|>x"]
    for at in range(0, len(texts), 200):
        some = texts[at:at + 200]
        ids, ends = encoder.encode(some)
        for text, found in zip(some, np.split(ids, ends[:-1])):
            assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_span_of_a_written_file(tmp_path):
    writer = tokenfile.SegmentWriter(f"{tmp_path}/one.tok", 2)  # more documents than a sample step
    for i in range(700):
        writer.add(10 + i, bytes(2 * (i % 9)))
    writer.close()
    reader = tokenfile.SegmentReader(f"{tmp_path}/one.tok")
    spans = [(first, first + len(ids)) for _, first, ids in reader.documents()]
    assert [reader.span(i) for i in range(700)] == spans and spans[-1][1] == sum(i % 9 for i in range(700))


def test_token_counts(docs, pairs):
    assert _got(tokencount.count_tokens(docs, queries.BYTE_BPE)) == sorted(brute.token_counts(pairs))
    # with hardly any frequent pre-tokens nearly all go through the join
    assert _got(tokencount.count_tokens(docs, queries.BYTE_BPE, frequent=3)) == sorted(brute.token_counts(pairs))


def test_quality_rules(docs, pairs):
    found = quality_rules.judge(docs)
    assert _got(found.drop("kept")) == sorted(brute.quality_measures(pairs))
    assert {r.doc_id for r in found.where("kept").collect()} == {r.doc_id for r in quality_rules.keep(docs).collect()}
    assert found.where("kept and base_failed").count() == 0


def test_classifier_learns_and_scores_all(spark):
    good = [(i, "plain words in a row number %d. " % i * 20) for i in range(60)]
    bad = [(100 + i, "$$$ *** %%% ### " * (20 + i)) for i in range(60)]
    docs = spark.createDataFrame([*good, *bad, (500, None), (501, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in [*good, *bad]], "doc_id bigint, quality int")
    found = {r.doc_id: r for r in quality_model.score_quality(docs, labels).collect()}
    assert len(found) == 122 and all(0 <= r.score <= 1 for r in found.values())
    assert all(found[i].predicted == 1 for i, _ in good) and all(found[i].predicted == 0 for i, _ in bad)
    alone = quality_model.score_quality(docs, labels.where("quality = 1"))
    assert alone.where("score = 1").count() == 122


def test_simhash(docs, pairs):
    found = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert _got(found) == sorted(brute.simhash(pairs))


@pytest.mark.parametrize("hot, parts", [(4, 64), (4, 2), (1, 0), (4096, 64)])
def test_fingerprint_links(spark, hot, parts):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(20)]
    near = [b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(1, 5))) for b in base for _ in range(8)]
    fps = sorted(set(base + near))
    links = simhash.link_fingerprints(
        spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint"), hot_entries=hot, most_parts=parts).collect()
    truth, found = brute.Groups(), brute.Groups()
    for f in fps:
        for g in fps:
            if (f ^ g).bit_count() <= 3:
                truth.join(f, g)
        found.root(f)
    for a, b in links:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
        found.join(a & (1 << 64) - 1, b & (1 << 64) - 1)
    assert all(truth.root(f) == found.root(f) for f in fps)


def test_rows_of_a_very_hot_key_are_linear_in_its_entries(spark):
    """All fingerprints agree in 32 bits; the third segment deals them out."""
    rnd = np.random.default_rng(3)
    low = np.unique(rnd.integers(0, 1 << 32, 3000))
    near = np.unique(np.concatenate([low, low[:200] ^ 5, low[200:300] ^ (1 << 20)]))
    counted = {}
    for n in (len(near) // 2, len(near)):
        batch = simhash.pa.RecordBatch.from_pydict({
            "key": np.repeat(np.int64(7 << 16), 2 * n), "fp": np.tile(near[:n].astype(np.int64), 2),
            "probe": np.repeat([False, True], n)})
        counted[n] = sum(b.num_rows for b in simhash._third_segments(iter([batch])))
    assert counted[len(near)] <= 138 * len(near) and counted[len(near)] < 2.1 * counted[len(near) // 2]
    fps = spark.createDataFrame([(int(f),) for f in near], "fp bigint")
    links = simhash.link_fingerprints(fps, hot_entries=16, most_parts=4).collect()
    truth, found = brute.Groups(), brute.Groups()
    for i in near.tolist():
        found.root(i)
        for j in near[np.bitwise_count(near ^ i) <= 3].tolist():
            truth.join(i, j)
    for a, b in links:
        found.join(a, b)
    assert all(truth.root(i) == found.root(i) for i in near.tolist())


def test_columns_of_any_name_pass_through(spark, docs):
    """Names that operators use inside."""
    extra = {c: F.lit(c) for c in ("text_key", "own_doc", "h1", "h2", "row", "piece", "fp", "bitmap", "m_doc", "key")}
    wide = docs.withColumns(extra)
    for made in (linededup.dedup_lines(wide), mixing.mix(wide), quality_rules.keep(wide), queries.bpe.encode(
            wide, queries.RANKS, queries.public_tokenizers.PATTERN)):
        rows = made.select(*extra, "doc_id").collect()
        assert rows and all(tuple(r)[:-1] == tuple(extra) for r in rows)
    shorter = {r.doc_id: (r.text, r.n_dropped) for r in linededup.dedup_lines(docs).collect()}
    assert {r.doc_id: (r.text, r.n_dropped) for r in linededup.dedup_lines(wide).collect()} == shorter
    assert _got(simhash.near_duplicates(wide)) == _got(simhash.near_duplicates(docs))
    assert _got(tokencount.count_tokens(wide, queries.BYTE_BPE)) == _got(tokencount.count_tokens(docs, queries.BYTE_BPE))


def test_long_pre_tokens_are_not_sent_to_all_tasks(spark):
    rows = [(i, "x" * 70 + " " + "y" * 64) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _got(tokencount.count_tokens(table, queries.BYTE_BPE)) == sorted(brute.token_counts(rows))


def test_workers_keep_the_collector_on_and_no_texts(spark, docs):
    """After encoding, a worker's collector runs and its memory is bounded."""
    def state(batches):
        import gc
        for batch in batches:
            yield batch.select([]).append_column("on", simhash.pa.array([gc.isenabled()] * batch.num_rows))

    queries.encoded_digests(docs).count()
    tokenfile.read_token_files(tokenfile.write_token_files(docs, queries.WORD_BPE, 1)).count()
    assert {r.on for r in docs.select("doc_id").mapInArrow(state, "on boolean").collect()} == {True}


def test_transducer_that_forgets():
    """With hardly any states kept the tokens are the same."""
    from fraudloom.llm.bpe import Transducer
    rnd = random.Random(8)
    ranks = queries.bpe.read_ranks(queries.RANKS)
    words = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(1, 90))).encode() for _ in range(400)]
    small, large = Transducer(ranks, max_states=60), Transducer(ranks)
    ids, ends = small.encode_all(words, block=16)
    again, places = large.encode_all(words)
    assert ids.tolist() == again.tolist() and ends.tolist() == places.tolist()
    assert [small.encode(w) for w in words] == [ids[b:e].tobytes() for b, e in zip([0, *ends[:-1]], ends)]
    assert len(small.final) < 60 * 100


def test_library_classes_of_characters(pairs):
    """Characters that the two libraries class differently, after letters and digits and before contractions."""
    texts = [t for c in [*range(0x250, 0x30000, 41), 0x209D, 0x18F56, 0x11DBA] if not 0xD800 <= c < 0xE000
             for t in (chr(c) + "'s", f"a{chr(c)}1{chr(c)} {chr(c)}", f" {chr(c)}'ll")]
    encoder = queries.bpe.TextEncoder(queries.bpe.read_ranks(queries.RANKS), queries.public_tokenizers.PATTERN)
    ids, ends = encoder.encode(texts)
    own = [(len(i), hashlib.sha256(i.astype("<u4").tobytes()).hexdigest()) for i in np.split(ids, ends[:-1])]
    assert own == [row[1:3] for row in brute.byte_bpe(list(enumerate(texts)))]


def test_mix(spark):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randint(0, 40), "en", rnd.choice([None, "a", "b", "c", "d"]), 0) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.plan_mix(docs, bucket_rows=7).collect()
    held, taken, target = Counter(), Counter(), {}
    for r in plan:
        held[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
        assert r.copies in (0, 1, 2)
    assert len(plan) == 600
    expected = brute.targets(held)
    assert all(abs(target[s] - expected[s]) < 1e-6 and abs(taken[s] - target[s]) <= 1 for s in held)
    again = mixing.plan_mix(docs.repartition(7), bucket_rows=7).collect()
    assert sorted(map(str, again)) == sorted(map(str, plan))
    assert mixing.mix(docs).groupBy("doc_id").count().where("count > 2").count() == 0
    assert mixing.mix(docs).count() == sum(r.copies for r in mixing.plan_mix(docs).collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for made in (
        queries.encoded_digests(none), licenses.scan_licenses(none), linededup.dedup_lines(none),
        tokenfile.read_token_files(tokenfile.write_token_files(none, queries.WORD_BPE, 1)), mixing.mix(none),
        tokencount.count_tokens(none, queries.BYTE_BPE), quality_rules.judge(none), simhash.near_duplicates(none),
        quality_model.score_quality(none, spark.createDataFrame([], "doc_id bigint, quality int")),
        hnsw.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<double>")),
    ):
        assert made.count() == 0


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == corpus_pipeline.COLUMNS, name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert {r.doc_id for r in out} == set(texts)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in out)


def test_pipeline_keeps_one_row_of_each_group_with_null_and_repeated_ids(spark):
    rnd = random.Random(9)
    texts = [" ".join(str(rnd.getrandbits(40)) for _ in range(60)) for _ in range(12)]
    ids = [None, None, None, None, 1, 2, 2, 5, 5, 5, 7, None]
    rows = [(i, t, "en", "a", len(t)) for i, t in zip(ids, texts)]
    rows += [(1, texts[5], "en", "a", len(texts[5])), (2, texts[7], "en", "a", len(texts[7]))]  # smaller ids of two groups
    rows += [rows[0], rows[4], (9, texts[1], "en", "a", len(texts[1])), (None, texts[10], None, "a", len(texts[10]))]
    rows += [(None, None, "en", None, None), (None, "", None, "en", None), (None, texts[0], None, "a", len(texts[0]))]
    found = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    got = sorted(((r.doc_id, r.text or "") for r in found.collect()), key=str)
    smallest = {1: 9, 5: 1, 7: 2}
    assert got == sorted([(None, ""), *((smallest.get(k, i), t) for k, (i, t) in enumerate(zip(ids, texts)))], key=str)


def test_license_words_are_counted_without_lists(spark):
    """Words in all their places, and the gate lets through what its stems alone let through."""
    texts = ["", " ", "a", " a", "a ", "-A\x7fb\x00", "Ünï 中文 \U0001f600x", "1:2@3[4`5{6", "\x80", "x" * 70_000, "a " * 70_000, None]
    texts += [w.upper() for w in ("mit-license", "sublicence", "agpl", "0bsd", "CC  by", "ms-pl", "eupl", "mit 0", "cc0", "shall be included")]
    texts += ["hereby, granted", "held liable", "tissue", "unlicensed", "mi", "mit", "MIT."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = licenses.scan_licenses(docs)
    assert "regexp_extract_all" not in str(licenses._n_words(F.col("text")))
    words = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    assert {r.doc_id: r.n_words for r in found.collect()} == {i: len(words.findall(t or "")) for i, t in enumerate(texts)}
    text = F.coalesce("text", F.lit(""))
    assert docs.where(text.rlike("(?i)" + licenses._STEMS) != text.rlike(licenses._GATE)).count() == 0
    assert licenses._GATE.startswith("(?i)(?=")
