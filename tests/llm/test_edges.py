"""Every operator on odd rows and on empty tables."""

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import (chat_format, decontamination, license_scan, mixing, near_dedup, quality_classifier, quality_rules, sharding,
                          text, toxicity, url_filter)

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 1, 1), (6, 1, 0), (None, 1, 1), (8, None, None), (99, 0, 1), (7, 3, 9)], LABELS)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "w0 w2916 w829 w3745 w1658"), (2, None), (None, ""), (3, "one"), (1, "w0 w2916 w829 w3745 w1658")],
                                 "item_id long, text string")


def by_id(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key] or 0))


def test_quality_rules(odd):
    rows = by_id(quality_rules.judged(odd))
    assert len(rows) == 11
    nothing = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert all(r["n_words"] == r["word_chars"] == 0 and r["base_failed"] and not r["kept"] for r in nothing)
    eight = next(r for r in rows if r["doc_id"] == 8)
    # a no-break space does not part words; code points count, not bytes
    assert (eight["n_words"], eight["word_chars"], eight["n_dup_lines"]) == (5, 3 + 6 + 1 + 4 + 4, 1)


def test_scores(odd, labels):
    for module, label in ((toxicity, "toxic"), (quality_classifier, "quality")):
        rows = by_id(module.score(odd, module.train(odd, labels)))
        assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
        empty = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
        assert len(empty) == 1


def test_without_labels(odd, labels):
    for module in (toxicity, quality_classifier):
        rows = module.score(odd, module.train(odd, labels.where("false"))).collect()
        assert len(rows) == 11 and all(abs(r["score"] - 0.5) < 0.01 for r in rows)


def test_stages_keep_odd_rows(odd, labels, benchmark):
    kept = toxicity.without_toxic(odd, toxicity.train(odd, labels.where("false")), limit=0.9)
    assert kept.columns == odd.columns and kept.count() == 11
    kept = near_dedup.one_of_each_group(odd)
    # 6 repeats 5, the second 7 its own row and 4; rows without an id stay
    assert kept.columns == odd.columns and sorted(str(r[0]) for r in kept.select("doc_id").collect()) == ["1", "2", "3", "4", "5", "8", "None", "None"]
    kept = decontamination.without_items(odd, benchmark)
    assert kept.columns == odd.columns and {r[0] for r in odd.select("doc_id").collect()} - {r[0] for r in kept.select("doc_id").collect()} == {5, 6}
    assert mixing.repeated(odd).columns == odd.columns


def test_decontamination(odd, benchmark):
    assert sorted((r.doc_id, r.item_id, r.score) for r in decontamination.contaminated(odd, benchmark).distinct().collect()) == [(5, 1, 1.0), (6, 1, 1.0)]


def test_mixing(odd):
    rows = by_id(mixing.mixed(odd))
    assert len(rows) == 11 and all(r["taken"] <= 3 * r["size"] for r in rows)
    none = next(r for r in rows if r["doc_id"] == 2)
    assert (none["source_size"], none["target"], none["taken"]) == (0, 0.0, 0)


def test_license_scan(odd, documents):
    assert license_scan.found(odd).collect() == []
    notice = "word " * 3000 + "LICENSED under CC BY-NC 4.0. " + "word " * 3000
    got = license_scan.found(documents([(1, notice, "a"), (2, "Released under the", "a"), (3, "Released under the MIT License", "a")])).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(1, "CC-BY-NC-4.0"), (3, "MIT")]


def test_license_clauses(documents):
    """A clause deep in a text shows its license; sister licenses are told apart by the words that a template must have."""
    later = {"BSD": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following\n"
                    " * disclaimer in the documentation and/or other materials provided with the distribution.",
             "ISC": "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                    "provided that the above copyright notice and this permission notice appear in all copies.",
             "Unlicense": "This is free and unencumbered software released into the public domain.",
             "GPL-2.0": "either version 2 of the License, or (at your option) any later version.",
             "GPL-3.0": "either version 3 of the License, or (at your option) any later version.",
             "LGPL": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
             "AGPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
             "GPL": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License",
             "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
             "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
             "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                        "accompanying documentation covered by this license"}
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(2500 + 700 * i)) + " " + text + " and so on", "a") for i, text in enumerate(later.values())]
    got = license_scan.found(documents(rows + [(99, "This work is shared under a general license of the public.", "a")])).collect()
    assert sorted((r.doc_id, r.license) for r in got) == list(enumerate(later))


def test_license_templates_are_distinct(documents):
    """Every template is found in its own text, and shows no other license."""
    got = license_scan.found(documents([(i, row[1], "a") for i, row in enumerate(license_scan.TEMPLATES)])).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(i, row[0]) for i, row in enumerate(license_scan.TEMPLATES)]


def test_near_duplicates(odd):
    rows = by_id(near_dedup.near_duplicates(odd))
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in rows] == [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (7, 4, False), (7, 4, False), (8, 8, True),
        (None, None, True), (None, None, True)]
    assert [r["n_shingles"] for r in rows][:4] == [0, 0, 0, 1]


def test_sharding(odd):
    rows = sharding.sharded(odd, 4).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(4) for k in range(3) if s + 4 * k < 11]
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(8, 0)}


def test_chat(spark):
    turns = spark.createDataFrame([(1, None, None, None), (1, 0, "user", "a\\b: ### </turn>"), (1, 1, "assistant", "\\\\l\\"), (None, 0, "assistant", ""),
                                   (2, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "od\nd: role", "y")], "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat_format.read_back(chat_format.formatted(turns.selectExpr("*", "1 as segments", "2 as valid"))).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("", ""), ("user", "a\\b: ### </turn>"), ("assistant", "\\\\l\\")]
    assert back[1].learned == ["\\\\l\\"] and not back[1].valid
    assert [(t.role, t.text) for t in back[3].turns] == [("od\nd: role", "y")]
    assert back[2].turns == [("user", "x"), ("user", "x")] and not back[2].valid and back[None].learned == [""]


def test_urls(spark):
    rows = [(1, None), (2, "no scheme/en/"), (3, "http://WWW.Example.com/en/x?y"), (4, "http://example.com/en/x"), (5, "http://a.com"),
            (6, "x://b.net/es/"), (7, "http://badexample.com/en/"), (8, "http://"), (9, "http://a.com/b\nc#d"), (9, "http://a.com/b\nc#d")]
    got = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as s", "2 as host")).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [
        ("", "", None), ("", "", None), ("www.example.com", "/en/x", "www.example.com/en/"), ("example.com", "/en/x", "example.com/en/"),
        ("a.com", "", None), ("b.net", "/es/", "net/es/"), ("badexample.com", "/en/", "com/"), ("", "", None)]
    assert got[1].verdict == got[8].verdict == "allow" and got[4].verdict == "block" and got[9].path == "/b\nc"


def test_url_within_a_query(spark):
    """Only the first :// counts, also where its host has no path."""
    rows = [(1, "http://a.com?u=http://b.net/es/x"), (2, "http://q.net?r=https://z.org/fr/a"), (3, "http://q.net#x://z.net/fr/"), (4, "a://b://c/d")]
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {1: ("a.com", "", None), 2: ("q.net", "", None), 3: ("q.net", "", None), 4: ("b:", "//c/d", None)}


def test_rows_without_an_id_draw_for_themselves(documents):
    """A source of rows without ids is taken near its target, as its texts differ."""
    rows = [(None, " ".join([f"w{i}"] * 10), "a") for i in range(2000)] + [(i, "x y", "b") for i in range(4000)]
    docs = documents(rows)
    got = mixing.mixed(docs).groupBy("doc_id").sum("taken").where("doc_id is null").first()[1]
    target = mixing.mixed(docs).where("doc_id is null").first().target
    assert abs(got - target) < 0.05 * target
    assert mixing.repeated(docs).where("doc_id is null").count() == got / 10


def test_repeated_ids_keep_their_own_texts(documents):
    """Rows of one id and different texts are rows of their own, compared by the text each has."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    docs = documents([(1, a, "s"), (1, b, "s"), (2, c, "s"), (9, b, "s"), (5, a, "s"), (2, c, "s"), (None, a, "s")])
    assert sorted((r.doc_id or 0, r.text[0]) for r in near_dedup.one_of_each_group(docs).collect()) == [(0, "a"), (1, "a"), (1, "b"), (2, "c")]
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (2, 2, True), (5, 1, False), (9, 1, False)]


def test_empty_tables(spark, odd, labels, benchmark):
    none = odd.where("false")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    for df in (quality_rules.judged(none), url_filter.judged(pages), decontamination.contaminated(none, benchmark), mixing.mixed(none),
               toxicity.score(none, toxicity.train(none, labels)), quality_classifier.score(none, quality_classifier.train(none, labels)),
               license_scan.found(none), near_dedup.near_duplicates(none), near_dedup.one_of_each_group(none), mixing.repeated(none),
               sharding.sharded(none), chat_format.digests(chat_format.formatted(turns)), decontamination.without_items(none, benchmark)):
        assert df.collect() == []
    assert decontamination.contaminated(odd, benchmark.where("false")).collect() == []


def test_url_model_reads_whole_urls_in_their_own_characters(spark):
    """Undecided URLs that differ from decided ones in script, or in the query alone, are told apart."""
    def urls(host, word, first):
        return [(first + i, f"http://{host}{i}.{'com' if host == 'a' else 'net'}/{'en' if host == 'a' else 'fr'}/{word}{i % 7}?q={word}{i % 5}") for i in range(120)]
    good, bad = "словарь", "λεξικόν"
    asked = [(1000, f"http://x.org/{good}3"), (1001, f"http://x.org/{bad}3"), (1002, f"http://x.org/?q={good}"), (1003, f"http://x.org/?q={bad}#{bad}")]
    rows = urls("a", good, 0) + urls("b", bad, 500) + asked
    got = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null").collect()}
    # the limit is calibrated on accepted hosts, so here the scores tell
    assert got[1001].verdict == got[1003].verdict == "block"
    assert got[1000].score > 0 > got[1001].score and got[1002].score > 0 > got[1003].score


def test_words_hash_alike_in_documents_longer_than_a_piece():
    words = [f"w{i % 1000}" for i in range(200_000)]
    column = pa.array(["a b", " ".join(words), None, " ".join(words[:1000])])
    got = [(p.first, text.word_hashes(p), p.n_words()) for p in text.pieces(column)]
    assert sum(int(n.sum()) for _, _, n in got) == 2 + 200_000 + 1000
    every = np.concatenate([h for _, h, _ in got])
    assert len(" ".join(words)) > 2 * text.PIECE
    assert (every[2:200_002].reshape(200, 1000) == every[-1000:]).all() and len(np.unique(every[-1000:])) == 1000
