"""Page text, archives, digests, licences, and the pipeline as a whole."""

import gzip
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import digests, licences, pages, queries, warc

SF = "/root/testdata/sf0.001"
PLAIN = "Erin on the thing and ering. The ther was tion for the and, on there is ing. And the er of thonst."


def page(body, nav="Home"):
    return f"<html><head><title>t</title></head><body><nav><a>{nav}</a></nav>{body}<footer>&copy; x</footer></body></html>"


def test_main_text(spark):
    rows = [
        (1, "http://a.example/1", page("<article><h1>Head &amp; tail</h1><p>One <b>bo</b>ld\n  text<br>next<p>two<ul><li>x<li>y</ul><aside>no</aside><div class='reader comments'>no</div></article>")),
        (2, "http://a.example/2", page("<div class='ad'>buy</div><article><p>Caf&eacute; <script>if (a<b) {}</script>z</article>")),
        (3, "http://b.example/1", page("<div class=top>Same on all</div><div class=story>First story.</div>")),
        (4, "http://b.example/2", page("<div class=top>Same on all</div><div class=story>Second story.</div><form>no</form>")),
        (5, None, None), (6, "x", ""), (7, "http://c.example/", "<article>cut off <b>he"), (7, "http://c.example/", "<article>cut off <b>he"),
        (8, "http://c.example/2", "<article>" + "<p>long " * 20_000), (None, "http://d.example", "no markup"),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = sorted(((r.page_id or 0, r.text) for r in pages.extract_text(docs).collect()))
    assert found == sorted([
        (1, "Head & tail\nOne bold text\nnext\ntwo\nx\ny"), (2, "Café z"), (3, "First story."), (4, "Second story."), (5, ""), (6, ""),
        (7, "cut off he"), (7, "cut off he"), (8, "\n".join(["long"] * 20_000)), (0, "no markup")])
    assert pages.extract_text(docs.where("false")).collect() == []


def test_articles_within_containers_that_look_set_apart(spark):
    teaser = "<div class=related><article>Tea</article></div>"
    rows = [
        (1, "http://a.example/1", page(f"<div class='content with-sidebar'><article><p>First long story.<div class=share>no</div></article>{teaser.replace('article', 'p')}</div>")),
        (2, "http://b.example/1", page("<div class='no-sidebar'><main>Second story.<aside>no</aside></main></div>")),
        (3, "http://c.example/1", page("<div id='search-page'><h1>no</h1><article class=story>Third story.</article></div>")),
        (4, "http://d.example/1", f"<body><form id=aspnet>{page('<article>Fourth story.</article>')}</form>"),
        (5, "http://e.example/1", page("<form><div class=top>Same</div><div class=story>Fifth story.</div></form>")),
        (6, "http://e.example/2", page("<form><div class=top>Same</div><div class=story>Sixth story.</div></form>")),
        (7, "http://f.example/1", page(f"<article>Seventh story.</article>{teaser}")),
        (8, "http://g.example/1", page(f"<div class=story>Eighth story.</div>{teaser}<aside><article>An aside longer than the story</article></aside>")),
        (9, "http://h.example/1", page("<article>Ninth story.</article><div class=comments><article class=comment>A comment longer than the story</article></div>")),
    ]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.extract_text(docs).collect()}
    assert found == {1: "First long story.", 2: "Second story.", 3: "Third story.", 4: "Fourth story.", 5: "Fifth story.", 6: "Sixth story.", 7: "Seventh story.", 8: "Eighth story.", 9: "Ninth story."}


def extracted(spark, rows, **options):
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.extract_text(docs, **options).collect()}


def test_pages_without_marks_take_the_slots_of_their_host(spark):
    """On one host some pages mark their article and some do not."""
    around = "<div class=top>Same banner on all</div>{}<div class=end>Same end on all</div>"
    rows = [
        (1, "http://a.example/1", page(around.format("<article>One story.</article>"))),
        (2, "http://a.example/2", page(around.format("<article>Two story.</article>"))),
        (3, "http://a.example/3", page(around.format("<div class=story>Three story.</div>"))),
        (4, "http://a.example/4", page(around.format("<div class=story>Four story.</div><blockquote>Quoted once.</blockquote>"))),
        (4, "http://a.example/4", page(around.format("<div class=story>Four story.</div><blockquote>Quoted once.</blockquote>"))),
    ]
    for options in ({}, {"fan": 2}):
        assert extracted(spark, rows, **options) == {1: "One story.", 2: "Two story.", 3: "Three story.", 4: "Four story.\nQuoted once."}


def test_rows_depend_on_the_wrapper(spark, monkeypatch):
    rows = [(1, "http://a.example/1", page("<article>One story.</article>"))]
    assert extracted(spark, rows) == {1: "One story."}
    monkeypatch.setattr(pages, "infer_wrappers", lambda docs, **_: spark.createDataFrame([("a.example", "", [])], "host string, wrapper string, slots array<string>"))
    assert extracted(spark, rows) == {1: ""}


@pytest.mark.parametrize(("body", "text"), [
    ('<article><p title="5" tall">Hello</p><p>there</p></article>', "Hello\nthere"),
    ("<article data-x=it's><p>Hello</p><p>don't</p></article>", "Hello\ndon't"),
    ("<article><a title='a > b' href=\"x>y\">Hello</a> there</article>", "Hello there"),
    ('<article><p class="ad-hoc">Hello</p><p id="notice-of-motion">there</p><p class="related-work">and</p><p id="related">then</p></article>', "Hello\nthere\nand\nthen"),
    ("<article>Hello<div class='ad'>no</div><div class=share-buttons>no</div><div id=comments>no</div><form>no</form></article>", "Hello"),
])
def test_attributes_and_names_within_an_article(spark, body, text):
    assert extracted(spark, [(1, "http://a.example/1", page(body))]) == {1: text}


def test_wrappers_do_not_depend_on_how_they_are_grouped(spark):
    draw = random.Random(7)
    rows = []
    for i in range(60):
        parts = "".join(f"<{t}>{t} {i} {k}</{t}>" for k, t in enumerate(draw.choices(["p", "h2", "pre", "blockquote"], k=draw.randint(1, 6))))
        rows.append((i, "http://a.example/x", page(f"<div class=story>{parts}</div>")))
    want = extracted(spark, rows)
    assert extracted(spark, rows, fan=3) == want
    assert all(f" {i} " in text for i, text in want.items())


def test_wrappers_hold_options_and_repeats():
    one, other = pages.folded(["a", "b", "b", "b", "d"]), pages.folded(["a", "b", "c", "d", "x", "y", "x", "y"])
    assert pages._encode(one) == "a\nb+\nd"
    merged = pages.aligned(one, other)
    assert pages._encode(merged) == "a\nb+\nc?\nd\nx?+\ny?+"
    assert pages._decode(pages._encode(merged)) == merged
    assert {i[0] for i in pages._aligned_greedily(one, other)} == {"a", "b", "c", "d", "x", "y"}


def archive(spark, tmp_path, rows):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_warc(docs, str(tmp_path / "warc"), records_per_file=3)
    return warc.read_warc(spark, str(tmp_path / "warc"))


def test_archive_round_trip(spark, tmp_path):
    big, other = "é" * 600, "z" * 1000
    rows = [(1, "http://a/ b", big), (5, "u", big), (3, None, big), (9, "u", other), (None, "u", other), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 90), (10, "u", "q" * 300_000)]
    found = archive(spark, tmp_path, rows).collect()
    got = {r.record_id: (r.type, r.refers_to, r.payload_bytes, r.payload_digest, r.reason) for r in found}
    top = {big: 5, other: 9}
    assert len(found) == len(rows) and all(r.type for r in found)
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html in top and top[html] != i
        want = ("revisit" if revisit else "response", f"<urn:page:{top[html]}>" if revisit else None, len(data), hashlib.sha1(data).hexdigest(), None)
        assert got[f"<urn:page:{i if i is not None else ''}>"] == want
    assert archive(spark, tmp_path / "none", []).collect() == []


def test_salvage_after_damage(spark, tmp_path):
    archive(spark, tmp_path, [(i, f"http://h/{i}", f"page {i} " * 40) for i in range(4)])
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    starts = [r["start"] for r in warc.salvage(data)]
    assert len(starts) == 4 and starts[0] == 0
    broken = bytearray(data)
    broken[starts[1] + 450] ^= 1  # the payload of the second
    broken = bytes(broken[: starts[3]]) + b"noise" + bytes(broken[starts[3] : -7])  # before the fourth, which is cut off
    found = list(warc.salvage(broken))
    assert [(r["type"], r["start"], r["end"]) for r in found] == [
        ("response", 0, starts[1]), (None, starts[1], starts[2]), ("response", starts[2], starts[3]), (None, starts[3], len(broken))]
    assert found[1]["reason"] == "payload digest differs"
    members = [gzip.compress(data[a:b]) for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]
    members[1] = members[1][:40] + b"\xff\xff" + members[1][42:]
    found = list(warc.salvage(b"".join(members)))
    ids = [r["record_id"] for r in found if r["type"]]
    assert len(ids) == 3 and [r["reason"] for r in found if not r["type"]] == ["broken gzip member"]
    assert sum(r["end"] - r["start"] for r in found) == sum(map(len, members))


def test_archive_query_equals_sql(spark):
    found = queries.op7_warc(spark, SF).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    con.execute(queries.ORACLES["op7_warc"])
    names = [c[0] for c in con.description]
    assert sorted(map(str, con.fetchall())) == sorted(str(tuple(r[n] for n in names)) for r in found)


def test_digests_and_edited_texts(spark):
    draw = random.Random(2)
    rows = [(i, " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(draw.randint(0, 300)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "tiny"), (103, "é" * 50), (104, "same " * 30_000), (50, rows[50][1]), (None, "last one")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, part string")
    found = digests.compare_with_next(docs.repartition(5)).collect()
    texts = [t or "" for _, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)]
    edited = sorted(hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t, n in zip(texts, texts[1:] + texts[:1], strict=True))
    assert sorted(r.edited_sha256 for r in found) == edited
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    long = [r for r in found if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) >= len(long) - 2
    twins = [r.fingerprint for r in found if r.doc_id == 50]
    assert len(twins) == 2 and twins[0] == twins[1] != ""
    assert {r.fingerprint for r in found if r.n_chars == 0} == {""}
    one = digests.compare_with_next(docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert digests.compare_with_next(docs.where("false")).collect() == []


def slow_grade(window):
    cost = sum(int(digests._COST[window.count(b)]) for b in set(window))
    return (digests._TOP - cost) * digests.GRADES // digests._TOP


def test_entropy_grades():
    import numpy as np

    data = bytes(random.Random(4).choices(b"aab cdefgh", k=300)) + b"x" * 70
    got = digests.grades(np.frombuffer(data, np.uint8)).tolist()
    assert got == [slow_grade(data[i : i + digests.WINDOW]) for i in range(len(data) - digests.WINDOW + 1)]


def test_licences_are_found_and_inherited(spark):
    mit, apache = "Released under the MIT License.", "# Licensed under the Apache License, Version 2.0."
    rows = [
        ("a/LICENSE", mit), ("a/x.txt", "nothing here"), ("a/b/c/y.txt", None), ("a/b/z.py", f"line\n{apache}\nline"), ("d/y.txt", ""),
        ("a/e/COPYING", apache), ("a/e/f/g.txt", "the license of the license"), (None, mit), (None, "text"), ("top.txt", "of"), ("a/x.txt", "nothing here"),
        ("l/long.txt", "word " * 60_000 + "\nAll rights reserved."),
    ]
    files = spark.createDataFrame([(p, t, "clash", 7) for p, t in rows], "path string, text string, licence string, directory int")
    found = licences.scan_licences(files).collect()
    got = sorted((str(r.path), str(r.licence), str(r.origin), str(r.from_path), r.directory) for r in found)
    assert got == sorted([
        ("a/LICENSE", "MIT", "file", "None", 7), ("a/x.txt", "MIT", "inherited", "a/LICENSE", 7), ("a/x.txt", "MIT", "inherited", "a/LICENSE", 7),
        ("a/b/c/y.txt", "MIT", "inherited", "a/LICENSE", 7), ("a/b/z.py", "Apache-2.0", "header", "None", 7), ("d/y.txt", "None", "None", "None", 7),
        ("a/e/COPYING", "Apache-2.0", "file", "None", 7), ("a/e/f/g.txt", "Apache-2.0", "inherited", "a/e/COPYING", 7),
        ("None", "MIT", "header", "None", 7), ("None", "None", "None", "None", 7), ("top.txt", "None", "None", "None", 7), ("l/long.txt", "Proprietary", "header", "None", 7)])
    assert licences.scan_licences(files.where("false")).collect() == []


BSD = """Copyright (c) 2020, Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer."""
GPL2_HEADER = """/*
 * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
 */
int main;"""


@pytest.mark.parametrize(("text", "licence"), [
    (BSD, "BSD-3-Clause"), (GPL2_HEADER, "GPL-2.0"), ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989", "GPL-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL-3.0"), ("GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007", "LGPL-3.0"),
    ("GNU Lesser General Public License Version 3", "LGPL-3.0"), ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("MIT License\n\nCopyright (c) 2019", "MIT"), ("                                 Apache License\n                           Version 2.0, January 2004", "Apache-2.0"),
    ("ISC License\n\nCopyright", "ISC"), ("BSD 2-Clause License\n\n" + BSD, "BSD-2-Clause"), ("CC0 1.0 Universal", "CC0-1.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("# Permission is hereby granted, free of charge, to any\n# person obtaining a copy of this software and associated\n# documentation files (the \"Software\")", "MIT"),
    ("the license of the general public\nand its version 3 of the words", None), ("we redistribute water\nin many forms", None),
])
def test_wrapped_notices_and_their_neighbours(text, licence):
    held = {t: 3 for t in licences.vocabulary(licences.TEMPLATES)} | {"the": 900, "of": 800, "to": 700, "and": 850, "in": 600}
    scorer = licences.Scorer(licences.TEMPLATES, held, 20_000, 0.8)
    assert scorer.best(text)[0] == licence


def test_cosine_equals_brute_force():
    import numpy as np

    held = {t: n for n, t in enumerate(sorted(licences.vocabulary(licences.TEMPLATES)))}
    scorer = licences.Scorer(licences.TEMPLATES, held, 5000, 0.0)
    texts = [(name, text) for name in sorted(licences.TEMPLATES) for text in licences.TEMPLATES[name]]

    def vector(text, axis):
        found = licences.terms(text)
        return np.array([(1 + np.log(found.count(t))) * (np.log(5001 / (held[t] + 1)) + 1 if t in held else np.log(5001) + 1) if t in found else 0.0 for t in axis])

    for line in ("Licensed under the MIT License and nothing else", "GNU General Public License version 2 or 3", "All rights reserved by the license license"):
        axis = sorted(set(licences.terms(line)) | set(held))
        own = vector(line, axis)
        near = [(own @ v) / np.linalg.norm(own) / np.linalg.norm(v) for v in (vector(t, axis) for _, t in texts)]
        name, cosine = scorer.score(line)
        assert cosine == pytest.approx(max(near)) and name == texts[int(np.argmax(near))][0]


def test_prefilter_loses_no_line():
    held = {t: 3 for t in licences.vocabulary(licences.TEMPLATES)} | {"the": 900, "of": 800, "to": 700}
    scorer = licences.Scorer(licences.TEMPLATES, held, 1000, 0.8)
    draw = random.Random(6)
    words = sorted({w for t in held for w in t.split()})
    for texts in licences.TEMPLATES.values():
        for text in texts:
            for _ in range(30):
                parts = text.split()
                parts[draw.randrange(len(parts))] = draw.choice(words)
                line = " ".join(parts)
                assert (scorer.best(line)[0] is not None) == (scorer.score(line) is not None)


@pytest.fixture(scope="module")
def odd_documents(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, row string, leaks int, kept_id long"
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("*", F.lit("r").alias("row"), F.lit(1).alias("leaks"), F.lit(2).cast("long").alias("kept_id"))
    odd = [(None, "The thing was here with them.", "en", None, None, None, None, None), (9001, None, None, None, None, None, None, None), (9002, "", "de", "src1", 0, "", 0, 0), (9003, "12 34", "en", "src1", 5, "", 0, 0)]
    twice = [(9004, f"{PLAIN} jo@corp.example", "en", "src2", 1, "r", 1, 1)] * 2
    return docs.unionByName(spark.createDataFrame(odd + twice, kinds).select(docs.columns))


def test_stages_keep_columns_and_take_effect(spark, odd_documents):
    docs = odd_documents
    known = corpus_pipeline.language(spark, docs, SF)
    ids = [r.doc_id for r in known.select("doc_id").collect()]
    assert known.columns == docs.columns and not {9001, 9002, 9003} & set(ids) and ids.count(9004) == 2 and None in ids
    single = corpus_pipeline.near_duplicates(spark, known, SF)
    texts = [r.text for r in single.collect()]
    assert single.columns == docs.columns and len(texts) == len(set(texts)) < len(ids)
    clean = corpus_pipeline.benchmark_passages(spark, single, SF)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [r.text for r in clean.collect()]
    assert clean.columns == docs.columns and not any(i in t for i in items for t in left)
    assert all(t in left for t in texts if not any(i.lower() in t.lower() for i in items))
    masked = corpus_pipeline.personal_data(spark, clean, SF)
    rows = masked.collect()
    assert masked.columns == docs.columns and len(rows) == len(left) and dict(masked.dtypes) == dict(docs.dtypes)
    assert [r.text for r in rows if r.doc_id == 9004] == [f"{PLAIN} [EMAIL]"]
    assert [r.n_chars for r in rows if r.doc_id == 9004] == [len(f"{PLAIN} [EMAIL]")]


def test_stages_of_an_empty_table(spark, odd_documents):
    docs = odd_documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
