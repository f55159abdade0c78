import zstandard

from wordloom.llm.licenses import TEMPLATES, Compressor, blocks, difference, full_texts, scan


def test_scan(spark):
    texts = [
        "Prose.\nReleased under the MIT License.\nMore prose.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the very Apache License Version 2.0",
        "I lost my driving license yesterday and had to walk home.",
        "Nothing here.",
    ]
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: r for r in rows}
    assert set(got) == {0, 1, 2, 3, 4}
    assert [got[i].license for i in range(4)] == ["MIT", "GPL-2.0", "GPL-3.0", "Apache-2.0"]
    assert [got[i].exact for i in range(5)] == [True, True, True, False, False]
    assert got[0].first_line == got[0].last_line == 1 and got[3].extra_words == ["very"]
    assert got[3].confirmed and not got[4].confirmed
    assert all(r.bytes_with <= r.bytes_alone for r in rows if r.exact)


def test_every_template_wins_its_own_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEMPLATES.values())], "doc_id long, text string")
    got = {r.doc_id: r.license for r in scan(df).collect()}
    assert [got[i] for i in sorted(got)] == list(TEMPLATES) and len(got) == len(TEMPLATES)


def test_blocks_and_differences():
    assert blocks("a\nlicense x\ncopyright y\nb\nwarranty") == [(1, 2, "license x\ncopyright y"), (4, 4, "warranty")]
    assert difference("a b c", "a c") == (1.0, [], ["b"], (0, 2))
    assert difference("q", "a c") == (0.0, ["a", "c"], ["q"], (0, 0))


def test_odd_rows(odd, none):
    assert scan(odd).count() == 0
    assert scan(none).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


def test_notice_inside_a_long_line(spark):
    prose = " ".join(f"word{i % 37} of{i % 11} filler{i}" for i in range(60))
    text = f"{prose} Released under the MIT License. {prose} Licensed under CC BY-SA 4.0. {prose}"
    rows = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sorted(r.license for r in rows if r.exact and r.confirmed) == ["CC-BY-SA-4.0", "MIT"]


def test_full_text_over_lines_without_hints(spark, tmp_path):
    from wordloom.llm.licenses import templates_in

    (tmp_path / "MIT-text.txt").write_text(MIT)
    templates = TEMPLATES | templates_in(spark, str(tmp_path))
    text = f"Some prose before.\n{MIT}\nAnd some after."
    rows = [r for r in scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), templates).collect() if r.confirmed]
    assert [(r.license, r.first_line, r.last_line, r.exact) for r in rows] == [("MIT-text", 1, 9, True)]


def test_ties_for_the_last_place_are_compared(spark):
    """The right one of many near twins is the last by name, and its number is not what compresses best."""
    templates = {f"T{n}": f"This work is licensed under the Common Text License, version {n}." for n in range(1, 10)}
    df = spark.createDataFrame([(n, t) for n, t in enumerate(templates.values(), 1)], "doc_id long, text string")
    rows = scan(df, templates, finalists=1).collect()
    assert {r.doc_id: (r.license, r.exact) for r in rows} == {n: (f"T{n}", True) for n in range(1, 10)}


def test_all_that_tie_are_finalists():
    from wordloom.llm.licenses import compared

    ranked = [(0.9, "a", 60, 6), (0.8, "b", 60, 12), (0.7, "c", 60, 18), (0.7, "d", 60, 18), (0.6, "e", 60, 25), (0.1, "f", 60, 54)]
    assert [x[1] for x in compared(ranked, 3)] == ["a", "b", "c", "d", "e"]
    assert compared([], 3) == []


def confirmed(spark, texts, templates=TEMPLATES, **options):
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates, **options).collect()
    return {i: sorted(r.license for r in rows if r.doc_id == i and r.confirmed) for i in range(len(texts))}


def test_versions_are_told_apart(spark):
    gpl = "This work is licensed under the GNU General Public License, version {}."
    prose = "Words and more words of prose, nothing else to see here. "
    texts = [
        gpl.format(3), prose + gpl.format(3) + " " + prose, gpl.format(3) + "\n" + gpl.format(2), gpl.format(9), gpl.format(""),
        "This work is licensed under the fine GNU Lesser General Public License, version 3.",
        "Released under the MIT License. Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0 and so on.",
    ]
    for templates in (TEMPLATES, TEMPLATES | full_texts()):
        got = confirmed(spark, texts, templates)
        assert got == {0: ["GPL-3.0"], 1: ["GPL-3.0"], 2: ["GPL-2.0", "GPL-3.0"], 3: [], 4: [], 5: ["LGPL-3.0"], 6: ["CC-BY-4.0", "MIT"], 7: ["CC-BY-NC-4.0"]}
    rows = scan(spark.createDataFrame([(1, gpl.format(9))], "doc_id long, text string")).collect()
    assert {"GPL-2.0", "GPL-3.0"} <= {rows[0].license, *rows[0].ambiguous} and not rows[0].confirmed


def test_given_documents_have_the_notices_that_are_in_them(spark, docs):
    rows = docs.collect()
    got = scan(docs, TEMPLATES | full_texts()).where("confirmed").collect()
    found = {(r.doc_id, r.license) for r in got}
    assert found == {(r.doc_id, name) for r in rows for name, t in TEMPLATES.items() if t in (r.text or "")}
    assert found


def test_full_texts(spark):
    prose = "\n".join(f"word{i % 37} of{i % 11} filler{i}" for i in range(80))
    full = full_texts()
    texts = [f"{prose}\n{t}\n{prose}" for t in full.values()]
    got = confirmed(spark, texts, TEMPLATES | full)
    for i, name in enumerate(full):
        assert name in got[i] and set(got[i]) <= {name, "Proprietary"}, (name, got[i])


def test_windows_everywhere_find_what_nothing_hints_at(spark):
    templates = {"Plain": "You may use and share this text as you like, but name its author and keep this sentence."}
    prose = " ".join(f"word{i % 37} of{i % 11} filler{i}" for i in range(90))
    texts = [f"{prose} {templates['Plain']} {prose}", prose]
    assert confirmed(spark, texts, templates) == {0: [], 1: []}
    assert confirmed(spark, texts, templates, every_window=True) == {0: ["Plain"], 1: []}


def test_ranking_equals_compressing_with_every_template():
    c = Compressor(TEMPLATES)
    for block in ["Released under the MIT License.", "Licensed under nothing, really", "All rights reserved. " * 9]:
        want = []
        for name, t in TEMPLATES.items():
            d = zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            plain = dict(level=3, write_checksum=False, write_content_size=False, write_dict_id=False)
            want.append((len(zstandard.ZstdCompressor(dict_data=d, **plain).compress(block.encode())), name))
        assert [(size, name) for _, name, _, size in c.ranked(block)] == sorted(want)
