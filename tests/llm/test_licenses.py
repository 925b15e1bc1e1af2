import pytest

from mirrorset.llm import licenses
from mirrorset.llm.license_texts import TEMPLATES


def found(spark, make_documents, texts, **options):
    rows = licenses.scan(make_documents(list(enumerate(texts))), **options).collect()
    return sorted((r.doc_id, r.license, round(r.coverage, 3), texts[r.doc_id].encode()[r.span_start : r.span_end].decode()) for r in rows)


def test_whole_edited_and_repeated(spark, make_documents):
    notice = TEMPLATES["mit-notice"]
    edited = notice.replace("free of charge", "without any charge at all").replace("merge, ", "")
    texts = [
        "Intro.\nAll rights reserved.\nMore " + "word " * 3000 + "ALL RIGHTS  RESERVED",
        f"before {notice} after",
        f"before {edited} after",
        None,
        "",
        "all rights of man are reserved here",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the Apache License, Version 2.0.",
        "ünlü Licensed under the Apache License, Version 2.0. (c)",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under",
    ]
    got = found(spark, make_documents, texts)
    assert got == [
        (0, "all-rights-reserved", 1.0, "ALL RIGHTS  RESERVED"),
        (0, "all-rights-reserved", 1.0, "All rights reserved"),
        (1, "mit-notice", 1.0, notice[:-1]),
        (2, "mit-notice", got[3][2], edited[:-1]),
        (6, "cc-by-nc-4.0", 1.0, "Licensed under CC BY-NC 4.0"),
        (7, "apache-2.0", 1.0, "Licensed under the Apache License, Version 2.0"),
        (8, "apache-2.0", 1.0, "Licensed under the Apache License, Version 2.0"),
        (9, "gpl-3.0", 1.0, "This work is licensed under the GNU General Public License, version 3"),
    ]
    assert 0.9 < got[3][2] < 1


def plain_alignment(text, template):
    """Matched words of the best local alignment without a band."""
    best, row = (0, 0), [(0, 0)] * (len(text) + 1)
    for word in template:
        new = [(0, 0)]
        for i, other in enumerate(text):
            s, m = row[i]
            cell = max((s + 1, m + 1) if word == other else (s - 1, m), (row[i + 1][0] - 1, row[i + 1][1]), (new[-1][0] - 1, new[-1][1]))
            new.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, new[-1])
        row = new
    return best[1]


@pytest.mark.parametrize("drop", [0, 3, 5])
def test_band_loses_nothing_near_the_diagonal(drop):
    template = list(range(60))
    text = [-1] * 7 + template[:20] + [-2] * 2 + template[20 + drop : 40] + [-3] + template[41:] + [-1] * 4
    matched, first, last = licenses.align(text, template, 7)
    assert matched == plain_alignment(text, template) and text[first] == 0 and text[last - 1] == 59


def test_test_table_as_plain_search(spark, documents):
    """Every wording that stands in a text word for word is reported; nothing else is there."""
    words = lambda s: " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in s).lower().split())
    texts = {r.doc_id: f" {words(r.text)} " for r in documents.collect()}
    short = {n: f" {words(t)} " for n, t in TEMPLATES.items()}
    got = {(r.doc_id, r.license) for r in licenses.scan(documents).collect()}
    want = {(i, n) for i, t in texts.items() for n, s in short.items() if s in t}
    assert want and want <= got and all(r.coverage >= 0.8 for r in licenses.scan(documents).collect())


def test_empty_and_clashing(spark, make_documents):
    rows = make_documents([(None, "All rights reserved."), (1, "x")]).selectExpr("*", "1 AS license")
    assert [(r.doc_id, r.span_end) for r in licenses.scan(rows).collect()] == [(None, 19)]
    assert licenses.scan(rows.limit(0)).count() == 0
    assert licenses.scan(rows, templates={}).count() == 0


@pytest.mark.parametrize("name", ["all-rights-reserved", "mit", "cc-by-4.0", "apache-2.0", "mit-notice"])
@pytest.mark.parametrize("between", ["\n", " x ", " x y z "])
def test_adjacent_repeats_are_all_reported(spark, make_documents, name, between):
    wording = TEMPLATES[name]
    text = "Intro " + between.join([wording] * 5) + " end"
    got = licenses.scan(make_documents([(1, text)])).collect()
    step = len(wording + between)
    assert sorted((r.license, r.coverage, r.span_start, r.span_end) for r in got) == [
        (name, 1.0, 6 + i * step, 6 + i * step + len(wording) - 1) for i in range(5)
    ]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_wording_is_named_right(name):
    """Each wording, and a long one with a few words changed, is reported under its own name and no other."""
    import pyarrow as pa

    wording = TEMPLATES[name]
    changed = wording.replace(" and/or ", " or ").replace(" any ", " every ", 1) if len(wording.split()) > 30 else wording
    texts = pa.array([f"Intro words.\n{wording}\nMore words.", f"Some {changed} text"])
    assert [[r[1] for r in rows] for rows in licenses.matches_of(texts)] == [[name], [name]]


@pytest.mark.parametrize(
    "text",
    ["Licensed under CC BY-XY 4.0.", "Released under the MIT-like License.", "All other rights reserved.",
     "This work is licensed under the GNU Free Documentation License, version 3.", "Licensed under the Apache License, Version 1.1."],
)
def test_near_names_are_not_reported(text):
    import pyarrow as pa

    assert licenses.matches_of(pa.array([text])) == [[]]
