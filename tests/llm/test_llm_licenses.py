import pytest

import llm_cases as C
from tidemark.llm import licenses as L
from tidemark.llm.words import hashed_words

INDEX = L.TemplateIndex(L.TEMPLATES)


def spans(text):
    return [(name, round(cov, 3), text[a:b], [text[x:y] for x, y in parts])
            for name, cov, _, a, b, parts in L.scan(text, INDEX)]


@pytest.mark.parametrize("name", list(L.TEMPLATES))
def test_every_template_is_found_whole(name):
    text = f"é some words before this.\n{L.TEMPLATES[name]} And more after."
    hits = L.scan(text, INDEX)
    assert [m[0] for m in hits] == [name] and hits[0][1] == 1.0
    assert text[hits[0][3]:hits[0][4]] == L.TEMPLATES[name].strip(".)/\" ")


def test_changes_inside_a_notice():
    text = "This work is hereby licensed under the GNU Funny Public License, version 3!"
    ((name, coverage, whole, parts),) = spans(text)
    assert name == "GPL-3.0"
    assert whole == "This work is hereby licensed under the GNU Funny Public License, version 3"
    assert coverage == round(11 / 12, 3)
    assert parts == ["This work is", "licensed under the GNU", "Public License, version 3"]


@pytest.mark.parametrize("text, name, coverage", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0", 1.0),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", 1.0),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0", 1.0),
    ("Released under MIT License", "MIT", 0.8)])
def test_neighbours_are_told_apart(text, name, coverage):
    assert [(m[0], round(m[1], 3)) for m in L.scan(f"Foo. {text} Bar", INDEX)] == [(name, coverage)]


def test_the_start_of_a_notice_is_not_the_whole():
    """Half of a notice is below the least coverage; nine tenths say so."""
    words = L.TEMPLATES["MIT-text"].split()
    assert L.scan(" ".join(words[:len(words) // 2]), INDEX) == []
    (hit,) = L.scan(" ".join(words[:len(words) * 9 // 10]), INDEX)
    assert hit[0] == "MIT-text" and 0.85 < hit[1] < 0.95


def unbanded(text, template):
    """Matched words of the best local alignment, by the full table."""
    full = [[(0, 0)] * (len(text) + 1) for _ in range(len(template) + 1)]
    best = (0, 0)
    for i, w in enumerate(template, 1):
        for j, v in enumerate(text, 1):
            (a, m), (b, n), (c, o) = full[i - 1][j - 1], full[i - 1][j], full[i][j - 1]
            full[i][j] = max((a + (2 if v == w else -1), m + int(v == w)), (b - 1, n), (c - 1, o), (0, 0))
            best = max(best, full[i][j])
    return best


def test_recall_against_unbanded_alignment():
    """Notices with a tenth of their words changed, left out or added, in foreign text."""
    import random
    rng = random.Random(5)
    wanted = found = 0
    for _ in range(6):
        for name, notice in L.TEMPLATES.items():
            words = notice.split()
            if len(words) > 90:
                words_of, name_of = words[:90], {name: " ".join(words[:90])}
            else:
                words_of, name_of = words, {name: notice}
            edited = []
            for w in words_of:
                kind = rng.random()
                if kind < 0.035:
                    continue
                edited.append("changed" if kind < 0.07 else w)
                if kind > 0.965:
                    edited.append("added")
            text = " ".join(["lorem"] * 5 + edited + ["ipsum"] * 5)
            index = L.TemplateIndex(name_of)
            _, matched = unbanded(hashed_words(text.encode(), True, L._GAP)[0].tolist(), index.words[name].tolist())
            if matched / len(index.words[name]) >= L.MIN_COVERAGE:
                wanted += 1
                hits = L.scan(text, index)
                found += bool(hits) and hits[0][2] >= matched - 1
    assert wanted > 100 and found / wanted >= 0.98


def test_a_long_text_with_many_notices():
    text = ("filler word " * 400 + L.TEMPLATES["MIT"] + " ") * 60
    assert [m[0] for m in L.scan(text, INDEX)] == ["MIT"] * 60


def test_two_occurrences_and_line_breaks():
    text = "Released under\nthe MIT\tLICENSE.\n" + "filler " * 50 + "released under the mit license"
    assert [m[0] for m in spans(text)] == ["MIT", "MIT"]


def test_parts_of_a_notice_are_not_enough():
    assert L.scan("licensed under the sun, in the apache valley of the mit", INDEX) == []
    assert L.scan("", INDEX) == []


def test_alignment_equals_unbanded_brute_force():
    a = hashed_words(b"x b c d e f y y g h i z", True, L._GAP)[0]
    b = hashed_words(b"b c q d e f g h i", True, L._GAP)[0]
    full = [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i, w in enumerate(b, 1):
        for j, v in enumerate(a, 1):
            full[i][j] = max(0, full[i - 1][j - 1] + (2 if v == w else -1), full[i - 1][j] - 1,
                             full[i][j - 1] - 1)
    best = max(map(max, full))
    matched, parts = L.align(a, b, 1, 0, len(a))
    assert matched == 8 and parts == [(1, 6), (8, 11)]
    gaps = 1 + 2
    assert 2 * matched - gaps == best


def test_winnowing_keeps_a_fingerprint_of_every_window():
    import numpy as np
    grams = np.random.default_rng(3).integers(0, 50, 400, dtype=np.uint64)
    kept = L.winnow(grams, 4)
    for at in range(len(grams) - 3):
        window = grams[at:at + 4]
        assert at + 3 - int(np.argmin(window[::-1])) in kept


def test_query(spark):
    text = "Nothing.\nReleased under the MIT License.\n"
    rows = [*C.ODD, (30, text, "s"), (31, text * 2, None), (30, text, "s"), (None, text, "s")]
    got = L.license_coverage(C.clashing(C.frame(spark, rows))).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["30", "30", "31", "31", "None"]
    assert {r["spans"] for r in got if r["doc_id"] == 30} == {"9-39"}
    assert L.license_coverage(C.frame(spark, [])).count() == 0


def test_notices_of_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {(r["doc_id"], name) for r in docs.collect() for name, notice in L.TEMPLATES.items()
            if notice in (r["text"] or "")}
    got = {(r["doc_id"], r["license"]) for r in L.scan_licenses(docs).where("coverage = 1").collect()}
    assert got == want and len(want) > 10
