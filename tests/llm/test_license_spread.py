"""License copies with many inserted words against patience alignment of the whole text."""

import random

import pytest

from corpusforge.llm import license_align
from corpusforge.llm.license_align import MIN_COVERAGE, TEMPLATES, Scanner, patience, words

SCAN = Scanner(TEMPLATES, MIN_COVERAGE)


def whole_text(name, text):
    return len(patience(text, words(TEMPLATES[name]))) / len(words(TEMPLATES[name]))


def found(name, text):
    return [m for m in SCAN(text) if m[0] == name]


def test_notice_with_inserted_words():
    text = words("This work is licensed under the GNU General Public License as published by the Free Software Foundation, version 3")
    assert whole_text("gpl-3.0-notice", text) == 1.0
    assert SCAN(text) == [("gpl-3.0-notice", 1.0, 0, len(text))]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_insertions_against_whole_text(name):
    template, rng, seen = words(TEMPLATES[name]), random.Random(name), 0
    n = len(template)
    for k in range(120):
        foreign = [f"x{i}" for i in range(50)] + (template if k % 3 == 0 else [])
        text = list(template)
        for _ in range(rng.choice([1, 2, n])):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choices(foreign, k=rng.choice([n // 2, n, 4 * n]))
        text = rng.choices(foreign, k=rng.randrange(3 * n)) + text + rng.choices(foreign, k=rng.randrange(3 * n))
        if whole_text(name, text) >= MIN_COVERAGE:
            seen += 1
            assert found(name, text), (k, text)
    assert seen > 40


def test_spread_copies_are_found_one_by_one():
    copy = [w for t in words(TEMPLATES["apache-2.0-notice"]) for w in (t, "x", "y", "z")]
    near = words(TEMPLATES["apache-2.0-notice"])
    text = copy + ["w"] * 200 + near + ["w"] * 300 + copy
    assert whole_text("apache-2.0-notice", text) < MIN_COVERAGE
    got = sorted((first, end) for _, _, first, end in found("apache-2.0-notice", text))
    assert len(got) == 3 and all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_scattered_words_without_order_and_empty_templates():
    assert not SCAN(words(TEMPLATES["apache-2.0-notice"])[::-1] * 50)
    assert Scanner({"none": "", "mit": "Released under the MIT License."}, MIN_COVERAGE)(words("Released under the MIT License.")) == [("mit", 1.0, 0, 5)]


def scan(spark, rows, **how):
    return {r.doc_id: r for r in license_align.scan(spark.createDataFrame(rows, "doc_id long, text string, license string"), **how).collect()}


def test_scattered_words_name_no_license(spark):
    fill = lambda n: " ".join(f"w{i % 97}" for i in range(n))
    mit = " ".join(w + " " + fill(2000) for w in "released under the mit license".split())
    gpl = " ".join(w + " " + fill(150) for w in words(TEMPLATES["gpl-3.0-notice"]))
    got = scan(spark, [(1, mit, "x"), (2, gpl + " Released under the MIT License.", "x"), (3, "Released under the MIT (Expat) License.", None)])
    assert got[1].license is None and got[1].coverage is None and got[1].n_matches == 2  # with and without the article
    assert got[1].matches[0].license == "mit-notice" and got[1].matches[0].coverage == 1.0 and got[1].matches[0].density < 0.001
    assert got[2].license == "mit-notice" and got[2].density == 1.0
    assert "gpl-3.0-notice" in [m.license for m in got[2].matches if m.density < 0.5]
    assert got[3].license == "mit-notice" and 0.8 < got[3].density < 0.9


def test_common_notices_are_told_apart(spark):
    rows = [(i, f"// {t}\n int main", "x") for i, t in enumerate(TEMPLATES.values())]
    got = scan(spark, rows)
    assert [got[i].license for i in range(len(rows))] == list(TEMPLATES)
    # A notice is not listed again for the shorter template it holds.
    assert got[list(TEMPLATES).index("mit-notice")].n_matches == 1 and got[list(TEMPLATES).index("cc-by-nc-4.0-notice")].n_matches == 1


def test_templates_as_a_table_ties_and_odd_rows(spark):
    table = spark.createDataFrame([("a", "one two three four"), ("b", "one two three four"), ("none", None), (None, "x y"), ("blank", " ")], "license string, text string")
    rows = [(1, "one two three four", "x"), (1, "one two three four", "x"), (2, None, "x"), (None, "", "x"), (3, "five", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    out = license_align.scan(df, templates=table)
    assert sorted((str(r.doc_id), r.license, r.n_matches) for r in out.collect() if r.n_matches) == [("1", "a", 2)] * 2
    assert out.count() == 5 and license_align.scan(df.limit(0)).count() == 0
    assert {m.license for r in out.collect() for m in r.matches} == {"a", "b"}
