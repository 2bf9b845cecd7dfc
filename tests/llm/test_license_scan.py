import itertools
import random
from collections import Counter

import pytest

from kpiloom.llm.license_scan import TEMPLATES, TEXTS, WORD, Template, align, license_scan, longest_increasing, scan, span_shares, whole
from tests.llm.conftest import EDGE


def test_longest_increasing_matches_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.randrange(8) for _ in range(rng.randint(0, 8))]
        got = [values[i] for i in longest_increasing(values)]
        best = max((len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n)
                    if all(a < b for a, b in zip(c, c[1:]))), default=0)
        assert len(got) == best and all(a < b for a, b in zip(got, got[1:]))


def test_alignment_is_monotone_and_recurses_into_gaps():
    text = "x a b c q q d e f z".split()
    template = "a b c q q d e f".split()
    assert [template[j] for _, j in align(text, template)] == template
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 15))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 15))]
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


NOTICES = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
           "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}


@pytest.mark.parametrize("name", sorted(NOTICES))
def test_notices_are_found_wherever_they_stand(name):
    filler = "the work under this license text of the version and so on " * 400
    found = scan(filler + NOTICES[name] + " " + filler + NOTICES[name].upper(), TEMPLATES, 0.8)
    assert [f[0] for f in found] == [name, name] and all(f[3] == 1.0 for f in found)


def test_edited_long_text_is_covered_in_part():
    mit = next(t for t in TEMPLATES if t.license == "MIT-text")
    words = list(mit.words)
    for i in range(5, len(words), 12):
        words[i] = "changed"
    found = scan("intro " + " ".join(words) + " outro", TEMPLATES, 0.8)
    assert [f[0] for f in found] == ["MIT-text"] and 0.85 < found[0][3] < 1
    assert scan(" ".join(words[:len(words) // 2]), TEMPLATES, 0.8) == []
    assert scan(" ".join(reversed(mit.words)), (mit,), 0.8) == []


def test_clean_text_has_none():
    assert scan("a plain sentence about a license to drive under the bridge", TEMPLATES, 0.8) == []


def test_query_on_edges(spark, table):
    rows = [*EDGE, (20, NOTICES["MIT"]), (20, NOTICES["MIT"])]
    out = license_scan(table(rows)).collect()
    assert len(out) == len(rows)
    assert [r.license for r in out if r.doc_id == 20] == ["MIT", "MIT"]
    assert all(r.license is None and r.coverage == 0 and r.notices == [] for r in out if r.doc_id != 20)
    assert license_scan(table([])).count() == 0
    odd = spark.createDataFrame([(1, "x", "mine", 3)], "doc_id long, text string, license string, coverage int")
    assert license_scan(odd).first().license is None
    assert scan("one two", (Template.of("own", "one two"),), 0.8)[0][0] == "own"


@pytest.mark.parametrize(("text", "name"), [
    ("Released under the BSD License.", "BSD"), ("Released under the XYZ License.", None),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under the GNU Library General Public License, version 3.", None),
    ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"), ("Licensed under the Apache License, Version 3.0.", None),
    ("Licensed under the Apache License, Version 1.0. See section 2.0.", None),
    ("Licensed under the Apache License 2.0.", "Apache-2.0"),
    ("Licensed under CC BY 3.0.", "CC-BY-3.0"), ("Licensed under CC BY 9.0.", None),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0")])
def test_near_miss_notices_are_not_another_license(text, name):
    assert [f[0] for f in scan(text, TEMPLATES, 0.8)] == ([name] if name else [])


@pytest.mark.parametrize(("name", "file"), sorted(TEXTS.items()))
def test_whole_texts_are_found_and_openings_are_not(name, file):
    text = whole(file)
    assert [(f[0], f[3]) for f in scan(f"before it {text} and after", TEMPLATES, 0.8)] == [(name, 1.0)]
    words = text.split()
    assert scan(" ".join(words[:len(words) // 5]), TEMPLATES, 0.8) == []


def test_a_related_text_is_not_taken_for_the_license():
    other = whole("CC-BY-4.0").replace("Attribution 4.0", "Attribution-NonCommercial 4.0")
    assert scan(other, TEMPLATES, 0.8) == []


def test_texts_travel_in_the_package():
    import zipfile

    from kpiloom.llm import common

    sent = []

    class Context:
        addPyFile = staticmethod(sent.append)

    common.on_executors(type("Session", (), {"sparkContext": Context()})())
    assert "kpiloom/llm/license_texts/MIT.txt" in zipfile.ZipFile(sent[0]).namelist()


@pytest.mark.parametrize(("text", "name"), [
    ("Licensed under CC BY 4.0. ", "CC-BY-4.0"), ("Released under the MIT License. ", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3. see ", "GPL-3.0"),
    (whole("MIT") + " ", "MIT-text"), (whole("BSD-3-Clause").replace("REGENTS", "some other HOLDERS") + " by others ", "BSD-3-Clause-text")])
def test_notices_back_to_back_are_all_found(text, name):
    for copies in (2, 3, 5):
        found = sorted(scan(text * copies, TEMPLATES, 0.8), key=lambda f: f[1])
        assert [f[0] for f in found] == [name] * copies
        step = len(WORD.findall(text))
        assert all(i * step <= f[1] and f[1] + f[2] <= (i + 1) * step for i, f in enumerate(found))


def test_span_shares_match_counting():
    rng = random.Random(5)
    for _ in range(100):
        words = [rng.choice("abcde") for _ in range(rng.randint(1, 30))]
        t = Template("x", tuple(rng.choice("abcd") for _ in range(rng.randint(1, 8))))
        got = span_shares(words, t)
        assert got == [(Counter(words[i:i + len(t.words)]) & Counter(t.words)).total() for i in range(len(words))]
