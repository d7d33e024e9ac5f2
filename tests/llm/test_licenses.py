"""Planted notices, whole, changed within the bound and beyond it, in texts without any other licence words."""

import difflib
import random

import pytest

from fairspark.llm import licenses

# one wording in which no other template lies, so that what was planted is what is to be found
PLANTED = sorted(k for k in licenses.TEMPLATES if not k.endswith("-notice"))


def prose(rng, n):
    return [rng.choice("lerth onmat brin suvo tarn ilko wem drast polu neth").capitalize() if rng.random() < 0.1
            else "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def changed(words, n, rng):
    """``words`` with ``n`` of them left out, none at an end (so the place stays where it was)."""
    gone = set(rng.sample(range(1, len(words) - 1), n)) if n else set()
    return [w for i, w in enumerate(words) if i not in gone]


def brute(text, templates):
    """Templates of which some run of words differs by at most the bound: every start and every end."""
    got = licenses.words_of(text)
    out = set()
    for name, t in templates.items():
        want = licenses.words_of(t)
        slack = int(licenses.MAX_DIFFERENT * len(want))
        for a in range(len(got)):
            for b in range(a + len(want) - slack, min(len(got), a + len(want) + slack) + 1):
                same = sum(m.size for m in difflib.SequenceMatcher(None, got[a:b], want, autojunk=False).get_matching_blocks())
                if len(want) + (b - a) - 2 * same <= licenses.MAX_DIFFERENT * len(want):
                    out.add(name)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_planted_notices_are_found_in_order(seed):
    rng = random.Random(seed)
    text, want = " ".join(prose(rng, 40)), []
    for name in rng.sample(PLANTED, len(PLANTED)):
        words = licenses.TEMPLATES[name].split(" ")
        n = rng.randint(0, int(licenses.MAX_DIFFERENT * len(words) / 2)) if len(words) > 20 else 0
        start = len(text) + 1
        block = " ".join(changed(words, n, rng))
        text += f" {block}\n" + " ".join(prose(rng, rng.choice([3, 60, 900])))
        want.append((name, start, n > 0))
    rows = [r for r in licenses.TemplateScanner().scan(text) if r[-1]]
    assert [(r[2], r[0], r[4] > 0) for r in rows] == want
    assert all(r[4] <= licenses.MAX_DIFFERENT for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_own_templates_against_every_place(seed):
    """Templates of the caller's own without a licence word: the opening words come from them."""
    rng = random.Random(100 + seed)
    own = {f"T{i}": " ".join(w.lower() for w in prose(rng, n)) for i, n in enumerate((4, 9, 16, 30))}
    for _ in range(12):
        name = rng.choice(sorted(own))
        words = own[name].split(" ")
        # from whole to well beyond the bound
        block = changed(words, rng.randint(0, min(len(words) - 2, 2 * int(licenses.MAX_DIFFERENT * len(words)) + 1)), rng)
        text = " ".join([*prose(rng, rng.randint(0, 50)), *block, *prose(rng, rng.randint(0, 50))])
        found = {r[2] for r in licenses.TemplateScanner(own).scan(text) if r[-1]}
        assert found == brute(text, own)


def test_openers_cover_every_close_wording():
    for templates in (licenses.TEMPLATES, {"a": "one two", "b": "x " * 30}, {"none": "..."}):
        opens = set(licenses.openers(templates))
        for t in templates.values():
            words = licenses.words_of(t)
            slack = int(licenses.MAX_DIFFERENT * len(words))
            assert not words or sum(w in opens for w in words) > slack


def test_no_templates_and_edges(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "Under the MIT license."), (3, "Released under the MIT License."),
                                  (None, "İ İ Released under the\n# MIT License")], "doc_id long, text string")
    assert licenses.scan_licenses(rows, {}).count() == 0 and licenses.scan_licenses(rows.limit(0)).count() == 0
    got = sorted((r["doc_id"] or 0, r["start"], r["license"]) for r in licenses.scan_licenses(rows).filter("confirmed").collect())
    assert got == [(0, 4, "MIT"), (3, 0, "MIT")]
