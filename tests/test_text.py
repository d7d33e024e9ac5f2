from collections import Counter

import pytest
from pyspark.sql import functions as F

from fairspark.functions.text import line_array, tokens
from fairspark.operators import words
from fairspark.sources.text import lines_from, read_text_lines


def _tok(spark, line):
    return spark.createDataFrame([(line,)], "v string").select(tokens("v").alias("t")).head()["t"]


@pytest.mark.parametrize("line,expected", [
    ("a b  ", ["a", "b"]),          # trailing empties dropped
    ("a  b", ["a", "", "b"]),       # inner empty kept
    (" a", ["", "a"]),              # leading empty kept
    ("", [""]),                     # empty line: one empty token
    ("   ", []),                    # only spaces: none
    ("x\ty. Z", ["x\ty.", "Z"]),    # only the space separates; case and punctuation kept
])
def test_tokens_follow_single_space_split(spark, line, expected):
    assert _tok(spark, line) == expected


@pytest.mark.parametrize("text,expected", [
    ("a\nb", ["a", "b"]),
    ("a\r\nb\rc", ["a", "b", "c"]),
    ("a\n", ["a"]),                 # one final terminator is not a new line
    ("a\n\n", ["a", ""]),
    ("\n", [""]),
    ("a\r\n", ["a"]),
    ("", []),
])
def test_line_array(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(line_array("t").alias("l")).head()["l"]
    assert got == expected


def _java_split(line):
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _python_counts(texts):
    c = Counter()
    for t in texts:
        for line in t.splitlines():
            c.update(_java_split(line))
    return c


TEXTS = ["the cat  the\nDog dog.\n", "", "  lead\n\nthe end  ", "one\r\ntwo\rthree"]


@pytest.fixture()
def lines(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return lines_from(df, "text", ["doc_id"])


def test_all_variants_agree_with_brute_force(lines):
    expected = {w: n for w, n in _python_counts(TEXTS).items() if n}
    for mode in words.MODES:
        got = {r["word"]: r["n"] for r in words.word_counts(lines, mode, 3, ["doc_id", "line_no"]).collect()}
        assert got == expected, mode


def test_counts_sum_to_token_count_and_distinct(lines):
    counts = words.word_counts(lines)
    total = lines.select(F.explode(tokens("value"))).count()
    assert counts.agg(F.sum("n")).head()[0] == total
    assert words.distinct_words(counts).head()["n_words"] == counts.count()


def test_avg_word_length_over_distinct_words(lines):
    counts = words.word_counts(lines)
    ws = [r["word"] for r in counts.collect()]
    got = words.avg_word_length(counts).head()["avg_word_length"]
    assert got == pytest.approx(sum(len(w) for w in ws) / len(ws))


def test_per_doc_counts(lines):
    got = {(r["doc_id"], r["line_no"], r["word"]): r["n"]
           for r in words.per_doc_counts(lines).collect()}
    assert got[(0, 0, "the")] == 2
    assert got[(0, 0, "")] == 1
    assert got[(2, 1, "")] == 1       # the empty second line of doc 2
    assert (1, 0, "") not in got       # an empty text has no line
    assert words.num_docs(lines).head()["n_docs"] == 2 + 0 + 3 + 3


def test_read_text_file(spark, tmp_path):
    p = tmp_path / "docs.txt"
    p.write_text("a b\nb c c\n")
    lines = read_text_lines(spark, str(p), partitions=2)
    got = {r["word"]: r["n"] for r in words.word_counts(lines, "salted", 4).collect()}
    assert got == {"a": 1, "b": 2, "c": 2}


def test_documents_table_sf001(spark):
    from fairspark.plans import tables
    lines = tables.doc_lines(spark, "/root/testdata/sf0.01", keep_line_no=False)
    counts = words.word_counts(lines)
    assert words.distinct_words(counts).head()["n_words"] == 93796
    assert counts.agg(F.sum("n")).head()[0] == 390171
    assert words.avg_word_length(counts).head()[0] == pytest.approx(7.77705872318649, abs=1e-12)
