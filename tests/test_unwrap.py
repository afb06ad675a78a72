"""Wrappers by hand, and lists that Python and JSON made themselves."""

import json
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polyglotmill.functions import unwrap as u

CASES = [
    ("['a b']", "a b"), ('["a b"]', "a b"), ("[ 'a' , 'b' ]", "a"), ("[['deep', 'x'], 1]", "deep"), ("[]", ""), ("[[]]", ""), ("[None, 'x']", ""), ("[null]", ""), ("[12, 'x']", "12"),
    ("['one' 'two']", "onetwo"), (r"['it\'s']", "it's"), (r'["a\nb\u00e9\ud83d\ude00"]', "a\nbé😀"), ("['[\"twice\"]']", "twice"), ("[\n  'x',\n  'y',\n]", "x"),
    ("['It's fine']", "It's fine"), ('["two\nlines"]', "two\nlines"), ("[abc]", "abc"), ("[“Von”]", "Von"), ("[‘a’]", "a"), ("[« a »]", "a"),
    ("['broken", "broken"), ('["broken', "broken"), ("broken']", "broken"), ("broken ’ ]", "broken ’"), ('["[\'deep', "deep"), ("text']\" ]", "text"), ("say \"hi\"", 'say "hi'), ("'quoted'", "quoted"),
    (r"a \"b\" c", 'a "b" c'), ("a [1] b", "a [1] b"), ("plain", "plain"), ("  padded ", "padded"), ("", ""), (None, ""), ("'", ""), ("[", ""), ("x]y", "x]y"), ("['a', 'b'", "a', 'b"),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_by_hand(text, want):
    assert u.unwrap(text) == want


def test_columns_are_the_same(spark):
    rows = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(CASES)], "id int, x string")
    got = {r.id: r.y for r in rows.select("id", u.unwrap_text(F.col("x")).alias("y")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), min_size=1, max_size=3), st.booleans())
def test_lists_turned_into_strings(values, as_json):
    text = json.dumps(values) if as_json else repr(values)
    assert u.inside(text) == values[0].strip()


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("'" * 200_000 + "x", "[" * 200_000, "x" + "']" * 100_000, "[" + "'a'," * 100_000, "[" * 900 + "]" * 900, "a' " * 100_000 + "x"):
        u.unwrap(text)
    assert time.time() - began < 5
