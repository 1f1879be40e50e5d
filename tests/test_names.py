import pytest
from hypothesis import given
from hypothesis import strategies as st

from kempt.functions.names import clean_name, clean_names, free_name, uniquify


@pytest.mark.parametrize("raw, clean", [
    (" First Name ", "first_name"), ("first-name", "first_name"), ("2nd", "x_2nd"), ("***", "column"),
    ("", "column"), ("É tat", "é_tat"), ("__a__b__", "a_b"), ("Petal.Length", "petal_length"), ("a\tb\n", "a_b"),
])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_clean_names_are_unique():
    assert clean_names([" First Name ", "first-name", "2nd", "***", "É tat"]) == [
        "first_name", "first_name_1", "x_2nd", "column", "é_tat"]


def test_uniquify_skips_taken_names():
    assert uniquify(["a", "a", "a_1", "a"]) == ["a", "a_2", "a_1", "a_3"]
    assert uniquify(["a", "b"], reserved=["A"]) == ["a_1", "b"]


def test_free_name_starts_at_two():
    assert free_name("a", ["b"]) == "a"
    assert free_name("a", ["a"]) == "a_2"
    assert free_name("a", ["a", "a_2"]) == "a_3"


@given(st.lists(st.text(max_size=6), max_size=12))
def test_uniquify_keeps_length_and_is_distinct(names):
    out = uniquify(names)
    assert len(out) == len(names) and len({n.lower() for n in out}) == len(out)


@given(st.text(max_size=20))
def test_clean_name_is_stable(text):
    assert clean_name(clean_name(text)) == clean_name(text)
