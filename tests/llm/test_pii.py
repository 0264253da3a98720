import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trendmill.llm import pii


def plain_base(text):
    """The base identifiers as the contract words them."""
    spans = [
        (0, m.start(), m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(v // 10 + v % 10 for v in doubled) % 10 == 0:
            spans.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.1 2+-9()0b%é", max_size=40))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.identifiers(text) == plain_base(text)
    assert [s[:3] for s in pii.spans_of(text) if s[3]] == plain_base(text)


@pytest.mark.parametrize("text, kind, found", [
    ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("write to john at example dot com", "email", "john at example dot com"),
    ("bob @ mail.example.org", "email", "bob @ mail.example.org"),
    ("jоhn@example.com", "email", "jоhn@example.com"),
    ("a​b@ex​ample.com", "email", "a​b@ex​ample.com"),
    ("card ４１１１ １１１１ １１１１ １１１１.", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("four " + "one " * 15, "card", ("four " + "one " * 15).strip()),
    ("call plus one five five five one two three four five six seven ok", "phone",
     "plus one five five five one two three four five six seven"),
    ("ip 192[.]168[.]1[.]1 x", "ip", "192[.]168[.]1[.]1"),
    ("one nine two dot one six eight dot one dot one", "ip",
     "one nine two dot one six eight dot one dot one"),
])
def test_disguises_map_back_to_the_source(text, kind, found):
    spans = [(pii.KINDS[k], text[s:e]) for k, s, e, base in pii.spans_of(text) if not base]
    assert (kind, found) in spans


@pytest.mark.parametrize("text", [
    "meet at the dot matrix printer", "one two three go", "see [1] and (at) noon", "un deux trois",
])
def test_clean_text_stays_clean(text):
    assert pii.spans_of(text) == [] and pii.masked(text, []) == text


@pytest.mark.parametrize("around", ["{}", "{} on point", "{}, an appointment", "dotted: {}"])
@pytest.mark.parametrize("text, found", [
    ("write to jane at example.com", "jane at example.com"),
    ("email: jane at firma.ch", "jane at firma.ch"),
    ("so jane.doe at firma.ch said", "jane.doe at firma.ch"),
    ("so jane arroba example.com said", "jane arroba example.com"),
    ("so jane arobase firma.it said", "jane arobase firma.it"),
    ("so jane\t@\tfirma.it said", "jane\t@\tfirma.it"),
    ("so jane at firma dot ch said", "jane at firma dot ch"),
    ("so jane at firma dot nl said", "jane at firma dot nl"),
    ("so jane at firma dot it said", "jane at firma dot it"),
    ("so jane at firma dot ai said", "jane at firma dot ai"),
    ("so jane at mail.firma dot museum said", "jane at mail.firma dot museum"),
    ("so jane at mail dot firma.online said", "jane at mail dot firma.online"),
    ("so jane at firma punkt ch said", "jane at firma punkt ch"),
    ("so jane at firma point ch said", "jane at firma point ch"),
    ("so jane arobase firma point it said", "jane arobase firma point it"),
    ("so jane arroba firma punto ar said", "jane arroba firma punto ar"),
    ("available at github.com", None),
    ("contact us at example.com", None),
    ("arrived at one point it rained", None),
    ("look at this point in time", None),
    ("at boiling point water boils", None),
    ("meet at the dot matrix printer", None),
])
def test_a_spoken_at_is_judged_by_its_own_words(text, found, around):
    whole = around.format(text)
    spans = [(pii.KINDS[k], whole[s:e], base) for k, s, e, base in pii.spans_of(whole)]
    assert spans == ([("email", found, False)] if found else [])


def test_a_quoted_spelled_run_needs_no_other_spelled_word():
    run = "four 111 1111 1111 1111 1"
    text = f'"{run}"'
    assert pii.deobfuscated(text).text == '"41111111111111111"'


def test_overlapping_spans_are_masked_once():
    text = "jоhn@example.com and x@y.org"
    assert pii.masked(text, pii.spans_of(text)) == "<EMAIL> and <EMAIL>"


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, " " * 300_000, "+1 " * 100_000, "1." * 150_000):
        pii.spans_of(text)


def test_any_number_of_leading_zeros_in_an_address():
    text = "0" * 4_300 + "1.2.3.4"
    assert pii.spans_of(text) == [(1, 0, len(text), True)]
    assert pii.spans_of("0" * 5_000 + ".0.0.0")[0][:2] == (1, 0)
    assert pii.spans_of("0" * 5_000 + "256.2.3.4") == []


def test_odd_rows(odd, none):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == [] for r in rows if r["doc_id"] in (2, 3))
    masked = pii.mask_personal_data(odd)
    assert masked.columns == odd.columns
    assert masked.where("text is null").count() == 2
    assert pii.find_personal_data(none).count() == 0
