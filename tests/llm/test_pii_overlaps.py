"""Disguises that reach over a plain match, long dotted names, and letters drawn like digits."""

import time

import pytest

from affinis.llm import pii


@pytest.mark.parametrize("text, kind, source, plain", [
    ("x j\u043ehn@example.com x", "email", "j\u043ehn@example.com", "hn@example.com"),
    ("x 1\uff192.168.1.1 x", "ip", "1\uff192.168.1.1", "2.168.1.1"),
    ("x jo\u200bhn@example.com x", "email", "jo\u200bhn@example.com", "hn@example.com"),
    ("x john dot doe@example.com x", "email", "john dot doe@example.com", "doe@example.com"),
    ("x jane@mail.example[dot]com x", "email", "jane@mail.example[dot]com", "jane@mail.example"),
])
def test_a_disguise_over_a_plain_span_is_added(text, kind, source, plain):
    base, every = pii.find_spans(text)
    assert [(k, text[a:b]) for k, a, b in base] == [(kind, plain)]
    assert {(k, text[a:b]) for k, a, b in every} == {(kind, plain), (kind, source)}


@pytest.mark.parametrize("dots", [1, 16, 17, 18, 40, 3000])
def test_names_of_any_number_of_spoken_dots(dots):
    name = " dot ".join(["part"] * (dots + 1)) + " at example dot com"
    text = f"mail {name}!"
    assert [(k, text[a:b]) for k, a, b in pii.find_spans(text)[1]] == [("email", name)]


@pytest.mark.parametrize("text, kind, source", [
    ("card 4l11 1111 1111 1111 end", "card", "4l11 1111 1111 1111"),
    ("card 4111 11I1 11l1 1111 end", "card", "4111 11I1 11l1 1111"),
    ("host 1O.2O.3.44 up", "ip", "1O.2O.3.44"),
    ("call +1 555 O12 3456 now", "phone", "+1 555 O12 3456"),
])
def test_letters_drawn_like_digits(text, kind, source):
    assert (kind, source) in [(k, text[a:b]) for k, a, b in pii.find_spans(text)[1]]


@pytest.mark.parametrize("text", ["I have 10l of oil", "lOl 5 Il 0", "I 12 l 9 O", "ll OO 11 00", "vol. 3l"])
def test_letters_elsewhere_stay(text):
    assert pii.find_spans(text) == ([], [])


def test_long_runs_take_linear_time():
    for unit in ("a dot ", "a. ", "1l ", "1l.", "x@y.z dot ", "+1l ", "\u043e@a.b "):
        began = time.perf_counter()
        pii.find_spans(unit * 20_000)
        assert time.perf_counter() - began < 20
