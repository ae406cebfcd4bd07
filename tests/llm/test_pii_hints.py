"""What the rules rewrite doesn't depend on where the hints send them."""

import random

import pytest

from affinis.llm import pii


@pytest.mark.parametrize("text, kind, source", [
    ("at 192.168.one.one now", "ip", "192.168.one.one"),
    ("at one.2.3.4 now", "ip", "one.2.3.4"),
    ("at 10.0.0.One Two now", "ip", "10.0.0.One Two"),
    ("call +1 555 one two 34567 now", "phone", "+1 555 one two 34567"),
    ("card four 111 1111 1111 1111 end", "card", "four 111 1111 1111 1111"),
    ("card ٤١١١ ١١١١ ١١١١ ١١١١ end", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("at १९२.१६८.१.१ now", "ip", "१९२.१६८.१.१"),
    ("call +1 555 𝟏𝟐𝟑 4567 now", "phone", "+1 555 𝟏𝟐𝟑 4567"),
    ("at ١٩٢ dot 168 dot ١ dot one now", "ip", "١٩٢ dot 168 dot ١ dot one"),
])
def test_disguises_with_few_digit_words_or_digits_of_other_scripts(text, kind, source):
    assert [(k, text[a:b]) for k, a, b in pii.find_spans(text)[1]] == [(kind, source)]


def test_spans_with_and_without_hints_agree(monkeypatch):
    draw = random.Random(32)
    parts = ["one", "two", "Six", "neun", "oh", "4", "111", "1111", "192", "555 1234", "٤", "१", "𝟏", "３", "dot", "at", "(at)", "[dot]",
             "plus", "+", "@", "john", "example", "com", "о", "İ", "and"]
    gaps = [" ", " ", ".", ".", "-", ", ", "  ", " - ", ""]
    texts = ["".join(draw.choice(parts) + draw.choice(gaps) for _ in range(draw.randint(1, 14))) for _ in range(30_000)]
    for _ in range(10_000):  # addresses and numbers with some digits disguised
        digits = [draw.choice("0123456789") for _ in range(draw.choice([4, 4, 10, 16]))]
        sign = draw.choice([".", ".", " ", "-", " dot "])
        texts.append(draw.choice(["", "+", "plus "]) + sign.join(
            draw.choice([d, d, d + d, draw.choice([w for w, v in pii._DIGIT_WORDS.items() if v == d])]) for d in digits))
    gated = [pii.find_spans(t) for t in texts]
    monkeypatch.setattr(pii, "_hints", lambda text: [(0, len(text))])
    every = [pii.find_spans(t) for t in texts]
    differ = [(t, g[1], e[1]) for t, g, e in zip(texts, gated, every, strict=True) if g != e]
    assert not differ, differ[:3]
    assert sum(plain != found for plain, found in every) > 500
