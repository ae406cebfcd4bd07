"""What the piece encoder remembers, and texts that its runs cover or don't."""

from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from affinis.llm import near_dedup, tokens

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_that_come_again_outlast_those_that_don_t(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 200_000)
    own, draw, learned = tokens.PieceEncoder(TOKENIZER), random.Random(3), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda runs: (learned.extend(runs), learn(runs))[1])
    common = [f" gemein{k}sam".replace(str(k), chr(97 + k)) for k in range(20)]
    for _ in range(40):
        once = ["".join(draw.choice("abcdefghijklmnopqrst") for _ in range(12)) for _ in range(200)]
        list(own.ids(["x" + "".join(common) + " " + " ".join(once)]))
        assert own.held <= 200_000 + 60_000  # the bound and a batch
    assert all(learned.count(piece) == 1 for piece in common)


def test_white_space_anywhere_is_read_as_by_the_library():
    library, own, draw = Tokenizer.from_file(TOKENIZER), tokens.PieceEncoder(TOKENIZER, "<u4"), random.Random(4)
    for _ in range(2000):
        text = "".join(draw.choice(["a", "Wort", "7", "!", " ", "\n", "  ", "\t", "'s", "é", "я", " ", "<s>"]) for _ in range(draw.randint(0, 9)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert next(iter(own.ids([text]))) == b"".join(x.to_bytes(4, "little") for x in ids), repr(text)


def test_a_stage_that_does_not_encode_gives_back_what_the_encoders_remember(monkeypatch):
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    list(tokens.encoder(TOKENIZER).ids(["some words"]))
    list(near_dedup._sketcher(2, 2)(iter(())))
    assert not tokens._ENCODERS
