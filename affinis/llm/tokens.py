"""Token ids and token counts of whole texts, as the tokenizer's own library gives them.

Long texts are split at safe boundaries, and equal pieces are encoded once. A byte-level BPE model cuts a text by a pattern before
it merges bytes, and each cut stands alone, so wherever the pattern is certain to cut, the text may be split. A single space
between two characters that are surely no white space is such a place, and so are the ends of runs of Latin letters, of ASCII
digits and of ASCII punctuation (but for the apostrophe, which may take letters along). Text that holds anything else
keeps together and is encoded in one call.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm import words as W
from affinis.llm.common import text_of

#: bytes that a Python worker keeps for pieces, about; half of them for pieces that were met once so far
REMEMBERED_BYTES = 72 << 20
#: what a remembered piece takes besides its characters and ids, and the longest one that is kept
PIECE_COST, LONGEST = 200, 64
BATCH_BYTES = 1 << 19
OVER = 512

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_POINTS = r"!-&(-/:-@\[-`{-~"
_SURE = "[!-~¡-ɏ]"
#: the pattern's cuts in a text that these runs cover, see _plain_runs
_RUNS = re.compile(rf" ?[{_LETTERS}]+| ?[{_POINTS}]+| ?[0-9]+|\n")
_CUT = re.compile(rf"(?<={_SURE})(?= {_SURE})")


class _Known(dict):
    """Ids of pieces that were met in at least two batches; ``new`` has those of one, which move here when they are met again.

    A piece that neither holds gives None and goes to ``missing``; ``once`` has those of the batch that are not to be kept.
    """

    def __init__(self):
        super().__init__()
        self.new: dict[str, bytes] = {}
        self.held = self.held_new = 0
        self.missing: set[str] = set()
        self.once: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.new.pop(piece, None)
        if ids is None:
            self.missing.add(piece)
        else:
            self[piece] = ids
            cost = PIECE_COST + len(piece) + len(ids)
            self.held += cost
            self.held_new -= cost
        return ids

    def keep(self, pieces: list[str], ids: list[bytes]) -> None:
        self.new.update(zip(pieces, ids, strict=True))
        self.held_new += PIECE_COST * len(pieces) + sum(map(len, pieces)) + sum(map(len, ids))

    def forget(self, most: int) -> None:
        """Either half of ``most`` bytes is bounded: too many pieces met again count as new ones, too many new ones are dropped."""
        if self.held > most // 2:
            self.new, self.held_new = dict(self), self.held
            self.clear()
            self.held = 0
        elif self.held_new > most // 2:
            self.new, self.held_new = {}, 0


class PieceEncoder:
    """Token ids of texts as little-endian bytes, with a bounded memory of pieces already met."""

    def __init__(self, path: str, id_type: str = "<u4"):
        self.id_type = id_type
        self.width = np.dtype(id_type).itemsize
        self.known = _Known()
        self.specials: list[str] = []
        self.splits = False
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        self.model = None
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        layout = json.loads(self.tokenizer.to_str())
        before = layout.get("pre_tokenizer") or {}
        self.splits = (layout.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                       and not before.get("add_prefix_space") and layout["model"]["type"] == "BPE"
                       and not layout["model"].get("dropout"))
        self.specials = [t["content"] for t in layout.get("added_tokens") or ()]

    @property
    def held(self) -> int:
        """Bytes of all remembered pieces, about."""
        return self.known.held + self.known.held_new

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text in one call of the library for all."""
        if not texts:
            return []
        if self.model is not None:
            return [np.asarray(ids, dtype=self.id_type).tobytes() for ids in self.model.encode(texts, num_threads=1)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype=self.id_type).tobytes() for e in encoded]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; the texts should be a batch of bounded size."""
        if not self.splits:
            yield from self.whole(texts)
            return
        known, odd = self.known, set()
        known.forget(REMEMBERED_BYTES)
        get = known.__getitem__
        found = []
        for text in texts:
            pieces = self.pieces_of(text, odd)
            found.append((pieces, list(map(get, pieces))))
        missing, known.missing = known.missing, set()
        # long pieces hardly come again: they are known for this batch only
        long = [piece for piece in missing if len(piece) > LONGEST]
        known.once = dict(zip(long, self.whole(long), strict=True))
        missing.difference_update(long)
        alone = list(missing.intersection(odd))
        known.keep(alone, self.whole(alone))
        self._learn(list(missing.difference(odd)))
        for pieces, ids in found:
            if None in ids:
                ids = [x if x is not None else known.once[piece] if piece in known.once else known.new[piece] for piece, x in zip(pieces, ids, strict=True)]
            yield b"".join(ids)
        known.once = {}

    def _learn(self, runs: list[str]) -> None:
        """Encode runs as lines of one text: a line end before a run is a piece of its own, so its id parts them."""
        if "\n" in runs:
            self.known.keep(["\n"], self.whole(["\n"]))
            runs = [run for run in runs if run != "\n"]
        line = self.whole(["\n"])[0] if runs else b""
        for i in range(0, len(runs), 5000):
            lines = runs[i: i + 5000]
            ids = np.frombuffer(self.whole(["\n".join(lines)])[0], self.id_type)
            cuts = np.flatnonzero(ids == np.frombuffer(line, self.id_type)[0]) * self.width
            if len(cuts) != len(lines) - 1:  # a vocabulary in which the line end is more than one id, or merges
                self.known.keep(lines, self.whole(lines))
            else:
                data = ids.tobytes()
                begin, end = [0, *(cuts + self.width).tolist()], [*cuts.tolist(), len(data)]
                self.known.keep(lines, [data[a:b] for a, b in zip(begin, end, strict=True)])

    def pieces_of(self, text: str, odd: set[str]) -> list[str]:
        """The text in pieces between places where the pattern is certain to cut; those that are not plain runs go to ``odd`` too."""
        if any(s in text for s in self.specials):
            odd.add(text)
            return [text]
        runs = _plain_runs(text)
        if runs is not None:
            return runs
        pieces = []
        for part in _CUT.split(text):
            runs = _plain_runs(part)
            if runs is None:
                odd.add(part)
                pieces.append(part)
            else:
                pieces += runs
        return pieces


def _plain_runs(text: str) -> list[str] | None:
    """The runs of a text that has nothing else, or None: it has another character, or white space before white space or the end."""
    runs = _RUNS.findall(text)
    if sum(map(len, runs)) < len(text) or text.endswith("\n") or "\n\n" in text or "\n " in text:
        return None
    return runs


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, id_type: str = "<u4") -> PieceEncoder:
    """The worker's encoder for a tokenizer file; workers are used again, and so is what they remember."""
    if (path, id_type) not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path, id_type] = PieceEncoder(path, id_type)
    return _ENCODERS[path, id_type]


def release() -> None:
    """Give back what the worker's encoders remember: workers are used again by stages that don't encode."""
    _ENCODERS.clear()


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", over: int = OVER) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    Only ``doc_id`` and text go to Python and only lengths come back. Rows are encoded in groups of about equal bytes. A null text
    counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids are kept. No special tokens are added; special strings inside a
    text are read as the library does by default.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts, BATCH_BYTES):
                part = texts.slice(i, j - i)
                lengths = np.fromiter((len(x) for x in own.ids(part.to_pylist())), np.int64, j - i) // own.width
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), pc.cast(pc.binary_length(part), pa.int64()), pa.array(lengths),
                    pa.array(lengths > over)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
