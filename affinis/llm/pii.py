"""Personal data in whole texts: e-mail and IP addresses, card and phone numbers, plain and disguised, as spans of the source text.

Plain identifiers are found by four patterns, leftmost and non-overlapping per kind, in time linear in the text.

Disguised ones are found in a normalised copy. Transducers rewrite, from left to right: look-alike letters of other scripts,
decimal digits of all scripts and full-width forms to ASCII; invisible characters to nothing; runs of spelled digits (English, French, German, Spanish) to
digits; bracketed or spelled "at", "dot", "plus" and their kin to the signs they stand for. Each character of the copy keeps the
source span it was made of, so a match in the copy is mapped back to the span from the first character's start to the last one's
end. ASCII letters that look like digits count as such in a group of digits. Only the surroundings of a disguise are normalised and
searched, and of their matches those that a disguise took part in are added, also where they reach over a plain one, as
where only the head of an address is disguised; what lies inside a plain span of its kind is none of its own.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm import words as W
from affinis.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run of local characters before it and a dotted host behind it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        host = _HOST.match(text, at + 1) if begin < at else None
        # characters back to ``free`` are read again only by an @ right behind them, and @ is no local character
        if host:
            yield begin, host.end()
        free = host.end() if host else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Fours of numbers joined by single dots; a longer chain is taken four by four from the left."""
    for chain in _CHAIN.finditer(text):
        start, parts = chain.start(), chain[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i: i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _digits(match[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_digits(match[0])) <= 15:
            yield match.span()


def plain_spans(text: str) -> list[Span]:
    """Undisguised identifiers, by kind in the order of KINDS, then by place."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text):
        for kind, finder in (("ip", _ips), ("card", _cards)):
            found += [(kind, *span) for span in finder(text)]
        if "+" in text:
            found += [("phone", *span) for span in _phones(text)]
    return found


_DIGIT = re.compile("[0-9]")

# --- fixed values: look-alikes of Latin letters and signs in Cyrillic and Greek, and signs drawn alike
_LOOKALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТХУЗаеѕіјорсхуһԁԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονι",
    "ABESIJKMHOPCTXY3aesijopcxyhdqw" "ABEZHIKMNOPTYXovi", strict=True)) | {"․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-"}
#: decimal digits of all scripts come in rows of ten, in the order of their value
_ZEROS = [c for c in map(chr, range(128, 0x110000)) if unicodedata.decimal(c, None) == 0]
_FOLDED = {ord(zero) + k: str(k) for zero in _ZEROS for k in range(10)}
_INVISIBLE = frozenset("­​‌‍⁠﻿")
# --- fixed values: digit words, 0 to 9
_DIGIT_WORDS = {word: str(value) for row in (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
) for value, word in enumerate(row.split())} | {"oh": "0"}

_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_GAP = r"[ \t]*[-,.]?[ \t]*"
#: a run of at least three digit words, possibly with digits between
_SPELLED = re.compile(rf"(?<![^\W_])(?:{_WORD})(?:{_GAP}(?<![^\W_])(?:{_WORD}|[0-9]+)(?![^\W_])){{2,}}(?![^\W_])", re.IGNORECASE)
_SPELLED_PART = re.compile(rf"(?<![^\W_])(?:{_WORD})(?![^\W_])|[0-9]+", re.IGNORECASE)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"[ \t]*{_OPEN}[ \t]*(?:at|@|arobase|arroba|ät)[ \t]*{_CLOSE}[ \t]*"
_DOT = rf"[ \t]*{_OPEN}[ \t]*(?:dot|punkt|point|punto|\.)[ \t]*{_CLOSE}[ \t]*"
_BARE_AT = r"[ \t]+(?:at|arobase|arroba)[ \t]+"
_BARE_DOT = r"[ \t]+(?:dot|punkt|point|punto)[ \t]+"
_NAME = r"[A-Za-z0-9-]+"
_ANY_AT, _ANY_DOT = f"(?:{_AT}|{_BARE_AT}|@)", f"(?:{_DOT}|{_BARE_DOT}|\\.)"
#: a bracketed sign counts wherever it is; a bare "at" or "dot" only inside name-at-host-dot-suffix or between numbers
_BRACKETED = re.compile(f"(?P<at>{_AT})|(?P<dot>{_DOT})", re.IGNORECASE)
#: a run of dotted names, of any length, and the rest of an address if it follows; a run without one is passed over as a whole
_SPOKEN = re.compile(rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]++(?:{_ANY_DOT}[A-Za-z0-9_%+-]++)*+"
                     rf"(?:(?P<at>{_AT}|{_BARE_AT}|@){_NAME}(?:{_ANY_DOT}{_NAME})+)?+", re.IGNORECASE)
_DOTS = re.compile(f"{_DOT}|{_BARE_DOT}", re.IGNORECASE)
_NUMBER = rf"(?:[0-9]++|(?:{_WORD})(?:[ \t-]+(?:{_WORD})){{0,2}})"  # a part of an address has three digits at most
_SPOKEN_IP = re.compile(rf"(?<![^\W_]){_NUMBER}(?:{_ANY_DOT}{_NUMBER}){{3}}(?![^\W_])", re.IGNORECASE)
#: groups of digits and letters drawn like them, and the letters' values
_CONFUSED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?![A-Za-z0-9])(?:[ ().-]{1,2}[0-9OoIl]++(?![A-Za-z0-9]))*+")
_CONFUSED_GROUP = re.compile("[0-9OoIl]+")
_CONFUSED_PAIR = re.compile("[0-9][OoIl]|[OoIl][0-9]")
_LETTER_DIGITS = {"O": "0", "o": "0", "I": "1", "l": "1"}
_PLUS = re.compile(rf"(?<![^\W_])(?:plus|más)[ \t]+(?=(?:{_WORD})(?![^\W_])|[0-9])", re.IGNORECASE)

_HINT_DOT = re.compile(r"(?<![^\W_])(?:dot|punkt|point|punto)(?![^\W_])")
_HINT_BRACKET = re.compile(rf"{_OPEN}[ \t]*(?:at|@|arobase|arroba|ät|dot|punkt|point|punto|\.)[ \t]*{_CLOSE}", re.IGNORECASE)
_HINT_CHAR = re.compile(f"[{''.join(_LOOKALIKES)}{''.join(_INVISIBLE)}！-～{''.join(f'{zero}-{chr(ord(zero) + 9)}' for zero in _ZEROS)}]")
_REACH = 200


def _ascii_digits(text: str) -> str:
    """The text with the decimal digits of all scripts as ASCII ones, in the same places."""
    return text if text.isascii() else text.translate(_FOLDED)


def _rewrites(text: str) -> list[tuple[int, int, str]]:
    """Non-overlapping (start, end, replacement), in order; of overlapping ones the earlier rule wins."""
    found: list[tuple[int, int, str]] = []
    used = bytearray(len(text))

    def add(start: int, end: int, new: str) -> None:
        if used.find(1, start, end) < 0:
            used[start:end] = b"\1" * (end - start)
            found.append((start, end, new))

    for c in _HINT_CHAR.finditer(text):
        sign = c[0]
        new = _LOOKALIKES.get(sign) or _FOLDED.get(ord(sign)) or unicodedata.normalize("NFKC", sign)
        add(*c.span(), "" if sign in _INVISIBLE else new)
    text = _ascii_digits(text)
    for m in _BRACKETED.finditer(text):
        add(*m.span(), "@" if m.lastgroup == "at" else ".")
    for m in _SPOKEN.finditer(text):
        if m["at"] is None:
            continue
        dots = list(_DOTS.finditer(text, m.start(), m.end()))
        if dots or m["at"].strip(" \t")[:1] in "[({<@":  # a bare "at" needs a spoken dot beside it
            if m["at"] != "@":
                add(*m.span("at"), "@")
            for dot in dots:
                add(*dot.span(), ".")
    for m in _SPOKEN_IP.finditer(text):
        for dot in _DOTS.finditer(text, m.start(), m.end()):
            add(*dot.span(), ".")
        rows = _spelled(text, m.start(), m.end(), keep=".")
        for row in rows:
            add(*row)
        if rows and any(_ips(_DOTS.sub(".", _replaced(text, m.start(), m.end(), rows)))):
            used[m.start():m.end()] = b"\1" * (m.end() - m.start())  # the dots of an address stay
    for start, end in _confused(text):
        for k in range(start, end):
            if text[k] in _LETTER_DIGITS:
                add(k, k + 1, _LETTER_DIGITS[text[k]])
    for m in _PLUS.finditer(text):
        add(*m.span(), "+")
    for m in _SPELLED.finditer(text):
        for row in _spelled(text, m.start(), m.end()):
            add(*row)
    return sorted(found)


def _confused(text: str) -> list[tuple[int, int]]:
    """Groups that hold digits and letters drawn like them, in runs of groups of which two thirds of the characters are digits."""
    found: list[tuple[int, int]] = []
    if _CONFUSED_PAIR.search(text):
        for run in _CONFUSED.finditer(text):
            groups = [g.span() for g in _CONFUSED_GROUP.finditer(text, *run.span())]
            digits = len(_digits(run[0]))
            if digits >= 4 and 3 * digits >= 2 * sum(b - a for a, b in groups):
                found += [(a, b) for a, b in groups if _CONFUSED_PAIR.search(text, a, b)]
    return found


def _spelled(text: str, start: int, end: int, keep: str = "") -> list[tuple[int, int, str]]:
    """Digit words as digits; what is between two of them goes, unless it holds ``keep`` or a dot word."""
    rows, last = [], None
    for part in _SPELLED_PART.finditer(text, start, end):
        if last is not None and part.start() > last:
            between = text[last: part.start()]
            if not (keep and (keep in between or any(c.isalpha() for c in between))):
                rows.append((last, part.start(), ""))
        word = part[0].lower()
        if word in _DIGIT_WORDS:
            rows.append((part.start(), part.end(), _DIGIT_WORDS[word]))
        last = part.end()
    return rows


def _replaced(text: str, start: int, end: int, rows: list[tuple[int, int, str]]) -> str:
    out = []
    for a, b, new in rows:
        out += [text[start:a], new]
        start = b
    return "".join(out) + text[start:end]


def normalise(text: str) -> tuple[str, list[int], list[int], list[bool]]:
    """The rewritten text; for each of its characters the start and end of its source, and whether it was rewritten."""
    out, starts, ends, changed, at = [], [], [], [], 0
    for a, b, new in _rewrites(text):
        out.append(text[at:a])
        starts += range(at, a)
        ends += range(at + 1, a + 1)
        changed += [False] * (a - at)
        out.append(new)
        starts += [a] * len(new)
        ends += [b] * len(new)
        changed += [True] * len(new)
        if not new and changed:
            changed[-1] = True  # something between this character and the next has gone
        at = b
    out.append(text[at:])
    starts += range(at, len(text))
    ends += range(at + 1, len(text) + 1)
    changed += [False] * (len(text) - at)
    return "".join(out), starts, ends, changed


@lru_cache(maxsize=1024)
def _whole_words(words: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    """The words as whole ones, and what makes a hint of one: two more of them or of numbers behind it."""
    word = f"(?:{'|'.join(words)})"
    return (re.compile(rf"(?<![^\W_]){word}(?![^\W_])"),
            re.compile(rf"{word}(?:[ \t,.-]++(?:{word}|[0-9]++)(?![^\W_])){{2}}"))


def _digit_words(low: str) -> list[tuple[int, int]]:
    """Digit words with two more digit words or numbers behind them, or behind a number and a dot.

    Every run that _SPELLED matches begins with the first, and in an address without dot words each spelled part is one of both
    or stands among the two behind the first.
    """
    present = tuple(w for w in _DIGIT_WORDS if w in low and _whole_words((w,))[0].search(low))
    if not present:
        return []
    found, (word, chain) = [], _whole_words(present)
    for m in word.finditer(low):
        if run := chain.match(low, m.start()):
            found.append(run.span())
        elif m.start() > 1 and low[m.start() - 1] == "." and "0" <= low[m.start() - 2] <= "9":
            found.append(m.span())
    return found


def _hints(text: str) -> list[tuple[int, int]]:
    """Places where something may be disguised."""
    found = []
    if not text.isascii():
        found += [m.span() for m in _HINT_CHAR.finditer(text)]
    folded = _ascii_digits(text)
    low = folded.lower()
    if len(low) != len(text):  # a letter that lower case makes longer: its capital stays, so places agree
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in folded)
    if any(w in low for w in ("dot", "punkt", "point", "punto")):
        found += [m.span() for m in _HINT_DOT.finditer(low)]
    found += _digit_words(low)
    found += _confused(folded)
    if "plus" in low or "más" in low:
        found += [m.span() for m in _PLUS.finditer(low)]
    if any(c in text for c in "[({<"):
        found += [m.span() for m in _HINT_BRACKET.finditer(text)]
    return sorted(found)


def hidden_spans(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that show only after normalising; none lies inside a plain one of its kind."""
    regions: list[list[int]] = []
    for a, b in _hints(text):
        a, b = max(0, a - _REACH), min(len(text), b + _REACH)
        # a region begins and ends between words, so it cuts no identifier that is shorter than the reach
        while a and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if regions and a <= regions[-1][1]:
            regions[-1][1] = max(b, regions[-1][1])
        else:
            regions.append([a, b])
    found: list[Span] = []
    for a, b in regions:
        copy, starts, ends, changed = normalise(text[a:b])
        for kind, begin, end in plain_spans(copy):
            if any(changed[begin:end]):
                found.append((kind, a + starts[begin], a + ends[end - 1]))
    if found and plain:
        # plain spans of a kind don't overlap, so the last one that begins at or before a span is the one that may hold it
        starts = {kind: [s[1:] for s in plain if s[0] == kind] for kind in KINDS}
        found = [s for s in found if not _inside(s, starts[s[0]])]
    return found


def _inside(span: Span, plain: list[tuple[int, int]]) -> bool:
    k = bisect_right(plain, span[1], key=lambda p: p[0])
    return k > 0 and span[2] <= plain[k - 1][1]


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans and all spans, each by kind in the order of KINDS, then by start; code points, end exclusive."""
    plain = plain_spans(text)
    hidden = hidden_spans(text, plain)
    every = sorted({*plain, *hidden}, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if hidden else plain
    return plain, every


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row of ``docs``.

    The counts and ``base_sha256`` are of the plain spans, ``spans`` lists plain and disguised ones. Null and empty texts have none;
    null ids and repeated rows are kept.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts):
                found = [find_spans(t) for t in texts.slice(i, j - i).to_pylist()]
                counts = [pa.array([sum(s[0] == k for s in plain) for plain, _ in found], pa.int64()) for k in KINDS]
                digests = [hashlib.sha256(_joined(plain).encode()).hexdigest() for plain, _ in found]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *counts, pa.array(digests, pa.string()),
                                                  pa.array([_joined(every) for _, every in found], pa.string())], names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(find, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")
