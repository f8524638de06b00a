"""A plain reading of a text with, for every character of it, the place in the text it came from."""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from dataclasses import dataclass
from itertools import chain


def _classes(categories: str, *spans: range) -> list[str]:
    """The characters of each general category named, for use between brackets in a pattern."""
    runs: dict[str, list[list[int]]] = {c: [] for c in categories.split()}
    for i in chain(*spans):
        own = runs.get(unicodedata.category(chr(i)))
        if own is None:
            continue
        if own and i == own[-1][1] + 1:
            own[-1][1] = i
        else:
            own.append([i, i])
    return ["".join(re.escape(chr(a)) if a == b else f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in r) for r in runs.values()]


# Bitmaps serve a class of the first 65,536 characters; every further range costs a comparison a character.
_NEAR = range(0x10000)
_HIDDEN, UPPER, *_MARKS = _classes("Cf Lu Mn Mc Me", _NEAR)
_FAR = "\U00010000-\U0010ffff"
_HIDDEN_ALL, *_MARKS_ALL = _classes("Cf Mn Mc Me", _NEAR, range(0x10000, 0x20000), range(0xE0000, 0xE0200))  # the other planes have none
#: Where something other than ordinary characters and single spaces may begin, in texts of ASCII and in others.
_START_ASCII = re.compile(r"[ \t-\r\x1c-\x1f&<*](?:(?<! )|(?=\s))")
_START = re.compile(rf"[ \t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000&<*{_HIDDEN}{''.join(_MARKS)}{_FAR}](?:(?<! )|(?=\s))")
_SPECIAL = re.compile(rf"[{_HIDDEN_ALL}]+|&(?:#\d{{1,7}}|#x[0-9A-Fa-f]{{1,6}}|[A-Za-z]{{2,8}});|</?[A-Za-z][A-Za-z0-9]{{0,9}}\s*/?>|\*\*|\s+|[{''.join(_MARKS_ALL)}]+")


@dataclass(frozen=True)
class Plain:
    """text, and its pieces in order: begin[k] is where piece k begins in text, came[k] and went[k] are its place in the source.

    The characters of a piece of the source's length stand for one each, those of any other piece for all of its place.
    """

    text: str
    begin: list[int]
    came: list[int]
    went: list[int]

    def _piece(self, i: int) -> tuple[int, bool]:
        k = bisect_right(self.begin, i) - 1
        n = (self.begin[k + 1] if k + 1 < len(self.begin) else len(self.text)) - self.begin[k]
        return k, n == self.went[k] - self.came[k]

    def source(self, i: int) -> int:
        """Where text[i] begins in the source."""
        if not self.begin:
            return i
        k, even = self._piece(i)
        return self.came[k] + i - self.begin[k] if even else self.came[k]

    def source_end(self, i: int) -> int:
        """Behind the source of text[i - 1]."""
        if not self.begin:
            return i
        k, even = self._piece(i - 1)
        return self.came[k] + i - self.begin[k] if even else self.went[k]


def plain(text: str) -> Plain:
    """Entities resolved, compatible forms unified, invisible characters and markup taken out (markup becomes a space).

    White space becomes one space, or one line feed where a line is left empty.
    """
    start_of = _START_ASCII if text.isascii() else _START
    m = start_of.search(text)
    if m is None and (text.isascii() or unicodedata.is_normalized("NFKC", text)):
        return Plain(text, [], [], [])
    out: list[str] = []
    begin: list[int] = []
    came: list[int] = []
    went: list[int] = []
    size = 0

    def put(s: str, start: int, end: int) -> None:
        nonlocal size
        if s:
            out.append(s)
            begin.append(size)
            came.append(start)
            went.append(end)
            size += len(s)

    def copy(start: int, end: int) -> None:
        part = text[start:end]
        if part.isascii() or unicodedata.is_normalized("NFKC", part):
            put(part, start, end)
            return
        held = start
        for i, ch in enumerate(part, start):
            form = ch if ch.isascii() else unicodedata.normalize("NFKC", ch)
            if form != ch:
                put(text[held:i], held, i)
                put(form, i, i + 1)
                held = i + 1
        put(text[held:end], held, end)

    done = 0
    while m is not None:
        special = _SPECIAL.match(text, m.start())
        if special is None:
            m = start_of.search(text, m.end())
            continue
        start, end, what = m.start(), special.end(), special.group()
        if what[0] == "&":
            copy(done, start)
            put(unicodedata.normalize("NFKC", html.unescape(what)), start, end)
        elif what[0] == "<":
            copy(done, start)
            put(" ", start, end)
        elif what.isspace():
            copy(done, start)
            put("\n" if what.count("\n") > 1 else " ", start, end)
        elif what == "**" or unicodedata.category(what[0]) == "Cf":
            copy(done, start)
        else:  # marks belong to the character before them
            start = max(done, start - 1)
            copy(done, start)
            put(unicodedata.normalize("NFKC", text[start:end]), start, end)
        done = end
        m = start_of.search(text, end)
    copy(done, len(text))
    return Plain("".join(out), begin, came, went)
