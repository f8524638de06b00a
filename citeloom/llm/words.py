"""Words of a text as they are compared: without case, punctuation, layout, invisible characters and Unicode forms."""

from __future__ import annotations

import re
import unicodedata

import regex

_ASCII = re.compile(r"[a-z0-9]+")
_ANY = regex.compile(r"[\p{L}\p{N}\p{M}]+")
_HIDDEN = regex.compile(r"\p{Cf}+")


def words(text: str | None) -> list[str]:
    """Words of text in order; none for NULL. Invisible characters inside a word don't split it."""
    if not text:
        return []
    if text.isascii():
        return _ASCII.findall(text.lower())
    plain = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", _HIDDEN.sub("", text)).casefold())
    return _ANY.findall(plain)
