"""Cutting text where a byte-level BPE pre-tokenizer always cuts, without running its pattern."""

from __future__ import annotations

import re
from collections.abc import Callable
from string import punctuation

import regex

_ODD = re.compile(r" \s| \Z")
#: Characters whose class no version of Unicode changes, so that every library splits them alike.
plain = re.compile(r"[\n -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*\Z").match
_CUT = re.compile(r" (?=\S)")

#: Fixed value: the usual pattern, whose matches in plain words need no search.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def units(text: str) -> list:
    """Pieces of ``text`` that are encoded alone with the same result as in the whole.

    The usual pattern (``' ?\\p{L}+'`` and so on, and white space that leaves its
    last character to the word after it) never matches across the place before a
    space that a non-space follows.  So these places are safe cuts; a piece holds
    a few matches, mostly one.  The first piece is a 1-tuple (text as it stands),
    any other a str that stands for a space and itself.
    """
    if not text:
        return []
    parts: list = _CUT.split(text) if _ODD.search(text) else text.split(" ")
    if parts[0]:
        parts[0] = (parts[0],)
    else:
        del parts[0]  # the text begins with a space that belongs to the next piece
    return parts


def unit_text(unit) -> str:
    return unit[0] if isinstance(unit, tuple) else " " + unit


def splitter(pattern: str) -> Callable[[object], list[str]]:
    """A function from a piece to the pattern's matches in it; a piece with characters that versions of Unicode class differently stays whole."""
    findall, usual = regex.compile(pattern).findall, pattern == USUAL

    def split(unit) -> list[str]:
        text = unit_text(unit)
        if usual and isinstance(unit, str) and unit.isascii():
            core = unit.rstrip(punctuation)
            if core.isalpha():  # a word, and what follows it
                return [text] if len(core) == len(unit) else [" " + core, unit[len(core) :]]
        if not plain(text):
            return [text]
        found = findall(text)
        return found if sum(map(len, found)) == len(text) else [text]

    return split
