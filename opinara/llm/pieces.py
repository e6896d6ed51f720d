"""Cutting a text where byte-level BPE can never join, so that encoded pieces can be looked up instead of redone.

The splitting pattern of these vocabularies lets a single space only start a match, never end or cross one. A text may
therefore be cut before each single space that stands between two characters that are not white space; the codes of the
text are the codes of the cut pieces in order. Elsewhere (runs of spaces, a space beside a line end) no cut is made.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Fixed value: the splitting pattern for which texts may be cut so.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def split_safe(text: str) -> list[str]:
    """The pieces of a text in order. The first is as it stands; a later one that begins with a line end too; before any
    other belongs the space at which it was cut (``with_space``). '' gives one empty piece."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " " or text[-1:] == " " or _RARE_SPACE.search(text):
        return _SAFE.split(text)
    # a line end between two other characters is a match by itself, and what follows it has no space before it
    return text.replace("\n", " \n").split(" ")


def with_space(piece: str) -> str:
    return piece if piece[:1] == "\n" else " " + piece


class PieceCache(dict):
    """What ``encode`` makes of a later piece, remembered for short pieces up to a bounded number."""

    def __init__(self, encode: Callable[[list[str]], list], entries: int = 300_000, longest: int = 48, cut: Callable[[str], list[str]] = split_safe):
        super().__init__()
        self.encode, self.entries, self.longest, self.cut = encode, entries, longest, cut

    def __missing__(self, piece: str):
        made = self.encode([with_space(piece)])[0]
        if len(piece) <= self.longest:
            self[piece] = made
        return made

    def fill(self, texts: list[list[str]]) -> dict[str, object]:
        """Make all later pieces of split texts known in one call of ``encode``; returns those too long to be kept."""
        new: set[str] = set()
        for pieces in texts:
            new.update(pieces[1:])
        fresh, long = [p for p in new if p not in self], {}
        for piece, made in zip(fresh, self.encode([with_space(p) for p in fresh]), strict=True):
            (self if len(piece) <= self.longest else long)[piece] = made
        return long

    def encode_batch(self, texts: list[str], at_once: bool = False) -> list[list]:
        """For each text the made values of its pieces in order; ``at_once`` if ``encode`` is better called for many."""
        if len(self) > self.entries:
            self.clear()
        split = [self.cut(t) for t in texts]
        long = self.fill(split) if at_once else {}
        first = self.encode([p[0] for p in split])
        get = self.__getitem__ if not long else (lambda p: long[p] if p in long else self[p])
        return [[f, *map(get, p[1:])] for f, p in zip(first, split, strict=True)]
