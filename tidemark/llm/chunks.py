"""Cutting text into words whose tokens can be remembered.

Byte-level vocabularies are applied to matches of a pattern in which a word takes the one space
before it. A single space or line end between two other characters always starts a new match, so a
text without two neighbouring blanks can be cut there with ``str.split`` and each word looked up in
a dictionary; only texts with runs of blanks go through the pattern as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import regex

_TWO_BLANKS = re.compile(r"\s\s")


class Chunks:
    """Joined values of all matches of each text.

    ``values`` gives the values of a list of matches; it is asked once for each match that is not
    remembered. The dictionaries hold at most ``most`` words besides those of the batch at hand and
    start anew when they are full.
    """

    def __init__(
        self, pattern: str, values: Callable[[list[str]], Sequence], join: Callable[[list], object], most: int = 600_000
    ):
        self.matches = regex.compile(pattern).findall
        self.values = values
        self.join = join
        self.most = most
        self.known: dict[str, object] = {}  # by match
        self.bare: dict[str, object] = {}  # by word at the start of a line
        self.spaced: dict[str, object] = {}  # by word after a space

    def _learn(self, bare: set[str], spaced: set[str], matches: set[str]) -> None:
        if len(self.known) + len(self.bare) + len(self.spaced) > self.most:
            for kept in (self.known, self.bare, self.spaced):
                kept.clear()
        new_bare = {w: self.matches(w) for w in bare if w not in self.bare}
        new_spaced = {w: self.matches(" " + w) for w in spaced if w not in self.spaced}
        asked = matches.union(*new_bare.values(), *new_spaced.values())
        unknown = [m for m in asked if m not in self.known]
        self.known.update(zip(unknown, self.values(unknown)))
        known = self.known
        for kept, new in ((self.bare, new_bare), (self.spaced, new_spaced)):
            kept.update({w: self.join([known[m] for m in found]) for w, found in new.items()})

    def totals(self, texts: Sequence[str | None]) -> list:
        bare: set[str] = set()
        spaced: set[str] = set()
        matches: set[str] = {"\n"}
        cut = []
        for text in texts:
            if not text:
                cut.append((False, []))
            elif _TWO_BLANKS.search(text):
                found = self.matches(text)
                matches.update(found)
                cut.append((False, found))
            else:
                lines = [line.split(" ") for line in text.split("\n")]
                for words in lines:
                    bare.add(words[0])
                    spaced.update(words[1:])
                cut.append((True, lines))
        self._learn(bare, spaced, matches)
        known, first, later, end = self.known, self.bare, self.spaced, self.known["\n"]
        out = []
        for by_line, parts in cut:
            if not by_line:
                out.append(self.join([known[m] for m in parts]))
                continue
            values = []
            for number, words in enumerate(parts):
                if number:
                    values.append(end)
                values.append(first[words[0]])
                values.extend([later[w] for w in words[1:]])
            out.append(self.join(values))
        return out
