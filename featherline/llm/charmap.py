"""Normalisation of texts by a compiled character map, keeping where every normalised character comes from.

A compiled map is a double-array trie over the UTF-8 bytes of what is replaced, and the replacements as strings
that end with a zero byte. At each place of a text the longest prefix that the trie has is replaced; where it has none,
one character stays. Blanks are then treated as the model says: a blank in front, runs of blanks made one, blanks
written as U+2581.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

#: How a model writes a blank.
BLANK = "▁"


class CharacterMap:
    """Longest-prefix replacement by a compiled map; an empty one replaces nothing."""

    def __init__(self, compiled: bytes):
        self.units, self.replacements = np.zeros(0, np.uint32), b""
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4)
            self.replacements = compiled[4 + size:]
        self.array = self.units.tolist()
        self.starts = lru_cache(1 << 16)(self._starts)

    def _walk(self, data: bytes) -> tuple[int, int | None, bool]:
        """(bytes of the longest entry that ``data`` begins with, its value, whether all of ``data`` leads on in the trie)."""

        def child(unit: int) -> int:
            return (unit >> 10) << ((unit & 0x200) >> 6)

        length, value = 0, None
        node = child(self.array[0])
        for at, byte in enumerate(data, 1):
            node ^= byte
            if node >= len(self.array):
                return length, value, False
            unit = self.array[node]
            if unit & 0x800000FF != byte:
                return length, value, False
            node ^= child(unit)
            if unit & 0x100:
                length, value = at, self.array[node] & 0x7FFFFFFF
        return length, value, True

    def _starts(self, character: str) -> bool:
        """Whether some entry begins with this character."""
        length, _, on = self._walk(character.encode())
        return on or length > 0

    def longest(self, text: str, at: int) -> tuple[int, str] | None:
        """(characters replaced, what replaces them) at this place, or None if nothing is."""
        if not self.array or not self.starts(text[at]):
            return None
        # The trie is no deeper than its entries are long, so the walk ends by itself; the window grows while it goes on.
        width = 16
        while True:
            data = text[at:at + width].encode()
            length, value, on = self._walk(data)
            if not on or at + width >= len(text):
                break
            width *= 4
        if not length:
            return None
        end = self.replacements.index(b"\0", value)
        return len(data[:length].decode(errors="ignore")), self.replacements[value:end].decode()


class Normalizer:
    """A model's normaliser. ``literal`` strings (a compiled pattern) pass as they are."""

    def __init__(self, charmap: CharacterMap, add_prefix: bool, collapse: bool, escape: bool, suffix: bool, literal=None):
        self.charmap, self.literal = charmap, literal
        self.add_prefix, self.collapse, self.escape, self.suffix = add_prefix, collapse, escape, suffix

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and for its end, the source character it comes from."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.charmap.array and not self.collapse and self.literal is None:
            body = text.replace(" ", BLANK) if self.escape else text
            source = np.arange(len(text) + 1)
            blank = BLANK if self.escape else " "
            if not self.add_prefix:
                return body, source
            if self.suffix:
                return body + blank, np.append(source, len(text))
            return blank + body, np.append(0, source)
        return self._general(text)

    def _replaced(self, text: str, at: int) -> tuple[int, str]:
        if self.literal is not None and (found := self.literal.match(text, at)):
            return found.end() - at, found.group()
        return self.charmap.longest(text, at) or (1, text[at])

    def _general(self, text: str) -> tuple[str, np.ndarray]:
        blank = BLANK if self.escape else " "
        out: list[str] = []
        source: list[int] = []
        at = 0
        while self.collapse and at < len(text):
            step, new = self._replaced(text, at)
            if new != " ":
                break
            at += step
        if at == len(text):
            return "", np.zeros(1, np.int64)

        def add(new: str) -> None:
            out.extend(new)
            source.extend([at] * len(new))

        if self.add_prefix and not self.suffix:
            add(blank)
        after_blank = self.collapse
        while at < len(text):
            step, new = self._replaced(text, at)
            if after_blank:
                new = new.lstrip(" ")
            if new:
                after_blank = self.collapse and new.endswith(" ")
                add(new.replace(" ", blank))
            at += step
        while self.collapse and out and out[-1] == blank:
            out.pop()
            at = source.pop()
        if self.add_prefix and self.suffix:
            add(blank)
        return "".join(out), np.array([*source, at], np.int64)
