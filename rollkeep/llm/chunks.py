"""Encode whole texts piece by piece: cut where a byte-level vocabulary's pattern always cuts, encode each distinct piece once.

The pattern glues one space to the word after it. So a text may be cut before every space that has no
white space beside it, and the ids of the text are the ids of these chunks in turn.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

#: The characters with the Unicode property White_Space.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNSAFE = re.compile(f" [{WHITE_SPACE}]|[{WHITE_SPACE}] ")


def _safe(text: str) -> bool:
    """Whether no space stands beside other white space."""
    if "  " in text or " \n" in text or "\n " in text:
        return False
    return text.replace("\n", "").isprintable() or not _UNSAFE.search(text)  # printable: no white space but spaces


#: A space and a word; else white space up to the last one before a word; else that last one.
_RUNS = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")


def chunks(text: str) -> tuple[list[str], list[str]]:
    """Two lists that give the text one after the other: whole chunks, and chunks without the one space before each.

    The second has all but the first chunk where every space may be cut at; otherwise the first list has all.
    """
    if not _safe(text):
        return _RUNS.findall(text), []
    head, *rest = text.split(" ")
    return [head] if head else [], rest


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; remembers the ids of the first `keep` distinct chunks."""

    def __init__(self, encode: Callable[[Sequence[str]], Iterable[bytes]], keep: int = 300_000) -> None:
        self.encode_new, self.keep = encode, keep
        self.whole: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str | None], at_once: int = 2_000_000) -> Iterable[bytes]:
        """One bytes object for each text, in order; null counts as empty. Works on about at_once characters at a time."""
        group: list[tuple[list[str], list[str]]] = []
        held = 0
        for text in texts:
            group.append(chunks(text or ""))
            held += len(text or "")
            if held >= at_once:
                yield from self._group(group)
                group, held = [], 0
        yield from self._group(group)

    def _group(self, group: list[tuple[list[str], list[str]]]) -> Iterable[bytes]:
        heads = joined([a for a, _ in group], self.whole, self.encode_new, self.keep // 4)
        rests = joined([b for _, b in group], self.spaced, lambda new: self.encode_new([" " + x for x in new]), self.keep)
        for a, b in zip(heads, rests, strict=True):
            yield a + b


def joined(group: list[list], known: dict, make: Callable[[list], Iterable[bytes]], keep: int) -> Iterable[bytes]:
    """For each list of parts, the joined bytes of its parts; makes those that are not known yet, each once.

    known takes what was made until it holds `keep` parts: the frequent ones come early, and the others are rare.
    """
    found = [list(map(known.get, one)) for one in group]
    new = list({part for one, got in zip(group, found, strict=True) if None in got for part, x in zip(one, got, strict=True) if x is None})
    made = dict(zip(new, make(new), strict=True)) if new else {}
    for one, got in zip(group, found, strict=True):
        yield b"".join([made[part] if x is None else x for part, x in zip(one, got, strict=True)] if None in got else got)
    if len(known) < keep:
        known.update(made)
