"""XML text in blocks: what each block says by itself, how blocks join, and where elements begin and end.

A file is cut into blocks that begin after some `>`. A block may then begin in text, in a comment, in CDATA, in a processing
instruction or within a quoted attribute value. Each block gives a summary for every state that it could begin in: the
state at its end, the closing tags that nothing in it opened, and the opening tags that nothing in it closed. Summaries
join from left to right without a look at the text, so a file of any size is checked in parallel. What a block begins with
is then known, and a second walk cuts elements out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

TEXT, COMMENT, CDATA, PI, DOUBLE, SINGLE = "text", "comment", "cdata", "pi", "double", "single"
ENDS = {COMMENT: b"-->", CDATA: b"]]>", PI: b"?>"}
BEGINS = {b"<!--": COMMENT, b"<![CDATA[": CDATA, b"<?": PI}
#: How a tag may look that began in the block before; its name is not known here.
QUOTED = {DOUBLE: b'<\x00 a="', SINGLE: b"<\x00 a='"}
UNKNOWN = b"\x00"

_PART = rb"(?![-.0-9])[^\s<>/=\"'!?&:]+"
_NAME = _PART + rb"(?::" + _PART + rb")?"
_ATTRIBUTES = rb"(?:\s+" + _NAME + rb"\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*"
#: (name of a closing tag, name of an opening one, / if that is empty).
TAG = re.compile(rb"<(?:/(" + _NAME + rb")\s*|(" + _NAME + rb")" + _ATTRIBUTES + rb"\s*(/?))>")
SPECIAL = re.compile(rb"<!--|<!\[CDATA\[|<\?|<!")
DOCTYPE = re.compile(rb"<!DOCTYPE\s+" + _NAME + rb"(?:\s[^<>\[\]]*)?>")
#: A processing instruction; one for xml itself must be a declaration.
INSTRUCTION = re.compile(rb"<\?(?:xml\s+version\s*=\s*[\"']1\.[0-9]+[\"'](?:\s+encoding\s*=\s*[\"'][A-Za-z][\w.-]*[\"'])?(?:\s+standalone\s*=\s*[\"'](?:yes|no)[\"'])?\s*\?>|(?![xX][mM][lL][\s?])" + _NAME + rb"(?:\s|\?>))")
ENTITY = re.compile(rb"&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);")
#: A tag that ends within a quoted value: its name, and the quote.
UNFINISHED = re.compile(rb"<(" + _NAME + rb")" + _ATTRIBUTES + rb"\s+" + _NAME + rb"\s*=\s*(?:(\")[^\"<]*|(')[^'<]*)$")


def local(name: bytes) -> bytes:
    """A name without its namespace prefix."""
    return name.rpartition(b":")[2]


def lexed(text: bytes, state: str) -> tuple[list[tuple[bytes, bytes, bytes]], str, bytes, bool, bool, bool]:
    """The tags of a stretch of text, the state at its end, an unfinished tag there, whether all is
    well-formed, and whether what stands before the first tag and after the last is blank."""
    tags: list[tuple[bytes, bytes, bytes]] = []
    fine = lead = trail = True
    at = 0
    while True:
        if state != TEXT:
            end = text.find(ENDS[state], at)
            if state == COMMENT:
                fine = fine and text.find(b"--", at, end if end >= 0 else len(text)) < 0
            if end < 0:
                return tags, state, b"", fine, lead, trail
            at, state = end + len(ENDS[state]), TEXT
        special = SPECIAL.search(text, at)
        region = text[at : special.start() if special else len(text)]
        found = TAG.findall(region)
        rest = b""
        last = region.rfind(b"<")
        whole = TAG.match(region, last) if last >= 0 else None
        if last >= 0 and not whole and not special:
            region, rest = region[:last], region[last:]
            last = region.rfind(b"<")
            whole = TAG.match(region, last) if last >= 0 else None
        fine = fine and len(found) == region.count(b"<")
        for x in (region, rest):
            if b"&" in x:
                fine = fine and x.count(b"&") == len(ENTITY.findall(x))
        if b"]]>" in region:
            fine = fine and b"]]>" not in TAG.sub(b"", region)
        if not tags:
            lead = lead and not (region[: region.find(b"<")] if found else region).strip()
        trail = not region[whole.end() :].strip() if whole else trail and not region.strip()
        tags += found
        if not special:
            return tags, TEXT, rest, fine, lead, trail
        at = special.end()
        if special[0] == b"<!":
            kind = DOCTYPE.match(text, special.start())
            fine, at = fine and kind is not None, kind.end() if kind else at
        else:
            state = BEGINS[special[0]]
            fine = fine and (state != PI or INSTRUCTION.match(text, special.start()) is not None)
            if state == CDATA:
                lead, trail = lead and bool(tags), False


class Summary:
    """What a block says if it begins in a given state."""

    def __init__(self, state: str) -> None:
        self.state, self.rest = (state, b"") if state in ENDS else (TEXT, QUOTED.get(state, b""))
        self.closes: list[bytes] = []
        self.opens: list[bytes] = []
        self.tops = self.wanted = 0  # elements that begin at the lowest depth, and wanted ones
        self.lead = self.trail = True
        self.tagged = False
        self.first: bytes | None = None  # what closed the tag that began in the block before

    def add(self, tags: list[tuple[bytes, bytes, bytes]], state: str, rest: bytes, lead: bool, trail: bool, wanted: bytes) -> bool:
        """Take the tags of the next stretch; False if they do not nest."""
        opens = self.opens
        for close, name, empty in tags:
            if close:
                if opens:
                    mine = opens.pop()
                    if mine != close:
                        if mine != UNKNOWN:
                            return False
                        self.first = close
                else:
                    self.closes.append(close)
                    self.tops = 0
            else:
                if not opens:
                    self.tops += 1
                if not empty:
                    opens.append(name)
                if name.endswith(wanted) and local(name) == wanted:
                    self.wanted += 1
        self.lead = self.lead and (self.tagged or lead)
        self.trail = trail if tags else self.trail and trail
        self.tagged = self.tagged or bool(tags)
        self.state, self.rest = state, rest
        return True


def summed_up(stretches: Iterator[bytes], wanted: bytes) -> str:
    """The summaries of some text by the state that it begins in, as JSON; states in which it cannot begin are left out.

    stretches: the text in parts that end after a `>`. A part is looked through once for all states that agree on where
    it begins. Text that is not UTF-8 has no summaries.
    """
    alive = {s: Summary(s) for s in (TEXT, COMMENT, CDATA, PI, DOUBLE, SINGLE)}
    size, sound = 0, True
    for text in stretches:
        size += len(text)
        try:
            text.decode()
        except UnicodeDecodeError:
            sound = False
        seen: dict[tuple[str, bytes], tuple] = {}
        for name, s in list(alive.items()):
            key = (s.state, s.rest)
            if key not in seen:
                seen[key] = lexed(s.rest + text, s.state)
            tags, state, rest, fine, lead, trail = seen[key]
            if not fine or not s.add(tags, state, rest, lead, trail, wanted):
                del alive[name]
    plain = lambda names: [n.decode("latin-1") for n in names]
    found = {n: [s.state, s.rest.decode("latin-1"), plain(s.closes), plain(s.opens), s.tops, s.wanted, s.lead, s.trail, s.first and s.first.decode("latin-1")] for n, s in alive.items()}
    return json.dumps({"size": size, "by": found if sound else {}})


def joined(blocks: list[tuple[int, str, bytes]], length: int, wanted: str, elements: set[str]) -> tuple[list[dict], bool, int]:
    """What each block of a file begins with, whether the file is well-formed, and how many wanted elements it opens.

    blocks: (place, summaries, the block's last piece, which they leave out) in order; length: the file's bytes. A block
    begins with a state, an unfinished tag, a byte offset, and perhaps within one of the elements: its name, the block
    where that began, and its depth among elements of its own name. The last piece of a file may lack its `>`; then it
    must be blank. Where a block cannot follow, the file is not well-formed, and nothing is told of later blocks.
    """
    starts: list[dict] = []
    stack: list[tuple[str, int]] = []
    state, rest, offset, roots, count, sound = TEXT, "", 0, 0, 0, True
    for k, (place, told, tail) in enumerate(blocks):
        inside = next((i for i, (n, _) in enumerate(stack) if n.rpartition(":")[2] in elements), None)
        target = None if inside is None else [*stack[inside], sum(n == stack[inside][0] for n, _ in stack[inside:])]
        starts.append({"place": place, "state": state, "rest": rest, "offset": offset, "target": target})
        for part in (told, None):
            if part is None:
                if k + 1 == len(blocks) and offset + len(tail) in (length, length - 3):  # less three for a byte order mark
                    sound = sound and not tail.strip()
                    offset += len(tail)
                    break
                part = summed_up(iter([tail + b">"]), wanted.encode())
            said = json.loads(part)
            offset += said["size"]
            open_tag = UNFINISHED.search(rest.encode("latin-1")) if rest else None
            name = open_tag[1].decode("latin-1") if open_tag else ""
            begun = (DOUBLE if open_tag[2] else SINGLE) if open_tag else state
            found = said["by"].get(begun)
            if found is None or (rest and not open_tag):
                return starts, False, count
            state, left, closes, opens, tops, n, lead, trail, first = found
            if first not in (None, name):
                return starts, False, count
            sound = sound and (bool(stack) or lead)
            for close in closes:
                if not stack or stack.pop()[0] != close:
                    return starts, False, count
            roots += 0 if stack else tops
            stack += [(name if o == "\0" else o, place) for o in opens]
            sound = sound and (bool(stack) or trail)
            still = left.startswith("<\0")  # the tag goes on
            count += n + (open_tag is not None and not still and name.rpartition(":")[2] == wanted)
            rest = rest + left[len(QUOTED[begun]) :] if still else left
    whole = offset in (length, length - 3)
    return starts, sound and whole and state == TEXT and not rest and not stack and roots == 1, count


def marks(elements: list[str]) -> re.Pattern[bytes]:
    """A pattern of tags of the elements, with any prefix, and of what may hide tags: (/ of a closing tag, name, / of an empty one)."""
    names = b"|".join(sorted((e.encode() for e in elements), key=len, reverse=True))
    return re.compile(rb"<!--|<!\[CDATA\[|<\?|<(/?)((?:[^\s<>/=\"'!?&:]+:)?(?:" + names + rb"))(?=[\s/>])" + _ATTRIBUTES + rb"\s*(/?)>")


def cut(stretches: Iterator[bytes], start: dict, pattern: re.Pattern[bytes]) -> Iterator[tuple[int, str, int | None, bytes]]:
    """(byte offset, local name, block where it began or None, text) of the outermost elements of a block.

    A block where it began is given for the parts of elements that do not begin and end in this block. What stands in
    comments, CDATA and attribute values is no tag.
    """
    state, rest = start["state"], start["rest"].encode("latin-1")
    base = start["offset"] - len(rest)  # the byte offset of what is worked on
    name, origin, depth = b"", None, 0
    if start["target"]:
        name, origin, depth = start["target"][0].encode("latin-1"), start["target"][1], start["target"][2]
    began, parts = base, []
    for text in stretches:
        text, rest = rest + text, b""
        at = kept = 0  # kept: where the present element's text begins here
        while True:
            if state != TEXT:
                end = text.find(ENDS[state], at)
                if end < 0:
                    break
                at, state = end + len(ENDS[state]), TEXT
            found = pattern.search(text, at)
            if not found:
                last = text.rfind(b"<", at)
                if last >= 0 and not TAG.match(text, last):
                    text, rest = text[:last], text[last:]
                break
            at = found.end()
            closing, tag, empty = found.groups()
            if tag is None:
                state = BEGINS[found[0]]
            elif not name and not closing:
                began, kept = base + found.start(), found.start()
                if empty:
                    yield began, local(tag).decode("latin-1"), None, text[kept:at]
                else:
                    name, depth = tag, 1
            elif tag == name and not empty:
                depth += -1 if closing else 1
                if not depth:
                    yield began, local(name).decode("latin-1"), origin, b"".join([*parts, text[kept:at]])
                    name, origin, parts = b"", None, []
        if name:
            parts.append(text[kept:])
        base += len(text)
    if name:
        yield began, local(name).decode("latin-1"), start["place"] if origin is None else origin, b"".join(parts)
