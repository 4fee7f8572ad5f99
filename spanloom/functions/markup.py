"""XML reports as slots of text: every run of text and every attribute, with its place in the source, and the source again with other texts in them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.parsers import expat

#: What a source is made of; a source that expat has read has nothing else.
PIECE = re.compile(r"<!--.*?-->|<\?.*?\?>|<!\[CDATA\[(?P<cdata>.*?)\]\]>|</(?P<close>[^\s>]+)\s*>|<(?P<open>[^\s/>]+)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<empty>/?)>|(?P<text>[^<]+)", re.DOTALL)
ATTRIBUTE = re.compile(r"(?P<name>[^\s=]+)\s*=\s*(?:\"(?P<double>[^\"]*)\"|'(?P<single>[^']*)')")
#: The entities of XML itself; there are no others, as document type declarations are refused.
ENTITY = re.compile(r"&(?:#(?P<dec>[0-9]+)|#x(?P<hex>[0-9A-Fa-f]+)|(?P<name>lt|gt|amp|quot|apos));")
NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


@dataclass(frozen=True)
class Slot:
    """A text of the report: its elements (and ``@name`` for an attribute), which of their kin they are, and its place in the source."""

    path: tuple[str, ...]
    steps: tuple[str, ...]
    value: str
    start: int
    end: int
    cdata: bool = False


def readable(source: str) -> bool:
    """Whether it is well-formed, and without a document type, so without entities of its own."""
    if "<!DOCTYPE" in source:
        return False
    try:
        expat.ParserCreate().Parse(re.sub(r"^\s*<\?xml[^>]*\?>", "", source).encode(), True)
    except expat.ExpatError:
        return False
    return True


def unescape(text: str) -> str:
    return ENTITY.sub(lambda m: chr(int(m["dec"])) if m["dec"] else chr(int(m["hex"], 16)) if m["hex"] else NAMED[m["name"]], text)


def escape(text: str) -> str:
    for mark, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "apos")):
        text = text.replace(mark, f"&{name};")
    return text


def slots(source: str) -> Iterator[Slot]:
    """All texts of a well-formed source in order: attributes, runs of text (also beside elements), and one of no length in an element that is empty.

    The root's own name is no part of a path. Runs of blanks alone, beside elements,
    are layout and no texts.
    """
    stack: list[list] = []  # element, number of children so far, whether it held anything

    def place(*more: tuple[str, str]) -> tuple[tuple[str, ...], tuple[str, ...]]:
        inner = stack[1:]
        steps = [str(parent[1] - 1) for parent in stack[: len(inner)]]
        return (*[e[0] for e in inner], *[m[0] for m in more]), (*steps, *[m[1] for m in more])

    for m in PIECE.finditer(source):
        if m["open"] is not None:
            if stack:
                stack[-1][1] += 1
                stack[-1][2] = True
            stack.append([m["open"], 0, False])
            for a in ATTRIBUTE.finditer(m["attributes"]):
                which = "double" if a["double"] is not None else "single"
                start, end = (m.start("attributes") + x for x in a.span(which))
                path, steps = place((f"@{a['name']}", f"@{a['name']}"))
                yield Slot(path, steps, unescape(a[which]), start, end)
            if m["empty"]:
                path, steps = place()
                yield Slot(path, steps, "", m.end(), m.end(), True)
                stack.pop()
        elif m["close"] is not None:
            if not stack[-1][2]:
                path, steps = place()
                yield Slot(path, steps, "", m.start(), m.start())
            stack.pop()
        elif stack and (m["cdata"] is not None or m["text"] is not None):
            raw = m["cdata"] if m["cdata"] is not None else m["text"]
            closing = source.startswith("</", m.end())
            if raw.strip() or (closing and not stack[-1][2]):
                stack[-1][2] = True
                path, steps = place()
                yield Slot(path, steps, raw if m["cdata"] is not None else unescape(raw), m.start(), m.end(), m["cdata"] is not None)


def with_slots(source: str, values: Sequence[str | None]) -> str:
    """The source with new values in its slots, in order; what keeps its value keeps its bytes."""
    out, at = [], 0
    for slot, value in zip(slots(source), values, strict=True):
        if value is None or value == slot.value or (slot.start == slot.end and slot.cdata):
            continue
        out += [source[at : slot.start], escape(value)]
        at = slot.end
    return "".join([*out, source[at:]])
