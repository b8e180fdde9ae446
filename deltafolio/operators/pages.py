"""Parsers from lines with geometry to typed blocks, one for each family of layouts; run them by ``folding.fold``."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from itertools import islice

from .folding import Line, cells, in_paragraph, in_row, joined

# Layouts of the documents.
CODE = r"^[A-Z0-9]{1,6}$"
CONTINUED = r"^[A-Z0-9]{1,6}\s*\(continued\)$"


def paragraph(held: list[Line], kind: str = "paragraph") -> dict:
    return {"type": kind, "page": held[0].page, "text": joined(held)}


# ---- code tables --------------------------------------------------------------------------------------------------------


def visual_rows(lines: Iterator[Line]) -> Iterator[list[Line]]:
    """Rows of lines against the row's first line."""
    held: list[Line] = []
    for x in lines:
        if held and not in_row(held[:1], x):
            yield held
            held = []
        held.append(x)
    if held:
        yield held


def code_tables(
    lines: Iterator[Line], major: float = 20.0, margin: float = 15.0, anchor_gap: float = 150.0, wrap_gap: float = 4.0,
    glossary: str = r"Glossary$", term_gap: float = 8.0, look: int = 5, near: float = 3.0,
) -> Iterator[dict]:
    """Tables whose rows start with a code; headers, wrapped rows, paragraphs, and a glossary as a two-column table.

    A row is data if a cell near the anchor (the table's left edge) is a code. Other rows of a table are, in this order: its
    header if bold; the next row's beginning, where that one is data, nearer to it than the last row by ``wrap_gap`` and further from
    that than it; else more of the last row. A line left of the anchor's margin or a major heading ends the table, and so does a
    lone line that starts with a footnote marker, or a lone line at the anchor that no code is in, if a major heading comes
    within the ``look`` rows after it and before any data.
    """
    rows = visual_rows(lines)
    coming: deque[list[Line]] = deque(islice(rows, look + 1))
    row, ahead = coming.popleft() if coming else None, None
    anchor: float | None = None
    header: dict | None = None
    body: dict | None = None
    ends = 0.0  # bottom of the last row
    early: list[tuple[float, str]] = []  # cells that belong to the next row
    held: list[Line] = []  # open paragraph
    term: list[Line] = []
    in_glossary = headed = False

    def top(r: list[Line]) -> float:
        return min(x.y0 for x in r)

    def is_data(r: list[Line]) -> bool:
        found = [x for x, t in cells(r) if re.match(CODE, t) or re.match(CONTINUED, t, re.I)]
        left = anchor if anchor is not None else min(x.x0 for x in r)
        return bool(found) and min(found) - left < anchor_gap

    def is_note(r: list[Line]) -> bool:
        if len(r) != 1 or r[0].footnote:
            return len(r) == 1
        if abs(r[0].x0 - anchor) > near or re.match(CODE, r[0].text.strip()):
            return False
        for other in coming:
            if len(other) == 1 and other[0].bold and other[0].size >= major:
                return True
            if is_data(other):
                return False
        return False

    def place(into: dict, more: list[tuple[float, str]]) -> None:
        for x, t in more:
            k = min(range(len(into["at"])), key=lambda i: abs(into["at"][i] - x))
            into["cells"][k] = f"{into['cells'][k]}\n{t}".strip("\n")

    def done(*blocks: dict | None) -> Iterator[dict]:
        for b in blocks:
            if b:
                yield {k: v for k, v in b.items() if k != "at"}

    while row is not None:
        ahead = coming[0] if coming else None
        page, own = row[0].page, cells(row)
        heading = row[0].size >= major and row[0].bold
        if heading or in_glossary:
            yield from done(header, body)
            header = body = anchor = None
        if heading:
            if held:
                yield paragraph(held)
            held = []
            if term:
                yield paragraph(term)
                term = []
            in_glossary = in_glossary or row[0].size > major and bool(re.search(glossary, joined(row)))
            yield paragraph(row)
        elif in_glossary and row[0].bold:
            if term and not (term[-1].page == page and top(row) - term[-1].y1 < term_gap):
                yield paragraph(term)
                term = []
            if held:
                yield {"type": "table_row", "page": held[0].page, "cells": [held[0].text, joined(held[1:])]}
                held = []
            term = term + row
        elif in_glossary and (term or held):
            if term:
                if not headed:
                    yield {"type": "table_header", "page": page, "cells": ["Term", "Definition"]}
                    headed = True
                first = term[0]
                held = [Line(first.page, first.ord, first.x0, first.y0, first.x1, first.y1, joined(term), first.size), *row]
                term = []
            else:
                held = held + row
        elif is_data(row):
            if held:
                yield paragraph(held)
                held = []
            yield from done(header, body)
            header = None
            body = {"type": "table_row", "page": page, "at": [x for x, _ in own], "cells": [t for _, t in own]}
            if early:
                grown = body["cells"]
                body["cells"] = [""] * len(grown)
                place(body, early)
                body["cells"] = [f"{a}\n{b}".strip("\n") for a, b in zip(body["cells"], grown)]
                early = []
            anchor, ends = min(own)[0] if anchor is None else anchor, max(x.y1 for x in row)
        elif len(own) > 1 and all(x.bold for x in row):
            if held:
                yield paragraph(held)
                held = []
            yield from done(header, body)
            header, body, anchor, ends = {"type": "table_header", "page": page, "at": [x for x, _ in own], "cells": [t for _, t in own]}, None, min(own)[0], max(x.y1 for x in row)
        elif body and own[0][0] >= anchor - margin and body["page"] == page and not held and not is_note(row):
            before, after = top(row) - ends, top(ahead) - max(x.y1 for x in row) if ahead and ahead[0].page == page else None
            if after is not None and is_data(ahead) and after <= wrap_gap and after < before:
                early += own
            else:
                place(body, own)
                ends = max(x.y1 for x in row)
        else:
            yield from done(header, body)
            header = body = anchor = None
            if held and not in_paragraph(held, row[0]):
                yield paragraph(held)
                held = []
            held = held + row
        row = coming.popleft() if coming else None
        coming.extend(islice(rows, 1))
    yield from done(header, body)
    if in_glossary and held:
        yield {"type": "table_row", "page": held[0].page, "cells": [held[0].text, joined(held[1:])]}
    elif held:
        yield paragraph(held)
    if term:
        yield paragraph(term)


# ---- numbered sections --------------------------------------------------------------------------------------------------


def follows(new: tuple[int, ...], now: tuple[int, ...] | None) -> bool:
    """Whether a section number may come after the present one: the same, the next root, any direct child, or the next
    sibling of the section or of one of its ancestors below the root."""
    if now is None or new == now:
        return True
    if len(new) == 1:
        return new[0] == now[0] + 1
    if len(new) == len(now) + 1:
        return new[:-1] == now
    return len(new) <= len(now) and new[:-1] == now[: len(new) - 1] and new[-1] == now[len(new) - 1] + 1


def numbered_sections(lines: Iterator[Line], longest: int = 250) -> Iterator[dict]:
    """A block for each line: accepted headings, and other lines with the path of the open sections."""
    now: tuple[int, ...] | None = None
    stack: list[tuple[tuple[int, ...], str]] = []
    for x in lines:
        text = x.text.strip()
        found = re.match(r"^([0-9]{1,9}(?:\.[0-9]{1,9})*)\s+(.+)$", text)
        number = tuple(int(n) for n in found[1].split(".")) if found and len(found[2]) <= longest else None
        accepted = number is not None and follows(number, now)
        if accepted:
            now = number
            stack = [s for s in stack if len(s[0]) < len(number)] + [(number, found[2])]
        yield {
            "type": "section_heading" if accepted else "paragraph", "page": x.page, "level": len(now) if now else None, "text": text,
            "code": ".".join(map(str, now)) if now else None, "title": stack[-1][1] if stack else None, "items": [t for _, t in stack],
        }
