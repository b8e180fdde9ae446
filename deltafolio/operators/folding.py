"""Stateful parsers over ordered lines, as streams.

A parser is a generator from lines to blocks that keeps only the blocks under construction. Lines are partitioned by scope and
sorted, so an edition of any length passes through one task without being held there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = """page int, type string, level int, code string, title string, label string, text string, cells array<string>, items array<string>,
    card struct<name:string,positions:string,length:string,format:string,description:string,note:string,values:string,mapping:string>,
    anchor_column string, columns map<string,string>"""
_NAMES = ("page", "type", "level", "code", "title", "label", "text", "cells", "items", "card", "anchor_column", "columns")


@dataclass(slots=True)
class Line:
    page: int
    ord: int
    x0: float
    y0: float
    x1: float
    y1: float
    text: str
    size: float
    bold: bool = False
    fonts: tuple = ()
    footnote: bool = False


Parser = Callable[[Iterator[Line]], Iterator[dict]]


def fold(lines: DataFrame, scope: list[str], parser: Parser, order: list[str] | None = None, rows: int = 512) -> DataFrame:
    """scope, block (0, 1, …) and the columns of a block; ``lines`` has the scope and the fields of Line.

    Null texts are empty, null positions and sizes 0; ``footnote`` (the line starts with a footnote marker) may be missing; a scope
    without blocks has no rows.
    """
    order = order or ["page", "ord"]
    fields = list(Line.__dataclass_fields__)
    if "footnote" not in lines.columns:
        lines = lines.withColumn("footnote", F.lit(False))
    spread = lines.select(*scope, *fields).repartition(*scope).sortWithinPartitions(*scope, *order)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = ", ".join(f"{c} {lines.schema[c].dataType.simpleString()}" for c in scope)
    schema = to_arrow_schema(StructType.fromDDL(f"{kinds}, block long, {BLOCK}"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def stream() -> Iterator[tuple]:
            for batch in batches:
                for k in range(0, batch.num_rows, 1024):
                    for r in batch.slice(k, 1024).to_pylist():
                        at = (r[c] or 0.0 for c in ("x0", "y0", "x1", "y1"))
                        yield tuple(r[c] for c in scope), Line(r["page"] or 0, r["ord"] or 0, *at, r["text"] or "", r["size"] or 0.0, bool(r["bold"]), tuple(r["fonts"] or ()), bool(r["footnote"]))

        def blocks() -> Iterator[dict]:
            for key, group in groupby(stream(), key=lambda x: x[0]):
                for k, block in enumerate(parser(line for _, line in group)):
                    yield dict(zip(scope, key), block=k, **{c: block.get(c) for c in _NAMES})

        held: list[dict] = []
        for block in blocks():
            held.append(block)
            if len(held) == rows:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return spread.mapInArrow(run, f"{kinds}, block long, {BLOCK}")


def in_row(held: list[Line], line: Line) -> bool:
    """Same page, and over half of the smaller height shared with the lines so far."""
    if held[0].page != line.page:
        return False
    top, bottom = min(x.y0 for x in held), max(x.y1 for x in held)
    return min(bottom, line.y1) - max(top, line.y0) > 0.5 * min(bottom - top, line.y1 - line.y0)


def in_paragraph(held: list[Line], line: Line, shift: float = 20.0, gap: float = 10.0) -> bool:
    """Same page, near the first line's left edge, close below the last line."""
    return held[0].page == line.page and abs(line.x0 - held[0].x0) <= shift and line.y0 - held[-1].y1 <= gap


def cells(held: list[Line], tolerance: float = 3.0) -> list[tuple[float, str]]:
    """(x0, text) of a visual row's cells from the left; lines that start within the tolerance share a cell."""
    out: list[tuple[float, list[str]]] = []
    for line in sorted(held, key=lambda x: x.x0):
        if out and abs(line.x0 - out[-1][0]) <= tolerance:
            out[-1][1].append(line.text.strip())
        else:
            out.append((line.x0, [line.text.strip()]))
    return [(x, "\n".join(t)) for x, t in out]


def joined(held: list[Line]) -> str:
    return " ".join(x.text.strip() for x in held).strip()


def clusters(values: list[float], tolerance: float) -> list[list[float]]:
    """Single-linkage clusters of sorted values."""
    ordered = sorted(values)
    cuts = [0, *(k for k in range(1, len(ordered)) if ordered[k] - ordered[k - 1] > tolerance), len(ordered)]
    return [ordered[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
