"""Queries without SQL, held against plain Python over the same rows."""

import re
from collections import defaultdict
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from deltafolio.operators import tables
from deltafolio.plans import catalogue


def greedy(a, b, threshold, mode):
    a, b, out = sorted(a), sorted(b), []
    for x in list(a):
        y = next((y for y in b if y[1] == x[1]), None)
        if y:
            out.append((x[0], y[0], 1.0, "exact"))
            a.remove(x)
            b.remove(y)
    edges = [(SequenceMatcher(None, x[1], y[1]).ratio(), x[0], y[0]) for x in a for y in b]
    used = set()
    for r, x, y in sorted((e for e in edges if e[0] >= threshold), key=(lambda e: (e[1], -e[0], e[2])) if mode == "serial" else (lambda e: (-e[0], e[1], e[2]))):
        if ("a", x) not in used and ("b", y) not in used:
            used |= {("a", x), ("b", y)}
            out.append((x, y, round(r, 3), "fuzzy"))
    return out


@pytest.mark.parametrize("mode", ["serial", "global"])
def test_fuzzy_queries(spark, sf_dir, mode):
    a, b = catalogue.part_names(spark, sf_dir)
    sides = []
    for side in (a, b):
        scopes = defaultdict(list)
        for r in side.collect():
            scopes[r["brand"], r["kind"]].append((r["ord"], r["text"]))
        sides.append(scopes)
    wanted = sorted((*scope, *x) for scope in set(sides[0]) | set(sides[1]) for x in greedy(sides[0][scope], sides[1][scope], 0.85, mode))
    got = catalogue.queries()[f"fuzzy_{mode}"](spark, sf_dir).collect()
    assert sorted((r["brand"], r["kind"], r["a_ord"], r["b_ord"], r["ratio"], r["match_type"]) for r in got) == wanted and wanted


def clean(text):
    return re.sub("[ \t\n\r]+", " ", text or "").strip(" ")


def test_paragraph_align(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["text"] or ""))
    wanted = []
    for k, rows in turns.items():
        old = [clean(t) for _, t in sorted(rows)]
        new = [t + " revised" if (k + n) % 5 == 0 else t for n, t in enumerate(old) if (k + n) % 7]
        for tag, i, j, m, n in SequenceMatcher(None, old, new, autojunk=False).get_opcodes():
            if tag == "equal":
                wanted += [(k, "exact", i + x, i + x + 1, m + x, m + x + 1) for x in range(j - i)]
                continue
            status = {"delete": "removed", "insert": "added"}.get(tag)
            if not status:
                x, y = " ".join(old[i:j]), " ".join(new[m:n])
                status = "reflowed" if x == y else "fuzzy" if SequenceMatcher(None, x, y).ratio() >= 0.95 else "pool"
            wanted.append((k, status, i, j, m, n))
    got = catalogue.queries()["paragraph_align"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == sorted(wanted)


def test_disappeared_content(spark, sf_dir):
    wanted = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        old = r["text"] or ""
        new = " ".join(old.split(" ")[7:])
        a, b = old.split(), new.split()
        gone = [" ".join(a[i:j]) for tag, i, j, _, _ in SequenceMatcher(None, a, b).get_opcodes() if tag in ("delete", "replace") and j - i >= 5]
        wanted[r["conv_id"], r["turn"]] = (" ¶ ".join(gone), round(SequenceMatcher(None, old, new).ratio(), 3))
    got = catalogue.queries()["disappeared_content"](spark, sf_dir).collect()
    assert {(r["conv_id"], r["turn"]): (r["gone"], r["ratio"]) for r in got} == wanted


def pages_of(spark, sf_dir):
    return by_document(catalogue.laid_out(spark, sf_dir).collect())


def by_document(lines):
    docs = defaultdict(list)
    for r in lines:
        docs[r["doc_id"]].append(r)
    return {k: sorted(rows, key=lambda r: (r["page"], r["ord"])) for k, rows in docs.items()}


def test_narrative(spark, sf_dir):
    levels = {26.0: 1, 20.0: 2, 14.0: 3}
    wanted = []
    for k, rows in pages_of(spark, sf_dir).items():
        blocks, last = [], None
        for r in rows:
            level = levels.get(r["size"])
            if blocks and level and blocks[-1][0] == level and last["page"] == r["page"] and last["size"] == r["size"]:
                blocks[-1][2].append(r["text"].strip())
            elif blocks and not level and blocks[-1][0] is None and blocks[-1][1]["page"] == r["page"] and abs(r["x0"] - blocks[-1][1]["x0"]) <= 20 and r["y0"] - last["y1"] <= 10:
                blocks[-1][2].append(r["text"].strip())
            else:
                blocks.append((level, r, [r["text"].strip()]))
            last = r
        wanted += [(k, n, first["page"], level, " ".join(t).strip()) for n, (level, first, t) in enumerate(blocks)]
    got = catalogue.queries()["narrative"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["block"], r["page"], r["level"] or 0, r["text"]) for r in got) == sorted((a, b, c, d or 0, e) for a, b, c, d, e in wanted)


def test_index_blocks(spark, sf_dir):
    wanted = []
    for k, rows in pages_of(spark, sf_dir).items():
        blocks = []
        for r in rows:
            text = r["text"].strip()
            kind = "section_heading" if r["size"] == 12.0 and re.match(r"[0-9]{2}\s", text) else "table_row" if r["size"] == 10.5 else "paragraph"
            if blocks and kind == blocks[-1][0] != "section_heading" and blocks[-1][1][0]["page"] == r["page"]:
                own = blocks[-1][1]
                top, bottom = min(x["y0"] for x in own), max(x["y1"] for x in own)
                overlap = min(bottom, r["y1"]) - max(top, r["y0"])
                in_row = overlap > 0.5 * min(bottom - top, r["y1"] - r["y0"]) or r["y0"] - bottom <= 4
                if in_row if kind == "table_row" else abs(r["x0"] - own[0]["x0"]) <= 20 and r["y0"] - own[-1]["y1"] <= 10:
                    own.append(r)
                    continue
            blocks.append((kind, [r]))
        for n, (kind, own) in enumerate(blocks):
            cells = []
            for r in sorted(own, key=lambda r: r["x0"]):
                if not cells or abs(r["x0"] - cells[-1][0]) > 3:
                    cells.append((r["x0"], []))
                cells[-1][1].append(r["text"].strip())
            row = kind == "table_row"
            wanted.append((k, n, own[0]["page"], kind, "" if row else " ".join(r["text"].strip() for r in own).strip(), "|".join("\n".join(t) for _, t in cells) if row else ""))
    got = catalogue.queries()["index_blocks"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["block"], r["page"], r["type"], r["text"] or "", r["cells"] or "") for r in got) == sorted(wanted)


def test_numbered_sections(spark, sf_dir):
    wanted = []
    for k, rows in pages_of(spark, sf_dir).items():
        now = None
        for n, r in enumerate(rows):
            text = r["text"].strip()
            m = re.match(r"([0-9]{1,9}(?:\.[0-9]{1,9})*)\s+(.+)$", text)
            if m and len(m[2]) <= 250:
                new = [int(x) for x in m[1].split(".")]
                allowed = [None, new]
                if now is not None:
                    allowed = [now, [now[0] + 1], *([now[:d] + [now[d] + 1] for d in range(1, len(now))])]
                if now is None or new in allowed or (len(new) == len(now) + 1 and new[:-1] == now):
                    now = new
                    wanted.append((k, n, "section_heading", text, ".".join(map(str, now))))
                    continue
            wanted.append((k, n, "paragraph", text, ".".join(map(str, now)) if now else ""))
    got = catalogue.queries()["numbered_sections"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["block"], r["type"], r["text"], r["code"] or "") for r in got) == sorted(wanted)


def plain_tables(documents, rotated, final=False):
    """Page by page: tiers by their first line, zones by repeated names, rows by gaps of the anchor column; final ones are put together."""
    along, end, across, sign = ("x0", "x1", "y1", -1) if rotated else ("y0", "y1", "x0", 1)
    levels, gap = ({14.0: 1, 12.0: 2}, 6.8) if rotated else ({26.0: 1, 20.0: 2}, 3.0)
    wanted = []
    for k, rows in documents.items():
        for page in sorted({r["page"] for r in rows}):
            by = defaultdict(list)
            for r in rows:
                if r["page"] == page:
                    role = "heading" if r["size"] in levels else "header" if r["bold"] and r["size"] == 9.5 else "title" if r["bold"] and r["size"] == 10.5 else "data" if not r["bold"] and r["size"] == 9.0 else "rest"
                    by[role].append(r)
            wanted += [(k, page, "section_heading", levels[r["size"]], "", r["text"].strip(), "") for r in by["heading"]]
            tiers, spaced = [], set()
            for r in sorted(by["header"], key=lambda r: (r[along], r[across])):
                if not tiers or r[along] - tiers[-1][0] > 15:
                    tiers.append((r[along], []))
                tiers[-1][1].append(r)
            zones = []
            for at, own in tiers:
                cells = []
                for r in sorted(own, key=lambda r: r[across]):
                    if not cells or r[across] - cells[-1][-1][across] > 20:
                        cells.append([])
                    cells[-1].append(r)
                named = []
                for c in cells:
                    c = sorted(c, key=lambda r: (r[along], r["ord"]))
                    named.append((" ".join(r["text"].strip() for r in c).strip(), c[0][across]))
                    if c[0]["text"].startswith(" "):
                        spaced.add(named[-1][0])
                if not zones or {n for n, _ in named} & {n for _, t in zones[-1] for n, _ in t}:
                    zones.append([])
                zones[-1].append((at, named))
            found = []
            for z in zones:
                leaves = [c for _, t in z[1:] for c in t]
                columns = {}
                for n, x in leaves + [c for c in z[0][1] if all(abs(c[1] - x) > 65 for _, x in leaves)]:
                    columns.setdefault(n, x)
                found.append((z[0][0], columns))
            for z, (start, columns) in enumerate(found):
                last = len(found) - 1
                zone = lambda r: max((n for n in range(len(found)) if found[n][0] <= r[along]), default=0)  # noqa: E731, B023
                head = lambda r: min((n for n in range(len(found)) if found[n][0] >= r[along]), default=last)  # noqa: E731, B023
                title = " ".join(r["text"].strip() for r in sorted(by["title"], key=lambda r: (r[along], r["ord"])) if head(r) == z).strip()
                anchor = min(columns, key=lambda n: sign * columns[n])
                built, before = [defaultdict(list)], None
                near = lambda r: min(columns, key=lambda n: abs(columns[n] - r[across]))  # noqa: E731, B023
                data = []
                for r in by["data"]:
                    parts = r["segments"] or [] if final else []
                    split = len({near(p) for p in parts}) > 1
                    data += [(r, p, j) for j, p in enumerate(parts)] if split else [(r, r, 0)]
                for _, r, _ in sorted((x for x in data if zone(x[0]) == z), key=lambda x: (x[1][along], sign * x[1][across], x[0]["ord"], x[2])):
                    name = near(r)
                    if name == anchor:
                        if before is None or r[along] - before > gap:
                            built.append(defaultdict(list))
                        before = r[end]
                    built[-1][name if len(built) > 1 else "__unassigned_prefix__"].append(r["text"].strip())
                whole = [{c: " ".join(row.get(c, [])).strip() for c in (columns if n else row)} for n, row in enumerate(built)]
                if final:
                    whole[1:] = put_together(whole[1:], sorted(columns, key=lambda n: sign * columns[n]), spaced, anchor)
                for cells in whole:
                    if cells:
                        wanted.append((k, page, "grid_row", z + 1, title, "", "|".join(f"{c}={t}" for c, t in sorted(cells.items()))))
            rest = sorted(by["rest"] + ([] if found else by["data"] + by["title"]), key=lambda r: (r[along], sign * r[across], r["ord"]))
            for own in [[r] for r in rest] if rotated else [rest] if rest else []:
                wanted.append((k, page, "paragraph", 0, "", " ".join(r["text"].strip() for r in own).strip(), ""))
    return sorted(wanted)


def put_together(rows, order, spaced, anchor):
    """Plain rows of a table: headers that no row fills go to the filled one before them, then orphans to the row before them."""
    if len(rows) > 1:
        ever = [any(r[c] for r in rows) for c in order]
        name, gone = {c: c for c in order}, set()
        for j in range(1, len(order)):
            if any(ever) and not ever[j] and ever[j - 1]:
                name[order[j - 1]] = order[j - 1] + (" " if order[j] in spaced else "") + order[j]
                gone.add(order[j])
        rows = [{name[c]: r[c] for c in order if c not in gone} for r in rows]
    out = []
    for r in rows:
        if out and re.match(r"[–‒-]\s", r.get(anchor, "")) and not any(v for c, v in r.items() if c != anchor):
            out[-1][anchor] = (out[-1][anchor] + " " + r[anchor]).strip()
        else:
            out.append(r)
    return out


def listed(blocks):
    """Blocks with flat columns, as ``plain_tables`` lists them."""
    return sorted((r["doc_id"], r["page"], r["type"], r["level"] or 0, r["title"] or "", r["text"] or "", r["columns"] or "") for r in blocks)


@pytest.mark.parametrize("rotated", [False, True])
def test_page_tables(spark, sf_dir, rotated):
    wanted = plain_tables(pages_of(spark, sf_dir), rotated)
    assert listed(catalogue.queries()["rotated_tables" if rotated else "page_tables"](spark, sf_dir).collect()) == wanted
    assert any(w[2] == "grid_row" for w in wanted) or not rotated


@pytest.mark.parametrize("rotated", [False, True])
def test_final_tables(spark, sf_dir, rotated):
    """Lines of given pages, once as they stand and once turned, so that rows run to the right and columns from the bottom edge up."""
    lines = catalogue.order_pages(spark, sf_dir)
    if rotated:
        box = lambda c: [c("y0").alias("x0"), (-c("x1")).alias("y0"), c("y1").alias("x1"), (-c("x0")).alias("y1"), c("text").alias("text")]
        parts = F.transform("segments", lambda s: F.struct(*box(lambda n: s[n])))
        lines = lines.select("doc_id", "page", "ord", *box(F.col), "size", "bold", "fonts", parts.alias("segments"))
    sizes = {"headings": ((26.0, 1), (20.0, 2)) if not rotated else ((14.0, 1), (12.0, 2))}
    blocks = tables.final_tables(lines, ["doc_id"], rotated, **sizes)
    flat = F.array_join(F.transform(F.array_sort(F.map_entries("columns")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    wanted = plain_tables(by_document(lines.collect()), rotated, final=True)
    assert listed(blocks.withColumn("columns", flat).collect()) == wanted
    columns = [w[-1] for w in wanted]
    assert any("Sta tus=" in c for c in columns) and any("|tus=late" in c for c in columns) and any(" – see note" in c for c in columns) and any(c.startswith("__") for c in columns)
    assert tables.final_tables(lines.limit(0), ["doc_id"], rotated).collect() == []


def test_section_moves(spark, sf_dir):
    from test_matching_index import plain_moves

    sides = []
    for side in catalogue.turn_sections(spark, sf_dir):
        sections = defaultdict(list)
        for r in sorted(side.collect(), key=lambda r: (r["scope"], r["section"], r["ord"])):
            sections[r["scope"], r["section"]].append(r["text"])
        sides.append(dict(sections))
    got = catalogue.queries()["section_moves"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == plain_moves(*sides) and got
