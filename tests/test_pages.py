import re
from itertools import product

from pyspark.sql import functions as F

from deltafolio.operators import assembly, cards, flows, folding, pages, scan, tables
from deltafolio.operators.folding import Line


def L(text, y=0.0, x=60.0, size=9.0, bold=False, page=1, h=10.0, w=50.0, fonts=()):
    return Line(page, int(page * 1000 + y), x, y, x + w, y + h, text, size, bold, fonts)


def shapes(blocks, *names):
    return [tuple(b.get(n) for n in ("type", *names)) for b in blocks]


LINE = "doc int, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string, size double, bold boolean, fonts array<string>"


def blocks(spark, relation, lines, *names):
    """The relation's blocks of one document whose lines stand in this order, and that nothing changes if scopes are cut into ranges."""
    made = spark.createDataFrame([(1, x.page, k, *map(float, (x.x0, x.y0, x.x1, x.y1)), x.text, float(x.size), x.bold, list(x.fonts)) for k, x in enumerate(lines)], LINE).repartition(3)
    got = relation(made, ["doc"]).orderBy("block").collect()
    assert [r["block"] for r in got] == list(range(len(got)))
    return [tuple(r[n] for n in ("type", *names)) for r in got]


def test_index_rows_wrap_but_never_across_pages(spark):
    lines = [L("05 Sales", size=12.0), L("TCR 0", 20, 60, 10.5), L("Data of", 20, 160, 10.5), L("the sale", 32, 160, 10.5), L("TCR 1", 60, 60, 10.5), L("TCR 2", 30, 60, 10.5, page=2), L("a", 60, page=2), L("b", 75, page=2), L("c", 200, page=2)]
    assert blocks(spark, flows.index_blocks, lines, "text", "cells") == [
        ("section_heading", "05 Sales", None), ("table_row", None, ["TCR 0", "Data of\nthe sale"]), ("table_row", None, ["TCR 1"]), ("table_row", None, ["TCR 2"]), ("paragraph", "a b", None), ("paragraph", "c", None)]


def test_label_cards_and_glossary(spark):
    lines = [
        L("V0545", size=20.0), L("BAD DATE", 20, fonts=("Other-Bold",)), L("IN ITEM", 30, fonts=("CourierX",)), L("Description: The date is wrong. Action:", 40), L("Return it.", 50),
        L("Transaction Types:", 60), L("●", 70), L("Sales", 70), L("drafts", 80), L("●", 90), L("Credits", 90), L("Some Glossary", 100, size=26.0), L("Acquirer", 130, bold=True), L("bank", 143, bold=True), L("Takes", 160, x=200.0), L("●", 172, x=200.0), L("items.", 172, x=200.0)]
    assert blocks(spark, cards.label_cards, lines, "code", "title", "label", "text", "items") == [
        ("card_header", "V0545", "BAD DATE IN ITEM", None, None, None), ("field", None, None, "Description", "The date is wrong.", None), ("field", None, None, "Action", "Return it.", None),
        ("bullet_list", None, None, None, None, ["Sales drafts", "Credits"]), ("paragraph", None, None, None, "Some Glossary", None),
        ("card_header", "Acquirer bank", "Acquirer bank", None, None, None), ("field", None, None, "Description", "Takes items.", None)]
    lines = [
        L("lead"), L("123456-A", 20, size=26.0), L("title", 30), L("more", 40), L("l", 50), L("Action: do", 60), L("l", 70), L("V1", 80, size=20.0), L("Transaction Type: a", 90, fonts=("CourierX",)), L("Transaction Type: a b", 95), L("c", 96), L("l", 100), L("l", 110), L("d", 120),
        L("Big", 130, size=16.0), L("after", 140), L("My Glossary", 150, size=16.0), L("T1", 160, bold=True), L("T2", 190, bold=True), L("T3", 200, bold=True, x=150.0), L("Description: x", 210), L("T4", 10, bold=True, page=2), L("T5", 15, bold=True, page=2)]
    assert blocks(spark, cards.label_cards, lines, "code", "title", "label", "text", "items") == [
        ("paragraph", None, None, None, "lead", None), ("card_header", "123456-A", "title", None, None, None), ("paragraph", None, None, None, "more l", None), ("field", None, None, "Action", "do l", None),
        ("card_header", "V1", "Transaction Type: a", None, None, None), ("bullet_list", None, None, None, None, ["a b c", "d"]), ("paragraph", None, None, None, "Big after", None), ("paragraph", None, None, None, "My Glossary", None),
        ("glossary_term", None, None, None, "T1", None), ("card_header", "T2", "T2", None, None, None), ("field", None, None, "Description", "T3", None), ("field", None, None, "Description", "x", None), ("glossary_term", None, None, None, "T4 T5", None)]
    assert blocks(spark, cards.label_cards, [], "text") == []


def test_code_tables():
    lines = [
        L("Codes", 0, size=24.0, bold=True), L("Code", 40, bold=True), L("Meaning", 40, 200, bold=True), L("A1", 60), L("first", 60, 200), L("goes on", 72, 200), L("starts early", 96, 200), L("B2", 108), L("second", 108, 200),
        L("B2 (continued)", 10, page=2), L("third", 10, 200, page=2), L("Left note", 40, 20, page=2)]
    got = shapes(pages.code_tables(iter(lines)), "text", "cells")
    assert got == [
        ("paragraph", "Codes", None), ("table_header", None, ["Code", "Meaning"]), ("table_row", None, ["A1", "first\ngoes on"]), ("table_row", None, ["B2", "starts early\nsecond"]),
        ("table_row", None, ["B2 (continued)", "third"]), ("paragraph", "Left note", None)]


def test_notes_before_headings_and_footnotes_end_a_table():
    rows = [L("Code", 40, bold=True), L("Meaning", 40, 200, bold=True), L("A1", 60), L("first", 60, 200)]
    note = [L("A remark on all codes", 76), L("that goes on", 88)]
    assert shapes(pages.code_tables(iter(rows + note + [L("Next part", 110, size=24.0, bold=True)])), "text", "cells")[1:] == [
        ("table_row", None, ["A1", "first"]), ("paragraph", "A remark on all codes that goes on", None), ("paragraph", "Next part", None)]
    more = [L("B2", 100), L("second", 100, 200)]
    got = shapes(pages.code_tables(iter(rows + note + more + [L("Next part", 130, size=24.0, bold=True)])), "text", "cells")
    assert got[1] == ("table_row", None, ["A1\nA remark on all codes\nthat goes on", "first"]) and got[2] == ("table_row", None, ["B2", "second"])
    mark = L("1 See the list", 76)
    mark.footnote = True
    assert shapes(pages.code_tables(iter(rows + [mark])), "text", "cells")[1:] == [("table_row", None, ["A1", "first"]), ("paragraph", "1 See the list", None)]


def test_code_tables_glossary():
    lines = [L("A Glossary", 0, size=24.0, bold=True), L("ACH", 40, bold=True), L("Clearing", 60, 200), L("house.", 72, 200), L("Very long", 100, bold=True), L("term", 112, bold=True), L("Its sense.", 130, 200)]
    assert shapes(pages.code_tables(iter(lines)), "text", "cells") == [
        ("paragraph", "A Glossary", None), ("table_header", None, ["Term", "Definition"]), ("table_row", None, ["ACH", "Clearing house."]), ("table_row", None, ["Very long term", "Its sense."])]


def test_field_cards(spark):
    grid = [L(t, 40, 60 + 60 * k, 9.5) for k, t in enumerate(cards.GRID_WORDS)]
    lines = [
        L("TC 05", 0, size=26.0), L("Sales", 20, size=26.0), *grid, L("1–2", 60, 60), L("2", 60, 180), L("Code", 72, 300), L("3", 90, 60), L("1", 10, 60, page=2), L("Format: AN = letters", 30, page=2),
        L("Card Number", 100, 60, page=2, size=10.0), L("Description early", 100, 200, page=2, size=10.0), L("Positions: 5–20", 115, 60, page=2, size=10.0), L("Length: 16", 130, 60, page=2, size=10.0), L("more", 130, 200, page=2, size=10.0), L("Values: any", 145, 200, page=2, size=10.0)]
    got = blocks(spark, cards.field_cards, lines, "text", "cells", "card")
    assert [x[:3] for x in got[:-1]] == [
        ("section_heading", "TC 05 Sales", None), ("table_header", None, list(cards.GRID_HEADER)), ("table_row", None, ["1–2", "2", "Code"]), ("table_row", None, ["3"]), ("table_row", None, ["1"]), ("paragraph", "Format: AN = letters", None)]
    card = got[-1][3]
    assert (card["name"], card["positions"], card["length"], card["description"], card["values"]) == ("Card Number", "5–20", "16", "early more", "any")


def test_field_cards_without_names_and_with_loose_text(spark):
    c = lambda text, y, x=60.0, page=1: L(text, y, x, size=10.0, page=page)
    lines = [
        c("Intro", 0), c("goes on", 12), c("Positions: 1", 60), c("Length: 2", 72), c("bytes", 83), c("Note it", 83, 200), c("far note", 95, 200), c("stray", 130), c("Next", 160), c("beside", 160, 200), c("Position: 2–3", 172), c("Format: AN", 184),
        L("TC 9", 300, size=20.0), L("Nine", 312, size=20.0), c("Values: early", 320, 200), c("Positions: 4", 330), c("Mapping X", 330, 200), c("loose", 10, 60, 2)]
    got = blocks(spark, cards.field_cards, lines, "text", "card")
    assert [x[:2] for x in got] == [("paragraph", "Intro goes on"), ("field_card", None), ("paragraph", "stray"), ("field_card", None), ("section_heading", "TC 9 Nine"), ("field_card", None), ("paragraph", "loose")]
    shown = [{k: v for k, v in x[2].asDict().items() if v} for x in got if x[2]]
    assert shown == [{"positions": "1", "length": "2 bytes", "note": "it far note"}, {"name": "Next", "positions": "2–3", "format": "AN", "description": "beside"}, {"positions": "4", "values": "early", "mapping": "X"}]
    assert blocks(spark, cards.field_cards, [], "text") == []


def test_rotated_pairs(spark):
    at = lambda text, x0, y1, size=9.0, page=1: Line(page, int(x0), x0, y1 - 80, x0 + 9, y1, text, size)
    lines = [at("Sample (1 of 2)", 20, 700, 12.0), at("Field Name", 40, 700), at("Description", 40, 400), at("Amount", 60, 702), at("How much", 61, 401), at("there is", 71, 400), at("Date", 100, 700), at("None here", 130, 400), at("Field Name", 40, 700, page=2), at("Other", 60, 700, page=2), at("Text", 60, 300, page=2)]
    assert blocks(spark, cards.rotated_pairs, lines, "title", "label", "text") == [
        ("field_description_pair", "Sample", "Amount", "How much there is"), ("field_description_pair", "Sample", "Date", ""), ("field_description_pair", "Sample", "Other", "Text")]


def table(spark, lines, doc=1):
    return spark.createDataFrame([(doc, x.page, x.ord, *map(float, (x.x0, x.y0, x.x1, x.y1)), x.text, x.size, x.bold, list(x.fonts)) for x in lines], LINE)


def test_page_tables_with_two_zones(spark):
    head = lambda y: [L("Name", y, 60, 9.5, True), L("Len", y, 200, 9.5, True)]
    lines = [
        L("Reports", 0, size=26.0), L("T1", 20, size=10.5, bold=True), *head(40), L("lost", 55, 200), L("a", 70), L("1", 70, 200), L("b", 100), L("c", 111), L("T2", 150, size=10.5, bold=True), *head(170), L("d", 190), L("2", 190, 200), L("rest", 300, size=8.0)]
    plain = [L("lone data", 10, page=2), L("T3", 30, size=10.5, bold=True, page=2)]
    got = sorted(tables.page_tables(table(spark, lines + plain), ["doc"]).collect(), key=lambda r: (r["page"], r["ord"]))
    rows = [(b["title"], b["columns"]) for b in got if b["type"] == "grid_row"]
    assert rows == [("T1", {assembly.PREFIX: "lost"}), ("T1", {"Name": "a", "Len": "1"}), ("T1", {"Name": "b c", "Len": ""}), ("T2", {"Name": "d", "Len": "2"})]
    assert all(b["anchor_column"] == "Name" and b["items"] == ["Name", "Len"] for b in got if b["type"] == "grid_row")
    assert (got[0]["type"], got[0]["level"], got[0]["text"]) == ("section_heading", 1, "Reports")
    assert [(b["page"], b["text"]) for b in got if b["type"] == "paragraph"] == [(1, "rest"), (2, "lone data T3")]
    assert tables.page_tables(table(spark, lines).limit(0), ["doc"]).collect() == []


def test_tables_broadcast_nothing_that_grows_with_pages(spark):
    """Zones, titles and bullets are a row for each page: small when stored, but no table for the driver's memory. A null document is one,
    pages without headers are paragraphs, and lines are the same whether scans are cut into ranges or not."""
    head = lambda y: [L("Name", y, 60, 9.5, True), L("Le", y, 200, 9.5, True), L(" n", y, 260, 9.5, True)]
    lines = [L("early", 30), L("T1", 20, size=10.5, bold=True), *head(40), L("a", 70), L("1", 70, 200), L("-", 85, fonts=("Wingdings",)), L("b", 100), L("– c", 130), L("T2", 160, size=10.5, bold=True), *head(180), L("d", 200), L("2", 200, 200), L("e", 230), L("end", 300, size=10.5, bold=True)]
    plain = [L("lone", 10, page=2), L("T3", 30, size=10.5, bold=True, page=2)]
    both = table(spark, lines + plain).unionByName(table(spark, lines + plain).withColumn("doc", F.lit(None).cast("int")))
    shown = lambda df: sorted(str((r["doc"] is None, r["page"], r["ord"], r["type"], r["title"], r["text"], r["items"], sorted((r["columns"] or {}).items()))) for r in df.collect())
    for relation in (tables.page_tables, tables.final_tables):
        made = relation(both, ["doc"])
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
        got = shown(made)
        assert [x.replace("(True", "(False") for x in got[len(got) // 2:]] == got[: len(got) // 2]
        assert sum("grid_row" in x for x in got) == 2 * (5 if relation is tables.final_tables else 6) and sum("lone T3" in x for x in got) == 2
    assert got == shown(tables.final_tables(both, ["doc"], most=2))
    assert any("'Le n', '1'" in x for x in got) and any("'b – c'" in x for x in got)


def test_header_tiers_and_group_headers(spark):
    lines = [L("Group", 10, 200, 9.5, True), L("Key", 10, 60, 9.5, True), L("In", 30, 190, 9.5, True), L(" Out", 30, 250, 9.5, True), L("side", 42, 252, 9.5, True), L("Key", 90, 60, 9.5, True)]
    cells = tables.header_cells(tables.oriented(table(spark, lines), False), ["doc", "page"])
    assert sorted((r["at"], r["name"], r["across"], r["blank"]) for r in cells.collect()) == [(10.0, "Group", 200.0, False), (10.0, "Key", 60.0, False), (30.0, "In", 190.0, False), (30.0, "Out side", 250.0, True), (90.0, "Key", 60.0, False)]
    found = tables.zones(cells, ["doc", "page"]).orderBy("zone").collect()
    assert [(r["zone"], r["start"], {c["name"] for c in r["columns"]}) for r in found] == [(1, 10.0, {"In", "Out side", "Key"}), (2, 90.0, {"Key"})]


def test_zones_of_data_and_titles(spark):
    found = spark.createDataFrame([(1, 1, 100.0), (1, 2, 300.0)], "page int, zone int, start double")
    at = lambda values: spark.createDataFrame([(1, float(v)) for v in values], "page int, along double")
    zone = lambda df, forward: [r["zone"] for r in tables.in_zones(df, found, ["page"], forward).orderBy("along").collect()]
    assert zone(at([50, 150, 300]), False) == [1, 1, 2] and zone(at([90, 120, 400]), True) == [1, 2, 2]


def test_bullets_keep_wrapped_anchors(spark):
    at = lambda text, x0: Line(1, int(x0), x0, 600, x0 + 5, 700, text, 9.0)
    found = spark.createDataFrame([(1, 1, 1, 0.0, [("A", 700.0, -700.0, False), ("B", 300.0, -300.0, False)])], "doc int, page int, zone int, start double, columns array<struct<name:string,across:double,rank:double,blank:boolean>>")
    data = tables.oriented(table(spark, [at("one", 10), at("two", 23), at("three", 60)]), True)
    bullet = tables.oriented(table(spark, [at("l", 28)]), True)
    rows = lambda marks: [r["columns"]["A"] for r in tables.anchored_rows(data, found, marks, ["doc", "page"], tables.ROTATED_GAP).orderBy("row").collect()]
    assert rows(bullet.limit(0)) == ["one", "two", "three"] and rows(bullet) == ["one two", "three"]


def test_narrative_headings_and_paragraphs(spark):
    lines = [L("1 Big", 0, size=26.0), L("title", 30, size=26.0), L("Part", 60, size=20.0), L("Detail", 80, size=14.0), L("a", 100), L("b", 112), L("far", 150), L("moved", 160, 100), L("Part two", 0, size=20.0, page=2), L("c", 20, page=2)]
    assert blocks(spark, flows.narrative, lines, "level", "text") == [
        ("section_heading", 1, "1 Big title"), ("section_heading", 2, "Part"), ("section_heading", 3, "Detail"), ("paragraph", None, "a b"), ("paragraph", None, "far"), ("paragraph", None, "moved"), ("section_heading", 2, "Part two"), ("paragraph", None, "c")]


def test_section_transitions_against_enumeration():
    def allowed(now):
        yield now
        yield (now[0] + 1,)
        yield from (now + (n,) for n in range(1, 5))
        yield from (now[:k] + (now[k] + 1,) for k in range(1, len(now)))

    numbers = [n for size in (1, 2, 3) for n in product(range(1, 5), repeat=size)]
    for now in numbers:
        if len(now) < 3:
            assert {n for n in numbers if pages.follows(n, now)} == set(allowed(now)) & set(numbers)
    got = list(pages.numbered_sections(L(t, 10 * k) for k, t in enumerate(["1 A", "1.1 B", "3 note", "1.2 C", "x", "2 D"])))
    assert [(b["type"][:1], b["code"]) for b in got] == [("s", "1"), ("s", "1.1"), ("p", "1.1"), ("s", "1.2"), ("p", "1.2"), ("s", "2")]


def test_fold_streams_scopes_in_order(spark):
    rows = [(s, 1 + k // 5, k, 60.0, 20.0 * k, 110.0, 20.0 * k + 10, f"{k % 3 + 1} line {s}{k}", 9.0, None, None, "clash") for s in ("a", "b") for k in range(40)]
    lines = spark.createDataFrame(rows[::-1], "s string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string, size double, bold boolean, fonts array<string>, block string")
    got = folding.fold(lines, ["s"], pages.numbered_sections, rows=7).orderBy("s", "block").collect()
    expected = [b["code"] for b in pages.numbered_sections(L(r[7]) for r in rows[:40])]
    assert [r["code"] for r in got] == expected * 2 and [r["block"] for r in got] == [*range(40)] * 2
    assert folding.fold(lines.limit(0), ["s"], pages.code_tables).count() == 0
    empty = lines.select("s", *(F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in Line.__dataclass_fields__ if c in lines.columns))
    for parser in (pages.code_tables, pages.numbered_sections):
        folding.fold(empty, ["s"], parser).count()
    for relation in (cards.label_cards, cards.field_cards, cards.rotated_pairs, flows.index_blocks, flows.narrative):
        relation(empty, ["s"]).count()
    assert flows.narrative(empty.limit(0), ["s"]).collect() == []


def test_phantom_columns(spark):
    rows = [("t", 1, {"Messages": "x", "and Codes": "", "Len": "1"}), ("t", 2, {"Messages": "y", "and Codes": " ", "Len": "2"}), ("t", 3, {"__unassigned_prefix__": "p"}), ("u", 1, {"Messages": "x", "and Codes": "", "Len": ""}), ("v", 1, {"Messages": "", "and Codes": "", "Len": ""}), ("v", 2, None)]
    df = spark.createDataFrame(rows, "s string, k int, columns map<string,string>").withColumns({"names": F.array(*map(F.lit, ("Messages", "and Codes", "Len"))), "spaced": F.array(F.lit("and Codes"))})
    got = {(r["s"], r["k"]): r["columns"] for r in assembly.phantom_columns(df, ["s"]).collect()}
    assert got[("t", 1)] == {"Messages and Codes": "x", "Len": "1"} and got[("t", 3)] == {"__unassigned_prefix__": "p"}
    assert got[("u", 1)] == rows[3][2] and got[("v", 1)] == rows[4][2] and len(got) == 6


def test_phantom_names_that_are_columns_already(spark):
    order = F.array(*map(F.lit, ("A", "B", "A B", "C")))
    df = spark.createDataFrame([(1, {"A": "x", "B": "", "A B": "y", "C": "z"}), (2, {"A": "u", "B": "", "A B": "", "C": "w"})], "k int, columns map<string,string>").withColumns({"s": F.lit(1), "names": order, "spaced": F.array(F.lit("B"))})
    assert [r["columns"] for r in assembly.phantom_columns(df, ["s"]).orderBy("k").collect()] == [{"A B": "x", "C": "z"}, {"A B": "u", "C": "w"}]
    # A row of text before any anchor is no second row.
    one = spark.createDataFrame([(1, {"A": "x", "B": ""}), (0, {assembly.PREFIX: "p"})], "k int, columns map<string,string>").withColumns({"s": F.lit(1), "names": F.array(F.lit("A"), F.lit("B")), "spaced": F.array(F.lit("B"))})
    assert [r["columns"] for r in assembly.phantom_columns(one, ["s"]).orderBy("k").collect()] == [{assembly.PREFIX: "p"}, {"A": "x", "B": ""}]


def test_orphans_of_maps(spark, monkeypatch):
    cells = [{assembly.PREFIX: "– p"}, {"A": "– one", "B": ""}, {"A": "- two", "B": None}, {"A": "x", "B": "1"}, {"A": "– y", "B": " "}, {"A": "‒ z", "B": ""}, {"A": "– full", "B": "2"}, {"A": "-tight", "B": ""}, {"B": ""}, None, {"A": "– end", "B": ""}]
    rows = spark.createDataFrame([(s, k, c, "A", "clash") for s in (1, None) for k, c in enumerate(cells)], "s int, row int, columns map<string,string>, anchor_column string, island string")
    wanted = [(0, cells[0]), (1, {"A": "– one - two", "B": ""}), (3, {"A": "x – y ‒ z", "B": "1"}), (6, cells[6]), (7, cells[7]), (8, {"B": "", "A": "– end"}), (9, None)]
    for split in (None, 3):
        if split:
            monkeypatch.setitem(scan.scanned.__kwdefaults__, "split", split)
        got = assembly.joined_orphans(rows, ["s"]).orderBy("s", "row").collect()
        assert [(r["row"], r["columns"]) for r in got] == wanted * 2 and {r["island"] for r in got} == {"clash"}
    assert assembly.joined_orphans(rows.limit(0), ["s"]).collect() == []


def test_references_and_criteria(spark):
    row = spark.createDataFrame([("see Table 2–1, TABLE 2-1 and Table 1-10; Table 2-1",), (None,)], "t string")
    assert [r[0] for r in row.select(assembly.references(F.col("t"))).collect()] == [["TABLE 2-1", "Table 1-10", "Table 2-1"], []]
    old = spark.createDataFrame([("p", "x", "Rate is 5. All Rights Reserved"), ("p", "y", "gone"), ("p", "z", "The first wording of it")], "program string, title string, text string")
    new = spark.createDataFrame([("p", "x", "Rate  is 5."), ("p", "w", "new"), ("p", "z", "Another wording")], "program string, title string, text string")
    got = {r["title"]: r["change_type"] for r in assembly.criteria_changes(old, new, ["program", "title"]).collect()}
    assert got == {"y": "criteria_table_removed", "w": "criteria_table_added", "z": "criteria_changed"}


def test_repair_keeps_words(spark):
    from deltafolio.functions import text as T

    assert [r[0] for r in spark.createDataFrame([("TC R 1",), ("TC Rate",)], "t string").select(T.repair(F.col("t"))).collect()] == ["TCR 1", "TC Rate"]
    assert re.match(pages.CONTINUED, "A1 (continued)")


def test_field_cards_in_many_tasks_and_with_one_shuffle(spark):
    """Random pages: scopes spread over many tasks give the same blocks; else lines are dealt out once, by their scope."""
    import random
    import re

    r = random.Random(5)
    said = ["Positions: 1", "Position: 2–3", "Length: 4", "Format: AN", "Format: AN = x", "Values: a", "Note", "Mapping X", "Description d", "plain", "", *["TC 1"] * 8, *cards.GRID_WORDS]
    rows = []
    for doc, n in ((1, 150), (2, 15)):
        y = 0.0
        for k in range(n):
            y = 0.0 if k % 40 == 0 else y + r.choice([0.0, 2.0, 9.0, 11.0, 12.0, 25.0])
            x = r.choice([60.0, 62.0, 100.0, 200.0, 300.0])
            rows.append((doc, k // 40, k, x, y, x + 50, y + 10, r.choice(said), r.choice([9.0, 9.5, 9.5, 10.0, 10.0, 20.0]), False, []))
    rows += [(2, 9, 900 + k, 60.0 + k, 40.0, 70.0, 50.0, t, 9.5 if k < 5 else 9.0, False, []) for k, t in enumerate([*cards.GRID_WORDS, "1"])]
    lines = spark.createDataFrame(rows, LINE)
    whole, spread = cards.field_cards(lines, ["doc"]), cards.field_cards(lines, ["doc"], most=100)
    shown = lambda df: sorted(str(x) for x in df.collect())
    assert shown(whole) == shown(spread) and {x["type"] for x in whole.collect()} == {"section_heading", "table_header", "table_row", "field_card", "paragraph"}
    plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    exchanges = re.findall(r"Exchange \w+", plan)
    assert exchanges == ["Exchange hashpartitioning"], exchanges
