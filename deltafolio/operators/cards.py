"""Cards and pairs of labelled texts on pages, as relations: what a line is follows from columns and running values, blocks are islands.

Lines have the scope and page, ord, x0, y0, x1, y1, text, size, bold and fonts; null texts are empty, null positions and sizes 0. Every result
has the scope, block (0, 1, …, in the order of first lines), page, type and columns of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import broadcast_if_fits, reads, release, rows_of
from . import scan
from .matching import greedy_assign

# Labels, bullets and layouts of the documents.
LABELS = r"(Description|Action|Transaction Types?):"
BULLETS = ("●", "■", "•", "l")
CARD_LEFT = r"^(Positions?|Length|Format):\s*(.*)$"
CARD_RIGHT = r"^(Description|Note|Values|Mapping)(?::\s*|\s+)(.*)$"
CARD = ("name", "positions", "length", "format", "description", "note", "values", "mapping")
GRID_WORDS = ("Position", "Field", "Length", "Format", "Contents")
GRID_HEADER = ("Position", "Field Length", "Format", "Contents")


def _lines(lines: DataFrame, scope: list[str]) -> DataFrame:
    number = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "")
    whole = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return lines.select(*scope, whole("page"), whole("ord"), *(number(c) for c in ("x0", "y0", "x1", "y1", "size")), text.alias("text"), F.coalesce("bold", F.lit(False)).alias("bold"), F.coalesce("fonts", F.array().cast("array<string>")).alias("fonts"))


def _flag(c: Column) -> Column:
    return F.when(c, 1).otherwise(0)


def _in_order(c: str, value: str) -> Column:
    """Texts of collected (at, …) structs, in order, empty ones left out, as one."""
    return F.array_join(F.filter(F.transform(F.array_sort(c), lambda x: x[value]), lambda t: t != ""), " ")


# ---- label cards and glossary -------------------------------------------------------------------------------------------


def label_cards(
    lines: DataFrame, scope: list[str], code_size: float = 20.0, other_size: float = 26.0, code: str = r"^[vV]\d{4}$|^\d{6}-[A-Z]$", title_font: str = "Courier",
    big: float = 15.0, glossary: str = r"Glossary$", term_x: float = 100.0, term_gap: float = 8.0,
) -> DataFrame:
    """card_header (code, title), field (label, text), bullet_list (items), glossary_term and paragraph.

    A code's title is the line after it and those in the title font that follow at once. Below a glossary heading, bold lines at the
    left are terms; a term with a text right below is a card of its own, with that text as its description. A label opens a field or a list, and may
    hang at the end of another label's line. Bullets separate a list's items. Any other line goes on with the open block.
    """
    text, order = F.col("text"), ["page", "ord"]
    is_code = (F.col("size") == code_size) | ((F.col("size") == other_size) & text.rlike(code))
    titled = F.exists("fonts", lambda f: f.startswith(title_font))
    marked = _lines(lines, scope).withColumns({"is_code": is_code, "is_big": ~is_code & (F.col("size") > big), "titled": titled, "at_left": F.col("bold") & (F.col("x0") < term_x)})
    after, whole = F.col("n") - F.col("code_n"), r"(?s)^" + LABELS + r"\s*(.*)$"
    is_title = F.coalesce(~F.col("is_code") & (F.col("other_fonts") == F.col("code_fonts")), F.lit(False))
    heads = F.col("is_big") & ~is_title & text.rlike(glossary)
    below = F.col("glossaries") - _flag(heads) > 0
    is_term = ~F.col("is_code") & ~is_title & below & F.col("at_left")
    heading = F.col("is_big") & ~is_title & ~is_term
    own = ~F.col("is_code") & ~is_title & ~is_term & ~heading
    was = lambda c: F.coalesce(F.col("was")[c], F.lit(False))
    same_term = is_term & was("term") & F.coalesce((F.col("was")["page"] == F.col("page")) & (F.col("y0") - F.col("was")["y1"] < term_gap), F.lit(False))
    says = own & was("term")
    labelled = own & ~says & text.rlike(whole)
    first, rest = F.regexp_extract("text", whole, 1), F.regexp_extract("text", whole, 2)
    tail = r"(?s)^(.*\S)\s+" + LABELS + r"\s*$"
    hangs = labelled & rest.rlike(tail)
    kind_of = lambda label: F.when(label.startswith("Transaction"), "bullet_list").otherwise("field")
    lone = own & ~says & ~labelled & (F.col("was").isNull() | was("header"))
    opened = (
        F.when(F.col("is_code"), "card_header").when(is_term & ~same_term, "term").when(heading | lone, "paragraph").when(says, "field").when(hangs, kind_of(F.regexp_extract(rest, tail, 2))).when(labelled, kind_of(first))
    )
    bullet = own & ~says & ~labelled & ~lone & text.isin(*BULLETS)
    found = scan.scanned(
        marked, scope, order,
        {"n": scan.total(F.lit(1))}, {"code_n": scan.latest(F.when(F.col("is_code"), F.col("n")))}, {"other_fonts": scan.total(_flag((after > 1) & ~F.col("titled")))},
        {"code_fonts": scan.latest(F.when(F.col("is_code"), F.col("other_fonts")))}, {"glossaries": scan.total(_flag(heads))},
        {"was": scan.before(F.struct("page", "y1", is_term.alias("term"), (F.col("is_code") | is_title).alias("header")))},
        {"block": scan.total(F.when(hangs, 2).when(opened.isNotNull(), 1).otherwise(0)), "kind": scan.latest(opened)},
        {"mark": scan.total(_flag(bullet & (F.col("kind") == "bullet_list")))},
    )
    dropped = bullet & ((F.col("kind") == "bullet_list") | (below & (F.col("kind") == "field")))
    at, none = F.struct("page", "ord"), F.lit(None).cast("string")
    part = lambda block, kind, role, said, label=none: F.struct(block.alias("block"), kind.alias("kind"), F.lit(role).alias("role"), said.alias("said"), label.alias("label"))
    here, kind = F.col("block"), F.col("kind")
    parts = (
        F.when(dropped, F.array(part(here, kind, "mark", F.lit(""))))
        .when(F.col("is_code"), F.array(part(here, kind, "code", text)))
        .when(is_title, F.array(part(here, kind, "title", text)))
        .when(says, F.array(part(here - 1, F.lit("term"), "described", F.lit("")), part(here, kind, "text", text, F.lit("Description"))))
        .when(hangs, F.array(part(here - 1, kind_of(first), "text", F.regexp_extract(rest, tail, 1), first), part(here, kind, "text", F.lit(""), F.regexp_extract(rest, tail, 2))))
        .when(labelled, F.array(part(here, kind, "text", rest, first)))
        .otherwise(F.array(part(here, kind, "text", text)))
    )
    rows = found.select(*scope, at.alias("at"), "page", "mark", F.explode(parts).alias("p")).select(*scope, "at", "page", "mark", "p.*")
    of = lambda role: F.collect_list(F.when(F.col("role") == role, F.struct("at", "mark", "said")))
    blocks = rows.groupBy(*scope, "block").agg(
        F.first("kind").alias("kind"), F.min_by("page", F.when(F.col("role") != "described", F.col("at"))).alias("page"), F.min(F.when(F.col("role") == "described", F.col("page"))).alias("described"),
        F.max("label").alias("label"), of("code").alias("codes"), of("title").alias("titles"), of("text").alias("texts"),
    )
    said = _in_order("texts", "said")
    marks = F.array_distinct(F.transform(F.array_sort("texts"), lambda x: x["mark"]))
    item = lambda m: F.array_join(F.filter(F.transform(F.filter(F.array_sort("texts"), lambda x: x["mark"] == m), lambda x: x["said"]), lambda t: t != ""), " ")
    items, is_list, header = F.filter(F.transform(marks, item), lambda t: t != ""), F.col("kind") == "bullet_list", F.col("kind") == "card_header"
    card = F.col("described").isNotNull()
    kind = F.when((F.col("kind") == "term") & card, "card_header").when(F.col("kind") == "term", "glossary_term").otherwise(F.col("kind"))
    name = F.nullif(_in_order("titles", "said"), F.lit(""))
    return blocks.select(
        *scope, (F.col("block") - 1).cast("bigint").alias("block"), F.coalesce("described", "page").cast("int").alias("page"), kind.alias("type"), F.when(header, _in_order("codes", "said")).when(card, said).alias("code"),
        F.when(header, name).when(card, said).alias("title"), F.when(F.col("kind") == "field", F.col("label")).alias("label"), F.when(~header & ~is_list & ~card, said).alias("text"), F.when(is_list, items).alias("items"),
    )


# ---- rotated pairs ------------------------------------------------------------------------------------------------------


def rotated_pairs(
    lines: DataFrame, scope: list[str], title_size: float = 12.0, label_sizes: tuple[float, ...] = (9.0, 9.5), band: float = 6.0, apart: float = 30.0,
    wrap: float = 15.0, name: str = "Field Name", other: str = "Description",
) -> DataFrame:
    """field_description_pair (title, label, text): on a rotated page, lines whose lower ends form the topmost cluster are names, those of the
    lowest are descriptions; a wrapped description is an island along x0. Names take the nearest free description within ``band``, in their order.
    """
    own, page = _lines(lines, scope), [*scope, "page"]
    order = F.struct("ord", "x0")
    shown = own.where(F.col("size") == title_size).groupBy(*page).agg(F.collect_list(F.struct(order.alias("at"), F.col("text").alias("said"))).alias("t"))
    titles = shown.select(*page, F.regexp_replace(_in_order("t", "said"), r"\s*\(\d+ of \d+\)\s*$", "").alias("title"))
    labels = own.where(F.col("size").isin(*label_sizes))
    # One scan along y1 finds the clusters; the first and the last one of a page are its columns.
    far = F.coalesce(F.col("y1") - F.col("last") > band, F.lit(True))
    cut = scan.scanned(labels, page, ["y1", "ord"], {"last": scan.before(F.col("y1"))}, {"cluster": scan.total(_flag(far))})
    ends = cut.groupBy(*page).agg(F.max("cluster").alias("top"), F.max(F.when(F.col("cluster") == 1, F.col("y1"))).alias("low"), F.max(F.col("text") == name).alias("named"))
    edge = cut.join(ends, page).where("named and top > 1").groupBy(*page, "top", "low").agg(F.min(F.when(F.col("cluster") == F.col("top"), F.col("y1"))).alias("high")).where(F.col("low") + apart <= F.col("high")).select(*page, "top")
    cells = cut.join(edge, page).where((F.col("cluster") == 1) | (F.col("cluster") == F.col("top"))).withColumn("upper", F.col("cluster") == F.col("top"))
    names = cells.where(F.col("upper") & (F.col("text") != name)).select(*page, F.struct("x0", "ord").alias("a_ord"), "x0", "text")
    parts = cells.where(~F.col("upper") & (F.col("text") != other))
    opens = F.coalesce(F.col("x0") - F.col("before") >= wrap, F.lit(True))
    islands = scan.scanned(parts.drop("last", "cluster", "top"), page, ["x0", "ord"], {"before": scan.before(F.col("x0"))}, {"island": scan.total(_flag(opens))})
    texts = islands.groupBy(*page, "island").agg(F.min("x0").alias("b_x"), F.collect_list(F.struct(F.struct("x0", "ord").alias("at"), F.col("text").alias("said"))).alias("t")).select(*page, "b_x", F.struct(F.col("b_x").alias("x0"), "island").alias("b_ord"), _in_order("t", "said").alias("text"))
    # Cells of the band's width, and their neighbours: what is near is in one of three.
    near = names.withColumn("cell", F.explode(F.array(*(F.floor(F.col("x0") / band) + k for k in (-1, 0, 1))))).drop("text").join(texts.withColumn("cell", F.floor(F.col("b_x") / band)).drop("text"), [*page, "cell"])
    edges = near.where(F.abs(F.col("x0") - F.col("b_x")) <= band).select(*page, "a_ord", "b_ord", (-F.abs(F.col("x0") - F.col("b_x"))).alias("ratio"))
    taken = greedy_assign(edges, page, "serial").select(*page, "a_ord", "b_ord")
    both = names.join(taken, [*page, "a_ord"], "left").join(texts.select(*page, "b_ord", F.col("text").alias("said")), [*page, "b_ord"], "left")
    # The title of the latest page that shows one.
    every = both.select(*page, F.col("a_ord").alias("at"), F.col("text").alias("label"), F.coalesce("said", F.lit("")).alias("text"), F.lit(None).cast("string").alias("shown"), F.lit(True).alias("pair"))
    heads = titles.select(*page, F.lit(None).cast(every.schema["at"].dataType).alias("at"), F.lit(None).cast("string").alias("label"), F.lit("").alias("text"), F.col("title").alias("shown"), F.lit(False).alias("pair"))
    named = scan.scanned(every.unionByName(heads), scope, ["page", "pair", "at"], {"title": scan.latest(F.col("shown")), "block": scan.total(_flag(F.col("pair")))}).where("pair")
    return named.select(*scope, (F.col("block") - 1).cast("bigint").alias("block"), F.col("page").cast("int").alias("page"), F.lit("field_description_pair").alias("type"), F.coalesce("title", F.lit("")).alias("title"), "label", "text")


# ---- position grids and field cards -------------------------------------------------------------------------------------


def field_cards(
    lines: DataFrame, scope: list[str], heading_sizes: tuple[float, ...] = (20.0, 26.0), heading: str = r"^TC \d", legend: str = r"^Format:\s*AN\s*=",
    header_size: float = 9.5, row_size: float = 9.0, row_gap: float = 4.0, split: float = 150.0, name_gap: float = 20.0, most: int = scan.SPLIT,
) -> DataFrame:
    """section_heading, table_header, table_row (cells), field_card (card) and paragraph.

    A grid is a run of header words and the run of row lines after it; a row ends where a line starts more than ``row_gap`` below all before
    it on the page. Elsewhere a "Positions" label on the left opens a card, which begins with the paragraph right above the label, its name; labels on
    the right of ``split``, from the name's first line on, fill that card, as do "Length" and "Format" on the left. Lines on the right go on with
    the last label there, those on the left close below a left label with that one; others make paragraphs.

    Scopes are counted once. Those of up to ``most`` lines are dealt out by scope, and only once: every running value and the blocks themselves
    are of a scope or its parts. Larger ones are spread over many tasks at each step.
    """
    own = _lines(lines, scope)
    options = dict(heading_sizes=heading_sizes, heading=heading, legend=legend, header_size=header_size, row_size=row_size, row_gap=row_gap, split=split, name_gap=name_gap)
    large = scan.large_scopes(own, scope, most)
    if not rows_of(large):
        release(large)
        return _field_cards(own, scope, lambda *a: scan.scanned(*a, split=None), **options)
    few = broadcast_if_fits(large)
    rest = _field_cards(own.join(few, scan.matches(own, few, scope), "left_anti"), scope, lambda *a: scan.scanned(*a, split=None), **options)
    spread = _field_cards(own.join(few, scan.matches(own, few, scope), "left_semi"), scope, lambda *a: scan.scanned(*a, split=most), **options)
    return reads(rest.unionByName(spread), large, spread)


def _field_cards(own: DataFrame, scope: list[str], scanned, heading_sizes, heading, legend, header_size, row_size, row_gap, split, name_gap) -> DataFrame:
    """field_cards of lines as _lines gives them. A line gets the number of its block from running values; no step joins, so that none deals lines out anew."""
    text, order = F.col("text"), ["page", "ord"]
    starts = F.col("size").isin(*heading_sizes) & text.rlike(heading)
    word = (F.col("size") == header_size) & text.isin(*GRID_WORDS)
    left, right = F.regexp_extract("text", CARD_LEFT, 1), F.regexp_extract("text", CARD_RIGHT, 1)
    was = lambda c: F.col("was")[c]
    yes = lambda c: F.coalesce(c, F.lit(False))
    lean = own.select(*scope, *order, "x0", "y0", "y1", "size", "text")
    marked = lean.withColumns({"starts": starts, "word": word & ~starts, "legend": text.rlike(legend) & ~starts & ~word})
    # Runs of lines of one kind: a heading goes on while lines have its size, rows go on while lines have theirs, after a header.
    turns = F.when(F.col("starts") | F.col("legend"), F.lit(True)).when(F.col("word"), ~yes(was("word"))).otherwise(yes(was("word")) | yes(was("legend")) | F.col("was").isNull() | (was("size") != F.col("size")))
    lined = scanned(
        marked, scope, order, {"was": scan.before(F.struct("size", "word", "legend"))}, {"run": scan.total(_flag(turns)), "n": scan.total(F.lit(1))},
        {"head_run": scan.latest(F.when(F.col("starts"), F.col("run"))), "word_run": scan.latest(F.when(F.col("word"), F.col("run"))), "word_no": scan.total(_flag(F.col("word")))},
        {"first_word": scan.latest(F.when(F.col("word") & ~yes(was("word")), F.col("word_no")))},
    ).drop("was")
    zone = F.when(F.col("starts") | yes((F.col("run") == F.col("head_run")) & ~F.col("legend") & ~F.col("word")), "heading").when(F.col("word"), "header").when(yes((F.col("size") == row_size) & (F.col("run") == F.col("word_run") + 1)) & ~F.col("legend"), "row").otherwise("text")
    # Cards. A stretch ends at headings and grids; only lines between them make cards.
    on_left = F.col("x0") < split
    role = F.when(F.col("legend"), "paragraph").when(on_left & left.startswith("Position"), "opens").when(on_left & (left != ""), "left").when(~on_left & (right != ""), "right").when(on_left, "under").otherwise("beside")
    stretch = F.concat(F.coalesce("head_run", F.lit(0)), F.lit(":"), F.coalesce("word_run", F.lit(0)))
    lined = lined.withColumns({"zone": zone, "stretch": stretch}).withColumn("role", F.when(F.col("zone") == "text", role)).drop("starts", "word", "size", "head_run")
    by = [*scope, "stretch"]
    close = lambda line, gap: (line["page"] == F.col("page")) & (F.abs(F.col("x0") - line["x0"]) <= 20.0) & (F.col("y0") - line["y1"] <= gap)
    is_left, is_role = yes(F.col("role").isin("left", "opens", "under", "paragraph")), lambda *r: yes(F.col("role").isin(*r))
    place = F.struct("page", "x0", "y0", "y1", "role")
    # Lines on the left, one after another: those close below a Length or a Format, without a break, go on with it.
    lefts = scanned(
        lined, by, order, {"seen": scan.latest(F.when(is_left, place))}, {"up": scan.before(F.col("seen"))},
        {"label_of": scan.latest(F.when(is_role("left", "opens", "paragraph"), F.struct("role", F.lower(left).alias("key")))), "breaks": scan.total(_flag(is_role("under") & ~yes(close(F.col("up"), 2.0))))},
        {"label_breaks": scan.latest(F.when(is_left & ~is_role("under"), F.col("breaks")))},
    )
    goes_on = yes(is_role("under") & (F.col("label_of")["role"] == "left") & (F.col("breaks") == F.col("label_breaks")))
    lefts = lefts.withColumn("role", F.when(goes_on, "more").when(is_role("under"), "paragraph").otherwise(F.col("role"))).drop("seen", "up", "breaks", "label_breaks")
    # Paragraphs are islands of such lines; the one right above a Positions label is its card's name.
    above = lambda c: F.col("up")[c]
    new = is_role("paragraph") & (F.col("legend") | ~yes((above("role") == "paragraph") & close(F.col("up"), 10.0)))
    named = is_role("opens") & yes((above("role") == "paragraph") & (above("page") == F.col("page")) & (F.col("y0") - above("y1") <= name_gap))
    # No line of a paragraph comes after the label that it names, so the next such label is its own or another one's.
    name_of = F.when(is_role("paragraph") & (F.col("named")["paragraph"] == F.col("paragraph")), F.col("named")["n"])
    opens = F.when(is_role("opens") & ~named, F.col("n")).when(new, name_of)
    field = F.when(is_role("right"), F.lower(right))
    ran = scanned(
        lefts, by, order, {"seen": scan.latest(F.when(is_role("left", "opens", "paragraph"), place))}, {"up": scan.before(F.col("seen"))}, {"paragraph": scan.total(_flag(new))},
        {"named": scan.coming(F.when(named, F.struct("paragraph", "n")))}, {"card": scan.latest(opens), "next_card": scan.coming(opens), "name_y": scan.latest(F.when(is_role("paragraph"), F.col("y0")))},
        {"label": scan.latest(F.when(is_role("right"), F.struct(field.alias("field"), F.col("card").alias("card"))))},
    )
    # Right of a name, a line without a label is its description; before the first card, labels wait for it.
    continued = yes(F.col("label")["card"].eqNullSafe(F.col("card")))
    of_name = is_role("beside") & ~continued & yes(F.abs(F.col("y0") - F.col("name_y")) < 3.0)
    # What goes on with a left label has that label's key.
    key = (
        F.when(is_role("right"), field).when(is_role("beside") & continued, F.col("label")["field"]).when(of_name, "description").when(is_role("opens"), "positions")
        .when(is_role("left"), F.lower(left)).when(is_role("more"), F.col("label_of")["key"]).when(name_of.isNotNull(), "name")
    )
    said = F.when(is_role("right"), F.regexp_extract("text", CARD_RIGHT, 2)).when(is_role("opens", "left"), F.regexp_extract("text", CARD_LEFT, 2)).otherwise(text)
    ran = ran.withColumns({"key": key, "said": said, "of_card": F.coalesce(name_of, "card", "next_card")}).drop("seen", "up", "named", "label", "label_of", "name_y", "card", "next_card")
    # Rows: what starts more than the gap below everything before it in the run and on the page.
    ran = scanned(
        ran.withColumn("page_run", F.when(F.col("zone") == "row", F.concat_ws(":", "run", "page"))), [*scope, "page_run"], order, {"bottom": scan.highest(F.col("y1"))}, {"above": scan.before(F.col("bottom"))},
        {"row": scan.total(_flag(yes(F.col("y0") - F.col("above") > row_gap)))},
    )
    # Blocks: the lines of one number.
    full = F.floor((F.col("word_no") - F.col("first_word")) / len(GRID_WORDS))
    number = lambda kind, *of: F.struct(F.lit(kind).alias("kind"), F.concat_ws("/", *(c.cast("string") for c in of)).alias("of"))
    block = (
        F.when(F.col("zone") == "heading", number("section_heading", F.col("stretch"))).when(F.col("zone") == "header", number("table_header", F.col("word_run"), full))
        .when(F.col("zone") == "row", number("table_row", F.col("page_run"), F.col("row"))).when(F.col("key").isNotNull() & F.col("of_card").isNotNull(), number("field_card", F.col("of_card")))
        .when(F.col("key").isNull() & is_role("paragraph"), number("paragraph", F.col("stretch"), F.col("paragraph"))).when(F.col("key").isNull() & is_role("beside"), number("paragraph", F.col("n")))
    )
    at = F.struct("page", "ord")
    part = F.struct(at.alias("at"), "x0", F.when(F.col("zone") == "text", F.col("key")).alias("key"), F.when(F.col("zone") == "text", F.col("said")).otherwise(text).alias("said"))
    parts = ran.withColumn("in_block", block).where("in_block is not null").select(*scope, "in_block", part.alias("part"), F.when(is_role("opens") & (F.col("n") == F.col("of_card")), at).alias("opens_at"))
    blocks = parts.groupBy(*scope, "in_block").agg(F.min("opens_at").alias("opens_at"), F.min("part.at").alias("first_at"), F.array_sort(F.collect_list("part")).alias("parts"))
    kind, none = F.col("in_block")["kind"], F.lit(None)
    by_place = F.array_sort(F.transform("parts", lambda x: F.struct(x["x0"], x["at"], x["said"])))
    blocks = blocks.withColumn("row", F.when(kind == "table_row", by_place))
    ends = F.filter(F.sequence(F.lit(0), F.size("row") - 1), lambda k: yes(k == 0) | (F.get("row", k)["x0"] - F.get("row", k - 1)["x0"] > 3.0))
    blocks = blocks.withColumn("begins", F.when(kind == "table_row", ends))
    cell = lambda k, j: F.array_join(F.transform(F.slice("row", k + 1, F.coalesce(F.get("begins", j + 1), F.size("row")) - k), lambda x: x["said"]), "\n")
    in_order = lambda rows: F.array_join(F.filter(F.transform(rows, lambda x: x["said"]), lambda t: t != ""), " ")
    held = lambda c: F.filter("parts", lambda x: x["key"] == c)
    card = F.struct(*(in_order(held(c)).alias(c) for c in CARD))
    out = blocks.select(
        *scope, F.when(kind == "field_card", F.col("opens_at")).otherwise(F.col("first_at")).alias("at"), kind.alias("type"), F.when(kind.isin("section_heading", "paragraph"), in_order("parts")).alias("text"),
        F.when(kind == "table_header", F.array(*map(F.lit, GRID_HEADER))).when(kind == "table_row", F.transform("begins", cell)).otherwise(none.cast("array<string>")).alias("cells"), F.when(kind == "field_card", card).alias("card"),
    )
    numbered = scanned(out, scope, ["at"], {"block": scan.total(F.lit(1))})
    return numbered.select(*scope, (F.col("block") - 1).cast("bigint").alias("block"), F.col("at")["page"].cast("int").alias("page"), "type", "text", "cells", "card")
