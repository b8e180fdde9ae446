import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from deltafolio.functions import similarity
from deltafolio.functions import text as T
from deltafolio.operators import bands, classify, diffing, landing, matching, reporting
from deltafolio.plans import driver
from deltafolio.sources import editions
from deltafolio.streaming import landing as stream


def test_row_bands_compare_with_the_first_line(spark):
    rows = spark.createDataFrame([([(0.0, 10.0), (2.0, 11.0), (9.0, 19.0), (20.0, 30.0)],)], "x array<struct<y0:double,y1:double>>")
    assert rows.select(bands.row_bands(F.col("x"))).first()[0] == [1, 1, 2, 3]


def test_gap_clusters(spark):
    rows = spark.createDataFrame([(1, float(v)) for v in (1, 5, 10, 17, 30)], "s int, v double")
    assert [r["cluster"] for r in bands.gap_cluster(rows, ["s"], "v", 6).orderBy("v").collect()] == [1, 1, 1, 2, 3]


def test_unique_match_takes_the_last(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, ord int")
    b = spark.createDataFrame([("x", 1), ("z", 2)], "k string, ord int")
    rows = matching.match_unique(matching.last_wins(a, ["k"], "ord"), b, ["k"]).select("k", "status", "a.ord").collect()
    assert sorted(map(tuple, rows), key=str) == [("x", "matched", 2), ("y", "removed", 3), ("z", "added", None)]


def test_serial_and_global_order(spark):
    edges = spark.createDataFrame([(1, 1, 1, 0.90), (1, 1, 2, 0.86), (1, 2, 1, 0.95)], "s int, a_ord int, b_ord int, ratio double")
    pairs = lambda mode: sorted((r["a_ord"], r["b_ord"]) for r in matching.greedy_assign(edges, ["s"], mode).collect())
    assert pairs("serial") == [(1, 1)] and pairs("global") == [(1, 2), (2, 1)]


def test_splits_and_merges(spark):
    schema = "k int, s int, e int, name string"
    removed = spark.createDataFrame([(1, 71, 168, "Reserved"), (2, 10, 20, "Reserved"), (3, 156, 168, "Foo"), (4, 1, 9, "Reserved")], schema)
    added = spark.createDataFrame([(1, 71, 78, "Payment"), (1, 120, 168, "Reserved"), (2, 12, 14, "X"), (3, 160, 168, "Reserved"), (4, 1, 3, "X"), (4, 4, 6, "Y"), (4, 7, 9, "Reserved")], schema)
    rows = {r["k"]: (r["new_fields"], r["remaining_reserved"]) for r in diffing.reserved_splits(removed, added, ["k"]).collect()}
    assert rows == {1: ("71-78 Payment", "120-168 Reserved"), 4: ("1-3 X,4-6 Y", "7-9 Reserved")}
    only = {r["k"]: (r["new_fields"], r["remaining_reserved"]) for r in diffing.reserved_splits(removed, added, ["k"], only_start=True).collect()}
    assert only[4] == ("1-3 X", "4-6 Y,7-9 Reserved")
    assert [r["k"] for r in diffing.reserved_merges(removed, added, ["k"]).collect()] == [3]


def test_position_shift_and_alignment():
    removed, added = [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")], [("5", "x"), ("6", "a"), ("7", "c"), ("8", "d")]
    assert [x[0] for x in matching.position_shift(removed, added)] == ["a", "c", "d"]
    assert matching.align(["p one", "p two"], ["p one p two"]) == [("reflowed", 0, 2, 0, 1)]


def test_similarity_fixtures():
    assert round(similarity.ratio_of("tc 01, 02, 03 - tcr 0-8, d", "tc 01, 02, 03 - tcr 0-8, d, e"), 3) == 0.945
    assert round(similarity.ratio_of("Agreement ID", "Selected Program ID"), 3) == 0.387
    old = "the quick brown fox jumps over the lazy dog " * 6
    new = old.replace("lazy", "eager", 1).replace("fox", "cat", 1)
    assert similarity.ratio_of(old, new) < 0.1 and similarity.ratio_of(old, new, autojunk=False) > 0.97
    text = "send the advice to the issuer within five business days of receipt"
    assert similarity.disappeared_of(text, "send the advice to the issuer") == ["within five business days of receipt"]
    assert similarity.disappeared_of("field must equal A or B", "field must equal A") == []


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=30), st.text("abc ", max_size=30))
def test_length_bound_is_sound(a, b):
    total = len(a) + len(b)
    assert similarity.ratio_of(a, b) <= (2 * min(len(a), len(b)) / total if total else 1.0) + 1e-12


def test_text_functions(spark):
    row = spark.createDataFrame([(" A\t b\n", "12–14", "l Is less", "20240131")], "a string, p string, t string, d string").select(
        T.key(F.col("a")), T.position(F.col("p")), T.position_rank(F.col("p")), T.without_bullets(F.col("t")), T.shown_date(F.col("d")), T.range_of(T.position(F.col("p"))), T.short(F.col("d"), 4)
    ).first()
    assert tuple(row)[:5] == ("a b", "12-14", 12, "Is less", "31/01/2024") and tuple(row[5]) == (12, 14) and row[6] == "2024…"


def test_classification_and_safety_net(spark):
    rows = spark.createDataFrame([(1, "a b", "a  B"), (2, "a b", "b a"), (3, "a", "c")], "k int, old string, new string")
    got = {r["k"]: r["ai_category"] for r in classify.classify(rows).collect()}
    assert got == {1: "extraction_noise", 2: "editorial_change", 3: "business_rule_change"}
    safe = classify.safety_net(classify.classify(rows), F.col("k") == 2).where("safety_net_override").collect()
    assert [(r["k"], r["ai_category"], r["ai_original_category"]) for r in safe] == [(2, "business_rule_change", "editorial_change")]
    calls = []

    def flaky(old, new):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "editorial_change", ""

    assert classify.with_retries(flaky, pause=0)("a", "b")[0] == "editorial_change" and len(calls) == 3


def test_relocation(spark):
    row = spark.createDataFrame([(["x y", "z"], ["has x y here"])], "c array<string>, p array<string>").select(classify.relocated(F.col("c"), F.col("p"))).first()
    assert row[0] == ["x y"]


def test_state_and_conflicts(spark):
    latest = spark.createDataFrame([("a", "2", "3"), ("b", "1", "2"), ("c", "1", "2")], "slug string, edition_a string, edition_b string")
    state = spark.createDataFrame([("a", "1", "2"), ("b", "1", "2")], "slug string, edition_a string, edition_b string")
    assert {r["slug"]: r["is_new"] for r in landing.is_new(latest, state, ["edition_a", "edition_b"]).collect()} == {"a": True, "b": False, "c": True}
    new = spark.createDataFrame([("t", "1"), ("u", "2")], "target string, digest string")
    assert [r["target"] for r in landing.conflicts(new, spark.createDataFrame([("t", "9"), ("u", "2")], "target string, digest string")).collect()] == ["t"]


def test_files_and_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "20240131 - Some Title.txt").write_text("one\ntwo")
    files = editions.editions_from_files(spark, str(tmp_path / "in"))
    assert [(r["edition"], r["title"]) for r in files.collect()] == [("20240131", "Some Title")]
    assert [r["line"] for r in editions.lines_from_files(files, lambda c: c.decode().split("\n")).orderBy("ord").collect()] == ["one", "two"]
    editions.write_report(spark.createDataFrame([("a_to_b", "x\ny")], "pair string, body string"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "pair=a_to_b").is_dir()
    html = editions.html_report(spark.createDataFrame([(1,)], "n int"), "<b>__DATA_B64__</b>").first()[0]
    import base64

    assert json.loads(base64.b64decode(html[3:-4])) == {"n": 1}


def test_stream_lands_good_batches_and_rejects_bad_ones(spark, tmp_path):
    for name, rows in (("good", [{"manual": "a", "edition": "1", "text": "x"}]), ("bad", [{"manual": "a", "edition": "1", "text": "x"}] * 3)):
        inbox = tmp_path / name
        inbox.mkdir()
        (inbox / "f.json").write_text("\n".join(map(json.dumps, rows)))
        q = stream.land(spark, str(inbox), str(tmp_path / f"corpus-{name}"), str(tmp_path / f"alerts-{name}"), str(tmp_path / f"cp-{name}"))
        assert q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "corpus-good")).count() == 1
    assert not (tmp_path / "corpus-bad").exists() and (tmp_path / "alerts-bad").exists()


def test_places_on_many_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select("l_partkey", "l_orderkey", "l_linenumber")
    placed = reporting.ranked(rows, [F.col(c) for c in rows.columns], "place")
    got = placed.agg(F.count("*").alias("n"), F.count_distinct("place").alias("d"), F.min("place").alias("lo"), F.max("place").alias("hi")).first()
    assert (got["n"], got["d"], got["lo"], got["hi"]) == (rows.count(),) * 2 + (1, rows.count())
    before = F.lag(F.struct(*rows.columns)).over(Window.partitionBy(F.floor(F.col("place") / 1000)).orderBy("place"))
    assert placed.withColumn("before", before).where(F.col("before") > F.struct(*rows.columns)).count() == 0


def frame(spark, rows, names="s int, ord int, text string"):
    return spark.createDataFrame(rows, names)


def plain_fuzzy(a, b, threshold, mode, min_length=0):
    """Equal texts by occurrence, then greedy by the standard library's ratio. a, b: [(ord, text)] of one scope."""
    from difflib import SequenceMatcher

    a, b, out = sorted(a), sorted(b), []
    for x in list(a):
        y = next((y for y in b if y[1] == x[1]), None)
        if y:
            out.append((x[0], y[0], 1.0, "exact"))
            a.remove(x)
            b.remove(y)
    edges = [(SequenceMatcher(None, x[1], y[1]).ratio(), x[0], y[0]) for x in a for y in b if min(len(x[1]), len(y[1])) >= min_length]
    edges = [e for e in edges if e[0] >= threshold]
    used = set()
    for r, x, y in sorted(edges, key=(lambda e: (e[1], -e[0], e[2])) if mode == "serial" else (lambda e: (-e[0], e[1], e[2]))):
        if ("a", x) not in used and ("b", y) not in used:
            used |= {("a", x), ("b", y)}
            out.append((x, y, r, "fuzzy"))
    return sorted(out)


def test_fuzzy_match_like_plain_search(spark):

    r = random.Random(3)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.randrange(7)))
    texts = lambda: [(s, k, word() if r.random() < 0.8 else "same") for s in range(25) for k in range(r.randrange(12))]
    a, b = texts(), texts()
    for mode in ("serial", "global"):
        for least in (0, 3):
            got = matching.fuzzy_match(frame(spark, a), frame(spark, b), ["s"], 0.6, mode, least).collect()
            for s in range(25):
                side = lambda rows: [(k, t) for x, k, t in rows if x == s]
                assert sorted((x["a_ord"], x["b_ord"], x["ratio"], x["match_type"]) for x in got if x["s"] == s) == plain_fuzzy(side(a), side(b), 0.6, mode, least)


def test_an_exact_partner_is_not_taken_by_an_earlier_row(spark):
    a, b = frame(spark, [(1, 1, "batch code A1"), (1, 2, "batch code A2")]), frame(spark, [(1, 1, "batch code A2")])
    assert [(r["a_ord"], r["match_type"]) for r in matching.fuzzy_match(a, b, ["s"]).collect()] == [(2, "exact")]


def test_character_bound_is_never_below_the_ratio():

    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdeß日 ") for _ in range(r.randrange(12)))
    old, new = [word() for _ in range(4000)], [word() for _ in range(4000)]
    bounds = similarity.character_bound(old, new)
    assert all(bounds[k] >= similarity.ratio_of(x, y) - 1e-12 for k, (x, y) in enumerate(zip(old, new)))


def test_similar_texts_are_no_change(spark):
    rows = spark.createDataFrame([(1, "x" * 20 + "the end of the list of all fields of the record", "x" * 20 + "the end of the list of all fields of the record."), (2, "a", "b"), (3, " a  b", "a b"), (4, None, "z")], "k int, old string, new string")
    assert sorted(r["k"] for r in diffing.unlike(rows).collect()) == [2, 4]
    assert sorted(r["k"] for r in diffing.unlike(rows, None).collect()) == [1, 2, 4]
    bullets = spark.createDataFrame([(1, "l Is less", "● Is less")], "k int, old string, new string")
    assert diffing.unlike(bullets, similar=T.without_bullets).collect() == []


def test_pool_and_reflow(spark):
    long = "the quick brown fox jumps over the lazy dog and runs on to the river bank"
    pairs = spark.createDataFrame([(1, ["same", long, "gone for good", "end"], ["same", "brand new text", long + "s", "end"]), (2, ["p1", "p2", "q"], ["p1 p2", "q"]), (3, [], ["x"])], "k int, old array<string>, new array<string>")
    got = {(r["k"], r["status"], r["a_from"], r["b_from"]) for r in matching.align_and_pool(pairs, ["k"]).collect()}
    assert got == {(1, "exact", 0, 0), (1, "fuzzy", 1, 2), (1, "removed", 2, None), (1, "added", None, 1), (1, "exact", 3, 3), (2, "reflowed", 0, 0), (2, "exact", 2, 1), (3, "added", 0, 0)}
    assert matching.reflowed(["a", "b", "c d"], ["a b", "c", "d"]) == [("joined", [0, 1], [0]), ("split", [2], [1, 2])]
    assert matching.reflowed(["a", "a", "a"], ["a a", "a a"]) == [("joined", [0, 1], [0])]
    flow = spark.createDataFrame([(1, ["a", "b", "c d", long, "keep"], ["a b", "c", "d", long + "s", "keep", "new"])], "k int, old array<string>, new array<string>")
    got = {(r["status"], r["a_ord"], r["b_ord"]) for r in matching.reflow_paragraphs(flow, ["k"]).collect()}
    assert got == {("joined", 0, 0), ("joined", 1, 0), ("split", 2, 1), ("split", 2, 2), ("fuzzy", 3, 3), ("exact", 4, 4), ("added", None, 5)}


def test_nearest_band_like_all_pairs(spark):

    r = random.Random(4)
    rows = [(r.randrange(3), k, float(r.randrange(40))) for k in range(80)]
    marks = [(r.randrange(2), float(r.randrange(40)), chr(97 + r.randrange(26)), k) for k in range(20)]
    got = bands.nearest(spark.createDataFrame(rows, "s int, k int, v double"), spark.createDataFrame(marks, "s int, at double, tie string, n int"), ["s"], "v", "at", "tie").collect()
    for s, k, v in rows:
        best = min(((abs(v - at), tie, at, n) for x, at, tie, n in marks if x == s), default=None)
        found = [(x["tie"], x["at"]) for x in got if x["k"] == k]
        assert found == ([(best[1], best[2])] if best else []), (s, k, v)


def test_leaders(spark):
    row = spark.createDataFrame([([1.0, 10.0, 16.0, 17.0, 40.0],)], "v array<double>")
    assert row.select(bands.leaders(F.col("v"), 15.0)).first()[0] == [1.0, 1.0, 1.0, 17.0, 40.0]


def test_judged_changes(spark):
    gone = "send the advice to the issuer within five business days of receipt"
    rows = [("content", gone, "send the advice to the issuer", ["elsewhere"]), ("content", gone, "send the advice to the issuer", ["now within five business days of receipt, always"]), ("content", "a B", "a b", []), ("added", None, "x", [])]
    df = spark.createDataFrame(rows, "change_type string, old string, new string, context array<string>")
    call = lambda old, new: ("nonsense", "why") if old == "a B" else ("editorial_change", "shorter")
    got = classify.judged(df, ["content"], call, "context").collect()
    assert sorted((r["ai_category"], r["safety_net_override"], r["ai_reason"]) for r in got if r["change_type"] == "content") == [
        ("business_rule_change", True, "shorter"), ("editorial_change", False, "shorter"), ("extraction_noise", False, "unknown category nonsense: why")]
    assert [r["ai_category"] for r in got if r["change_type"] == "added"] == [None]
    assert {(r["ai_category"], r["n"]) for r in classify.category_summary(classify.judged(df, ["content"], call), ["change_type"]).collect()} == {("business_rule_change", 2), ("extraction_noise", 1)}
    assert similarity.disappeared_of("l one two l three four five", "x", bullets=frozenset("l")) == ["one two three four five"]
    assert similarity.removed_values_of("field must equal A or B", "field must equal A") == ["or B"]


def test_uncovered_lines(spark):
    old, new = "members must send the advice within five days\nshort", "members should send the advice within five days\nan entirely different obligation applies here"
    row = spark.createDataFrame([(old, new)], "old string, new string").select(classify.uncovered_lines(F.col("old"), F.col("new")), classify.uncovered_lines(F.col("new"), F.col("old")), classify.downgraded(F.lit("high"), F.col("old"), F.col("new"))).first()
    assert list(row) == [[], ["an entirely different obligation applies here"], "low"]


def test_prompts_and_model_service(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    import pytest

    row = spark.createDataFrame([("a", None)], "old string, new string").select(classify.prompt("Old: {old}\nNew: {new} {{}}", old=F.col("old"), new=F.col("new"))).first()[0]
    assert row.startswith("Old: a\nNew:  ")

    class Service(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"category": "editorial_change", "reason": asked["prompt"]}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/"
    classify.check_service(url)
    call = classify.http_classifier(url, lambda old, new: {"prompt": f"{old}>{new}"}, lambda reply: (reply["category"], reply["reason"]))
    assert call("x", "y") == ("editorial_change", "x>y")
    server.shutdown()
    server.server_close()
    with pytest.raises(RuntimeError, match="no answer"):
        classify.check_service(url, timeout=1)


def test_documents_state_and_index(spark, tmp_path):
    import pytest

    rows = spark.createDataFrame([("m", "1", "x")], "manual string, pair string, text string")
    editions.write_documents(rows, f"{tmp_path}/docs", "manual")
    assert editions.read_documents(spark, f"{tmp_path}/docs", "manual string, pair string, text string").select("manual", "pair", "text").collect() == rows.collect()
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        editions.read_documents(spark, f"{tmp_path}/none", "text string")
    legacy = tmp_path / "state.json"
    legacy.write_text(json.dumps({"a": {"edition_a": "1", "edition_b": "2"}}))
    path = f"{tmp_path}/state"
    assert editions.load_state(spark, path).collect() == []
    old = editions.load_state(spark, path, str(legacy))
    assert [tuple(r) for r in old.collect()] == [("a", "1", "2")]
    editions.save_state(old, path, str(legacy))
    assert not legacy.exists()
    editions.save_state(spark.createDataFrame([("b", "3", "4")], "slug string, edition_a string, edition_b string"), path)
    assert sorted(map(tuple, editions.load_state(spark, path).collect())) == [("a", "1", "2"), ("b", "3", "4")]
    editions.write_index(spark.createDataFrame([("p1", "- one"), ("p2", "- two")], "pair string, line string"), f"{tmp_path}/index", "All")
    assert [p.read_text() for p in (tmp_path / "index").glob("part-*")] == ["# All\n- two\n- one\n"]


def test_files_move_only_where_nothing_is(spark, tmp_path):
    import pytest

    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    (tmp_path / "taken").write_text("x")
    with pytest.raises(FileExistsError):
        editions.move_files(spark, [(f"{tmp_path}/a", f"{tmp_path}/corpus/a"), (f"{tmp_path}/b", f"{tmp_path}/taken")])
    assert (tmp_path / "a").exists()
    editions.move_files(spark, [(f"{tmp_path}/a", f"{tmp_path}/corpus/a")])
    assert (tmp_path / "corpus" / "a").read_text() == "a" and not (tmp_path / "a").exists()
    editions.write_alert(spark.createDataFrame([("m", "size"), ("n", "ok")], "manual string, verdict string"), f"{tmp_path}/alerts")
    assert "".join(p.read_text() for p in (tmp_path / "alerts").glob("part-*")).strip().endswith(" m: size")


def test_html_report_holds_its_data(spark):
    import base64
    import re

    html = editions.html_report(spark.createDataFrame([("ü", 3)], "manual string, headline int")).first()["html"]
    data = re.search(r'atob\("([^"]*)"\)', html)[1]
    assert json.loads(base64.b64decode(data)) == {"manual": "ü", "headline": 3}


def test_stages_run_in_order_and_stop_at_a_failure():
    import pytest

    from deltafolio.plans import stages as S

    seen = []

    def step(name, fail=False):
        def run(manual, before, **options):
            if fail:
                raise ValueError("broken")
            seen.append((manual, name, before, options))
            return name

        return run

    own = [S.Stage("07", "report", step("report")), S.Stage("03", "match", step("match")), S.Stage("05", "judge", step("judge"))]
    assert [x[:3] for x in S.run_manual("m", own, only="p")] == [("m", "match", True), ("m", "judge", True), ("m", "report", True)]
    assert seen == [("m", "match", None, {"only": "p"}), ("m", "judge", "match", {"only": "p"}), ("m", "report", "judge", {"only": "p"})]
    assert [s.name for s in S.chosen(own, "04", "07", skip_ai=True)] == ["report"]
    bad = [S.Stage("01", "read", step("read", fail=True)), S.Stage("02", "next", step("next"))]
    got = S.run_all({"x": bad, "y": own[:1]})
    assert [(o.manual, o.stage, o.ok) for o in got] == [("x", "read", False), ("y", "report", True)] and "broken" in got[0].error
    with pytest.raises(ValueError):
        S.chosen([own[0], own[0]])


def test_pair_driver_from_blocks_to_reports(spark):
    def edition(date, *blocks):
        return [("m", date, k, *b) for k, b in enumerate(blocks)]

    head, row = (lambda t: ("section_heading", t, [])), (lambda *c: ("table_row", "", list(c)))
    rows = edition("20240101", ("paragraph", "intro", []), head("Transaction codes"), row("a1", "Purchase of goods"), row("b2", "Refund"), head("Old part"), row("z", "y"))
    rows += edition("20240601", head("Transaction Codes"), row("A1", "Purchase of services"), row("c3", "New"), head("Annex"), row("q", "w"))
    rows += edition("20250101", head("Transaction Code"), row("A1", "Purchase of services"), row("c3", "New"), head("Annex"), row("q", "w"))
    blocks = spark.createDataFrame(rows, "manual string, edition string, ord int, type string, text string, cells array<string>")
    got = {(r["pair"], r["change_type"], r["title"], r["key"]) for r in driver.changes(blocks).collect()}
    first = "20240101_to_20240601"
    assert got == {(first, "section_removed", "Old part", None), (first, "section_added", "Annex", None), (first, "row_content_changed", "Transaction Codes", "A1"), (first, "row_removed", "Transaction Codes", "B2"), (first, "row_added", "Transaction Codes", "C3"), ("20240601_to_20250101", "section_renamed", "Transaction Code", None)}
    body = driver.reports(driver.judged_changes(blocks)).first()["body"].split("\n")
    assert body[0] == "- row_content_changed Transaction Codes A1 1: Purchase of goods -> Purchase of services" and len(body) == 5


def test_a_single_file_needs_an_older_edition(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put = lambda name, *rows: (inbox / name).write_text("\n".join(json.dumps({"manual": m, "edition": e, "text": "t"}) for m, e in rows))
    run = lambda: stream.land(spark, str(inbox), f"{tmp_path}/corpus", f"{tmp_path}/alerts", f"{tmp_path}/state", older_needed=True).awaitTermination()
    put("1.json", ("m", "20240101"), ("m", "20240601"))
    run()
    put("2.json", ("m", "20250101"))
    run()
    put("3.json", ("n", "20250101"))
    run()
    put("4.json", ("m", "20230101"))
    run()
    assert sorted(r["edition"] for r in spark.read.parquet(f"{tmp_path}/corpus").collect()) == ["20240101", "20240601", "20250101"]
    assert sorted((r["manual"], r["verdict"]) for r in spark.read.json(f"{tmp_path}/alerts").collect()) == [("m", "no older edition"), ("n", "no older edition")]


def test_all_events_of_a_pair(spark):
    """Renames, duplicates, moves, reserved names and paragraphs, next to rows and sections."""
    long = "the amount of the fee that a member pays for each transaction of this kind is set out "
    old = {"Fees": ["R|a1|Reserved", "R|a2|Name", "R|a3|x", "R|a3|y", "P|one", "P|gone", "P|s0", "P|same", "P|same", "P|s1", "P|alpha beta", "P|gamma", "P|s2", "P|" + long + "below", "P|s3"], "Interchange fees": ["R|k|v"], "Moved away": ["P|m1", "P|m2", "P|m3"], "Lost": ["P|z"]}
    new = {"Fees": ["R|a1|Amount", "R|a2|reserved ", "R|a3|y", "R|b|new", "P|one", "P|s0", "P|same", "P|s1", "P|alpha", "P|beta gamma", "P|s2", "P|" + long + "above", "P|s3", "P|come"], "Interchange fee": ["R|k|w"], "Elsewhere": ["P|M1", "P|m2", "P|m3"]}
    rows = []
    for edition, sections in (("20240101", old), ("20240601", new)):
        n = 0
        for title, parts in sections.items():
            for part in ["H|" + title, *parts]:
                kind, _, rest = part.partition("|")
                rows.append(("m", edition, n, {"H": "section_heading", "R": "table_row", "P": "paragraph"}[kind], "" if kind == "R" else rest, rest.split("|") if kind == "R" else []))
                n += 1
    blocks = spark.createDataFrame(rows, "manual string, edition string, ord int, type string, text string, cells array<string>")
    got = sorted((tuple(r) for r in driver.changes(blocks, name_index=1).drop("manual", "pair").collect()), key=str)
    row = lambda kind, title, key=None, at=None, a=None, b=None: (kind, title, key, at, a, b)
    assert got == sorted([
        row("section_renamed", "Interchange fee", None, None, "Interchange fees", "Interchange fee"), row("section_removed", "Moved away"), row("section_removed", "Lost"), row("section_added", "Elsewhere"),
        row("possible_section_move", "Elsewhere", None, None, "Moved away", "Elsewhere"), row("row_content_changed", "Interchange fee", "K", 1, "v", "w"),
        row("field_became_defined", "Fees", "A1", None, "a1 | Reserved", "a1 | Amount"), row("field_became_reserved", "Fees", "A2", None, "a2 | Name", "a2 | reserved "), row("row_added", "Fees", "B", None, None, "b | new"),
        row("duplicate_key_warning", "Fees", None, None, "A3", ""), row("duplicate_paragraph_warning", "Fees", None, None, "same", ""),
        row("paragraph_removed", "Fees", None, None, "gone", None), row("paragraph_removed", "Fees", None, None, "same", None), row("paragraph_added", "Fees", None, None, None, "come"),
        row("paragraph_reflowed", "Fees", None, None, "alpha beta gamma", "alpha beta gamma"), row("paragraph_content_changed", "Fees", None, None, long + "below", long + "above")], key=str)


def test_relocations_like_plain_search(spark):
    r = random.Random(6)
    words = ["fee", "rate", "the", "of", "Card", "ACQUIRER", "part", "partly", "é"]
    text = lambda n: "  ".join(r.choice(words) for _ in range(n))
    paragraphs = [(r.choice([1, 2, None]), text(r.randint(0, 12))) for _ in range(60)] + [(1, None), (1, "")]
    events = [(k, r.choice([1, 2, 3, None]), [r.choice([text(r.randint(1, 5)), "", None, "he of", "art"]) for _ in range(r.randint(0, 4))], "clash") for k in range(120)] + [(500, 1, None, "clash")]
    key = lambda t: " ".join((t or "").lower().split())
    want = {}
    for k, s, chunks, _ in events:
        held = [key(p) for q, p in paragraphs if s is not None and q == s]
        told = [c for c in chunks or [] if key(c)]
        moved = [c for c in told if any(key(c) in p for p in held)]
        want[k] = (moved, [c for c in told if c not in moved])
    E = spark.createDataFrame(events, "k int, s int, disappeared_content array<string>, event_no string").repartition(4)
    P = spark.createDataFrame(paragraphs, "s int, text string")
    got = classify.relocations(E, P, ["s"])
    assert got.columns == [*E.columns, "relocated_content"]
    assert {x["k"]: (x["relocated_content"], x["disappeared_content"]) for x in got.collect()} == want and any(m for m, _ in want.values())
    assert classify.relocations(E.limit(0), P, ["s"]).count() == 0


@pytest.mark.parametrize("limit", [128 << 20, 0])
def test_titles_wait_at_their_rarest_word(spark, monkeypatch, limit):
    r = random.Random(9)
    words = ["the"] * 5 + [f"w{k}" for k in range(30)]
    docs = [(k, sorted({r.choice(words) for _ in range(r.randint(0, 20))})) for k in range(150)] + [(900, None), (901, [])]
    titles = [(k, sorted({r.choice(words) for _ in range(r.randint(1, 4))})) for k in range(40)] + [(99, [])]
    want = {}
    for k, tokens in docs:
        held = [s for s, need in titles if need and set(need) <= set(tokens or [])]
        if len(held) == 1:
            want[k] = held[0]
    monkeypatch.setattr(landing, "fits", lambda df: limit > 0)
    got = landing.detect_titles(spark.createDataFrame(docs, "doc_id int, tokens array<string>"), spark.createDataFrame(titles, "slug int, tokens array<string>"))
    assert {x["doc_id"]: x["slug"] for x in got.collect()} == want and want


def test_paragraph_events_find_their_texts_by_place(spark):
    """Each event takes the texts of its own paragraphs: no row of an event holds all paragraphs of its section."""
    long = "the amount of the fee that a member pays for each transaction of this kind is set out below in full"
    old = ["Kept", "One  two", "Three", "Between", long, "Kept too", *(f"Gone {k}" for k in range(3)), "End"]
    new = ["Kept", "One two three", "Between", long + " x", "Kept too", "End", *(f"New  {k}" for k in range(2))]
    rows = [("m", e, 0, "section_heading", "Title", None) for e in ("1", "2")]
    rows += [("m", e, k + 1, "paragraph", t, None) for e, side in (("1", old), ("2", new)) for k, t in enumerate(side)]
    blocks = spark.createDataFrame(rows, "manual string, edition string, ord long, type string, text string, cells array<string>")
    found = driver.changes(blocks)
    assert not [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "slice(" in line]
    assert sorted(tuple(r)[2:] for r in found.select("manual", "pair", "change_type", "old", "new").collect()) == [
        ("paragraph_added", None, "New  0"), ("paragraph_added", None, "New  1"), ("paragraph_content_changed", long, long + " x"), ("paragraph_reflowed", "One  two Three", "One two three"),
        *(("paragraph_removed", f"Gone {k}", None) for k in range(3)),
    ]
