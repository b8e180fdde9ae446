"""Registered queries of the edition-change operators over the driver's tables, each with its SQL where SQL has a form.

Two editions of a keyed table: A is the rows whose key is no multiple of 10, B those whose key is not 1 modulo 10, with the
compared value altered where the key is a multiple of 7.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import disappeared, length_bound, ratio
from ..operators import assembly, bands, cards, classify, containers, diffing, flows, folding, landing, matching, noise, pages, reporting, spans, tables
from . import driver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*cols) if cols else df


# ---- editions of tables -------------------------------------------------------------------------------------------------


def customers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.where("k % 10 <> 0"), c.where("k % 10 <> 1").withColumn("segment", F.when(F.col("k") % 7 == 0, F.concat("segment", F.lit(" REVISED"))).otherwise(F.col("segment")))


_C = """a AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey % 10 <> 0),
     b AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || ' REVISED' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 10 <> 1)"""
_LOG = f"""{_C}, change_log AS (
    SELECT 'added' AS change_type, b.k AS k, NULL AS old, b.segment AS new FROM b LEFT JOIN a USING (k) WHERE a.k IS NULL
    UNION ALL SELECT 'removed', a.k, a.segment, NULL FROM a LEFT JOIN b USING (k) WHERE b.k IS NULL
    UNION ALL SELECT 'content_changed', a.k, a.segment, b.segment FROM a JOIN b USING (k) WHERE a.segment <> b.segment)"""


def log_of(spark: SparkSession, d: str) -> DataFrame:
    m = matching.match_unique(*customers(spark, d), ["k"])
    plain = m.where("status <> 'matched'").select(F.col("status").alias("change_type"), "k", F.col("a.segment").alias("old"), F.col("b.segment").alias("new"))
    content = diffing.field_diff(m.where("status = 'matched'"), ["k"], ["name", "segment"]).select(F.lit("content_changed").alias("change_type"), "k", "old", "new")
    return plain.unionByName(content)


@query(f"WITH {_C} SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'matched' END AS status, a.segment AS old, b.segment AS new FROM a FULL JOIN b ON a.k = b.k")
def match_unique(spark, d):
    return matching.match_unique(*customers(spark, d), ["k"]).select("k", "status", F.col("a.segment").alias("old"), F.col("b.segment").alias("new"))


def order_editions(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus").toDF("ord", "cust", "priority", "state")
    return o.where("ord % 10 <> 0"), o.where("ord % 10 <> 1")


_O = """a AS (SELECT o_orderkey AS ord, o_custkey AS cust, o_orderpriority AS priority, o_orderstatus AS state FROM orders WHERE o_orderkey % 10 <> 0),
     b AS (SELECT o_orderkey AS ord, o_custkey AS cust, o_orderpriority AS priority, o_orderstatus AS state FROM orders WHERE o_orderkey % 10 <> 1)"""


@query(f"""WITH {_O}, la AS (SELECT cust, priority, max(ord) AS ord FROM a GROUP BY ALL), lb AS (SELECT cust, priority, max(ord) AS ord FROM b GROUP BY ALL)
SELECT cust, priority, la.ord AS a_ord, lb.ord AS b_ord, CASE WHEN la.ord IS NULL THEN 'added' WHEN lb.ord IS NULL THEN 'removed' ELSE 'matched' END AS status FROM la FULL JOIN lb USING (cust, priority)""")
def match_unique_last_wins(spark, d):
    a, b = (matching.last_wins(x.select("cust", "priority", "ord"), ["cust", "priority"], "ord") for x in order_editions(spark, d))
    return matching.match_unique(a, b, ["cust", "priority"]).select("cust", "priority", F.col("a.ord").alias("a_ord"), F.col("b.ord").alias("b_ord"), "status")


@query(f"""WITH {_O}, ra AS (SELECT *, row_number() OVER (PARTITION BY cust, priority ORDER BY ord) AS n FROM a), rb AS (SELECT *, row_number() OVER (PARTITION BY cust, priority ORDER BY ord) AS n FROM b)
SELECT cust, priority, CAST(n AS BIGINT) AS nth, ra.ord AS a_ord, rb.ord AS b_ord FROM ra FULL JOIN rb USING (cust, priority, n)""")
def match_occurrence(spark, d):
    a, b = (x.select("cust", "priority", "ord") for x in order_editions(spark, d))
    return matching.match_occurrence(a, b, ["cust", "priority"], ["ord"]).select("cust", "priority", F.col("nth").cast("long").alias("nth"), F.col("a.ord").alias("a_ord"), F.col("b.ord").alias("b_ord"))


@query(f"WITH {_LOG} SELECT * FROM change_log")
def change_log(spark, d):
    return log_of(spark, d)


@query(f"WITH {_LOG} SELECT change_type, count(*) AS n FROM change_log GROUP BY ALL")
def change_summary(spark, d):
    return log_of(spark, d).groupBy("change_type").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS edition FROM events), p AS (SELECT edition AS edition_a, lead(edition) OVER (ORDER BY edition) AS edition_b FROM e)
SELECT edition_a, edition_b, edition_a || '_to_' || edition_b AS pair FROM p WHERE edition_b IS NOT NULL""")
def edition_pairs(spark, d):
    return landing.edition_pairs(read(spark, d, "events", "ts").select(F.lit("events").alias("manual"), F.date_format("ts", "yyyyMMdd").alias("edition"))).select("edition_a", "edition_b", "pair")


@query("""WITH f AS (SELECT p_partkey AS k, unnest(['p_name', 'p_brand', 'p_size']) AS field, unnest([p_name, p_brand, CAST(p_size AS VARCHAR)]) AS old,
  unnest([CASE WHEN p_partkey % 7 = 0 THEN 'new ' || p_name ELSE p_name END, p_brand, CASE WHEN p_partkey % 11 = 0 THEN CAST(p_size + 1 AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END]) AS new FROM part)
SELECT * FROM f WHERE old <> new""")
def field_diff(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size").withColumnRenamed("p_partkey", "k")
    b = p.withColumns({"p_name": F.when(F.col("k") % 7 == 0, F.concat(F.lit("new "), "p_name")).otherwise(F.col("p_name")), "p_size": F.when(F.col("k") % 11 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))})
    return diffing.field_diff(matching.match_unique(p, b, ["k"]), ["k"], ["p_name", "p_brand", "p_size"]).drop("similarity_ratio")


@query("""WITH x AS (SELECT event_id AS k, unnest(['type', 'user', 'extra']) AS name, unnest([event_type, CAST(user_id AS VARCHAR), '']) AS old,
  unnest([CASE WHEN event_id % 7 = 0 THEN 'changed' ELSE event_type END, CAST(user_id AS VARCHAR), CASE WHEN event_id % 5 = 0 THEN 'x' ELSE '' END]) AS new FROM events) SELECT * FROM x WHERE old <> new""")
def map_column_diff(spark, d):
    e = read(spark, d, "events", "event_id", "event_type", "user_id")
    user = F.col("user_id").cast("string")
    a = F.create_map(F.lit("type"), F.col("event_type"), F.lit("user"), user)
    b = F.create_map(F.lit("type"), F.when(F.col("event_id") % 7 == 0, "changed").otherwise(F.col("event_type")), F.lit("user"), user)
    b = F.when(F.col("event_id") % 5 == 0, F.map_concat(b, F.create_map(F.lit("extra"), F.lit("x")))).otherwise(b)
    return diffing.map_diff(e.select(F.col("event_id").alias("k"), a.alias("a"), b.alias("b")), ["k"], skip=(assembly.PREFIX,)).drop("similarity_ratio")


_LINES = """l AS (SELECT doc_id, CAST(n - 1 AS BIGINT) AS ord, lines[n] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS n))"""


def doc_lines_of(spark, d):
    from ..sources.editions import lines_from_text

    return lines_from_text(read(spark, d, "documents", "doc_id", "text"))


@query(f"WITH {_LINES} SELECT doc_id, ord, line, 'p0_b0_l' || ord AS line_id FROM l")
def doc_lines(spark, d):
    return doc_lines_of(spark, d).withColumn("line_id", F.concat(F.lit("p0_b0_l"), F.col("ord").cast("string")))


@query(f"WITH {_LINES} SELECT doc_id, count(*) AS kept FROM l WHERE length(line) >= 20 AND NOT regexp_matches(line, '(\\. ){{4,}}') AND NOT regexp_matches(trim(line, ' '), '^[0-9]{{1,4}}$') GROUP BY doc_id")
def noise_filter(spark, d):
    line = F.col("line")
    return doc_lines_of(spark, d).where((F.length(line) >= 20) & ~noise.dot_leader(line) & ~noise.page_number(line)).groupBy("doc_id").agg(F.count("*").alias("kept"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 10 AS y0, l_quantity * 10 + 9 AS y1, CASE WHEN l_partkey % 5 = 0 THEN 'Intro . . . . . 7' ELSE 'text' END AS t FROM lineitem) SELECT l_orderkey, count(*) AS kept FROM x WHERE NOT (y1 <= 60 OR y0 >= 450) AND NOT contains(t, '. . . . ') GROUP BY 1""")
def page_furniture(spark, d):
    y = F.col("l_quantity") * 10
    text = F.when(F.col("l_partkey") % 5 == 0, "Intro . . . . . 7").otherwise("text")
    return read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity").where(~noise.furniture(y, y + 9, text, 60, 450)).groupBy("l_orderkey").agg(F.count("*").alias("kept"))


@query(f"""WITH {_LINES}, c AS (SELECT doc_id, ord, lower(trim(regexp_replace(line, '[ \\t\\n\\r]+', ' ', 'g'), ' ')) AS t FROM l) SELECT doc_id, ord FROM c WHERE t = '' OR t = 'all rights reserved.' OR regexp_matches(t, '^[0-9]+$') OR regexp_matches(t, '^[ivxlcdm]+$') OR contains(t, 'licensed')
OR regexp_matches(t, '^(january|february|march|april|may|june|july|august|september|october|november|december) [0-9]{{4}}$')""")
def guide_noise(spark, d):
    return doc_lines_of(spark, d).where(noise.guide_noise(F.col("line"), ["All rights reserved."], "licensed")).select("doc_id", "ord")


@query(f"WITH {_LINES}, p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY ord) AS before FROM l) SELECT doc_id, ord FROM p WHERE NOT contains(line, '|') AND NOT coalesce(contains(before, '|') AND length(line) < 40, false) AND NOT contains(line, '$$$')")
def continued_lag_noise(spark, d):
    line = F.col("line")
    return noise.without_running_headers(doc_lines_of(spark, d), ["doc_id"], ["ord"], F.contains(line, F.lit("|")), F.length(line) < 40, F.contains(line, F.lit("$$$"))).select("doc_id", "ord")


@query("SELECT doc_id, md5(lower(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'), ' '))) AS key_md5 FROM documents")
def normalize_keys(spark, d):
    return read(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(T.key(F.col("text"))).alias("key_md5"))


@query("""SELECT p_partkey AS k, upper(p_name) AS code, lower(replace(p_name, ' ', ' ') || ' ' || p_type) AS card, lower(p_type) AS title FROM part""")
def key_variants(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_type")
    card, title = F.concat(F.replace("p_name", F.lit(" "), F.lit(" – ")), F.lit("‐"), "p_type"), F.concat(F.lit(" Note: "), "p_type")
    return p.select(F.col("p_partkey").alias("k"), T.code(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("code"), T.card_name(card).alias("card"), T.without_note(title).alias("title"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER w AS n, CASE WHEN l_extendedprice - lag(l_extendedprice) OVER w > 5000 THEN 1 ELSE 0 END AS opens FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_linenumber))
SELECT l_orderkey, l_linenumber, CAST(1 + sum(opens) OVER (PARTITION BY l_orderkey ORDER BY n) AS BIGINT) AS cluster FROM r""")
def gap_cluster(spark, d):
    return bands.gap_cluster(read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], "l_extendedprice", 5000, ["l_linenumber"]).select("l_orderkey", "l_linenumber", "cluster")


@query("""WITH r AS (SELECT event_id, user_id, epoch(ts) AS t, row_number() OVER w AS n, CASE WHEN floor(epoch(ts)) - floor(lag(epoch(ts)) OVER w) > 3600 THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id))
SELECT event_id, user_id, CAST(1 + sum(opens) OVER (PARTITION BY user_id ORDER BY n) AS BIGINT) AS cluster FROM r""")
def sessionize_gap(spark, d):
    e = read(spark, d, "events", "event_id", "user_id", "ts").withColumn("t", F.unix_timestamp("ts"))
    return bands.gap_cluster(e, ["user_id"], "t", 3600, ["event_id"]).select("event_id", "user_id", "cluster")


@query("""WITH RECURSIVE x AS (SELECT l_orderkey AS k, l_quantity * 2 AS y0, l_quantity * 2 + 9 AS y1, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity * 2, l_linenumber) AS n FROM lineitem),
f AS (SELECT k, n, y0, y1, 1 AS band FROM x WHERE n = 1 UNION ALL SELECT x.k, x.n, CASE WHEN least(f.y1, x.y1) - greatest(f.y0, x.y0) > 0.5 * least(f.y1 - f.y0, x.y1 - x.y0) THEN f.y0 ELSE x.y0 END, CASE WHEN least(f.y1, x.y1) - greatest(f.y0, x.y0) > 0.5 * least(f.y1 - f.y0, x.y1 - x.y0) THEN f.y1 ELSE x.y1 END, CASE WHEN least(f.y1, x.y1) - greatest(f.y0, x.y0) > 0.5 * least(f.y1 - f.y0, x.y1 - x.y0) THEN f.band ELSE f.band + 1 END FROM f JOIN x ON x.k = f.k AND x.n = f.n + 1)
SELECT k AS l_orderkey, string_agg(CAST(band AS VARCHAR), ',' ORDER BY n) AS bands FROM f GROUP BY k""")
def row_band_fold(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select("l_orderkey", F.struct((F.col("l_quantity") * 2).alias("y0"), F.col("l_linenumber").alias("n"), (F.col("l_quantity") * 2 + 9).alias("y1")).alias("x"))
    rows = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("lines"))
    return rows.select("l_orderkey", F.array_join(bands.row_bands(F.transform("lines", lambda x: F.struct(x["y0"].cast("double").alias("y0"), x["y1"].cast("double").alias("y1")))), ",").alias("bands"))


@query("""WITH RECURSIVE x AS (SELECT l_orderkey AS k, l_quantity AS x0, CAST(l_linenumber AS VARCHAR) AS t, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, CAST(l_linenumber AS VARCHAR)) AS n FROM lineitem),
f AS (SELECT k, n, x0, t AS cells FROM x WHERE n = 1 UNION ALL SELECT x.k, x.n, CASE WHEN abs(x.x0 - f.x0) <= 3 THEN f.x0 ELSE x.x0 END, f.cells || CASE WHEN abs(x.x0 - f.x0) <= 3 THEN chr(10) ELSE '|' END || x.t FROM f JOIN x ON x.k = f.k AND x.n = f.n + 1)
SELECT k AS l_orderkey, arg_max(cells, n) AS cells FROM f GROUP BY k""")
def cell_merge_fold(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select("l_orderkey", F.struct(F.col("l_quantity").cast("double").alias("x0"), F.col("l_linenumber").cast("string").alias("text")).alias("x"))
    return li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("cells")).select("l_orderkey", F.array_join(bands.merged_cells(F.col("cells"), 3.0), "|").alias("cells"))


@query("""WITH t AS (SELECT page_id, regexp_extract_all(html, '(?s)<(h1|h2|h3|p|li|title)[^>]*>([^<]*)<', 1) AS tags, regexp_extract_all(html, '(?s)<(h1|h2|h3|p|li|title)[^>]*>([^<]*)<', 2) AS texts FROM pages)
SELECT page_id, CAST(n - 1 AS BIGINT) AS ord, tags[n] AS tag, texts[n] AS text FROM t, LATERAL (SELECT unnest(range(1, len(tags) + 1)) AS n)""")
def html_blocks(spark, d):
    from ..sources.editions import blocks_from_html

    return blocks_from_html(read(spark, d, "pages", "page_id", "html"))


_H = """h AS (SELECT doc_id, ord, line, CASE WHEN ord % 11 = 0 THEN 1 WHEN ord % 5 = 0 THEN 2 WHEN ord % 3 = 0 THEN 3 ELSE 4 END AS level FROM l)"""


def levelled(spark, d):
    o = F.col("ord")
    return doc_lines_of(spark, d).withColumn("level", F.when(o % 11 == 0, 1).when(o % 5 == 0, 2).when(o % 3 == 0, 3).otherwise(4))


@query(f"WITH {_LINES}, {_H} SELECT doc_id, ord, CAST(sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS section FROM h")
def section_ord(spark, d):
    return containers.section_ord(levelled(spark, d), ["doc_id"], F.col("level") == 1).select("doc_id", "ord", "section")


@query(f"""WITH {_LINES}, {_H}, g AS (SELECT *, sum(CASE WHEN level < 1 THEN 1 ELSE 0 END) OVER w AS g1, sum(CASE WHEN level < 2 THEN 1 ELSE 0 END) OVER w AS g2, sum(CASE WHEN level < 3 THEN 1 ELSE 0 END) OVER w AS g3 FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
p AS (SELECT doc_id, ord, max(CASE WHEN level = 1 THEN ord END) OVER (PARTITION BY doc_id, g1 ORDER BY ord) AS p1, max(CASE WHEN level = 2 THEN ord END) OVER (PARTITION BY doc_id, g2 ORDER BY ord) AS p2, max(CASE WHEN level = 3 THEN ord END) OVER (PARTITION BY doc_id, g3 ORDER BY ord) AS p3 FROM g)
SELECT doc_id, ord, concat_ws(' > ', p1, p2, p3) AS path FROM p""")
def heading_path(spark, d):
    return containers.heading_path(levelled(spark, d).withColumn("name", F.col("ord").cast("string")), ["doc_id"], "level", "name").select("doc_id", "ord", "path")


@query("""WITH b AS (SELECT p_brand, min(p_retailprice) AS m, p_type FROM part GROUP BY p_brand, p_type), c AS (SELECT p_partkey, p_brand, p_retailprice FROM part),
j AS (SELECT p_partkey, b.p_type, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(p_retailprice - m), b.p_type) AS n FROM c JOIN b USING (p_brand)) SELECT p_partkey, p_type AS band FROM j WHERE n = 1""")
def nearest_band(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_retailprice", "p_type")
    b = p.groupBy("p_brand", "p_type").agg(F.min("p_retailprice").alias("m")).withColumnRenamed("p_type", "band")
    return bands.nearest(p.drop("p_type"), b, ["p_brand"], "p_retailprice", "m", "band").select("p_partkey", "band")


def event_sides(spark, d):
    e = read(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    kinds = e.agg(F.min("event_type").alias("k"))
    marks = e.join(F.broadcast(kinds), F.col("event_type") == F.col("k")).groupBy("user_id", "ts").agg(F.max("event_id").alias("mark"))
    return e.join(F.broadcast(kinds), F.col("event_type") != F.col("k")).select("user_id", "ts", "event_id"), marks


_E = """k AS (SELECT min(event_type) AS k FROM events), r AS (SELECT event_id, user_id, ts FROM events, k WHERE event_type <> k.k), m AS (SELECT user_id, ts, max(event_id) AS mark FROM events, k WHERE event_type = k.k GROUP BY user_id, ts)"""


@query(f"WITH {_E} SELECT r.event_id, m.mark FROM r ASOF LEFT JOIN m ON r.user_id = m.user_id AND r.ts >= m.ts")
def zone_asof_backward(spark, d):
    return bands.asof(*event_sides(spark, d), ["user_id"], "ts", "ts", "mark").select("event_id", "mark")


@query(f"WITH {_E} SELECT r.event_id, m.mark FROM r ASOF LEFT JOIN m ON r.user_id = m.user_id AND r.ts <= m.ts")
def zone_asof_forward(spark, d):
    return bands.asof(*event_sides(spark, d), ["user_id"], "ts", "ts", "mark", forward=True).select("event_id", "mark")


@query("""WITH t AS (SELECT n_nationkey AS s, 50 + 90 * r_regionkey AS p, chr(CAST(97 + r_regionkey AS INTEGER)) AS a FROM nation, region WHERE n_nationkey < 7), r AS (SELECT s, a, p, coalesce(lead(p) OVER (PARTITION BY s ORDER BY p) - 1, 480) AS e FROM t UNION ALL SELECT s, 'front_matter', 1, min(p) - 1 FROM t GROUP BY s),
o AS (SELECT o_orderkey, o_custkey % 7 AS s, o_orderkey % 500 + 1 AS page FROM orders) SELECT o_orderkey, coalesce(r.a, 'unassigned') AS name FROM o LEFT JOIN r ON o.s = r.s AND page BETWEEN p AND e""")
def page_range_lookup(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_custkey").select("o_orderkey", (F.col("o_custkey") % 7).alias("s"), (F.col("o_orderkey") % 500 + 1).alias("page"))
    manuals = read(spark, d, "nation", "n_nationkey").where("n_nationkey < 7").select(F.col("n_nationkey").cast("long").alias("s"))
    region = read(spark, d, "region", "r_regionkey", "r_name").select((F.col("r_regionkey") * 90 + 50).cast("long").alias("page"), F.concat(F.lit("Appendix "), F.element_at(F.split(F.lit("A,B,C,D,E"), ","), F.col("r_regionkey") + 1), F.lit(": "), "r_name").alias("title"))
    toc = manuals.join(F.broadcast(region)).withColumns({"level": F.lit(2), "last": F.lit(480).cast("long")})  # five rows a manual
    return containers.in_ranges(o, containers.toc_ranges(toc, ["s"], "last"), ["s"], "page").select("o_orderkey", "name")


def byte_ranges(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q"))
    odd = F.col("n") % 2 == 1
    name = lambda m: F.when(F.col("q") % m == 0, F.concat(F.lit("F"), F.col("n").cast("string"))).otherwise("Reserved")
    return li.where(odd).select("k", F.col("q").alias("s"), (F.col("q") + 20).alias("e"), name(5).alias("name")), li.where(~odd).select("k", F.col("q").alias("s"), (F.col("q") + 5).alias("e"), name(2).alias("name"))


_R = """x AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS INTEGER) AS q FROM lineitem), r AS (SELECT k, q AS s, q + 20 AS e, CASE WHEN q % 5 = 0 THEN 'F' || n ELSE 'Reserved' END AS name FROM x WHERE n % 2 = 1), a AS (SELECT k, q AS s, q + 5 AS e, CASE WHEN q % 2 = 0 THEN 'F' || n ELSE 'Reserved' END AS name FROM x WHERE n % 2 = 0)"""


@query(f"""WITH {_R}, i AS (SELECT r.k, r.s AS rs, r.e AS re, a.s, a.s || '-' || a.e || ' ' || a.name AS t, a.name <> 'Reserved' AS def FROM r JOIN a ON r.k = a.k AND a.s >= r.s AND a.e <= r.e WHERE r.name = 'Reserved')
SELECT k, rs, re, coalesce(string_agg(t, ',' ORDER BY s, t) FILTER (WHERE def), '') AS new_fields, coalesce(string_agg(t, ',' ORDER BY s, t) FILTER (WHERE NOT def), '') AS remaining_reserved FROM i GROUP BY k, rs, re HAVING bool_or(def AND s = rs)""")
def interval_split(spark, d):
    return diffing.reserved_splits(*byte_ranges(spark, d), ["k"])


@query(f"WITH {_R} SELECT r.k, r.s AS a_s, r.e AS a_e, r.name AS a_name, a.s, a.e FROM r JOIN a ON r.k = a.k AND r.s <= a.e AND a.s <= r.e WHERE r.name <> 'Reserved' AND a.name = 'Reserved'")
def interval_merge(spark, d):
    return diffing.reserved_merges(*byte_ranges(spark, d), ["k"])


@query("""WITH x AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'Reserved' ELSE o_orderstatus END AS old, CASE WHEN o_orderkey % 7 = 0 THEN 'RESERVED' ELSE o_orderstatus END AS new FROM orders),
y AS (SELECT k, CASE WHEN lower(old) = 'reserved' AND lower(new) <> 'reserved' THEN 'field_became_defined' WHEN lower(old) <> 'reserved' AND lower(new) = 'reserved' THEN 'field_became_reserved' END AS change_type FROM x) SELECT * FROM y WHERE change_type IS NOT NULL""")
def reserved_transition(spark, d):
    o = read(spark, d, "orders", "o_orderkey", "o_orderstatus")
    old, new = F.when(F.col("o_orderstatus") == "F", "Reserved").otherwise(F.col("o_orderstatus")), F.when(F.col("o_orderkey") % 7 == 0, "RESERVED").otherwise(F.col("o_orderstatus"))
    return o.select(F.col("o_orderkey").alias("k"), diffing.reserved_transition(old, new).alias("change_type")).where("change_type is not null")


@query("SELECT l_orderkey, arg_min(l_returnflag, l_linenumber * 100000000 + l_partkey) FILTER (WHERE l_returnflag <> 'N') AS signature FROM lineitem GROUP BY l_orderkey")
def signature_first_nonboring(spark, d):
    li = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").withColumn("n", F.col("l_linenumber").cast("long") * 100000000 + F.col("l_partkey"))
    return containers.signature(li, ["l_orderkey"], "l_returnflag", "n", ["N"])


@query("""WITH x AS (SELECT o_custkey % 100 AS s, o_orderpriority AS title, o_orderstatus || o_custkey AS sig, o_orderkey AS ord FROM orders), a AS (SELECT *, row_number() OVER (PARTITION BY s, title ORDER BY sig, ord) AS n FROM x WHERE ord % 3 > 0), b AS (SELECT *, row_number() OVER (PARTITION BY s, title ORDER BY sig, ord) AS n FROM x WHERE ord % 3 < 2)
SELECT s, title, CAST(n AS BIGINT) AS nth, a.ord AS a_ord, b.ord AS b_ord FROM a FULL JOIN b USING (s, title, n)""")
def signature_pairs(spark, d):
    x = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus").select((F.col("o_custkey") % 100).alias("s"), F.col("o_orderpriority").alias("title"), F.concat("o_orderstatus", F.col("o_custkey").cast("string")).alias("signature"), F.col("o_orderkey").alias("ord"))
    return containers.paired_signatures(x.where("ord % 3 > 0"), x.where("ord % 3 < 2"), ["s"]).select("s", "title", F.col("nth").cast("long").alias("nth"), F.col("a.ord").alias("a_ord"), F.col("b.ord").alias("b_ord"))


@query("SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return containers.duplicates(read(spark, d, "lineitem", "l_orderkey", "l_suppkey"), ["l_orderkey", "l_suppkey"])


@query(f"""WITH {_LINES}, c AS (SELECT doc_id, ord, string_split(line, ' | ') AS cells FROM l WHERE contains(line, ' | ')), x AS (SELECT doc_id, ord, CAST(n - 1 AS INTEGER) AS column_index, cells[n] AS old, CASE WHEN (doc_id + n) % 7 = 0 THEN cells[n] || ' x' ELSE cells[n] END AS new FROM c, LATERAL (SELECT unnest(range(1, len(cells) + 1)) AS n))
SELECT * FROM x WHERE column_index >= 1 AND length(trim(old, ' ')) < 49 AND trim(regexp_replace(old, '[ \\t\\n\\r]+', ' ', 'g'), ' ') <> trim(regexp_replace(new, '[ \\t\\n\\r]+', ' ', 'g'), ' ')""")
def cells_diff(spark, d):
    rows = doc_lines_of(spark, d).where(F.contains("line", F.lit(" | "))).withColumn("a_cells", F.split("line", r" \| "))
    rows = rows.withColumn("b_cells", F.transform("a_cells", lambda c, k: F.when((F.col("doc_id") + k + 1) % 7 == 0, F.concat(c, F.lit(" x"))).otherwise(c)))
    return diffing.cells_diff(rows, ["doc_id", "ord"]).drop("similarity_ratio")


def part_names(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_partkey").alias("ord"), F.concat("p_name", F.lit(" "), "p_type").alias("text"))
    return p.where("ord % 2 = 0"), p.where("ord % 2 = 1")


@query("""WITH p AS (SELECT p_brand AS brand, p_type AS kind, p_partkey AS ord, p_name || ' ' || p_type AS t FROM part), e AS (SELECT a.brand, a.kind, a.ord AS a_ord, b.ord AS b_ord, levenshtein(a.t, b.t) AS x FROM p a JOIN p b ON a.brand = b.brand AND a.kind = b.kind WHERE a.ord % 2 = 0 AND b.ord % 2 = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY brand, kind, a_ord ORDER BY x, a_ord, b_ord) AS ra, row_number() OVER (PARTITION BY brand, kind, b_ord ORDER BY x, a_ord, b_ord) AS rb FROM e) SELECT a_ord, b_ord, CAST(x AS INTEGER) AS distance FROM r WHERE ra = 1 AND rb = 1""")
def fuzzy_mutual_best(spark, d):
    return matching.mutual_nearest(*part_names(spark, d), ["brand", "kind"]).select("a_ord", "b_ord", "distance")


@query()
def fuzzy_serial(spark, d):
    a, b = part_names(spark, d)
    return matching.fuzzy_match(a, b, ["brand", "kind"], 0.85, "serial").select("brand", "kind", "a_ord", "b_ord", F.round("ratio", 3).alias("ratio"), "match_type")


@query()
def fuzzy_global(spark, d):
    a, b = part_names(spark, d)
    return matching.fuzzy_match(a, b, ["brand", "kind"], 0.85, "global").select("brand", "kind", "a_ord", "b_ord", F.round("ratio", 3).alias("ratio"), "match_type")


def turn_pairs(spark, d):
    """Each conversation's turns as paragraphs; the new edition drops, joins and rewords some."""
    c = read(spark, d, "conversations", "conv_id", "turn", "text").withColumn("text", F.coalesce("text", F.lit(""))).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    old = F.transform("t", lambda x: T.clean(x["text"]))
    new = F.filter(F.transform("t", lambda x, k: F.when((F.col("conv_id") + k) % 7 == 0, F.lit(None)).when((F.col("conv_id") + k) % 5 == 0, F.concat(T.clean(x["text"]), F.lit(" revised"))).otherwise(T.clean(x["text"]))), lambda x: x.isNotNull())
    return c.select("conv_id", old.alias("old"), new.alias("new"))


@query()
def paragraph_align(spark, d):
    return matching.align_paragraphs(turn_pairs(spark, d), ["conv_id"])


@query("""WITH t AS (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r]+', ' ', 'g'), ' ') AS text FROM conversations), n AS (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nx FROM t),
b AS (SELECT conv_id, turn AS b_ord, text || ' ' || nx AS text FROM n WHERE turn % 2 = 0 AND nx IS NOT NULL) SELECT n.conv_id, n.turn AS a_ord, b.b_ord FROM n JOIN b ON n.conv_id = b.conv_id AND n.text || ' ' || n.nx = b.text WHERE n.nx IS NOT NULL""")
def reflow_adjacent(spark, d):
    a = read(spark, d, "conversations", "conv_id", "turn", "text").select("conv_id", F.col("turn").alias("ord"), T.clean(F.coalesce("text", F.lit(""))).alias("text"))
    b = a.withColumn("nx", F.lead("text").over(Window.partitionBy("conv_id").orderBy("ord"))).where("nx is not null and ord % 2 = 0").select("conv_id", "ord", F.concat_ws(" ", "text", "nx").alias("text"))
    return matching.reflow_adjacent(a, b, ["conv_id"]).select("conv_id", "a_ord", "b_ord")


@query("""WITH r AS (SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS p, CAST(l_partkey AS VARCHAR) AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR)) AS n FROM lineitem), u AS (SELECT l_orderkey, count(DISTINCT x) AS names, count(*) AS c FROM r GROUP BY 1)
SELECT r.l_orderkey, r.x AS name, CASE WHEN names = 1 THEN b.p ELSE r.p END AS old_position, r.p || 's' AS new_position FROM r JOIN u USING (l_orderkey) LEFT JOIN r b ON b.l_orderkey = r.l_orderkey AND b.n = r.n - 1 WHERE r.n > 1""")
def position_shift(spark, d):
    item = F.struct(F.col("l_linenumber").cast("string").alias("position"), F.col("l_partkey").cast("string").alias("name"))
    g = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("removed"))
    return matching.shifted(g.withColumn("added", F.transform(F.slice("removed", 2, F.size("removed")), lambda x: F.struct(F.concat(x["position"], F.lit("s")).alias("position"), x["name"].alias("name")))), ["l_orderkey"])


@query("""WITH x AS (SELECT DISTINCT l_orderkey % 50 AS scope, l_orderkey AS k, l_partkey AS line FROM lineitem), r AS (SELECT scope, 'a' || k AS s, line FROM x), a AS (SELECT scope, 'b' || k AS s, line FROM x WHERE NOT (k % 3 = 0 AND line % 5 = 0)),
rn AS (SELECT scope, s, count(*) AS n FROM r GROUP BY ALL), an AS (SELECT scope, s, count(*) AS n FROM a GROUP BY ALL), j AS (SELECT r.scope, r.s AS a, a.s AS b, count(*) AS shared FROM r JOIN a ON r.scope = a.scope AND r.line = a.line GROUP BY ALL),
g AS (SELECT j.scope, a, b, shared FROM j JOIN rn ON rn.scope = j.scope AND rn.s = a JOIN an ON an.scope = j.scope AND an.s = b WHERE least(rn.n, an.n) >= 0.5 * greatest(rn.n, an.n) AND shared >= 0.8 * rn.n)
SELECT scope, a, b, shared FROM (SELECT *, count(*) OVER (PARTITION BY scope, a) AS ca, count(*) OVER (PARTITION BY scope, b) AS cb FROM g) WHERE ca = 1 AND cb = 1""")
def section_move_coverage(spark, d):
    x = read(spark, d, "lineitem", "l_orderkey", "l_partkey").distinct().select((F.col("l_orderkey") % 50).alias("scope"), F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("line"))
    side = lambda df, p: df.select("scope", F.concat(F.lit(p), F.col("k").cast("string")).alias("section"), "line")
    named = lambda df, p: side(df, p).withColumnRenamed("line", "text")
    return matching.section_copies(named(x, "a"), named(x.where("not (k % 3 = 0 and line % 5 = 0)"), "b"), ["scope"]).select("scope", "a", "b", F.col("exact").alias("shared"))


@query("""WITH x AS (SELECT o_orderkey % 40 AS scope, o_custkey AS k, o_orderpriority || o_orderstatus AS line, o_orderkey FROM orders), r AS (SELECT scope, 'a' || k AS s, line, count(*) AS n FROM x GROUP BY ALL), a AS (SELECT scope, 'b' || k AS s, line, count(*) AS n FROM x WHERE o_orderkey % 6 <> 0 GROUP BY ALL),
rn AS (SELECT scope, s, sum(n) AS n FROM r GROUP BY ALL), an AS (SELECT scope, s, sum(n) AS n FROM a GROUP BY ALL), j AS (SELECT r.scope, r.s AS a, a.s AS b, sum(least(r.n, a.n)) AS exact FROM r JOIN a ON r.scope = a.scope AND r.line = a.line GROUP BY ALL),
g AS (SELECT j.scope, a, b, exact, rn.n AS a_n, an.n AS b_n FROM j JOIN rn ON rn.scope = j.scope AND rn.s = a JOIN an ON an.scope = j.scope AND an.s = b WHERE least(rn.n, an.n) >= 0.5 * greatest(rn.n, an.n) AND exact >= 0.8 * rn.n)
SELECT scope, a, b, CAST(exact AS BIGINT) AS exact, CAST(a_n AS BIGINT) AS a_n, CAST(b_n AS BIGINT) AS b_n FROM (SELECT *, count(*) OVER (PARTITION BY scope, a) AS ca, count(*) OVER (PARTITION BY scope, b) AS cb FROM g) WHERE ca = 1 AND cb = 1""")
def section_copies(spark, d):
    """Paragraphs that a section holds several times count as often as both sections have them."""
    x = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    side = lambda df, p: df.select((F.col("o_orderkey") % 40).alias("scope"), F.concat(F.lit(p), F.col("o_custkey").cast("string")).alias("section"), F.concat("o_orderpriority", "o_orderstatus").alias("text"))
    return matching.section_copies(side(x, "a"), side(x.where("o_orderkey % 6 <> 0"), "b"), ["scope"]).select("scope", "a", "b", "exact", "a_n", "b_n")


def turn_sections(spark, d):
    """Conversations as sections; the new edition holds them under other names, some turns dropped, some reworded."""
    new = turn_pairs(spark, d)
    side = lambda c, p: new.select((F.col("conv_id") % 20).alias("scope"), F.concat(F.lit(p), F.col("conv_id").cast("string")).alias("section"), F.posexplode(c).alias("ord", "text"))
    return side("old", "a"), side("new", "b")


@query()
def section_moves(spark, d):
    return matching.section_moves(*turn_sections(spark, d), ["scope"]).select("scope", "a", "b", "coverage", "a_n", "b_n")


@query("""WITH t AS (SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '[ \t\n\r]+', ' ', 'g'), ' ') AS text FROM conversations), c AS (SELECT conv_id, turn, array_to_string(list_slice(string_split(text, ' '), 3, 9), ' ') AS chunk FROM t),
p AS (SELECT DISTINCT conv_id, lower(text) AS held FROM t WHERE (conv_id + turn) % 3 <> 0), h AS (SELECT DISTINCT c.conv_id, c.turn FROM c JOIN p ON p.conv_id = c.conv_id AND contains(held, lower(chunk)) WHERE chunk <> '')
SELECT conv_id, turn, CASE WHEN h.turn IS NOT NULL THEN translate(chunk, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE '' END AS relocated, CASE WHEN h.turn IS NULL THEN translate(chunk, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE '' END AS gone FROM c LEFT JOIN h USING (conv_id, turn)""")
def relocations(spark, d):
    """Seven words of each turn, in capitals, are sought in the turns that the new edition keeps."""
    t = read(spark, d, "conversations", "conv_id", "turn", "text").withColumn("text", T.clean(F.coalesce("text", F.lit(""))))
    chunk = F.translate(F.array_join(F.slice(F.split("text", " "), 3, 7), "  "), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    events = t.select("conv_id", "turn", F.array(chunk).alias("disappeared_content"))
    found = classify.relocations(events, t.where("(conv_id + turn) % 3 <> 0").select("conv_id", "text"), ["conv_id"])
    shown = lambda c: F.regexp_replace(F.array_join(c, "¶"), " +", " ")
    return found.select("conv_id", "turn", shown("relocated_content").alias("relocated"), shown("disappeared_content").alias("gone"))


@query()
def disappeared_content(spark, d):
    c = read(spark, d, "conversations", "conv_id", "turn", "text").withColumn("text", F.coalesce("text", F.lit("")))
    new = F.array_join(F.slice(F.split("text", " "), 8, F.size(F.split("text", " "))), " ")
    rows = c.select("conv_id", "turn", F.col("text").alias("old"), new.alias("new")).withColumn("gone", disappeared(F.col("old"), F.col("new")))
    return rows.select("conv_id", "turn", F.array_join("gone", " ¶ ").alias("gone"), F.round(ratio(F.col("old"), F.col("new")), 3).alias("ratio"), length_bound(F.col("old"), F.col("new")).alias("bound"))


@query("""WITH x AS (SELECT doc_id, CASE quality WHEN 1 THEN 'editorial_change' ELSE 'business_rule_change' END AS c, toxic = 1 AS gone FROM labels)
SELECT doc_id, CASE WHEN c = 'editorial_change' AND gone THEN 'business_rule_change' ELSE c END AS ai_category, c = 'editorial_change' AND gone AS safety_net_override, CASE WHEN c = 'editorial_change' AND gone THEN c END AS ai_original_category FROM x""")
def safety_net(spark, d):
    rows = read(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "editorial_change").otherwise("business_rule_change").alias("ai_category"), F.col("toxic"))
    return classify.safety_net(rows, F.col("toxic") == 1).select("doc_id", "ai_category", "safety_net_override", "ai_original_category")


@query("""SELECT CASE WHEN c IN ('business_rule_change', 'editorial_change', 'extraction_noise') THEN c ELSE 'extraction_noise' END AS ai_category, count(*) AS n FROM (SELECT CASE quality WHEN 1 THEN 'editorial_change' ELSE 'other' END AS c FROM labels) GROUP BY ALL""")
def ai_summary(spark, d):
    return read(spark, d, "labels").select(classify.valid_category(F.when(F.col("quality") == 1, "editorial_change").otherwise("other")).alias("ai_category")).groupBy("ai_category").agg(F.count("*").alias("n"))


@query(f"WITH {_LOG} SELECT change_type, k FROM (SELECT *, row_number() OVER (PARTITION BY change_type ORDER BY k) AS n FROM change_log) WHERE n <= 5")
def only_and_limit(spark, d):
    return classify.limited(log_of(spark, d), "change_type", "k", 5).select("change_type", "k")


@query(f"""WITH {_LINES}, w AS (SELECT doc_id, ord, line, lag(line) OVER (PARTITION BY doc_id ORDER BY ord) AS before FROM l),
s AS (SELECT doc_id, ord, list_distinct(list_filter(regexp_split_to_array(lower(line), '[^a-z]+'), lambda x: length(x) >= 4)) AS a, list_distinct(list_filter(regexp_split_to_array(lower(before), '[^a-z]+'), lambda x: length(x) >= 4)) AS b FROM w WHERE before IS NOT NULL)
SELECT doc_id, ord, round(len(list_intersect(a, b)) / greatest(len(a), 1), 6) AS share FROM s""")
def keyword_overlap(spark, d):
    w = Window.partitionBy("doc_id").orderBy("ord")
    rows = doc_lines_of(spark, d).withColumn("before", F.lag("line").over(w)).where("before is not null")
    return rows.select("doc_id", "ord", F.round(classify.keyword_overlap(F.col("line"), F.col("before")), 6).alias("share"))


@query("SELECT doc_id, sha256(text) AS digest, CASE WHEN text IS NOT NULL THEN count(*) OVER (PARTITION BY text) END AS copies FROM documents")
def content_copies(spark, d):
    return landing.with_copies(read(spark, d, "documents", "doc_id", "text")).select("doc_id", "digest", "copies")


@query("SELECT doc_id AS target, sha256(text) AS digest, sha256('older ' || text) AS corpus_digest FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL")
def content_conflict(spark, d):
    docs = read(spark, d, "documents", "doc_id", "text")
    older = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("older "), "text")).otherwise(F.col("text"))
    return landing.conflicts(docs.select(F.col("doc_id").alias("target"), F.sha2("text", 256).alias("digest")), docs.select(F.col("doc_id").alias("target"), F.sha2(older, 256).alias("digest")))


@query("""WITH e AS (SELECT o_custkey AS manual, strftime(o_orderdate, '%Y%m%d') AS edition FROM orders) SELECT manual, max(edition) AS latest, count(DISTINCT edition) AS editions FROM e GROUP BY manual""")
def latest_edition(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderdate").select(F.col("o_custkey").alias("manual"), F.date_format("o_orderdate", "yyyyMMdd").alias("edition"))
    return landing.latest_editions(o)


@query("""WITH e AS (SELECT DISTINCT o_custkey AS manual, strftime(o_orderdate, '%Y%m%d') AS edition FROM orders), p AS (SELECT manual, edition AS edition_a, lead(edition) OVER (PARTITION BY manual ORDER BY edition) AS edition_b FROM e)
SELECT manual, edition_a, edition_b FROM p WHERE edition_b IS NOT NULL AND edition_a >= '19950101' AND edition_b <= '19971231'""")
def edition_chain(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderdate").select(F.col("o_custkey").alias("manual"), F.date_format("o_orderdate", "yyyyMMdd").alias("edition"))
    return landing.chain(landing.edition_pairs(o), "19950101", "19971231").select("manual", "edition_a", "edition_b")


@query("""WITH g AS (SELECT l_orderkey AS manual, count(*) AS n, count(DISTINCT l_shipdate) AS dates, min(l_shipdate) AS first FROM lineitem GROUP BY 1), c AS (SELECT o_orderkey AS manual, min(o_orderdate) AS oldest FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
v AS (SELECT manual, n, CASE WHEN n NOT IN (1, 2) THEN 'size' WHEN n = 2 AND dates < 2 THEN 'dates' WHEN n = 1 AND NOT coalesce(oldest < first, false) THEN 'no older edition' ELSE 'ok' END AS verdict FROM g LEFT JOIN c USING (manual))
SELECT manual, n, verdict, bool_and(verdict = 'ok') OVER () AS batch_ok FROM v""")
def batch_validate(spark, d):
    inbox = read(spark, d, "lineitem", "l_orderkey", "l_shipdate").toDF("manual", "edition")
    corpus = read(spark, d, "orders", "o_orderkey", "o_orderdate").where("o_orderkey % 2 = 0").toDF("manual", "edition")
    return landing.validate_batch(inbox, corpus).select("manual", "n", "verdict", "batch_ok")


@query("""WITH s AS (SELECT o_custkey AS slug, max(strftime(o_orderdate, '%Y%m%d')) AS b FROM orders GROUP BY 1), p AS (SELECT slug, CASE WHEN slug % 3 = 0 THEN b ELSE '19000101' END AS b FROM s WHERE slug % 2 = 0) SELECT s.slug, s.b AS edition_b, p.b IS NULL OR p.b <> s.b AS is_new FROM s LEFT JOIN p USING (slug)""")
def is_new_since_publish(spark, d):
    s = latest_edition(spark, d).select(F.col("manual").alias("slug"), F.col("latest").alias("edition_b"))
    state = s.where("slug % 2 = 0").withColumn("edition_b", F.when(F.col("slug") % 3 == 0, F.col("edition_b")).otherwise("19000101"))
    return landing.is_new(s, state, ["edition_b"])


@query("""WITH x AS (SELECT l_orderkey AS title, l_suppkey AS position, CASE WHEN l_linenumber % 2 = 0 THEN 'row' ELSE 'card' END AS kind FROM lineitem) SELECT title, position, max(kind) AS kind, bool_or(kind = 'row') AS confirmed_in_row, bool_or(kind = 'card') AS confirmed_in_card FROM x GROUP BY ALL""")
def transition_dedupe(spark, d):
    x = read(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber").select(F.col("l_orderkey").alias("title"), F.col("l_suppkey").alias("position"), F.when(F.col("l_linenumber") % 2 == 0, "row").otherwise("card").alias("kind"))
    return reporting.dedupe_transitions(x, ["title", "position"])


@query("""WITH x AS (SELECT l_orderkey AS label, l_partkey AS name, l_linenumber AS n FROM lineitem), a AS (SELECT label, min(name) AS new FROM x WHERE n % 2 = 0 GROUP BY label HAVING count(*) = 1), r AS (SELECT label, min(name) AS old FROM x WHERE n % 2 = 1 GROUP BY label HAVING count(*) = 1) SELECT label, old, new FROM a JOIN r USING (label)""")
def rename_hints(spark, d):
    x = read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_linenumber").toDF("label", "name", "n")
    return reporting.rename_hints(x.where("n % 2 = 0").select("label", "name"), x.where("n % 2 = 1").select("label", "name"), "label", "name")


@query(f"WITH {_C} SELECT coalesce(x.segment, y.segment) AS segment, coalesce(x.n, 0) AS before, coalesce(y.n, 0) AS after, coalesce(y.n, 0) - coalesce(x.n, 0) AS delta FROM (SELECT segment, count(*) AS n FROM a GROUP BY 1) x FULL JOIN (SELECT segment, count(*) AS n FROM b GROUP BY 1) y USING (segment)")
def counts_before_after(spark, d):
    return reporting.before_after(*customers(spark, d), "segment")


@query(f"WITH {_LOG} SELECT change_type, k, CAST(n AS INTEGER) AS n FROM (SELECT *, row_number() OVER (PARTITION BY change_type ORDER BY k) AS n FROM change_log) WHERE n <= 3")
def top_items(spark, d):
    return reporting.top(log_of(spark, d), ["change_type"], ["k"], 3).select("change_type", "k", "n")


@query("""WITH x AS (SELECT DISTINCT o_custkey AS title, o_orderstatus AS sig FROM orders) SELECT title, sig, CASE WHEN count(*) OVER (PARTITION BY title) > 1 THEN title || ' (' || sig || ')' ELSE CAST(title AS VARCHAR) END AS heading FROM x""")
def sibling_heading(spark, d):
    x = read(spark, d, "orders", "o_custkey", "o_orderstatus").toDF("title", "sig").distinct()
    return reporting.headings(x, "title", "sig")


@query(f"""WITH {_LOG} SELECT 'customers' AS manual, count(*) AS headline, count(*) FILTER (WHERE change_type = 'added') AS added, count(*) FILTER (WHERE change_type = 'removed') AS removed, count(*) FILTER (WHERE change_type = 'content_changed') AS changed FROM change_log""")
def consolidated_report(spark, d):
    return reporting.summary(log_of(spark, d).withColumn("manual", F.lit("customers")), "manual").select("manual", "headline", "added", "removed", "changed")


@query(f"WITH {_LINES} SELECT doc_id, ord, max(CASE WHEN contains(line, '|') THEN ord END) OVER (PARTITION BY doc_id ORDER BY ord) AS caption FROM l")
def caption_carry(spark, d):
    return containers.carried(doc_lines_of(spark, d), ["doc_id"], F.when(F.contains("line", F.lit("|")), F.col("ord")), "caption").select("doc_id", "ord", "caption")


@query("""WITH b AS (SELECT o_custkey AS s, o_orderkey AS ord, o_orderpriority AS code, o_orderkey % 3 = 0 AS cont FROM orders), p AS (SELECT *, lag(ord) OVER (PARTITION BY s, code ORDER BY ord) AS prev FROM b),
g AS (SELECT *, sum(CASE WHEN NOT cont OR prev IS NULL OR ord - prev > 5000 THEN 1 ELSE 0 END) OVER (PARTITION BY s, code ORDER BY ord) AS grp FROM p) SELECT s, code, min(ord) AS ord, string_agg(CAST(ord AS VARCHAR), ';' ORDER BY ord) AS text, count(*) AS n FROM g GROUP BY s, code, grp""")
def continued_merge(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").select(F.col("o_custkey").alias("s"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderkey") % 3 == 0, F.concat("o_orderpriority", F.lit(" (continued)"))).otherwise(F.col("o_orderpriority")).alias("code"), F.col("o_orderkey").cast("string").alias("text"))
    return containers.continued_rows(o, ["s"], "code", "text", back=5000).select("s", "code", "ord", F.replace("text", F.lit("\n"), F.lit(";")).alias("text"), "n")


@query("""WITH b AS (SELECT o_custkey AS s, o_orderkey AS ord, o_orderpriority AS code, o_orderkey % 3 = 0 AS cont, 2 + o_orderkey % 2 AS size, o_orderstatus AS x, CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey AS VARCHAR) END AS y FROM orders), p AS (SELECT *, lag(ord) OVER w AS prev, lag(size) OVER w AS psize FROM b WINDOW w AS (PARTITION BY s, code ORDER BY ord)),
g AS (SELECT *, sum(CASE WHEN coalesce(cont AND ord - prev <= 9000 AND size = psize, false) THEN 0 ELSE 1 END) OVER (PARTITION BY s, code ORDER BY ord) AS grp FROM p)
SELECT s, min(ord) AS ord, code, arg_min(CASE WHEN cont THEN code || ' (continued)' ELSE code END, ord) || '|' || string_agg(x, ';' ORDER BY ord) || coalesce('|' || string_agg(y, ';' ORDER BY ord), '') AS cells, count(*) AS n FROM g GROUP BY s, code, grp""")
def continued_cells(spark, d):
    k = F.col("o_orderkey")
    code = F.when(k % 3 == 0, F.concat("o_orderpriority", F.lit(" (continued)"))).otherwise(F.col("o_orderpriority"))
    cells = F.when(k % 2 == 1, F.array(code, "o_orderstatus", k.cast("string"))).otherwise(F.array(code, "o_orderstatus"))
    rows = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus").select(F.col("o_custkey").alias("s"), k.alias("ord"), cells.alias("cells"))
    return containers.continued_cells(rows, ["s"], back=9000).select("s", "ord", "code", F.replace(F.array_join("cells", "|"), F.lit("\n"), F.lit(";")).alias("cells"), "n")


@query("""WITH b AS (SELECT o_custkey % 50 AS s, o_orderkey AS ord, CASE WHEN o_orderkey % 4 = 0 THEN 'paragraph' WHEN o_orderkey % 5 = 0 THEN 'table_header' ELSE 'table_row' END AS type, o_orderpriority AS text FROM orders), w AS (SELECT *, lag(type) OVER v AS lt, lag(text) OVER v AS lx FROM b WINDOW v AS (PARTITION BY s ORDER BY ord)),
g AS (SELECT *, CASE WHEN type = 'table_header' THEN CASE WHEN lt = 'paragraph' THEN lx ELSE 'h ' || text END END AS own FROM w), c AS (SELECT *, count(own) OVER (PARTITION BY s ORDER BY ord) AS grp FROM g), t AS (SELECT *, max(own) OVER (PARTITION BY s, grp) AS title FROM c)
SELECT s, ord, title FROM t WHERE type = 'table_row' AND title IS NOT NULL""")
def tables_of_blocks(spark, d):
    k = F.col("o_orderkey")
    kind = F.when(k % 4 == 0, "paragraph").when(k % 5 == 0, "table_header").otherwise("table_row")
    b = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").select((F.col("o_custkey") % 50).alias("s"), k.alias("ord"), kind.alias("type"), F.col("o_orderpriority").alias("text"), F.array(F.lit("h"), "o_orderpriority").alias("cells"))
    return containers.tables_of(b, ["s"]).select("s", "ord", "title")


@query(f"""WITH {_LINES}, {_H}, g AS (SELECT *, sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS section FROM h) SELECT doc_id, ord, CAST(section AS BIGINT) AS section, first_value(line) OVER (PARTITION BY doc_id, section ORDER BY ord) AS section_title FROM g WHERE section > 0 QUALIFY level > 1""")
def sections_of_blocks(spark, d):
    return containers.sections(levelled(spark, d).withColumnRenamed("line", "text"), ["doc_id"], F.col("level") == 1).select("doc_id", "ord", "section", "section_title")


@query("""SELECT source, count(*) AS n, string_agg(coalesce(lang, '?'), ' / ' ORDER BY doc_id) AS parts, arg_min(coalesce(lang, '?'), doc_id + CASE WHEN lang = 'en' THEN 0 ELSE 1000000000000 END) AS title FROM documents GROUP BY source""")
def coalesce_groups(spark, d):
    docs = read(spark, d, "documents", "doc_id", "source", "lang").withColumn("lang", F.coalesce("lang", F.lit("?")))
    return containers.coalesced(docs, ["source"], "lang", "doc_id", F.col("lang") == "en").select("source", "n", "parts", "title")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_size, p_partkey) AS place FROM part")
def position_sort(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_size").withColumn("position", F.concat(F.col("p_size").cast("string"), F.lit("–"), F.lit("99")))
    return reporting.ranked(p, [T.position_rank(T.position(F.col("position"))), F.col("p_partkey")], "place").select("p_partkey", F.col("place").cast("long").alias("place"))


@query("""SELECT c_custkey AS k, trim(concat_ws(' ', c_name, c_mktsegment), ' ') AS old, trim(concat_ws(' ', c_name, c_mktsegment, 'REVISED'), ' ') AS new FROM customer WHERE c_custkey % 7 = 0""")
def composite_diff(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").select(F.col("c_custkey").alias("k"), F.struct(F.col("c_name").alias("x"), F.col("c_mktsegment").alias("y")).alias("a"))
    c = c.withColumn("b", F.struct(F.col("a.x").alias("x"), F.when(F.col("k") % 7 == 0, F.concat("a.y", F.lit(" REVISED"))).otherwise(F.col("a.y")).alias("y")))
    return c.select("k", diffing.composite("a", ["x", "y"]).alias("old"), diffing.composite("b", ["x", "y"]).alias("new")).where("old <> new")


@query(f"WITH {_LOG} SELECT change_type, k, coalesce(old, c_mktsegment) AS old, c_name AS title FROM change_log JOIN customer ON c_custkey = k")
def context_backfill(spark, d):
    facts = read(spark, d, "customer", "c_custkey", "c_mktsegment", "c_name").toDF("k", "old", "title")
    return diffing.backfilled(log_of(spark, d), facts, ["k"]).select("change_type", "k", "old", "title")


@query(f"WITH {_LOG} SELECT k, change_type, coalesce(r.c_name, s.s_name, '') AS field_name FROM change_log LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) r ON r.c_custkey = k LEFT JOIN supplier s ON s.s_suppkey = k")
def lookup_enrich(spark, d):
    rows = read(spark, d, "customer", "c_custkey", "c_name").where("c_custkey % 3 = 0").toDF("k", "field_name")
    cards = read(spark, d, "supplier", "s_suppkey", "s_name").toDF("k", "field_name")
    return classify.enriched(log_of(spark, d), [rows, cards], ["k"], "field_name").select("k", "change_type", "field_name")


@query(f"WITH {_LOG} SELECT change_type, string_agg('- ' || k || ': ' || coalesce(old, '') || ' -> ' || coalesce(new, ''), chr(10) ORDER BY k) AS body FROM change_log GROUP BY change_type")
def report_lines(spark, d):
    line = F.concat(F.lit("- "), F.col("k").cast("string"), F.lit(": "), F.coalesce("old", F.lit("")), F.lit(" -> "), F.coalesce("new", F.lit("")))
    return reporting.bodies(log_of(spark, d).withColumn("line", line), ["change_type"], "k", "line")


@query(f"WITH {_LOG}, moved AS (SELECT k FROM change_log WHERE k % 20 = 0) SELECT change_type, k FROM change_log WHERE change_type IN ('added', 'removed') AND k NOT IN (SELECT k FROM moved)")
def suppress_moved(spark, d):
    log = log_of(spark, d)
    return reporting.without_moved(log, log.where("k % 20 = 0"), ["k"]).select("change_type", "k")


@query(f"WITH {_LOG} SELECT change_type, k FROM change_log WHERE change_type <> 'content_changed' AND k % 4 <> 0")
def consumed_items(spark, d):
    log = log_of(spark, d)
    return diffing.unconsumed(log.where("change_type <> 'content_changed'"), log.where("k % 4 = 0"), ["k"]).select("change_type", "k")


@query(f"""WITH {_LOG}, o AS (SELECT o_custkey AS k, string_agg(o_orderpriority, '|' ORDER BY o_orderkey) AS context FROM orders GROUP BY 1) SELECT change_type, k, coalesce(context, '') AS context FROM change_log LEFT JOIN o USING (k)""")
def context_attach(spark, d):
    paragraphs = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").toDF("k", "ord", "text")
    return diffing.with_context(log_of(spark, d), paragraphs, ["k"]).select("change_type", "k", F.array_join("context", "|").alias("context"))


@query("""SELECT o_custkey AS k, string_agg(o_orderpriority, ' ' ORDER BY o_orderkey) AS joined, string_agg(o_orderstatus || ' | ' || o_orderpriority, ' | ' ORDER BY o_orderkey) AS bullets FROM orders GROUP BY 1""")
def flatten_fields(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus"))).alias("x"))
    one, many = F.transform("x", lambda x: x["o_orderpriority"]), F.transform("x", lambda x: F.array(x["o_orderstatus"], x["o_orderpriority"]))
    return o.select("k", diffing.flattened(one).alias("joined"), diffing.flattened(many, nested=True).alias("bullets"))


@query(f"WITH {_LOG} SELECT change_type, '- [' || change_type || '](' || change_type || '.md): ' || count(*) || ' changes, ' || count(*) FILTER (WHERE k % 2 = 0) || ' of business rules' AS line FROM change_log GROUP BY 1")
def index_lines(spark, d):
    return reporting.index_lines(log_of(spark, d), "change_type", F.col("k") % 2 == 0)


@query(f"""WITH {_LOG}, r AS (SELECT change_type, k, row_number() OVER (PARTITION BY change_type ORDER BY k) AS n, count(*) OVER (PARTITION BY change_type) AS c FROM change_log), g AS (SELECT change_type, c, string_agg(CAST(k AS VARCHAR), ',' ORDER BY n) FILTER (WHERE n <= 3) AS items FROM r GROUP BY ALL)
SELECT 'customers' AS manual, CAST(sum(c) AS BIGINT) AS headline, string_agg(change_type || ':' || c || ':' || items, ';' ORDER BY -c, change_type) AS groups FROM g""")
def summary_pills(spark, d):
    made = reporting.pills(log_of(spark, d).withColumn("manual", F.lit("customers")), "manual", F.col("k").cast("string"), order="k")
    return made.select("manual", "headline", F.array_join(F.transform("groups", lambda g: F.concat_ws(":", g["change_type"], g["count"].cast("string"), F.array_join(g["items"], ","))), ";").alias("groups"))


@query("""WITH o AS (SELECT o_custkey AS manual, strftime(o_orderdate, '%Y%m%d') AS pair, o_orderkey FROM orders) SELECT manual, pair, o_orderkey FROM (SELECT *, max(pair) OVER (PARTITION BY manual) AS last FROM o) WHERE pair = last""")
def latest_pair(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderdate", "o_orderkey").select(F.col("o_custkey").alias("manual"), F.date_format("o_orderdate", "yyyyMMdd").alias("pair"), "o_orderkey")
    return reporting.latest(o, "manual", "pair")


@query("""SELECT p_partkey AS k, CASE WHEN length(t) > 24 THEN rtrim(t[1:24], ' ') || '…' ELSE t END AS summary FROM (SELECT p_partkey, 'brand: ' || p_brand || '; type: ' || p_type AS t FROM part)""")
def row_summary(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type")
    columns = F.create_map(F.lit("name"), F.col("p_name"), F.lit("type"), F.col("p_type"), F.lit("brand"), F.col("p_brand"), F.lit("empty"), F.lit(""))
    return p.select(F.col("p_partkey").alias("k"), reporting.row_summary(columns, "name", 24).alias("summary"))


_ROLES = "CASE WHEN trim(line, ' ') = '' THEN 'empty' WHEN contains(line, ' | ') THEN 'table' WHEN length(line) < 30 THEN 'heading' WHEN regexp_matches(line, '[0-9]{4,}') THEN 'data' ELSE 'paragraph' END"


@query(f"WITH {_LINES} SELECT role, role NOT IN ('empty', 'heading') AS included, count(*) AS n FROM (SELECT {_ROLES} AS role FROM l) GROUP BY ALL")
def role_classify(spark, d):
    line = F.col("line")
    rules = [("empty", F.trim(line) == ""), ("table", F.contains(line, F.lit(" | "))), ("heading", F.length(line) < 30), ("data", line.rlike("[0-9]{4,}"))]
    rows = doc_lines_of(spark, d).select(assembly.block_role(rules, "paragraph").alias("role"))
    return rows.groupBy("role", assembly.included(F.col("role"), ("empty", "heading")).alias("included")).agg(F.count("*").alias("n"))


@query(f"""WITH {_LINES}, p AS (SELECT doc_id, ord, list_filter(string_split(line, ', '), lambda x: trim(x, ' ') <> '') AS s FROM l), t AS (SELECT doc_id, ord, n, s[n] AS x FROM p, LATERAL (SELECT unnest(range(1, len(s) + 1)) AS n))
SELECT doc_id, ord, CAST(n - 1 AS BIGINT) AS segment, CASE WHEN length(x) % 2 = 0 AND regexp_matches(trim(x, ' '), '^[0-9]+(,[0-9]+)*$') THEN '' ELSE trim(x, ' ') END AS text, length(x) % 3 = 0 AS bold, CAST(CASE WHEN length(x) % 2 = 0 THEN 7 ELSE 9 END AS DOUBLE) AS size, CAST(length(x) AS DOUBLE) AS x1 FROM t""")
def segment_split(spark, d):
    def span(t):
        n = F.length(t)
        return F.struct(t.alias("text"), F.when(n % 2 == 0, 7.0).otherwise(9.0).alias("size"), F.when(n % 3 == 0, 16).otherwise(0).alias("flags"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), n.cast("double").alias("x1"), F.lit(1.0).alias("y1"))

    own = F.flatten(F.transform(F.split("line", ", "), lambda t: F.array(span(t), span(F.lit(" ")))))
    rows = doc_lines_of(spark, d).select("doc_id", "ord", F.posexplode(spans.segments(own)).alias("segment", "s"))
    x = F.col("s")
    return rows.select("doc_id", "ord", F.col("segment").cast("long").alias("segment"), spans.text_of(x).alias("text"), spans.is_bold(x).alias("bold"), spans.largest_size(x).alias("size"), spans.bbox(x)["x1"].alias("x1"))


@query("""SELECT p_partkey AS k, p_size < 20 AND length(p_name) >= 15 - length(p_type) AS marked, 'p1_b' || p_size || '_l2_s' || p_partkey AS line_id FROM part""")
def footnote_markers(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_size", "p_name", "p_type")
    span = lambda t, size: F.struct(t.alias("text"), size.cast("double").alias("size"), F.lit(0).alias("flags"), *(F.lit(0.0).alias(c) for c in ("x0", "y0", "x1", "y1")))
    line = F.array(span(F.lit(" "), F.lit(9)), span(F.lit("1,2"), F.when(F.col("p_size") < 20, 6).otherwise(9)), span(F.concat("p_name", F.lit(" "), "p_type"), F.lit(9)))
    return p.select(F.col("p_partkey").alias("k"), spans.starts_with_marker(line, 16).alias("marked"), spans.line_id(F.lit(1), F.col("p_size"), F.lit(2), F.col("p_partkey")).alias("line_id"))


@query("SELECT doc_id, regexp_replace(replace(text, chr(160), ' '), '\\bTC R\\b', 'TCR', 'g') AS text FROM documents")
def text_repair(spark, d):
    return read(spark, d, "documents", "doc_id", "text").select("doc_id", T.repair(F.col("text")).alias("text"))


@query(f"WITH {_LINES} SELECT doc_id, count(*) AS num_lines_in, count(*) FILTER (WHERE length(line) >= 20) AS num_lines_kept FROM l GROUP BY doc_id")
def edition_counts(spark, d):
    return landing.edition_counts(doc_lines_of(spark, d), ["doc_id"], F.length("line") >= 20)


@query(f"WITH {_LOG} SELECT change_type, base64(encode(to_json({{'type': change_type, 'n': count(*)}}))) AS payload FROM change_log GROUP BY change_type")
def payload_base64(spark, d):
    return log_of(spark, d).groupBy("change_type").agg(F.count("*").alias("n")).select("change_type", F.base64(F.encode(F.to_json(F.struct(F.col("change_type").alias("type"), "n")), "UTF-8")).alias("payload"))


@query("""WITH t AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM benchmark),
dw AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS word FROM documents), n AS (SELECT item_id, unnest(w) AS word, len(w) AS k FROM t),
h AS (SELECT doc_id, item_id FROM dw JOIN n USING (word) GROUP BY doc_id, item_id, k HAVING count(*) = k) SELECT doc_id, min(item_id) AS slug FROM h GROUP BY doc_id HAVING count(*) = 1""")
def title_detect(spark, d):
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: x != ""))
    titles = read(spark, d, "benchmark").select(F.col("item_id").alias("slug"), words(F.col("text")).alias("tokens"))
    return landing.detect_titles(read(spark, d, "documents", "doc_id", "text").select("doc_id", words(F.col("text")).alias("tokens")), titles)


# ---- page parsers and what is assembled after them ----------------------------------------------------------------------


def laid_out(spark, d):
    """The documents' lines on pages of 50, with sizes and columns that follow from a line's place."""
    o = F.col("ord")
    at = o % 50
    left = F.when(o % 3 == 2, 160.0).otherwise(60.0)
    top = (50 + 12 * at).cast("double")
    size = F.when(at == 0, 20.0).when(at == 1, 10.5).when(at == 2, 9.5).when(at % 7 == 0, 12.0).when(at % 5 == 0, 10.5).otherwise(9.0)
    lines = doc_lines_of(spark, d)
    return lines.select("doc_id", F.floor(o / 50).cast("int").alias("page"), "ord", left.alias("x0"), top.alias("y0"), (left + 90).alias("x1"), (top + 10).alias("y1"), F.col("line").alias("text"), size.alias("size"), (at < 3).alias("bold"), F.array().cast("array<string>").alias("fonts"))


def turned(spark, d):
    """Rotated pages of eight parts of a brand: names at the top edge, descriptions at the bottom, wrapped ones further right."""
    p = read(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type").withColumn("n", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1)
    page, x = F.floor(F.col("n") / 8).cast("int"), F.col("n") % 8 * 40.0
    line = lambda at, y, text, size: F.struct(F.lit(at).cast("double").alias("at") if isinstance(at, float) else at.alias("at"), F.lit(y).alias("y"), text.alias("text"), F.lit(size).alias("size"))
    first = F.col("n") % 8 == 0
    lines = F.array(
        F.when(first, line(10.0, 400.0, F.concat("p_brand", F.lit(" (1 of 2)")), 12.0)), F.when(first, line(40.0, 700.0, F.lit("Field Name"), 9.0)), F.when(first, line(40.0, 300.0, F.lit("Description"), 9.0)),
        line(x + 60, 700.0, F.col("p_name"), 9.0), F.when(F.col("p_partkey") % 5 > 0, line(x + 62, 300.0, F.col("p_type"), 9.5)), F.when(F.col("p_partkey") % 5 > 2, line(x + 72, 300.0, F.lit("wrapped"), 9.5)),
    )
    rows = p.select(F.element_at(F.split("p_brand", "#"), 2).cast("long").alias("doc_id"), page.alias("page"), F.explode(F.array_compact(lines)).alias("l"), "p_partkey")
    return rows.select("doc_id", "page", (F.col("p_partkey") * 10 + F.col("l.at") / 100).cast("long").alias("ord"), F.col("l.at").alias("x0"), (F.col("l.y") - 60).alias("y0"), (F.col("l.at") + 9).alias("x1"), F.col("l.y").alias("y1"), F.col("l.text").alias("text"), F.col("l.size").alias("size"), F.lit(False).alias("bold"), F.array().cast("array<string>").alias("fonts"))


def _parsed(parser, lines=laid_out):
    def run(spark, d):
        blocks = folding.fold(lines(spark, d), ["doc_id"], parser)
        # Flat columns, for comparison.
        cells = F.array_join("cells", "|")
        columns = F.array_join(F.transform(F.array_sort(F.map_entries("columns")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
        return blocks.select("doc_id", "block", "page", "type", "level", "code", "title", "label", "text", cells.alias("cells"), F.array_join("items", "|").alias("items"), F.to_json("card").alias("card"), columns.alias("columns"))

    return run


for _name in ("code_tables", "numbered_sections"):
    QUERIES[_name] = _parsed(getattr(pages, _name))


def _flat(blocks):
    """Flat columns, for comparison; those that a layout has not are null."""
    own = {"level": F.lit(None).cast("int")} | {c: F.lit(None).cast("string") for c in ("code", "title", "label", "text", "cells", "items", "card", "columns")}
    own |= {c: F.array_join(c, "|") if c in ("cells", "items") else F.to_json(c) if c == "card" else F.col(c) for c in own if c in blocks.columns}
    return blocks.select("doc_id", "block", "page", "type", *(v.alias(c) for c, v in own.items()))


@query()
def index_blocks(spark, d):
    return _flat(flows.index_blocks(laid_out(spark, d), ["doc_id"]))


@query()
def narrative(spark, d):
    return _flat(flows.narrative(laid_out(spark, d), ["doc_id"]))


@query()
def label_cards(spark, d):
    return _flat(cards.label_cards(laid_out(spark, d), ["doc_id"]))


@query()
def field_cards(spark, d):
    return _flat(cards.field_cards(laid_out(spark, d), ["doc_id"]))


@query()
def rotated_pairs(spark, d):
    return _flat(cards.rotated_pairs(turned(spark, d), ["doc_id"]))


SQL["rotated_pairs"] = """WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS n FROM part)
SELECT CAST(string_split(p_brand, '#')[2] AS BIGINT) AS doc_id, row_number() OVER (PARTITION BY p_brand ORDER BY n) - 1 AS block, CAST(n // 8 AS INTEGER) AS page, 'field_description_pair' AS type, CAST(NULL AS INTEGER) AS level, CAST(NULL AS VARCHAR) AS code, p_brand AS title, p_name AS label,
CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 5 <= 2 THEN p_type ELSE p_type || ' wrapped' END AS text, CAST(NULL AS VARCHAR) AS cells, CAST(NULL AS VARCHAR) AS items, CAST(NULL AS VARCHAR) AS card, CAST(NULL AS VARCHAR) AS columns FROM p"""


def _tables(rotated: bool):
    def run(spark, d):
        blocks = tables.page_tables(laid_out(spark, d), ["doc_id"], rotated)
        columns = F.array_join(F.transform(F.array_sort(F.map_entries("columns")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
        return blocks.select("doc_id", "page", "ord", "type", "level", "title", "text", "anchor_column", columns.alias("columns"), F.array_join("items", "|").alias("items"), F.array_join("cells", "|").alias("cells"))

    return run


QUERIES["page_tables"], QUERIES["rotated_tables"] = _tables(False), _tables(True)


@query()
def pair_changes(spark, d):
    """Three editions of a manual of customers: segments are sections, customers rows, some with a paragraph.

    The second edition has some rows twice and some names reserved; in the third one section is renamed and one moves under another title.
    """
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"))
    k, e, moves = F.col("k"), F.col("e"), F.col("segment") == "MACHINERY"
    editions = spark.range(3).select(F.col("id").alias("e"))
    rows = c.join(F.broadcast(editions)).where("k % 10 <> e").withColumns({"nation": F.when((k % 7 == e) & ~moves, F.concat(F.lit("moved to "), "nation")).otherwise(F.col("nation")), "name": F.when((k % 13 == 0) & (e == 1) & ~moves, "Reserved").otherwise(F.col("name"))})
    again = rows.where("k % 50 = 0 and e = 1 and segment <> 'MACHINERY'").withColumn("nation", F.lit("again"))
    title = F.when((F.col("segment") == "BUILDING") & (e == 2), "BUILDINGS").when(moves & (e == 2), "HEAVY EQUIPMENT WORKS").otherwise(F.col("segment"))
    scope = [F.lit("customers").alias("manual"), F.concat(F.lit("2024010"), e.cast("string")).alias("edition")]
    first = F.xxhash64("segment").bitwiseAND(255) * 10_000_000
    none = F.array().cast("array<string>")
    cells = F.array(F.concat(F.lit("c"), k.cast("string")), "name", "nation")
    table = lambda df, late: df.select(*scope, (first + late + k).alias("ord"), F.lit("table_row").alias("type"), F.lit("").alias("text"), cells.alias("cells"))
    heads = rows.select("segment", "e").distinct().select(*scope, first.alias("ord"), F.lit("section_heading").alias("type"), title.alias("text"), none.alias("cells"))
    prose = c.join(F.broadcast(editions)).where("segment <> 'MACHINERY' and (k % 100 = 7 or (k % 100 = 8 and e <> 1))")
    prose = prose.select(*scope, (first + 6_000_000 + k).alias("ord"), F.lit("paragraph").alias("type"), F.concat(F.lit("Rule  "), k.cast("string"), F.lit(" applies")).alias("text"), none.alias("cells"))
    blocks = table(rows, 1).unionByName(table(again, 3_000_000)).unionByName(heads).unionByName(prose)
    return driver.changes(blocks, name_index=1).select("pair", "change_type", "title", "key", "column_index", "old", "new")


_P = """c AS (SELECT e, c_custkey AS k, CASE WHEN c_custkey % 13 = 0 AND e = 1 THEN 'Reserved' ELSE c_name END AS name, c_mktsegment AS segment, CASE WHEN c_custkey % 50 = 0 AND e = 1 THEN 'again' WHEN c_custkey % 7 = e THEN 'moved to ' || c_nationkey ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer, (SELECT unnest([0, 1, 2]) AS e)),
r AS (SELECT * FROM c WHERE k % 10 <> e AND NOT segment = 'MACHINERY'), m AS (SELECT * FROM c WHERE segment <> 'MACHINERY'),
m01 AS (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'),
ab AS (SELECT a.e, a.k, a.name AS n1, b.name AS n2, a.segment, a.nation AS old, b.nation AS new, b.k AS other FROM r a LEFT JOIN r b ON b.e = a.e + 1 AND b.k = a.k WHERE a.e < 2), ba AS (SELECT b.e - 1 AS e, b.k, b.name, b.segment, b.nation FROM r b LEFT JOIN r a ON a.e = b.e - 1 AND a.k = b.k WHERE b.e > 0 AND a.k IS NULL),
d AS (SELECT segment, string_agg('C' || k, ',' ORDER BY 'C' || k) AS keys FROM r WHERE e = 1 AND k % 50 = 0 GROUP BY segment)"""
SQL["pair_changes"] = f"""WITH {_P}, u AS (
SELECT e, 'row_content_changed' AS change_type, segment, 'C' || k AS key, 2 AS column_index, old, new FROM ab WHERE old <> new AND n1 = n2
UNION ALL SELECT e, CASE WHEN n2 = 'Reserved' THEN 'field_became_reserved' ELSE 'field_became_defined' END, segment, 'C' || k, NULL, 'c' || k || ' | ' || n1 || ' | ' || old, 'c' || k || ' | ' || n2 || ' | ' || new FROM ab WHERE n1 <> n2
UNION ALL SELECT e, 'row_removed', segment, 'C' || k, NULL, 'c' || k || ' | ' || n1 || ' | ' || old, NULL FROM ab WHERE other IS NULL
UNION ALL SELECT e, 'row_added', segment, 'C' || k, NULL, NULL, 'c' || k || ' | ' || name || ' | ' || nation FROM ba
UNION ALL SELECT 0, CASE WHEN c_custkey % 10 = 0 THEN 'row_added' ELSE 'row_removed' END, 'MACHINERY', 'C' || c_custkey, NULL, CASE WHEN c_custkey % 10 = 1 THEN 'c' || c_custkey || ' | ' || c_name || ' | ' || c_nationkey END, CASE WHEN c_custkey % 10 = 0 THEN 'c' || c_custkey || ' | ' || c_name || ' | ' || c_nationkey END FROM m01 WHERE c_custkey % 10 < 2
UNION ALL SELECT e, 'duplicate_key_warning', segment, NULL, NULL, CASE WHEN e = 1 THEN keys ELSE '' END, CASE WHEN e = 0 THEN keys ELSE '' END FROM d, (SELECT unnest([0, 1]) AS e)
UNION ALL SELECT 1, 'section_renamed', 'BUILDING', NULL, NULL, 'BUILDING', 'BUILDINGS' FROM (SELECT DISTINCT segment FROM r WHERE segment = 'BUILDING')
UNION ALL SELECT 1, unnest(['section_removed', 'section_added', 'possible_section_move']), unnest(['MACHINERY', 'HEAVY EQUIPMENT WORKS', 'HEAVY EQUIPMENT WORKS']), NULL, NULL, unnest([NULL, NULL, 'MACHINERY']), unnest([NULL, NULL, 'HEAVY EQUIPMENT WORKS']) FROM (SELECT DISTINCT c_mktsegment FROM m01)
UNION ALL SELECT e, CASE WHEN e = 0 THEN 'paragraph_removed' ELSE 'paragraph_added' END, segment, NULL, NULL, CASE WHEN e = 0 THEN 'Rule  ' || k || ' applies' END, CASE WHEN e = 1 THEN 'Rule  ' || k || ' applies' END FROM m WHERE k % 100 = 8 AND e < 2)
SELECT '2024010' || e || '_to_2024010' || (e + 1) AS pair, change_type, CASE WHEN segment = 'BUILDING' AND e = 1 THEN 'BUILDINGS' ELSE segment END AS title, key, CAST(column_index AS INTEGER) AS column_index, old, new FROM u"""


def order_pages(spark, d):
    """Pages of four orders of a customer: a header of which a part stands apart, lines of one or two cells, remarks below their order."""
    o = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority").withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1)
    k, y, first = F.col("o_orderkey"), 60.0 + F.col("n") % 4 * 40, F.col("n") % 4 == 0
    box = lambda x, y, text: [F.lit(x).alias("x0"), y.alias("y0"), F.lit(x + 50).alias("x1"), (y + 10).alias("y1"), text.alias("text")]
    parts = lambda *cells: F.array(*(F.struct(*box(x, y, t)) for x, t in cells))
    none = parts((0.0, F.lit(""))).cast("array<struct<x0:double,y0:double,x1:double,y1:double,text:string>>")

    def line(at, x, y, text, size=9.0, segments=None):
        return F.struct(F.lit(at).alias("at"), *box(x, y, text), F.lit(size).alias("size"), F.lit(size > 9).alias("bold"), (F.when(F.lit(False), none) if segments is None else segments).alias("segments"))

    head = lambda at, x, text: F.when(first, line(at, x, F.lit(40.0), F.lit(text), 9.5))
    status, priority, key = F.col("o_orderstatus"), F.col("o_orderpriority"), k.cast("string")
    lines = F.array(
        F.when(first, line(10, 60.0, F.lit(20.0), F.lit("Orders"), 10.5)), head(11, 60.0, "Order"), head(12, 200.0, "Sta"), head(13, 260.0, " tus"), head(14, 400.0, "Priority"),
        F.when(first & (F.floor(F.col("n") / 4) % 2 == 1), line(0, 400.0, F.lit(50.0), F.lit("brought over"))),
        F.when(k % 4 == 0, line(1, 60.0, y, F.concat(key, F.lit(" open")), segments=parts((60.0, key), (90.0, F.lit("open"))))).otherwise(line(1, 60.0, y, key)),
        F.when(k % 3 == 0, line(2, 200.0, y, F.concat(status, F.lit("  "), priority), segments=parts((200.0, status), (400.0, priority)))).otherwise(line(2, 200.0, y, status)),
        F.when(k % 3 > 0, line(3, 400.0, y, priority)), F.when((F.col("o_custkey") % 2 == 0) & (k % 7 == 0), line(4, 260.0, y, F.lit("late"))), F.when(k % 5 == 0, line(5, 60.0, y + 20, F.lit("– see note"))),
    )
    rows = o.select(F.col("o_custkey").alias("doc_id"), F.floor(F.col("n") / 4).cast("int").alias("page"), "o_orderkey", F.explode(F.array_compact(lines)).alias("l"))
    return rows.select("doc_id", "page", (F.col("o_orderkey") * 100 + F.col("l.at")).alias("ord"), *(F.col("l." + c) for c in ("x0", "y0", "x1", "y1", "text", "size", "bold", "segments")), F.array().cast("array<string>").alias("fonts"))


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n, o_custkey % 2 = 0 AND o_orderkey % 7 = 0 AS late, o_orderkey % 5 = 0 AS noted FROM orders),
t AS (SELECT *, n // 4 AS page, bool_or(late) OVER w AS ever, count(*) OVER w + count(*) FILTER (noted) OVER w AS lines FROM o WINDOW w AS (PARTITION BY o_custkey, n // 4)),
r AS (SELECT *, 'Order=' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN ' open' ELSE '' END || CASE WHEN noted THEN ' – see note' ELSE '' END || '|Priority=' || o_orderpriority AS own FROM t)
SELECT o_custkey AS doc_id, CAST(page AS INTEGER) AS page, o_orderkey * 100 + 1 AS ord, 'Orders' AS title, 'Order' AS anchor_column, CASE WHEN lines > 1 AND NOT ever THEN 'Order|Sta tus|Priority' ELSE 'Order|Sta|tus|Priority' END AS items,
own || CASE WHEN lines > 1 AND NOT ever THEN '|Sta tus=' || o_orderstatus ELSE '|Sta=' || o_orderstatus || '|tus=' || CASE WHEN late THEN 'late' ELSE '' END END AS columns FROM r
UNION ALL SELECT o_custkey, CAST(page AS INTEGER), o_orderkey * 100, 'Orders', 'Order', '__unassigned_prefix__', '__unassigned_prefix__=brought over' FROM t WHERE n % 4 = 0 AND page % 2 = 1""")
def final_tables(spark, d):
    columns = F.array_join(F.transform(F.array_sort(F.map_entries("columns")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    rows = tables.final_tables(order_pages(spark, d), ["doc_id"]).where("type = 'grid_row'")
    return rows.select("doc_id", "page", "ord", "title", "anchor_column", F.array_join("items", "|").alias("items"), columns.alias("columns"))


@query("""WITH t AS (SELECT o_custkey AS s, o_orderkey AS ord, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + o_orderkey % 2 AS INTEGER) AS page, CASE WHEN o_orderkey % 5 = 0 THEN 'T' END AS table_id, CAST(o_orderkey % 11 = 0 AS VARCHAR) AS section, '| ' || o_orderstatus || ' |  |' AS head, '| ' || o_orderkey || ' | x |' AS row FROM orders),
b AS (SELECT *, lag(page) OVER w AS p, lag(section) OVER w AS sec, lag(head) OVER w AS h FROM t WINDOW w AS (PARTITION BY s ORDER BY ord)), c AS (SELECT *, coalesce(page = p + 1 AND table_id IS NULL AND section IS NOT DISTINCT FROM sec AND lower(head) = lower(h), false) AS on_ FROM b),
g AS (SELECT *, sum(CASE WHEN on_ THEN 0 ELSE 1 END) OVER (PARTITION BY s ORDER BY ord) AS grp FROM c)
SELECT s, min(ord) AS ord, min(page) AS page, max(page) AS page_end, arg_min(section, ord) AS section, count(*) AS parts, string_agg(CASE WHEN on_ THEN row ELSE head || chr(10) || '|-|-|' || chr(10) || row END, chr(10) ORDER BY ord) AS text FROM g GROUP BY s, grp""")
def table_continuation(spark, d):
    o, k = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus"), F.col("o_orderkey")
    text = F.concat(F.lit("| "), "o_orderstatus", F.lit(" |  |\n|-|-|\n| "), k.cast("string"), F.lit(" | x |"))
    page = (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) + k % 2).cast("int")
    tables = o.select(F.col("o_custkey").alias("s"), k.alias("ord"), page.alias("page"), F.when(k % 5 == 0, "T").alias("table_id"), (k % 11 == 0).cast("string").alias("section"), text.alias("text"))
    return assembly.continued_tables(tables, ["s"]).select("s", "ord", "page", "page_end", "section", "parts", "text")


@query("""WITH r AS (SELECT o_custkey AS s, o_orderkey AS ord, CASE WHEN o_orderkey % 3 = 0 THEN '– ' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS a, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END AS b FROM orders),
o AS (SELECT *, a LIKE '– %' AND b = '' AND row_number() OVER (PARTITION BY s ORDER BY ord) > 1 AS orphan FROM r), g AS (SELECT *, sum(CASE WHEN orphan THEN 0 ELSE 1 END) OVER (PARTITION BY s ORDER BY ord) AS grp FROM o)
SELECT s, min(ord) AS ord, string_agg(a, ' ' ORDER BY ord) AS a, arg_min(b, ord) AS b, count(*) AS n FROM g GROUP BY s, grp""")
def dash_orphan(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("– "), k.cast("string"))).otherwise(k.cast("string"))
    rows = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus").select(F.col("o_custkey").alias("s"), k.alias("ord"), text.alias("a"), F.when(k % 2 == 0, "").otherwise(F.col("o_orderstatus")).alias("b"))
    return assembly.dash_orphans(rows, ["s"], "a", ["b"])


@query("""WITH r AS (SELECT c_mktsegment AS s, c_custkey AS k, c_name AS n, CASE WHEN c_nationkey >= 0 THEN '' END AS e FROM customer), z AS (SELECT s, count(*) AS c FROM r GROUP BY s)
SELECT k, s, CASE WHEN c > 1 THEN 'Na me=' || n ELSE ' me=|Na=' || n END AS columns FROM r JOIN z USING (s)""")
def phantom_columns(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    names = F.array(F.lit("Na"), F.lit("me"))
    rows = c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s"), F.create_map(F.lit("Na"), "c_name", F.lit("me"), F.lit("")).alias("columns"), names.alias("names"), F.array(F.lit("me")).alias("spaced"))
    return assembly.phantom_columns(rows, ["s"]).select("k", "s", F.array_join(F.transform(F.map_entries("columns"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("columns"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, CAST(l_partkey AS VARCHAR) AS t, CAST(l_suppkey AS VARCHAR) AS u FROM lineitem), c AS (SELECT *, CASE WHEN q <= 25 THEN 'low' ELSE 'high' END AS c1, CASE WHEN q + 20 <= 25 THEN 'low' ELSE 'high' END AS c2 FROM x)
SELECT l_orderkey, l_linenumber, 0 AS segment, c1 AS column, CASE WHEN c1 = c2 THEN t || ' ' || u ELSE t END AS text FROM c UNION ALL SELECT l_orderkey, l_linenumber, 1, c2, u FROM c WHERE c1 <> c2""")
def resegment(spark, d):
    q = F.col("l_quantity").cast("double")
    piece = lambda x, t: F.struct(x.alias("x"), F.col(t).cast("string").alias("text"))
    band = lambda n, x: F.struct(F.lit(n).alias("name"), F.lit(x).alias("x"))
    rows = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", F.array(piece(q, "l_partkey"), piece(q + 20, "l_suppkey")).alias("segments"), F.array(band("low", 0.0), band("high", 50.0)).alias("columns"))
    return assembly.resegment(rows, ["l_orderkey", "l_linenumber"])


_IX = """ix AS (SELECT 'Table ' || s_suppkey || '-' || s_nationkey AS ref, s_suppkey AS n, 'Table ' || s_suppkey || '-' || s_nationkey || ': ' || s_name || chr(10) || 'body' AS content FROM supplier)"""


def supplier_tables(spark, d):
    name = F.concat(F.lit("Table "), F.col("s_suppkey").cast("string"), F.lit("-"), F.col("s_nationkey").cast("string"))
    return read(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_name").select(F.lit(0).alias("guide"), F.col("s_suppkey").alias("ord"), name.alias("table_id"), F.col("s_name").alias("title"), F.lit("body").alias("text"))


@query(f"""WITH {_IX}, r AS (SELECT c_custkey AS k, 'Table ' || (c_custkey % 9) || '-' || c_nationkey AS ref FROM customer)
SELECT k, r.ref, coalesce(a.content, '[Table ' || r.ref || ' not found in extracted guide]') AS old, coalesce(b.content, '[Table ' || r.ref || ' not found in extracted guide]') AS new, coalesce(a.content, '') = coalesce(b.content, '') AS unchanged FROM r LEFT JOIN ix a USING (ref) LEFT JOIN (SELECT * FROM ix WHERE n % 2 = 0) b ON b.ref = r.ref""")
def table_ref_enrich(spark, d):
    text = lambda dash: F.concat(F.lit("as in table "), (F.col("c_custkey") % 9).cast("string"), F.lit(dash), F.col("c_nationkey").cast("string"), F.lit("."))
    changes = read(spark, d, "customer", "c_custkey", "c_nationkey").select(F.col("c_custkey").alias("k"), F.replace(text("–"), F.lit("table"), F.lit("Table")).alias("old"), F.replace(text("-"), F.lit("table"), F.lit("Table")).alias("new"))
    index = assembly.table_index(supplier_tables(spark, d), ["guide"])
    later = assembly.table_index(supplier_tables(spark, d).where("ord % 2 = 0"), ["guide"])
    return assembly.with_references(changes, ["k"], index, later)


@query("""SELECT o_custkey AS guide, o_orderpriority AS table_id, o_orderpriority || ': ' || arg_max(o_orderstatus, o_orderkey) || chr(10) || max(o_orderkey) AS content FROM orders GROUP BY 1, 2""")
def last_wins_index(spark, d):
    o = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus").select(F.col("o_custkey").alias("guide"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("table_id"), F.col("o_orderstatus").alias("title"), F.col("o_orderkey").cast("string").alias("text"))
    return assembly.table_index(o, ["guide"])


@query("""SELECT p_partkey AS k, lower(p_brand || ' ' || p_type) AS old, lower(p_brand || ' ' || p_type || ' %') AS new FROM part WHERE p_partkey % 7 = 0""")
def rate_diff(spark, d):
    p = read(spark, d, "part", "p_partkey", "p_brand", "p_type").select(F.col("p_partkey").alias("k"), F.concat_ws("  ", "p_brand", "p_type").alias("old_rate"), F.concat_ws(" ", "p_brand", "p_type").alias("new_rate"))
    return assembly.rate_changes(p.withColumn("new_rate", F.when(F.col("k") % 7 == 0, F.concat("new_rate", F.lit(" %"))).otherwise(F.col("new_rate"))), ["k"])


@query(f"""WITH {_C}, x AS (SELECT a.k AS ak, b.k AS bk, a.name || ' ' || a.segment AS o, b.name || ' ' || b.segment AS n FROM a FULL JOIN b ON a.k = b.k)
SELECT ak AS k, 'criteria_changed' AS change_type, o AS old, n AS new FROM x WHERE o <> n UNION ALL SELECT ak, 'criteria_table_removed', o || ' All rights reserved', '' FROM x WHERE bk IS NULL UNION ALL SELECT bk, 'criteria_table_added', '', n || ' All rights reserved' FROM x WHERE ak IS NULL""")
def criteria_diff(spark, d):
    a, b = (c.select("k", F.concat_ws(" ", "name", "segment", F.lit("All rights reserved")).alias("text")) for c in customers(spark, d))
    return assembly.criteria_changes(a, b, ["k"]).drop("ratio")


@query(f"""WITH {_LOG}, s AS (SELECT 1 AS part, k AS ord, '- ' || k || ': ' || old || ' -> ' || new AS line FROM change_log WHERE change_type = 'content_changed' UNION ALL SELECT 2, k, '- ' || k || ' ' || change_type FROM change_log WHERE change_type <> 'content_changed'),
h AS (SELECT part, count(*) AS n FROM s GROUP BY part), t AS (SELECT part, -1 AS ord, CASE part WHEN 1 THEN '## Content changes' ELSE '## Structure' END || ' (' || n || ')' AS line FROM h)
SELECT part, string_agg(line, chr(10) ORDER BY ord) AS body FROM (SELECT * FROM s UNION ALL SELECT * FROM t) GROUP BY part""")
def full_report(spark, d):
    log = log_of(spark, d)
    content = log.where("change_type = 'content_changed'").select("k", F.concat(F.lit("- "), F.col("k").cast("string"), F.lit(": "), "old", F.lit(" -> "), "new").alias("line"))
    structure = log.where("change_type <> 'content_changed'").select("k", F.concat(F.lit("- "), F.col("k").cast("string"), F.lit(" "), "change_type").alias("line"))
    return reporting.report([("Content changes", content), ("Structure", structure)], "k")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
