"""Cleaning rules (C1-C11) and document operators (P1-P18) on texts written from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import clean
from tidemart.functions.jsonpath import json_get
from tidemart.operators import documents, project
from tidemart.plans.registry import on

# -- cleaning rules ---------------------------------------------------------------------------

# Order numbers written the ways shops write them.
TEXTS = """
SELECT o_orderkey, o_orderkey AS n,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderkey AS STRING) || ' sold'
       WHEN o_orderkey % 9 = 1 THEN '1,' || CAST(100 + o_orderkey % 900 AS STRING) || ' items'
       WHEN o_orderkey % 9 = 2 THEN CAST(o_orderkey % 90 AS STRING) || '.' || CAST(o_orderkey % 7 AS STRING) || 'K'
       WHEN o_orderkey % 9 = 3 THEN CAST(o_orderkey % 70 AS STRING) || 'K+'
       WHEN o_orderkey % 9 = 4 THEN CAST(o_orderkey % 50 AS STRING) || '.50' || '万'
       WHEN o_orderkey % 9 = 5 THEN '-2.' || CAST(o_orderkey % 10 AS STRING)
       WHEN o_orderkey % 9 = 6 THEN 'null'
       WHEN o_orderkey % 9 = 7 THEN '  ' ELSE o_orderpriority END AS t
FROM {orders}
"""
_T = f"WITH x AS ({TEXTS.format(orders='orders')}) "
_NUM = r"nullif(regexp_extract(replace(t, ',', ''), '-?\d+(?:\.\d+)?'), '')"
_FACTOR = ("CASE WHEN upper(t) LIKE '%万%' THEN 10000.0::DOUBLE WHEN upper(t) LIKE '%K%' THEN 1000.0::DOUBLE "
           "WHEN upper(t) LIKE '%M%' THEN 1000000.0::DOUBLE ELSE 1.0::DOUBLE END")
_HUMAN = f"CAST(floor(CAST({_NUM} AS DOUBLE) * {_FACTOR} + 0.5) AS BIGINT)"


def _rule(name, rule, oracle, source=TEXTS, head=_T, cols="o_orderkey"):
    on(name, lambda t: t.sql(source).select(cols, rule(F.col("t")).alias("v")), f"{head} SELECT {cols}, {oracle} AS v FROM x")


_rule("c1_parse_human_number", clean.parse_human_number, _HUMAN)
_rule("c2_parse_decimal_text", clean.parse_decimal_text,
      f"regexp_replace(regexp_replace(CAST(CAST({_NUM} AS DECIMAL(18,4)) AS VARCHAR), '0+$', ''), '\\.$', '')")
on("c3_number_with_unit_fallback",
   lambda t: t.sql(TEXTS).select("o_orderkey", clean.number_with_unit_fallback(
       F.col("t"), F.expr("CASE WHEN n % 4 <> 0 THEN concat('[\"', n % 60, 'K\",\"Sold\"]') END")).alias("v")),
   f"{_T} SELECT o_orderkey, coalesce({_HUMAN}, CASE WHEN n % 4 <> 0 THEN (n % 60) * 1000 END) AS v FROM x")
_rule("c4_to_long", clean.to_long, _HUMAN)
_rule("c5_to_double", clean.to_double, f"CAST({_NUM} AS DOUBLE)")

WORDS = """
SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'true' WHEN event_id % 8 = 1 THEN ' YES ' WHEN event_id % 8 = 2 THEN '1'
  WHEN event_id % 8 = 3 THEN 'False' WHEN event_id % 8 = 4 THEN 'no' WHEN event_id % 8 = 5 THEN '0'
  WHEN event_id % 8 = 6 THEN event_type ELSE CAST(user_id AS STRING) END AS t
FROM {events}
"""
_rule("c6_to_boolean", clean.to_boolean,
      "CASE WHEN lower(trim(t)) IN ('true', 'yes', '1') THEN true WHEN lower(trim(t)) IN ('false', 'no', '0') THEN false "
      "ELSE abs(TRY_CAST(t AS DOUBLE)) >= 1 END", WORDS, f"WITH x AS ({WORDS.format(events='events')}) ", "event_id")

DAYS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'on ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:00'
  WHEN o_orderkey % 4 = 1 THEN '2024-13-45' WHEN o_orderkey % 4 = 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
  ELSE o_orderpriority END AS t
FROM {orders}
"""
_rule("c7_to_date", clean.to_date, r"TRY_CAST(nullif(regexp_extract(t, '\d{4}-\d{2}-\d{2}'), '') AS DATE)", DAYS,
      f"WITH x AS ({DAYS.format(orders='orders')}) ")

AMOUNTS = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 0 THEN 'n/a' WHEN l_linenumber % 4 = 1
  THEN CAST(l_partkey AS STRING) || '.00' || CAST(l_suppkey AS STRING) || '5' WHEN l_linenumber % 4 = 2
  THEN '-' || CAST(l_partkey AS STRING) || '.12345' ELSE CAST(l_partkey AS STRING) || '.0' END AS t
FROM {lineitem}
"""
_A = f"WITH x AS ({AMOUNTS.format(lineitem='lineitem')}) "
on("c8_to_scaled_decimal", lambda t: t.sql(AMOUNTS).select(
    "l_orderkey", "l_linenumber", clean.to_scaled_decimal(F.col("t"), 4).alias("v")),
   f"{_A} SELECT l_orderkey, l_linenumber, CAST(TRY_CAST(t AS DECIMAL(38,10)) AS DECIMAL(20,4)) AS v FROM x")
# A JSON number loses its fraction, the same digits as text have none to lose.
on("c9_json_long", lambda t: t["events"].select("event_id", F.from_json(F.expr("""concat('{"a":', user_id, '.5,"b":"', user_id,
  '.5","c":', user_id, ',"d":"', user_id, '.0","e":-', user_id, '.75,"f":1e30,"g":true,"h":null}')"""),
    "a variant, b variant, c variant, d variant, e variant, f variant, g variant, h variant").alias("v")).select(
    "event_id", *[clean.json_long(F.col(f"v.{n}")).alias(n) for n in "abcdefgh"], clean.json_int(F.col("v.c")).alias("i")), """
SELECT event_id, user_id AS a, CAST(NULL AS BIGINT) AS b, user_id AS c, user_id AS d, -user_id AS e, CAST(NULL AS BIGINT) AS f,
  CAST(NULL AS BIGINT) AS g, CAST(NULL AS BIGINT) AS h, CAST(user_id AS INT) AS i FROM events""")
on("c9_to_exact_long", lambda t: t.sql(AMOUNTS).select(
    "l_orderkey", "l_linenumber", clean.to_exact_long(F.col("t")).alias("v"),
    clean.to_exact_int(F.concat(F.col("t"))).alias("i"),
    clean.to_exact_int(F.lit("3000000000")).alias("too_large")),
   f"{_A} SELECT l_orderkey, l_linenumber, CASE WHEN t LIKE '%.0' THEN CAST(TRY_CAST(t AS DOUBLE) AS BIGINT) END AS v, "
   "CASE WHEN t LIKE '%.0' THEN CAST(TRY_CAST(t AS DOUBLE) AS INT) END AS i, CAST(NULL AS INT) AS too_large FROM x")

MOMENTS = """
SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS d, CASE WHEN event_id % 6 = 0
  THEN CAST(CAST(ts AS DATE) AS STRING) || 'T00:13:41+08:00' WHEN event_id % 6 = 1
  THEN CAST(CAST(ts AS DATE) AS STRING) || 'T23:59:59' WHEN event_id % 6 = 2
  THEN CAST(CAST(ts AS DATE) AS STRING) || 'T10:20Z' WHEN event_id % 6 = 3
  THEN CAST(CAST(ts AS DATE) AS STRING) || ' 11:22:33.5' WHEN event_id % 6 = 4 THEN ' ' ELSE event_type END AS t
FROM {events}
"""
_rule("c10_normalise_datetime", clean.normalise_datetime,
      "CASE WHEN event_id % 6 = 0 THEN d || ' 00:13:41' WHEN event_id % 6 = 1 THEN d || ' 23:59:59' "
      "WHEN event_id % 6 = 2 THEN d || ' 10:20:00' WHEN event_id % 6 = 3 THEN d || ' 11:22:33' END",
      MOMENTS, f"WITH x AS ({MOMENTS.format(events='events')}) ", "event_id")
_rule("c11_blank_to_null", clean.blank_to_null, "CASE WHEN trim(t) <> '' THEN t END")

# -- documents --------------------------------------------------------------------------------


def _docs(t, expr: str, *cols: str):
    """Events with a document text built from them."""
    return t["events"].select("event_id", "user_id", "event_type", "ts", "props", *cols, F.expr(expr).alias("doc"))


_FORMS = """CASE event_id % 4
  WHEN 0 THEN concat('{"id": ', event_id, ', "t": "', event_type, '", "ok": true}')
  WHEN 1 THEN concat("{'id': ", event_id, ", 't': 'None ", event_type, "', 'ok': True, 'no': None,}")
  WHEN 2 THEN concat('{id: ', event_id, ', t: "', event_type, '", ok: false}')
  ELSE concat('{"id": ', event_id, ', "t": ') END"""


def _p1(t):
    parsed = documents.parse_tolerant_json(_docs(t, _FORMS).withColumnRenamed("doc", "value"))
    return parsed.select("event_id", *[F.get_json_object("doc", f"$.{c}").alias(c) for c in ("id", "t", "ok", "no")])


on("p1_parse_tolerant_json", _p1, """
SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(event_id AS VARCHAR) END AS id,
  CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'None ' || event_type WHEN 2 THEN event_type END AS t,
  CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'true' WHEN 2 THEN 'false' END AS ok, CAST(NULL AS VARCHAR) AS no
FROM events""")
on("p1_quarantine", lambda t: documents.split_quarantine(_docs(t, _FORMS).withColumnRenamed("doc", "value"))[1]
   .groupBy("event_type").agg(F.count("*").alias("bad")),
   "SELECT event_type, count(*) AS bad FROM events WHERE event_id % 4 = 3 GROUP BY ALL")

_NESTED = """to_json(named_struct('id', event_id, 'a', named_struct('b', array(named_struct('c', user_id),
  named_struct('c', user_id + 1)), 't', event_type, 'e', ''), 'p', props, 'null', CAST(NULL AS STRING)))"""


def _project(mapping, types, expr=_NESTED, **kw):
    return lambda t: project.project_by_mapping(_docs(t, expr), mapping, types, keep=("event_id",), singles=None, **kw)


on("p2_project_by_mapping", _project(
    {"id": "id", "kind": "a.t", "gone": "a.x", "unset": "", "unknown": "a.t"},
    {"id": "BIGINT", "kind": "STRING", "gone": "STRING", "unset": "BIGINT"}),
   "SELECT event_id, event_id AS id, event_type AS kind, CAST(NULL AS VARCHAR) AS gone, CAST(NULL AS BIGINT) AS unset "
   "FROM events")
on("p3_path_dialect", _project(
    {"name": "a.t", "bracket": "a.b[0].c", "number": "a.b.1.c", "outside": "a.b[5].c", "empty": "a.e", "nothing": "null"},
    {"name": "STRING", "bracket": "BIGINT", "number": "BIGINT", "outside": "BIGINT", "empty": "STRING",
     "nothing": "STRING"}),
   "SELECT event_id, event_type AS name, user_id AS bracket, user_id + 1 AS number, CAST(NULL AS BIGINT) AS outside, "
   "'' AS empty, CAST(NULL AS VARCHAR) AS nothing FROM events")


def _p4(t):
    from tidemart.operators.explode import explode_crumbs

    docs = _docs(t, _NESTED).withColumn("list", json_get(F.col("doc"), ["a", "b"]))
    rows = explode_crumbs(docs, "list")
    return rows.select("event_id", "pos", F.get_json_object("item", "$.c").cast("bigint").alias("c"))


on("p4_path_variables", _p4, """
SELECT event_id, CAST(i AS INT) AS pos, user_id + i AS c FROM events, (SELECT unnest([0, 1]) AS i)""")

_MAPS = """concat('{"m":{"z":', CASE WHEN event_id % 2 = 0 THEN '{"v":""}' ELSE concat('{"v":"z', event_id, '"}') END,
  ',"a":{"v":"a', event_id, '","l":[{"w":null},{"w":', user_id, '}]}}}')"""
on("p5_wildcards", _project(
    {"v": ["m.value.v"], "w": ["m.value.l[i].w"]}, {"v": "STRING", "w": "BIGINT"}, _MAPS, mode="eligible"),
   "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'z' END || event_id AS v, user_id AS w FROM events")

_FLAT = """concat('{"g.id":', event_id, ',"g.l[0].u":"x', user_id, '"',
  CASE WHEN event_id % 2 = 0 THEN concat(',"g.l[1].u":"y', user_id, '"') ELSE '' END, ',"h":{"k.q":"', event_type, '"}}')"""


def _flat(mapping, types):
    def run(t):
        docs = documents.parse_tolerant_json(_docs(t, _FLAT).withColumnRenamed("doc", "value"))
        return project.project_by_mapping(docs, mapping, types, keep=("event_id",), mode="eligible")

    return run


on("p6_flattened_lookup", _flat(
    {"id": "g.id", "first": "g.l[0].u", "second": "g.l.1.u", "q": "h.k.q"},
    {"id": "BIGINT", "first": "STRING", "second": "STRING", "q": "STRING"}),
   "SELECT event_id, event_id AS id, 'x' || user_id AS first, CASE WHEN event_id % 2 = 0 THEN 'y' || user_id END AS second, "
   "event_type AS q FROM events")
# Of a mapped section, keys that only look flattened stay as they are; so does what no path reaches.
_UNMAPPED = """concat('{"g.id": ', event_id, ', "ext": {"p.search":"', event_type, '", "n": 1.50}, "o.x": {"y.z": 1}}')"""


def _p6_unmapped(t):
    paths = {"id": "g.id", "ext": "ext", "other": "o.y"}
    docs = documents.parse_tolerant_json(_docs(t, _UNMAPPED).withColumnRenamed("doc", "value"), paths=paths.values())
    return project.project_by_mapping(docs, paths, {"id": "BIGINT", "ext": "JSON", "other": "STRING"}, keep=("event_id",),
                                      mode="eligible").select("event_id", "id", F.get_json_object("ext", "$['p.search']").alias("kept"),
                                                              F.size(F.json_object_keys("ext")).alias("keys"), "other")


on("p6_unmapped_keys", _p6_unmapped, """
SELECT event_id, event_id AS id, event_type AS kept, CAST(2 AS INT) AS keys, CAST(NULL AS VARCHAR) AS other FROM events""")
on("p7_unflatten", _flat({"l": "g.l"}, {"l": "JSON"}),
   """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '[{"u":"x' || user_id || '"},{"u":"y' || user_id || '"}]'
   ELSE '{"u":"x' || user_id || '"}' END AS l FROM events""")

_ORDERED = """concat('{"a":', CASE event_id % 5 WHEN 0 THEN '""' WHEN 1 THEN 'null' WHEN 2 THEN '[]' WHEN 3 THEN '"none"'
  ELSE concat('"', user_id, ' pcs"') END, ',"b":{"n":', event_id, '},"c":"', event_type, '"}')"""
on("p8_coalesce_sources", _project(
    {"number": ["a", "b.n"], "text": ["a", "c"]}, {"number": "BIGINT", "text": "STRING"}, _ORDERED, mode="eligible"),
   """SELECT event_id, CASE WHEN event_id % 5 = 4 THEN user_id ELSE event_id END AS number,
   CASE event_id % 5 WHEN 3 THEN 'none' WHEN 4 THEN user_id || ' pcs' ELSE event_type END AS text FROM events""")
_RULED = """concat('{"t":"', CASE WHEN event_id % 3 = 0 THEN ' Temu ' ELSE event_type END, '","u":"u', user_id, '","s":"By"}')"""
on("p9_field_rules", _project(
    {"title": ["t", "u"], "salesTipText": "s"}, {"title": "STRING", "salesTipText": "JSON"}, _RULED, mode="eligible"),
   """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'u' || user_id ELSE event_type END AS title,
   '["By"]' AS salesTipText FROM events""")


def _p10(t):
    expr = """CASE event_id % 3 WHEN 0 THEN concat('{"reviewId":"', event_id, '","id":1}')
      WHEN 1 THEN concat('{"comment_id":"', event_id, '"}') ELSE concat('{"user":{"name":"', event_type, '"}}') END"""
    docs = _docs(t, expr).withColumn("item", F.from_json("doc", "map<string,string>"))
    item = F.col("item")
    return docs.select(
        "event_id", project.with_aliases(item, "reviewId", ("review_id", "commentId", "comment_id", "id")).alias("id"),
        project.with_aliases(item, "name", ("nickname", "user.name")).alias("name"))


on("p10_alias_fallback", _p10, """
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN event_id % 3 = 2 THEN event_type END AS name FROM events""")


def _p11(t):
    expr = """CASE event_id % 3 WHEN 0 THEN concat('{"z":{"id":', event_id, '},"a":{"id":-1}}')
      WHEN 1 THEN concat('{"z":5,"id":', user_id, '}') ELSE concat('{"z":{},"id":', user_id, '}') END"""
    docs = _docs(t, expr)
    inner = documents.unwrap_envelope(F.col("doc"))
    return docs.select("event_id", F.get_json_object(inner, "$.id").cast("bigint").alias("id"))


on("p11_unwrap_envelope", _p11,
   "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id ELSE user_id END AS id FROM events")


def _p12(t):
    from tidemart.operators.explode import explode_list_outer

    page = project.project_by_mapping(
        _docs(t, _NESTED), {"kind": "a.t", "l": "a.b"}, {"kind": "STRING", "l": "STRING"}, keep=("event_id",), singles=None)
    rows = explode_list_outer(page, "l")
    return rows.select("event_id", "kind", F.get_json_object("item", "$.c").cast("bigint").alias("c"))


on("p12_page_constants", _p12, """
SELECT event_id, event_type AS kind, user_id + i AS c FROM events, (SELECT unnest([0, 1]) AS i)""")
on("p13_embedded_json", lambda t: _docs(
    t, "CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN concat('[', user_id, ']') ELSE event_type END")
   .select("event_id", project.embedded_json(F.col("doc")).alias("v")),
   "SELECT event_id, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN '[' || user_id || ']' END AS v FROM events")


def _p14(t):
    raw = t["events"].select(
        F.col("event_id").cast("string").alias("id"), F.concat(F.col("user_id"), F.lit("K sold")).alias("salesNum"),
        F.concat(F.to_date("ts").cast("string"), F.lit(" x")).alias("day"), "event_type", "value")
    return project.cast_layer(raw, {
        "id": "BIGINT", "salesNum": "BIGINT", "day": "DATE", "event_type": "STRING", "absent": "DOUBLE"})


on("p14_cast_layer", _p14, """
SELECT event_id AS id, user_id * 1000 AS salesNum, CAST(ts AS DATE) AS day, event_type, CAST(NULL AS DOUBLE) AS absent
FROM events""")


def _p15(t):
    expr = """CASE event_id % 3 WHEN 0 THEN concat('{"b":[{"c":"', event_type, '"},{"c":', user_id, '}]}')
      WHEN 1 THEN concat('{"b":{"c":"', event_type, '"}}') ELSE '{"b":[]}' END"""
    return _docs(t, expr).select("event_id", project.nested_leaves(F.col("doc"), ["b", "c"]).alias("v"))


on("p15_nested_leaves", _p15, """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN '["' || event_type || '",' || user_id || ']' WHEN 1 THEN event_type END AS v
FROM events""")
on("p16_keep_entries_with", lambda t: _docs(
    t, """CASE event_id % 3 WHEN 0 THEN concat('[{"optId":', user_id, '},{"x":1},{"optId":"', event_type, '"}]')
      WHEN 1 THEN concat('{"optId":', user_id, '}') ELSE 'bad' END""")
   .select("event_id", project.keep_entries_with(F.col("doc"), "optId").alias("v")), """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '[{"optId":' || user_id || '},{"optId":"' || event_type || '"}]'
  ELSE '[]' END AS v FROM events""")
on("p17_leaf_category", lambda t: _docs(
    t, """CASE event_id % 3 WHEN 0 THEN concat('[{"catId":1,"isLeaf":false},{"catId":', user_id, ',"isLeaf":true}]')
      WHEN 1 THEN '[{"catId":1}]' ELSE '{}' END""")
   .select("event_id", project.leaf_category(F.col("doc")).alias("v")),
   "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS v FROM events")
on("p18_stamp", lambda t: project.stamp(t["events"].select("event_id"), "2024-02-01", "2024-02-01 08:00:00"),
   "SELECT event_id, DATE '2024-02-01' AS run_date, TIMESTAMP '2024-02-01 08:00:00' AS run_ts FROM events")
