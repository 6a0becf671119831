"""Catalogue: cleaning (B), remap and audit (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley import params
from trolley.functions.labels import normalise_label, season_of_month, segment
from trolley.operators import clean as CL
from trolley.operators import remap as RM
from trolley.operators.star import dim_basket
from trolley.plans.registry import query
from trolley.plans.sqlbase import baskets_cte, lines_cte, segment_sql, with_
from trolley.sources import adapter
from trolley.sources.tables import read_table

L = lines_cte()
B = baskets_cte()

# --- test parameters over the driver's tables (part names are "adjective noun") --
LABEL_MAP = {"ECONOMY": "VALUE", "PROMO": "OFFERS", "STANDARD": "CORE"}
OVERRIDES = [(1, "Brand#25"), (2, "Brand#25"), (3, "Brand#24"), (4, "Brand#24"), (5, "Brand#23"),
             (6, "Brand#23"), (7, "Brand#22")]
DROP_CATEGORY = "Brand#1"
REMAP_RULES = [
    (1, "name", "*", "red widget", "Brand#1", None),
    (2, "name", "Brand#5", "Blue  Bolt", "Brand#2", None),
    (3, "regex", "*", r"\bgizmo\b", "Brand#3", r"\bold\b"),
    (4, "regex", "*", r"\banvil\b", "Brand#4", None),
    (5, "regex", "*", r"\banvil\b", "Brand#6", None),
    (6, "name", "*", "hotplate", "Brand#7", None),
    (7, "name", "*", "cold gearr", "Brand#8", None),
    (8, "regex", "Brand#9", r"^small", "Brand#9", None),
    (9, "name", "*", "RED WIDGET", "Brand#1", None),
    (10, "regex", "*", r"\brod\b", "Brand#10", None),
    (11, "name", "Brand#11", "purple widget", "Brand#12", None),
]
#: stay families: products of the category that should remain where they are
STAYS = [(1, "Brand#12", r"\bgizmo\b"), (2, "Brand#13", r"^red\b"), (3, "Brand#2", r"\brod\b"), (4, "Brand#25", "nothing")]
KEYWORDS = [(1, "widget", ["Brand#1", "Brand#11"]), (2, "gear", ["Brand#2"]), (3, "ring", ["Brand#3", "Brand#13", "Brand#23"]),
            (4, "plate", ["Brand#4"]), (5, "small", ["Brand#5"])]
QUALIFIERS = [("gear", "small"), ("gear", "old"), ("plate", "hot"), ("widget", "red")]


def _sqlstr(v):
    return "CAST(NULL AS VARCHAR)" if v is None else "'" + str(v).replace("'", "''") + "'"


def _values(rows, cols, types):
    body = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _sqlstr(v) for v in r) + ")"
                     for r in rows)
    sel = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(cols, types))
    return f"(SELECT {sel} FROM (VALUES {body}) v({', '.join(cols)}))"


RULES_SQL = "rules AS " + _values(REMAP_RULES, ["rule_no", "kind", "source", "pattern", "destination", "exclude"],
                                  ["BIGINT", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR"])
PRODS_SQL = "prods AS (SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category FROM part)"
NORM = "lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"
MATCH_SQL = f"""nmatch AS (
  SELECT r.rule_no, p.product_id, p.product_name, p.category, r.destination FROM prods p JOIN rules r
  ON r.kind = 'name' AND {NORM.format(x='p.product_name')} = {NORM.format(x='r.pattern')}
  AND (r.source = '*' OR r.source = p.category)),
rmatch AS (
  SELECT r.rule_no, p.product_id, p.product_name, p.category, r.destination FROM prods p JOIN rules r
  ON r.kind = 'regex' AND regexp_matches(p.product_name, '(?i)' || r.pattern)
  AND (r.source = '*' OR r.source = p.category)
  AND NOT coalesce(r.exclude IS NOT NULL AND regexp_matches(p.product_name, '(?i)' || r.exclude), false)),
m AS (SELECT * FROM nmatch UNION ALL SELECT * FROM rmatch),
res AS (
  SELECT product_id, product_name, category, count(*) AS n_rules, count(DISTINCT destination) AS n_destinations,
         CASE WHEN count(DISTINCT destination) = 1 THEN min(destination) END AS destination,
         min(rule_no) AS first_rule,
         CASE WHEN count(DISTINCT destination) > 1 THEN 'conflict' WHEN min(destination) = category THEN 'noop'
              WHEN count(*) > 1 THEN 'duplicate' ELSE 'move' END AS status
  FROM m GROUP BY 1, 2, 3),
remapped AS (
  SELECT l.*, l.category AS category_before,
         coalesce(CASE WHEN r.status IN ('move', 'duplicate') THEN r.destination END, l.category) AS category_after
  FROM lines l LEFT JOIN res r USING (product_id))"""
REMAP = with_(L, PRODS_SQL, RULES_SQL, MATCH_SQL)


class Remap:
    def __init__(self, spark, d):
        self.spark = spark
        self.products = adapter.products(spark, d)
        self.rules = RM.rules_df(spark, REMAP_RULES)
        self.matches = RM.all_matches(self.products, self.rules)
        self.resolved = RM.resolve(self.matches)
        self.lines = adapter.lines(spark, d)

    def remapped(self):
        return RM.apply_remap(self.lines, self.resolved)


# ----------------------------------------------------------------- B -----
RENAME = {"l_orderkey": "basket_id", "l_partkey": "product_id", "l_suppkey": "store_id",
          "l_linenumber": "src_line", "l_quantity": "quantity", "l_extendedprice": "amount",
          "l_discount": "discount", "l_tax": "tax", "l_returnflag": "return_flag",
          "l_linestatus": "line_status"}


@query("clean_rename", """SELECT l_orderkey AS basket_id, l_partkey AS product_id, l_suppkey AS store_id,
  l_linenumber AS src_line, l_quantity AS quantity, l_extendedprice AS amount, l_discount AS discount,
  l_tax AS tax FROM lineitem""")
def q_rename(spark, d):
    return CL.clean_rename(read_table(spark, d, "lineitem"), RENAME, drop=("l_returnflag", "l_linestatus"))


@query("normalise_label", r"""SELECT p_partkey AS product_id,
  trim(regexp_replace(replace(upper(trim(p_name)), '_', ' '), '\s+', ' ', 'g')) AS name_clean,
  trim(regexp_replace(replace(upper(trim(p_type)), '_', ' '), '\s+', ' ', 'g')) AS group_clean FROM part""")
def q_norm(spark, d):
    p = read_table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"), normalise_label("p_name").alias("name_clean"),
                    normalise_label("p_type").alias("group_clean"))


@query("map_labels", "SELECT p_partkey AS product_id, p_type AS product_group, CASE p_type "
       + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(LABEL_MAP.items()))
       + " ELSE p_type END AS group_mapped FROM part")
def q_map(spark, d):
    p = read_table(spark, d, "part").select(F.col("p_partkey").alias("product_id"),
                                            F.col("p_type").alias("product_group"))
    return CL.map_labels(p, "product_group", LABEL_MAP, "group_mapped")


@query("override_by_product", "WITH o AS " + _values(OVERRIDES, ["product_id", "value"], ["BIGINT", "VARCHAR"])
       + "\nSELECT p.p_partkey AS product_id, coalesce(o.value, p.p_brand) AS category FROM part p "
         "LEFT JOIN o ON o.product_id = p.p_partkey")
def q_override(spark, d):
    p = adapter.products(spark, d).select("product_id", "category")
    o = spark.createDataFrame(OVERRIDES, "product_id bigint, value string")
    return CL.override_by_product(p, o, "product_id", "category")


@query("drop_category", with_(L) + f"""SELECT category, count(*) AS lines FROM lines
WHERE category <> '{DROP_CATEGORY}' GROUP BY 1""")
def q_drop_cat(spark, d):
    l = adapter.lines(spark, d).filter(F.col("category") != DROP_CATEGORY)
    return l.groupBy("category").agg(F.count(F.lit(1)).alias("lines"))


@query("dedupe_rows", """SELECT (SELECT count(*) FROM lineitem) AS rows_before,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS rows_after,
  (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates""")
def q_dedupe(spark, d):
    return CL.dedupe_rows(read_table(spark, d, "lineitem"))


@query("duplicate_groups", """SELECT l_orderkey, l_partkey, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dup_groups(spark, d):
    return CL.duplicate_groups(read_table(spark, d, "lineitem", "l_orderkey", "l_partkey"))


@query("drop_null_key", """SELECT count(*) AS rows_before, count(l.l_orderkey) AS rows_after
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def q_dropnull(spark, d):
    o = read_table(spark, d, "orders", "o_orderkey")
    li = read_table(spark, d, "lineitem", "l_orderkey")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return j.agg(F.count(F.lit(1)).alias("rows_before"),
                 F.count("l_orderkey").alias("rows_after"))  # same as dropna on the key, one pass


@query("parse_date_lenient", """SELECT o_orderkey,
  CAST(try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed_date,
  CAST(try_strptime(o_orderpriority, '%d/%m/%Y') AS DATE) AS parsed_bad FROM orders""")
def q_parse(spark, d):
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    o = o.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("txt"), "o_orderpriority")
    return o.select("o_orderkey", CL.parse_date_lenient("txt").alias("parsed_date"),
                    CL.parse_date_lenient("o_orderpriority").alias("parsed_bad"))


@query("assign_line_no", with_(L) + """SELECT basket_id, product_id, store_id, src_line,
  row_number() OVER (PARTITION BY basket_id ORDER BY src_line, product_id, store_id) AS line_no FROM lines""")
def q_lineno(spark, d):
    l = adapter.lines(spark, d, with_line_no=True)
    return l.select("basket_id", "product_id", "store_id", "src_line", F.col("line_no").cast("bigint"))


_NP = """np AS (SELECT product_id, product_name, product_group, category FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY basket_id, src_line, store_id) AS rk
  FROM lines) WHERE rk = 1)"""


@query("normalise_products", with_(L, _NP) + "SELECT * FROM np")
def q_nprod(spark, d):
    return CL.first_by_ordinal(adapter.lines(spark, d), "product_id", ["product_name", "product_group", "category"],
                               ["basket_id", "src_line", "store_id"])


@query("normalise_transactions", with_(L) + """SELECT basket_id, sale_date, customer_id FROM (
  SELECT *, row_number() OVER (PARTITION BY basket_id ORDER BY src_line, product_id, store_id) AS rk FROM lines)
WHERE rk = 1""")
def q_ntx(spark, d):
    return CL.first_by_ordinal(adapter.lines(spark, d), "basket_id", ["sale_date", "customer_id"],
                               ["src_line", "product_id", "store_id"])


@query("resolve_keys", with_(L, _NP) + """SELECT l.basket_id, l.product_id, l.store_id, l.src_line,
  np.product_group, np.category AS product_category, t.o_custkey AS customer_id
FROM lines l JOIN np USING (product_id) JOIN orders t ON t.o_orderkey = l.basket_id""")
def q_resolve_keys(spark, d):
    l = adapter.lines(spark, d)
    np_ = CL.first_by_ordinal(l, "product_id", ["product_group", "category"], ["basket_id", "src_line", "store_id"])
    t = adapter.transactions(spark, d)
    return (l.select("basket_id", "product_id", "store_id", "src_line")
            .join(np_.withColumnRenamed("category", "product_category"), "product_id")
            .join(t.select("basket_id", "customer_id"), "basket_id")
            .select("basket_id", "product_id", "store_id", "src_line", "product_group", "product_category", "customer_id"))


@query("segment_basket", with_(L, B) + "SELECT basket_id, round(CAST(basket_value AS DOUBLE), 2) AS basket_value, "
       "basket_segment FROM baskets")
def q_segment(spark, d):
    b = dim_basket(adapter.lines(spark, d))
    return b.select("basket_id", F.round(F.col("basket_value").cast("double"), 2).alias("basket_value"),
                    segment("basket_value").alias("basket_segment"))


def _season_case(col):
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(params.MONTH_SEASON.items()))
    return f"CASE {col} {whens} ELSE '{params.DEFAULT_SEASON}' END"


@query("season_of_month", with_(L) + f"""SELECT DISTINCT CAST(month(sale_date) AS BIGINT) AS month_number,
  {_season_case('month(sale_date)')} AS season FROM lines""")
def q_season(spark, d):
    l = adapter.lines(spark, d)
    return l.select(F.month("sale_date").cast("bigint").alias("month_number")).distinct().select(
        "month_number", season_of_month("month_number").alias("season"))


@query("clip_values", with_(L, B) + f"""SELECT basket_id,
  round(least(CAST(basket_value AS DOUBLE), {params.HIST_CAP}), 2) AS clipped_value FROM baskets""")
def q_clip(spark, d):
    from trolley.functions.labels import clip
    b = dim_basket(adapter.lines(spark, d))
    return b.select("basket_id", F.round(clip(F.col("basket_value").cast("double"), params.HIST_CAP), 2)
                    .alias("clipped_value"))


# ----------------------------------------------------------------- C -----
@query("remap_name_rules", REMAP + "SELECT rule_no, product_id, product_name, category, destination FROM nmatch")
def q_name_rules(spark, d):
    r = Remap(spark, d)
    return RM.name_matches(r.products, r.rules)


@query("remap_regex_rules", REMAP + "SELECT rule_no, product_id, product_name, category, destination FROM rmatch")
def q_regex_rules(spark, d):
    r = Remap(spark, d)
    return RM.regex_matches(r.products, r.rules)


@query("remap_resolve", REMAP + "SELECT * FROM res")
def q_resolve(spark, d):
    return Remap(spark, d).resolved


@query("remap_apply", REMAP + """SELECT category_before, category_after AS category, count(*) AS lines,
  round(CAST(sum(amount) AS DOUBLE), 2) AS revenue FROM remapped GROUP BY 1, 2""")
def q_apply(spark, d):
    m = Remap(spark, d).remapped()
    return (m.groupBy("category_before", "category")
            .agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("amount").cast("double"), 2).alias("revenue")))


_UNMATCHED = """un AS (SELECT * FROM rules WHERE rule_no NOT IN (SELECT rule_no FROM m))"""


@query("remap_unmatched", with_(L, PRODS_SQL, RULES_SQL, MATCH_SQL, _UNMATCHED) + f"""
SELECT u.rule_no, u.kind, u.source, u.pattern, u.destination,
  coalesce((SELECT count(*) FROM (SELECT DISTINCT {NORM.format(x='product_name')} AS k, category FROM prods) x
            WHERE x.k = {NORM.format(x='u.pattern')}) > 0 AND u.kind = 'name', false) AS exists_elsewhere
FROM un u""")
def q_unmatched(spark, d):
    r = Remap(spark, d)
    return RM.unmatched_rules(r.products, r.rules, r.matches)


@query("remap_near_miss", with_(L, PRODS_SQL, RULES_SQL, MATCH_SQL, _UNMATCHED) + r""",
names AS (SELECT DISTINCT product_name, lower(regexp_replace(product_name, '\s+', '', 'g')) AS squash FROM prods),
u AS (SELECT rule_no, pattern, lower(regexp_replace(pattern, '\s+', '', 'g')) AS squash FROM un WHERE kind = 'name'),
sq AS (SELECT u.rule_no, u.pattern, n.product_name, 1.0 AS similarity, 'squash' AS how
       FROM u JOIN names n USING (squash)),
cand AS (SELECT u.rule_no, u.pattern, n.product_name,
                round(1 - levenshtein(lower(u.pattern), lower(n.product_name))
                      / greatest(length(lower(u.pattern)), length(lower(n.product_name))), 6) AS similarity
         FROM u JOIN names n ON true WHERE u.rule_no NOT IN (SELECT rule_no FROM sq)),
si AS (SELECT rule_no, pattern, product_name, similarity, 'similar' AS how FROM (
        SELECT *, row_number() OVER (PARTITION BY rule_no ORDER BY similarity DESC, product_name) AS rk
        FROM cand WHERE similarity >= 0.72) WHERE rk <= 3)
SELECT * FROM sq UNION ALL SELECT * FROM si""")
def q_near(spark, d):
    r = Remap(spark, d)
    return RM.near_misses(r.products, RM.unmatched_rules(r.products, r.rules, r.matches))


@query("remap_near_blocks")
def q_near_blocks(spark, d):
    r = Remap(spark, d)
    return RM.block_near_misses(r.products, RM.unmatched_rules(r.products, r.rules, r.matches))


@query("remap_refusals", with_(L, PRODS_SQL, RULES_SQL, MATCH_SQL, _UNMATCHED) + """
SELECT 'conflict' AS reason, first_rule AS rule_no, product_name AS name FROM res WHERE status = 'conflict'
UNION ALL SELECT 'unmatched name', rule_no, pattern FROM un WHERE kind = 'name'""")
def q_refusals(spark, d):
    r = Remap(spark, d)
    return RM.remap_refusals(r.resolved, RM.unmatched_rules(r.products, r.rules, r.matches))


_STAYS = "stays AS " + _values(STAYS, ["stay_no", "source", "pattern"], ["BIGINT", "VARCHAR", "VARCHAR"])


@query("remap_stay_conflicts", with_(L, PRODS_SQL, RULES_SQL, MATCH_SQL, _STAYS) + """SELECT m.product_id, m.product_name, m.category,
  m.rule_no, m.destination, s.stay_no
FROM m JOIN stays s ON s.source = m.category AND regexp_matches(m.product_name, '(?i)' || s.pattern)""")
def q_stay(spark, d):
    return RM.stay_conflicts(Remap(spark, d).matches, spark.createDataFrame(STAYS, RM.STAY_SCHEMA))


@query("remap_report", REMAP + """, b AS (SELECT category_before AS category, count(DISTINCT product_id) AS n
  FROM remapped GROUP BY 1),
a AS (SELECT category_after AS category, count(DISTINCT product_id) AS n FROM remapped GROUP BY 1)
SELECT coalesce(b.category, a.category) AS category, CAST(coalesce(b.n, 0) AS BIGINT) AS products_before,
  CAST(coalesce(a.n, 0) AS BIGINT) AS products_after, CAST(coalesce(a.n, 0) - coalesce(b.n, 0) AS BIGINT) AS delta
FROM b FULL OUTER JOIN a USING (category)""")
def q_report(spark, d):
    r = Remap(spark, d)
    m = r.remapped()
    return RM.remap_report(m.withColumn("category", F.col("category_before")), m)


#: products that the author of each rule expected it to name
ESTIMATES = [(r[0], 10 * r[0]) for r in REMAP_RULES]
_EST = "est AS " + _values(ESTIMATES, ["rule_no", "estimate"], ["BIGINT", "BIGINT"])


@query("remap_sections", with_(L, PRODS_SQL, RULES_SQL, MATCH_SQL, _EST) + """
SELECT rule_no, estimate, coalesce(h.n, 0) AS matched, coalesce(v.n, 0) AS moved, coalesce(h.n, 0) - estimate AS difference
FROM est LEFT JOIN (SELECT rule_no, count(*) AS n FROM m GROUP BY 1) h USING (rule_no)
LEFT JOIN (SELECT first_rule AS rule_no, count(*) AS n FROM res WHERE status IN ('move', 'duplicate') GROUP BY 1) v USING (rule_no)""")
def q_sections(spark, d):
    r = Remap(spark, d)
    return RM.moves_by_section(r.resolved, r.matches, spark.createDataFrame(ESTIMATES, "rule_no bigint, estimate bigint"))


@query("remap_moves_by_destination", REMAP + """SELECT category_after AS destination,
  count(DISTINCT product_id) AS products, round(CAST(sum(amount) AS DOUBLE), 2) AS revenue
FROM remapped WHERE category_after <> category_before GROUP BY 1""")
def q_moves(spark, d):
    return RM.moves_by_destination(Remap(spark, d).remapped())


@query("remap_invariants", REMAP + """SELECT 'before' AS side, count(*) AS rows,
  round(CAST(sum(amount) AS DOUBLE), 2) AS revenue, count(DISTINCT product_id) AS products,
  count(DISTINCT category_before) AS categories FROM remapped
UNION ALL SELECT 'after', count(*), round(CAST(sum(amount) AS DOUBLE), 2), count(DISTINCT product_id),
  count(DISTINCT category_after) FROM remapped""")
def q_invariants(spark, d):
    r = Remap(spark, d)
    m = r.remapped()
    return RM.remap_invariants(m.withColumn("category", F.col("category_before")), m)


_KW = "kw AS (SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({n} AS BIGINT), '{k}', [{', '.join(repr(c) for c in e)}])" for n, k, e in KEYWORDS) + ") v(kw_no, keyword, expected))"
_QU = "qu AS " + _values(QUALIFIERS, ["keyword", "word"], ["VARCHAR", "VARCHAR"])


@query("audit_flags", with_(PRODS_SQL, _KW, _QU) + r""",
hits AS (SELECT p.*, k.* FROM prods p JOIN kw k ON regexp_matches(p.product_name, '(?i)\b' || k.keyword || '\b'))
SELECT product_id, product_name, category, expected[1] AS suggested, keyword FROM hits h
WHERE NOT EXISTS (SELECT 1 FROM hits a WHERE a.product_id = h.product_id AND list_contains(a.expected, a.category))
  AND NOT EXISTS (SELECT 1 FROM qu WHERE qu.keyword = h.keyword AND contains(lower(h.product_name), qu.word))""")
def q_flags(spark, d):
    return RM.audit_flags(adapter.products(spark, d), spark.createDataFrame(KEYWORDS, RM.KW_SCHEMA),
                          spark.createDataFrame(QUALIFIERS, RM.QUALIFIER_SCHEMA))


@query("audit_category_summary", with_(L) + """SELECT category, count(DISTINCT product_id) AS products,
  round(CAST(sum(amount) AS DOUBLE), 2) AS revenue,
  round(100.0 * count(DISTINCT basket_id) / (SELECT count(DISTINCT basket_id) FROM lines), 4) AS pct_of_baskets
FROM lines GROUP BY 1""")
def q_cat_summary(spark, d):
    return CL.audit_category_summary(adapter.lines(spark, d))


@query("audit_products", with_(L) + """SELECT category, product_id, product_name, product_group,
  round(sum(quantity), 2) AS units, round(CAST(sum(amount) AS DOUBLE), 2) AS revenue FROM lines GROUP BY 1, 2, 3, 4""")
def q_audit_products(spark, d):
    return CL.audit_products(adapter.lines(spark, d))


@query("audit_mapping", with_(L) + """, c AS (SELECT product_group, category, count(*) AS n FROM lines GROUP BY 1, 2)
SELECT product_group, count(*) AS n_categories,
  CASE WHEN count(*) = 1 THEN min(category)
       ELSE string_agg(category || ' (' || CAST(n AS VARCHAR) || ')', '; ' ORDER BY n DESC, category) END AS mapping
FROM c GROUP BY 1""")
def q_mapping(spark, d):
    return CL.audit_mapping(adapter.lines(spark, d))


_PROFILE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PROFILE_TXT = ["l_returnflag", "l_linestatus"]


def _profile_sql():
    parts = []
    for c in _PROFILE_NUM:
        for metric, expr in [("nulls", f"count(*) FILTER (WHERE {c} IS NULL)"),
                             ("zeros", f"count(*) FILTER (WHERE {c} = 0)"),
                             ("positives", f"count(*) FILTER (WHERE {c} > 0)"),
                             ("non_positive", f"count(*) FILTER (WHERE {c} <= 0)"),
                             ("max", f"max({c})"), ("min", f"min({c})"), ("distinct", f"count(DISTINCT {c})")]:
            parts.append(f"SELECT '{c}' AS column, '{metric}' AS metric, round(CAST({expr} AS DOUBLE), 6) + 0.0 AS value "
                         f"FROM lineitem")
    for c in _PROFILE_TXT:
        for metric, expr in [("nulls", f"count(*) FILTER (WHERE {c} IS NULL)"),
                             ("untrimmed", f"count(*) FILTER (WHERE {c} <> trim({c}))"),
                             ("distinct", f"count(DISTINCT {c})")]:
            parts.append(f"SELECT '{c}' AS column, '{metric}' AS metric, round(CAST({expr} AS DOUBLE), 6) AS value "
                         f"FROM lineitem")
    return "\nUNION ALL ".join(parts)


@query("audit_profile", _profile_sql())
def q_profile(spark, d):
    return CL.audit_profile(read_table(spark, d, "lineitem"), _PROFILE_NUM, _PROFILE_TXT)


@query("audit_value_counts", """SELECT l_returnflag, count(*) AS n,
  round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM lineitem GROUP BY 1""")
def q_value_counts(spark, d):
    return CL.value_counts(read_table(spark, d, "lineitem", "l_returnflag"), "l_returnflag")


@query("audit_baskets", with_(L) + """, per AS (SELECT basket_id, CAST(sum(amount) AS DOUBLE) AS value,
  count(DISTINCT product_id) AS products, sum(quantity) AS quantity, count(*) AS lines FROM lines GROUP BY 1)
SELECT count(*) AS baskets, round(avg(value), 2) AS mean_value, round(median(value), 2) AS median_value,
  round(avg(products), 6) AS mean_products, count(*) FILTER (WHERE products = 1) AS single_product_baskets,
  max(lines) AS max_lines, round(max(value), 2) AS max_value FROM per""")
def q_audit_baskets(spark, d):
    return CL.audit_baskets(adapter.lines(spark, d))


# ------------------------------------------------------------ A1 / A6 ------
LETTERHEAD = ["STORE NAME", "ADDRESS LINE", "SALES REGISTER", "PERIOD: ALL", "", "PRINTED BY: SYSTEM",
              "PAGE 1"]
EXPORT_SQL = with_(L) + """SELECT basket_id AS invoice_no, product_id, CAST(sale_date AS DATE) AS sale_date,
  quantity, round(CAST(amount AS DOUBLE), 2) AS total_amount FROM lines"""


def _export_dir(spark, name):
    from trolley.session import checkpoint_dir
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"


@query("ingest_pos_raw", EXPORT_SQL)
def q_ingest(spark, d):
    """Lines written as a raw export (letterhead + header + rows, day-first
    dates) to the shared folder, then read back with an explicit schema."""
    from trolley.sources import pos_csv
    lines = adapter.lines(spark, d).select(
        F.date_format("sale_date", "dd/MM/yyyy").alias("date"), F.col("basket_id").alias("invoice_no"),
        F.col("product_id").alias("product"), F.col("quantity"),
        F.col("amount").cast("double").alias("total_amount"))
    path = _export_dir(spark, "pos")
    pos_csv.write_export(lines, path, LETTERHEAD)
    raw = pos_csv.read_export(spark, path, "date string, invoice_no string, product string, quantity string, "
                                           "total_amount string")
    return raw.select(F.col("invoice_no").cast("bigint").alias("invoice_no"),
                      F.col("product").cast("bigint").alias("product_id"),
                      F.try_to_date("date", "dd/MM/yyyy").alias("sale_date"),
                      F.col("quantity").cast("double").alias("quantity"),
                      F.round(F.col("total_amount").cast("double"), 2).alias("total_amount"))


_BLANK = sum(not t.strip() for t in LETTERHEAD)


@query("ingest_rejects", f"""SELECT reason, CAST(lines AS BIGINT) AS lines FROM (VALUES ('header', 1), ('blank line', {_BLANK}),
  ('too few fields', {len(LETTERHEAD) - _BLANK})) v(reason, lines) WHERE lines > 0""")
def q_rejects(spark, d):
    """Lines of the export that are no data rows, by reason."""
    from trolley.sources import pos_csv
    lines = adapter.lines(spark, d).select(F.date_format("sale_date", "dd/MM/yyyy").alias("date"), F.col("basket_id").alias("invoice_no"),
                                           F.col("product_name").alias("product"))
    path = _export_dir(spark, "pos-rejects")
    pos_csv.write_export(lines, path, LETTERHEAD)
    return (pos_csv.export_rejects(spark, path, "date string, invoice_no string, product string")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("lines")))


@query("write_artifact", with_(L) + """SELECT category, round(CAST(sum(amount) AS DOUBLE), 2) AS revenue,
  count(DISTINCT basket_id) AS baskets FROM lines GROUP BY 1""")
def q_artifact(spark, d):
    """Category summary written as a one-file CSV artifact and read back."""
    from trolley.sources import pos_csv
    l = adapter.lines(spark, d)
    cb = l.groupBy("category", "basket_id").agg(F.sum("amount").alias("a"))
    summ = cb.groupBy("category").agg(F.round(F.sum("a").cast("double"), 2).alias("revenue"),
                                      F.count(F.lit(1)).alias("baskets"))
    path = _export_dir(spark, "artifact")
    pos_csv.write_artifact(summ, path)
    return spark.read.schema("category string, revenue double, baskets bigint").option("header", True).csv(path)
