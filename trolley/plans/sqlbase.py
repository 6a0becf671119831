"""DuckDB SQL building blocks mirroring the adapter and star builders.

The oracle text is generated from the same parameters the Spark code uses,
so a parameter change cannot silently desynchronise the two sides.
"""

from __future__ import annotations

from trolley import params


def lines_cte(category: str = "p_brand", name: str = "lines") -> str:
    return f"""{name} AS (
  SELECT l.l_orderkey AS basket_id, l.l_partkey AS product_id, p.p_name AS product_name,
         p.p_type AS product_group, p.{category} AS category,
         CAST(o.o_orderdate AS DATE) AS sale_date, o.o_custkey AS customer_id,
         l.l_suppkey AS store_id, l.l_linenumber AS src_line, l.l_quantity AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,6)) AS amount, l.l_tax AS tax
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""


def segment_sql(v: str, edges=params.SEGMENT_EDGES, labels=params.SEGMENT_LABELS) -> str:
    return (f"CASE WHEN {v} < {edges[0]} THEN '{labels[0]}' WHEN {v} <= {edges[1]} "
            f"THEN '{labels[1]}' ELSE '{labels[2]}' END")


def baskets_cte(name: str = "baskets", src: str = "lines", edges=params.SEGMENT_EDGES) -> str:
    return f"""{name} AS (
  SELECT basket_id, sale_date, CAST(strftime(sale_date, '%Y%m%d') AS BIGINT) AS date_key,
         sum(amount) AS basket_value, count(*) AS n_items,
         count(DISTINCT category) AS n_categories,
         {segment_sql('sum(amount)', edges)} AS basket_segment
  FROM {src} GROUP BY basket_id, sale_date)"""


def zones_values() -> str:
    rows = ", ".join(f"({z[0]}, '{z[1]}', '{z[2]}', '{z[3]}', '{z[4]}')" for z in params.ZONES)
    return (f"(SELECT CAST(zone_no AS BIGINT) AS zone_no, zone_assignment, zone_label, zone_location, "
            f"intention FROM (VALUES {rows}) z(zone_no, zone_assignment, zone_label, zone_location, intention))")


def layout_case(slot: str, sizes=params.ZONE_SIZES) -> str:
    parts, acc = [], 0
    for i, s in enumerate(sizes, start=1):
        acc += s
        parts.append(f"WHEN {slot} <= {acc} THEN {i}")
    return f"CAST(CASE {' '.join(parts)} END AS BIGINT)"


def dim_category_cte(category: str = "p_brand", sizes=params.ZONE_SIZES) -> str:
    return f"""layout AS (
  SELECT category, {layout_case('slot', sizes)} AS zone_no
  FROM (SELECT category, row_number() OVER (ORDER BY category) AS slot
        FROM (SELECT DISTINCT {category} AS category FROM part))),
dim_category AS (
  SELECT CAST(row_number() OVER (ORDER BY l.category) AS BIGINT) AS category_key,
         l.category AS category_name, l.zone_no, z.zone_assignment, z.zone_label,
         z.zone_location, z.intention
  FROM layout l LEFT JOIN {zones_values()} z ON l.zone_no = z.zone_no)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
