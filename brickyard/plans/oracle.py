"""DuckDB oracle SQL for every registered query (same output column names).

Written independently of the Spark plans, from the same definitions: CTE
builders below give each layer once (bronze, silver, gold) and the queries
compose them. Only the fixed values of the mapping are shared.
"""

from __future__ import annotations

from brickyard.functions.keys import NULL_TOKEN
from brickyard.operators.retrieve import BM25_B, BM25_K1, DEFAULT_TEMPLATE, REWRITE_TEMPLATE
from brickyard.plans import registry as R
from brickyard.plans.sales_star import AS_OF, RUN_TS, RUN_TS_2, SRC_SYS
from brickyard.sources.seed import SIZE_LABELS

TS1 = f"TIMESTAMP '{RUN_TS}'"
TS2 = f"TIMESTAMP '{RUN_TS_2}'"
TOKEN_RE = r"[^\p{L}\p{N}]+"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), {q(NULL_TOKEN)})" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def bronze(name: str, src: str, ts: str = TS1, where: str = "", select: str = "*") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"{name} AS (SELECT {select}, {ts} AS src_crt_ts, {ts} AS src_upd_ts, {q(SRC_SYS)} AS src_sys, "
            f"{ts} AS crt_ts, {ts} AS upd_ts FROM {src}{w})")


def silver_orders(name: str, b: str) -> str:
    return f"""{name} AS (SELECT order_id, order_date, src_sys, src_crt_ts, src_upd_ts FROM (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         src_sys, crt_ts AS src_crt_ts, upd_ts AS src_upd_ts,
         row_number() OVER (PARTITION BY CAST(o_orderkey AS BIGINT)
                            ORDER BY upd_ts DESC NULLS FIRST, CAST(o_orderdate AS DATE) ASC NULLS FIRST) AS rn
  FROM {b} WHERE o_orderkey IS NOT NULL) WHERE rn = 1)"""


def silver_lines(name: str, b: str, qty_shift: int = 0) -> str:
    qty = "CAST(l_quantity AS BIGINT)" + (f" - {qty_shift}" if qty_shift else "")
    return f"""{name} AS (SELECT order_detail_id, order_id, product_id, {qty} AS quantity,
         src_sys, src_crt_ts, src_upd_ts FROM (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS order_detail_id, CAST(l_orderkey AS BIGINT) AS order_id,
         TRIM(CAST(l_partkey AS VARCHAR)) AS product_id, l_quantity,
         src_sys, crt_ts AS src_crt_ts, upd_ts AS src_upd_ts,
         row_number() OVER (PARTITION BY CAST(l_orderkey * 10 + l_linenumber AS BIGINT)
             ORDER BY upd_ts DESC NULLS FIRST, l_shipdate DESC NULLS FIRST, l_partkey ASC NULLS FIRST,
                      l_suppkey ASC NULLS FIRST, l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST) AS rn
  FROM {b} WHERE l_orderkey * 10 + l_linenumber IS NOT NULL) WHERE rn = 1)"""


SIZE_CASE = ("CASE WHEN p_size < 11 THEN 'S' WHEN p_size < 21 THEN 'M' WHEN p_size < 31 THEN 'L' "
             "WHEN p_size < 41 THEN 'XL' ELSE 'XXL' END")
PRICE_CASE = ("CASE WHEN {p} < 925 THEN 'Budget' WHEN {p} < 950 THEN 'Standard' "
              "WHEN {p} < 975 THEN 'Premium' ELSE 'Luxury' END")


def silver_products(name: str = "silver_products", b: str = "bronze_part") -> str:
    return f"""{name} AS (SELECT product_id, product_type_id, size_code, price, src_sys, src_crt_ts, src_upd_ts FROM (
  SELECT TRIM(CAST(p_partkey AS VARCHAR)) AS product_id, TRIM(CAST(p_partkey AS VARCHAR)) AS product_type_id,
         TRIM({SIZE_CASE}) AS size_code, CAST(p_retailprice AS DOUBLE) AS price,
         src_sys, crt_ts AS src_crt_ts, upd_ts AS src_upd_ts,
         row_number() OVER (PARTITION BY TRIM(CAST(p_partkey AS VARCHAR))
                            ORDER BY upd_ts DESC NULLS FIRST, TRIM(CAST(p_partkey AS VARCHAR)) ASC NULLS FIRST) AS rn
  FROM {b} WHERE TRIM(CAST(p_partkey AS VARCHAR)) IS NOT NULL) WHERE rn = 1)"""


def silver_types(name: str = "silver_types", b: str = "bronze_part") -> str:
    return f"""{name} AS (SELECT product_type_id, product_name, product_category, component_list,
         src_sys, src_crt_ts, src_upd_ts FROM (
  SELECT TRIM(CAST(p_partkey AS VARCHAR)) AS product_type_id, TRIM(p_name) AS product_name,
         TRIM(p_type) AS product_category, TRIM(p_name) AS component_list,
         src_sys, crt_ts AS src_crt_ts, upd_ts AS src_upd_ts,
         row_number() OVER (PARTITION BY TRIM(CAST(p_partkey AS VARCHAR))
                            ORDER BY upd_ts DESC NULLS FIRST, TRIM(CAST(p_partkey AS VARCHAR)) ASC NULLS FIRST) AS rn
  FROM {b} WHERE TRIM(CAST(p_partkey AS VARCHAR)) IS NOT NULL) WHERE rn = 1)"""


def silver_components(name: str = "silver_components", b: str = "bronze_part") -> str:
    return f"""{name} AS (SELECT product_type_id, product_category, TRIM(component) AS component,
         CAST(component_position AS INTEGER) AS component_position, src_sys, src_crt_ts, src_upd_ts FROM (
  SELECT TRIM(CAST(p_partkey AS VARCHAR)) AS product_type_id, TRIM(p_type) AS product_category,
         unnest(string_split(p_name, ' ')) AS component,
         unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS component_position,
         src_sys, crt_ts AS src_crt_ts, upd_ts AS src_upd_ts
  FROM {b}))"""


def size_labels(name: str = "size_labels") -> str:
    rows = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in SIZE_LABELS)
    return (f"{name} AS (SELECT * FROM (VALUES {rows}) v(size_code, size_label, size_description, "
            f"serves_min, serves_max, sort_order))")


def dim_product(name: str = "dim_product") -> str:
    return f"""{name} AS (
  SELECT {sk('i.product_id')} AS product_sk, {sk('i.product_type_id')} AS product_type_sk,
         i.product_id, i.product_type_id, t.product_name, t.product_category, t.component_list,
         CAST(len(string_split(t.component_list, ' ')) AS INTEGER) AS component_count,
         i.size_code, l.size_label, l.size_description, l.serves_min, l.serves_max, i.price,
         {PRICE_CASE.format(p='i.price')} AS price_tier,
         i.src_sys, i.src_crt_ts, i.src_upd_ts, {TS1} AS crt_ts, {TS1} AS upd_ts
  FROM silver_products i LEFT JOIN silver_types t ON i.product_type_id = t.product_type_id
  LEFT JOIN size_labels l ON i.size_code = l.size_code)"""


def product_ctes() -> list[str]:
    return [bronze("bronze_part", "part"), silver_products(), silver_types(), size_labels(), dim_product()]


def components_ctes() -> list[str]:
    return [silver_components(), f"""dim_components AS (
  SELECT {sk('component')} AS component_sk, component, src_sys, src_crt_ts, src_upd_ts,
         {TS1} AS crt_ts, {TS1} AS upd_ts
  FROM (SELECT DISTINCT TRIM(component) AS component, src_sys, src_crt_ts, src_upd_ts FROM silver_components))""",
            f"""bridge AS (
  SELECT {sk('e.product_type_id', 'd.component')} AS product_component_sk,
         {sk('e.product_type_id')} AS product_type_sk, {sk('e.component')} AS component_sk,
         e.product_type_id, d.component, e.component_position, {TS1} AS crt_ts, {TS1} AS upd_ts,
         e.src_sys, e.src_crt_ts, e.src_upd_ts
  FROM silver_components e LEFT JOIN dim_components d ON TRIM(e.component) = TRIM(d.component))"""]


def fact(name: str, lines: str, headers: str, ts: str = TS1) -> str:
    return f"""{name} AS (
  SELECT {sk('l.order_detail_id')} AS order_detail_sk, {sk('l.product_id')} AS product_sk,
         {sk('CAST(h.order_date AS DATE)')} AS date_sk, {sk('l.order_id')} AS order_sk,
         l.order_detail_id, l.order_id, l.product_id, h.order_date, l.quantity,
         CASE WHEN l.quantity <= 0 THEN NULL ELSE l.quantity END AS quantity_valid,
         h.src_sys, h.src_crt_ts, h.src_upd_ts, {ts} AS crt_ts, {ts} AS upd_ts
  FROM {lines} l LEFT JOIN {headers} h ON l.order_id = h.order_id)"""


def fact_ctes(qty_shift: int = 0) -> list[str]:
    return [bronze("bronze_orders", "orders"), bronze("bronze_lines", "lineitem"),
            silver_orders("silver_orders", "bronze_orders"),
            silver_lines("silver_lines", "bronze_lines", qty_shift),
            fact("fact", "silver_lines", "silver_orders")]


def dim_date_cte(name: str = "dim_date", fiscal_start: int = 2) -> list[str]:
    d = "calendar_date"
    a = f"DATE '{AS_OF}'"
    m0 = fiscal_start
    fmonth = f"CASE WHEN month({d}) >= {m0} THEN month({d}) - {m0 - 1} ELSE month({d}) + {13 - m0} END"
    return [
        """bounds AS (SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS s,
        CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS e FROM orders)""",
        "spine AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM bounds)",
        f"""{name} AS (
  SELECT {sk(d)} AS date_sk, CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d},
         CAST(dayofweek({d}) AS INTEGER) AS day_of_week, CAST(dayofmonth({d}) AS INTEGER) AS day_of_month,
         CAST(dayofyear({d}) AS INTEGER) AS day_of_year, CAST(weekofyear({d}) AS INTEGER) AS week_of_year,
         CAST(month({d}) AS INTEGER) AS month_number, CAST(quarter({d}) AS INTEGER) AS quarter_number,
         CAST(year({d}) AS INTEGER) AS year_number,
         strftime({d}, '%a') AS day_name, strftime({d}, '%b') AS month_name,
         left(strftime({d}, '%b'), 3) AS month_name_short,
         dayofweek({d}) IN (0, 6) AS is_weekend, NOT (dayofweek({d}) IN (0, 6)) AS is_weekday,
         CAST({d} - {a} AS INTEGER) AS rltv_day,
         CAST((CAST(date_trunc('week', {d}) AS DATE) - CAST(date_trunc('week', {a}) AS DATE)) / 7 AS INTEGER) AS rltv_week,
         CAST((year({d}) * 12 + month({d})) - (year({a}) * 12 + month({a})) AS INTEGER) AS rltv_month,
         CAST((year({d}) * 4 + quarter({d})) - (year({a}) * 4 + quarter({a})) AS INTEGER) AS rltv_quarter,
         CAST(year({d}) - year({a}) AS INTEGER) AS rltv_year,
         CAST(CASE WHEN month({d}) >= {m0} THEN year({d}) ELSE year({d}) - 1 END AS INTEGER) AS fiscal_year,
         CAST({fmonth} AS INTEGER) AS fiscal_month,
         CAST(ceil(({fmonth}) / 3.0) AS INTEGER) AS fiscal_quarter,
         'date_generator' AS src_sys, {TS1} AS crt_ts, {TS1} AS upd_ts
  FROM spine)"""]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def tokens_sql(col: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({col}), {q(TOKEN_RE)}), lambda x: x <> '')"


def bm25_ctes(queries_sql: str, k: int, prefix: str = "") -> list[str]:
    """CTEs ending in ``{prefix}ranked(query_id, rank, doc_id, score)``;
    ``queries_sql`` selects (qid, qtext)."""
    p = prefix
    k1, b = BM25_K1, BM25_B
    return [
        f"{p}dt AS (SELECT doc_id, {tokens_sql('text')} AS toks FROM documents)",
        f"{p}stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM {p}dt)",
        f"{p}qt AS (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({tokens_sql('qtext')}) AS term "
        f"FROM ({queries_sql})) GROUP BY qid, term)",
        f"{p}dterms AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM "
        f"(SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM {p}dt) "
        f"WHERE term IN (SELECT term FROM {p}qt) GROUP BY doc_id, term)",
        f"{p}dfreq AS (SELECT term, count(*) AS df FROM {p}dterms GROUP BY term)",
        f"{p}w AS (SELECT qt.qid, qt.term, qt.qtf * ln(1 + ({p}stats.n - f.df + 0.5) / (f.df + 0.5)) AS w "
        f"FROM {p}qt qt JOIN {p}dfreq f ON qt.term = f.term, {p}stats)",
        f"{p}sc AS (SELECT w.qid AS query_id, d.doc_id, sum(w.w * (d.tf * ({k1} + 1) / (d.tf + {k1} * "
        f"(1 - {b} + {b} * d.dl / {p}stats.avgdl)))) AS score "
        f"FROM {p}dterms d JOIN {p}w w ON d.term = w.term, {p}stats GROUP BY w.qid, d.doc_id)",
        f"{p}ranked AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ("
        f"SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id "
        f"ORDER BY round(score, 6) DESC, doc_id ASC) AS rank FROM {p}sc WHERE score > 0) WHERE rank <= {k})",
    ]


def context_cte(name: str, ranked: str) -> str:
    return (f"{name} AS (SELECT r.query_id, CAST(count(*) AS INTEGER) AS n_docs, "
            f"string_agg('Context document ' || CAST(r.rank AS VARCHAR) || ': ' || d.text || ' \n\n', '' "
            f"ORDER BY r.rank) AS context FROM {ranked} r JOIN documents d ON r.doc_id = d.doc_id "
            f"GROUP BY r.query_id)")


def history_cte(name: str, n: int) -> str:
    if n <= 1:
        return (f"{name} AS (SELECT conv_id, turn, role, text, 0 AS n_history, '' AS history_text, "
                f"FALSE AS has_h FROM conversations)")
    return f"""{name} AS (SELECT conv_id, turn, role, text, CAST(coalesce(len(h), 0) AS INTEGER) AS n_history,
         coalesce(array_to_string(list_transform(h, lambda m: m.role || ': ' || m.text), chr(10)), '') AS history_text
  FROM (SELECT conv_id, turn, role, text,
               list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY turn
                    ROWS BETWEEN {n - 1} PRECEDING AND 1 PRECEDING) AS h
        FROM conversations))"""


def template_sql(values: dict[str, str], template: str = DEFAULT_TEMPLATE) -> str:
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(q(template[pos:m.start()]))
        parts.append(f"coalesce({values[m.group(1)]}, '')")
        pos = m.end()
    if pos < len(template):
        parts.append(q(template[pos:]))
    return " || ".join(parts)


LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
             "l_tax, l_returnflag, l_linestatus, l_shipdate")


def _report_sql() -> str:
    """quality_report: one row per declared check (see registry.report_checks)."""
    ctes = fact_ctes() + product_ctes() + dim_date_cte() + components_ctes()

    def orphans(child, col, parent, field):
        return f"(SELECT 1 FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = c.{col}))"

    def row(rel, label, cols, sev, n_expr, src):
        return (f"SELECT {q(rel)} AS relation, {q(label)} AS \"check\", {q(cols)} AS columns, "
                f"{q(sev)} AS severity, CAST(({n_expr}) AS BIGINT) AS n_failed FROM {src}")
    rows = [
        row("silver_orders", "unique:order_id", "order_id", "warn", "count(*)",
            "(SELECT order_id FROM silver_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)"),
        row("silver_orders", "not_null:order_date", "order_date", "error",
            "count(*) FILTER (WHERE order_date IS NULL)", "silver_orders"),
        row("silver_order_details", "unique:order_detail_id", "order_detail_id", "error", "count(*)",
            "(SELECT order_detail_id FROM silver_lines WHERE order_detail_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
        row("silver_order_details", "not_null:order_id", "order_id", "error",
            "count(*) FILTER (WHERE order_id IS NULL)", "silver_lines"),
        row("silver_order_details", "relationships:order_id", "order_id", "error", "count(*)",
            "(SELECT 1 FROM silver_lines c WHERE c.order_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM silver_orders p WHERE p.order_id = c.order_id))"),
        row("silver_order_details", "relationships:product_id", "product_id", "error", "count(*)",
            "(SELECT 1 FROM silver_lines c WHERE c.product_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM silver_products p WHERE p.product_id = c.product_id))"),
        row("fact_orders", "not_null:order_detail_sk", "order_detail_sk", "error",
            "count(*) FILTER (WHERE order_detail_sk IS NULL)", "fact"),
        row("fact_orders", "unique_combination:order_id,order_detail_id", "order_id,order_detail_id", "error",
            "count(*)", "(SELECT 1 FROM fact GROUP BY order_id, order_detail_id HAVING count(*) > 1)"),
        row("fact_orders", "expression:quantity_valid", "quantity_valid", "error",
            "count(*) FILTER (WHERE NOT (quantity_valid > 0))", "fact"),
        row("fact_orders", "range:quantity", "quantity", "warn",
            "count(*) FILTER (WHERE NOT (quantity BETWEEN 0 AND 40))", "fact"),
        row("fact_orders", "relationships:product_sk", "product_sk", "error", "count(*)", orphans("fact", "product_sk", "dim_product", "product_sk")),
        row("fact_orders", "relationships:date_sk", "date_sk", "error", "count(*)", orphans("fact", "date_sk", "dim_date", "date_sk")),
        row("fact_orders", "unique:order_detail_sk", "order_detail_sk", "error", "count(*)",
            "(SELECT 1 FROM fact WHERE order_detail_sk IS NOT NULL GROUP BY order_detail_sk HAVING count(*) > 1)"),
        row("fact_orders", "unique_combination:order_detail_id,product_sk", "order_detail_id,product_sk", "error",
            "count(*)", "(SELECT 1 FROM fact GROUP BY order_detail_id, product_sk HAVING count(*) > 1)"),
        row("bridge_components", "unique_combination:product_type_sk,component_sk", "product_type_sk,component_sk", "warn",
            "count(*)", "(SELECT 1 FROM bridge GROUP BY product_type_sk, component_sk HAVING count(*) > 1)"),
        row("bridge_components", "not_null:product_component_sk", "product_component_sk", "error",
            "count(*) FILTER (WHERE product_component_sk IS NULL)", "bridge"),
        row("bridge_components", "relationships:product_type_sk", "product_type_sk", "error", "count(*)",
            orphans("bridge", "product_type_sk", "dim_product", "product_type_sk")),
        row("bridge_components", "relationships:component_sk", "component_sk", "error", "count(*)",
            orphans("bridge", "component_sk", "dim_components", "component_sk")),
        row("dim_components", "unique:component_sk", "component_sk", "error", "count(*)",
            "(SELECT 1 FROM dim_components WHERE component_sk IS NOT NULL GROUP BY component_sk HAVING count(*) > 1)"),
        row("dim_components", "not_null:component_sk", "component_sk", "error", "count(*) FILTER (WHERE component_sk IS NULL)", "dim_components"),
        row("dim_product", "unique:product_sk", "product_sk", "error", "count(*)",
            "(SELECT 1 FROM dim_product WHERE product_sk IS NOT NULL GROUP BY product_sk HAVING count(*) > 1)"),
        row("dim_product", "accepted_values:price_tier", "price_tier", "error",
            "count(DISTINCT CASE WHEN NOT (price_tier IN ('Budget', 'Standard', 'Premium', 'Luxury')) "
            "THEN price_tier END)", "dim_product"),
        row("dim_product", "accepted_values:size_label", "size_label", "warn",
            "count(DISTINCT CASE WHEN NOT (size_label IN ('Small', 'Medium', 'Large', 'X-Large')) "
            "THEN size_label END)", "dim_product"),
        row("dim_product", "positive:price", "price", "error", "count(*) FILTER (WHERE price <= 0)", "dim_product"),
        row("dim_date", "accepted_values:month_number", "month_number", "error",
            "count(DISTINCT CASE WHEN NOT (month_number IN (1,2,3,4,5,6,7,8,9,10,11,12)) THEN month_number END)",
            "dim_date"),
        row("dim_date", "expression:calendar_date", "calendar_date", "warn",
            "count(*) FILTER (WHERE NOT (year(calendar_date) <= 2000))", "dim_date"),
    ]
    body = ("SELECT *, CASE WHEN n_failed = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END "
            "AS status FROM (\n" + "\nUNION ALL\n".join(rows) + ")")
    return with_(ctes, body)


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    half = "(SELECT max(o_orderkey) // 2 FROM orders)"
    orders_cols = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
    stamp_cols = "src_crt_ts, src_upd_ts, src_sys, crt_ts, upd_ts"

    S["bronze_orders"] = with_([bronze("b", "orders")], "SELECT * FROM b")

    def merged(target, source, key, wm, cols="*"):
        return (f", new AS (SELECT * FROM {source} WHERE {wm} > (SELECT max({wm}) FROM {target}))\n"
                f"SELECT {cols} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.{key} = t.{key})\n"
                f"UNION ALL SELECT {cols} FROM new")

    S["bronze_incremental_key"] = with_(
        [bronze("target", "orders", TS1, f"o_orderkey <= {half}"), bronze("source", "orders", TS2)],
        merged("target", "source", "o_orderkey", "o_orderkey"))
    S["bronze_incremental_date"] = with_(
        [bronze("target", "orders", TS1, f"o_orderdate < TIMESTAMP '{R.DATE_CUT}'"), bronze("source", "orders", TS2)],
        merged("target", "source", "o_orderkey", "o_orderdate"))
    S["watermark_filter"] = (f"SELECT * FROM lineitem WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem "
                             f"WHERE l_shipdate < TIMESTAMP '{R.SHIP_CUT}')")
    S["upsert"] = with_(
        [bronze("target", "orders", TS1, "o_orderkey <= (SELECT max(o_orderkey) * 2 // 3 FROM orders)"),
         bronze("source", "orders", TS2, "o_orderkey > (SELECT max(o_orderkey) // 3 FROM orders)",
                select="* REPLACE (o_totalprice * 2 AS o_totalprice)")],
        "SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)\n"
        "UNION ALL SELECT * FROM source")
    S["versioned_merge"] = """WITH second AS (SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice,
     CAST(CASE WHEN o_orderkey % 3 = 0 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS INTEGER) AS order_year
   FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 3 FROM orders))
SELECT * FROM second UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) FROM orders
WHERE o_orderkey <= (SELECT max(o_orderkey) * 2 // 3 FROM orders) AND o_orderkey NOT IN (SELECT o_orderkey FROM second)"""
    S["silver_incremental"] = with_([bronze("b", "lineitem"), silver_lines("s", "b")], "SELECT * FROM s")
    inc_cols = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_custref, {stamp_cols}"
    S["schema_sync"] = with_(
        [bronze("target0", "orders", TS1, f"o_orderkey <= {half}"),
         f"target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
         f"CAST(NULL AS BIGINT) AS o_custref, {stamp_cols} FROM target0)",
         bronze("source", "orders", TS2, select="* EXCLUDE (o_orderpriority), o_custkey * 10 AS o_custref")],
        merged("target", "source", "o_orderkey", "o_orderkey", inc_cols))
    S["fact_incremental_merge"] = with_(
        [bronze("b1", "orders", TS1, f"o_orderkey <= {half}"),
         bronze("b2new", "orders", TS2, f"o_orderkey > {half}"),
         "b2 AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2new)",
         bronze("bl", "lineitem"), silver_orders("so1", "b1"), silver_orders("so2", "b2"),
         silver_lines("sl", "bl"), fact("f1", "sl", "so1", TS1), fact("f2", "sl", "so2", TS2)],
        merged("f1", "f2", "order_detail_sk", "src_crt_ts"))

    S["silver_orders"] = with_([bronze("b", "orders"), silver_orders("s", "b")], "SELECT * FROM s")
    S["silver_order_details"] = with_([bronze("b", "lineitem"), silver_lines("s", "b")], "SELECT * FROM s")
    S["silver_pizza"] = with_([bronze("bronze_part", "part"), silver_products()], "SELECT * FROM silver_products")
    S["dedupe_latest"] = (f"SELECT {LINE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
                          f"l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, l_partkey ASC NULLS FIRST, "
                          f"l_suppkey ASC NULLS FIRST, l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST) "
                          f"AS rn FROM lineitem) WHERE rn = 1")

    S["surrogate_key"] = f"SELECT p_partkey, {sk('p_partkey')} AS part_sk FROM part"
    S["surrogate_key_multi"] = (f"SELECT l_orderkey, l_linenumber, "
                                f"{sk('l_orderkey', 'nullif(l_linenumber, 1)', 'CAST(l_shipdate AS DATE)')} "
                                f"AS line_sk FROM lineitem")
    dd = dim_date_cte()
    S["date_spine"] = with_(dd[:2], "SELECT calendar_date FROM spine")
    S["dim_date"] = with_(dd, "SELECT * FROM dim_date")
    S["dim_date_fiscal"] = with_(dim_date_cte(fiscal_start=R.FISCAL_START_ALT),
                                 "SELECT calendar_date, fiscal_year, fiscal_month, fiscal_quarter FROM dim_date")
    S["dim_date_relative"] = with_(dd, "SELECT calendar_date, rltv_day, rltv_week, rltv_month, rltv_quarter, "
                                       "rltv_year FROM dim_date")

    S["split_explode"] = ("SELECT p_partkey, TRIM(component) AS component, CAST(pos AS INTEGER) AS component_position "
                          "FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS component, "
                          "unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS pos FROM part)")
    S["ingredient_count"] = ("SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS component_count "
                             "FROM part")
    comp = [bronze("bronze_part", "part")] + components_ctes()
    S["dim_ingredients"] = with_(comp, "SELECT * FROM dim_components")
    S["bridge_ingredients"] = with_(comp, "SELECT * FROM bridge")
    S["bridge_strict_semi"] = with_(product_ctes() + components_ctes(),
                                    "SELECT * FROM bridge b WHERE b.product_type_id IN (SELECT product_type_id "
                                    "FROM dim_product WHERE price_tier <> 'Luxury')")

    S["seed_join"] = with_([bronze("bronze_part", "part"), silver_products(), size_labels()],
                           "SELECT i.size_code, i.product_id, l.size_label, l.size_description, l.serves_min, "
                           "l.serves_max FROM silver_products i LEFT JOIN size_labels l ON i.size_code = l.size_code")
    S["price_tier"] = f"SELECT p_partkey, p_retailprice, {PRICE_CASE.format(p='p_retailprice')} AS price_tier FROM part"
    vm = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in R.SIZE_CODE_NAMES.items())
    S["value_map"] = with_([bronze("bronze_part", "part"), silver_products()],
                           f"SELECT product_id, size_code, coalesce(CASE size_code {vm} END, size_code) AS size_name "
                           f"FROM silver_products")
    S["dim_product"] = S["dim_product_join"] = with_(product_ctes(), "SELECT * FROM dim_product")
    S["seed_csv_join"] = with_([bronze("bronze_part", "part"), silver_products(), size_labels()],
                               "SELECT i.size_code, i.product_id, l.* EXCLUDE (size_code) FROM silver_products i "
                               "LEFT JOIN size_labels l ON i.size_code = l.size_code")
    S["time_of_day"] = "SELECT event_id, strftime(ts, '%H:%M:%S') AS order_time, CAST(hour(ts) AS INTEGER) AS order_hour FROM events"

    S["fact_orders"] = with_(fact_ctes(), "SELECT * FROM fact")
    S["quantity_valid"] = with_(fact_ctes(R.QUANTITY_SHIFT), "SELECT order_detail_id, quantity, quantity_valid FROM fact")
    S["gross_amount"] = with_(fact_ctes() + product_ctes(), """SELECT f.order_detail_sk, f.order_detail_id, f.order_id,
  f.product_id, f.order_date, f.quantity_valid, CAST(CAST(d.price AS DECIMAL(18,2)) AS DOUBLE) AS unit_price,
  CAST(CAST(f.quantity_valid AS DECIMAL(18,0)) * CAST(d.price AS DECIMAL(18,2)) AS DOUBLE) AS gross_amount
FROM fact f LEFT JOIN dim_product d ON f.product_sk = d.product_sk""")

    S["check_not_null"] = ("SELECT * REPLACE (nullif(l_discount, 0.0) AS l_discount) FROM lineitem "
                           "WHERE nullif(l_discount, 0.0) IS NULL")
    S["check_unique"] = ("SELECT l_orderkey * 10 + l_linenumber AS order_detail_id, count(*) AS n_records "
                         "FROM lineitem WHERE l_orderkey * 10 + l_linenumber IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
    acc = ", ".join(q(v) for v in R.PRIORITIES_ACCEPTED)
    S["check_accepted_values"] = (f"SELECT o_orderpriority, count(*) AS n_records FROM orders "
                                  f"WHERE NOT (o_orderpriority IN ({acc})) GROUP BY o_orderpriority")
    S["check_relationships"] = (f"SELECT * FROM lineitem l WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM "
                                f"orders o WHERE o.o_orderdate < TIMESTAMP '{R.PARENT_DATE_CUT}' "
                                f"AND o.o_orderkey = l.l_orderkey)")
    S["check_unique_combination"] = ("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
                                     "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
    S["check_expression"] = "SELECT * FROM lineitem WHERE NOT (l_discount <= 0.08)"
    S["check_range"] = "SELECT * FROM lineitem WHERE NOT (l_quantity BETWEEN 0 AND 40)"
    S["check_positive"] = ("SELECT * REPLACE (l_quantity - 25 AS l_quantity) FROM lineitem "
                           "WHERE l_quantity - 25 <= 0")
    S["orphan_antijoin"] = with_(fact_ctes() + product_ctes(),
                                 "SELECT * FROM fact f WHERE f.product_sk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM "
                                 "dim_product d WHERE d.price_tier <> 'Luxury' AND d.product_sk = f.product_sk)")
    S["freshness"] = (f"SELECT 'events' AS relation, max_loaded_at, age_hours, CASE WHEN max_loaded_at IS NULL "
                      f"THEN 'error' WHEN age_hours > 48 THEN 'error' WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END "
                      f"AS status FROM (SELECT max_loaded_at, (epoch_us(TIMESTAMP '{R.FRESHNESS_AS_OF}') - "
                      f"epoch_us(max_loaded_at)) / 3600e6 AS age_hours FROM (SELECT max(ts) AS max_loaded_at "
                      f"FROM events))")
    S["freshness_sources"] = ("SELECT relation, max_loaded_at, age_hours, CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > 48 THEN 'error' "
                              "WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT relation, max_loaded_at, "
                              f"(epoch_us(TIMESTAMP '{R.FRESHNESS_AS_OF}') - epoch_us(max_loaded_at)) / 3600e6 AS age_hours FROM ("
                              "SELECT 'orders' AS relation, max(o_orderdate)::TIMESTAMP AS max_loaded_at FROM orders "
                              "UNION ALL SELECT 'lineitem', max(l_shipdate)::TIMESTAMP FROM lineitem UNION ALL SELECT 'events', max(ts)::TIMESTAMP FROM events "
                              f"UNION ALL SELECT 'part', CASE WHEN count(*) > 0 THEN {TS1} END FROM part))")
    S["quality_report"] = _report_sql()

    star = fact_ctes() + product_ctes()
    S["q_revenue_by_product"] = with_(star + [
        "t AS (SELECT product_sk, sum(quantity_valid) AS quantity FROM fact GROUP BY product_sk)"],
        f"""SELECT d.product_id, d.product_name, d.product_category, CAST(t.quantity AS BIGINT) AS quantity,
  CAST(CAST(t.quantity AS DECIMAL(18,0)) * CAST(d.price AS DECIMAL(18,2)) AS DOUBLE) AS revenue
FROM t JOIN dim_product d ON t.product_sk = d.product_sk
ORDER BY revenue DESC NULLS LAST, d.product_id LIMIT {R.TOP_PRODUCTS}""")
    S["q_busiest_day"] = with_(fact_ctes() + dim_date_cte() + [
        "per_date AS (SELECT date_sk, count(DISTINCT order_id) AS n_orders, count(*) AS n_lines, "
        "sum(quantity_valid) AS quantity FROM fact GROUP BY date_sk)"],
        """SELECT c.day_of_week, c.day_name, CAST(sum(p.n_orders) AS BIGINT) AS n_orders,
  CAST(sum(p.n_lines) AS BIGINT) AS n_lines, CAST(sum(p.quantity) AS BIGINT) AS total_quantity
FROM per_date p JOIN dim_date c ON p.date_sk = c.date_sk GROUP BY c.day_of_week, c.day_name""")
    S["q_busiest_hour"] = ("SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS n_events, "
                           "count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
    S["q_ingredient_frequency"] = with_(star + components_ctes() + [
        "f AS (SELECT f.order_id, d.product_type_sk, f.quantity_valid FROM fact f JOIN dim_product d "
        "ON f.product_sk = d.product_sk)",
        "per_type AS (SELECT product_type_sk, order_id, sum(quantity_valid) AS q FROM f GROUP BY 1, 2)",
        "pairs AS (SELECT DISTINCT product_type_sk, component FROM bridge WHERE component IS NOT NULL)",
        "per_order AS (SELECT p.component, t.order_id, sum(t.q) AS q FROM per_type t JOIN pairs p "
        "ON t.product_type_sk = p.product_type_sk GROUP BY 1, 2)"],
        "SELECT component, count(*) AS n_orders, CAST(sum(q) AS BIGINT) AS total_quantity FROM per_order "
        "GROUP BY component")
    S["q_revenue_by_quarter"] = with_(star + dim_date_cte() + [
        "per AS (SELECT product_sk, date_sk, sum(quantity_valid) AS q FROM fact GROUP BY 1, 2)",
        """qq AS (SELECT c.year_number, c.quarter_number, c.year_number * 4 + c.quarter_number AS qi,
     CAST(sum(CAST(per.q AS DECIMAL(18,0)) * CAST(d.price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
   FROM per JOIN dim_product d ON per.product_sk = d.product_sk JOIN dim_date c ON per.date_sk = c.date_sk
   GROUP BY c.year_number, c.quarter_number)"""],
        """SELECT a.year_number, a.quarter_number, a.revenue, p.revenue AS prev_revenue,
  a.revenue - p.revenue AS revenue_change, (a.revenue - p.revenue) / p.revenue * 100 AS pct_change
FROM qq a LEFT JOIN qq p ON a.qi = p.qi + 1""")
    S["q_avg_order_value"] = with_(star + [
        """per_order AS (SELECT d.product_category, f.order_id,
     sum(CAST(f.quantity_valid AS DECIMAL(18,0)) * CAST(d.price AS DECIMAL(18,2))) AS amount
   FROM fact f JOIN dim_product d ON f.product_sk = d.product_sk GROUP BY 1, 2)"""],
        """SELECT product_category, count(*) AS n_orders, CAST(sum(amount) AS DOUBLE) AS total_revenue,
  CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order_value FROM per_order GROUP BY product_category""")

    S["vector_topk"] = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, list_cosine_similarity(a.v, b.v) AS score
      FROM e a, e b WHERE a.vec_id <> b.vec_id),
r AS (SELECT query_id, doc_id, round(score, 6) AS score,
             row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id ASC) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {R.VECTOR_K}"""
    S["keyword_topk"] = with_(bm25_ctes("SELECT item_id AS qid, text AS qtext FROM benchmark", R.KEYWORD_K),
                              "SELECT * FROM ranked")
    S["term_index"] = f"""WITH dt AS (SELECT row_number() OVER () AS place, {tokens_sql('text')} AS toks FROM documents),
held AS (SELECT term, place, any_value(dl) AS dl, count(*) AS tf FROM (SELECT place, len(toks) AS dl, unnest(toks) AS term FROM dt) GROUP BY term, place)
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, CAST(max(tf) AS INTEGER) AS max_tf, CAST(min(dl) AS INTEGER) AS min_len FROM held GROUP BY term"""
    S["context_assembly"] = with_(bm25_ctes("SELECT item_id AS qid, text AS qtext FROM benchmark", R.CONTEXT_K)
                                  + [context_cte("ctx", "ranked")], "SELECT * FROM ctx")
    S["chat_history"] = with_([history_cte("h", R.HISTORY_N)],
                              "SELECT conv_id, turn, role, text, n_history, history_text FROM h")
    qsql = (f"SELECT conv_id * {R.QUESTION_ID_SCALE} + turn AS qid, replace(text, '''', '') AS qtext "
            f"FROM conversations WHERE role = 'user'")
    prompt = template_sql({"history": "h.history_text", "context": "c.context", "question": "qs.question"})
    questions = (f"qs AS (SELECT conv_id, turn, conv_id * {R.QUESTION_ID_SCALE} + turn AS query_id, "
                 f"replace(text, '''', '') AS question FROM conversations WHERE role = 'user')")
    rewrite = template_sql({"history": "h.history_text", "question": "qs.question"}, REWRITE_TEMPLATE)
    S["rewrite_prompt"] = with_(
        [history_cte("h", R.HISTORY_N), questions],
        f"""SELECT qs.conv_id, qs.turn, qs.question, coalesce(h.n_history, 0) > 0 AS rewrite,
       CASE WHEN h.n_history > 0 THEN {rewrite} END AS rewrite_prompt
FROM qs LEFT JOIN h ON qs.conv_id = h.conv_id AND qs.turn = h.turn""")
    S["prompt_assembly"] = with_(
        bm25_ctes(qsql, R.CONTEXT_K) + [context_cte("ctx", "ranked"), history_cte("h", R.HISTORY_N), questions],
        f"""SELECT qs.conv_id, qs.turn, coalesce(h.n_history, 0) > 0 AS has_history, {prompt} AS prompt
FROM qs LEFT JOIN h ON qs.conv_id = h.conv_id AND qs.turn = h.turn
LEFT JOIN ctx c ON qs.query_id = c.query_id""")
    return S


ORACLE = build()
