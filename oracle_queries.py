"""The registered queries as plain SQL over the driver tables, for DuckDB."""

from __future__ import annotations

from basketry.contracts import AUDIT_COLUMNS, ENTITIES, contract
from basketry.plans.driver_tables import DEPARTMENT_IDS, NO_AISLE, NO_DEPARTMENT
from basketry.plans.stored import LABEL

OLD_LABEL = "2026-04-01"

# Written out here, so that a name forgotten in the library is missed. Fixed values.
PRODUCT_KEYS = "product_id, product_name, aisle_id, aisle, department_id, department"
TABLE_KEYS = {
    "orders": ["order_id"],
    "products": ["product_id"],
    "aisles": ["aisle_id"],
    "departments": ["department_id"],
    "order_products_prior": ["order_id", "product_id"],
    "order_products_train": ["order_id", "product_id"],
}
REFERENCES = [
    ("order_products_prior", "order_id", "orders"),
    ("order_products_train", "order_id", "orders"),
    ("order_products_prior", "product_id", "products"),
    ("order_products_train", "product_id", "products"),
    ("products", "aisle_id", "aisles"),
    ("products", "department_id", "departments"),
]
# The first two columns of each table.
_RAW_STARTS = {
    "orders": ("order_id", "user_id"),
    "products": ("product_id", "product_name"),
    "departments": ("department_id", "department"),
    "aisles": ("aisle_id", "aisle"),
    "order_products_prior": ("order_id", "product_id"),
    "order_products_train": ("order_id", "product_id"),
}
STARTS = {
    "raw": _RAW_STARTS,
    "bronze": _RAW_STARTS,
    "silver": {
        "orders_clean": ("order_id", "user_id"),
        "products_enriched": ("product_id", "product_name"),
        "order_items_prior_enriched": ("order_id", "product_id"),
        "order_items_train_enriched": ("order_id", "product_id"),
    },
    "gold": {
        "orders_by_period": ("order_dow", "order_hour_of_day"),
        "top_products": ("product_id", "product_name"),
        "repurchase_metrics": ("product_id", "product_name"),
    },
}


def _int(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({text}), '^[+-]?[.][0-9]*$') THEN 0 ELSE "
        f"TRY_CAST(nullif(regexp_extract(trim({text}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') "
        "AS INTEGER) END"
    )


def _typed(column: str, kind: str) -> str:
    if kind == "int":
        return f"{_int(column)} AS {column}"
    if kind == "double":
        return f"TRY_CAST(nullif(trim({column}), '') AS DOUBLE) AS {column}"
    return f"trim({column}) AS {column}"


def _bronze(entity: str) -> str:
    spec = ENTITIES[entity]
    typed = ", ".join(_typed(f.name, f.dataType.simpleString()) for f in spec.schema)
    any_value = " OR ".join(f"{c} IS NOT NULL" for c in spec.columns)
    return (
        f"SELECT {typed}, '{LABEL}' AS raw_ingestion_date FROM raw_{entity} WHERE {any_value}"
    )


_DEPARTMENT_CASE = (
    "CASE p_type " + " ".join(f"WHEN '{t}' THEN '{i}'" for t, i in DEPARTMENT_IDS.items()) + " END"
)
_AISLE_ID = "regexp_extract(p_brand, '([0-9]+)', 1)"


def _raw_items(again: str) -> str:
    return f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(CASE WHEN l_partkey % 131 = 0 THEN l_partkey + 1000000 ELSE l_partkey END AS VARCHAR)
    AS product_id,
  CAST(l_linenumber AS VARCHAR) AS add_to_cart_order,
  CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN {again} THEN '1' ELSE '0' END AS reordered
FROM lineitem"""


def _silver_items(source: str) -> str:
    return f"""
SELECT i.order_id, i.product_id, i.add_to_cart_order, i.reordered, o.user_id, o.eval_set,
  o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order, o.is_first_order,
  p.product_name, p.aisle_id, p.aisle, p.department_id, p.department,
  i.raw_ingestion_date AS bronze_raw_ingestion_date
FROM bronze_order_products_{source} i
JOIN silver_orders_clean o ON i.order_id = o.order_id
LEFT JOIN silver_products_enriched p ON i.product_id = p.product_id
WHERE i.product_id IS NOT NULL"""


_ORDER_ROWS = """
SELECT ' ' || o_orderkey || ' ' AS order_id,
  CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
  CASE WHEN o_orderkey % 11 = 0 THEN 'test' WHEN o_orderkey % 5 = 0 THEN 'train'
    ELSE ' PRIOR ' END AS eval_set,
  CAST(row_number() OVER customer AS VARCHAR)
    || CASE WHEN o_orderkey % 79 = 0 THEN '.9' ELSE '' END AS order_number,
  CASE WHEN o_orderkey % 97 = 0 THEN '7' WHEN o_orderkey % 113 = 0 THEN '1e2'
    ELSE CAST(dayofweek(o_orderdate) AS VARCHAR) END AS order_dow,
  CASE WHEN o_orderkey % 101 = 0 THEN '10.0' WHEN o_orderkey % 109 = 0 THEN '.5'
    ELSE CAST(o_orderkey % 24 AS VARCHAR) END AS order_hour_of_day,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN 'abc'
    ELSE CAST(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER customer,
      CAST(o_orderdate AS DATE)) AS VARCHAR) || '.0' END AS days_since_prior_order,
  o_orderkey
FROM orders WINDOW customer AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""

# Each common table expression with the ones it reads.
_CTES: dict[str, tuple[str, list[str]]] = {
    "order_rows": (_ORDER_ROWS, []),
    "raw_orders": (
        "SELECT * EXCLUDE (o_orderkey) FROM order_rows"
        " UNION ALL SELECT * EXCLUDE (o_orderkey) FROM order_rows WHERE o_orderkey % 103 = 0"
        " UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM order_rows"
        " WHERE o_orderkey % 499 = 0",
        ["order_rows"],
    ),
    "raw_products": (
        "SELECT ' ' || p_partkey AS product_id, p_name"
        " || CASE WHEN p_partkey % 17 = 0 THEN ', \"large\"' ELSE '' END || ' ' AS product_name,"
        f" {_AISLE_ID} AS aisle_id, {_DEPARTMENT_CASE} AS department_id FROM part",
        [],
    ),
    "raw_aisles": (
        f"SELECT DISTINCT {_AISLE_ID} AS aisle_id, p_brand AS aisle FROM part"
        f" WHERE p_brand <> '{NO_AISLE}'",
        [],
    ),
    "raw_departments": (
        f"SELECT DISTINCT {_DEPARTMENT_CASE} AS department_id, lower(p_type) AS department"
        f" FROM part WHERE p_type <> '{NO_DEPARTMENT}'",
        [],
    ),
    "raw_order_products_prior": (_raw_items("l_returnflag = 'R'"), []),
    "raw_order_products_train": (_raw_items("l_linestatus = 'F'"), []),
    **{f"bronze_{e}": (_bronze(e), [f"raw_{e}"]) for e in ENTITIES},
    "silver_orders_clean": (
        """
SELECT * EXCLUDE (pick) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY user_id, eval_set, order_number,
    order_dow, order_hour_of_day, days_since_prior_order NULLS FIRST, is_first_order) AS pick
  FROM (
    SELECT order_id, user_id, lower(trim(eval_set)) AS eval_set, order_number, order_dow,
      order_hour_of_day,
      CASE WHEN order_number = 1 THEN 0.0 ELSE days_since_prior_order END
        AS days_since_prior_order,
      raw_ingestion_date AS bronze_raw_ingestion_date, order_number = 1 AS is_first_order
    FROM bronze_orders
    WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND order_number IS NOT NULL
      AND eval_set IS NOT NULL AND order_dow BETWEEN 0 AND 6
      AND order_hour_of_day BETWEEN 0 AND 23)) WHERE pick = 1""",
        ["bronze_orders"],
    ),
    "silver_products_enriched": (
        "SELECT p.product_id, p.product_name, p.aisle_id, a.aisle, p.department_id,"
        " d.department, p.raw_ingestion_date AS bronze_raw_ingestion_date"
        " FROM bronze_products p LEFT JOIN bronze_aisles a ON p.aisle_id = a.aisle_id"
        " LEFT JOIN bronze_departments d ON p.department_id = d.department_id",
        ["bronze_products", "bronze_aisles", "bronze_departments"],
    ),
    **{
        f"silver_order_items_{s}_enriched": (
            _silver_items(s),
            [f"bronze_order_products_{s}", "silver_orders_clean", "silver_products_enriched"],
        )
        for s in ("prior", "train")
    },
}


def _ordered(names: list[str], seen: dict[str, None]) -> dict[str, None]:
    for name in names:
        if name not in seen:
            _ordered(_CTES[name][1], seen)
            seen[name] = None
    return seen


def _with(names: list[str], select: str) -> str:
    needed = _ordered(names, {})
    ctes = ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in needed)
    return f"WITH {ctes}\n{select}"


def _all_of(name: str) -> str:
    return _with([name], f"SELECT * FROM {name}")


_KEYS = PRODUCT_KEYS
_PRIOR = "silver_order_items_prior_enriched"

_TOP_PRODUCTS = f"""
SELECT *, round(total_reorders / total_order_rows, 4) AS reorder_rate FROM (
  SELECT {_KEYS}, count(*) AS total_order_rows, count(DISTINCT order_id) AS distinct_orders,
    count(DISTINCT user_id) AS distinct_users, CAST(sum(reordered) AS BIGINT) AS total_reorders
  FROM {_PRIOR} GROUP BY ALL)"""


def _repurchase(keys: str) -> str:
    return f"""
SELECT *, round(total_reorders / total_order_rows, 4) AS reorder_rate FROM (
  SELECT {keys}, count(*) AS total_order_rows, CAST(sum(reordered) AS BIGINT) AS total_reorders,
    count(DISTINCT user_id) AS distinct_users,
    count(DISTINCT CASE WHEN reordered = 1 THEN user_id END) AS distinct_reordering_users,
    count(DISTINCT order_id) AS distinct_orders,
    count(DISTINCT CASE WHEN reordered = 1 THEN order_id END) AS distinct_reorder_orders
  FROM {_PRIOR} GROUP BY ALL)"""


def _report_rows(layer: str, table: str, source: str, snapshot: str | None = "stored") -> str:
    """The report on a snapshot: stored as the contract says, damaged, or empty; None: no name."""
    first, second = STARTS[layer][table]
    name = "" if snapshot is None else f"'{snapshot}' AS snapshot, "
    damaged, empty = snapshot == "damaged", snapshot == "empty"
    retyped = f"{second} bigint" if damaged and layer != "raw" else ""
    rows = "0" if empty else f"(SELECT count(*) FROM ({source}))"

    def row(check: str, expected: str, observed: str, passed: str) -> str:
        return (
            f"SELECT {name}'{layer}.{table}' AS table_name, '{check}' AS check_name,"
            f" '{expected}' AS expected, {observed} AS observed, {passed} AS passed"
        )

    return " UNION ALL ".join(
        [
            row("missing_columns", "", f"'{first if damaged else ''}'", str(not damaged)),
            row("unexpected_columns", "", f"'{'surplus' if damaged else ''}'", "TRUE"),
            row("wrong_types", "", f"'{retyped}'", str(not retyped)),
            row("row_count", "> 0", f"CAST({rows} AS VARCHAR)", f"{rows} > 0"),
        ]
    )


def _three_reports(layer: str, table: str, source: str) -> str:
    return " UNION ALL ".join(
        _report_rows(layer, table, source, s) for s in ("stored", "damaged", "empty")
    )


def _share(keys: str) -> str:
    return _with(
        [_PRIOR],
        f"SELECT {keys}, item_count, round(item_count / sum(item_count) OVER (), 4) AS item_share"
        f" FROM (SELECT {keys}, count(*) AS item_count FROM {_PRIOR} GROUP BY ALL)",
    )


_PRODUCT_RANKINGS = {"top_products": _TOP_PRODUCTS, "repurchase_metrics": _repurchase(_KEYS)}
_GOLD = {
    "orders_by_period": _with(
        ["silver_orders_clean"],
        """
SELECT *, round(total_orders / distinct_users, 4) AS avg_orders_per_user FROM (
  SELECT order_dow, order_hour_of_day, count(DISTINCT order_id) AS total_orders,
    count(DISTINCT user_id) AS distinct_users FROM silver_orders_clean GROUP BY ALL)""",
    ),
    **{t: _with([_PRIOR], sql) for t, sql in _PRODUCT_RANKINGS.items()},
}

_NUMERIC = [
    (e.name, f.name, f.dataType.simpleString())
    for e in ENTITIES.values()
    for f in e.schema
    if f.dataType.simpleString() in ("int", "double")
]


def _bad_values(entity: str, column: str, kind: str) -> str:
    value = _typed(column, kind).removesuffix(f" AS {column}")
    return (
        f"SELECT '{entity}' AS table_name, '{column}' AS column_name, '{kind}' AS expected_type,"
        f" count(*) FILTER (WHERE {column} IS NOT NULL AND ({value}) IS NULL) AS bad_values"
        f" FROM raw_{entity}"
    )


def _key_duplicates(table: str, keys: list[str]) -> str:
    listed = ", ".join(keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns,"
        " count(*) AS duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows"
        f" FROM (SELECT count(*) AS n FROM bronze_{table} WHERE {known}"
        f" GROUP BY {listed} HAVING count(*) > 1)"
    )


def _orphans(table: str, column: str, referenced: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
        f" '{referenced}' AS referenced_table, count(DISTINCT {column}) AS orphan_ids,"
        f" count(*) AS orphan_rows FROM bronze_{table} t WHERE {column} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM bronze_{referenced} r WHERE r.{column} = t.{column})"
    )


# What each table is made of; written out here like the other names.
_MADE_OF = {
    **{f"bronze.{e}": [f"raw.{e}"] for e in _RAW_STARTS},
    "silver.orders_clean": ["bronze.orders"],
    "silver.products_enriched": ["bronze.products", "bronze.aisles", "bronze.departments"],
    "silver.order_items_prior_enriched": [
        "bronze.order_products_prior", "silver.orders_clean", "silver.products_enriched",
    ],
    "silver.order_items_train_enriched": [
        "bronze.order_products_train", "silver.orders_clean", "silver.products_enriched",
    ],
    "gold.orders_by_period": ["silver.orders_clean"],
    "gold.top_products": ["silver.order_items_prior_enriched"],
    "gold.repurchase_metrics": ["silver.order_items_prior_enriched"],
}


def _run_stale() -> str:
    """Only what is made of the aisles, directly or not, is stale after they were landed anew."""
    of_aisles = {
        "raw.aisles", "bronze.aisles", "silver.products_enriched", "silver.order_items_prior_enriched",
        "silver.order_items_train_enriched", "gold.top_products", "gold.repurchase_metrics",
    }
    rows = []
    for phase in ("landed", "built"):
        for table, inputs in _MADE_OF.items():
            for given in inputs:
                renewed = phase == "built" and given in ("raw.aisles", "bronze.aisles")
                layer, name = table.split(".")
                count = f"(SELECT count(*) FROM ({_GOLD[name] if layer == 'gold' else f'SELECT * FROM {layer}_{name}'}))"
                rows.append(
                    f"SELECT '{phase}' AS phase, '{table}' AS table_name, '{given}' AS input_name,"
                    f" '{LABEL if renewed else OLD_LABEL}' AS label, {phase == 'landed' and given in of_aisles} AS stale,"
                    f" {phase == 'built' and table == 'silver.products_enriched'} AS mixed,"
                    f" {count if table in of_aisles else 'CAST(NULL AS BIGINT)'} AS row_count"
                )
    tables = ["bronze_aisles", *(f"silver_{t}" for t in STARTS["silver"])]
    return _with(tables, " UNION ALL ".join(rows))


def oracle_sql() -> dict[str, str]:
    raw = [f"raw_{e}" for e in ENTITIES]
    bronze = [f"bronze_{e}" for e in ENTITIES]
    union = " UNION ALL ".join
    out = {n: _all_of(n) for n in bronze}
    out |= {n: _all_of(n) for n in _CTES if n.startswith("silver_")}
    out |= {f"gold_{n}": sql for n, sql in _GOLD.items()}

    out["dq_raw"] = _with(
        raw, union(_three_reports("raw", e, f"SELECT * FROM raw_{e}") for e in ENTITIES)
    )
    for layer in ("bronze", "silver"):
        for t in STARTS[layer]:
            source = f"{layer}_{t}"
            out[f"dq_{source}"] = _with(
                [source], _three_reports(layer, t, f"SELECT * FROM {source}")
            )
    for t, sql in _GOLD.items():
        out[f"dq_gold_{t}"] = _three_reports("gold", t, sql)

    out["src_manifest"] = union(
        f"SELECT '{e.name}' AS entity, '{e.file_name}' AS file_name, '{folder}' AS folder,"
        f" {folder == 'whole' or e.name in ('aisles', 'departments')} AS present"
        for e in ENTITIES.values()
        for folder in ("whole", "part")
    )
    out["raw_landing"] = _with(
        raw, " UNION ALL BY NAME ".join(f"SELECT *, '{e}' AS entity FROM raw_{e}" for e in ENTITIES)
    )
    out["raw_landing_summary"] = union(
        f"SELECT '{e}' AS entity, TRUE AS has_files, TRUE AS bytes_agree" for e in ENTITIES
    )
    out |= {f"scan_csv_{e}": _all_of(f"raw_{e}") for e in ENTITIES}
    out["scan_csv_multiline"] = (
        "SELECT ' ' || p_partkey AS product_id, CASE WHEN p_partkey % 3 = 0 THEN"
        " replace(p_name, ' ', chr(10)) || chr(10) || chr(10) || '\"' || p_type || '\",' || chr(10) || p_name"
        f" ELSE p_name || ' 5\" x' END AS product_name, {_AISLE_ID} AS aisle_id,"
        f" {_DEPARTMENT_CASE} AS department_id FROM part"
    )
    out["scan_parquet_snapshot"] = _all_of("bronze_orders")
    out["latest_snapshot"] = _with(
        ["bronze_products"],
        f"SELECT '{LABEL}' AS ingestion_date, raw_ingestion_date, count(*) AS row_count"
        " FROM bronze_products GROUP BY raw_ingestion_date",
    )
    out["snapshot_label"] = _with(
        ["bronze_products"],
        f"SELECT '{OLD_LABEL}' AS ingestion_date, count(*) AS row_count FROM bronze_products"
        f" WHERE aisle_id < 30 UNION ALL SELECT '{LABEL}', count(*) FROM bronze_products",
    )
    out["snapshot_overwrite"] = _with(
        ["bronze_products"],
        f"SELECT '{OLD_LABEL}' AS ingestion_date, '{OLD_LABEL}' AS raw_ingestion_date,"
        " * EXCLUDE (raw_ingestion_date) FROM bronze_products WHERE aisle_id < 30"
        f" UNION ALL SELECT '{LABEL}', '{LABEL}', * EXCLUDE (raw_ingestion_date)"
        " FROM bronze_products WHERE department_id <= 3",
    )
    out["snapshot_summary"] = _with(
        bronze,
        union(
            f"SELECT '{e}' AS table_name, '{LABEL}' AS ingestion_date, count(*) AS row_count"
            f" FROM bronze_{e}"
            for e in ENTITIES
        ),
    )
    out |= {f"end_to_end_{n}": sql for n, sql in _GOLD.items()}

    out |= {f"silver_{s}_in_buckets": _all_of(f"silver_order_items_{s}_enriched") for s in ("prior", "train")}
    out["run_stale"] = _run_stale()
    ranked = {t: f"SELECT *, '{t}' AS ranking FROM ({sql})" for t, sql in _PRODUCT_RANKINGS.items()}
    out["gold_updated"] = _with([_PRIOR], " UNION ALL BY NAME ".join(ranked.values()))
    levels = ["department_id, department", "aisle_id, aisle", "product_id, product_name"]
    sets = ", ".join(f"({', '.join(levels[:n])})" for n in range(4))
    out["gold_rollup"] = _with(
        [_PRIOR],
        f"""
SELECT *, round(total_reorders / total_order_rows, 4) AS reorder_rate FROM (
  SELECT CAST(3 - grouping(department_id) - grouping(aisle_id) - grouping(product_id) AS INTEGER) AS level, {', '.join(levels)},
    count(*) AS total_order_rows, CAST(sum(reordered) AS BIGINT) AS total_reorders,
    count(DISTINCT user_id) AS distinct_users,
    count(DISTINCT CASE WHEN reordered = 1 THEN user_id END) AS distinct_reordering_users
  FROM {_PRIOR} GROUP BY GROUPING SETS ({sets}))""",
    )
    out["dq_key_duplicates"] = _with(
        bronze, union(_key_duplicates(t, k) for t, k in TABLE_KEYS.items())
    )
    out["dq_type_conformance"] = _with(raw, union(_bad_values(*column) for column in _NUMERIC))
    less = {("short", "departments"): 1}
    out["dq_source_raw_counts"] = _with(
        raw,
        union(
            f"SELECT '{landing}' AS landing, '{e}' AS entity, count(*) AS source_rows,"
            f" count(*) - {less.get((landing, e), 0)} AS raw_rows,"
            f" {(landing, e) not in less} AS passed FROM raw_{e}"
            for landing in ("whole", "short")
            for e in ENTITIES
        ),
    )
    changed = ("changed", "aisles")
    out["dq_source_raw_content"] = _with(
        raw,
        union(
            f"SELECT '{landing}' AS landing, '{e}' AS entity, count(*) AS source_rows, CAST({n} AS BIGINT) AS only_in_source,"
            f" CAST({n} AS BIGINT) AS only_in_raw, CAST({n} AS BIGINT) AS differing_files, '{'raw,source' if n else ''}' AS sides,"
            f" {not n} AS passed FROM raw_{e}"
            for landing in ("whole", "changed")
            for e in ENTITIES
            for n in (int((landing, e) == changed),)
        ),
    )
    orders_columns = [c for c in contract("silver", "orders_clean").fieldNames() if c not in AUDIT_COLUMNS]
    reasons = {"order_hour_of_day": "distribution,different", "days_since_prior_order": "nulls"}

    def column_drift(label: str, column: str) -> str:
        shifted = label == "2026-04-03"
        kept = f"count(*) FILTER (WHERE order_id % 3 <> 0 AND {column} IS NOT NULL)"
        less = f"count(*) - {kept if shifted and column == 'days_since_prior_order' else f'count({column})'}"
        reason = reasons.get(column, "") if shifted else ""
        return (
            f"SELECT '{label}' AS run_label, '{column}' AS column_name, count(*) AS row_count_before,"
            f" count(*) AS row_count_now, count(*) - count({column}) AS null_count_before, {less} AS null_count_now,"
            f" '{reason}' AS reasons, {bool(reason)} AS drifted FROM silver_orders_clean"
        )

    out["dq_drift"] = _with(
        ["silver_orders_clean"],
        union(column_drift(label, c) for label in ("2026-04-02", "2026-04-03") for c in orders_columns),
    )
    out["dq_orphans"] = _with(bronze, union(_orphans(*r) for r in REFERENCES))
    of_layers = [f"{layer}_{t}" for layer in ("raw", "bronze", "silver") for t in STARTS[layer]]
    tables = [
        _report_rows(layer, t, _GOLD[t] if layer == "gold" else f"SELECT * FROM {layer}_{t}", None)
        for layer in STARTS
        for t in STARTS[layer]
    ]
    out["dq_summary"] = _with(
        of_layers, f"SELECT *, '{LABEL}' AS run_label FROM ({union(tables)})"
    )

    out["q_department_volume"] = _share("department_id, department")
    out["q_aisle_share"] = _share("aisle_id, aisle")
    out["q_basket_size"] = _with(
        [_PRIOR],
        "SELECT count(DISTINCT order_id) AS order_count, count(*) AS item_count,"
        f" round(count(*) / count(DISTINCT order_id), 4) AS avg_items_per_order FROM {_PRIOR}",
    )
    interval = (
        "round(sum(days_since_prior_order) FILTER (WHERE NOT is_first_order)"
        " / nullif(count(days_since_prior_order) FILTER (WHERE NOT is_first_order), 0), 4)"
        " AS avg_days_between_orders"
    )
    out["q_order_interval"] = _with(
        ["silver_orders_clean"],
        f"SELECT user_id, count(*) AS order_count, {interval}"
        " FROM silver_orders_clean GROUP BY user_id",
    )
    out["q_successive_products"] = _with(
        [_PRIOR],
        f"""
SELECT product_id, product_name, count(*) AS successive_purchases,
  count(DISTINCT user_id) AS distinct_users
FROM (
  SELECT product_id, product_name, user_id, order_number - lag(order_number) OVER (
    PARTITION BY product_id, product_name, user_id ORDER BY order_number) AS step
  FROM (SELECT DISTINCT product_id, product_name, user_id, order_number FROM {_PRIOR}))
WHERE step = 1 GROUP BY product_id, product_name""",
    )
    out["q_department_repurchase"] = _with(
        [_PRIOR],
        "SELECT *, round(distinct_reordering_users / distinct_users, 4) AS returning_user_share"
        f" FROM ({_repurchase('department_id, department')})",
    )
    out["q_user_frequency"] = _with(
        ["silver_orders_clean"],
        f"""
SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 10 THEN '6-10'
    WHEN n <= 20 THEN '11-20' ELSE '21+' END AS frequency_group,
  count(DISTINCT user_id) AS user_count, count(*) AS order_count, {interval}
FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM silver_orders_clean)
GROUP BY frequency_group""",
    )
    out["q_cohort_retention"] = _with(
        ["silver_orders_clean"],
        """
SELECT cohort, period, user_count, order_count,
  round(user_count / max(CASE WHEN period = '0-89' THEN user_count END)
    OVER (PARTITION BY cohort), 4) AS user_share
FROM (
  SELECT cohort, CASE WHEN since < 90 THEN '0-89' WHEN since < 180 THEN '90-179'
      WHEN since < 360 THEN '180-359' WHEN since < 720 THEN '360-719' ELSE '720+' END AS period,
    count(DISTINCT user_id) AS user_count, count(*) AS order_count
  FROM (
    SELECT user_id, coalesce(sum(days_since_prior_order) OVER customer, 0)
        - coalesce(first_value(days_since_prior_order) OVER customer, 0) AS since,
      CASE WHEN gap IS NULL THEN 'unknown' WHEN gap <= 30 THEN '0-30' WHEN gap <= 90 THEN '31-90'
        WHEN gap <= 365 THEN '91-365' ELSE '366+' END AS cohort
    FROM (SELECT *, min(CASE WHEN order_number = 2 THEN days_since_prior_order END)
        OVER (PARTITION BY user_id) AS gap FROM silver_orders_clean)
    WINDOW customer AS (PARTITION BY user_id ORDER BY order_number
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  GROUP BY ALL)""",
    )
    out["q_basket_similarity"] = _with(
        [_PRIOR],
        f"""
SELECT order_number, count(*) AS basket_count, CAST(sum(common) AS BIGINT) AS kept_products,
  count(*) FILTER (WHERE common = 0) AS all_new,
  round(sum(CAST(round(common / (n + former - common) * 1000000) AS BIGINT)) / (count(*) * 1000000), 4)
    AS mean_similarity
FROM (
  SELECT b.user_id, b.order_number, len(b.p) AS n, len(a.p) AS former, len(list_intersect(a.p, b.p)) AS common
  FROM baskets a JOIN baskets b ON a.user_id = b.user_id AND a.order_number + 1 = b.order_number)
GROUP BY order_number""",
    ).replace(
        "\nSELECT order_number, count(*) AS basket_count",
        f", baskets AS (SELECT user_id, order_number, list(DISTINCT product_id) AS p FROM {_PRIOR} GROUP BY ALL)"
        "\nSELECT order_number, count(*) AS basket_count",
    )
    out["q_order_survival"] = _with(
        ["silver_orders_clean"],
        """
SELECT cohort, order_number, reached, at_risk, ended, censored, share,
  round(CASE WHEN coalesce(max(went_on = 0) OVER before, FALSE) THEN 0 ELSE
    exp(coalesce(sum(CASE WHEN went_on > 0 THEN ln(went_on) END) OVER before, 0)) END, 4) AS estimate
FROM (
  SELECT *, reached - censored AS at_risk,
    round(reached / max(reached) OVER (PARTITION BY cohort), 4) AS share,
    CASE WHEN ended = censored THEN 1.0 ELSE (reached - ended) / nullif(reached - censored, 0) END AS went_on
  FROM (
    SELECT cohort, order_number, ended, censored,
      CAST(sum(ended) OVER (PARTITION BY cohort ORDER BY order_number DESC) AS BIGINT) AS reached
    FROM (
      SELECT CASE WHEN gap IS NULL THEN 'unknown' WHEN gap <= 30 THEN '0-30' WHEN gap <= 90 THEN '31-90'
          WHEN gap <= 365 THEN '91-365' ELSE '366+' END AS cohort, order_number,
        count(*) AS ended, count(*) FILTER (WHERE test) AS censored
      FROM (
        SELECT user_id, max(order_number) AS order_number, any_value(gap) AS gap,
          bool_or(eval_set = 'test' AND order_number = last) AS test
        FROM (SELECT *, max(order_number) OVER (PARTITION BY user_id) AS last,
            min(CASE WHEN order_number = 2 THEN days_since_prior_order END) OVER (PARTITION BY user_id) AS gap
          FROM silver_orders_clean) GROUP BY user_id)
      GROUP BY ALL)))
WINDOW before AS (PARTITION BY cohort ORDER BY order_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    )
    out["q_frequency_ranks"] = _with(
        ["silver_orders_clean"],
        """
SELECT CAST(floor((r - 1) * 10 / n) + 1 AS BIGINT) AS frequency_rank, count(*) AS user_count,
  min(orders) AS fewest_orders, max(orders) AS most_orders, CAST(sum(orders) AS BIGINT) AS order_count
FROM (SELECT orders, rank() OVER (ORDER BY orders) AS r, count(*) OVER () AS n
  FROM (SELECT user_id, count(*) AS orders FROM silver_orders_clean GROUP BY user_id)) GROUP BY 1""",
    )
    out["q_basket_evolution"] = _with(
        [_PRIOR],
        "SELECT order_number, count(DISTINCT order_id) AS order_count, count(*) AS item_count,"
        " CAST(sum(reordered) AS BIGINT) AS total_reorders,"
        " round(count(*) / count(DISTINCT order_id), 4) AS avg_items_per_order,"
        f" round(sum(reordered) / count(*), 4) AS reorder_rate FROM {_PRIOR}"
        " GROUP BY order_number",
    )
    return out
