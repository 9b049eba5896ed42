"""SQL that states each registered query for an independent engine."""

from __future__ import annotations

from factpanel.bindings import FLOOR, MERGE_TAGS, TAGS
from factpanel.operators.quality import NEGATIVE_REVENUE
from factpanel.queries import BASE_TABLES, LINE_CATEGORIES, METRICS, NO_COMPANY, RATIO_COLS
from factpanel.schema import (
    DELTA_COLS,
    RATIOS,
    SCREENER_TAGS,
    SHEET_COLS,
    TTM_COLS,
    TTM_YOY_COLS,
    YOY_COLS,
)

NUM = """num AS (
  SELECT l_suppkey || '-' || year(l_shipdate) || '-' || quarter(l_shipdate) AS adsh,
         p_type || '_' || l_linestatus AS tag,
         CAST(CASE WHEN l_linenumber = 7 THEN NULL
                   WHEN l_quantity = 50 THEN 0.0
                   WHEN l_returnflag = 'R' THEN -l_extendedprice
                   ELSE l_extendedprice END AS DOUBLE) AS value,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ddate,
         CAST(year(l_shipdate) AS INTEGER) AS dataset_year,
         CAST(quarter(l_shipdate) AS INTEGER) AS dataset_quarter
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

BRANDS = NUM.replace("num AS", "brands AS").replace("p_type || '_' || l_linestatus AS tag", "p_brand AS tag")

CUSTOMERS = """sub AS (
  SELECT o_custkey || '-' || y || '-' || q AS adsh, o_custkey AS cik,
         CASE WHEN q = 4 THEN '10-K' ELSE '10-Q' END AS form,
         CAST(CAST(last AS DATE) AS VARCHAR) AS filed, y AS dataset_year, q AS dataset_quarter
  FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
               max(o_orderdate) AS last FROM orders GROUP BY 1, 2, 3)),
num AS (
  SELECT o_custkey || '-' || year(o_orderdate) || '-' || quarter(o_orderdate) AS adsh,
         CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS DOUBLE) AS value,
         CAST(year(o_orderdate) AS INTEGER) AS dataset_year, CAST(quarter(o_orderdate) AS INTEGER) AS dataset_quarter
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

SUB = """sub AS (
  SELECT s || '-' || y || '-' || q AS adsh,
         s AS cik,
         s_name AS name,
         CASE WHEN (s + y + q) % 11 = 0 THEN '8-K' WHEN q = 4 THEN '10-K' ELSE '10-Q' END AS form,
         y AS fy,
         CASE WHEN q = 4 THEN 'FY' ELSE 'Q' || q END AS fp,
         CAST(y AS BIGINT) * 10000 + q * 300 + 30 AS period,
         CAST(last AS VARCHAR) AS filed,
         y AS dataset_year,
         q AS dataset_quarter
  FROM (SELECT l_suppkey AS s, CAST(year(l_shipdate) AS INTEGER) AS y,
               CAST(quarter(l_shipdate) AS INTEGER) AS q,
               CAST(max(l_shipdate) AS DATE) AS last
        FROM lineitem GROUP BY 1, 2, 3)
  JOIN supplier ON s = s_suppkey)"""

ID = "adsh, cik, name, form, fy, fp, period, filed, dataset_year, dataset_quarter"
FILINGS = "filings AS (SELECT * FROM sub WHERE form IN ('10-K', '10-Q'))"


def _texts(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _ratio(a: str, b: str) -> str:
    return f"nullif(CASE WHEN {b} = 0 THEN {a} * pow({b}, -1) ELSE {a} / {b} END, CAST('nan' AS DOUBLE))"


def _finite(c: str) -> str:
    return f"CASE WHEN isinf({c}) OR isnan({c}) THEN NULL ELSE {c} END"


def _pivot(tags: dict[str, list[str]], source: str = "num") -> str:
    made = ",\n         ".join(
        f"max(CASE WHEN tag IN ({_texts(t)}) THEN value END) AS {m}" for m, t in tags.items()
    )
    every = sorted({t for names in tags.values() for t in names})
    return (
        f"pivoted AS (\n  SELECT adsh, {made}\n  FROM {source} "
        f"WHERE tag IN ({_texts(every)}) GROUP BY adsh)"
    )


PIVOT = _pivot(TAGS)
JOINED = (
    "joined AS (SELECT f.*, "
    + ", ".join(f"p.{m}" for m in METRICS)
    + " FROM filings f LEFT JOIN pivoted p USING (adsh))"
)
P = (
    "p AS (SELECT *, "
    + ", ".join(f"{_ratio(a, b)} AS {n}" for n, (a, b) in RATIOS.items())
    + f", cfo + cfi AS fcf_approx, {_ratio('(cfo + cfi)', 'net_income')} AS fcf_to_net_income"
    + " FROM joined)"
)
PANEL = ",\n".join([NUM, SUB, FILINGS, PIVOT, JOINED, P])
WINDOW = (
    "WINDOW w AS (PARTITION BY cik ORDER BY period NULLS LAST, dataset_year, dataset_quarter, adsh)"
)


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes}\n{query}"


def _plain(doubles: list[str], others: str, source: str) -> str:
    """Infinite values as null, and which there were."""
    cells = ", ".join(f"{_finite(c)} AS {c}" for c in doubles)
    signs = ", ".join(f"CASE WHEN isinf({c}) THEN '{c}' || CASE WHEN {c} > 0 THEN '+' ELSE '-' END END" for c in doubles)
    return f"SELECT {others}{', ' if others else ''}{cells}, concat_ws(',', {signs}) AS infinite FROM {source}"


def _ranked(metrics: list[str]) -> str:
    """The 20 highest and lowest rows by each metric, the metrics below each other."""
    tops = [
        f"SELECT * FROM (SELECT '{m}' AS metric, '{direction}' AS direction, row_number() OVER (ORDER BY {m} {order}, adsh) AS rank, "
        f"adsh, cik, name, {m} AS value FROM p WHERE {m} IS NOT NULL) WHERE rank <= 20"
        for m in metrics
        for direction, order in (("high", "DESC"), ("low", "ASC"))
    ]
    return f"ranked AS ({' UNION ALL '.join(tops)})"


def _sum4(c: str) -> str:
    x = f"CASE WHEN isinf({c}) THEN NULL ELSE {c} END"
    parts = [f"lag({x}, {k}) OVER w" for k in (3, 2, 1)] + [x]
    added = "0.0::DOUBLE"
    for part in parts:
        added = f"({added} + coalesce({part}, 0.0))"
    return f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {added} END"


def _yoy(c: str) -> str:
    return f"{_ratio(c, f'prev_{c}')} - 1"


def _lagged(cols: list[str], name: str, source: str, rows: int = 4) -> str:
    lags = ", ".join(f"lag({c}, {rows}) OVER w AS prev_{c}" for c in cols)
    return f"{name} AS (SELECT *, {lags} FROM {source} {WINDOW})"


YOY_CTE = (
    _lagged(YOY_COLS, "lagged", "p")
    + ",\nyoy AS (SELECT adsh, cik, "
    + ", ".join(f"{_yoy(c)} AS {c}_yoy" for c in YOY_COLS)
    + " FROM lagged)"
)
TTM_CTE = (
    "sums AS (SELECT adsh, cik, period, dataset_year, dataset_quarter, "
    + ", ".join(f"{_sum4(c)} AS ttm_{c}" for c in TTM_COLS)
    + f" FROM p {WINDOW}),\nttm AS (SELECT *, {_ratio('ttm_net_income', 'ttm_revenue')} AS ttm_net_margin FROM sums)"
)
TTM_NAMES = [*[f"ttm_{c}" for c in TTM_COLS], "ttm_net_margin"]
TTM_YOY_CTE = (
    _lagged(TTM_YOY_COLS, "ttm_lagged", "ttm")
    + ",\nttm_yoy AS (SELECT adsh, cik, "
    + ", ".join(f"{_yoy(c)} AS {c}_yoy" for c in TTM_YOY_COLS)
    + " FROM ttm_lagged)"
)
DELTA_CTE = (
    _lagged(DELTA_COLS, "stepped", "p", 1)
    + ",\ndeltas AS (SELECT adsh, cik, "
    + ", ".join(f"nullif({c} - prev_{c}, CAST('nan' AS DOUBLE)) AS {c}_delta" for c in DELTA_COLS)
    + " FROM stepped)"
)
YOY_NAMES = [f"{c}_yoy" for c in YOY_COLS]
TTM_YOY_NAMES = [f"{c}_yoy" for c in TTM_YOY_COLS]
DELTA_NAMES = [f"{c}_delta" for c in DELTA_COLS]


def _merge() -> str:
    joins = "\n".join(
        f"LEFT JOIN (SELECT adsh, value AS {m} FROM brands WHERE tag = '{t}') AS t_{m} USING (adsh)"
        for m, t in MERGE_TAGS.items()
    )
    return (
        f"{BRANDS},\n{SUB},\n{FILINGS},\nmerged AS (SELECT cik, name, adsh, form, fy, fp, period, filed, "
        + ", ".join(MERGE_TAGS)
        + f" FROM filings\n{joins}),\nscreen AS (SELECT *, {_ratio('gross_profit', 'revenue')} AS gross_margin, "
        + f"{_ratio('operating_income', 'revenue')} AS operating_margin, "
        + f"{_ratio('net_income', 'revenue')} AS net_margin FROM merged)"
    )


MERGE_IDS = "cik, name, adsh, form, fy, fp, period, filed"
MERGE_NAMES = [*MERGE_TAGS, "gross_margin", "operating_margin", "net_margin"]


def _collapse() -> str:
    tags = {m: [TAGS[m][0]] for m in SCREENER_TAGS}
    margins = ", ".join(
        f"{_ratio(*RATIOS[m])} AS {m}" for m in ("gross_margin", "operating_margin", "net_margin")
    )
    metrics = ", ".join(SCREENER_TAGS)
    ctes = (
        f"{NUM},\n{SUB},\n{FILINGS},\n{_pivot(tags)},\nmerged AS (SELECT {MERGE_IDS}, {metrics} "
        f"FROM filings LEFT JOIN pivoted USING (adsh)),\nscreen AS (SELECT *, {margins} FROM merged),\n"
        f"kept AS (SELECT * FROM screen WHERE revenue >= {FLOOR} AND net_margin >= 0.2)"
    )
    names = [*SCREENER_TAGS, "gross_margin", "operating_margin", "net_margin"]
    return _with(ctes, _plain(names, MERGE_IDS, "kept"))


VALUE = (
    f"revenue >= {FLOOR} AND gross_margin >= 0.15 AND roe >= 0.10 AND fcf_approx >= 0"
)
LATEST_TEXT = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY cik ORDER BY CAST(fy AS VARCHAR) DESC NULLS FIRST, fp DESC NULLS FIRST,
    filed DESC NULLS FIRST, dataset_year DESC, dataset_quarter DESC, adsh DESC) AS rn FROM p) WHERE rn = 1)"""
LATEST_RANK = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY cik ORDER BY fy DESC NULLS FIRST,
    CASE fp WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 WHEN 'FY' THEN 5 ELSE 0 END DESC,
    dataset_year DESC, dataset_quarter DESC, adsh DESC) AS rn FROM p) WHERE rn = 1)"""

OBSERVED = """observed AS (SELECT * FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS dataset_year,
         CAST(quarter(o_orderdate) AS INTEGER) AS dataset_quarter,
         CASE o_orderpriority[1] WHEN '1' THEN 'sub' WHEN '2' THEN 'num' WHEN '3' THEN 'pre'
              WHEN '4' THEN 'tag' ELSE 'txt' END AS tab
  FROM orders)
  WHERE NOT ((tab = 'pre' AND dataset_quarter = 2) OR (tab = 'tag' AND dataset_year % 3 = 0))),
places AS (SELECT dataset_year, dataset_quarter,
  bool_or(tab = 'sub') AS s, bool_or(tab = 'num') AS n, bool_or(tab = 'pre') AS p, bool_or(tab = 'tag') AS t
  FROM observed GROUP BY ALL),
completeness AS (SELECT dataset_year, dataset_quarter, true AS "exists", s AND n AND p AND t AS complete,
  concat_ws(',', CASE WHEN NOT s THEN 'sub' END, CASE WHEN NOT n THEN 'num' END,
                 CASE WHEN NOT p THEN 'pre' END, CASE WHEN NOT t THEN 'tag' END) AS missing_files
  FROM places)"""

def _known(table: str, key: str) -> str:
    return f"""known AS (
  SELECT 'First' AS known, lpad(CAST(min({key}) AS VARCHAR), 10, '0') AS company FROM {table}
  UNION ALL SELECT 'Last', lpad(CAST(max({key}) AS VARCHAR), 10, '0') FROM {table}
  UNION ALL SELECT 'Nobody', '{NO_COMPANY}')"""


PRESENCE = """per_filing AS (SELECT adsh, count(*) AS n_facts, count(value) AS n_usable FROM num GROUP BY adsh),
presence AS (SELECT dataset_year, dataset_quarter, lpad(CAST(cik AS VARCHAR), 10, '0') AS company,
  sum(coalesce(n_facts, 0)) AS n_facts, sum(coalesce(n_usable, 0)) AS n_usable
  FROM sub LEFT JOIN per_filing USING (adsh) GROUP BY 1, 2, 3)"""


def _classes(table: str, key: str) -> str:
    return f"""{_known(table, key)},
periods AS (SELECT dataset_year, dataset_quarter FROM sub UNION SELECT dataset_year, dataset_quarter FROM num),
{PRESENCE},
classes AS (SELECT w.dataset_year, w.dataset_quarter, w.known, w.company,
  pr.company IS NOT NULL AS in_sub, coalesce(n_facts > 0, false) AS in_num, coalesce(n_usable > 0, false) AS usable
  FROM (SELECT * FROM periods, known) w LEFT JOIN presence pr USING (dataset_year, dataset_quarter, company)),
classified AS (SELECT *, CASE WHEN usable THEN 'usable_numeric_rows_present'
  WHEN in_num THEN 'present_in_num_but_not_usable' WHEN in_sub THEN 'absent_from_num'
  ELSE 'absent_from_sub' END AS classification FROM classes)"""


def _json(key: str, value: str, quote: bool = False) -> str:
    shown = f"'\"' || {value} || '\"'" if quote else value
    return f"'{{' || string_agg('\"' || {key} || '\":' || {shown}, ',' ORDER BY {key}) || '}}'"


QUARTER_AUDIT = f"""{_classes('supplier', 's_suppkey')},
subs AS (SELECT dataset_year, dataset_quarter, count(*) AS n, count(DISTINCT cik) AS companies FROM sub GROUP BY 1, 2),
nums AS (SELECT dataset_year, dataset_quarter, count(*) AS n FROM num GROUP BY 1, 2),
in_facts AS (SELECT dataset_year, dataset_quarter, count(*) AS companies FROM presence WHERE n_facts > 0 GROUP BY 1, 2),
forms AS (SELECT dataset_year, dataset_quarter, {_json('form', 'n')} AS j FROM
  (SELECT dataset_year, dataset_quarter, form, count(*) AS n FROM sub GROUP BY 1, 2, 3) GROUP BY 1, 2),
kn AS (SELECT dataset_year, dataset_quarter, {_json('known', 'in_sub')} AS j1, {_json('known', 'in_num')} AS j2,
  {_json('known', 'usable')} AS j3, {_json('known', 'classification', True)} AS j4 FROM classified GROUP BY 1, 2)"""

LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _lines() -> str:
    cases = []
    for label, pattern, groups in LINE_CATEGORIES:
        only = f" AND lang IN ({_texts(groups)})" if groups else ""
        cases.append(f"WHEN regexp_matches(raw, '{pattern}'){only} THEN '{label}'")
    return f"""WITH parts AS (SELECT doc_id, lang, regexp_split_to_array(text, '{LINE_END}') AS ls FROM documents),
lines AS (SELECT doc_id, lang, unnest(ls) AS raw, generate_subscripts(ls, 1) AS line FROM parts),
found AS (SELECT *, CASE {' '.join(cases)} END AS category FROM lines)
SELECT doc_id, CAST(line AS INTEGER) AS line, category,
  regexp_replace(raw, '^{BLANK}+|{BLANK}+$', '', 'g') AS snippet FROM found
WHERE category IS NOT NULL AND regexp_replace(raw, '^{BLANK}+|{BLANK}+$', '', 'g') <> ''"""


def _display(x: str) -> str:
    return (
        f"CASE WHEN abs({x}) < 1 THEN format('{{:.2f}}%', {x} * 100) "
        f"WHEN abs({x}) >= 1e9 THEN format('{{:.2f}}B', {x} / 1e9) "
        f"WHEN abs({x}) >= 1e6 THEN format('{{:.2f}}M', {x} / 1e6) "
        f"ELSE format('{{:,.0f}}', {x}) END"
    )


def _short(x: str) -> str:
    x = f"CAST({x} AS DOUBLE)"
    return (
        f"CASE WHEN abs({x}) >= 1e9 THEN format('{{:.1f}}B', {x} / 1e9) "
        f"WHEN abs({x}) >= 1e6 THEN format('{{:.1f}}M', {x} / 1e6) "
        f"WHEN abs({x}) >= 1e3 THEN format('{{:.1f}}k', {x} / 1e3) "
        f"ELSE format('{{:,.2f}}', {x}) END"
    )


def _number_profile(c: str) -> str:
    q = ", ".join(
        f"round(quantile_cont({c}, {p}), 4) AS {n}"
        for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return f"""SELECT '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS "count", CAST(NULL AS DOUBLE) AS "unique",
  CAST(NULL AS VARCHAR) AS top, CAST(NULL AS DOUBLE) AS freq, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, {q}, round(max({c}), 4) AS max
  FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM p)"""


def _text_profile(c: str) -> str:
    none = ", ".join(
        f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "p25", "p50", "p75", "max")
    )
    counted = f"(SELECT {c}, count(*) AS n FROM p WHERE {c} IS NOT NULL GROUP BY 1)"
    return f"""SELECT '{c}' AS "column", CAST(sum(n) AS DOUBLE) AS "count", CAST(count(*) AS DOUBLE) AS "unique",
  (SELECT {c} FROM {counted} ORDER BY n DESC, {c} LIMIT 1) AS top, CAST(max(n) AS DOUBLE) AS freq, {none} FROM {counted}"""


def _compare() -> str:
    metrics = ["revenue", "net_income", "gross_margin", "operating_margin",
               "net_margin", "roa", "roe", "fcf_approx"]
    first, last = ("(SELECT %s(s_suppkey) FROM supplier)" % f for f in ("min", "max"))
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, max(CASE WHEN cik = {first} THEN {m} END) AS first_company, "
        f"max(CASE WHEN cik = {last} THEN {m} END) AS second_company FROM latest"
        for m in metrics
    )
    ctes = f"{PANEL},\n{LATEST_RANK},\nrows_ AS ({rows})"
    return _with(ctes, _plain(["first_company", "second_company"], "metric", "rows_"))


def _bridge() -> str:
    return f"""WITH {PANEL},
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY revenue DESC NULLS LAST,
  dataset_year, dataset_quarter, adsh) AS rn FROM p) WHERE rn = 1),
levels AS (SELECT name, revenue, net_income, gross_margin IS NOT NULL AS g, operating_margin IS NOT NULL AS o,
  nullif(revenue * gross_margin, CAST('nan' AS DOUBLE)) AS gp,
  nullif(revenue * operating_margin, CAST('nan' AS DOUBLE)) AS op FROM one),
steps AS (
  SELECT name, 0 AS position, 'Revenue' AS step, revenue AS value, 'absolute' AS measure FROM levels
  UNION ALL SELECT name, 1, 'Gross Profit', gp - revenue, 'relative' FROM levels WHERE g
  UNION ALL SELECT name, 1 + CAST(g AS INTEGER), 'Operating Income',
    op - CASE WHEN g THEN gp ELSE revenue END, 'relative' FROM levels WHERE o
  UNION ALL SELECT name, 1 + CAST(g AS INTEGER) + CAST(o AS INTEGER), 'Net Income',
    net_income - CASE WHEN o THEN op WHEN g THEN gp ELSE revenue END, 'relative' FROM levels)
SELECT name, CAST(position AS INTEGER) AS position, step, value, measure FROM steps"""


def _counts(tables: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in tables)


NOT_SHIPPED = """(SELECT DISTINCT CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q FROM events
  WHERE (year(ts), quarter(ts)) NOT IN (SELECT (year(l_shipdate), quarter(l_shipdate)) FROM lineitem))"""


def oracle_sql() -> dict[str, str]:
    wide = [*METRICS, *RATIO_COLS]
    sheet_text = ["name", "cik", "fy", "fp"]
    sheet_numbers = [c for c in SHEET_COLS if c not in sheet_text]
    merge = _merge()
    return {
        "fundamentals": _with(PANEL, _plain(wide, ID, "p")),
        "scan_typed": _with(SUB, f"SELECT {ID} FROM sub"),
        "table_loader": _counts(BASE_TABLES),
        "period_list": _with(
            SUB,
            "SELECT DISTINCT dataset_year, dataset_quarter, dataset_year || '_' || dataset_quarter AS period_key FROM sub",
        ),
        "period_earliest": _with(
            SUB, "SELECT DISTINCT dataset_year, dataset_quarter FROM sub ORDER BY 1, 2 LIMIT 4"
        ),
        "period_key": _with(
            SUB,
            "SELECT adsh, dataset_year || '_' || dataset_quarter AS key, dataset_year || ' Q' || dataset_quarter AS label, "
            "dataset_year AS year, dataset_quarter AS quarter FROM sub",
        ),
        "row_count_snapshot": _counts(BASE_TABLES),
        "row_count_by_period": _with(
            f"{NUM},\n{SUB}",
            "SELECT 'sub' AS \"table\", dataset_year, dataset_quarter, count(*) AS n_rows FROM sub GROUP BY ALL "
            "UNION ALL SELECT 'num', dataset_year, dataset_quarter, count(*) FROM num GROUP BY ALL",
        ),
        "filter_forms": _with(f"{SUB},\n{FILINGS}", f"SELECT {ID} FROM filings"),
        "facts_semi_join": _with(
            f"{NUM},\n{SUB},\n{FILINGS}",
            "SELECT adsh, tag, value, ddate FROM num WHERE adsh IN (SELECT adsh FROM filings)",
        ),
        "lenient_numeric": """SELECT event_id, value AS amount,
  CASE WHEN event_type = 'error' THEN try_cast(props AS DOUBLE) ELSE value END AS mixed,
  try_cast(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k, try_cast(event_type AS DOUBLE) AS label FROM events""",
        "tag_pivot": _with(f"{NUM},\n{PIVOT}", f"SELECT adsh, {', '.join(METRICS)} FROM pivoted"),
        "filing_facts_left": _with(
            ",\n".join([NUM, SUB, FILINGS, PIVOT, JOINED]),
            f"SELECT adsh, cik, form, {', '.join(METRICS)} FROM joined",
        ),
        "ratios": _with(PANEL, _plain(RATIO_COLS, "adsh", "p")),
        "panel_build": _with(
            PANEL,
            "SELECT adsh, cik, dataset_year, dataset_quarter, dataset_year || ' Q' || dataset_quarter AS label, "
            f"{', '.join(METRICS)} FROM p",
        ),
        "panel_yoy": _with(f"{PANEL},\n{YOY_CTE}", _plain(YOY_NAMES, "adsh, cik", "yoy")),
        "panel_ttm": _with(f"{PANEL},\n{TTM_CTE}", _plain(TTM_NAMES, "adsh, cik", "ttm")),
        "panel_ttm_yoy": _with(
            f"{PANEL},\n{TTM_CTE},\n{TTM_YOY_CTE}", _plain(TTM_YOY_NAMES, "adsh, cik", "ttm_yoy")
        ),
        "panel_delta": _with(f"{PANEL},\n{DELTA_CTE}", _plain(DELTA_NAMES, "adsh, cik", "deltas")),
        "panel_full": _with(
            f"{PANEL},\n{YOY_CTE},\n{TTM_CTE},\n{TTM_YOY_CTE},\n{DELTA_CTE},\nfull_ AS (SELECT p.*, "
            + ", ".join(f"yoy.{n}" for n in YOY_NAMES) + ", "
            + ", ".join(f"ttm.{n}" for n in TTM_NAMES) + ", "
            + ", ".join(f"ttm_yoy.{n}" for n in TTM_YOY_NAMES) + ", "
            + ", ".join(f"deltas.{n}" for n in DELTA_NAMES)
            + " FROM p JOIN yoy USING (adsh) JOIN ttm USING (adsh) JOIN ttm_yoy USING (adsh) JOIN deltas USING (adsh))",
            _plain([*wide, *YOY_NAMES, *TTM_NAMES, *TTM_YOY_NAMES, *DELTA_NAMES], ID, "full_"),
        ),
        "company_ttm": _with(
            PANEL,
            f"SELECT dataset_year || ' Q' || dataset_quarter AS period, {_sum4('revenue')} AS ttm_revenue FROM p "
            "WHERE cik = (SELECT min(s_suppkey) FROM supplier) "
            "WINDOW w AS (PARTITION BY cik ORDER BY dataset_year, dataset_quarter, adsh)",
        ),
        "simple_screener": _with(
            f"{merge},\nkept AS (SELECT * FROM screen WHERE revenue >= {FLOOR})",
            _plain(MERGE_NAMES, MERGE_IDS, "kept"),
        ),
        "screener_merge": _with(merge, _plain(MERGE_NAMES, MERGE_IDS, "screen")),
        "screener_collapse": _collapse(),
        "screen_revenue": _with(PANEL, "SELECT adsh, name, revenue FROM p WHERE revenue >= 0"),
        "value_screen_all": _with(
            f"{PANEL},\nkept AS (SELECT * FROM p WHERE {VALUE})",
            _plain(["revenue", "gross_margin", "roe", "fcf_approx"], "adsh", "kept"),
        ),
        "value_screen_latest": _with(
            f"{PANEL},\n{LATEST_TEXT},\nkept AS (SELECT * FROM latest WHERE {VALUE} AND debt_to_equity < 2.0)",
            _plain(
                ["revenue", "gross_margin", "roe", "debt_to_equity", "fcf_approx"], "adsh, name, fy, fp", "kept"
            ),
        ),
        "latest_by_text": _with(f"{PANEL},\n{LATEST_TEXT}", "SELECT cik, adsh, fy, fp, revenue FROM latest"),
        "latest_by_rank": _with(f"{PANEL},\n{LATEST_RANK}", "SELECT cik, adsh, fy, fp, revenue FROM latest"),
        "top_revenue": _with(
            PANEL, "SELECT adsh, name, revenue FROM p ORDER BY revenue DESC NULLS LAST, adsh LIMIT 500"
        ),
        "rank_metric": _with(
            f"{PANEL},\ntop AS (SELECT * FROM p WHERE roe IS NOT NULL ORDER BY roe DESC, adsh LIMIT 20)",
            _plain(["roe", "revenue", "net_income", "fcf_approx"], "adsh, name", "top"),
        ),
        "rank_metric_low": _with(
            f"{PANEL},\ntop AS (SELECT * FROM p WHERE net_margin IS NOT NULL ORDER BY net_margin, adsh LIMIT 15)",
            _plain(["net_margin", "revenue"], "adsh, name", "top"),
        ),
        "rank_all_metrics": _with(f"{PANEL},\n{_ranked([*METRICS, *RATIO_COLS])}", _plain(["value"], "metric, direction, rank, adsh, cik, name", "ranked")),
        "excel_subset": _with(
            f"{PANEL},\ntop AS (SELECT * FROM p ORDER BY revenue DESC NULLS LAST, adsh LIMIT 10)",
            _plain(sheet_numbers, ", ".join(sheet_text), "top"),
        ),
        "compare_companies": _compare(),
        "absent_filings": _with(
            CUSTOMERS,
            "SELECT adsh, cik, form, filed, dataset_year, dataset_quarter FROM sub WHERE adsh NOT IN (SELECT adsh FROM num)",
        ),
        "coverage_classify": _with(
            f"{CUSTOMERS},\n{_classes('customer', 'c_custkey')}",
            "SELECT dataset_year, dataset_quarter, known, company, in_sub, in_num, usable, classification FROM classified",
        ),
        "distinct_companies": _with(SUB, "SELECT DISTINCT name FROM sub"),
        "form_counts": _with(
            SUB,
            "SELECT dataset_year, dataset_quarter, CASE WHEN form = '8-K' THEN '<null>' ELSE form END AS form, "
            "count(*) AS n FROM sub GROUP BY ALL",
        ),
        "companies_min_filings": _with(
            f"{SUB},\n{FILINGS}", "SELECT cik, count(*) AS n FROM filings GROUP BY cik HAVING count(*) >= 26"
        ),
        "audit_cik_counts": _with(
            f"{CUSTOMERS},\n{PRESENCE}",
            "SELECT dataset_year, dataset_quarter, count(*) AS distinct_cik_count_in_sub, "
            "count(*) FILTER (WHERE n_facts > 0) AS distinct_cik_count_in_num FROM presence GROUP BY 1, 2",
        ),
        "quarter_audit": _with(
            f"{NUM},\n{SUB},\n{QUARTER_AUDIT}",
            "SELECT s.dataset_year || '_' || s.dataset_quarter AS quarter, true AS sub_exists, true AS num_exists, "
            "s.n AS sub_row_count, m.n AS num_row_count, s.companies AS distinct_cik_count_in_sub, "
            "i.companies AS distinct_cik_count_in_num, f.j AS form_counts_json, kn.j1 AS known_presence_in_sub_json, "
            "kn.j2 AS known_presence_in_num_json, kn.j3 AS known_presence_usable_json, kn.j4 AS known_classification_json "
            "FROM subs s JOIN nums m USING (dataset_year, dataset_quarter) JOIN in_facts i USING (dataset_year, dataset_quarter) "
            "JOIN forms f USING (dataset_year, dataset_quarter) JOIN kn USING (dataset_year, dataset_quarter)",
        ),
        "normalize_id": """WITH shaped AS (SELECT c_custkey, CASE c_custkey % 5
    WHEN 0 THEN c_custkey || '.0' WHEN 1 THEN 'CIK' || c_custkey WHEN 2 THEN '10000000000' || c_custkey
    WHEN 3 THEN 'no id ' || c_mktsegment ELSE CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey AS VARCHAR) END END AS raw
  FROM customer),
digits AS (SELECT *, regexp_extract(regexp_replace(raw, '\\.0$', ''), '([0-9]+)', 1) AS d FROM shaped)
SELECT c_custkey, raw, CASE WHEN length(d) >= 10 THEN d WHEN length(d) > 0 THEN lpad(d, 10, '0') END AS id FROM digits""",
        "sub_integrity": _with(
            f"""{SUB},
holes AS (SELECT dataset_year, dataset_quarter,
  CASE WHEN form = '8-K' AND fy % 2 = 0 THEN NULL ELSE cik END AS cik,
  CASE WHEN dataset_quarter = 3 THEN NULL ELSE name END AS name FROM sub),
counts AS (SELECT dataset_year, dataset_quarter, count(*) FILTER (WHERE cik IS NULL) AS a,
  count(*) FILTER (WHERE name IS NULL) AS b FROM holes GROUP BY 1, 2),
dups AS (SELECT dataset_year, dataset_quarter, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS d FROM
  (SELECT dataset_year, dataset_quarter, cik, count(*) AS n FROM holes GROUP BY 1, 2, 3) GROUP BY 1, 2)""",
            "SELECT dataset_year, dataset_quarter, CASE WHEN a > 0 OR b > 0 THEN 'ISSUES' ELSE 'OK' END AS status, "
            "concat_ws(',', CASE WHEN a > 0 THEN 'null_cik' END, CASE WHEN b > 0 THEN 'null_name' END) AS issues, "
            "CASE WHEN d > 0 THEN 'duplicate_cik (' || CAST(d AS BIGINT) || ')' ELSE '' END AS warnings "
            "FROM counts JOIN dups USING (dataset_year, dataset_quarter) "
            f"UNION ALL SELECT y, q, 'NOT_FOUND', '', '' FROM {NOT_SHIPPED}",
        ),
        "num_integrity": _with(
            NUM,
            "SELECT dataset_year, dataset_quarter, 'OK' AS status, '' AS issues, "
            "count(*) FILTER (WHERE value IS NULL) AS null_value_count, "
            "count(*) FILTER (WHERE ddate IS NULL) AS null_ddate_count FROM num GROUP BY 1, 2 "
            f"UNION ALL SELECT y, q, 'NOT_FOUND', '', NULL, NULL FROM {NOT_SHIPPED}",
        ),
        "validate_panel": _with(
            f"{PANEL},\nc AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE revenue < 0) AS neg FROM p)",
            "SELECT CASE WHEN neg > 0 THEN 'ISSUES' ELSE 'OK' END AS status, "
            f"CASE WHEN neg > 0 THEN '{NEGATIVE_REVENUE}' ELSE '' END AS errors, n_rows FROM c",
        ),
        "period_completeness": _with(
            OBSERVED, 'SELECT dataset_year, dataset_quarter, "exists", complete, missing_files FROM completeness'
        ),
        "check_report": _with(
            f"{OBSERVED},\n{NUM},\n{SUB}",
            """SELECT 'periods' AS "check", dataset_year || '_' || dataset_quarter AS period,
  CASE WHEN complete THEN 'OK' ELSE 'ISSUES' END AS status, missing_files AS issues, '' AS meta FROM completeness
UNION ALL SELECT 'sub', dataset_year || '_' || dataset_quarter, 'OK', '', 'warnings=' FROM sub GROUP BY ALL
UNION ALL SELECT 'num', dataset_year || '_' || dataset_quarter, 'OK', '',
  'null_ddate_count=' || count(*) FILTER (WHERE ddate IS NULL) || ';null_value_count=' || count(*) FILTER (WHERE value IS NULL)
  FROM num GROUP BY dataset_year, dataset_quarter
UNION ALL SELECT 'rows_sub', dataset_year || '_' || dataset_quarter, 'OK', '', 'n_rows=' || count(*) FROM sub GROUP BY dataset_year, dataset_quarter
UNION ALL SELECT 'rows_num', dataset_year || '_' || dataset_quarter, 'OK', '', 'n_rows=' || count(*) FROM num GROUP BY dataset_year, dataset_quarter""",
        ),
        "profile_columns": _with(
            PANEL.replace("p AS (", "raw AS (").replace("FROM p ", "FROM raw ")
            + ",\np AS (" + _plain(wide, ID, "raw") + ")",
            "\nUNION ALL ".join(
                [_text_profile(c) for c in ("adsh", "name", "form", "fp", "filed", "infinite")]
                + [_number_profile(c) for c in ("cik", "fy", "period", "dataset_year", "dataset_quarter", *wide)]
            ),
        ),
        "histogram_2d": _with(
            f"{PANEL},\nxy AS (SELECT roe AS x, roa AS y FROM p WHERE isfinite(roe) AND isfinite(roa)),\n"
            "b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM xy)",
            "SELECT CAST(CASE WHEN x1 > x0 THEN least(floor((x - x0) * 30 / (x1 - x0)) + 1, 30) ELSE 1 END AS INTEGER) AS x_bin, "
            "CAST(CASE WHEN y1 > y0 THEN least(floor((y - y0) * 30 / (y1 - y0)) + 1, 30) ELSE 1 END AS INTEGER) AS y_bin, "
            "count(*) AS n FROM xy, b GROUP BY 1, 2",
        ),
        "union_by_name": _with(
            SUB,
            "SELECT adsh, cik, CAST(fy AS VARCHAR) AS fy, filed, CAST(NULL AS VARCHAR) AS form FROM sub WHERE form IN ('10-K', '10-Q') "
            "UNION ALL SELECT adsh, cik, 'FY' || fy, NULL, form FROM sub WHERE form = '8-K'",
        ),
        "union_distinct": _with(
            SUB,
            "SELECT cik, form, fy, fp FROM sub UNION SELECT cik, form, fy, fp FROM sub WHERE form IN ('10-K', '8-K') "
            "UNION SELECT cik, form, fy, NULL FROM sub",
        ),
        "month_rollup": """SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(year(o_orderdate) AS INTEGER) AS dataset_year, CAST(quarter(o_orderdate) AS INTEGER) AS dataset_quarter FROM orders""",
        "month_quarter": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
  CAST(year(o_orderdate + INTERVAL 1 MONTH) AS INTEGER) AS next_year,
  CAST(month(o_orderdate + INTERVAL 1 MONTH) AS INTEGER) AS next_month,
  CAST(year(o_orderdate - INTERVAL 1 MONTH) AS INTEGER) AS back_year,
  CAST(month(o_orderdate - INTERVAL 1 MONTH) AS INTEGER) AS back_month FROM orders""",
        "incremental_month": """WITH seen AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m,
  o_orderpriority[1] AS t FROM orders),
line AS (SELECT (SELECT min(m) FROM seen) AS last,
  (SELECT count(DISTINCT t) FROM seen WHERE t IN ('1', '2', '3', '4') AND m = (SELECT min(m) + 1 FROM seen)) = 4 AS complete)
SELECT CAST((last + 1) // 12 AS INTEGER) AS year, CAST((last + 1) % 12 + 1 AS INTEGER) AS month, complete,
  CAST((last + complete::INT) // 12 AS INTEGER) AS state_year, CAST((last + complete::INT) % 12 + 1 AS INTEGER) AS state_month
FROM line""",
        "fundamentals_lenient": _with(
            f"{PANEL},\nq AS (SELECT *, CASE WHEN fy % 2 = 0 THEN CAST(period || '.5' AS DOUBLE) END AS pubfloatusd FROM p)",
            _plain(["pubfloatusd", *wide], "adsh, cik, CAST(fy AS VARCHAR) AS fy", "q"),
        ),
        "panel_sorted": _with(
            PANEL, f"SELECT adsh, cik, dataset_year, dataset_quarter, {', '.join(METRICS)} FROM p ORDER BY cik, period, adsh"
        ),
        "company_by_name": _with(
            PANEL, f"SELECT {ID}, {', '.join(METRICS)} FROM p WHERE name = (SELECT max(s_name) FROM supplier)"
        ),
        "sheet_of_periods": _with(
            f"{PANEL},\nends AS (SELECT min(fy) AS y FROM sub),\npaired AS (SELECT p.* FROM p, ends "
            "WHERE (fy = y AND dataset_quarter = 3) OR (fy = y + 1 AND dataset_quarter = 1))",
            _plain(sheet_numbers, ", ".join(sheet_text), "paired"),
        ),
        "format_display": f"""SELECT c_custkey, {_display('(c_acctbal / 16384)')} AS ratio, {_display('c_acctbal')} AS plain,
  {_display('(c_acctbal * 4097)')} AS millions, {_display('(c_acctbal * 2097169)')} AS billions FROM customer""",
        "format_columns": f"""SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment, {_short('c_acctbal')} AS plain,
  {_short('c_acctbal * 4097')} AS millions, {_short('c_acctbal * 2097169')} AS billions,
  {_short('c_nationkey')} AS c_nationkey FROM customer""",
        "pl_bridge": _bridge(),
        "line_findings": _lines(),
    }
