"""SQL text of the loan-domain views and of the roll-ups, written apart from the Spark code."""

from __future__ import annotations

import re

REF = "DATE '2001-12-31'"


def _application(table: str, p: str, segment: str, target: str) -> str:
    key, bal, nation = f"{p}_{'custkey' if p == 'c' else 'suppkey'}", f"{p}_acctbal", f"{p}_nationkey"
    return f"""
SELECT {key} AS SK_ID_CURR, {target}
  CASE WHEN {key} % 50 = 7 THEN 'XNA' WHEN {key} % 3 = 0 THEN 'M' ELSE 'F' END AS CODE_GENDER,
  CASE WHEN {key} % 2 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
  CASE WHEN {key} % 5 < 3 THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
  CASE WHEN {key} % 4 = 1 THEN 'Yes' WHEN {key} % 4 > 1 THEN 'No' END AS EMERGENCYSTATE_MODE,
  CAST(CASE WHEN {key} % 11 = 0 THEN 365243 ELSE -({key} % 9000) END AS INTEGER) AS DAYS_EMPLOYED,
  CAST(-7000 - {key} % 18000 AS INTEGER) AS DAYS_BIRTH,
  CAST(-({key} % 400) AS INTEGER) AS DAYS_LAST_PHONE_CHANGE,
  CAST(floor({bal}) * 20 + 250000 AS DOUBLE) AS AMT_CREDIT,
  nullif(CAST({nation} AS DOUBLE) * 1000, 3000) AS AMT_ANNUITY,
  CAST(floor({bal}) * 18 + 200000 AS DOUBLE) AS AMT_GOODS_PRICE,
  CAST({nation} % 7 AS DOUBLE) * 15000 AS AMT_INCOME_TOTAL,
  {segment} AS NAME_INCOME_TYPE
FROM {table}"""


VIEWS = {
    "app": _application("customer", "c", "CASE WHEN c_custkey % 13 = 5 THEN 'Unknown' ELSE c_mktsegment END",
                        "CAST(c_acctbal < 0 AS INTEGER) AS TARGET,"),
    "new_app": _application("supplier", "s", "CASE WHEN s_suppkey % 3 = 0 THEN 'BUILDING' ELSE 'STARTUP' END", ""),
    "coded": """
SELECT * REPLACE (
  CASE CODE_GENDER WHEN 'M' THEN 0 WHEN 'F' THEN 1 END AS CODE_GENDER,
  CASE FLAG_OWN_CAR WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS FLAG_OWN_CAR,
  CASE FLAG_OWN_REALTY WHEN 'N' THEN 1 WHEN 'Y' THEN 0 END AS FLAG_OWN_REALTY,
  CASE EMERGENCYSTATE_MODE WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS EMERGENCYSTATE_MODE,
  CAST(nullif(DAYS_EMPLOYED, 365243) AS DOUBLE) AS DAYS_EMPLOYED,
  nullif(NAME_INCOME_TYPE, 'Unknown') AS NAME_INCOME_TYPE)
FROM app""",
    "rated": """
SELECT *, AMT_CREDIT / nullif(AMT_ANNUITY, 0) AS CREDIT_TO_ANNUITY_RATIO,
  AMT_CREDIT / nullif(AMT_GOODS_PRICE, 0) AS CREDIT_TO_GOODS_RATIO,
  AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0) AS ANNUITY_TO_INCOME_RATIO,
  AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS CREDIT_TO_INCOME_RATIO,
  AMT_INCOME_TOTAL / nullif(DAYS_BIRTH, 0) AS INCOME_TO_BIRTH_RATIO
FROM coded""",
    "bureau": f"""
SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
  CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Sold' END AS CREDIT_ACTIVE,
  CASE WHEN o_orderkey % 9 <> 4 THEN o_orderpriority END AS CREDIT_TYPE,
  d AS DAYS_CREDIT, CAST(CASE WHEN o_orderstatus <> 'P' THEN d + 730 END AS DOUBLE) AS DAYS_CREDIT_ENDDATE,
  d + 30 AS DAYS_CREDIT_UPDATE,
  CASE WHEN o_orderkey % 20 = 3 THEN CAST(o_orderkey % 90 AS INTEGER) ELSE 0 END AS CREDIT_DAY_OVERDUE,
  CASE WHEN o_orderkey % 4 = 0 THEN floor(p / 100) END AS AMT_CREDIT_MAX_OVERDUE,
  p AS AMT_CREDIT_SUM,
  CASE o_orderstatus WHEN 'O' THEN floor(p / 2) WHEN 'F' THEN CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_DEBT,
  CASE WHEN o_orderkey % 20 = 3 THEN floor(p / 50) ELSE CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE,
  CASE WHEN o_orderkey % 3 = 1 THEN floor(p / 4) END AS AMT_CREDIT_SUM_LIMIT,
  CASE WHEN o_orderkey % 7 <> 2 THEN floor(p / 12) END AS AMT_ANNUITY,
  CAST(o_orderkey % 3 AS INTEGER) AS CNT_CREDIT_PROLONG
FROM (SELECT *, floor(o_totalprice) AS p, CAST(date_diff('day', {REF}, CAST(o_orderdate AS DATE)) AS INTEGER) AS d FROM orders)""",
    "balance": "SELECT l_orderkey AS SK_ID_BUREAU, -l_linenumber AS MONTHS_BALANCE, l_returnflag AS STATUS FROM lineitem",
    "prev": f"""
SELECT *, AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS APP_CREDIT_PERC FROM (
SELECT o_custkey AS SK_ID_CURR, o_orderkey AS k,
  CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'P' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  o_orderpriority AS NAME_CONTRACT_TYPE, p AS AMT_APPLICATION, floor(p * (o_orderkey % 5) / 4) AS AMT_CREDIT,
  CASE WHEN o_orderstatus <> 'P' THEN floor(p / 24) END AS AMT_ANNUITY,
  CASE WHEN o_orderkey % 2 = 0 THEN floor(p / 10) END AS AMT_DOWN_PAYMENT,
  CASE WHEN o_orderkey % 6 <> 1 THEN p + 500 END AS AMT_GOODS_PRICE,
  CAST(o_orderkey % 24 AS INTEGER) AS HOUR_APPR_PROCESS_START,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 8 AS DOUBLE) / 16 END AS RATE_DOWN_PAYMENT,
  d AS DAYS_DECISION, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 10 * 6 AS DOUBLE) END AS CNT_PAYMENT,
  CAST(CASE WHEN o_orderkey % 3 <> 0 THEN d END AS DOUBLE) AS DAYS_FIRST_DRAWING,
  CAST(CASE WHEN o_orderkey % 5 <> 0 THEN d + 30 END AS DOUBLE) AS DAYS_FIRST_DUE,
  CAST(CASE WHEN o_orderkey % 7 <> 0 THEN d + 365 END AS DOUBLE) AS DAYS_LAST_DUE_1ST_VERSION,
  CAST(CASE WHEN o_orderkey % 4 <> 0 THEN d + 400 END AS DOUBLE) AS DAYS_LAST_DUE,
  CAST(CASE WHEN o_orderkey % 6 <> 0 THEN d + 410 END AS DOUBLE) AS DAYS_TERMINATION
FROM (SELECT *, floor(o_totalprice) AS p, CAST(date_diff('day', {REF}, CAST(o_orderdate AS DATE)) AS INTEGER) AS d FROM orders))""",
    "pos": """
SELECT user_id AS SK_ID_CURR, CAST(-(event_id % 96) AS INTEGER) AS MONTHS_BALANCE,
  CAST(CASE WHEN floor(value) > 60 THEN floor(value) - 60 ELSE 0 END AS INTEGER) AS SK_DPD,
  CAST(CASE WHEN floor(value) > 150 THEN floor(value) - 150 ELSE 0 END AS INTEGER) AS SK_DPD_DEF,
  CASE WHEN event_id % 17 <> 3 THEN event_type END AS NAME_CONTRACT_STATUS
FROM events""",
    "instal": f"""
SELECT *, AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
  CASE WHEN paid - due < 0 THEN 0 ELSE paid - due END AS DPD, CASE WHEN due - paid < 0 THEN 0 ELSE due - paid END AS DBD,
  paid AS DAYS_ENTRY_PAYMENT
FROM (SELECT o_custkey AS SK_ID_CURR, CAST(l_linenumber % 4 AS DOUBLE) AS NUM_INSTALMENT_VERSION,
  CASE WHEN l_linenumber = 7 THEN CAST(0 AS DOUBLE) ELSE floor(l_extendedprice) END AS AMT_INSTALMENT,
  floor(l_extendedprice * (1 - l_discount)) AS AMT_PAYMENT,
  CAST(date_diff('day', {REF}, CAST(o_orderdate AS DATE)) + 60 AS DOUBLE) AS due,
  CAST(date_diff('day', {REF}, CAST(l_shipdate AS DATE)) AS DOUBLE) AS paid
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "card": """
SELECT user_id AS SK_ID_CURR, CAST(-(event_id % 60) AS INTEGER) AS MONTHS_BALANCE, floor(value) * 10 AS AMT_BALANCE,
  CASE WHEN event_type = 'purchase' THEN floor(value) END AS AMT_PAYMENT_CURRENT,
  CASE WHEN event_type <> 'view' THEN floor(value) % 5 END AS CNT_DRAWINGS_CURRENT, event_type AS NAME_CONTRACT_STATUS
FROM events""",
    "scored": """
SELECT c_custkey AS SK_ID_CURR, CAST(c_acctbal < 0 AS INTEGER) AS TARGET,
  round(CAST(0.7 AS DOUBLE) / (1 + exp(c_acctbal / 2000)) + CAST(0.3 AS DOUBLE) *
    (CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '-42'), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)), 6) AS PROBA,
  c_acctbal AS BALANCE, c_nationkey AS NATION, c_mktsegment AS SEGMENT
FROM customer""",
    "folded": """
SELECT *, CAST((row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR) - 1) % 5 AS INTEGER) AS fold
FROM scored""",
}

_NEEDS = {"coded": ["app"], "rated": ["app", "coded"], "folded": ["scored"]}


def using(names: str, body: str, **extra: str) -> str:
    """A query over named views; `extra` adds views of its own, in order."""
    parts: list[str] = []
    for n in names.split():
        parts += [v for v in [*_NEEDS.get(n, []), n] if v not in parts]
    ctes = [f"{n} AS ({VIEWS[n]})" for n in parts] + [f"{n} AS ({t})" for n, t in extra.items()]
    return f"WITH {', '.join(ctes)} {body}"


# Sorted categories of the test tables; NULL last.
CATEGORIES = {
    "app": {"NAME_INCOME_TYPE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", None]},
    "bureau": {"CREDIT_ACTIVE": ["Active", "Closed", "Sold", None],
               "CREDIT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None]},
    "balance": {"STATUS": ["A", "N", "R", None]},
    "prev": {"NAME_CONTRACT_STATUS": ["Approved", "Canceled", "Refused", None],
             "NAME_CONTRACT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None]},
    "pos": {"NAME_CONTRACT_STATUS": ["click", "error", "purchase", "signup", "view", None]},
    "card": {"NAME_CONTRACT_STATUS": ["click", "error", "purchase", "signup", "view", None]},
}
_WHOLE = {"CNT_CREDIT_PROLONG", "MONTHS_BALANCE_SIZE", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"}
_SQL = {"min": "min({})", "max": "max({})", "mean": "avg({})", "sum": "sum({})", "var": "var_samp({})", "nunique": "count(DISTINCT {})"}


def flag(column: str, value: str | None) -> str:
    test = f"{column} IS NULL" if value is None else f"{column} = '{value}'"
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def measures(prefix: str, spec: dict, where: str | None = None, digits: int | None = 6) -> list[str]:
    """Aggregate expressions of numeric columns."""
    out = []
    for c, funcs in spec.items():
        for f in funcs:
            name = f"{prefix}{c}_{f.upper()}"
            tail = f" FILTER (WHERE {where})" if where else ""
            if f == "size":
                text = f"count(*){tail}" if not where else f"nullif(count(*){tail}, 0)"
            else:
                text = _SQL[f].format(c) + tail
                if f == "sum" and c in _WHOLE:
                    text = f"CAST({text} AS BIGINT)"
                elif f == "var":
                    text = f"CAST(CAST(round({text}, 9) AS FLOAT) AS DOUBLE)"
                elif f in ("mean", "sum") or c.endswith("_PERC"):
                    text = f"round({text}, {digits})" if digits is not None and f != "nunique" else text
            out.append(f'{text} AS "{name}"')
    return out


def shares(prefix: str, categories: dict, funcs=("mean",), clean: bool = False, digits: int | None = 6) -> list[str]:
    """Aggregate expressions of category indicators."""
    out = []
    for c, values in categories.items():
        for v in values:
            name = f"{c}_{'nan' if v is None else v}"
            name = re.sub("[^A-Za-z0-9_]+", "", name) if clean else name
            for f in funcs:
                text = _SQL[f].format(flag(c, v))
                if f == "sum":
                    text = f"CAST({text} AS BIGINT)"
                elif f == "var":
                    text = f"CAST(CAST(round({text}, 9) AS FLOAT) AS DOUBLE)"
                elif digits is not None:
                    text = f"round({text}, {digits})"
                out.append(f'{text} AS "{prefix}{name}_{f.upper()}"')
    return out


def grouped(key: str, source: str, columns: list[str]) -> str:
    return f"SELECT {key}, {', '.join(columns)} FROM {source} GROUP BY {key}"
