"""Aggregation specifications of the loan domain."""

# Recode dictionaries of the application table.
APPLICATION_CODES = {
    "CODE_GENDER": {"M": 0, "F": 1, "XNA": -1},
    "FLAG_OWN_CAR": {"N": 0, "Y": 1},
    "FLAG_OWN_REALTY": {"N": 1, "Y": 0},
    "EMERGENCYSTATE_MODE": {"No": 0, "Yes": 1},
}

# Extra null tokens of the application file and the missing-date sentinel.
NULL_TOKENS = ("XNA", "Unknown")
MISSING_DAYS = 365243

# Ratio features of the application table, name -> (numerator, denominator).
APPLICATION_RATIOS = {
    "CREDIT_TO_ANNUITY_RATIO": ("AMT_CREDIT", "AMT_ANNUITY"),
    "CREDIT_TO_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "ANNUITY_TO_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "CREDIT_TO_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "INCOME_TO_BIRTH_RATIO": ("AMT_INCOME_TOTAL", "DAYS_BIRTH"),
}

# Monthly status of a bureau credit.
BALANCE_MEASURES = {"MONTHS_BALANCE": ["min", "max", "size"]}

# Bureau credits per client.
BUREAU_MEASURES = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
BUREAU_SUBSETS = {"ACTIVE_": ("CREDIT_ACTIVE", "Active"), "CLOSED_": ("CREDIT_ACTIVE", "Closed")}

# Previous applications per client.
PREVIOUS_MEASURES = {
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
}
PREVIOUS_SENTINELS = [
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
]
PREVIOUS_SUBSETS = {
    "APPROVED_": ("NAME_CONTRACT_STATUS", "Approved"),
    "REFUSED_": ("NAME_CONTRACT_STATUS", "Refused"),
}

# Point-of-sale balances per client.
POS_MEASURES = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}

# Instalments per client.
INSTALMENT_MEASURES = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
}

# Card balances per client, for every numeric column and every category.
CARD_NUMERIC_FUNCS = ["min", "max", "mean", "sum", "var"]
CARD_CATEGORY_FUNCS = ["mean", "sum", "var"]
