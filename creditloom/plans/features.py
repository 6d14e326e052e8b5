"""One feature row per loan application.

Every satellite is aggregated to SK_ID_CURR before it meets the application table, so each join is
one-to-one on the same key: one exchange per satellite for its roll-up, one for the applications,
none added by the joins.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.columns import clip_lower, ratio, recode, sentinel_to_null, tokens_to_null
from creditloom.functions.naming import clean_names
from creditloom.operators.cleaning import infinities_to_null
from creditloom.operators.encoding import category_dictionaries, category_dictionary, one_hot
from creditloom.operators.rollup import Rollup, columns_of, dummy_name, is_category, numeric_columns, rollup
from creditloom.plans import specs
from creditloom.session import small_side

KEY = "SK_ID_CURR"


@dataclass(frozen=True)
class LoanTables:
    """The seven relational inputs."""

    application: DataFrame
    bureau: DataFrame
    bureau_balance: DataFrame
    previous_application: DataFrame
    pos_cash: DataFrame
    instalments: DataFrame
    card_balance: DataFrame


Dictionary = Mapping[str, list]


@dataclass
class Categories:
    """Category dictionary per table. Keep the one of training to build features for new loans."""

    tables: dict[str, Dictionary] = field(default_factory=dict)

    def of(self, name: str, df: DataFrame) -> Dictionary:
        if name not in self.tables:
            self.learn({name: df})
        return self.tables[name]

    def learn(self, frames: Mapping[str, DataFrame]) -> None:
        """Dictionaries of several tables from one job; known ones are left alone."""
        self.tables.update(category_dictionaries({n: df for n, df in frames.items() if n not in self.tables}))


def recode_application(df: DataFrame, null_markers: bool = False) -> DataFrame:
    """Null tokens, fixed codes, sentinel days. `null_markers` also nulls -1 codes and a zero
    last-phone-change day."""
    out = df.select(*[
        tokens_to_null(F.col(c), specs.NULL_TOKENS).alias(c) if c in columns_of(df, "string") else F.col(c)
        for c in df.columns
    ])
    codes = {c: recode(F.col(c), m) for c, m in specs.APPLICATION_CODES.items() if c in df.columns}
    if null_markers:
        for c in ("CODE_GENDER", "EMERGENCYSTATE_MODE"):
            if c in codes:
                codes[c] = F.nullif(codes[c], F.lit(-1))
        if "DAYS_LAST_PHONE_CHANGE" in df.columns:
            codes["DAYS_LAST_PHONE_CHANGE"] = F.nullif(F.col("DAYS_LAST_PHONE_CHANGE"), F.lit(0))
    codes["DAYS_EMPLOYED"] = sentinel_to_null(F.col("DAYS_EMPLOYED").cast("double"), specs.MISSING_DAYS)
    return out.withColumns(codes)


def application_features(df: DataFrame, categories: Dictionary | None = None, drop_first: bool = True,
                         strict_inf: bool = False) -> DataFrame:
    """Recodes, ratios and one-hot columns of the application table."""
    coded = recode_application(df).withColumns({
        name: ratio(F.col(num), F.col(den), strict_inf) for name, (num, den) in specs.APPLICATION_RATIOS.items()
    })
    dictionary = categories if categories is not None else category_dictionary(coded)
    return one_hot(coded, dictionary, drop_first=drop_first)[0]


def _credit_keys(balance: DataFrame) -> list[str]:
    """Balances that know their client (`sources.layout`) group and join by both, which keeps a partitioning by client."""
    return [*([KEY] if KEY in balance.columns else []), "SK_ID_BUREAU"]


def balance_rollup(balance: DataFrame, categories: Dictionary | None = None) -> DataFrame:
    """Monthly statuses per bureau credit."""
    dictionary = categories if categories is not None else category_dictionary(balance)
    return rollup(balance, _credit_keys(balance), Rollup("", specs.BALANCE_MEASURES, dictionary))


def _predicates(subsets: Mapping[str, tuple[str, str]]) -> dict[str, str]:
    return {prefix: is_category(c, v) for prefix, (c, v) in subsets.items()}


def bureau_features(bureau: DataFrame, balance: DataFrame, bureau_categories: Dictionary | None = None,
                    balance_categories: Dictionary | None = None) -> DataFrame:
    """Two-level roll-up: months per credit, then credits per client with active and closed subsets."""
    in_bureau = bureau_categories if bureau_categories is not None else category_dictionary(bureau)
    in_balance = balance_categories if balance_categories is not None else category_dictionary(balance)
    months = balance_rollup(balance, in_balance)
    joined = bureau.join(months, _credit_keys(balance), "left")
    shares = {f"{dummy_name(c, v)}_MEAN": ["mean"] for c, values in in_balance.items() for v in values}
    main = Rollup("BURO_", {**specs.BUREAU_MEASURES, **shares}, in_bureau)
    subsets = Rollup("", specs.BUREAU_MEASURES, subsets=_predicates(specs.BUREAU_SUBSETS))
    return joined.groupBy(KEY).agg(*main.columns(), *subsets.subset_columns())


def with_previous_ratios(previous: DataFrame, strict_inf: bool = False) -> DataFrame:
    nulled = {c: sentinel_to_null(F.col(c), specs.MISSING_DAYS) for c in specs.PREVIOUS_SENTINELS
              if c in previous.columns}
    perc = ratio(F.col("AMT_APPLICATION"), F.col("AMT_CREDIT"), strict_inf)
    return previous.withColumns({**nulled, "APP_CREDIT_PERC": perc})


def previous_features(previous: DataFrame, categories: Dictionary | None = None,
                      strict_inf: bool = False) -> DataFrame:
    """Previous applications per client with approved and refused subsets."""
    dictionary = categories if categories is not None else category_dictionary(previous)
    return rollup(with_previous_ratios(previous, strict_inf), KEY, previous_spec(dictionary))


def previous_spec(dictionary: Dictionary) -> Rollup:
    return Rollup("PREV_", specs.PREVIOUS_MEASURES, dictionary, subsets=_predicates(specs.PREVIOUS_SUBSETS))


def pos_features(pos: DataFrame, categories: Dictionary | None = None) -> DataFrame:
    dictionary = categories if categories is not None else category_dictionary(pos)
    return rollup(pos, KEY, Rollup("POS_", specs.POS_MEASURES, dictionary, count_as="POS_COUNT"))


def with_payment_gaps(instalments: DataFrame, strict_inf: bool = False) -> DataFrame:
    """Paid share, unpaid amount, days past due and days before due (both clipped at zero)."""
    paid, due = F.col("DAYS_ENTRY_PAYMENT"), F.col("DAYS_INSTALMENT")
    return instalments.withColumns({
        "PAYMENT_PERC": ratio(F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT"), strict_inf),
        "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "DPD": clip_lower(paid - due),
        "DBD": clip_lower(due - paid),
    })


def instalment_features(instalments: DataFrame, categories: Dictionary | None = None,
                        strict_inf: bool = False) -> DataFrame:
    dictionary = categories if categories is not None else category_dictionary(instalments)
    return rollup(with_payment_gaps(instalments, strict_inf), KEY, instalment_spec(dictionary))


def instalment_spec(dictionary: Dictionary) -> Rollup:
    return Rollup("INSTAL_", specs.INSTALMENT_MEASURES, dictionary, count_as="INSTAL_COUNT")


def card_features(card: DataFrame, categories: Dictionary | None = None) -> DataFrame:
    """Five statistics of every numeric column, three of every category, in one aggregate."""
    card = card.drop("SK_ID_PREV")
    dictionary = categories if categories is not None else category_dictionary(card)
    return rollup(card, KEY, card_spec(card, dictionary))


def card_spec(card: DataFrame, dictionary: Dictionary) -> Rollup:
    measures = {c: specs.CARD_NUMERIC_FUNCS for c in numeric_columns(card, exclude=(KEY, "SK_ID_PREV"))}
    return Rollup("CC_", measures, dictionary, specs.CARD_CATEGORY_FUNCS, count_as="CC_COUNT")


def limited_to(tables: LoanTables, applicants: DataFrame) -> LoanTables:
    """The tables with the satellite rows of these applicants only, so that a build for few of them rolls up few rows.

    Up to 20,000 keys (counted) go to every task and filter the satellites in their scan stage. More are semi-joined by shuffle on the
    key that the roll-up is partitioned by anyway. Categories must be known from training, for the rows left need not show all of them.
    """
    keys = small_side(applicants.select(KEY).distinct())

    def mine(df: DataFrame) -> DataFrame:
        return df.join(keys, KEY, "left_semi")

    bureau = mine(tables.bureau)
    credits = small_side(bureau.select("SK_ID_BUREAU").distinct())
    return replace(tables, bureau=bureau, bureau_balance=tables.bureau_balance.join(credits, "SK_ID_BUREAU", "left_semi"),
                   previous_application=mine(tables.previous_application), pos_cash=mine(tables.pos_cash),
                   instalments=mine(tables.instalments), card_balance=mine(tables.card_balance))


def learned(tables: LoanTables, known: Categories) -> Categories:
    """`known` with the dictionaries of all tables, from one job."""
    known.learn({"application": recode_application(tables.application), "bureau": tables.bureau, "bureau_balance": tables.bureau_balance,
                 "previous_application": tables.previous_application, "pos_cash": tables.pos_cash,
                 "instalments": tables.instalments, "card_balance": tables.card_balance})
    return known


def feature_table(tables: LoanTables, categories: Categories | None = None, drop_first: bool = True,
                  strict_inf: bool = False) -> DataFrame:
    """The wide table: applications left-joined with the five satellite roll-ups."""
    known = learned(tables, categories if categories is not None else Categories())
    out = application_features(tables.application, known.of("application", tables.application), drop_first, strict_inf)
    satellites = [
        bureau_features(tables.bureau, tables.bureau_balance, known.of("bureau", tables.bureau),
                        known.of("bureau_balance", tables.bureau_balance)),
        previous_features(tables.previous_application,
                          known.of("previous_application", tables.previous_application), strict_inf),
        pos_features(tables.pos_cash, known.of("pos_cash", tables.pos_cash)),
        instalment_features(tables.instalments, known.of("instalments", tables.instalments), strict_inf),
        card_features(tables.card_balance, known.of("card_balance", tables.card_balance)),
    ]
    for satellite in satellites:
        out = out.join(satellite, KEY, "left")
    out = clean_names(out)
    return infinities_to_null(out) if strict_inf else out
