"""Builds for few applicants read few satellite rows and give the same features."""

from creditloom.plans.features import Categories, feature_table, limited_to
from creditloom.plans.preparation import new_loan_features
from creditloom.sources import starschema as star
from tests.test_catalog import plan_of


def test_only_the_applicants_rows_are_rolled_up(spark, sf):
    tables = star.loan_tables(spark, sf)
    few = tables.application.filter("SK_ID_CURR <= 15")
    small = limited_to(tables, few)
    ids = {r[0] for r in few.select("SK_ID_CURR").collect()}
    for name in ("bureau", "previous_application", "pos_cash", "instalments", "card_balance"):
        whole, mine = getattr(tables, name), getattr(small, name)
        assert {r[0] for r in mine.select("SK_ID_CURR").distinct().collect()} <= ids
        assert mine.count() == whole.filter(whole.SK_ID_CURR.isin(*ids)).count()
        assert "LeftSemi" in plan_of(mine)
    months = small.bureau_balance.select("SK_ID_BUREAU").distinct()
    assert months.join(small.bureau, "SK_ID_BUREAU", "left_anti").isEmpty()
    # No exchange below the filter: it works where the rows are read.
    plan = plan_of(small.pos_cash)
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_same_features_as_the_whole_build(spark, sf):
    tables = star.loan_tables(spark, sf)
    known = Categories()
    whole = feature_table(tables, known, drop_first=False)
    few = tables.application.filter("SK_ID_CURR % 7 = 2")
    features = [c for c in whole.columns if c not in ("SK_ID_CURR", "TARGET")][:60] + ["CC_AMT_BALANCE_SUM", "BURO_DAYS_CREDIT_MEAN", "POS_COUNT"]
    features = list(dict.fromkeys(features))
    got = new_loan_features(type(tables)(few, *[getattr(tables, n) for n in list(tables.__dataclass_fields__)[1:]]), features, known)[0]
    want = whole.filter("SK_ID_CURR % 7 = 2")
    for c in ("CC_AMT_BALANCE_SUM", "BURO_DAYS_CREDIT_MEAN", "POS_COUNT"):
        left = {r[0]: r[1] for r in got.select("SK_ID_CURR", c).collect()}
        assert left == {r[0]: r[1] for r in want.select("SK_ID_CURR", c).collect()}
