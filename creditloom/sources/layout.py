"""Loan tables stored by client, so that roll-ups and joins move no rows.

Every table is bucketed and sorted by the client key, one file per bucket; monthly balances carry the client of their credit. Grouping by
client (or client and credit) and joining by it then follow the files. Clients with more rows than a bound in any satellite would make one bucket
large: they are stored apart, unbucketed, and built by the usual plan, whose roll-ups combine before they shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.naming import quoted
from creditloom.plans.features import KEY, Categories, LoanTables, feature_table, learned
from creditloom.session import small_side

CREDIT = "SK_ID_BUREAU"
HOT_ROWS = 1_000_000
_NAMES = [f.name for f in fields(LoanTables)]


@dataclass(frozen=True)
class Layout:
    """Stored loan tables: `usual` are bucketed catalog tables, `hot` plain ones or None. Each client is in one of the two."""

    usual: LoanTables
    hot: LoanTables | None

    def parts(self) -> list[LoanTables]:
        return [t for t in (self.usual, self.hot) if t is not None]

    def whole(self) -> LoanTables:
        return LoanTables(*[reduce(DataFrame.unionByName, [getattr(t, n) for t in self.parts()]) for n in _NAMES])


def with_clients(tables: LoanTables) -> LoanTables:
    """Balances with the client of their credit. Those of unknown credits go, as no roll-up uses them."""
    owners = tables.bureau.select(CREDIT, KEY).distinct()
    return LoanTables(**{**_each(tables), "bureau_balance": tables.bureau_balance.join(owners, CREDIT)})


def _each(tables: LoanTables) -> dict[str, DataFrame]:
    return {n: getattr(tables, n) for n in _NAMES}


def hot_clients(tables: LoanTables, limit: int) -> DataFrame:
    """Clients with more than `limit` rows in one table; at most (rows / limit) of them per table."""
    counts = [df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(KEY) for df in _each(tables).values()]
    return reduce(DataFrame.union, counts).filter(F.col(KEY).isNotNull()).distinct()


def _sort_keys(df: DataFrame) -> list[str]:
    return [KEY, *[c for c in (CREDIT,) if c in df.columns]]


def store(tables: LoanTables, path: str, name: str, buckets: int, hot_rows: int = HOT_ROWS) -> Layout:
    """Write the tables below `path` and register the bucketed ones as `{name}_{table}`.

    Rows without a client reach no feature row and are not stored. Tables of that name must not exist yet. Choose `buckets` so that the
    largest table has some hundred MB in each; every table has as many.
    """
    root, known = path.rstrip("/"), with_clients(tables)
    spark = tables.application.sparkSession
    hot_clients(known, hot_rows).write.parquet(f"{root}/hot_clients")
    hot = small_side(spark.read.parquet(f"{root}/hot_clients"))
    some = not hot.isEmpty()
    for table, df in _each(known).items():
        held = df.filter(F.col(KEY).isNotNull())
        keys = _sort_keys(df)
        (held.join(hot, KEY, "left_anti") if some else held).repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(*keys).option(
            "path", f"{root}/usual/{table}").saveAsTable(f"{name}_{table}")
        if some:
            held.join(hot, KEY, "left_semi").write.parquet(f"{root}/hot/{table}")
    spark.createDataFrame([(buckets, some)], "buckets int, hot boolean").coalesce(1).write.parquet(f"{root}/about")
    return opened(spark, root, name)


def opened(spark: SparkSession, path: str, name: str) -> Layout:
    """The layout stored at `path`. A session that does not know its tables registers them from the files.

    Credits meet their months by client and credit while the files are dealt by client alone. Spark shuffles such a join to be safe from
    skew unless told otherwise; hot clients being apart, the session is told so here. Results do not depend on it.
    """
    root = path.rstrip("/")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    about = spark.read.parquet(f"{root}/about").first()

    def usual() -> Iterator[DataFrame]:
        for table in _NAMES:
            if not spark.catalog.tableExists(f"{name}_{table}"):
                files = spark.read.parquet(f"{root}/usual/{table}")
                columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in files.schema)
                spark.sql(f"CREATE TABLE {name}_{table} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({', '.join(_sort_keys(files))}) "
                          f"INTO {about['buckets']} BUCKETS LOCATION '{root}/usual/{table}'")
            yield spark.table(f"{name}_{table}")

    hot = LoanTables(*[spark.read.parquet(f"{root}/hot/{t}") for t in _NAMES]) if about["hot"] else None
    return Layout(LoanTables(*usual()), hot)


def stored_feature_table(layout: Layout, categories: Categories | None = None, **options) -> DataFrame:
    """`plans.features.feature_table` from a layout: no exchange for the usual clients; the hot ones are built apart and added."""
    known = learned(layout.whole(), categories if categories is not None else Categories())
    return reduce(DataFrame.unionByName, [feature_table(part, known, **options) for part in layout.parts()])
