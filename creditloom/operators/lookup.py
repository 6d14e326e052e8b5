"""Key lookups, id-set checks and payload rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def client_lookup(features: DataFrame, requests: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Requested ids with their features and a `found` flag; unknown ids keep NULL features."""
    marked = features.withColumn("found", F.lit(1))
    return requests.join(marked, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))


def one_client(features: DataFrame, client_id: int, key: str = "SK_ID_CURR") -> DataFrame:
    """The row of one client: the filter reaches the scan."""
    return features.filter(F.col(key) == client_id)


def id_overlap(left: DataFrame, right: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """(n_common): 0 when the id sets are disjoint."""
    return left.select(key).join(right.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("n_common"))


def id_intersection(left: DataFrame, right: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    return left.select(key).intersect(right.select(key))


def unmatched(base: DataFrame, satellite: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Keys of the base table absent from a satellite."""
    return base.select(key).join(satellite.select(key), key, "left_anti")


def to_payload(df: DataFrame, features: Sequence[str], key: str = "SK_ID_CURR") -> DataFrame:
    """(client_id, features): request rows with a map<string, double>; NaN and ±inf become NULL."""
    from creditloom.functions.columns import finite

    pairs = [x for f in features for x in (F.lit(f), finite(F.col(f).cast("double")))]
    return df.select(F.col(key).alias("client_id"), F.create_map(*pairs).alias("features"))


def from_payload(payload: DataFrame, features: Sequence[str], key: str = "SK_ID_CURR") -> DataFrame:
    """Feature columns out of the request map; an absent name gives NULL."""
    return payload.select(F.col("client_id").alias(key), *[
        F.try_element_at("features", F.lit(f)).alias(f) for f in features])


def response_rows(responses: DataFrame, text: str, features: Sequence[str], with_results: bool = True,
                  key: str = "SK_ID_CURR") -> DataFrame:
    """Rows out of JSON response texts; `valid` is 0 when a required key is missing."""
    schema = "client_id bigint, features map<string,double>, proba double, prediction int, threshold double"
    required = ["client_id", "features", *(["proba", "prediction"] if with_results else [])]
    parsed = responses.select(F.from_json(F.col(text), schema).alias("r"))
    valid = F.lit(True)
    for name in required:
        valid = valid & F.col(f"r.{name}").isNotNull()
    extra = [F.col("r.proba").alias("PROBA"), F.col("r.prediction").alias("PREDICTION")] if with_results else []
    return parsed.select(F.col("r.client_id").alias(key), valid.cast("int").alias("valid"), *[
        F.try_element_at(F.col("r.features"), F.lit(f)).alias(f) for f in features], *extra)
