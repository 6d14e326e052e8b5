"""Build, prepare and store the training data of one project folder."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditloom.operators.cleaning import predictors
from creditloom.plans.features import KEY, Categories, LoanTables, feature_table
from creditloom.plans.preparation import compact, flagged, screened
from creditloom.sources import io


@dataclass
class TrainingSet:
    """Readers of what `build` stored."""

    spark: SparkSession
    folder: str

    def part(self, is_test: int) -> DataFrame:
        """One part; the other part's files are not read."""
        return self.spark.read.parquet(f"{self.folder}/parts").filter(f"is_test = {is_test}").drop("is_test")

    def features(self) -> list[str]:
        return io.load_feature_list(self.spark, f"{self.folder}/feature_lists", "all")

    def types(self) -> dict[str, str]:
        schema = io.load_schema(self.spark, f"{self.folder}/schema")
        return {f.name: f.dataType.simpleString() for f in schema if f.name in set(self.features())}

    def categories(self) -> Categories:
        text = self.spark.read.text(f"{self.folder}/categories", wholetext=True).first()["value"]
        return Categories(json.loads(text))


def build(tables: LoanTables, folder: str, test_share: float = 0.25) -> TrainingSet:
    """Feature table to disk, then its split to disk, then screens and types from there.

    Roll-ups run once and so do the ranks of the split. The passes that follow (screens over the training part, 0/1
    columns, type ranges, the parts) scan columns of Parquet, and a lost executor costs one task, not the lineage.
    """
    spark = tables.application.sparkSession
    known = Categories()
    io.write_parquet(feature_table(tables, known), f"{folder}/features")
    io.write_parquet(flagged(spark.read.parquet(f"{folder}/features"), test_share=test_share), f"{folder}/flagged")
    prepared = screened(spark.read.parquet(f"{folder}/flagged"))
    out = compact(prepared.data.withColumn("is_test", prepared.data["is_test"].cast("string")))
    io.save_split(out, f"{folder}/parts", "is_test")
    io.save_schema(out.drop("is_test"), f"{folder}/schema")
    names = predictors(out, (KEY, "TARGET", "is_test"))
    io.write_parquet(io.feature_list_rows(spark, {"all": names, "constant": prepared.constant, "empty": prepared.empty}),
                     f"{folder}/feature_lists")
    spark.createDataFrame([(json.dumps(known.tables),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/categories")
    return TrainingSet(spark, folder)
