"""What a generic job needs to know about a kind of record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint import schemas
from touchpoint.functions import names
from touchpoint.operators import validate


@dataclass(frozen=True)
class Dataset:
    """Schema, key, text to embed, validation and object name of a kind of record.

    ``order`` names the columns whose larger value is newer; it decides between records with the same key that have no
    position in a file.
    """

    name: str
    schema: str
    key: str
    text: str
    rules: Callable[[], list[validate.Rule]]
    file_name: Callable[[], Column]
    order: tuple[str, ...]

    def ordering(self) -> list[Column]:
        return [F.desc(c) for c in self.order]

    def flagged(self, df: DataFrame) -> DataFrame:
        return validate.with_reason(df, self.rules(), validate.INVALID)

    def named(self, df: DataFrame) -> DataFrame:
        return df.withColumn("file_name", self.file_name())


RECEIPTS = Dataset(
    "receipts", schemas.RECEIPT, "id", "body", validate.receipt_rules,
    lambda: names.transaction_name(F.col("at"), F.col("id"), F.col("user_id")), ("at", "body"),
)
PRODUCTS = Dataset(
    "products", schemas.PRODUCT, "id", "title", validate.product_rules, lambda: names.product_name(F.col("id")), ("title",)
)
DESCRIPTIONS = Dataset(
    "product_descriptions", schemas.PRODUCT_DESCRIPTION, "id", "description", validate.description_rules,
    lambda: names.product_name(F.col("id")), ("description", "title", "hid", "product_category_hid"),
)
