"""The order panel: the six base tables every operator reads.

A :class:`Panel` is a bag of lazy DataFrames in the market-basket layout

* ``orders``          order_id, user_id, eval_set, order_number, order_dow,
                      order_hour_of_day, days_since_prior_order
* ``order_products``  order_id, product_id, add_to_cart_order, reordered, eval_set
* ``products``        product_id, product_name, aisle_id, department_id
* ``departments``     department_id, department
* ``aisles``          aisle_id, aisle
* ``product_prices``  product_id, price decimal(8,2)

``order_products_raw`` is the line table as loaded (before basket de-duplication); the
quality report and the key checks run on it, everything else on ``order_products``.
Panels come from the market-basket CSV files (:mod:`basketry.sources.files`) or are
derived from the star-schema Parquet tables (:mod:`basketry.sources.star`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class Panel:
    orders: DataFrame
    order_products: DataFrame
    products: DataFrame
    departments: DataFrame
    aisles: DataFrame
    product_prices: DataFrame
    order_products_raw: DataFrame | None = None

    def __post_init__(self):
        if self.order_products_raw is None:
            self.order_products_raw = self.order_products

    def register(self, prefix: str = "") -> "Panel":
        """Expose the tables as temp views for ``spark.sql``."""
        for name in ("orders", "order_products", "products", "departments", "aisles",
                     "product_prices", "order_products_raw"):
            getattr(self, name).createOrReplaceTempView(prefix + name)
        return self
