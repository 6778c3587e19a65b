"""Product prices: the loaded price table, or a deterministic fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import fixed


def unit_hash(*cols, seed: int = fixed.SEED) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of md5("c1|c2|…|seed").

    Depends only on the row's values, so it is the same on any partitioning, on a
    retried task, and in SQL engines that have md5."""
    key = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols],
                      F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def derived_prices(products: DataFrame, seed: int = fixed.SEED) -> DataFrame:
    """price = floor(base · noise) + 0.99 with base = 2 + department_id mod 7 and
    noise uniform in [0.5, 4) drawn from the product id."""
    base = (F.lit(fixed.PRICE_BASE) + F.pmod(F.col("department_id"), F.lit(fixed.PRICE_TIERS))).cast("double")
    noise = F.lit(fixed.PRICE_NOISE_LOW) + F.lit(fixed.PRICE_NOISE_HIGH - fixed.PRICE_NOISE_LOW) * unit_hash("product_id", seed=seed)
    price = F.floor(base * noise).cast("decimal(8,2)") + F.lit(fixed.PRICE_CENTS).cast("decimal(8,2)")
    return products.select("product_id", price.cast("decimal(8,2)").alias("price"))


def ensure_prices(products: DataFrame, prices: DataFrame | None, seed: int = fixed.SEED) -> DataFrame:
    """The loaded price table when there is one, else the derived prices."""
    if prices is not None:
        return prices.select("product_id", F.col("price").cast("decimal(8,2)").alias("price"))
    return derived_prices(products, seed)
