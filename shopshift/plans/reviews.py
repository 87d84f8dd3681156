"""Review job: the rating and its five options, reviews, votes, details and store links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopshift import config as C
from shopshift.config import MigrationConfig
from shopshift.functions import columns as X
from shopshift.functions import predicates as P
from shopshift.operators.joins import typed_join
from shopshift.operators.keys import next_key
from shopshift.operators.reshape import replicate
from shopshift.sinks.writers import replace_where
from shopshift.sources.tables import constant_row, constant_rows, materialise


def rating_tables(tgt: dict[str, DataFrame], cfg: MigrationConfig) -> tuple[dict[str, DataFrame], int]:
    """(Re)create the rating and its scale; returns the tables and the new rating id."""
    spark = tgt["rating"].sparkSession
    ratings = tgt["rating"]
    replaced = P.equals("rating_code", cfg.rating_code)
    # ids continue after the rows that stay, so a re-run reproduces the same ids
    rating_id = next_key(ratings.filter(~F.coalesce(replaced, F.lit(False))), "rating_id")
    old_ratings = ratings.filter(replaced).select("rating_id")
    new_rating = constant_row(spark, rating_id=rating_id, rating_code=cfg.rating_code, entity_id=1, position=0)
    ratings = replace_where(ratings, new_rating, replaced)
    # the options belong to the rating: options of a replaced rating go with it
    kept_options = tgt["rating_option"].join(old_ratings, "rating_id", "left_anti")
    first_option = next_key(kept_options, "option_id")
    scale = [
        (first_option + i, rating_id, str(v), v, v) for i, v in enumerate(C.RATING_SCALE)
    ]
    options = constant_rows(spark, "option_id long, rating_id long, code string, value int, position int", scale)
    all_options = kept_options.unionByName(options, allowMissingColumns=True)
    return {"rating": ratings, "rating_option": all_options}, rating_id


def reviews_stage(src: dict[str, DataFrame], options: DataFrame, rating_id: int) -> DataFrame:
    """Reviews with their text and the option of their rating value (unmatched reviews drop)."""
    r = src["reviews"]
    rd = src["reviews_description"].select("reviews_id", "reviews_text")
    with_text = r.join(rd, "reviews_id", "inner")
    # the options of the new rating are the scale created with it
    opts = options.filter(P.equals("rating_id", rating_id)).select("option_id", F.col("value").alias("option_value"))
    return typed_join(with_text, "reviews_rating", opts, "option_value", "long", "inner").select(
        "reviews_id", "products_id", "customers_id", "customers_name", "reviews_rating", "date_added",
        "reviews_text", "option_id",
    )


def review_rows(stage: DataFrame) -> dict[str, DataFrame]:
    return {
        "review": stage.select(
            F.col("reviews_id").alias("review_id"),
            F.col("date_added").alias("created_at"),
            F.col("products_id").alias("entity_pk_value"),
            F.lit(1).alias("entity_id"),
            F.lit(1).alias("status_id"),
        ),
        "rating_option_vote": stage.select(
            F.col("customers_id").alias("customer_id"),
            "option_id",
            F.col("reviews_id").alias("review_id"),
            F.col("reviews_rating").alias("value"),
            X.rating_percent("reviews_rating").alias("percent"),
            F.col("products_id").alias("entity_pk_value"),
        ),
        "review_detail": stage.select(
            F.col("reviews_id").alias("review_id"),
            F.lit(1).alias("store_id"),
            F.col("reviews_text").alias("detail"),
            F.col("customers_name").alias("nickname"),
            F.col("customers_id").alias("customer_id"),
        ),
        "review_store": replicate(stage.select(F.col("reviews_id").alias("review_id")), "store_id", [0, 1]),
    }


def reviews_job(
    src: dict[str, DataFrame], tgt: dict[str, DataFrame], cfg: MigrationConfig, materialise_stages: bool = False
) -> dict[str, DataFrame]:
    """Rating scale plus the four review targets (the stage feeds all four)."""
    out, rating_id = rating_tables(tgt, cfg)
    stage = reviews_stage(src, out["rating_option"], rating_id)
    if materialise_stages:
        stage = materialise(stage)
    out.update(review_rows(stage))
    return out

