"""Clean and filter review texts into label-ready rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import clean_text, has_script, strip_space
from gleanery.params import CleaningParams
from gleanery.schemas import UNLABELED


def prepare(reviews: DataFrame, params: CleaningParams = CleaningParams()) -> DataFrame:
    """Unlabeled rows ``reviewId, platform, text, primary, secondary``.

    Blank texts go first, then those whose cleaned form is too short or has
    too few characters of the wanted script.
    """
    # Each as an array of none or one, so that Spark cannot move a test below the
    # projection that computes its text, and compute every text twice or more.
    filled = F.filter(F.array(F.col("content").cast("string")), lambda text: strip_space(text) != "")
    rows = reviews.filter(F.col("content").cast("string") != "")  # reaches the scan of a stored table
    rows = rows.select("reviewId", "platform", F.explode(filled).alias("content"))
    rows = rows.select("reviewId", "platform", clean_text(F.col("content"), params.strip_emoji).alias("text"))

    def wanted(text):
        return (F.length(text) >= params.min_length) & has_script(text, params.min_script_chars, params.script)

    survivors = F.filter(F.array("text"), wanted)
    return rows.select(
        "reviewId",
        "platform",
        F.explode(survivors).alias("text"),
        F.lit("").alias("primary"),
        F.lit("").alias("secondary"),
    ).select(*UNLABELED.names)
