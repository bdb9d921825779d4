"""A bright-star catalogue of the whole sky."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.bands import gaia_to_johnson
from .filters import quality_cut
from .match import dedupe_sky


def bright_catalog(stars: DataFrame, mlim: float = 10.0, r: float = 1 / 3600, keep: str = "first") -> DataFrame:
    """Stars brighter than the limit that pass the survey's cuts, with Johnson bands, without close doubles
    (within r degrees; the first by star_id stays), in order of g."""
    rows = gaia_to_johnson(quality_cut(stars.where(stars["g"] < mlim), "gaia"))
    return dedupe_sky(rows, r, keep, "star_id", ("radeg", "decdeg")).orderBy("g", "star_id")
