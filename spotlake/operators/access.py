"""Which media an account may see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotlake.functions.text import strip
from spotlake.schemas import MEDIA

# Sector names in order of precedence and the medium each one stands for
SECTOR_NAMES = {
    "television": "tv",
    "televisión": "tv",
    "tv": "tv",
    "radio": "radio",
    "impresos": "impresos",
    "impreso": "impresos",
    "prensa": "impresos",
    "print": "impresos",
    "periódicos": "impresos",
    "periodicos": "impresos",
    "revistas": "impresos",
    "revista": "impresos",
}


def sector_medium(name: Column) -> Column:
    """Medium of a sector name: exact match first, then the first name it contains, else null."""
    plain = F.lower(strip(name))
    exact = F.element_at(F.create_map(*[F.lit(x) for pair in SECTOR_NAMES.items() for x in pair]), plain)
    within = [F.when(plain.contains(key), medium) for key, medium in SECTOR_NAMES.items()]
    return F.coalesce(exact, *within)


def account_media(accounts: DataFrame, sectors: DataFrame) -> DataFrame:
    """Sorted media per account; an account whose sectors map to nothing sees every medium.

    The account-sector pairs are made distinct before the join, and an account collects at
    most one entry per medium.
    """
    pairs = accounts.select("id_account", "id_sector_src").distinct()
    named = sectors.select(F.col("id").alias("id_sector_src"), sector_medium(F.col("name")).alias("medium"))
    allowed = pairs.join(named, "id_sector_src", "left").groupBy("id_account").agg(
        F.array_sort(F.collect_set("medium")).alias("media")
    )
    everything = F.array(*map(F.lit, MEDIA))
    return allowed.select(
        "id_account", F.when(F.size("media") == 0, everything).otherwise(F.col("media")).alias("media")
    )


def allowed_rows(rows_per_medium: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows each account may see, from the row count of each medium.

    Counting per medium first keeps the join at accounts x media, whatever the table holds.
    """
    grants = allowed.select("id_account", F.explode("media").alias("medium"))
    return grants.join(rows_per_medium, "medium", "left").groupBy("id_account").agg(
        F.count("*").alias("media_allowed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("visible_rows"),
    )


def restrict(df: DataFrame, medium_column: str, media: list[str] | None, admin: bool = False) -> DataFrame:
    """Keep the media an account may see; an empty list and an administrator see all."""
    if admin or not media:
        return df
    return df.where(F.col(medium_column).isin(list(media)))


def check_access(medium: str, media: list[str] | None, admin: bool = False) -> None:
    if not admin and medium not in (media or MEDIA):
        raise PermissionError(f"no access to {medium}")
