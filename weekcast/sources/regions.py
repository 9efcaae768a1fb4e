"""Region names -> two-letter codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Region names and the codes the source knows them by.
REGION_CODES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar",
    "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de",
    "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id",
    "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks",
    "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md",
    "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms",
    "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv",
    "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny",
    "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok",
    "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc",
    "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut",
    "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv",
    "wisconsin": "wi", "wyoming": "wy", "district of columbia": "dc",
    "puerto rico": "pr", "american samoa": "as", "guam": "gu",
    "northern mariana islands": "mp", "u.s. virgin islands": "vi",
}

# All characters that Python's str.strip() removes; SQL trim removes blanks only.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def region_mapping(spark: SparkSession) -> DataFrame:
    """The built-in mapping (name, code): 56 rows."""
    return spark.createDataFrame(list(REGION_CODES.items()), "name string, code string")


def normalize_region(
    df: DataFrame,
    col: str,
    mapping: DataFrame | None = None,
    strict: bool = True,
    out: str = "region_code",
) -> DataFrame:
    """Add ``out``: the code for a region given by name or by code.

    Unknown regions get NULL, which callers route to quarantine.
    ``strict=False`` is for codes that are known to be right: they are only
    lower-cased, neither trimmed nor looked up.
    """
    if not strict:
        return df.withColumn(out, F.lower(F.col(col)))
    built_in = mapping is None
    names = region_mapping(df.sparkSession) if built_in else mapping
    # A code always stands for itself, even where a name is spelt the same.
    by_name = names.select(F.col("name").alias("_key"), F.col("code"), F.lit(0).alias("_self"))
    by_code = names.select(F.col("code").alias("_key"), F.col("code"), F.lit(1).alias("_self"))
    lookup = (
        by_name.unionByName(by_code)
        .groupBy("_key")
        .agg(F.max(F.struct("_self", "code"))["code"].alias(out))
    )
    if built_in:
        lookup = F.broadcast(lookup)  # 112 rows, fixed; a caller's mapping is left to its statistics
    key = F.lower(F.btrim(F.col(col), F.lit(WHITESPACE)))
    return df.withColumn("_key", key).join(lookup, "_key", "left").drop("_key")
