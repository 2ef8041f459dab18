"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "normalize_taxon", "first_token", "trim_ws", "level_suffix", "log10_pseudo",
    "presence_flag", "panel_column_name", "keyed_uniform", "clamp_fraction",
    "erfc", "round_doubles",
]


#: Whitespace other than the blank, and the other characters before which a pattern's ``$`` holds.
_RARE = "[\t-\r\x85\u2028\u2029]"


def _plain(c: Column) -> Column:
    """The string has none of ``_RARE``, so blanks are all there is to trim and to cut at: no patterns are needed,
    which cost more than all else done with a row."""
    return ~c.rlike(_RARE)


def trim_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (blanks, tabs, newlines)."""
    return F.when(_plain(c), F.trim(c)).otherwise(F.regexp_replace(c, r"^\s+|\s+$", ""))


def normalize_taxon(c: Column) -> Column:
    """strip, lower, '_' -> ' ', collapse inner whitespace to one blank."""
    blanks = F.lower(F.replace(c, F.lit("_"), F.lit(" ")))
    plain = F.trim(blanks)
    return (F.when(_plain(c) & ~plain.contains("  "), plain)
            .otherwise(F.regexp_replace(F.regexp_replace(blanks, r"^\s+|\s+$", ""), r"\s+", " ")))


def first_token(c: Column) -> Column:
    """First whitespace-separated token of a trimmed string ('' for blank)."""
    return F.when(_plain(c), F.substring_index(F.trim(c), " ", 1)).otherwise(F.split(trim_ws(c), r"\s+").getItem(0))


def level_suffix(c: Column) -> Column:
    """Abundance level code -> file suffix: S -> _species, G -> _genus, else ''."""
    code = F.upper(trim_ws(c))
    return (F.when(code == "S", F.lit("_species"))
            .when(code == "G", F.lit("_genus"))
            .otherwise(F.lit("")))


def log10_pseudo(c: Column, pseudocount: float) -> Column:
    return F.log10(c + F.lit(float(pseudocount)))


def presence_flag(c: Column, threshold: float) -> Column:
    """Inclusive threshold: value >= threshold -> 1 else 0."""
    return F.when(c >= F.lit(float(threshold)), 1).otherwise(0).cast("int")


def panel_column_name(taxon: str) -> str:
    return "panel_" + taxon.replace(" ", "_")


def keyed_uniform(*parts: Column) -> Column:
    """Deterministic uniform in [0,1) from md5 of the ':'-joined key.

    Independent of partitioning and task retries, unlike ``rand()``; the same
    number is computable in any SQL engine with md5.
    """
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    top52 = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint")
    return top52.cast("double") / F.lit(float(1 << 52))


def clamp_fraction(target: Column, total: Column) -> Column:
    """min(1, max(0, target / max(total, 1)))."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                   target.cast("double") / F.greatest(total, F.lit(1)).cast("double")))


# Fixed coefficients of the complementary error function approximation
# (Chebyshev fit, fractional error below 1.2e-7 everywhere).
ERFC_COEFFS = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc(x: Column) -> Column:
    """erfc(x) as Column arithmetic: there is no built-in erf in Spark SQL."""
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(ERFC_COEFFS[-1])
    for coef in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(coef) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (for engine-independent comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
