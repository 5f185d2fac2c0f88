"""Column expressions that type and normalise dirty text. No Python runs per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Species code -> label, the label of unknown codes, and the text of a blank code.
SPECIES_LABELS = {
    "C": "Colza",
    "O": "Colza",
    "S": "Soja",
    "W": "Blé tendre",
    "T": "Triticale",
    "B": "Blé dur/Orge",
    "M": "Maïs",
    "L": "Lin",
    "P": "Pois",
}
UNKNOWN_PREFIX = "INCONNU_CODE_"
BLANK_CODE = "VIDE"
# Text that counts as missing when a delimited file is read.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ----------------------------------------------------------------------------

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(name: str, upper: bool = False) -> str:
    cleaned = name.lstrip("\ufeff").strip()
    return cleaned.upper() if upper else cleaned


def clean_names(df: DataFrame, upper: bool = False) -> DataFrame:
    """Strip the byte-order mark and blanks from column names (PRJ-3)."""
    return df.toDF(*[clean_name(c, upper) for c in df.columns])


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Text cells that spell a missing value become null."""
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
        if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain decimal number is null (PRJ-5)."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def whole_number(c: Column | str) -> Column:
    """Text to a nullable bigint; ``'2018.0'`` is accepted."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(WHOLE), text.try_cast("bigint")).otherwise(
        number(text).try_cast("bigint"))


def decimal_comma(c: Column | str) -> Column:
    """``'843,94'`` to 843.94 (PRJ-6)."""
    return number(F.replace(_col(c).cast("string"), F.lit(","), F.lit(".")))


def id_text(c: Column | str) -> Column:
    """Numeric id in one spelling: ``'53684.0'`` and ``53684`` both give ``'53684'`` (PRJ-4).

    Whole ids never pass through a double, so ids above 2^53 keep their digits.
    Missing and unreadable ids are null.
    """
    return whole_number(c).cast("string")


def text(c: Column | str) -> Column:
    """Trimmed text; null stays null (PRJ-9)."""
    return F.trim(_col(c).cast("string"))


def blank_to_null(c: Column | str) -> Column:
    """Empty text to null (PRJ-11)."""
    return F.nullif(_col(c), F.lit(""))


def species_label(code: Column | str, labels: Mapping[str, str] = SPECIES_LABELS) -> Column:
    """Code to label; unknown and blank codes stay visible (PRJ-10)."""
    key = F.upper(F.trim(F.coalesce(_col(code).cast("string"), F.lit(""))))
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    unknown = F.concat(F.lit(UNKNOWN_PREFIX), F.when(key == "", F.lit(BLANK_CODE)).otherwise(key))
    return F.coalesce(F.try_element_at(lookup, key), unknown)


def coordinates(lat: Sequence[Column | str], lon: Sequence[Column | str]) -> tuple[Column, Column]:
    """First coordinate present in each list; the pair (0, 0) means missing (PRJ-7, PRJ-8)."""
    best_lat = F.coalesce(*[number(c) for c in lat])
    best_lon = F.coalesce(*[number(c) for c in lon])
    missing = F.coalesce((best_lat == 0) & (best_lon == 0), F.lit(False))
    return F.when(~missing, best_lat), F.when(~missing, best_lon)


def composite_key(*parts: Column | str, sep: str = "#") -> Column:
    """Parts joined by ``sep``; a null part is an empty slot, so keys keep their shape (PRJ-15)."""
    return F.concat_ws(sep, *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def promote_numeric(df: DataFrame, share: float = 0.6) -> DataFrame:
    """Turn text columns into doubles when more than ``share`` of all rows parse (PRJ-12).

    One aggregate measures every column; only that single row reaches the driver.
    """
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return df
    ratios = df.agg(*[
        (F.count(decimal_comma(F.col(f"`{c}`"))) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias(c)
        for c in texts]).first()
    winners = {c for c in texts if ratios[c] > share}
    return df.select(*[decimal_comma(F.col(f"`{c}`")).alias(c) if c in winners
                       else F.col(f"`{c}`") for c in df.columns])


def any_column_contains(df: DataFrame, needle: str) -> DataFrame:
    """Rows where any column holds the text, ignoring case (FLT-11)."""
    haystacks = [F.contains(F.lower(F.col(f"`{c}`").cast("string")), F.lit(needle.strip().lower()))
                 for c in df.columns]
    hit = F.lit(False)
    for h in haystacks:
        hit = hit | F.coalesce(h, F.lit(False))
    return df.filter(hit)
