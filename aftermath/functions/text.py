"""Text and key normalisation."""

from pyspark.sql import Column, functions as F


def tidy(value: Column) -> Column:
    """Trimmed upper-case text; null stays null."""
    return F.upper(F.trim(value))


def zero_pad(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    return F.lpad(value, F.greatest(F.length(value), F.lit(width)), "0")


def code_digits(value: Column) -> Column:
    """Digits of a whole-number code given as number or text (``7``, ``007``, ``7.0``); else null."""
    return F.nullif(F.regexp_extract(value.cast("string"), r"^\s*0*(\d+?)(\.0*)?\s*$", 1), F.lit(""))


def place_key(state: Column, county: Column) -> Column:
    """Two-digit state code followed by three-digit county code; null if either is."""
    return F.concat(zero_pad(code_digits(state), 2), zero_pad(code_digits(county), 3))


def slug(label: str) -> str:
    """Column-name form of a category label."""
    return label.replace(" ", "_").replace("/", "_").lower()


def numeric(value: Column) -> Column:
    """Number parsed leniently: bad text and NaN are null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def key_number(value: Column) -> Column:
    """A numeric key given as number or text (``12`` or ``12.0``) as a long; else null."""
    number = value.try_cast("string").try_cast("double")
    return F.coalesce(value.try_cast("long"), F.when(number == F.floor(number), number.try_cast("long")))
