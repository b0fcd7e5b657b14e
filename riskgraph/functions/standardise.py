"""Standardising raw columns. Every cast is a ``try_cast``: bad input becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V

# --- fixed values: accepted spellings ------------------------------------------------------------
TRUE_WORDS = ("true", "yes", "y")
FALSE_WORDS = ("false", "no", "n")
TRUE_TOKENS = ("1", "1.0") + TRUE_WORDS
FALSE_TOKENS = ("0", "0.0") + FALSE_WORDS
NUMBER_PATTERN = r"^-?\d+(\.\d+)?$"
WHOLE_PATTERN = r"^\d+(\.0+)?$"


def optional_column(df: DataFrame, name: str) -> Column:
    """The column if the frame has it, a NULL otherwise (schema drift turns into presence violations)."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def text_of(col: Column) -> Column:
    return F.lower(F.trim(col.cast("string")))


def to_double(col: Column) -> Column:
    """Numeric text as a double; NaN and junk are NULL."""
    return F.nanvl(col.try_cast("double"), F.lit(None))


def to_int(col: Column) -> Column:
    """Truncate numeric text to int; NaN, overflow and junk are NULL."""
    return col.try_cast("double").try_cast("int")


def parse_binary(col: Column) -> Column:
    word = text_of(col)
    return F.when(word.isin(*TRUE_TOKENS), True).when(word.isin(*FALSE_TOKENS), False)


def parse_binary_or_positive(col: Column) -> Column:
    """Numbers: positive is true, zero is false, negative is unknown. Words as in ``parse_binary``."""
    word = text_of(col)
    number = F.when(word.rlike(NUMBER_PATTERN), word.try_cast("double"))
    by_number = F.when(number > 0, True).when(number == 0, False)
    by_word = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    return F.coalesce(by_number, by_word)


def parse_gender(col: Column, female: Sequence[str], male: Sequence[str]) -> Column:
    word = text_of(col)
    return F.when(word.isin(*female), "female").when(word.isin(*male), "male")


def age_band_of_years(years: Column) -> Column:
    """Band 1..13: five-year steps from 25 up, everything younger in band 1, 80 and older in band 13."""
    step = F.floor(years / 5) - 3
    return F.when(years.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(V.AGE_BANDS), step))).cast("int")


def age_band_of_label(col: Column) -> Column:
    """Decode a band given as whole-number text (any value) or as one of the 13 labels."""
    word = text_of(col)
    labels = F.create_map(*[F.lit(x) for i, t in enumerate(V.AGE_BAND_LABELS, 1) for x in (t, i)])
    return F.when(word.rlike(WHOLE_PATTERN), to_int(word)).otherwise(F.try_element_at(labels, word))


def age_band_midpoint(band: Column) -> Column:
    mids = F.array(*[F.lit(m) for m in V.AGE_BAND_MIDPOINTS])
    return F.when(band.between(1, len(V.AGE_BAND_MIDPOINTS)), F.get(mids, band - 1))


def days_to_years(days: Column) -> Column:
    return F.floor(to_double(days) / F.lit(365.25)).try_cast("int")


def body_mass_index(weight_kg: Column, height_cm: Column) -> Column:
    return F.when(height_cm > 0, weight_kg / F.pow(height_cm / 100.0, F.lit(2.0)))


def row_digest(prefix: str, columns: Sequence[str | Column]) -> Column:
    """SHA-256 over prefix and columns as text, NULL as empty text, joined by a bar."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", F.lit(prefix), *texts), 256)


def stable_record_key(df: DataFrame, prefix: str) -> Column:
    """Digest of the data columns; lineage columns (leading underscore) do not count."""
    return row_digest(prefix, [c for c in df.columns if not c.startswith("_")])
