"""Text cleaning, number parsing and keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from berthlake import fixed_values as fv

_BLANKS = " \t\n\r\x0b\x0c 　"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(_BLANKS))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def clean_token(c: Column | str) -> Column:
    """Trimmed text; the spellings of a missing value become null."""
    text = strip(c)
    return F.when(~text.isin(fv.NULL_TOKENS), text)


def int_or_null(c: Column | str) -> Column:
    """'1,200' -> 1200; anything that is not a whole number ('12.0', '-') -> null."""
    digits = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.when(digits.rlike("^[+-]?[0-9]+$"), digits.try_cast("int"))


def zero_padded(c: Column | str, width: int) -> Column:
    """Digits of a whole number with leading zeros up to ``width``; a longer number is never cut."""
    digits = _col(c).cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def double_or_null(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast("double")


def workload_strict(c: Column | str) -> Column:
    """'1,015 / 960 / 12' -> struct(discharge, loading, shift); a bad part becomes null."""
    pieces = F.split(strip(c), r"\s*/\s*|／|｜|\|")
    pieces = F.filter(pieces, lambda p: strip(p) != "")
    pieces = F.transform(pieces, lambda p: F.replace(strip(p), F.lit(","), F.lit("")))

    def part(i: int) -> Column:
        piece = F.get(pieces, F.lit(i))
        return F.when(piece.rlike("^[0-9]+$"), piece.try_cast("int"))

    return F.struct(
        part(0).alias("discharge"), part(1).alias("loading"), part(2).alias("shift")
    )


def workload_lenient(c: Column | str) -> Column:
    """Slash- or blank-separated triple; every failure counts as zero."""
    text = _col(c)
    by_slash = F.split(text, "/")
    by_blank = F.filter(F.split(text, r"\s+"), lambda p: p != "")
    pieces = F.when(F.size(by_slash) >= 2, by_slash).when(F.size(by_blank) >= 2, by_blank)

    def part(i: int) -> Column:
        digits = F.regexp_replace(F.get(pieces, F.lit(i)), "[^0-9]", "")
        return F.coalesce(digits.try_cast("int"), F.lit(0))

    return F.struct(
        part(0).alias("discharge"), part(1).alias("loading"), part(2).alias("shift")
    )


def total_workload(*parts: str) -> Column:
    parts = parts or ("discharge", "loading", "shift")
    total = F.coalesce(F.col(parts[0]), F.lit(0))
    for p in parts[1:]:
        total = total + F.coalesce(F.col(p), F.lit(0))
    return total


def business_key() -> Column:
    return F.concat_ws("_", "terminal_id", "mother_vessel", "sun_vessel", "eta_work_date")


_KEY_RUNGS = [
    ("MV_", "mother_vessel", "mother_vessel"),
    ("VN_", "vessel_name", "vessel_name"),
    ("SV_", "sun_vessel", "sun_vessel"),
    ("RT_", "route", "route"),
]


def gold_key() -> Column:
    """Identity of a call without its terminal, so that a terminal move stays the same call."""
    amounts = F.concat_ws(
        "_",
        F.coalesce(F.col("discharge").cast("string"), F.lit("0")),
        F.coalesce(F.col("loading").cast("string"), F.lit("0")),
    )
    rungs = [F.concat(F.lit(prefix), blank_to_null(name)) for prefix, name, _ in _KEY_RUNGS]
    weak = F.concat(F.lit("WEAK_"), blank_to_null("carrier"), F.lit("_"), amounts)
    unknown = F.concat(F.lit("UNKNOWN_"), amounts)
    day = F.coalesce(F.col("eta_work_date").cast("string"), F.lit("UNKNOWN_DATE"))
    return F.concat_ws("_", F.coalesce(*rungs, weak, unknown), day)


def gold_key_type() -> Column:
    kinds = [F.when(blank_to_null(name).isNotNull(), kind) for _, name, kind in _KEY_RUNGS]
    weak = F.when(blank_to_null("carrier").isNotNull(), "weak_carrier_workload")
    return F.coalesce(*kinds, weak, F.lit("unknown"))


def display_name() -> Column:
    names = [blank_to_null(c) for c in ("vessel_name", "mother_vessel", "sun_vessel")]
    carrier = F.coalesce(F.col("carrier"), F.lit("UNKNOWN"))
    return F.coalesce(*names, F.concat(F.lit(fv.UNKNOWN_VESSEL_PREFIX), carrier, F.lit(")")))


def yes_flag(c: Column | str) -> Column:
    return F.when(F.upper(_col(c)) == "Y", 1).otherwise(0)


def is_excluded_name(c: Column | str) -> Column:
    return F.coalesce(F.upper(_col(c)).rlike(fv.EXCLUDED_NAME_PATTERN), F.lit(False))


def is_cancelled(c: Column | str) -> Column:
    return F.coalesce(F.upper(_col(c)).isin(fv.CANCELLED_STATUS), F.lit(False))


def literal_map(values: dict) -> Column:
    """A small constant mapping as a map literal (plan-time size, no join)."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def terminal_number(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), r"terminal_(\d+)", 1).try_cast("int")


def terminal_name(c: Column | str) -> Column:
    """Id ('terminal_1'), number or digit text -> display name; unmapped values stay as they are."""
    text = F.lower(strip(_col(c).cast("string")))
    number = F.regexp_extract(text, r"^(?:terminal_)?([0-9]+)$", 1).try_cast("int")
    return F.coalesce(F.try_element_at(literal_map(fv.TERMINAL_NAMES), number), _col(c).cast("string"))


def safe_name(name: str) -> str:
    return name.translate({ord(ch): "_" for ch in fv.ILLEGAL_NAME_CHARS})
