"""Keys, hashes and small mappings as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Model by the first two letters of a device id, and place on the body by device type.
MODELS = {"SW": "Watch", "CS": "Chest Strap", "SR": "Sleep Ring", "GM": "Glucose Monitor"}
ZONES = {"smartwatch": "wrist", "chest_strap": "chest", "sleep_ring": "finger", "glucose_monitor": "abdomen"}
#: Medication by prefix of its national drug code.
NDC_PREFIXES = {"00093-7": "metformin", "00093-52": "lisinopril", "00113-0": "albuterol", "00093-8": "atorvastatin", "68180-03": "sertraline", "68180-05": "omeprazole"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """60 bits of the SHA-256 of the parts joined by a bar; null if any part is null, so that unknown keys never meet."""
    cols = [_col(p).cast("string") for p in parts]
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    digest = F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, 15)
    return F.when(known, F.conv(digest, 16, 10).cast("long"))


def person_key(identifier: Column | str) -> Column:
    """SHA-256 of the normalised identifier; also the mask of a personal identifier."""
    return F.sha2(F.lower(F.trim(_col(identifier))), 256)


def row_hash(*parts: Column | str) -> Column:
    """Change-detection hash: nulls count as empty."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]), 256)


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_of_string(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "-", "").try_cast("int")


def time_key(c: Column | str) -> Column:
    """HHMM as an integer."""
    return (F.hour(_col(c)) * 100 + F.minute(_col(c))).cast("int")


def key_to_date(c: Column | str) -> Column:
    return F.to_date(_col(c).cast("string"), "yyyyMMdd")


def age_group(birth_year: Column | str, as_of_year: int) -> Column:
    age = F.lit(as_of_year) - _col(birth_year)
    return F.when(age.isNull(), "Unknown").when(age < 18, "0-17").when(age < 35, "18-34").when(age < 50, "35-49").when(age < 65, "50-64").otherwise("65+")


def first_word(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(c), r"^(\w+)", 1))


def mapped(c: Column, table: dict[str, str], default: str) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(c == k, v)
    return out.otherwise(default)


def device_model(device_id: Column | str) -> Column:
    return mapped(F.substring(_col(device_id), 1, 2), MODELS, "Unknown")


def body_zone(device_type: Column | str) -> Column:
    return mapped(_col(device_type), ZONES, "unknown")


def drug_of_ndc(ndc: Column | str) -> Column:
    """Medication of the longest matching code prefix, null without one."""
    out = F
    for prefix in sorted(NDC_PREFIXES, key=len, reverse=True):
        out = out.when(_col(ndc).startswith(prefix), NDC_PREFIXES[prefix])
    return out
