"""Masking of personal data.  Null stays null throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.functions.times import epoch_days_to_date_text

# The patterns a number or an address must match as a whole.
MOBILE_PATTERN = r"(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}"
EMAIL_PATTERN = r"[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_hex(c: Column | str) -> Column:
    return F.md5(_col(c))


def md5_hex_nonempty(c: Column | str) -> Column:
    """MD5, but an empty text stays empty."""
    return F.when(_col(c) == "", _col(c)).otherwise(F.md5(_col(c)))


def star_mask(c: Column | str) -> Column:
    """Keep the first character, star out the others."""
    text = _col(c)
    return F.concat(F.substring(text, 1, 1), F.regexp_replace(F.substring(text, 2, 2147483647), ".", "*"))


def _hash_if(c: Column | str, pattern: str) -> Column:
    return F.when(_col(c).rlike(rf"\A(?:{pattern})\z"), F.md5(_col(c)))


def phone_hash(c: Column | str) -> Column:
    """MD5 of a valid mobile number, null for anything else."""
    return _hash_if(c, MOBILE_PATTERN)


def email_hash(c: Column | str) -> Column:
    """MD5 of a valid e-mail address, null for anything else."""
    return _hash_if(c, EMAIL_PATTERN)


Mask = Callable[[Column], Column]

# Which column of which source table is masked how.
MASKING_POLICY: dict[str, dict[str, Mask]] = {
    "employee_info": {"password": md5_hex, "real_name": star_mask, "phone": phone_hash},
    "express_courier": {"working_phone": phone_hash},
    "truck_driver": {"license_no": md5_hex},
    "truck_info": {"truck_no": md5_hex, "device_gps_id": md5_hex, "engine_no": md5_hex},
    "truck_model": {"model_no": md5_hex},
    "user_address": {"phone": phone_hash},
    "user_info": {
        "passwd": md5_hex,
        "real_name": md5_hex_nonempty,
        "phone_num": phone_hash,
        "email": email_hash,
        "birthday": epoch_days_to_date_text,
    },
}


def mask_columns(columns: dict[str, Column], table: str, policy: dict[str, dict[str, Mask]] | None = None) -> list[Column]:
    """Select list of one known table with its masks applied."""
    masks = (MASKING_POLICY if policy is None else policy).get(table, {})
    return [(masks[name](c) if name in masks else c).alias(name) for name, c in columns.items()]


def mask_map(table: Column, row: Column, policy: dict[str, dict[str, Mask]] | None = None) -> Column:
    """Mask a ``MAP<STRING,STRING>`` row whose table is only known at run time.

    Absent keys stay absent: a mask is applied to the entries the row has.
    """
    policy = MASKING_POLICY if policy is None else policy
    fields: dict[Mask, list[str]] = {}
    for name, masks in policy.items():
        for column, mask in masks.items():
            fields.setdefault(mask, []).append(f"{name}.{column}")

    def masked(key: Column, value: Column) -> Column:
        field = F.concat_ws(".", table, key)
        out = value
        for mask, names in fields.items():
            out = F.when(field.isin(*names), mask(value)).otherwise(out)
        return out

    return F.transform_values(row, masked) if fields else row
