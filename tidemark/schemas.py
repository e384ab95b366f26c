"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _fields(spec: dict[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in spec.items()])


MARKET = _fields(
    {
        "id": StringType(),
        "name": StringType(),
        "symbol": StringType(),
        "image": StringType(),
        "current_price": DoubleType(),
        "market_cap": DoubleType(),
        "total_volume": DoubleType(),
        "price_change_percentage_24h": DoubleType(),
        "market_cap_rank": IntegerType(),
        "high_24h": DoubleType(),
        "low_24h": DoubleType(),
        "circulating_supply": DoubleType(),
        "total_supply": DoubleType(),
        "max_supply": DoubleType(),
        "ath": DoubleType(),
        "atl": DoubleType(),
    }
)

CORRUPT = "_corrupt_record"
MARKET_WITH_CORRUPT = StructType(MARKET.fields + [StructField(CORRUPT, StringType(), True)])

# One row per attempt to fetch a snapshot: where the body landed, or why it failed.
FETCH_LOG = _fields(
    {
        "fetch_id": LongType(),
        "fetched_at": TimestampType(),
        "status": IntegerType(),
        "path": StringType(),
        "error": StringType(),
    }
)

SIGNUP_FIELDS = (
    "ftname",
    "ltname",
    "email",
    "Phonenumber",
    "address",
    "state",
    "spassword",
    "conpassword",
)
SIGNUP = _fields(
    {
        "submission_id": LongType(),
        "submitted_at": TimestampType(),
        **{name: StringType() for name in SIGNUP_FIELDS},
    }
)

CONTACT_FIELDS = ("firstname", "lastname", "mailid", "subject", "description")
CONTACT = _fields(
    {
        "submission_id": LongType(),
        "submitted_at": TimestampType(),
        **{name: StringType() for name in CONTACT_FIELDS},
    }
)

LOGIN = _fields({"attempt_id": LongType(), "email": StringType(), "pass": StringType()})

MEMBER = _fields(
    {
        "member_id": LongType(),
        "member_name": StringType(),
        "email": StringType(),
        "phone_number": StringType(),
        "address": StringType(),
        "state": StringType(),
        "selling_quantity": IntegerType(),
        "password_digest": StringType(),
    }
)
ADMIN = _fields({"email": StringType(), "password_digest": StringType()})
CONTACT_PAGE = _fields(
    {
        "name": StringType(),
        "mailid": StringType(),
        "subject": StringType(),
        "description": StringType(),
    }
)

SECTION = _fields(
    {
        "ord": IntegerType(),
        "section_id": StringType(),
        "offset_top": DoubleType(),
        "offset_height": DoubleType(),
    }
)
NAV_LINK = _fields({"ord": IntegerType(), "href": StringType()})
SCROLL = _fields(
    {
        "session_id": LongType(),
        "ts": TimestampType(),
        "event_id": LongType(),
        "scroll_y": DoubleType(),
    }
)

VIOLATION = _fields(
    {
        "rule": StringType(),
        "field": StringType(),
        "severity": StringType(),
        "message": StringType(),
    }
)
VIOLATIONS = ArrayType(VIOLATION)
