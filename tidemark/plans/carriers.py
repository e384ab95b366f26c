"""Inputs derived from the driver tables, which hold no market, form or scroll table.

Texts in ``*_SQL`` are valid in Spark and in ANSI SQL, so the SQL twins derive the very
same rows. Special cases (missing, blank, quoted, too long) are spread by key remainders
with coprime moduli, so that all rule branches meet each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleansing import digest
from tidemark.operators.attribution import section_intervals
from tidemark.schemas import NAV_LINK, SECTION

# --- market -----------------------------------------------------------------

SCALE_SQL = (
    "CAST(CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 "
    "WHEN 3 THEN 1000000000 ELSE 1000000000000 END AS DECIMAL(15,0))"
)
PRICE_SQL = "CAST(c_acctbal AS DECIMAL(20,2))"

# Amounts stay decimal until the last step, so both engines see the same number.
ASSET_AMOUNTS_SQL = {
    "current_price": PRICE_SQL,
    "high_24h": f"{PRICE_SQL} + 10",
    "low_24h": f"{PRICE_SQL} - 10",
    "circulating_supply": f"{PRICE_SQL} * {SCALE_SQL}",
    "total_supply": f"CASE WHEN c_custkey % 4 <> 0 THEN {PRICE_SQL} * {SCALE_SQL} END",
    "max_supply": f"CASE WHEN c_custkey % 9 = 0 THEN {PRICE_SQL} * 21000 END",
    "ath": f"{PRICE_SQL} * 1000",
    "atl": f"CAST({PRICE_SQL} * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(24,6))",
}
ASSET_TEXTS_SQL = {
    "id": "CAST(c_custkey AS STRING)",
    "name": "c_name",
    "symbol": "lower(c_mktsegment)",
    "image": "'https://img.example.com/' || CAST(c_custkey AS STRING) || '.png'",
}
HAS_CAP_SQL = "c_custkey % 5 <> 0"
CHANGE_SQL = "CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal / 1000.0E0 END"
RANK_SQL = "CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey + 1 AS INT) END"
QUOTE_SQL = "CASE WHEN c_nationkey % 5 = 0 THEN 'eur' ELSE 'usd' END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as assets; cap and volume from all their orders, null for some keys."""
    ordered = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("cap"),
            F.count("*").cast("double").alias("volume"),
        )
    )
    customers = table(spark, sf_dir, "customer")
    return customers.join(ordered, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        *[F.expr(sql).alias(name) for name, sql in ASSET_TEXTS_SQL.items()],
        F.expr(f"CASE WHEN {HAS_CAP_SQL} THEN cap END").alias("market_cap"),
        F.expr(f"CASE WHEN {HAS_CAP_SQL} THEN volume END").alias("total_volume"),
        F.expr(CHANGE_SQL).alias("price_change_percentage_24h"),
        F.expr(RANK_SQL).alias("market_cap_rank"),
        *[F.expr(sql).cast("double").alias(name) for name, sql in ASSET_AMOUNTS_SQL.items()],
        F.expr(QUOTE_SQL).alias("quote"),
    )


def stamped_events(spark: SparkSession, sf_dir: str, unit: str = "day") -> DataFrame:
    """Events with the snapshot they belong to."""
    return table(spark, sf_dir, "events").withColumn("snapshot_ts", F.date_trunc(unit, "ts"))


def snapshot_assets(stamped: DataFrame) -> DataFrame:
    """One asset row per user and snapshot: last value as price, sum of values as cap."""
    return (
        stamped.groupBy("snapshot_ts", "user_id")
        .agg(
            F.max_by(F.struct("value", "event_type"), F.struct("ts", "event_id")).alias("last"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("market_cap"),
            F.count("*").cast("double").alias("total_volume"),
        )
        .select(
            "snapshot_ts",
            F.col("user_id").cast("string").alias("id"),
            F.concat(F.lit("Asset "), F.col("user_id").cast("string")).alias("name"),
            F.col("last.event_type").alias("symbol"),
            F.col("last.value").alias("current_price"),
            "market_cap",
            "total_volume",
            (F.col("last.value") - 50.0).alias("price_change_percentage_24h"),
        )
    )


# Fetches in the order they land: week of the body, hours after the week's start at which it was
# fetched, and what became of it. The sixth is an old one that comes late.
FETCHES = (
    (1, 0, "good"), (1, 24, "refused"), (1, 48, "offline"), (2, 0, "good"), (2, 24, "empty"),
    (1, 72, "good"), (3, 0, "good"), (3, 24, "missing"), (4, 0, "good"), (5, 0, "broken"),
)
# Records of the broken body that are cut off, and assets selected from the first week.
CUT_SQL = "CAST(id AS BIGINT) % 7 = 0"
SELECTED_SQL = "CAST(id AS BIGINT) % 3 = 0"


# --- identity ---------------------------------------------------------------

EMAIL_SQL = "lower(replace(c_name, '#', '.')) || '@example.com'"
# Every third secret is the same one: the hot key.
SECRET_SQL = (
    "CASE WHEN c_custkey % 3 = 0 THEN 'shared' ELSE CAST(c_nationkey AS STRING) || ':' || "
    "c_mktsegment || ':' || CAST(CAST(floor(c_custkey / 20) AS BIGINT) AS STRING) END"
)
ADMIN_EMAIL_SQL = "lower(replace(s_name, '#', '.')) || '@example.com'"
ADMIN_SECRET_SQL = "'admin' || CAST(s_suppkey AS STRING)"

# Attempts: a third aim at one account, a fifth at admins, a seventh with a wrong secret.
ATTEMPT_EMAIL_SQL = (
    "CASE WHEN o_orderkey % 3 = 1 THEN 'Customer.000000000@Example.com' "
    "WHEN o_orderkey % 5 = 0 THEN 'supplier.00000000' || CAST(o_orderkey % 10 AS STRING) "
    f"|| '@example.com' WHEN o_orderkey % 31 = 0 THEN NULL ELSE {EMAIL_SQL} END"
)
ATTEMPT_SECRET_SQL = (
    "CASE WHEN o_orderkey % 7 = 0 THEN 'wrong' WHEN o_orderkey % 3 <> 1 AND "
    "o_orderkey % 5 = 0 THEN 'admin' || CAST(o_orderkey % 10 AS STRING) "
    f"ELSE {SECRET_SQL} END"
)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("candidate_id"),
        F.expr(EMAIL_SQL).alias("email"),
        digest(SECRET_SQL).alias("secret_digest"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other customer is a member."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_custkey % 2 = 0")
        .select(
            F.col("c_custkey").alias("member_id"),
            F.expr(EMAIL_SQL).alias("email"),
            digest(SECRET_SQL).alias("password_digest"),
        )
    )


def admins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.expr(ADMIN_EMAIL_SQL).alias("email"),
        digest(ADMIN_SECRET_SQL).alias("password_digest"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("attempt_id"),
        F.expr(ATTEMPT_EMAIL_SQL).alias("email"),
        F.expr(ATTEMPT_SECRET_SQL).alias("pass"),
    )


# Candidates that come one after another: both keys repeat, independently of the order.
QUEUE_EMAIL_SQL = (
    "CAST(c_nationkey AS STRING) || ':' || CAST(CAST(floor(c_acctbal / 40) AS BIGINT) AS STRING)"
)
QUEUE_SECRET_SQL = (
    "c_mktsegment || ':' || CAST(CAST(floor(c_acctbal * 100) AS BIGINT) % 500 AS STRING)"
)


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("candidate_id"),
        F.expr(QUEUE_EMAIL_SQL).alias("email"),
        digest(QUEUE_SECRET_SQL).alias("secret_digest"),
    )


# --- forms ------------------------------------------------------------------

_GOOD_SECRET = "'Passw0rd!' || CAST(c_custkey AS STRING)"
_SECRET_CASES = (
    "CASE c_custkey % 37 WHEN 1 THEN NULL WHEN 2 THEN '0' WHEN 3 THEN 'Sh0rt!' "
    "WHEN 4 THEN 'alllower1!' WHEN 5 THEN 'ALLUPPER1!' WHEN 6 THEN 'NoDigits!' "
    "WHEN 7 THEN 'NoSpecial1' WHEN 8 THEN 'Quo''teAbc' WHEN 9 THEN 'Aa1&&' "
    "WHEN 10 THEN '   ' "
    f"WHEN 11 THEN 'Bs1' || chr(92) || chr(92) || 'xyzw' ELSE {_GOOD_SECRET} END"
)
SIGNUP_SQL = {
    "ftname": (
        "CASE c_custkey % 43 WHEN 1 THEN NULL WHEN 2 THEN '0' WHEN 3 THEN '   ' "
        "WHEN 4 THEN 'O''Brien' WHEN 5 THEN ' Ann-Marie ' WHEN 6 THEN 'R2D2' "
        "WHEN 7 THEN '<b>Eve</b>' WHEN 8 THEN 'Lu' || chr(92) || 'cy' ELSE 'Maria' END"
    ),
    "ltname": (
        "CASE c_custkey % 29 WHEN 1 THEN '' WHEN 2 THEN 'de la Cruz' WHEN 3 THEN chr(201) || 'clair' "
        "WHEN 4 THEN chr(9) || 'Stone' || chr(10) ELSE 'Rivers' END"
    ),
    "email": (
        "CASE c_custkey % 31 WHEN 1 THEN NULL WHEN 2 THEN 'no-at-sign' "
        "WHEN 3 THEN 'a&b@example.com' WHEN 4 THEN 'a..b@example.com' "
        "WHEN 5 THEN 'user@localhost' WHEN 6 THEN 'user@example.1' "
        "WHEN 7 THEN repeat('x', 65) || '@example.com' WHEN 8 THEN 'a@' || repeat('b', 64) || '.com' "
        "ELSE replace(c_name, '#', '.') || '@Example.com' END"
    ),
    "Phonenumber": (
        "CASE c_custkey % 23 WHEN 1 THEN NULL WHEN 2 THEN lpad(CAST(c_custkey AS STRING), 9, '0') "
        "WHEN 3 THEN lpad(CAST(c_custkey AS STRING), 11, '0') WHEN 4 THEN '12345abcde' "
        "ELSE ' ' || lpad(CAST(c_custkey AS STRING), 10, '0') END"
    ),
    "address": (
        "CASE c_custkey % 19 WHEN 1 THEN NULL WHEN 2 THEN repeat(c_name, 6) "
        "ELSE '\"' || c_name || '\" & Sons' END"
    ),
    "state": (
        "CASE c_custkey % 17 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'Select an option' "
        "WHEN 4 THEN 'Elsewhere' WHEN 5 THEN 'Karnataka' ELSE 'Kerala' END"
    ),
    "spassword": _SECRET_CASES,
    "conpassword": (
        "CASE c_custkey % 13 WHEN 1 THEN NULL WHEN 2 THEN 'Different1!' "
        f"ELSE {_SECRET_CASES} END"
    ),
}
# Sign-ups that come in waves: everybody tries once, and most try again one or two waves later,
# some with another email and all with a secret that somebody else gives first.
WAVES = 4
_AGAIN_WAVE = "c_custkey % 4 + 1 + c_custkey % 2"
_AGAIN_SECRET = "'Passw0rd!' || CAST(c_custkey + 8 AS STRING)"
_AGAIN_SQL = {
    **SIGNUP_SQL,
    "email": f"CASE WHEN c_custkey % 5 = 0 THEN 'again.' || CAST(c_custkey AS STRING) "
    f"|| '@example.com' ELSE {SIGNUP_SQL['email']} END",
    "spassword": _AGAIN_SECRET,
    "conpassword": _AGAIN_SECRET,
}


def signup_waves_sql(customer: str = "customer") -> str:
    """All tries with their wave; later waves have larger ids."""

    def tries(wave: str, fields: dict[str, str]) -> str:
        listed = ", ".join(f"{sql} AS {name}" for name, sql in fields.items())
        return (
            f"SELECT {wave} AS wave, ({wave}) * 1000000000 + c_custkey AS submission_id, {listed} "
            f"FROM {customer} WHERE {wave} < {WAVES}"
        )

    return f"{tries('c_custkey % 4', SIGNUP_SQL)} UNION ALL {tries(_AGAIN_WAVE, _AGAIN_SQL)}"


KNOWN_EMAIL_SQL = "lower(replace(c_name, '#', '.') || '@example.com')"
KNOWN_SECRET_SQL = _GOOD_SECRET
KNOWN_SQL = "c_custkey % 4 = 0"

CONTACT_SQL = {
    "firstname": (
        "CASE (conv_id * 7 + turn) % 23 WHEN 1 THEN NULL WHEN 2 THEN 'J4ne' ELSE role END"
    ),
    "lastname": (
        "CASE (conv_id * 5 + turn) % 19 WHEN 1 THEN '' WHEN 2 THEN 'O''Neil' ELSE ' Field ' END"
    ),
    "mailid": (
        "CASE (conv_id + turn) % 17 WHEN 1 THEN '0' WHEN 2 THEN 'broken@' "
        "ELSE 'Conv.' || CAST(conv_id AS STRING) || '@Example.com' END"
    ),
    "subject": (
        "CASE (conv_id * 3 + turn) % 13 WHEN 1 THEN NULL WHEN 2 THEN '12345' ELSE text END"
    ),
    "description": (
        "CASE (conv_id + turn) % 11 WHEN 1 THEN NULL WHEN 2 THEN '0' "
        "ELSE '<i>' || replace(text, '. ', '.' || chr(92) || ' \"') || '</i> ' END"
    ),
}
CONTACT_ID_SQL = "conv_id * 1000 + turn"


def signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("submission_id"),
        *[F.expr(sql).alias(name) for name, sql in SIGNUP_SQL.items()],
    )


def signup_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(signup_waves_sql("{customer}"), customer=table(spark, sf_dir, "customer"))


def known_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that some of the sign-ups collide with."""
    return (
        table(spark, sf_dir, "customer")
        .filter(KNOWN_SQL)
        .select(
            F.col("c_custkey").alias("member_id"),
            F.lit("Known Member").alias("member_name"),
            F.expr(KNOWN_EMAIL_SQL).alias("email"),
            F.lit(None).cast("string").alias("phone_number"),
            F.lit(None).cast("string").alias("address"),
            F.lit(None).cast("string").alias("state"),
            F.lit(None).cast("int").alias("selling_quantity"),
            digest(KNOWN_SECRET_SQL).alias("password_digest"),
        )
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.expr(CONTACT_ID_SQL).alias("submission_id"),
        *[F.expr(sql).alias(name) for name, sql in CONTACT_SQL.items()],
    )


# Whole page texts with slashes, quotes and blanks added all over.
DIRTY_HTML_SQL = (
    "chr(9) || ' ' || replace(replace(replace(html, '</', '<' || chr(92) || '/'), "
    "'=\"', '=' || chr(92) || ''''), '<p', chr(92) || chr(92) || '<p') || ' ' || chr(11) || chr(10)"
)
# Whole texts between Unicode blanks.
PADDED_TEXT_SQL = "'\u00a0\u2003 ' || text || '\u3000\ufeff\t'"

# --- positions --------------------------------------------------------------

# The page's sections and links in document order, overlapping once.
SECTIONS = (
    (1, "home", 150.0, 10.0),
    (2, "about", 160.0, 20.0),
    (3, "services", 175.0, 35.0),
    (4, "portfolio", 210.0, 50.0),
    (5, "contact", 260.0, 90.0),
)
LINKS = ((1, "#home"), (2, "#about"), (3, "#services"), (4, "#portfolio"), (5, "#contact"))


def sections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTIONS, SECTION)


def sections_as_intervals(spark: SparkSession) -> DataFrame:
    return section_intervals(sections(spark))


def links(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LINKS, NAV_LINK)


def as_scroll(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("session_id"), "ts", "event_id", F.col("value").alias("scroll_y")
    )


# A pause of more than a day ends a visit.
VISIT_PAUSE = 86_400


def scroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scroll positions, a session per user."""
    return as_scroll(table(spark, sf_dir, "events"))


# A long section list whose overlap does not grow with its length.
LONG_SECTIONS_SQL = {
    "ord": "CAST(p_partkey AS INT)",
    "section_id": "'s' || CAST(p_partkey AS STRING)",
    "lo": "CAST(p_partkey AS DOUBLE)",
    "hi": "CAST(p_partkey + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 + p_size % 5 END AS DOUBLE)",
}
LONG_SCROLL_SQL = "event_id * 0.2E0 + value - 20.0E0"


def long_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third section has no length, which leaves gaps."""
    parts = table(spark, sf_dir, "part")
    return parts.select(*[F.expr(sql).alias(name) for name, sql in LONG_SECTIONS_SQL.items()])
