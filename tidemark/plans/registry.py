"""The registered queries: name -> (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cleansing, formatting as fmt, rules
from tidemark.operators import attribution, identity, intake, market
from tidemark.plans import carriers as c
from tidemark.schemas import CONTACT, LOGIN, MARKET, SIGNUP
from tidemark.session import work_dir
from tidemark.sources import readers, sinks
from tidemark.streaming.form_intake import ContactIntake, SignupIntake
from tidemark.streaming.market_refresh import MarketRefresh
from tidemark.streaming.section_tracking import SectionTracking
from tidemark.streaming.visits import VisitTracking

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEARCH_TEXT = "\u00a0 HouseHold\ufeff"
BLANK_TEXT = " \u3000\t"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- market -----------------------------------------------------------------


@query
def market_kpis(spark, sf):
    return market.kpis(c.assets(spark, sf))


@query
def market_top20(spark, sf):
    return market.table_view(market.market_page(c.assets(spark, sf)))


@query
def market_page2(spark, sf):
    return market.card_view(market.market_page(c.assets(spark, sf), page=2))


@query
def market_deep_page(spark, sf):
    """A page cut by rank, as pages far down are."""
    page = market.deep_page(c.assets(spark, sf), page=5)
    return page.select("id", "name", "market_cap")


@query
def market_rank(spark, sf):
    unranked = c.assets(spark, sf).select("id", "market_cap")
    return market.with_rank(unranked)


@query
def market_search(spark, sf):
    return market.search(c.assets(spark, sf), SEARCH_TEXT).select("id", "name", "symbol")


@query
def market_search_literal(spark, sf):
    """``#`` and digits as they are; ``_`` and ``%`` would be no wildcards either."""
    return market.search(c.assets(spark, sf), "R#00000001").select("id", "name", "symbol")


@query
def market_search_blank(spark, sf):
    return market.search(c.assets(spark, sf), BLANK_TEXT).select("id", "name", "symbol")


@query
def market_find(spark, sf):
    return market.find_asset(c.assets(spark, sf), "42").select("id", "name", "current_price")


@query
def market_quote(spark, sf):
    return market.kpis(market.in_quote(c.assets(spark, sf)))


@query
def market_direction(spark, sf):
    return c.assets(spark, sf).select(
        "id",
        F.expr(market.CHANGE_OR_ZERO).alias("change"),
        market.direction().alias("direction"),
    )


@query
def market_table(spark, sf):
    return market.table_view(c.assets(spark, sf))


@query
def market_cards(spark, sf):
    return market.card_view(c.assets(spark, sf))


@query
def market_detail_long(spark, sf):
    return market.detail_rows(c.assets(spark, sf))


@query
def market_status(spark, sf):
    assets = c.assets(spark, sf)
    runs = [
        ("found", market.status(assets, SEARCH_TEXT)),
        ("nothing", market.status(assets, "no such asset")),
        ("failed", market.status(assets, SEARCH_TEXT, "Request failed with status 503.")),
    ]
    named = [df.select(F.lit(name).alias("run"), "*") for name, df in runs]
    return named[0].unionByName(named[1]).unionByName(named[2])


# --- formatting -------------------------------------------------------------

MONEY_SQL = (
    "CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_totalprice AS DECIMAL(20,2)) * "
    "CAST(CASE o_orderkey % 8 WHEN 0 THEN 0.000001 WHEN 1 THEN 0.0001 WHEN 2 THEN -0.01 "
    "WHEN 3 THEN 1 WHEN 4 THEN 1000 WHEN 5 THEN 1000000 WHEN 6 THEN 1000000000 "
    "ELSE 0.001 END AS DECIMAL(16,6)) END"
)
NUMBER_SQL = (
    "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0137 AS DECIMAL(5,4)) - l_linenumber * 100"
)
PERCENT_SQL = "(l_extendedprice - 30000.0E0) / 977.0E0"
TIE_SQL = "(l_quantity - 25.0E0) / 8.0E0"
FRESH_SQL = "CASE WHEN event_id % 10 <> 0 THEN ts END"


@query
def fmt_compact_currency(spark, sf):
    amounts = c.table(spark, sf, "orders").select(
        "o_orderkey", F.expr(MONEY_SQL).cast("double").alias("amount")
    )
    return amounts.select("o_orderkey", fmt.format_compact_currency("amount").alias("text"))


@query
def fmt_percent(spark, sf):
    changes = c.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr(PERCENT_SQL).alias("change"),
        F.expr(TIE_SQL).alias("tie"),
    )
    return changes.select(
        "l_orderkey",
        "l_linenumber",
        fmt.format_percent("change").alias("text"),
        fmt.format_percent("tie").alias("tie_text"),
    )


@query
def fmt_number(spark, sf):
    numbers = c.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(NUMBER_SQL).cast("double").alias("number")
    )
    return numbers.select(
        "l_orderkey", "l_linenumber", fmt.format_number("number").alias("text")
    )


@query
def fmt_supply(spark, sf):
    return c.assets(spark, sf).select(
        "id",
        fmt.format_supply("circulating_supply", "symbol").alias("circulating"),
        fmt.format_supply("max_supply", "symbol").alias("maximum"),
    )


@query
def fmt_rank(spark, sf):
    return c.assets(spark, sf).select(
        "id",
        fmt.rank_text_detail("market_cap_rank").alias("detail"),
        fmt.rank_text_table("market_cap_rank").alias("in_table"),
    )


@query
def fmt_time(spark, sf):
    return c.table(spark, sf, "events").select(
        "event_id", fmt.refresh_time_text(FRESH_SQL).alias("text")
    )


@query
def cn_join(spark, sf):
    urgent = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END"
    kind = "CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END"
    return c.table(spark, sf, "orders").select(
        "o_orderkey", fmt.join_present("'order'", urgent, kind).alias("text")
    )


# --- cleansing and rules ----------------------------------------------------


@query
def cleanse_text(spark, sf):
    dirty = c.table(spark, sf, "pages").selectExpr("page_id", f"{c.DIRTY_HTML_SQL} AS dirty")
    return dirty.select(
        "page_id",
        cleansing.clean_input("dirty").alias("text"),
        cleansing.clean_input("dirty", escape_single_quote=False).alias("text_old_quotes"),
    )


@query
def search_terms(spark, sf):
    return c.table(spark, sf, "documents").select(
        "doc_id", cleansing.search_normalise(c.PADDED_TEXT_SQL).alias("text")
    )


def _judged(spark, sf, **options):
    return intake.judge_signups(c.signups(spark, sf), c.known_members(spark, sf), **options)


@query
def signup_violations(spark, sf):
    return _judged(spark, sf).select(
        "submission_id", rules.rule_text().alias("broken"), "accepted"
    )


@query
def signup_violations_strict(spark, sf):
    judged = _judged(spark, sf, mode=rules.STRICT, match_rule=identity.ANY)
    return judged.select(
        "submission_id", rules.rule_text().alias("broken"), "accepted"
    )


@query
def signup_accepted(spark, sf):
    accepted, _ = sinks.split_outcome(_judged(spark, sf))
    return sinks.member_rows(accepted)


@query
def signup_rejects(spark, sf):
    _, rejected = sinks.split_outcome(_judged(spark, sf))
    return intake.signup_texts(rejected, "submission_id")


@query
def contact_messages(spark, sf):
    judged = intake.judge_contacts(c.contacts(spark, sf))
    return judged.select("submission_id", "accepted", intake.contact_text())


@query
def contact_accepted(spark, sf):
    accepted, _ = sinks.split_outcome(intake.judge_contacts(c.contacts(spark, sf)))
    return sinks.contact_rows(accepted)


@query
def login_warnings(spark, sf):
    judged = intake.judge_logins(c.attempts(spark, sf))
    return judged.select(
        "attempt_id", rules.rule_text().alias("broken"), "email"
    )


# --- identity ---------------------------------------------------------------


@query
def dup_or_join(spark, sf):
    counted = identity.with_match_counts(c.candidates(spark, sf), c.members(spark, sf))
    return counted.select(
        "candidate_id", "n_matches", identity.is_duplicate().alias("duplicate")
    )


@query
def dup_any(spark, sf):
    counted = identity.with_match_counts(c.candidates(spark, sf), c.members(spark, sf))
    return counted.filter(identity.is_duplicate(identity.ANY)).select("candidate_id")


@query
def admit_new(spark, sf):
    admitted = identity.admit_new(c.candidates(spark, sf), c.members(spark, sf))
    return admitted.select("candidate_id", "email")


@query
def admit_new_any(spark, sf):
    admitted = identity.admit_new(c.candidates(spark, sf), c.members(spark, sf), identity.ANY)
    return admitted.select("candidate_id", "email")


@query
def admit_in_order(spark, sf):
    return identity.admit_in_order(c.queue(spark, sf)).select("candidate_id")


def _audited(spark, sf, attempts):
    judged = identity.login_outcome(
        intake.judge_logins(attempts), c.members(spark, sf), c.admins(spark, sf)
    )
    return judged.select("attempt_id", "outcome")


@query
def login_audit(spark, sf):
    return _audited(spark, sf, c.attempts(spark, sf))


@query
def login_audit_files(spark, sf):
    """Attempts written as form records and read back under their schema."""
    path = work_dir(spark, "attempts")
    c.attempts(spark, sf).write.json(path)
    return _audited(spark, sf, readers.read_forms(spark, path, LOGIN))


@query
def first_per_key(spark, sf):
    orders = c.table(spark, sf, "orders")
    return identity.first_per_key(
        orders, "o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"
    )


# --- positions --------------------------------------------------------------


def _sectioned(spark, sf):
    return attribution.with_section(c.scroll(spark, sf), c.sections_as_intervals(spark).collect())


@query
def section_range_join(spark, sf):
    return _sectioned(spark, sf).select("event_id", "scroll_y", "section_id")


@query
def section_range_join_long(spark, sf):
    """Against a table of sections, by a sweep."""
    events = c.table(spark, sf, "events").select(
        "event_id", F.expr(c.LONG_SCROLL_SQL).alias("scroll_y")
    )
    found = attribution.with_section(events, c.long_sections(spark, sf))
    return found.select("event_id", "section_id")


@query
def section_carry_forward(spark, sf):
    carried = attribution.carry_section(_sectioned(spark, sf))
    return carried.select("session_id", "event_id", "active_section")


@query
def section_carry_forward_hot(spark, sf):
    """All events as one session, in as many chunks as there are shuffle partitions."""
    one = _sectioned(spark, sf).withColumn("session_id", F.lit(0).cast("long"))
    carried = attribution.carry_section(one)
    return carried.select("event_id", "active_section")


@query
def sticky_flag(spark, sf):
    return c.scroll(spark, sf).select("event_id", attribution.is_sticky().alias("sticky"))


@query
def nav_lookup(spark, sf):
    carried = attribution.carry_section(_sectioned(spark, sf))
    linked = attribution.with_link(carried, c.links(spark).collect())
    return linked.select("event_id", "active_section", "href")


@query
def nav_lookup_long(spark, sf):
    """Page addresses as link targets, looked up by document language."""
    pages = c.table(spark, sf, "pages").select(
        F.col("page_id").cast("int").alias("ord"), F.col("url").alias("href")
    )
    wanted = c.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("/"), F.col("lang"), F.lit("/")).alias("wanted")
    )
    linked = attribution.link_by_substring(wanted, pages, section="wanted")
    return linked.select("doc_id", "href")


# --- snapshots --------------------------------------------------------------


@query
def latest_snapshot(spark, sf):
    newest = market.latest_snapshot(c.stamped_events(spark, sf))
    return c.snapshot_assets(newest).select("id", "current_price", "market_cap", "total_volume")


@query
def kpis_per_snapshot(spark, sf):
    return market.kpis(c.snapshot_assets(c.stamped_events(spark, sf)), "snapshot_ts")


@query
def selection_retained(spark, sf):
    """Assets selected in the first snapshot, refreshed from the newest one."""
    stamped = c.stamped_events(spark, sf)
    first = stamped.agg(F.min("snapshot_ts")).scalar()
    selected = c.snapshot_assets(stamped.filter(F.col("snapshot_ts") == first))
    newest = c.snapshot_assets(market.latest_snapshot(stamped))
    kept = market.retain_selected(selected, newest)
    return kept.select("id", "snapshot_ts", "current_price", "market_cap", "total_volume")


# --- sources, sinks and streams ---------------------------------------------


@query
def market_json_source(spark, sf):
    """Snapshot written as JSON lines and read back under the explicit schema."""
    path = work_dir(spark, "snapshot")
    rows = c.assets(spark, sf).select(*MARKET.names)
    rows.write.json(path)
    return market.kpis(readers.read_market(spark, path, array_files=False))


@query
def stream_latest_snapshot(spark, sf):
    """Weekly snapshots land one after another; the shown table is the newest one."""
    root = work_dir(spark, "refresh")
    weekly = c.snapshot_assets(c.stamped_events(spark, sf, "week"))
    weekly.withColumn("taken", F.date_format("snapshot_ts", "yyyyMMdd")).drop(
        "snapshot_ts"
    ).write.partitionBy("taken").json(f"{root}/bodies")
    taken = c.stamped_events(spark, sf, "week").select("snapshot_ts").distinct()
    day = F.date_format("snapshot_ts", "yyyyMMdd")
    log = taken.select(
        day.cast("long").alias("fetch_id"),
        F.col("snapshot_ts").cast("timestamp").alias("fetched_at"),
        F.lit(200).alias("status"),
        F.concat(F.lit(f"{root}/bodies/taken="), day).alias("path"),
        day.alias("taken"),
    )
    log.write.partitionBy("taken").json(f"{root}/log")
    job = MarketRefresh(spark, f"{root}/market", array_files=False)
    job.start(f"{root}/log", every_seconds=None).awaitTermination()
    return job.current().select("id", "current_price", "market_cap", "total_volume")


def _land_fetches(spark, sf, root):
    """The weekly bodies, and the fetches of ``carriers.FETCHES`` one after another."""
    weekly = c.snapshot_assets(c.stamped_events(spark, sf, "week"))
    stamps = [r[0] for r in weekly.select("snapshot_ts").distinct().orderBy("snapshot_ts").collect()]

    def rows_of(week):
        return weekly.filter(F.col("snapshot_ts") == F.lit(stamps[week - 1])).drop("snapshot_ts")

    for n, (week, hours, kind) in enumerate(c.FETCHES):
        path = f"{root}/bodies/{n}"
        if kind == "good":
            rows_of(week).write.json(path)
        elif kind == "empty":
            rows_of(week).filter("false").write.json(path)
        elif kind == "broken":
            line = F.to_json(F.struct("*"))
            cut = F.when(F.expr(c.CUT_SQL), F.substring(line, 1, 15)).otherwise(line)
            rows_of(week).select(cut.alias("value")).write.text(path)
        fetch = spark.range(1).select(
            F.lit(n).cast("long").alias("fetch_id"),
            F.lit(stamps[week - 1] + timedelta(hours=hours)).cast("timestamp").alias("fetched_at"),
            F.lit(503 if kind == "refused" else 200).alias("status"),
            F.lit(path).alias("path"),
            F.lit("no network" if kind == "offline" else None).cast("string").alias("error"),
        )
        fetch.coalesce(1).write.mode("append").json(f"{root}/log")
    return rows_of(1)


@query
def stream_refresh_faults(spark, sf):
    """Ten fetches, a batch each, of which four are shown: what is shown at the end with its stamp
    and KPIs, the kept selection, what became of each batch, and unreadable records."""
    root = work_dir(spark, "faults")
    first = _land_fetches(spark, sf, root)
    job = MarketRefresh(spark, f"{root}/market", array_files=False)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in MARKET.fields
               if f.name not in first.columns]
    job.select(first.filter(c.SELECTED_SQL).select("*", *missing))
    job.start(f"{root}/log", every_seconds=None).awaitTermination()

    def told(rows, kind, key, amount, at="NULL", text="NULL"):
        return rows.selectExpr(
            f"'{kind}' AS kind", f"CAST({key} AS STRING) AS key", f"CAST({amount} AS DOUBLE) AS amount",
            f"CAST({at} AS TIMESTAMP_NTZ) AS at", f"CAST({text} AS STRING) AS text",
        )

    became = "CASE WHEN good THEN 'shown' ELSE coalesce(error, 'not newer') END"
    parts = [
        told(job.current(), "asset", "id", "market_cap", "fetched_at"),
        told(job.current_kpis(), "kpi", "gainers_text", "cap_total", text="cap_text"),
        told(job.selected(), "selected", "id", "market_cap"),
        told(job.status(), "batch", "batch_id", "asset_count", "fetched_at", became),
        told(job.quarantined().groupBy().count(), "unreadable", "'records'", "count"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def stream_signup(spark, sf):
    root = work_dir(spark, "signups")
    c.signups(spark, sf).write.json(f"{root}/in")
    job = SignupIntake(spark, root, c.known_members(spark, sf))
    arriving = readers.stream_forms(spark, f"{root}/in", SIGNUP)
    job.start(arriving).awaitTermination()
    return job.accepted()


@query
def stream_signup_waves(spark, sf):
    """Sign-ups in four batches, each against those accepted before; every wave restarts the job."""
    root = work_dir(spark, "waves")
    waves = c.signup_waves(spark, sf)
    job = SignupIntake(
        spark, root, c.known_members(spark, sf), match_rule=identity.ANY, one_by_one=True
    )
    for wave in range(c.WAVES):
        waves.filter(f"wave = {wave}").drop("wave").write.mode("append").json(f"{root}/in")
        job.start(readers.stream_forms(spark, f"{root}/in", SIGNUP)).awaitTermination()
    return job.accepted()


@query
def stream_contact(spark, sf):
    root = work_dir(spark, "contacts")
    c.contacts(spark, sf).write.json(f"{root}/in")
    job = ContactIntake(spark, root)
    arriving = readers.stream_forms(spark, f"{root}/in", CONTACT)
    job.start(arriving).awaitTermination()
    return job.accepted()


@query
def stream_sections(spark, sf):
    schema = c.table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    job = SectionTracking(spark, work_dir(spark, "sections"), c.sections_as_intervals(spark).collect())
    job.start(c.as_scroll(events)).awaitTermination()
    return job.active()


@query
def stream_visits(spark, sf):
    """A month of scroll events in five weekly batches, sessions parted by pauses of a day."""
    root = work_dir(spark, "visits")
    events = c.scroll(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    week = F.date_trunc("week", "ts")
    for (one,) in events.select(week).distinct().orderBy(week).toLocalIterator():
        # Each week is two files, and two files are a batch.
        part = events.filter(week == F.lit(one)).repartition(2)
        part.write.mode("append").parquet(f"{root}/in")
    arriving = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{root}/in")
    )
    job = VisitTracking(
        spark, f"{root}/out", c.sections_as_intervals(spark).collect(), c.VISIT_PAUSE
    )
    job.start(arriving).awaitTermination()
    start = F.col("visit_start").cast("timestamp_ntz").alias("visit_start")
    return job.active().select("event_id", "session_id", start, "active_section")
