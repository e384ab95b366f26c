"""Position attribution: which section a scroll position lies in, and which link that marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sqltext import case, quoted
from tidemark.operators.key_filter import may_be_in
from tidemark.operators.lookup import lookup
from tidemark.operators.ordering import carry_forward, global_row_number
from tidemark.session import cut_lineage

# Lead of a section before its top, the sticky threshold, the first active link.
LEAD = 150
STICKY_AFTER = 100
FIRST_ACTIVE = "home"


def section_intervals(sections: DataFrame) -> DataFrame:
    """Half-open interval per section: from its top less the lead, as long as its height."""
    lo = F.col("offset_top") - LEAD
    return sections.select(
        "ord", "section_id", lo.alias("lo"), (lo + F.col("offset_height")).alias("hi")
    )


def with_section(
    events: DataFrame,
    sections: DataFrame | list,
    y: str = "scroll_y",
    name: str = "section_id",
) -> DataFrame:
    """Section each position lies in; of overlapping ones the last in document order.

    A list of rows, such as a page's few sections, becomes one expression: no join and no
    shuffle. A table is swept for disjoint pieces. Both give the same.
    """
    if isinstance(sections, DataFrame):
        return section_by_sweep(events, sections, y, name)
    listed = sorted(sections, key=lambda row: row["ord"])
    return events.withColumn(name, _section_expression(listed, y))


def _section_expression(sections: list, y: str) -> Column:
    """The last section of the document is asked first, so that it wins."""

    def number(value: float) -> str:
        return f"CAST('{value!r}' AS DOUBLE)"

    hits = [
        (f"{y} >= {number(row['lo'])} AND {y} < {number(row['hi'])}", quoted(row["section_id"]))
        for row in reversed(sections)
    ]
    return F.expr(case(hits, "NULL") if hits else "CAST(NULL AS STRING)")


def disjoint_pieces(sections: DataFrame) -> DataFrame:
    """``(at, section_id)``: from each end point on, up to the next one, the last section in
    document order that covers it, or null.

    The end points are numbered; a section covers a range of numbers, which is a union of
    aligned blocks, two of each size at most. A block keeps the last of the sections that
    fill it, and a piece asks the blocks it lies in, one of each size. So however many sections lie
    on one place, each costs a few narrow rows, reduced before the shuffle.
    """
    real = sections.where("hi > lo").select("ord", "section_id", "lo", "hi")
    ends = real.selectExpr("explode(array(lo, hi)) AS at").distinct()
    pieces = global_row_number(ends, "at", name="number").selectExpr("at", "number - 1 AS number")
    pieces = cut_lineage(pieces)
    numbered = (
        real.join(pieces.toDF("lo", "first"), "lo")
        .join(pieces.toDF("hi", "until"), "hi")
        .select("first", "until", F.struct("ord", "section_id").alias("section"))
    )
    sizes = max(1, (pieces.agg(F.max("number")).first()[0] or 0).bit_length())
    # What is left of the range at a size begins or ends with a block of that size where its
    # bound is odd there; the rest is made of blocks of twice the size.
    lower, upper = "shiftright(first + shiftleft(1L, k) - 1, k)", "shiftright(until, k)"
    blocks = f"""flatten(transform(sequence(0, {sizes}), k -> filter(array(
        CASE WHEN {lower} % 2 = 1 AND {lower} < {upper}
             THEN struct(k AS size, {lower} AS block) END,
        CASE WHEN {upper} % 2 = 1 AND {lower} < {upper}
             THEN struct(k AS size, {upper} - 1 AS block) END), x -> x IS NOT NULL)))"""
    filled = (
        numbered.select(F.explode(F.expr(blocks)).alias("b"), "section")
        .groupBy("b.size", "b.block")
        .agg(F.max_by("section.section_id", "section.ord").alias("id"), F.max("section.ord").alias("ord"))
    )
    asked = pieces.select(
        "number", F.explode(F.sequence(F.lit(0), F.lit(sizes))).alias("size")
    ).withColumn("block", F.expr("shiftright(number, size)"))
    last = (
        asked.join(filled, ["size", "block"])
        .groupBy("number")
        .agg(F.max_by("id", "ord").alias("section_id"))
    )
    return pieces.join(last, "number", "left").select("at", "section_id")


def section_by_sweep(
    events: DataFrame, sections: DataFrame, y: str = "scroll_y", name: str = "section_id"
) -> DataFrame:
    """The same for tables of sections."""
    return section_from_pieces(events, disjoint_pieces(sections), y, name)


def section_from_pieces(
    events: DataFrame, pieces: DataFrame, y: str = "scroll_y", name: str = "section_id"
) -> DataFrame:
    """The section of the last of :func:`disjoint_pieces` that begins at or before the position.

    Pieces and events are range-partitioned together by position, and each chunk begins with
    the piece the chunks before it end with. No event is multiplied, and nothing depends on
    how many sections or events lie on one place.
    """
    pieces = pieces.select(
        F.col("at").alias("__y"), F.struct("section_id").alias("__piece")
    )
    rows = events.withColumns(
        {"__y": F.col(y).cast("double"), "__row": F.monotonically_increasing_id()}
    )
    both = rows.unionByName(pieces, allowMissingColumns=True).withColumn("__all", F.lit(0))
    # A piece comes before the events at its place: its row number is null.
    placed = carry_forward(both, "__all", ["__y", "__row"], "__piece", "__found")
    found = placed.where("__row IS NOT NULL").withColumn(name, F.col("__found.section_id"))
    return found.drop("__y", "__row", "__all", "__piece", "__found")


def carry_section(
    events: DataFrame,
    section: str = "section_id",
    session: str = "session_id",
    order: tuple[str, ...] = ("ts", "event_id"),
    name: str = "active_section",
    first: str | Column = FIRST_ACTIVE,
) -> DataFrame:
    """Active section after each event: a position in no section changes nothing (WN1)."""
    first = F.lit(first) if isinstance(first, str) else first
    carried = carry_forward(events, session, list(order), section, name)
    return carried.withColumn(name, F.coalesce(F.col(name), first))


def is_sticky(y: str = "scroll_y") -> Column:
    """Past the threshold the header sticks (F8)."""
    return F.col(y) > STICKY_AFTER


def with_link(
    events: DataFrame,
    links: DataFrame | list,
    section: str = "active_section",
    name: str = "href",
) -> DataFrame:
    """First link, in order, whose target contains the section id as a substring.

    A list of rows becomes an expression, a table is joined; both give the same. The empty
    id is part of every target.
    """
    if isinstance(links, DataFrame):
        return link_by_substring(events, links, section, name)
    targets = [quoted(row["href"]) for row in sorted(links, key=lambda row: row["ord"])]
    hits = [(f"contains({target}, {section})", target) for target in targets]
    return events.withColumn(name, F.expr(case(hits, "NULL") if hits else "CAST(NULL AS STRING)"))


#: Letters of the pieces by which an id is looked for in targets.
GRAM = 3


def _grams(text: str, length: str) -> str:
    """The distinct pieces of ``length`` letters of a text."""
    last = f"length({text}) - {length} + 1"
    return (
        f"array_distinct(transform(sequence(1, greatest({last}, 1)), "
        f"i -> substring({text}, i, {length})))"
    )


def contained(ids: DataFrame, targets: DataFrame, id: str, target: str) -> DataFrame:
    """Rows of ``targets`` with each id of ``ids`` that is part of the text ``target``.

    Of the pieces of three letters of an id the rarest one among the targets stands for it; a
    shorter id stands for itself. Only those pieces of a target that stand for some id are
    joined, and each id found is compared in full. An empty id is part of no target here.
    """
    named = ids.select(F.col(id).alias("__id")).where("__id <> ''").distinct()
    own = named.select("__id", F.explode(F.expr(_grams("__id", f"least(length(__id), {GRAM})"))).alias("__gram"))
    lengths = own.agg(F.collect_set(F.length("__gram"))).first()[0] or [GRAM]
    pieces = " , ".join(_grams(target, str(k)) for k in sorted(lengths))
    met = targets.withColumn("__gram", F.explode(F.expr(f"array_distinct(flatten(array({pieces})))")))
    met = met.where(may_be_in(own, "__gram", "__gram"))
    often = met.groupBy("__gram").agg(F.count("*").alias("__n"))
    rarest = (
        lookup(own, often.withColumnRenamed("__gram", "__of"), "__gram", "__of")
        .groupBy("__id")
        .agg(F.min_by("__gram", F.struct(F.coalesce("__n", F.lit(0)), "__gram")).alias("__gram"))
    )
    found = met.join(rarest, "__gram").where(F.expr(f"contains({target}, __id)"))
    return found.drop("__gram").withColumnRenamed("__id", id)


def link_by_substring(
    events: DataFrame, links: DataFrame, section: str = "active_section", name: str = "href"
) -> DataFrame:
    """The same for a table of links, by equality of pieces instead of a nested loop."""
    ids = events.select(F.col(section).alias("__id"))
    hits = contained(ids, links.select("ord", "href"), "__id", "href").select("__id", "ord", "href")
    # The empty id is part of every target.
    every = links.where("href IS NOT NULL").select(F.lit("").alias("__id"), "ord", "href")
    chosen = hits.union(every).groupBy("__id").agg(F.min_by("href", "ord").alias(name))
    return lookup(events, chosen, section, "__id").drop("__id")
