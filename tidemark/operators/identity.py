"""Identity matching: duplicate counts on either of two keys, admission, prioritised lookup."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleansing import lower_email, lower_email_sql
from tidemark.operators.components import components
from tidemark.operators.lookup import lookup, pair_key, pair_text
from tidemark.session import cut_lineage

EXACTLY_ONE = "exactly_one"
ANY = "any"


def _key_texts(email: str, secret: str) -> str:
    """The keys by which a record can be met: its email, its secret, and both together."""
    return f"array(concat('e', {email}), concat('s', {secret}), concat('b', {pair_key(email, secret)}))"


def key_counts(
    members: DataFrame, email: str = "email", secret: str = "password_digest"
) -> DataFrame:
    """``(member_key, n)``: how many members have each email, each secret, and each pair.

    One scan and one aggregate, reduced before its shuffle. Counts of disjoint sets of members
    add up, see :func:`add_key_counts`.
    """
    keys = members.select(F.explode(F.expr(_key_texts(email, secret))).alias("member_key"))
    return keys.where("member_key IS NOT NULL").groupBy("member_key").agg(F.count("*").alias("n"))


def add_key_counts(*parts: DataFrame) -> DataFrame:
    """Counts of all members of the parts."""
    return reduce(DataFrame.unionByName, parts).groupBy("member_key").agg(F.sum("n").alias("n"))


def candidate_keys(
    candidates: DataFrame, email: str = "email", secret: str = "secret_digest"
) -> DataFrame:
    """``(pair, key)``: what the pair of keys of each candidate is looked up by."""
    keys = candidates.selectExpr(
        f"{pair_text(email, secret)} AS pair", f"explode({_key_texts(email, secret)}) AS key"
    )
    return keys.where("key IS NOT NULL")


def with_counts(
    candidates: DataFrame,
    counts: DataFrame,
    email: str = "email",
    secret: str = "secret_digest",
    name: str = "n_matches",
) -> DataFrame:
    """Candidates with the number of members they meet, from :func:`key_counts`.

    Members with the email, plus those with the secret, less those with both. The three
    counts are found for the candidates' bare keys and folded into one number per pair of
    keys; only then the candidates themselves are shuffled, once. Hot keys are split.
    """
    # Three long rows for each one of a small file: taken for small, they would be broadcast.
    keys = candidate_keys(candidates, email, secret).hint("merge")
    met = lookup(keys, counts, "key", "member_key", "inner")

    def of(kind: str) -> str:
        return f"coalesce(max(CASE WHEN startswith(key, '{kind}') THEN n END), 0)"

    found = met.groupBy("pair").agg(F.expr(f"{of('e')} + {of('s')} - {of('b')}").alias("__n"))
    counted = lookup(candidates, found, pair_text(email, secret), "pair")
    return counted.withColumn(name, F.expr("coalesce(__n, 0L)")).drop("pair", "__n")


def with_match_counts(
    candidates: DataFrame,
    members: DataFrame,
    email: str = "email",
    secret: str = "secret_digest",
    name: str = "n_matches",
) -> DataFrame:
    """Count member rows with the same email OR the same secret.

    Equal pairs are never listed. The members are scanned once, and the candidates' rows
    shuffled once. A missing key matches nobody.
    """
    return with_counts(candidates, key_counts(members), email, secret, name)


def is_duplicate_sql(match_rule: str = EXACTLY_ONE, name: str = "n_matches") -> str:
    """``exactly_one`` leaves two or more matches unflagged; ``any`` flags them too."""
    if match_rule not in (EXACTLY_ONE, ANY):
        raise ValueError(f"unknown match rule {match_rule!r}")
    return f"({name} = 1)" if match_rule == EXACTLY_ONE else f"({name} >= 1)"


def is_duplicate(match_rule: str = EXACTLY_ONE, name: str = "n_matches") -> Column:
    return F.expr(is_duplicate_sql(match_rule, name))


def admit_new(
    candidates: DataFrame,
    members: DataFrame,
    match_rule: str = EXACTLY_ONE,
    email: str = "email",
    secret: str = "secret_digest",
) -> DataFrame:
    """Candidates that are not duplicates of a member.

    ``any`` needs no counts: two anti joins, each against distinct keys.
    """
    if match_rule == ANY:
        return _without(
            _without(candidates, email, members.select("email")),
            secret,
            members.select("password_digest"),
        )
    counted = with_match_counts(candidates, members, email, secret)
    return counted.filter(~is_duplicate(match_rule)).drop("n_matches")


#: Rows of one group of rivals that a task takes one after another.
SCAN_ROWS = 200_000


def admit_in_order(
    candidates: DataFrame,
    order: str = "candidate_id",
    email: str = "email",
    secret: str = "secret_digest",
    scan_rows: int = SCAN_ROWS,
) -> DataFrame:
    """Candidates taken one after another, each dropped if it shares its email or its
    secret with one *accepted* before it. ``order`` must be a unique whole number, not null; a
    null key rivals nobody.

    Candidates that are linked by a chain of shared keys form a group; what happens in one
    group does not touch another. A task sorts the groups it got and walks through each with
    the keys taken so far. A group of more than ``scan_rows`` is not handed to one task: its
    first rows, about that many, are walked through, what they keep out is dropped, then all
    of the rest that come first for both their keys are taken and what these keep out dropped.
    What is left mostly falls apart into small groups and starts anew.
    """
    open_rows = cut_lineage(
        candidates.select(
            F.col(order).cast("long").alias("seq"),
            F.col(email).alias("k1"),
            F.col(secret).alias("k2"),
        )
    )
    admitted = []
    while True:
        grouped = _with_group(open_rows)
        sizes = grouped.where("component IS NOT NULL").groupBy("component").count()
        large = cut_lineage(sizes.where(F.col("count") > scan_rows).toDF("of", "size"))
        total = large.agg(F.sum("size")).first()[0]
        if not total:
            admitted.append(_walk(grouped))
            break
        grouped = cut_lineage(lookup(grouped, large, "component", "of"))
        admitted.append(_walk(grouped.where("size IS NULL")).select("seq"))
        rest = grouped.where("size IS NOT NULL").select("component", "seq", "k1", "k2")
        share = scan_rows / total
        # The bound is met up to a quarter of scan_rows.
        last = rest.agg(F.percentile_approx("seq", share, int(max(10_000, 4 / share)))).first()[0]
        first = cut_lineage(_walk(rest.where(F.col("seq") <= last)))
        rest = _unrivalled(rest.where(F.col("seq") > last).select("seq", "k1", "k2"), first)
        rest = cut_lineage(rest)
        ahead = _first_or_free(rest, "k1").join(_first_or_free(rest, "k2"), "seq")
        ahead = cut_lineage(ahead.select("seq", "k1", "k2"))
        admitted += [first.select("seq"), ahead.select("seq")]
        left = rest.join(ahead.select("seq"), "seq", "left_anti")
        open_rows = cut_lineage(_unrivalled(left, ahead))
    taken = reduce(DataFrame.unionByName, [a.select("seq") for a in admitted])
    return candidates.join(taken, F.col(order).cast("long") == F.col("seq"), "left_semi")


def _unrivalled(rows: DataFrame, taken: DataFrame) -> DataFrame:
    return _without(_without(rows, "k1", taken.select("k1")), "k2", taken.select("k2"))


def _with_group(rows: DataFrame) -> DataFrame:
    """Rows with the group of rivals they are in; null where a row has none.

    Each row is linked to the first row of its email and to that of its secret: as many links
    as keys, however many rows share one.
    """
    links = None
    for key in ("k1", "k2"):
        held = rows.where(F.col(key).isNotNull()).select("seq", key)
        first = held.groupBy(key).agg(F.min("seq").alias("first"), F.count("*").alias("n"))
        shared = first.where("n > 1").select(F.col(key).alias("of"), "first")
        own = lookup(held, shared, key, "of", "inner").select(
            F.col("seq").alias("a"), F.col("first").alias("b")
        )
        links = own if links is None else links.union(own)
    found = components(links).toDF("node", "component")
    return rows.join(found, F.col("seq") == F.col("node"), "left").drop("node")


def _walk(grouped: DataFrame) -> DataFrame:
    """``(seq, k1, k2)`` of the admitted rows of whole groups, and of all rows without one."""
    free = grouped.where("component IS NULL").select("seq", "k1", "k2")
    rivals = grouped.where("component IS NOT NULL").select("component", "seq", "k1", "k2")
    ordered = rivals.repartition("component").sortWithinPartitions("component", "seq")
    return free.union(ordered.mapInArrow(_walked, free.schema))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group, taken = None, (set(), set())
    for batch in batches:
        kept = []
        columns = (column.to_pylist() for column in batch.columns)
        for row, (component, _, *keys) in enumerate(zip(*columns, strict=True)):
            if component != group:
                group, taken = component, (set(), set())
            if any(key in known for key, known in zip(keys, taken, strict=True)):
                continue
            kept.append(row)
            for key, known in zip(keys, taken, strict=True):
                if key is not None:
                    known.add(key)
        yield batch.take(pa.array(kept, pa.int64())).select(["seq", "k1", "k2"])


def _without(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    return lookup(rows, keys.toDF("__taken").distinct(), column, "__taken", "left_anti")


def _first_or_free(rows: DataFrame, key: str) -> DataFrame:
    """``(seq, key)`` of the first row of each key, and of all rows without one."""
    held = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("seq").alias("seq"))
    return held.select("seq", key).unionByName(rows.filter(F.col(key).isNull()).select("seq", key))


def first_per_key(rows: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """The first row per key (WN2), as an aggregate: a hot key is reduced before the shuffle."""
    first = F.min_by(F.struct(order, *values), order)
    return rows.groupBy(key).agg(first.alias("__first")).select(key, "__first.*")


def login_outcome(
    attempts: DataFrame,
    members: DataFrame,
    admins: DataFrame,
    email: str = "email",
    secret: str = "pass_digest",
    member_order: str = "member_id",
    admin_order: str = "password_digest",
) -> DataFrame:
    """Match each attempt to member, else admin, else deny.

    Both tables are first reduced to the first row per email, side by side in one
    aggregate; the attempts then meet one table of unique emails in one join.
    A missing row or secret never matches.
    """
    stored = (
        members.select(
            lower_email("email").alias("__email"),
            F.struct(F.col(member_order).alias("o"), F.col("password_digest").alias("d")).alias(
                "__member"
            ),
        )
        .unionByName(
            admins.select(
                lower_email("email").alias("__email"),
                F.struct(F.col(admin_order).alias("o"), F.col("password_digest").alias("d")).alias(
                    "__admin"
                ),
            ),
            allowMissingColumns=True,
        )
        .groupBy("__email")
        .agg(
            F.min_by("__member.d", "__member.o").alias("__member_secret"),
            F.min_by("__admin.d", "__admin.o").alias("__admin_secret"),
        )
    )
    given = F.col(secret)
    return (
        lookup(attempts, stored, lower_email_sql(email), "__email")
        .withColumn(
            "outcome",
            F.when(given == F.col("__member_secret"), F.lit("member"))
            .when(given == F.col("__admin_secret"), F.lit("admin"))
            .otherwise(F.lit("denied")),
        )
        .drop("__email", "__member_secret", "__admin_secret")
    )
