"""Form records validated as they arrive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.rules import FAITHFUL, with_taken
from tidemark.operators.identity import (
    ANY,
    EXACTLY_ONE,
    admit_in_order,
    candidate_keys,
    with_counts,
)
from tidemark.operators.intake import judge_contacts, judge_signups, mark_counted
from tidemark.schemas import CONTACT_PAGE, MEMBER, VIOLATIONS
from tidemark.sources.sinks import (
    contact_rows,
    member_rows,
    read_batch,
    read_batches,
    split_outcome,
    write_batch,
)
from tidemark.streaming.member_index import MemberIndex
from tidemark.streaming.triggers import start

REJECT = StructType(
    [
        StructField("submission_id", LongType(), True),
        StructField("violations", VIOLATIONS, True),
    ]
)


@dataclass(frozen=True)
class SignupIntake:
    """Sign-ups against the members known so far: a base table plus earlier batches, both met
    by their keys only, in a :class:`MemberIndex`.

    ``one_by_one`` also settles duplicates inside a batch in submission order, as if
    the records came singly; it needs the ``any`` rule.
    """

    spark: SparkSession
    root: str
    base_members: DataFrame | None = None
    mode: str = FAITHFUL
    match_rule: str = EXACTLY_ONE
    one_by_one: bool = False

    def __post_init__(self) -> None:
        if self.one_by_one and self.match_rule != ANY:
            raise ValueError("one_by_one needs match_rule 'any'")

    def start(self, submissions: DataFrame, every_seconds: int | None = None) -> StreamingQuery:
        return start(submissions, self.on_batch, f"{self.root}/_stream", every_seconds)

    @property
    def index(self) -> MemberIndex:
        return MemberIndex(self.spark, f"{self.root}/index", self.base_members)

    def on_batch(self, submissions: DataFrame, batch_id: int) -> None:
        # The batch is read for its keys and then joined; the judged rows go to two outputs.
        by_rules = judge_signups(submissions, mode=self.mode).persist()
        self.index.open(batch_id)
        known = self.index.counts(batch_id, candidate_keys(by_rules))
        judged = mark_counted(with_counts(by_rules, known), self.match_rule).persist()
        try:
            accepted, rejected = split_outcome(judged)
            if self.one_by_one:
                admitted = admit_in_order(accepted, order="submission_id")
                late = accepted.join(admitted.select("submission_id"), "submission_id", "left_anti")
                # Known by now: one of the same batch was accepted before it.
                late = late.withColumns({"violations": with_taken("true"), "accepted": F.lit(False)})
                rejected = rejected.unionByName(late)
                accepted = admitted
            write_batch(member_rows(accepted), f"{self.root}/accepted", batch_id)
            write_batch(rejected.select(*REJECT.names), f"{self.root}/rejected", batch_id)
            # Last, and from what was written: an index never knows more than the table.
            self.index.add(read_batch(self.spark, f"{self.root}/accepted", MEMBER, batch_id), batch_id)
        finally:
            judged.unpersist()
            by_rules.unpersist()

    def accepted(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/accepted", MEMBER).select(*MEMBER.names)

    def rejected(self) -> DataFrame:
        """Rejected ids with their violations; no secret, not even as a digest."""
        return read_batches(self.spark, f"{self.root}/rejected", REJECT).select(*REJECT.names)


@dataclass(frozen=True)
class ContactIntake:
    """Contact records; no duplicate check, so no state."""

    spark: SparkSession
    root: str

    def start(self, submissions: DataFrame, every_seconds: int | None = None) -> StreamingQuery:
        return start(submissions, self.on_batch, f"{self.root}/_stream", every_seconds)

    def on_batch(self, submissions: DataFrame, batch_id: int) -> None:
        judged = judge_contacts(submissions).persist()
        try:
            accepted, rejected = split_outcome(judged)
            write_batch(contact_rows(accepted), f"{self.root}/accepted", batch_id)
            write_batch(rejected.select(*REJECT.names), f"{self.root}/rejected", batch_id)
        finally:
            judged.unpersist()

    def accepted(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/accepted", CONTACT_PAGE).select(
            *CONTACT_PAGE.names
        )

    def rejected(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/rejected", REJECT).select(*REJECT.names)


