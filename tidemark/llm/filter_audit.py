"""What filters do to each other, in every order they can be applied in.

Each document is reduced to the mask of the filters it fails; Spark counts the masks of each
part, however large. The counts of a part are the leaves of a decision diagram with one level
per filter, whose nodes know the counts below them. Walking from the root along the pass edges
tells what each filter removes in the order of the levels; exchanging two neighbouring levels
gives the diagram of the next order, so all orders are reached by single exchanges.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import map_arrow, slices
from tidemark.operators.lookup import lookup

#: The filters in the order of their bits; the last one is told by the corpus, not by a text.
FILTERS = "ABCDE"
COPY_BIT = 1 << FILTERS.index("E")

MARKS = re.compile(r"[#$%&*|]")
NOT_CAPITAL = bytes(set(range(256)) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

Weight = tuple[int, int, int]


def failures(text: str) -> int:
    """Mask of the filters A to D that a text fails."""
    data = text.encode()
    words = data.split()
    capitals = len(data.translate(None, NOT_CAPITAL))
    failed = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * capitals > 3 * len(text),
        MARKS.search(text) is not None,
    )
    return sum(f << k for k, f in enumerate(failed))


def mask_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        texts = [x or "" for x in rows[2].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                rows[0],
                rows[1],
                pa.array(map(failures, texts), pa.int32()),
                pa.array([hashlib.sha256(x.encode()).digest() for x in texts], pa.binary()),
            ],
            names=["doc_id", "part", "mask", "print"],
        )


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and failure mask, and those labelled.

    A copy fails filter E unless its id is the smallest of its text. Nothing is kept per group
    of copies but the smallest id and the rows that have it, so a text of any number of
    copies is reduced before each shuffle.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        "text",
    )
    schema = "doc_id long, part string, mask int, print binary"
    marked = map_arrow(source, mask_rows, schema)
    alike = marked.groupBy("print", "part", "mask", "doc_id").agg(F.count("*").alias("n"))

    known = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("of"))
        .agg(
            F.coalesce(F.max(F.expr("quality = 1")), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.expr("toxic = 1")), F.lit(False)).alias("toxic"),
        )
    )
    # A missing id has no label; its rows are spread by their text.
    key = "coalesce(cast(doc_id AS string), concat('~', hex(print)))"
    labelled = lookup(alike, known, key, "cast(of AS string)").select(
        "print", "part", "mask", "doc_id", "n",
        F.expr("coalesce(good, false)").alias("good"),
        F.expr("coalesce(toxic, false)").alias("toxic"),
    )
    groups = labelled.groupBy("print", "part", "mask", "good", "toxic").agg(
        F.min(F.expr("CASE WHEN doc_id IS NOT NULL THEN struct(doc_id, n) END")).alias("first"),
        F.sum("n").alias("n"),
        F.sum(F.expr("CASE WHEN doc_id IS NULL THEN n ELSE 0 END")).alias("unnamed"),
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("print"))
    split = groups.withColumn("smallest", smallest).selectExpr(
        "part", "mask", "good", "toxic", "n",
        "unnamed + CASE WHEN first.doc_id = smallest THEN first.n ELSE 0 END AS originals",
    )
    return (
        split.selectExpr(
            "part", "good", "toxic",
            "inline(array(struct(mask AS mask, originals AS n), "
            f"struct(mask + {COPY_BIT} AS mask, n - originals AS n)))",
        )
        .where("n > 0")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.expr("if(good, n, 0L)")).alias("good"),
            F.sum(F.expr("if(toxic, n, 0L)")).alias("toxic"),
        )
    )


class Diagram:
    """Decision diagram over failure bits with counts; equal nodes of a level are one.

    ``levels[k]`` lists the nodes of level k as (pass child, fail child), numbers of nodes of
    the next level; below the last level these are numbers of ``leaves``.
    """

    def __init__(self, names: str, counts: dict[int, Weight]):
        self.order = list(names)
        masks = range(1 << len(names))
        self.leaves = sorted({counts.get(m, (0, 0, 0)) for m in masks})
        number = {w: k for k, w in enumerate(self.leaves)}
        below = [number[counts.get(m, (0, 0, 0))] for m in masks]
        self.levels: list[list[tuple[int, int]]] = [[] for _ in names]
        for k in reversed(range(len(names))):
            # The level of bit k: of the bits left it is the highest, so the halves of the
            # list are what its pass and its fail edges lead to.
            half = 1 << k
            pairs = list(zip(below[:half], below[half:], strict=True))
            self.levels[k], below = self._numbered(pairs)
        self.weights: list[list[Weight]] = [[] for _ in names]
        for k in reversed(range(len(names))):
            self._weigh(k)

    @staticmethod
    def _numbered(pairs: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[int]]:
        known: dict[tuple[int, int], int] = {}
        numbers = [known.setdefault(pair, len(known)) for pair in pairs]
        return list(known), numbers

    def _weights_below(self, level: int) -> list[Weight]:
        return self.leaves if level + 1 == len(self.levels) else self.weights[level + 1]

    def _weigh(self, level: int) -> None:
        below = self._weights_below(level)
        self.weights[level] = [
            tuple(a + b for a, b in zip(below[lo], below[hi], strict=True))
            for lo, hi in self.levels[level]
        ]

    def exchange(self, level: int) -> None:
        """Swap the variables of ``level`` and the next one. Only nodes of the two change:
        what lies below them and the counts of the upper nodes are as before."""
        lower = self.levels[level + 1]
        pairs = []
        for lo, hi in self.levels[level]:
            pairs.append((lower[lo][0], lower[hi][0]))
            pairs.append((lower[lo][1], lower[hi][1]))
        self.levels[level + 1], numbers = self._numbered(pairs)
        self.levels[level] = list(zip(numbers[::2], numbers[1::2], strict=True))
        self._weigh(level + 1)
        order = self.order
        order[level], order[level + 1] = order[level + 1], order[level]

    def steps(self) -> Iterator[tuple[str, Weight, Weight, int]]:
        """(filter, kept, removed, failing it alone) per level along the all-pass path."""
        node = 0
        for level, name in enumerate(self.order):
            below = self._weights_below(level)
            lo, hi = self.levels[level][node]
            alone = hi
            for rest in range(level + 1, len(self.order)):
                alone = self.levels[rest][alone][0]
            yield name, below[lo], below[hi], self.leaves[alone][0]
            node = lo


def exchanges(n: int) -> list[int]:
    """Levels to exchange, one after another, to meet every order of ``n`` filters once.

    The last filter runs to the front and back again; between the runs the others make one
    exchange of their own, one level further down while the last one is in front.
    """
    if n < 2:
        return []
    out = []
    inner = [*exchanges(n - 1), None]
    for k, swap in enumerate(inner):
        front = k % 2 == 0
        out += reversed(range(n - 1)) if front else range(n - 1)
        if swap is not None:
            out.append(swap + front)
    return out


def audit_counts(counts: dict[int, Weight], names: str = FILTERS) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, alone, good, toxic, shapley) of one part."""
    diagram = Diagram(names, counts)
    seen, fails, total = [], {}, dict.fromkeys(names, 0)
    for swap in [None, *exchanges(len(names))]:
        if swap is not None:
            diagram.exchange(swap)
        order = "".join(diagram.order)
        for step, (name, kept, removed, alone) in enumerate(diagram.steps(), 1):
            if step == 1:
                fails[name] = removed[0]
            total[name] += removed[0]
            seen.append((order, step, name, kept[0], removed, alone))
    return [
        (order, step, kept, removed[0], fails[name] - removed[0], alone, *removed[1:], total[name])
        for order, step, name, kept, removed, alone in seen
    ]


AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audit_part(part: pd.DataFrame) -> pd.DataFrame:
    counts = {
        int(m): (int(n), int(g), int(t))
        for m, n, g, t in zip(part["mask"], part["n"], part["good"], part["toxic"], strict=True)
    }
    names = [field.split()[0] for field in AUDIT.split(", ")]
    out = pd.DataFrame(audit_counts(counts), columns=names[1:])
    out.insert(0, "part", part["part"].iloc[0])
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (language), order of the five filters, and step.

    A null text counts as empty: under 200 words, a copy of other empty and null texts. A null
    language is the part of the empty string, as is the empty string itself. A row with a null
    id is never a copy and has no label; rows of one id and one text are not copies of each
    other, as neither id is smaller. Of repeated labels of an id any 1 counts; null labels say
    nothing. No documents, no rows. Other columns are not looked at.
    """
    return mask_counts(docs, labels).groupBy("part").applyInPandas(audit_part, AUDIT)
