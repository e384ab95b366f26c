"""N-gram Jaccard join by universe partition and pigeonhole.

Two sets of sizes p and q with a Jaccard similarity of 0.8 or more differ in at most
``(p + q) // 9`` members. Sets are dealt into size bands; in a band the hash space of the
shingles is cut into segments, and each non-empty segment of a set has a signature, the hash
of the segment's subset. One differing member spoils at most one segment, so two linked sets
share one of the signatures that come first in any common order of signatures, if each keeps
one more than they may differ in. That order is the cost-based allocation: signatures
whose rarest shingle is rare in the corpus come first (a count sketch of fixed size), and hot
passages get no signature where the rest of the set suffices. Small sets, which may differ
in one member, are indexed whole with their one-deletion neighbourhoods. A band that holds a
set with too few filled segments is cut into segments of single shingles.

Equal sets are one set, named by a 64-bit hash of its shingles, which are 64-bit hashes
themselves. Candidates are verified exactly. A signature of many sets is not turned into all its pairs:
its sets are held against a few centres; a centre that has met all sets of its signature
leaves it, and the rounds go on until what is left of each signature is one component. Where
many copies of one text differ from each other by about as much as is allowed, most meetings are
settled by bitmaps of parities, and only those that may be links read the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.text import (
    WordHashes,
    id_bit,
    id_filter,
    map_arrow,
    mix,
    packed,
    passes,
    set_aside,
    shingles,
    signed,
    slices,
    summed_arrays,
    word_hashes,
    written,
)

#: Counters of the sketch of shingle counts, at any corpus size.
SKETCH = 1 << 20
CHUNKS = 64
#: Sets of a signature that are paired outright; larger groups go through centres.
PAIRED = 6
#: Centres of a signature in the second round; each later round takes so many times as many.
CENTRES = 32
#: Sizes up to which two sets may differ in one shingle only: p + q < 18.
SMALL = 9

#: Columns of a bitmap of parities: each bit in which two sets are unlike is a difference of them.
MARKS = tuple(f"m{k}" for k in range(16))
#: Names of sets that a task remembers as indexed.
SEEN = 300_000

INFO = (
    "doc_id long, print long, n long, name long, thin array<int>, marks array<long>, "
    "chunk int, counts binary"
)


def may_differ(p: int, top: int) -> int:
    """Most shingles in which a set of p and any partner of at most ``top`` may differ."""
    return (p + min(p * 5 // 4, top)) // 9


def bands_of(n: int) -> list[tuple[int, int]]:
    """(band, needed signatures) for a set of n: of each band whose sets it may be linked to."""
    if n < 8:
        return []
    own = n.bit_length() - 1
    out = []
    for band in (own, own - 1):
        top = ((2 << band) - 1) * 5 // 4
        if band >= 3 and n <= top:
            out.append((band, may_differ(n, top) + 1))
    return out


def segments(tokens: np.ndarray, band: int, fine: bool) -> np.ndarray:
    """Where the filled segments of sorted tokens begin: 2**band equal parts of the hash space."""
    if fine:
        return np.arange(len(tokens))
    part = tokens >> np.uint64(64 - band)
    return np.flatnonzero(np.r_[True, part[1:] != part[:-1]])


def signatures(tokens: np.ndarray, sketch: np.ndarray, fine: frozenset[int]) -> np.ndarray:
    """The signatures a set is indexed under."""
    n = len(tokens)
    out = []
    if 4 <= n <= SMALL:
        spread = mix(tokens)
        whole = spread.sum(dtype=np.uint64)
        out.append(mix(np.r_[whole, whole - spread]))
    for band, needed in bands_of(n):
        at = segments(tokens, band, band in fine)
        spread = mix(tokens ^ np.uint64(band))
        sums = mix(np.add.reduceat(spread, at) + np.uint64(band))
        cost = np.minimum.reduceat(sketch[tokens & np.uint64(SKETCH - 1)], at)
        out.append(sums[np.lexsort((sums, cost))[:needed]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def name_of(tokens: np.ndarray) -> int:
    """Name of a set: a 64-bit hash of its sorted tokens."""
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def marks(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of 64 bits a column, whose bits are odd numbers of shingles.

    What two sets share cancels out, so the bits fill with their differences, not with their sizes.
    """
    size = 64 * len(MARKS)
    at = (tokens >> np.uint64(20)) & np.uint64(size - 1)
    odd = np.bincount(at.astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def may_link(a: str, b: str) -> str:
    """SQL: what is known of two sets, sizes and bitmaps, allows a similarity of 0.8."""
    both = f"({a}.n + {b}.n)"
    apart = " + ".join(f"bit_count({a}.{m} ^ {b}.{m})" for m in MARKS)
    return f"9 * least({a}.n, {b}.n) >= 4 * {both} and 9 * ({apart}) <= {both}"


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and the task's part of the sketch."""
    known, counts = WordHashes(), np.zeros(SKETCH, np.uint32)
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.binary()]
    names = [field.split()[0] for field in INFO.split(", ")]

    def rows_of(columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
        )

    for part in slices(batches):
        rows = []
        for doc, own, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
            tokens = shingles(word_hashes(text, known))
            np.add.at(counts, tokens & np.uint64(SKETCH - 1), np.uint32(1))
            thin = [
                band
                for band, needed in bands_of(len(tokens))
                if len(segments(tokens, band, False)) < needed
            ]
            name = name_of(tokens) if len(tokens) else None
            rows.append((doc, own, len(tokens), name, thin, marks(tokens), None, None))
        yield rows_of(zip(*rows, strict=True))
    if counts.any():
        none = [None] * CHUNKS
        yield rows_of([*[none] * 6, list(range(CHUNKS)), [packed(x) for x in np.split(counts, CHUNKS)]])


def sketch_of(info: DataFrame) -> np.ndarray:
    parts = info.where("chunk is not null").select("chunk", "counts")
    out = np.zeros((CHUNKS, SKETCH // CHUNKS), np.int64)
    for (chunk,), counts in summed_arrays(parts, "chunk").items():
        out[chunk] = counts
    return out.ravel()


def indexer(sketch, fine: frozenset[int]):
    """Rows (sig, name); of equal sets in a task mostly only the first is indexed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, seen = WordHashes(), sketch.value, set()
        for part in slices(batches):
            found, owners = [], []
            for text in part[0].to_pylist():
                tokens = shingles(word_hashes(text, known))
                if len(tokens) < 4 or (own := name_of(tokens)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(own)
                found.append(signatures(tokens, counts, fine))
                owners.append(own)
            if found:
                sizes = [len(x) for x in found]
                docs = pa.array(np.repeat(np.array(owners, np.int64), sizes))
                yield pa.RecordBatch.from_arrays(
                    [signed(np.concatenate(found)), docs], names=["sig", "name"]
                )

    return work


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature: pairs of small groups; the members of large ones.

    Output (sig, a, b): sig is null for pairs, b is null for members. Never more than a
    batch and the head of one group is held.
    """
    sig, head, large = None, [], False

    def cells(rows):
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["sig", "a", "b"]
        )

    def closed(out):
        if not large:
            out += [(None, x, y) for i, x in enumerate(head) for y in head[i + 1 :]]

    for batch in batches:
        sigs, docs = batch[0].to_numpy(), batch[1].to_numpy()
        same = np.zeros(len(sigs) + 1, bool)
        same[1:-1] = sigs[1:] == sigs[:-1]
        lone = ~same[:-1] & ~same[1:]
        lone[:1] = lone[-1:] = False
        out = []
        for s, d in zip(sigs[~lone].tolist(), docs[~lone].tolist(), strict=True):
            if s != sig:
                closed(out)
                sig, head, large = s, [d], False
            elif large:
                out.append((s, d, None))
            elif not head or d != head[-1]:
                head.append(d)
                if len(head) > PAIRED:
                    out += [(s, x, None) for x in head]
                    head, large = [], True
        yield cells(out)
    out = []
    closed(out)
    yield cells(out)


def set_reader(bits, unnamed: bool):
    """Rows (name, tokens) of the documents whose filter bit is set, or that have no id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks = WordHashes(), bits.value
        for part in slices(batches, 100):
            at = part[1].fill_null(0).to_numpy()
            null = np.array(part[1].is_null())
            some = part.take(pa.array(np.flatnonzero(np.where(null, unnamed, passes(marks, at)))))
            sets = [shingles(word_hashes(x, known)) for x in some[0].to_pylist()]
            sets = [x for x in sets if len(x)]
            if sets:
                columns = [pa.array(map(name_of, sets), pa.int64())]
                columns.append(pa.array([x.tobytes() for x in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["name", "tokens"])

    return work


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs with 100 * intersection >= 80 * union."""
    for part in slices(batches, 200):
        keep = []
        for x, y in zip(part["ta"], part["tb"], strict=True):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
            keep.append(100 * common >= 80 * (len(a) + len(b) - common))
        yield pa.RecordBatch.from_arrays([part["a"], part["b"]], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_())
        )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked pairs among ``pairs (a, b)``; a hot end is split by the engine's skew join."""
    both = pairs.join(
        sets.select(F.col("name").alias("a"), F.col("tokens").alias("ta")), "a"
    ).join(sets.select(F.col("name").alias("b"), F.col("tokens").alias("tb")), "b")
    return map_arrow(both, verify, "a long, b long")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, print, n_shingles, name, component, low)`` for each row of ``docs``.

    ``print`` is ``xxhash64`` of the text, ``name`` that of its set (null without words),
    ``component`` the smallest name and ``low`` the smallest id of all that it is linked to.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text")
    )
    info = written(map_arrow(source, measure, INFO), "sets")
    rows = info.where("chunk is null").select("doc_id", "print", "n", "name", "thin", "marks")
    bands = rows.select(F.explode("thin").alias("band")).distinct().collect()
    fine = frozenset(r[0] for r in bands)
    known = [F.col("marks")[k].alias(m) for k, m in enumerate(MARKS)]
    of = written(
        rows.where("n > 0")
        .groupBy("name")
        .agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("marks").alias("marks"))
        .select("name", "low", "n", *known),
        "named",
    )
    sketch = spark.sparkContext.broadcast(sketch_of(info))
    index = map_arrow(source.select("text"), indexer(sketch, fine), "sig long, name long")
    found = written(
        map_arrow(
            index.repartition("sig").sortWithinPartitions("sig", "name"),
            runs,
            "sig long, a long, b long",
        ),
        "candidates",
    )
    pairs = found.where("sig is null").select("a", "b").distinct()
    members = found.where("sig is not null").select("sig", F.col("a").alias("name")).distinct()
    pairs = written(
        pairs.join(of.alias("x"), F.expr("a = x.name"))
        .join(of.alias("y"), F.expr(f"b = y.name and {may_link('x', 'y')}"))
        .select("a", "b"),
        "pairs",
    )
    members = written(members.join(of.drop("low"), "name").select("sig", "name", "n", *MARKS), "members")
    wanted = pairs.selectExpr("a as name").union(pairs.selectExpr("b as name"))
    wanted = wanted.union(members.select("name")).distinct().join(of.select("name", "low"), "name")
    wanted = written(wanted, "wanted")
    bits = spark.sparkContext.broadcast(id_filter(wanted.where("low is not null"), "low"))
    reader = set_reader(bits, not wanted.where("low is null").isEmpty())
    sets = written(
        map_arrow(
            source.select("text", F.when(F.col("doc_id").isNotNull(), id_bit("doc_id")).alias("bit")),
            reader,
            "name long, tokens binary",
        ).dropDuplicates(["name"]),
        "tokens",
    )
    links = written(verified(pairs, sets), "links")
    links = centred(members, sets, links)
    labels = components(links).withColumnRenamed("node", "name")
    sets = of.select("name", "low").join(labels, "name", "left")
    sets = sets.withColumn("component", F.coalesce("component", "name"))
    lows = sets.groupBy("component").agg(F.min("low").alias("low"))
    sets = written(sets.drop("low").join(lows, "component").select("name", "component", "low"), "groups")
    return rows.select("doc_id", "print", F.col("n").alias("n_shingles"), "name").join(
        sets, "name", "left"
    )


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each document.

    Shingles are five ASCII-lowered words, a shorter text is one shingle; documents with a
    Jaccard similarity of 0.8 or more are linked, and a component is named by its smallest id.
    Null or blank texts have no shingle and stay alone. A row with a null id is linked like any
    other and named by the smallest id of its component, null if there is none; rows of a
    repeated id are a document each. Other columns are ignored. No rows in, none out.
    """
    return grouped(docs, id_col, text_col).select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id")
    )


def first_of_groups(docs: DataFrame) -> DataFrame:
    """``docs`` without those that are linked, over any number of links, to one that stays.

    Of a group the smallest id stays (null ids last, then the smaller hash of the text), and of
    rows alike in both one. Texts without words all stay.
    """
    found = grouped(docs).where("name is not null")
    rows = found.groupBy("component", "doc_id", "print").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "print", "n")
    best = rows.groupBy("component").agg(F.min(order).alias("best")).select("best.*")
    best = best.toDF("none", "id", "__kept", "__n")
    kept = written(
        best.select(F.when(~F.col("none"), F.col("id")).alias("__id"), "__kept", "__n"), "kept"
    )
    own, columns = set_aside(docs, "__print", "__id", "__kept", "__n")
    own = own.withColumn("__print", F.xxhash64("text"))
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = (F.col("__print") == F.col("__kept")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))

    def those(of: DataFrame) -> DataFrame:
        return own.where(~blank).join(of, same, "left_semi")

    stays = those(kept.where("__n = 1"))
    repeated = kept.where("__n > 1")
    if not repeated.isEmpty():
        stays = stays.union(those(repeated).dropDuplicates(["doc_id", "__print"]))
    return stays.union(own.where(blank)).select(columns)


def centred(members: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """Links within large signature groups, until each group is one component.

    The first centre is the set of the smallest id, so that groups that share most of their
    sets share their centre too; later ones are the sets of the group's smallest components.
    A centre meets all sets of other components of a fitting size, and leaves the group.
    """
    centres, order_by = 1, ["name"]
    while True:
        labels = components(links).select(F.col("node").alias("name"), "component")
        named = members.join(labels, "name", "left").select(
            "sig", "name", "n", *MARKS, F.coalesce("component", "name").alias("comp")
        )
        spread = named.groupBy("sig").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high")
        )
        open_ = spread.where("low != high").select("sig")
        members = written(named.join(open_, "sig", "left_semi"), "members")
        if members.isEmpty():
            return links
        sizes = members.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("size"))
        order = Window.partitionBy("sig").orderBy(*order_by)
        chosen = (
            members.join(sizes, ["sig", "comp"])
            .withColumn("k", F.row_number().over(order))
            .where(F.col("k") <= centres)
            .drop("k", "size")
        )
        chosen = written(chosen, "centres")
        meet = f"x.sig = y.sig and x.comp != y.comp and {may_link('x', 'y')}"
        pairs = members.alias("x").join(chosen.alias("y"), F.expr(meet))
        pairs = pairs.selectExpr("least(x.name, y.name) as a", "greatest(x.name, y.name) as b")
        links = written(links.union(verified(pairs.distinct(), sets)), "links")
        members = members.drop("comp").join(chosen.select("sig", "name"), ["sig", "name"], "left_anti")
        members = written(members, "members")
        centres = CENTRES * centres
        order_by = ["size", "comp", "name"]
