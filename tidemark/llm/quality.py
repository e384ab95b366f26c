"""Quality classifier from weak labels.

Heuristic labellers accuse a document, find nothing, or do not look; given labels are one more
labeller. Expectation-maximisation over the counts of vote patterns estimates how often each
labeller accuses good documents and each kind of bad ones, without trusting any of them. The posterior
of a document's pattern is its soft label, and a bounded sample of all documents that got a vote,
labelled or not, with their soft labels trains a sparse logistic scorer over hashed words, word beginnings and style rates,
which then judges every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_arrow, set_aside, slices, written

#: Documents of each posterior class that may train the scorer: a bound at any corpus size.
SAMPLE = 2500
#: Posterior or score from which a document counts as bad.
BAD = 0.5
#: Words that insult: an example list for a labeller, fixed values. Without it, insults are learned
#: from given labels only.
INSULTS = frozenset(
    b"trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()
)
LABELLERS = ("shout", "table", "symbols", "repeats", "sameness", "insults", "given")
ABSTAIN, GOOD, WRONG = 0, 1, 2
#: Share of its estimated accusations of good documents that a labeller is held to.
PRESUMED = 0.9
BITS = 21
STYLES = 6
WORDS_KEPT = 300_000

SYMBOLS = re.compile(rb"[#$%&*=~^]{2,}")
OUTER = b".,;:!?()[]\"'|#$%&*"


class WordKinds(dict):
    """Flags of a word: 1 shouted, 2 table bar, 4 symbol run, 8 insult."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        text = word.decode()
        kind = 1 * (text.isupper() and "!!" in text) + 2 * (word == b"|")
        kind += 4 * bool(SYMBOLS.search(word)) + 8 * (word.lower().strip(OUTER) in INSULTS)
        self[word] = kind
        return kind


class WordFeatures(dict):
    """Three hashed features of a word in one number: itself, its beginning, its end."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        text = word.decode().lower().strip(OUTER.decode())
        value = 0
        for form in (f"={text}", f"<{text[:7]}", f">{text[-7:]}"):
            value = value << BITS | xxhash.xxh32_intdigest(form.encode()) >> (32 - BITS)
        self[word] = value
        return value


def style(parts: list[bytes], kinds: WordKinds) -> np.ndarray:
    """Rates of shouted words, bars, symbol runs, neighbours alike, sameness; number of insults."""
    n = len(parts)
    if not n:
        return np.zeros(STYLES)
    flags = np.fromiter(map(kinds.__getitem__, parts), np.uint8, n)
    again = sum(map(bytes.__eq__, parts[1:], parts)) / n
    # In stretches, as a long text of any kind repeats more of its words.
    same = 1 - sum(len(set(parts[k : k + 200])) for k in range(0, n, 200)) / n
    rates = [np.count_nonzero(flags & bit) / n for bit in (1, 2, 4)]
    return np.array([*rates, again, same, float(np.count_nonzero(flags & 8))])


def votes(parts: list[bytes], rates: np.ndarray) -> int:
    """Pattern of the heuristic labellers' votes, two bits each; short texts give no votes."""
    if len(parts) < 5:
        return 0
    shout, bars, symbols, again, same, insults = rates
    own = [
        WRONG if shout > 0.3 else GOOD if shout < 0.02 else ABSTAIN,
        WRONG if bars > 0.15 else GOOD if bars < 0.02 else ABSTAIN,
        WRONG if symbols > 0.1 else GOOD if symbols < 0.02 else ABSTAIN,
        WRONG if again > 0.25 else GOOD if again < 0.1 else ABSTAIN,
        ABSTAIN if len(parts) < 40 else WRONG if same > 0.8 else GOOD if same < 0.6 else ABSTAIN,
        WRONG if insults >= 2 and insults > 0.001 * len(parts) else ABSTAIN if insults else GOOD,
    ]
    return sum(v << 2 * k for k, v in enumerate(own))


def vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = WordKinds()
    for part in slices(batches):
        own = [(x or "").encode().split() for x in part[1].to_pylist()]
        patterns = [votes(parts, style(parts, kinds)) for parts in own]
        yield pa.RecordBatch.from_arrays(
            [part[0], pa.array(patterns, pa.int32())], names=["doc_id", "pattern"]
        )


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of being bad for each vote pattern, by expectation-maximisation.

    Two models of how labellers err are estimated, and the likelier one, less the usual penalty
    for its parameters, counts. Either bad documents are of one kind, which labellers overlap on;
    or there is a kind for each heuristic labeller, and one that only given labels call bad: then
    that labellers of other kinds find nothing clears nobody. No labeller is held to accuse bad documents less often than good ones.
    Counts alone can't tell whether an accuser whom no other joins is right; it is presumed to
    be, and given labels outweigh that. They are observed, not estimated. What nobody calls
    bad is not.
    """
    fits = [fitted(patterns, counts, several, rounds) for several in (False, True)]
    return max(fits, key=lambda fit: fit[0])[1]


def fitted(
    patterns: np.ndarray, counts: np.ndarray, several: bool, rounds: int
) -> tuple[float, np.ndarray]:
    """(penalised log-likelihood, posterior of being bad) of one model."""
    cast = np.stack([(patterns >> 2 * k) & 3 for k in range(len(LABELLERS))], axis=1)
    given, cast = cast[:, -1], cast[:, :-1]
    hit, looked = cast == WRONG, cast != ABSTAIN
    accused = hit.any(axis=1)
    unjudged = ~accused & (given == ABSTAIN)
    n = hit.shape[1]
    bad_kinds = n + 1 if several else 1
    allowed = np.ones((len(patterns), 1 + bad_kinds), bool)
    allowed[given == WRONG, 0] = False
    allowed[given == GOOD, 1:] = False

    def observed(share: np.ndarray) -> np.ndarray:
        share = np.where(allowed, share, 0)
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
        bad = 1 - share[:, 0]
        over = unjudged & (bad > 0.1)
        share[over, 1:] *= (0.1 / np.maximum(bad[over], 1e-300))[:, None]
        share[over, 0] = 0.9
        return share

    share = np.full(allowed.shape, 0.1 / bad_kinds)
    share[:, 0] = np.where(accused, 0.1, 0.9)
    share[accused, 1:] = 0.9
    if several:
        share[accused, 1:-1] = 0.9 * hit[accused] / hit[accused].sum(axis=1, keepdims=True)
        share[accused, -1] = 0
    share = observed(share)
    likely = 0.0
    for _ in range(rounds):
        weight = share * counts[:, None]
        rate = (weight.T @ hit + 0.1) / (weight.T @ looked + 0.2)
        if several:
            rate[0] = (PRESUMED * weight[:, 0] @ hit + 1e-3) / (weight[:, 0] @ looked + 1)
        rate[1:] = np.maximum(rate[1:], rate[0])
        prior = weight.sum(axis=0) + 0.1
        log = np.log(prior / prior.sum())
        log = log + hit @ np.log(rate).T + (looked & ~hit) @ np.log(1 - rate).T
        top = log.max(axis=1, keepdims=True)
        new = np.exp(log - top)
        mass = np.where(allowed, new, 0).sum(axis=1)
        likely = float(counts @ (np.log(np.maximum(mass, 1e-300)) + top[:, 0]))
        new = observed(new / new.sum(axis=1, keepdims=True))
        done = np.abs(new - share).max(initial=0) < 1e-9
        share = new
        if done:
            break
    parameters = (1 + bad_kinds) * n + bad_kinds
    return likely - parameters * np.log(max(1.0, counts.sum())) / 2, 1 - share[:, 0]


def features(text: str | None, words: WordFeatures, kinds: WordKinds):
    """(indices, values) of a text: hashed features by log count, style rates behind them."""
    parts = (text or "").encode().split()
    packed, count = np.unique(
        np.fromiter(map(words.__getitem__, parts), np.int64, len(parts)), return_counts=True
    )
    mask = (1 << BITS) - 1
    index = np.concatenate([(packed >> BITS * k) & mask for k in range(3)])
    index, at = np.unique(index, return_inverse=True)
    value = np.log1p(np.bincount(at, np.tile(count, 3), minlength=len(index)))
    rates = style(parts, kinds)
    rates[5] = min(rates[5], 10) / 10
    extra = np.r_[np.sqrt(rates), 1.0] * 4
    return np.r_[index, (1 << BITS) + np.arange(STYLES + 1)], np.r_[value * 0.3, extra]


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, kinds = WordFeatures(), WordKinds()
    for part in slices(batches):
        found = [features(x, words, kinds) for x in part[1].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                part[0],
                pa.array([i for i, _ in found], pa.list_(pa.int32())),
                pa.array([v for _, v in found], pa.list_(pa.float32())),
            ],
            names=["bad", "index", "value"],
        )


def train(index: list, value: list, bad: np.ndarray, rounds: int = 150, sparse: float = 2e-4):
    """(indices, weights) of a logistic scorer with an L1 penalty, by proximal Adam steps."""
    used, at = np.unique(np.concatenate(index), return_inverse=True)
    at = at.astype(np.int32)
    row = np.repeat(np.arange(len(index), dtype=np.int32), [len(x) for x in index])
    value = np.concatenate(value).astype(np.float32)
    balance = np.where(bad >= BAD, 0.5 / max(1, (bad >= BAD).sum()), 0.5 / max(1, (bad < BAD).sum()))
    w, mean, square = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    for step in range(1, rounds + 1):
        margin = np.bincount(row, w.astype(np.float32)[at] * value, minlength=len(index))
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - bad) * balance
        slope = np.bincount(at, error.astype(np.float32)[row] * value, minlength=len(used))
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        scale = 0.1 / (np.sqrt(square / (1 - 0.99**step)) + 1e-5)
        w -= scale * mean / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(0, np.abs(w) - np.minimum(scale, 1e3) * sparse)
    keep = w != 0
    return used[keep], w[keep]


def trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The scorer of the sampled rows, which one task can hold; none without both kinds."""
    bad, index, value = [], [], []
    for batch in batches:
        bad += batch[0].to_pylist()
        index += [x.values.to_numpy() for x in batch[1]]
        value += [x.values.to_numpy() for x in batch[2]]
    bad = np.array(bad)
    if len(bad) and 0 < (bad >= BAD).sum() < len(bad):
        used, w = train(index, value, bad)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(w)], names=["index", "weight"]
        )


def scorer(model, with_text: bool):
    names = ["row", *["text"] * with_text, "bad_score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kinds = WordFeatures(), WordKinds()
        index, weight = model.value
        table = np.zeros((1 << BITS) + STYLES + 1)
        table[index] = weight
        for part in slices(batches):
            found = [features(x, words, kinds) for x in part[1].to_pylist()]
            margin = np.array([float(table[i] @ v) for i, v in found])
            score = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
            columns = [part[0], *[part[1]] * with_text, pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return work


def fit(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE):
    """The scorer ``(indices, weights)`` of a corpus, and its table of vote patterns."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cast = written(map_arrow(source, vote_rows, "doc_id long, pattern int"), "votes")
    given = F.lit(0)
    if labels is not None:
        own = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
        own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.max(F.expr("if(quality = 0 or toxic = 1, 2, 1)")).alias("vote")
        )
        cast = cast.join(own, "doc_id", "left")
        given = F.coalesce("vote", F.lit(0))
    shift = 2 * (len(LABELLERS) - 1)
    cast = cast.select("doc_id", (F.col("pattern") + F.shiftleft(given, shift)).alias("pattern"))
    table = cast.groupBy("pattern").count().orderBy("pattern").toPandas()
    patterns, counts = table["pattern"].to_numpy(np.int64), table["count"].to_numpy(np.float64)
    bad = estimate(patterns, counts)
    spark = docs.sparkSession
    known = spark.createDataFrame(
        [(int(p), float(b)) for p, b in zip(patterns, bad, strict=True)],
        "pattern int, bad double",
    )
    # What got no vote has no label, soft or given, to learn from.
    soft = cast.where("doc_id is not null and pattern != 0").join(F.broadcast(known), "pattern")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = soft.where(F.col("bad") >= BAD).orderBy(*order).limit(sample)
    chosen = chosen.union(soft.where(F.col("bad") < BAD).orderBy(*order).limit(sample))
    chosen = chosen.groupBy("doc_id").agg(F.max("bad").alias("bad"))
    # Of a repeated id one text is enough.
    texts = source.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    texts = texts.select("bad", "text")
    rows = map_arrow(texts, feature_rows, "bad double, index array<int>, value array<float>")
    model = map_arrow(rows.repartition(1), trainer, "index int, weight double").toPandas()
    return model["index"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)


def judged(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, bad_score, keep)`` for each document; it is kept below a score of one half.

    ``labels`` (doc_id, quality, toxic) is one of the labellers and may be None or empty; nulls
    in it are no votes. Null and empty texts have no words and are judged by that alone. A null
    or repeated id is judged by its own text. Unless there are documents of both kinds to learn
    from, all are kept.
    """
    return scored(docs.select("doc_id", "text"), labels, sample, with_text=False)


def scored(
    docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE, with_text: bool = True
) -> DataFrame:
    """``docs``, with or without their text, with ``bad_score`` and ``keep``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    names = [c for c in docs.columns if c not in ("bad_score", "keep", "text")]
    rows = docs.select(F.struct(*names).alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    text = "text string, " if with_text else ""
    out = map_arrow(rows, scorer(model, with_text), f"row {kind}, {text}bad_score double")
    keep = F.coalesce(F.col("bad_score") < BAD, F.lit(True))
    if not len(model.value[0]):
        keep = F.lit(True)
    return out.select("row.*", *["text"] * with_text, "bad_score", keep.alias("keep"))


def kept(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    own, columns = set_aside(docs, "bad_score", "keep")
    return scored(own, labels, sample).where("keep").select(columns)
