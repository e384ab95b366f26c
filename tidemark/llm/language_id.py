"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a binary classifier over hashed byte n-grams
tells the languages with a one from those with a zero. A text's language is the one whose
codeword loses least against the bits' margins, each bit weighted by how well it parts its
languages; a small lead over the next language marks the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_arrow, packed, slices, summed_arrays

ORDERS = (2, 3)
BUCKETS = 1 << 16
#: Bytes of a text that are looked at in one step.
STEP = 1 << 20
#: Lead in probability below which a text is ambiguous.
LEAD = 0.2
UNKNOWN = "und"

#: ASCII letters and bytes of other scripts stay; everything else becomes a blank.
PLAIN = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def grams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams of a text, a step of bytes at a time."""
    data = np.frombuffer(b" " + text.encode().translate(PLAIN) + b" ", np.uint8)
    for at in range(0, len(data), STEP):
        part = data[at : at + STEP + max(ORDERS) - 1].astype(np.uint32)
        for order in ORDERS:
            n = min(STEP, len(part) - order + 1)
            if n > 0:
                value = part[:n].copy()
                for k in range(1, order):
                    value = value * np.uint32(0x9E3779B1) + part[k : k + n] + np.uint32(order)
                yield (value * np.uint32(0x85EBCA6B)) >> np.uint32(16)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of the task's texts, a row for each language."""
    counts: dict[str, np.ndarray] = {}
    for part in slices(batches):
        for lang, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for found in grams(text):
                if len(found) > BUCKETS // 8:
                    own += np.bincount(found, minlength=BUCKETS)
                else:
                    np.add.at(own, found, 1)
    if counts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts)), pa.array([packed(x) for x in counts.values()])],
            names=["lang", "counts"],
        )


def codewords(n: int) -> np.ndarray:
    """(n, bits) of -1 and 1: all ways to part few languages, random ones for many."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        columns = [[1] + [1 if c >> k & 1 else -1 for k in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns).T.astype(float)
    bits = 15 * int(np.ceil(np.log2(n)))
    best, apart = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        distance = ((code[:, None, :] != code[None, :, :]).sum(axis=2) + bits * np.eye(n)).min()
        if distance > apart and (np.abs(code.sum(axis=0)) < n).all():
            best, apart = code, distance
    return best


class Model:
    """Bit classifiers (buckets, bits), codewords (languages, bits) and bit weights."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        rates = [(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in self.langs]
        rates = np.array(rates).reshape(-1, BUCKETS)
        self.code = codewords(len(self.langs))
        bits = self.code.shape[1]
        table = np.zeros((BUCKETS, bits))
        for k in range(bits):
            ones = self.code[:, k] > 0
            if not ones.all():
                table[:, k] = np.log(rates[ones].mean(axis=0) / rates[~ones].mean(axis=0))
        margins = rates @ table * self.code
        self.weights = np.maximum(margins.min(axis=0, initial=10), 0) + 1e-6
        self.weights /= self.weights.sum()
        self.table = table.astype(np.float32)

    def parts(self) -> tuple:
        return self.langs, self.code, self.weights, self.table


def predictor(model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, code, weights, table = model.value
        for part in slices(batches):
            names, scores, unsure = [], [], []
            for letters, text in zip(part[1].to_pylist(), part[2].to_pylist(), strict=True):
                if not letters or not langs:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    unsure.append(True)
                    continue
                total, n = np.zeros(code.shape[1]), 0
                for found in grams(text):
                    total += table[found].sum(axis=0, dtype=np.float64)
                    n += len(found)
                # Neighbouring n-grams overlap: their evidence counts as that of fewer.
                margin = total / max(1, n) * min(n, 400) / len(ORDERS) / 2
                loss = np.logaddexp(0, -np.clip(code * margin, -500, 500)) @ weights
                chance = np.exp((loss.min() - loss) * code.shape[1])
                chance /= chance.sum()
                order = np.argsort(-chance, kind="stable")
                names.append(langs[order[0]])
                scores.append(float(chance[order[0]]))
                lead = chance[order[0]] - chance[order[1]] if len(langs) > 1 else 1.0
                unsure.append(bool(lead < LEAD))
            yield pa.RecordBatch.from_arrays(
                [part[0], pa.array(names), pa.array(scores, pa.float64()), pa.array(unsure)],
                names=["row", "lang_pred", "score", "ambiguous"],
            )

    return work


def fit(texts: DataFrame) -> Model:
    """The model of the rows ``(lang, text)`` that have both."""
    known = texts.where("lang is not null and text is not null")
    parts = map_arrow(known.select("lang", "text"), counted, "lang string, counts binary")
    return Model({lang: counts for (lang,), counts in summed_arrays(parts, "lang").items()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing
    was learned. Columns of these names are replaced, all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous", "text")]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.struct(*names).alias("row"), letters.alias("letters"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    out = map_arrow(
        rows, predictor(shared), f"row {kind}, lang_pred string, score double, ambiguous boolean"
    )
    return out.select("row.*", "lang_pred", "score", "ambiguous")


def held_out(folds: int, fold: int) -> Column:
    """The document is in fold ``fold`` of ``folds`` by the checksum of its id."""
    return F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False)
    )


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, ambiguous)``; learned from the other folds."""
    rows = docs.select("doc_id", held_out(folds, 0).alias("held_out"), "lang", "text")
    model = fit(rows.where("not held_out"))
    return predict(rows.select("doc_id", "held_out", "text"), model)
