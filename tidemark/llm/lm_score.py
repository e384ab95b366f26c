"""Language-model scores by a weighted backoff automaton over words.

Smoothed n-grams of words are the automaton: a state is a context of no, one or two words; it
has arcs for the words seen at least ``MIN_COUNT`` times after it, and a failure arc to the
context one word shorter, which weighs what the arcs leave. A text is read from left to right
between its ends: each word is weighed from the state the ones before it lead to, over failure
arcs where the state has no arc for it. Unknown words share what words seen once suggest they
deserve. All of it adds up to one over the known words and the unknown one, the outcomes of the
base score.

Counts cover all training texts and all their words, bigrams and trigrams; what is an arc depends
on its own count alone, not on the size of the corpus. Nothing is gathered in one place: texts are
cut into pieces, some of which are a chunk, and a chunk deals the distinct trigrams of its pieces
over tasks by their first words, each with its count in the piece's training texts. A bigram's count
is the sum over the trigrams that begin with it, as a text goes on with one more symbol after its
end, so bigrams are not dealt. Bigrams of a frequent word are spread over several buckets by the
second one, and a chunk asks all of them for that word's state. A bucket adds up what it holds and
answers each chunk in the order the chunk named it, so answers carry no n-grams. Frequent words are
named by numbers of up to three bytes, all others by hashes of eight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.language_id import held_out
from tidemark.llm.text import STEP as ODD
from tidemark.llm.text import map_arrow, mix, slices, written

#: Least count of an n-gram that is an arc, at any size of the corpus.
MIN_COUNT = 2
#: Most symbols of a model that is held in one place, less the class of all others.
HOT_WORDS = 1 << 16
#: Words, about, that n-grams name by a number.
NAMED_WORDS = 1 << 18
#: Bits of a symbol in the n-gram keys of such a model; symbols beyond have no arcs there.
SYMBOL_BITS = 10
#: Entries after which a task adds up what it holds.
HELD = 2_000_000
#: Characters of the texts of a piece, rows that are added to it at a time, and pieces of a chunk.
STEP = 1 << 21
ROWS = 16
PIECES = 8
#: Characters of the texts whose n-grams a task counts, and shares of them per task.
TASK_CHARS = 1 << 24
SHARES = 3

END_WORD = b"\n"
#: The two symbols before a text and the one after its end: no words, and no outcomes.
BEFORE, BEGIN, AFTER = b"\t", b"\r", b"\f"
WORDS_KEPT = 300_000

#: ``data`` holds texts, see ``chunker``, or columns of numbers, see ``packed``.
CHUNKS = "chunk long, chars long, asked boolean, data binary"
GRAMS = "bucket int, chunk long, asked boolean, data binary"
ANSWERS = "chunk long, bucket int, data binary"
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def word_key(word: bytes) -> int:
    """Hash of a word as a negative number; plain numbers from 0 are left for hot words."""
    return xxhash.xxh64_intdigest(word) % (1 << 63) - (1 << 63)


def word_keys(words: list[bytes]) -> np.ndarray:
    value = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return (value | np.uint64(1 << 63)).view(np.int64)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, compressed byte by byte of the numbers, as many as the largest has."""
    sizes, parts = [], []
    for c in columns:
        width = 8 if len(c) and c.min() < 0 else (int(c.max(initial=0)).bit_length() + 7) // 8
        sizes += [len(c), width]
        parts.append(c.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    head = np.array([len(columns), *sizes], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpacked(data: bytes, small: bool = False) -> list[np.ndarray]:
    """The columns; ``small``: of the least type that holds them, if none is below 0."""
    data = np.frombuffer(zstandard.decompress(data), np.uint8)
    count = int(data[:8].view(np.int64)[0])
    at, out = 8 * (2 * count + 1), []
    for n, width in data[8:at].view(np.int64).reshape(-1, 2).tolist():
        room = next(x for x in (1, 2, 4, 8) if x >= width) if small else 8
        whole = np.zeros((n, room), np.uint8)
        whole[:, :width] = data[at : at + n * width].reshape(width, n).T
        out.append(whole.view("<i8" if room == 8 else f"<u{room}").ravel())
        at += n * width
    return out


def parted(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names from 1, with 0 for each word that is named by a hash, and those hashes."""
    rare = names < 0
    return np.where(rare, 0, names + 1), names[rare]


def joined(names: np.ndarray, rare: np.ndarray) -> np.ndarray:
    out = names - 1
    out[names == 0] = rare
    return out


def gram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram as a number from 0; word keys are below it."""
    value = mix(before.view(np.uint64) * ODD + word.view(np.uint64))
    return (value >> np.uint64(1)).view(np.int64)


def added(parts: list, firsts: int) -> list[np.ndarray]:
    """Columns of the distinct first column; beyond ``firsts`` columns they are added up.

    Takes the parts out of their list, so that they are not held beside the sums.
    """
    columns = parts[0] if len(parts) == 1 else [np.concatenate(c) for c in zip(*parts, strict=True)]
    parts.clear()
    code, keys = pd.factorize(columns[0])
    out = [keys, *(np.empty(len(keys), np.int64) for _ in columns[1:firsts])]
    for own, column in zip(out[1:], columns[1:firsts], strict=True):
        own[code] = column
    # Whole numbers, exact as doubles: they are counts of tokens.
    return out + [np.bincount(code, c, len(keys)).astype(np.int64) for c in columns[firsts:]]


class Places(dict):
    """The number of a hot word, or the key of another one."""

    def __init__(self, hot: dict[int, int]):
        self.hot = hot

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        key = word_key(word)
        place = self[word] = self.hot.get(key, key)
        return place


def laid_out(texts: list[list[bytes]], places: Places, rare: int):
    """(keys, symbols, begins, sizes) of texts, each after two ends and with an end.

    ``keys`` are places as they are; in ``symbols`` every word that is not hot is ``rare``.
    """
    sizes = np.array([len(x) + 1 for x in texts], np.int64)
    flat = [w for words in texts for w in (END_WORD, END_WORD, *words, END_WORD)]
    keys = np.fromiter(map(places.__getitem__, flat), np.int64, len(flat))
    begins = np.cumsum(sizes + 2) - sizes
    return keys, np.where(keys < 0, rare, keys), begins, sizes


def own_places(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the texts' words and ends, without the two ends before each text."""
    own = np.zeros(len(symbols) + 1, np.int8)
    own[begins] += 1
    own[begins + sizes] -= 1
    return np.flatnonzero(np.cumsum(own)[:-1])


def pairs_and_triples(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray):
    """Keys of a model in one place: bigrams and trigrams of symbols that end in each text."""
    at = own_places(symbols, begins, sizes)
    two, three = symbol_keys(symbols[at - 1], symbols[at]), symbol_keys(*(symbols[at - k] for k in (2, 1, 0)))
    return two[two >= 0], three[three >= 0]


def symbol_keys(*symbols: np.ndarray) -> np.ndarray:
    key = np.zeros(len(symbols[0]), np.int64)
    for own in symbols:
        key = key << SYMBOL_BITS | own
    return np.where(np.max(symbols, axis=0) >> SYMBOL_BITS, -1, key)


class Grams:
    """The distinct trigrams of a piece, by the bigrams they begin with and these by their first words.

    A word's bigrams are in ``spread`` buckets, each of which has a part of it. Parts, bigrams
    and trigrams are numbered bucket by bucket. For each of the texts' places, ``word`` is the
    number of the word among the piece's ``names``, ``before`` the one before it, ``pair`` and
    ``triple`` are the bigram and trigram that end there, ``pair_before`` is the bigram before the word.
    """

    def __init__(self, texts: Texts, hot: pd.Index, spread: np.ndarray, buckets: int):
        self.sizes = texts.sizes + 1
        keys = np.r_[texts.keys(), word_keys([BEFORE, BEGIN, END_WORD, AFTER])]
        place = hot.get_indexer(keys)
        self.names = np.where(place < 0, keys, place)
        k = len(keys)
        before, begin, end, after = range(k - 4, k)
        ends = np.cumsum(self.sizes + 3)
        first = ends - self.sizes - 3
        local = np.full(ends[-1], -1, np.int64)
        local[first], local[first + 1], local[ends - 2], local[ends - 1] = before, begin, end, after
        local[local < 0] = texts.words
        goes_on = np.ones(len(local), bool)
        goes_on[ends - 1] = goes_on[ends - 2] = False
        at = np.flatnonzero(goes_on)
        b, c = local[at + 1], local[at + 2]
        pair, pairs = pd.factorize(local[at] * k + b)
        triple, triples = pd.factorize(pair * k + c)
        # What begins a text is as frequent as the end.
        parts = np.where(self.names < 0, 1, np.append(spread, 1)[np.maximum(self.names, 0)])
        parts[begin] = parts[end]
        self.deal(pairs // k, pairs % k, triples // k, triples % k, parts, buckets)
        self.begins = self.new_triple[triple]
        # The trigram of a text's end and what comes after it ends at none of the text's places.
        own = np.ones(len(at), bool)
        own[np.cumsum(self.sizes + 1) - 1] = False
        own = np.flatnonzero(own)
        self.triple, self.pair_before = self.begins[own], self.new_pair[pair[own]]
        self.pair, self.before, self.word = self.new_pair[pair[own + 1]], b[own], c[own]
        # The end leads nowhere: its count is that of what comes before a first word.
        self.count_of = np.arange(k)
        self.count_of[end] = begin

    def deal(self, a, b, of_pair, c, parts: np.ndarray, buckets: int) -> None:
        """Numbers ``parts`` of the words, bigrams ``(a, b)`` and trigrams ``(of_pair, c)`` by buckets."""
        names = self.names
        drawn = (mix(names.view(np.uint64)) >> np.uint64(1)).view(np.int64)
        leads = np.zeros(len(names), bool)
        leads[a] = True
        parts = np.where(leads, parts, 0)
        base = np.cumsum(parts) - parts
        of_part = np.repeat(np.arange(len(names)), parts)
        bucket = (drawn[of_part] + np.arange(len(of_part)) - base[of_part]) % buckets
        part = base[a] + drawn[b] % parts[a]

        rank = np.empty(len(names), np.int64)
        rank[np.argsort(names)] = np.arange(len(names))

        def numbered(group: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(group * len(names) + rank[name])
            new = np.empty(len(order), np.int64)
            new[order] = np.arange(len(order))
            return order, new

        order, new_part = numbered(bucket, of_part)
        self.part_word = of_part[order]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        by_part, self.new_pair = numbered(new_part[part], b)
        self.pair_word = b[by_part]
        self.pairs_of = np.bincount(new_part[part], minlength=len(order))
        by_pair, self.new_triple = numbered(self.new_pair[of_pair], c)
        self.triple_word = c[by_pair]
        self.triples_of = np.bincount(self.new_pair[of_pair], minlength=len(by_part))
        cut_pairs = np.r_[0, np.cumsum(self.pairs_of)][cut]
        cut_triples = np.r_[0, np.cumsum(self.triples_of)][cut_pairs]
        self.cuts = np.stack([cut, cut_pairs, cut_triples], axis=1)

    def counts(self, trained: np.ndarray) -> np.ndarray:
        """How often each trigram is in the texts ``trained``."""
        own = np.repeat(trained, self.sizes + 1)
        return np.bincount(self.begins[own], minlength=len(self.triple_word))

    def dealt(self, counts: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """(bounds of the buckets, (names, sizes) of parts, bigrams and trigrams); for sizes, ``counts``."""
        words = self.part_word, self.pair_word, self.triple_word
        sizes = self.pairs_of, self.triples_of, counts
        return self.cuts, [[self.names[w], n.astype(np.int32)] for w, n in zip(words, sizes, strict=True)]


def shares(pieces: list[tuple[np.ndarray, list[list[np.ndarray]]]]) -> Iterator[tuple[int, bytes]]:
    """(bucket, what a chunk has in it, piece by piece) of its pieces' ``dealt``; see ``keys_of``."""
    for k in range(len(pieces[0][0]) - 1):
        columns = []
        for level in range(3):
            for column in range(2):
                parts = [own[level][column][slice(*cuts[k : k + 2, level])] for cuts, own in pieces]
                made = np.concatenate(parts)
                columns += [made] if column else parted(made)
        if len(columns[0]):
            yield k, packed(*columns)


def framed(pieces: list[bytes]) -> bytes:
    return np.array([len(pieces), *map(len, pieces)], np.int64).tobytes() + b"".join(pieces)


def pieces_of(data: bytes) -> Iterator[bytes]:
    at = 8 * (1 + int(np.frombuffer(data, np.int64, 1)[0]))
    for size in np.frombuffer(data[8:at], np.int64).tolist():
        yield data[at : at + size]
        at += size


def chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``PIECES`` pieces, each with ``STEP`` characters of the texts: (doc_id, trained, asked, text)."""
    chunk, pieces, chars, asked, parts, size = TaskContext.get().partitionId() << 36, [], 0, False, [], 0

    def piece() -> bytes:
        rows = pa.Table.from_batches(parts)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows.combine_chunks())
        return zstandard.ZstdCompressor(level=6).compress(sink.getvalue())

    def row() -> pa.RecordBatch:
        columns = [pa.array([x]) for x in (chunk, chars, asked, framed(pieces))]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in CHUNKS.split(", ")])

    for part in slices(batches, ROWS):
        parts.append(part)
        asked = asked or any(part["asked"].to_pylist())
        size += sum(len(x or "") for x in part["text"].to_pylist())
        if size >= STEP:
            pieces.append(piece())
            chars, parts, size = chars + size, [], 0
            if len(pieces) == PIECES:
                yield row()
                chunk, pieces, chars, asked = chunk + 1, [], 0, False
    if parts:
        pieces.append(piece())
        chars += size
    if pieces:
        yield row()


class Texts:
    """The texts of a piece: ``ids``, ``trained``, ``asked``, and ``words``, numbers in ``known``.

    ``sizes`` has the number of words of each text.
    """

    def __init__(self, data: bytes):
        rows = pa.ipc.open_stream(zstandard.decompress(data)).read_all().combine_chunks()
        self.ids = rows["doc_id"].to_pylist()
        self.trained, self.asked = (np.array(rows[c].to_pylist(), bool) for c in ("trained", "asked"))
        text = pa.concat_arrays(rows["text"].cast(pa.large_string()).chunks)
        parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
        flat = parts.flatten()
        # White space at the ends of a text leaves empty strings there.
        full = pc.not_equal(pc.binary_length(flat), 0)
        ends = np.cumsum(np.r_[0, full.to_numpy(zero_copy_only=False)])
        self.sizes = np.diff(ends[np.r_[0, np.cumsum(pc.list_value_length(parts).to_numpy())]])
        words = flat.filter(full).dictionary_encode()
        self.words = words.indices.to_numpy().astype(np.int64)
        self.known = words.dictionary.cast(pa.large_binary()).to_pylist()

    def keys(self) -> np.ndarray:
        """The key of each known word."""
        return word_keys(self.known)

    def own_words(self, texts: np.ndarray) -> np.ndarray:
        """The words of the texts marked."""
        return self.words[np.repeat(texts, self.sizes)]


def word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words and ends of the training texts."""
    parts, held = [], 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in added(parts, 1)], names=["word", "n"])

    for batch in batches:
        for data in (x for row in batch[0] for x in pieces_of(row.as_py())):
            texts = Texts(data)
            n = np.bincount(texts.own_words(texts.trained), minlength=len(texts.known))
            ends = np.array([[word_key(END_WORD)], [texts.trained.sum()]], np.int64)
            found = np.concatenate([np.stack([texts.keys(), n]), ends], axis=1)
            parts.append(found[:, found[1] > 0])
            held += parts[-1].shape[1]
            if held > HELD:
                yield rows()
                parts, held = [], 0
    if parts:
        yield rows()


def asker(named, buckets: int):
    """The trigrams of each chunk by bucket, with their counts in its training texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spread = named.value
        hot = pd.Index(words)
        for part in slices(batches, ROWS):
            for chunk, asked, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                pieces = []
                for texts in map(Texts, pieces_of(data)):
                    found = Grams(texts, hot, spread, buckets)
                    pieces.append(found.dealt(found.counts(texts.trained)))
                rows = [(k, chunk, asked, x) for k, x in shares(pieces)]
                columns = zip(*rows, strict=True)
                kinds_of = (pa.int32(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds_of, strict=True)],
                    names=[x.split()[0] for x in GRAMS.split(", ")],
                )

    return work


def keys_of(data: bytes) -> tuple[np.ndarray, ...]:
    """(word of each part; key of each bigram, its word; key of each trigram; its count) of a share.

    The words and keys of what a trigram begins with are given once for each trigram as well.
    """
    word, rare, pairs, second, rare_second, triples, third, rare_third, n = unpacked(data)
    word = joined(word, rare)
    first = np.repeat(word, pairs)
    pair = gram(first, joined(second, rare_second))
    before = np.repeat(pair, triples)
    triple = gram(before, joined(third, rare_third))
    return word, pair, (triple, before, np.repeat(first, triples), n)


def answerer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each chunk the counts of its arcs, and (count, arcs, sum of the arcs' counts) of its states.

    The rows are sorted by bucket; of one bucket, which is bounded, the n-grams are held.
    """
    now, asked, parts, held = None, [], [], 0
    for part in slices(batches, ROWS):
        for bucket, chunk, wanted, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if bucket != now:
                yield from answered(now, asked, parts)
                now, asked, parts, held = bucket, [], [], 0
            if wanted:
                asked.append((chunk, data))
            rows = keys_of(data)[-1]
            seen = rows[-1] > 0
            parts.append([x[seen] for x in rows])
            held += len(parts[-1][0])
            if held > HELD:
                parts, held = [added(parts, 3)], 0
    yield from answered(now, asked, parts)


def answered(bucket: int | None, asked: list[tuple[int, bytes]], parts: list[np.ndarray]):
    """Answers of a bucket to the shares ``asked``; ``parts`` are (key, bigram, first word, count) of trigrams."""
    if not asked:
        return

    def arcs(n: np.ndarray) -> list[np.ndarray]:
        arc = n >= MIN_COUNT
        return [n, arc.astype(np.int64), n * arc]

    triples, before, first, n = added(parts, 3)
    own = arcs(n)
    triples, n = triples[n >= MIN_COUNT], n[n >= MIN_COUNT]
    pairs = added([[before, first, *own]], 2)
    del before, first, own
    words = added([[pairs[1], *arcs(pairs[2])]], 1)
    # What is seen less often than an arc has no arcs after it: its own count weighs nothing.
    arc = pairs[2] >= MIN_COUNT
    pairs = [x[arc] for x in pairs]
    tables = [pd.Index(x) for x in (triples, pairs[0], words[0])]
    # A key that is not there has the place -1.
    columns = [[np.append(x, 0) for x in own] for own in ([n], pairs[2:], words[1:])]
    for chunk, data in asked:
        word, pair, rows = keys_of(data)
        places = [table.get_indexer(x) for table, x in zip(tables, (rows[0], pair, word), strict=True)]
        found = [x[place] for place, own in zip(places, columns, strict=True) for x in own]
        made = [pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()), pa.array([packed(*found)])]
        yield pa.RecordBatch.from_arrays(made, names=["chunk", "bucket", "data"])


def weighed(n, seen, kinds, held) -> tuple[np.ndarray, np.ndarray]:
    """(weight of an arc of count ``n``, of the failure arc) of a state, by Witten and Bell.

    The state was seen ``seen`` times and has ``kinds`` arcs, of ``held`` counts in all.
    """
    total = np.maximum(1, np.maximum(seen, held) + kinds)
    return n / total, np.where(kinds > 0, 1 - held / total, 1.0)


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, dict[int, bytes]]]:
    """(texts, answers by bucket) of rows (chunk, bucket, data) sorted by chunk; texts have no bucket."""
    now, texts, answers = None, None, {}
    for part in slices(batches, ROWS):
        for chunk, bucket, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if chunk != now:
                if now is not None:
                    yield texts, answers
                now, texts, answers = chunk, None, {}
            if bucket is None:
                texts = data
            else:
                answers[bucket] = data
    if now is not None:
        yield texts, answers


def scorer(named, buckets: int, tokens: int, distinct: int, once: int):
    """Scores of chunks whose answers hold all that the training texts say of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spread = named.value
        hot = pd.Index(words)
        for data, answers in chunks_of(batches):
            # Of trigrams the counts; of bigrams and of words (count, arcs, sum of their counts).
            told = {k: unpacked(answers.pop(k), small=True) for k in sorted(answers)}
            at = np.zeros((buckets, 3), np.int64)
            for texts in map(Texts, pieces_of(data)):
                found = Grams(texts, hot, spread, buckets)
                start, at = at, at + np.diff(found.cuts, axis=0)

                def own(column: int, level: int) -> np.ndarray:
                    ends = zip(start[:, level].tolist(), at[:, level].tolist(), strict=True)
                    ends = [slice(*x) for x in ends]
                    return np.concatenate([x[column][ends[k]] for k, x in told.items()]).astype(np.int64)

                triples, *pairs_and_parts = (own(c, 2 - (c + 2) // 3) for c in range(7))
                pairs, parts = pairs_and_parts[:3], pairs_and_parts[3:]
                states = [np.bincount(found.part_word, x, len(found.names)) for x in parts]
                word = states[0][found.count_of[found.word]]
                chance = np.where(word > 0, word, once) / (tokens + once)
                for n, state in (
                    (pairs[0][found.pair], (x[found.before] for x in states)),
                    (triples[found.triple], (x[found.pair_before] for x in pairs)),
                ):
                    arc, fail = weighed(n, *state)
                    chance = arc + fail * chance
                values = np.stack([word > 0, np.log10((word + 1) / (tokens + distinct + 1)), np.log10(chance)])
                known, base, score = np.add.reduceat(values, np.cumsum(found.sizes) - found.sizes, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(texts.ids, pa.int64()),
                        pa.array(found.sizes),
                        pa.array(known.astype(np.int64)),
                        pa.array(base),
                        pa.array(score),
                    ],
                    names=[x.split()[0] for x in SCORED.split(", ")],
                ).filter(pa.array(texts.asked))

    return work


class Automaton:
    """The model of few symbols in one place, which the tests hold against the dealt one.

    ``counts``: of the symbols by number. ``rest``: count of all other words, which are the symbol
    ``HOT_WORDS``. ``once``: number of words seen once, the weight of unknown ones. ``pairs``,
    ``triples``: sorted (keys, counts). ``ends``: (symbol of the end, number of texts).
    """

    def __init__(self, counts: np.ndarray, rest: int, once: int, pairs, triples, ends=(0, 0)):
        total = counts.sum() + rest + once
        self.root = np.append(counts, np.zeros(HOT_WORDS + 1 - len(counts))) / total
        self.root[HOT_WORDS] = (rest + once) / total
        seen = np.append(counts, np.zeros(HOT_WORDS + 1 - len(counts)))
        seen[HOT_WORDS] = rest
        state = pairs[0] >> SYMBOL_BITS
        self.pairs = pairs[0], *self.smoothed(pairs[1], state, np.arange(len(seen)), seen)
        # A context of two symbols is a bigram, but for the two ends before a text.
        state = triples[0] >> SYMBOL_BITS
        self.states = np.unique(np.r_[pairs[0], state])
        seen = np.zeros(len(self.states))
        seen[np.searchsorted(self.states, pairs[0])] = pairs[1]
        seen[self.states == (ends[0] << SYMBOL_BITS | ends[0])] = ends[1]
        self.triples = triples[0], *self.smoothed(triples[1], state, self.states, seen)

    @staticmethod
    def smoothed(n, state, states, seen) -> tuple[np.ndarray, np.ndarray]:
        """(weight of each arc, weight of each state's failure arc)."""
        place = np.searchsorted(states, state)
        kinds = np.bincount(place, minlength=len(seen))
        held = np.bincount(place, n, minlength=len(seen))
        fail = weighed(0, seen, kinds, held)[1]
        return weighed(n, seen[place], kinds[place], held[place])[0], fail

    def read(self, symbols: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after those before it; the first two are 0."""
        c, b, a = symbols[2:], symbols[1:-1], symbols[:-2]
        chance = self.root[c] * self.pairs[2][b]
        self.add(chance, symbol_keys(b, c), *self.pairs[:2])
        place, there = self.find(symbol_keys(a, b), self.states)
        chance[there] *= self.triples[2][place[there]]
        self.add(chance, symbol_keys(a, b, c), *self.triples[:2])
        return np.r_[0.0, 0.0, np.log10(chance)]

    @staticmethod
    def find(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return place, table[place] == keys

    def add(self, chance, keys, table, weight) -> None:
        place, there = self.find(keys, table)
        chance[there] += weight[place[there]]


def columns_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = packed(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array([data])], names=["data"])


def frequent(words: DataFrame, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of the most frequent words, about ``NAMED_WORDS`` at most, frequent ones first."""
    if distinct > NAMED_WORDS:
        share = 1 - NAMED_WORDS / distinct
        words = words.where(F.col("n") > words.agg(F.percentile_approx("n", share)).head()[0])
    rows = map_arrow(words.select("word", "n"), columns_packed, "data binary").collect()
    parts = [unpacked(r.data) for r in rows]
    word, n = np.concatenate([np.empty((2, 0), np.int64), *(np.stack(x) for x in parts)], axis=1)
    order = np.lexsort((word, -n))
    return word[order], n[order]


def scored(rows: DataFrame) -> DataFrame:
    """Scores of the ``asked`` of ``rows (doc_id, trained, asked, text)`` by a model of the ``trained``."""
    spark = rows.sparkSession
    chunks = written(map_arrow(rows, chunker, CHUNKS), "chunks")
    words = map_arrow(chunks.select("data"), word_counter, "word long, n long")
    words = written(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    totals = words.selectExpr("coalesce(sum(n), 0)", "count(*)", "count_if(n = 1)").head()
    tokens, distinct, once = map(int, totals)
    chars = chunks.agg(F.sum("chars")).head()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // TASK_CHARS)
    buckets = SHARES * tasks
    hot, n = frequent(words, distinct)
    # A word's bigrams are in more than one bucket if they would be more than one's even share.
    spread = np.minimum(1 + n * buckets // max(1, tokens), buckets)
    named = spark.sparkContext.broadcast((hot, spread))
    grams = map_arrow(chunks.select("chunk", "asked", "data"), asker(named, buckets), GRAMS)
    grams = grams.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    answers = map_arrow(grams, answerer, ANSWERS)
    texts = chunks.where("asked").select("chunk", F.lit(None).cast("int").alias("bucket"), "data")
    rows = texts.union(answers).repartition(2 * tasks, "chunk").sortWithinPartitions("chunk")
    work = scorer(named, buckets, tokens, distinct, max(1, once))
    return map_arrow(rows, work, SCORED).select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def marked(docs: DataFrame, trained: Column, asked: bool) -> DataFrame:
    own = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(own, trained.alias("trained"), F.lit(asked).alias("asked"), "text")


def score(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Scores of ``docs (doc_id, text)`` by a model of ``training (doc_id, text)``.

    Per row of ``docs``: doc_id, n_tokens (words and the end), n_known (of them in training),
    train_tokens, base_score (add-one unigrams of words, log10) and score (log10 probability of
    the text by the automaton). A null text has the end only. Rows keep null and repeated
    ids. Without training texts all is unknown. Other columns are ignored.
    """
    return scored(marked(docs, F.lit(False), True).union(marked(training, F.lit(True), False)))


def held_out_scores(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Scores of all documents by a model of those outside of fold ``fold``."""
    away = held_out(folds, fold)
    return scored(marked(docs, ~away, True)).withColumn("held_out", away)
