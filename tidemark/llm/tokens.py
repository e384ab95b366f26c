"""Token ids of whole texts by the tokenizers library, with the ids of known words remembered."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast, SparkContext

#: Words whose ids a worker remembers; the first ones, as frequent words come early.
WORDS_KEPT = 600_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class TextEncoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and lower-cases, and never joins what white space parts,
    so a text of Latin-1 characters is the sequence of its words. The ids of a word come from
    the library and are remembered; a word of letters goes straight to the library's model, as
    normaliser and splitter leave it whole. Other texts, and texts that may hold special
    tokens, go through the library as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.model = self.tool.model
        self.letters = byte_letters()
        self.marks = {m: self.whole(m) for m in ".,"}
        encoder = self

        class Known(dict):
            def __missing__(self, word: bytes) -> bytes:
                ids = encoder.word(word)
                if len(self) < WORDS_KEPT:
                    self[word] = ids
                return ids

        self.known = Known()

    def whole(self, text: str) -> bytes:
        ids = self.tool.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isalpha():
            if not word.isascii():
                text = "".join(map(self.letters.__getitem__, word))
            return np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
        if len(text) > 1 and text[-1] in ".," and text[:-1].isalpha():
            return self.known[word[:-1]] + self.marks[text[-1]]
        return self.whole(text)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self.whole(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, text.lower().encode().split()))


def shared_encoder(context: SparkContext, path: str | None = None) -> Broadcast:
    """A broadcast of a few bytes, in which the tasks of a worker share one encoder."""
    return context.broadcast({"path": path or tokenizer_path()})


def encoder_in(shared: Broadcast) -> TextEncoder:
    held = shared.value
    if "encoder" not in held:
        held["encoder"] = TextEncoder(held["path"])
    return held["encoder"]
