"""Token ids of texts by a public BPE vocabulary with word ends, with an exact cache of white-space separated chunks."""

from __future__ import annotations

import os
from array import array
from unicodedata import is_normalized

import numpy as np

VOCABULARY = "word_bpe_49k.json"
#: Chunks that a worker remembers; the cache starts anew beyond that.
CACHE = 400_000
_LONGEST = 48
_TOGETHER = 1000
_MARKS = ".,!?;:%$#&*|"
#: The vocabulary writes bytes as printable characters: those that are printable stand for themselves, the rest follow from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class ChunkEncoder:
    """Encodes texts as little-endian unsigned 32-bit ids.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its chunks in turn;
    chunks recur and are encoded once. Only the four plain white-space characters split here: what else the
    tokenizer takes for white space it handles itself, within a chunk.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        new, learned = list(chunks), {}
        for at in range(0, len(new), _TOGETHER):
            some = new[at : at + _TOGETHER]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            data, owner = np.asarray(found.ids, "<u4").tobytes(), np.asarray(found.word_ids, np.int64)
            ends = (4 * np.cumsum(np.bincount(owner, minlength=len(some)))).tolist()
            learned.update(zip(some, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=False))
        return learned

    def encode(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self.known
        if len(known) > CACHE:
            known.clear()
            known[""] = b""
        missing = {c for c in chunks if c not in known}
        if not missing:
            return b"".join([known[c] for c in chunks])
        return self._encode_new(chunks, missing)

    def _word(self, word: str) -> bytes:
        """Ids of a word of lower-case letters below U+0250: it is one piece for the model, so nothing else has to run."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _encode_new(self, chunks: list[str], missing: set[str]) -> bytes:
        """Learns the missing chunks. A letter is never in one token with the plain marks after it, so a word is learned
        once for all its cases and all marks that follow it; what is not a plain word goes through the whole tokenizer."""
        known, learned, rest = self.known, {}, []
        for c in missing:
            word = c.rstrip(_MARKS)
            low = word.lower()
            if not (low.isalpha() and (word.isascii() or (max(word) < "\u0250" and "İ" not in word and is_normalized("NFC", word)))):
                rest.append(c)
                continue
            found = known.get(low)
            if found is None:
                found = self._word(low)
                if len(low) <= _LONGEST:
                    known[low] = found
            if marks := c[len(word) :]:
                if marks not in known:
                    known.update(self._learn({marks}))
                found += known[marks]
            (known if len(c) <= _LONGEST else learned)[c] = found
        if rest:
            learned.update(self._learn(set(rest)))
            known.update((c, b) for c, b in learned.items() if len(c) <= _LONGEST)
        return b"".join([known[c] if c in known else learned[c] for c in chunks])


_encoders: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, special_as_text: bool = False) -> ChunkEncoder:
    """One encoder for each worker and vocabulary."""
    key = (path, special_as_text)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, special_as_text)
    return _encoders[key]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
