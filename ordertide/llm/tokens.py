"""Token ids of whole texts by a public tokenizer's file, remembered word by word."""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from itertools import filterfalse

#: Entries that a worker remembers before it starts afresh.
MEMORY = 700_000
#: Words longer than this are not remembered.
LONGEST = 64
#: Characters of text that are split and looked up together.
PART = 200_000

_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker for the tokenizer file ``path``."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop this worker's encoders and what they remember, when it turns to an operator with a memory of its own."""
    _encoders.clear()


def default_tokenizer() -> str:
    """The public word-level BPE vocabulary; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _plain(word: str) -> bool:
    """Letters only, also once normalised and in lower case, so that nothing splits or joins the word."""
    if word.isascii():
        return word.isalpha()
    return word.isalpha() and word.lower().isalpha() and unicodedata.is_normalized("NFC", word)


#: A full stop or comma at a word's end, behind what is, or in lower case becomes, neither letter nor digit.
_CLUSTER = re.compile(r"[.,] (?:(?<![^\W_][.,] )|(?<=İ[.,] ))")


def _split(text: str | None, lower: bool) -> list[str]:
    """The words, a final full stop or comma on its own where the tokenizer too parts it from the word."""
    text = (text or "").replace("\n", " ")
    if lower and text.isascii() and "<|" not in text:
        text = text.lower()
    if not _CLUSTER.search(text):
        text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


class WordEncoder:
    """``encode`` gives the ids that the file's tokenizer gives, as little-endian unsigned 32-bit.

    The tokenizer must drop white space and never join across it, as word-level BPE does; then a
    text's ids are those of its words, and each worker asks the tokenizer for a word only once.
    ``words_apart`` checks that on the file itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.apart = self.words_apart()
        self.lower = self._direct("ABCDEFGHIJKLMNOPQRSTUVWXYZ") == self._direct("abcdefghijklmnopqrstuvwxyz")
        self.known: dict[str, bytes] = {"": b""}

    def words_apart(self) -> bool:
        probe = ["Apart", "word.", "x1,", "'s", "don't", "é!!", "%%", "7"]
        whole = self.tokenizer.encode(" \n ".join(probe) + "\n", add_special_tokens=False).ids
        return whole == [i for w in probe for i in self.tokenizer.encode(w, add_special_tokens=False).ids]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.apart:
            return [self._direct(t or "") for t in texts]
        out, start = [], 0
        while start < len(texts):
            # A few texts at a time, so that words looked up once are still near at the second look.
            stop, size = start, 0
            while stop < len(texts) and size < PART:
                size += len(texts[stop] or "")
                stop += 1
            out += self._part(texts[start:stop])
            start = stop
        return out

    def _part(self, texts: list[str | None]) -> list[bytes]:
        words = [_split(t, self.lower) for t in texts]
        if len(self.known) > MEMORY:
            self.known = {"": b""}
        known = self.known
        missing: set[str] = set()
        for x in words:
            missing.update(filterfalse(known.__contains__, x))
        long = {w: self._direct(w) for w in missing if len(w) > LONGEST}
        self._learn([w for w in missing if len(w) <= LONGEST])
        if not long:
            return [b"".join(map(known.__getitem__, x)) for x in words]
        return [b"".join([long[w] if w in long else known[w] for w in x]) for x in words]

    def _direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[str]) -> None:
        """A run of letters is encoded with others in one call; a final full stop or comma follows it."""
        known, stems, ended, rest = self.known, set(), [], []
        for w in words:
            stem = w[:-1] if w[-1] in ".," else w
            if _plain(stem):
                if stem not in known:
                    stems.add(stem)
                if stem is not w:
                    ended.append((w, stem))
            else:
                rest.append(w)
        for w in ".,":
            if w not in known:
                known[w] = self._direct(w)
        todo = list(stems)
        for i in range(0, len(todo), 512):
            part = todo[i : i + 512]
            made = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, at = made.ids, made.word_ids
            if at and at[-1] == len(part) - 1:
                start = 0
                for k, w in enumerate(part):
                    stop = start
                    while stop < len(at) and at[stop] == k:
                        stop += 1
                    known[w] = struct.pack(f"<{stop - start}I", *ids[start:stop])
                    start = stop
            else:
                for w in part:
                    known[w] = self._direct(w)
        for w, stem in ended:
            known[w] = known[stem] + known[w[-1]]
        for w in rest:
            known[w] = self._direct(w)
