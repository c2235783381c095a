"""Token ids of whole texts, by the tokenizers library.

Byte-level BPE splits a text into words first and encodes each word by itself, so a word's ids do not depend on its
neighbours. ``Encoder`` uses that: it keeps the ids of the words it has seen and gives the library only the new ones.
Texts with unusual runs of white space, where words are not so easily told apart, go to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

END_ID = 2
# White space as Unicode defines it, apart from the plain space and the line feed.
_RARE_ASCII = ("\t", "\x0b", "\x0c", "\r")
_RARE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_GROUP = 500


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, with ``end_id`` after each text.

    ``cache`` bounds the number of words that are kept; a full cache is emptied.
    """

    def __init__(self, path: str | None = None, end_id: int = END_ID, cache: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.cache = cache
        self.spaced: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.newline_ids = self._direct("\n")
        # The fast way needs a line feed to be one token of its own, as in the byte-level vocabularies.
        self.newline = int(np.frombuffer(self.newline_ids, "<u4")[0]) if len(self.newline_ids) == 4 else None
        # Tokens that begin with a space, which byte-level vocabularies write as this letter.
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, with the end id."""
        if len(self.spaced) + len(self.first) > self.cache:
            self.spaced.clear()
            self.first.clear()
        spaced, out, waiting = self.spaced, [], []
        for k, text in enumerate(texts):
            if not self._is_plain(text):
                out.append([self._direct(text)])
                continue
            words = text.split(" ")
            ids = list(map(spaced.get, words))
            ids[0] = self.first.get(words[0])
            if None in ids:
                waiting.append((k, words, [i for i, x in enumerate(ids) if x is None]))
            out.append(ids)
        self._learn([w[i] for _, w, gap in waiting for i in gap if i],
                    [w[0] for _, w, gap in waiting if not gap[0]])
        for k, words, gap in waiting:
            ids = out[k]
            for i in gap:
                ids[i] = self._ids(words[i], spaced if i else self.first)
        return [b"".join(ids) + self.end for ids in out]

    def _is_plain(self, text: str) -> bool:
        """Only single spaces and line feeds between words: every one of them then ends a word."""
        return not (self.newline is None or "  " in text or " \n" in text or "\n " in text or "\n\n" in text
                    or any(c in text for c in _RARE_ASCII) or text[:1] in (" ", "\n", "") or text[-1] in " \n"
                    or not text.isascii() and _RARE_SPACE.search(text))

    def _ids(self, word: str, known: dict[str, bytes]) -> bytes:
        """The ids of what stands between two spaces, from the words that were learnt."""
        if (ids := known.get(word)) is not None:
            return ids
        if "\n" in word:
            head, *rest = word.split("\n")
            return self.newline_ids.join([self._ids(head, known), *(self._ids(x, self.first) for x in rest)])
        stem = word.rstrip(".,")
        ids = known[word] = known[stem] + self.tails[word[len(stem):]]
        return ids

    def _learn(self, spaced: list[str], first: list[str]) -> None:
        """Give the library the words that are new, many at a time: with a space or a line feed before each."""
        after, start = set(), set(first)
        for word in spaced:
            if "\n" in word:
                head, *rest = word.split("\n")
                after.add(head)
                start.update(rest)
            else:
                after.add(word)
        for word in first:
            if "\n" in word:
                start.discard(word)
                start.update(word.split("\n"))
        for words, known, mark in ((after, self.spaced, " "), (start, self.first, "\n")):
            need = set()
            for word in words:
                if word not in known:
                    stem = word.rstrip(".,")
                    # A tail of points and commas is a word of its own after letters, but not after other signs.
                    if len(stem) < len(word) and stem.isalpha() and max(stem) < "\u0250":
                        tail = word[len(stem):]
                        if tail not in self.tails:
                            self.tails[tail] = self._direct(tail)
                        word = stem
                    if word not in known:
                        need.add(word)
            need = list(need)
            for k in range(0, len(need), _GROUP):
                part = need[k:k + _GROUP]
                ids = np.frombuffer(self._direct(mark + mark.join(part)), "<u4")
                # A word begins with the token that has its space, or after its line feed.
                begins = np.flatnonzero(self.begins[ids] if mark == " " else ids == self.newline)
                if len(begins) != len(part):
                    raise ValueError("the vocabulary has tokens across words")
                raw, skip = ids.tobytes(), 0 if mark == " " else 4
                edges = [*(4 * begins).tolist(), len(raw)]
                for word, a, b in zip(part, edges, edges[1:], strict=False):
                    known[word] = raw[a + skip:b]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str | None = None, end_id: int = END_ID) -> Encoder:
    """The worker's encoder, kept between tasks."""
    key = (path, end_id)
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id)
    return _encoders[key]
