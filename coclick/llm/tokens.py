"""Token ids of texts, with a bounded memo of words.

The tokenizer file's pre-tokenizer never joins characters across white space,
so a text's ids are those of its white-space separated words in order, and a
word's are those of its pieces, as the tokenizer's own model splits them.
Words and pieces are remembered (ids as little-endian unsigned 32-bit bytes) in
generations of bounded size.  Words with characters outside Latin letters and
ASCII, and tokenizer files for which a probe shows another structure, go through
the whole tokenizer.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Public tokenizer file used by the registered queries.
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
MEMO_WORDS, MEMO_PIECES = 250_000, 300_000

_PLAIN = re.compile(r"[!-~¡-ɏ]+")
_SIGNS = ".,;:!?"
#: Fixed value: the tokenizer file's split pattern.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is one, else the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


_CHARACTER = _byte_characters()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Pieces(dict):
    """piece -> ids, by the tokenizer's model."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join([_CHARACTER[b] for b in piece.encode()])
        out = self[piece] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return out


class _Words(dict):
    """word -> ids; ``old`` is the generation before."""

    def __init__(self, encoder: WordEncoder, old: dict[str, bytes]):
        super().__init__({"": b""})
        self.encoder, self.old = encoder, old

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            out = self.encoder.word(word)
        self[word] = out
        return out


class WordEncoder:
    """Encodes texts with one tokenizer file; one instance per Python worker and file."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters_are_plain = not any(s.rstrip(_SIGNS).isalpha() for s in self.special)
        self.memo_words = memo_words
        self.pieces = _Pieces(self.tokenizer.model)
        self.words = _Words(self, {})
        self.by_word = True
        self.by_word = self._is_word_by_word()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _is_word_by_word(self) -> bool:
        """Whether a probe text's ids are those of its words' pieces."""
        probe = "Of the theaest, don't 12a  Él\tein\nß x-ray çà."
        return self._whole(probe) == b"".join(map(self.word, probe.split()))

    def word(self, word: str) -> bytes:
        """Ids of a word without white space."""
        if self.letters_are_plain and word.isascii():
            # letters are one piece; most other words are letters and one sign
            if word.isalpha():
                return self.pieces[word.lower()]
            if word[-1] in _SIGNS and word[:-1].isalpha():
                return self.pieces[word[:-1].lower()] + self.pieces[word[-1]]
        if _PLAIN.fullmatch(word) and not any(s in word for s in self.special):
            return b"".join([self.pieces[p] for p in _PIECES.findall(word.lower())])
        return self._whole(word)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not self.by_word:
            return [self._whole(t or "") for t in texts]
        column = pa.array([t or "" for t in texts], pa.large_string())
        for space in "\n\t":
            column = pc.replace_substring(column, space, " ")
        lists = pc.split_pattern(column, " ")
        # each distinct word of the batch is looked up once, then its ids are gathered to their places
        coded = lists.flatten().dictionary_encode()
        own = list(map(self.words.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        at = coded.indices.to_numpy()
        count = size[at]
        ends = np.cumsum(count)
        shift = (np.cumsum(size) - size)[at] - (ends - count)
        flat = np.frombuffer(b"".join(own), "<u4")[np.repeat(shift, count) + np.arange(int(count.sum()))]
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy()].tolist()
        if len(self.words) > self.memo_words:
            self.words = _Words(self, dict(self.words))
            if len(self.pieces) > MEMO_PIECES:
                self.pieces.clear()
        return [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
