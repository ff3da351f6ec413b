"""Encoding with the tokenizers library, one call per distinct word instead of one per text.

The normaliser and the splitter of a word-level vocabulary never look across a
space or a line feed, so a text's ids are those of its words in order. Each
Python worker keeps the ids of the last words it has met, in two generations of
at most ``GENERATION`` entries.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

GENERATION, LONGEST_KEPT = 250_000, 64
_BEYOND = re.compile("[^\x00-\xff]")
#: A mark between a letter and white space, and so a run of marks of its own. The mark is the rarest and looked for first.
_LONE_MARK = re.compile(r"[.,;:!?](?=[ \n]|\Z)(?<=[a-zß-öø-ÿ].)")
#: What the splitter leaves whole and neither normal form nor case changes.
_PLAIN = re.compile(r"(?:[a-zß-öø-ÿ]+|[.,;:!?])\Z")


class Recent(dict):
    """Values by string, made by ``make`` when asked for; one generation back is kept as well."""

    def __init__(self, generation: int = GENERATION):
        super().__init__()
        self.generation = generation
        self.earlier: dict[str, bytes] = {}

    def make(self, key: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, key: str) -> bytes:
        value = self.earlier.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.generation:
                self.earlier = dict(self)
                self.clear()
            self[key] = value
        return value


class WordIds(Recent):
    """Ids of words as little-endian bytes.

    In a text of Latin-1 characters, case and normal form do not depend on
    context, so it is lower-cased as a whole and single marks after a letter
    become words of their own: far fewer words are then distinct. A lower-case
    run of letters or one mark is a word the model encodes alone; all others
    go through the whole tokenizer.
    """

    def __init__(self, path: str, generation: int = 2 * GENERATION):
        from tokenizers import Tokenizer, pre_tokenizers
        super().__init__(generation)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings in a text are ordinary text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code, self.tokenize = self.dtype.char, self.tokenizer.model.tokenize
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The letters that stand for the bytes of non-ASCII characters, as the library names them.
        self.letters = {code: bytewise.pre_tokenize_str(chr(code))[0][0] for code in range(0xDF, 0x100)}

    def make(self, word: str) -> bytes:
        if not _PLAIN.match(word):
            return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        spelled = word if word.isascii() else word.translate(self.letters)
        return array(self.code, [token.id for token in self.tokenize(spelled)]).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, as bytes of ``dtype``."""
        if text.isascii() or not _BEYOND.search(text):
            text = _LONE_MARK.sub(r" \g<0>", text.lower())
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=4)
def word_ids(path: str, generation: int = 2 * GENERATION) -> WordIds:
    """The worker's encoder for a vocabulary file; it stays in memory when the task has ended."""
    return WordIds(path, generation)
