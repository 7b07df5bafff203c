"""Token ids of texts by a public tokenizer file, with the words of a worker remembered."""

from __future__ import annotations

import os
import re
import sys

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from array import array  # noqa: E402

from tokenizers import Tokenizer  # noqa: E402
from tokenizers.pre_tokenizers import ByteLevel  # noqa: E402

REMEMBERED = 250_000
# texts whose pieces the pattern below finds as the tokenizer's own splitter does: Latin letters, common punctuation
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa0-įı-ſ‐-‧€]")
_NUMERIC = "0-9²³¹¼-¾"
_LETTER = "[a-zªµºß-öø-ſ]"
_PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|{_LETTER}+|[{_NUMERIC}]|[^\s\xa0{_NUMERIC}{_LETTER[1:-1]}]+"
)


class _Words(dict):
    """Word to its ids as little-endian 32-bit integers; an unknown word is encoded and kept."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.bytewise = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, word: str) -> bytes:
        # one piece needs neither normaliser nor splitter; printable ASCII stands for itself among the byte symbols
        symbols = word if word.isascii() else self.bytewise.pre_tokenize_str(word)[0][0]
        found = packed([t.id for t in self.model.tokenize(symbols)])
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


def packed(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class WordTokenizer:
    """Encodes a text as ``tokenizers`` does with ``add_special_tokens=False``.

    The file must hold a tokenizer that folds case and encodes each piece between blanks by itself, as
    ``word_bpe_49k.json`` does. Plain texts go piece by piece through the remembered words, any other text through the
    library whole. ``special_as_text`` reads the strings of special tokens as ordinary text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special_as_text = special_as_text
        self.words = _Words(self.tokenizer)

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if _PLAIN.search(text) or (not self.special_as_text and "<|" in text):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, _PIECE.findall(text.lower())))


_loaded: dict[tuple[str, bool], WordTokenizer] = {}


def tokenizer(path: str, special_as_text: bool = False) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    if (path, special_as_text) not in _loaded:
        _loaded[path, special_as_text] = WordTokenizer(path, special_as_text)
    return _loaded[path, special_as_text]
