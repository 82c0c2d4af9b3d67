"""Token ids of whole texts by a ``tokenizers`` file, with a cache by word.

The pre-tokenizers of the files in use never join what a space parts, so a text's
ids are those of its space-separated pieces in order.  Each Python worker keeps
the ids of the pieces it met, packed as little-endian unsigned 32-bit integers;
only new pieces are encoded.  Words that end in an ASCII letter are encoded by
``tiktoken`` with the file's own ranks; every token of the file is what its own
merges lead to, so the results equal the tokenizer's.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

#: Pieces kept by a worker before it starts afresh.
CACHE_PIECES = 250_000
#: Pieces longer than this aren't kept.
CACHE_PIECE_CHARS = 64
#: Letters, then ASCII marks.
WORD = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]*)")
#: Letters whose lower case depends on the place, or isn't one letter.
SIGMA = frozenset("Σİ")
#: The byte-level alphabet: printable Latin-1 bytes stand for themselves, others take characters from 256 on.
PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
#: The mark of tokens that end a word.
END = "</w>"


def ranked(path: str):
    """The file's words for ``tiktoken``: lower-case words whose last letter, an ASCII one, is written in upper case; None if ids aren't in the order of the merges.

    Tokens that end a word are other symbols than those inside it.  Lower-case words have no
    upper-case letters, so a last letter in upper case stands for the letter with its mark.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if merged != sorted(merged) or model.get("end_of_word_suffix") != END or model.get("ignore_merges"):
        return None
    letters = {chr(b): b for b in PRINTABLE} | {chr(c): b for b, c in BYTE_CHARS.items()}
    ranks = {}
    for token, number in model["vocab"].items():
        last = token.endswith(END) and len(token) > len(END)
        token = token.removesuffix(END) if last else token
        if not set(token) <= letters.keys():
            continue
        own = bytes(letters[c] for c in token)
        if own.lower() == own and (not last or own[-1:].islower()):
            ranks[own[:-1] + own[-1:].upper() if last else own] = number
    return tiktoken.Encoding("words", pat_str="[^A-Z]*[A-Z]", mergeable_ranks=ranks, special_tokens={})


class PieceCache(dict):
    """Ids by piece, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = ranked(path)

    def __missing__(self, piece: str) -> bytes:
        """The ids of a piece that isn't in the cache.

        Letters with ASCII marks behind them, most of all pieces, are cut as the
        pre-tokenizer cuts them, lowered, and go to the model, so that ``The``,
        ``the,`` and ``THE!!`` share the ids of ``the``.  All others go through
        the whole tokenizer.
        """
        m = WORD.fullmatch(piece)
        if m is None or not (piece.isascii() or m[1].isalpha() and unicodedata.is_normalized("NFC", piece) and not SIGMA & set(piece)):
            ids = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        else:
            word, marks = m[1].lower(), m[2]
            ids = self._word(word) if word == piece else self[word]
            if marks:
                ids += self[marks]
        if len(piece) <= CACHE_PIECE_CHARS:
            self[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if self.ranked is not None and "a" <= word[-1] <= "z" and len(word) <= CACHE_PIECE_CHARS:
            return array("I", self.ranked.encode_ordinary(word[:-1] + word[-1].upper())).tobytes()
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()

    def encode(self, text: str) -> bytes:
        if len(self) > CACHE_PIECES:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_CACHES: dict[str, PieceCache] = {}


def piece_cache(path: str) -> PieceCache:
    """This worker's cache for the file at ``path``."""
    if path not in _CACHES:
        _CACHES[path] = PieceCache(path)
    return _CACHES[path]
