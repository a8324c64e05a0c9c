"""Token ids of whole texts with a public tokenizer, one lookup per repeated word.

A word tokenizer that drops white space never lets a token cross it, so the ids of a text are
the ids of its blank-separated pieces, one after another. Whether a file is of that kind is read from its normaliser and pre-tokenizer; with
any other, texts are encoded whole. Punctuation at the end of a piece is a piece of its own where that changes no id.
Pieces are cut and counted off over all bytes of a slice at once; each worker encodes a distinct piece once with
the tokenizers library and then looks it up; most words of a corpus repeat. The table is emptied
when it holds ``CACHE_WORDS`` pieces, which bounds its memory and changes no result. Pieces of more than
``LONG_PIECE`` bytes are encoded each time.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from codecs import charmap_decode
from itertools import chain

import numpy as np
import pyarrow as pa

from duskwatch.llm.batches import worker_cache

CACHE_WORDS = 800_000
LONG_PIECE = 200
TEXT_BYTES = 2 << 20  # text encoded at a time
WHITE = b"\t\n\x0b\x0c\r "  # what bytes.split() splits at
# Punctuation after an ASCII letter or digit is a token run of its own. An apostrophe may begin a
# contraction, and <, |, > occur in special tokens, so those are left in place.
PUNCTUATION = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_BLANK, _ALNUM, _MARK = 1, 2, 3
KINDS = bytes(_BLANK if b in WHITE else _MARK if b in PUNCTUATION else _ALNUM if b < 128 and chr(b).isalnum() else 0 for b in range(256))

# Letters that are one character before and after the tokenizer's normal form, and no part of another: words of
# these alone are one word of the tokenizer, which its model takes as it is, in its characters for bytes.
# So is punctuation after them.
LETTERS = re.compile("([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F]+)([%s]*)" % re.escape(PUNCTUATION.decode()))
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _SELF]
BYTE_CHARS = "".join(chr(b) if b in _SELF else chr(256 + _OTHERS.index(b)) for b in range(256))


# Fixed value: how a tokenizer of this kind takes words out of a lower-cased text; white space is in none of them.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def takes_words(tokenizer) -> bool:
    """Whether the tokenizer's file says that it lower-cases, drops white space and then takes the words of ``WORD_PATTERN``."""
    made = json.loads(tokenizer.to_str())
    steps = lambda part, name: (made[part] or {}).get(name) or []
    normal, before = steps("normalizer", "normalizers"), steps("pre_tokenizer", "pretokenizers")
    return ([n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"] and [b["type"] for b in before] == ["Split", "ByteLevel"]
            and before[0]["pattern"] == {"Regex": WORD_PATTERN} and before[0]["behavior"] == "Removed" and before[0]["invert"]
            and not before[1]["add_prefix_space"] and not before[1]["use_regex"])


def cut_pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(all texts' pieces, some empty; how many there are up to the end of each text).

    Texts are cut at white space, which is left out, and before punctuation that ends a piece after an ASCII letter or digit.
    """
    data = b"".join(chain.from_iterable((t, b" ") for t in texts))
    kinds = np.frombuffer(data.translate(KINDS), np.uint8)
    cut = kinds == _BLANK
    mark = kinds == _MARK
    turns = np.flatnonzero(mark[1:] != mark[:-1]) + 1
    turns = turns[int(mark[:1].any()):]  # a run at the very start follows nothing
    begins, ends = turns[::2], turns[1::2]  # the last byte is a blank, so every run has an end
    cut[begins[(kinds[begins - 1] == _ALNUM) & (kinds[ends] == _BLANK)]] = True
    at = np.flatnonzero(cut)
    blank = kinds[at] == _BLANK
    offsets = np.zeros(len(at) + 1, np.int64)
    np.subtract(at, np.cumsum(blank) - blank, out=offsets[1:])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(None, WHITE))])
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    return pieces, np.searchsorted(at, text_ends, side="right")


class WordTokens:
    """Encodes texts to ids; keeps the ids of pieces it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = takes_words(self.tokenizer)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, bytes] = {b"": b""}  # ids of a piece as u32

    @classmethod
    def shared(cls, path: str) -> "WordTokens":
        cache = worker_cache().setdefault("tokens", {})
        if path not in cache:
            cache[path] = cls(path)
        return cache[path]

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of new pieces; those of all but long ones are kept."""
        tokenize, flat, ends = self.tokenizer.model.tokenize, array("I"), [0]
        for piece in pieces:
            if piece.isalpha() and len(piece) <= LONG_PIECE:  # ASCII letters
                flat.extend([t.id for t in tokenize(piece.lower().decode())])
            elif len(piece) <= LONG_PIECE and (letters := LETTERS.fullmatch(piece.decode("utf-8", "replace"))):
                word, tail = letters.groups()
                flat.extend([t.id for t in tokenize(charmap_decode(word.lower().encode(), "strict", BYTE_CHARS)[0])])
                if tail:
                    flat.extend([t.id for t in tokenize(tail)])
            else:
                flat.extend(self.encode_plain(piece))
            ends.append(4 * len(flat))
        ids = flat.tobytes()
        found = [ids[a:b] for a, b in zip(ends, ends[1:])]
        self.known.update(zip(pieces, found))
        for piece in pieces:  # long ones hardly ever repeat
            if len(piece) > LONG_PIECE:
                del self.known[piece]
        return found

    def encode_plain(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one uint32 array, each text ended by ``end_id``; number of ids per text)."""
        if not self.by_word:
            found = [e.ids + [end_id] for e in self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        if len(self.known) > CACHE_WORDS:
            self.clear()
        # Lower case is the tokenizer's own normal form. Before a combining mark (lead bytes CC, CD)
        # or in a special token, case still matters; those texts go in as they are.
        pieces, text_ends = cut_pieces([t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower() for t in texts])
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes ten times as long
        ids = list(map(self.known.get, words))
        unknown = [k for k, found in enumerate(ids) if found is None]
        for k, found in zip(unknown, self._learn([words[k] for k in unknown])):
            ids[k] = found
        ids.append(np.array([end_id], np.uint32).tobytes())  # one more word, after each text
        codes = np.insert(coded.indices.to_numpy(), text_ends, len(words))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(lengths) - lengths
        sizes = lengths[codes]
        totals = np.cumsum(sizes)
        places = np.repeat(starts[codes] - (totals - sizes), sizes)
        places += np.arange(len(places))
        n_ids = np.diff(totals[text_ends + np.arange(len(texts))], prepend=0)
        return np.frombuffer(b"".join(ids), np.uint32)[places], n_ids
