"""Ids of whole texts under two public tokenizers at once, one lookup per repeated word.

The first is a byte-level BPE, the second a piece model that puts a space before a text. Both read ``space + text``. A cut before a
space or line feed that follows another character changes neither's result: the first one's words begin there, and no piece of the second
crosses such a place (its vocabulary is asked when it is loaded; otherwise texts are not cut). So each worker encodes
a stretch between such cuts once with both libraries and then looks it up. The table is emptied at ``CACHE_WORDS`` stretches.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import accumulate, chain, repeat

import numpy as np

from duskwatch.llm.batches import worker_cache
from duskwatch.llm.tokens import BYTE_CHARS, LETTERS

CACHE_WORDS = 500_000
LONG_PIECE = 200
# A space or line feed with the white space behind it, a word, and whatever follows a white space of another kind.
STRETCH = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
_UNCUT = re.compile("[᠎▁]")  # read as white space by some: such texts are not cut
_MARK = "▁"


class PairTokens:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_char = {c: b for b, c in enumerate(BYTE_CHARS)}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            # special tokens are written as they are, all others in the characters for bytes
            self.bytes_a[i] = bytes(map(of_char.__getitem__, token)) if all(c in of_char for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.mark = self.b.piece_to_id(_MARK)
        self.cuts = not any("\n" in p or re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces) and pieces[self.mark] == _MARK
        self.clear()

    @classmethod
    def shared(cls, path_a: str, path_b: str) -> "PairTokens":
        cache = worker_cache().setdefault("pair tokens", {})
        if (path_a, path_b) not in cache:
            cache[path_a, path_b] = cls(path_a, path_b)
        return cache[path_a, path_b]

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = (array("I"), array("I"))
        self.starts, self.lengths = (array("q"), array("q")), (array("q"), array("q"))
        self.good = array("b")

    def stretches(self, text: str) -> list[str]:
        """``text``, which starts with a space, cut where both tokenizers allow it."""
        return STRETCH.findall(text) if self.cuts and not _UNCUT.search(text) else [text]

    def _ids(self, new: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of every stretch under both tokenizers."""
        ids_a: list = [None] * len(new)
        tokenize, spell, others = self.a.model.tokenize, BYTE_CHARS.__getitem__, []
        for k, word in enumerate(new):
            # letters alone are one word of the tokenizer, which its model takes as it is
            if word[0] == " " and (letters := LETTERS.fullmatch(word, 1)) and not letters[2]:
                ids_a[k] = [t.id for t in tokenize("".join(map(spell, word.encode())))]
            else:
                others.append(k)
        for k, found in zip(others, self.a.encode_batch_fast([new[k] for k in others], add_special_tokens=False)):
            ids_a[k] = found.ids
        # the piece model adds the leading space itself; before a line feed that space is a piece of its own
        ids_b = self.b.encode([w[1:] if w[0] == " " else w for w in new], num_threads=1)
        for k, word in enumerate(new):
            if word == " ":
                ids_b[k] = [self.mark]
            elif word[0] != " ":
                ids_b[k] = ids_b[k][1:] if ids_b[k][:1] == [self.mark] else []
        return ids_a, ids_b

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        sides = self._ids(new)
        joined = lambda table, lists: b"".join(map(table.__getitem__, chain.from_iterable(lists)))
        raw = "".join(new).encode()
        good = [True] * len(new)
        if not joined(self.bytes_a, sides[0]) == raw == joined(self.bytes_b, sides[1]):
            good = [joined(self.bytes_a, [one]) == word.encode() == joined(self.bytes_b, [two]) for word, one, two in zip(new, *sides)]
        self.codes.update(zip(new, range(len(self.good), len(self.good) + len(new))))
        self.good.extend(good)
        for side, lists in enumerate(sides):
            lists = [ids if fits else [] for ids, fits in zip(lists, good)]
            sizes = array("q", map(len, lists))
            self.starts[side].extend(accumulate(sizes[:-1], initial=len(self.flat[side])))
            self.lengths[side].extend(sizes)
            self.flat[side].extend(chain.from_iterable(lists))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of texts that start with a space: (ids a, number of ids a per text, ids b, number per text, whether both sides spell the text).

        A text that is not spelled by both has no ids.
        """
        if len(self.good) > CACHE_WORDS:
            self.clear()
        words, counts = [], []
        for text in texts:
            own = self.stretches(text) if text else []
            words += own
            counts.append(len(own))
        codes = np.fromiter(map(self.codes.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(codes < 0).tolist()
        new = {words[k]: None for k in unknown}
        long = [w for w in new if len(w) > LONG_PIECE]
        self._learn([w for w in new if len(w) <= LONG_PIECE])
        kept = len(self.good)
        if long:
            self._learn(long)
        codes[unknown] = [self.codes[words[k]] for k in unknown]
        counts = np.asarray(counts, np.int64)
        ends = np.cumsum(counts)
        bad = np.concatenate([[0], np.cumsum(np.array(self.good, np.int8)[codes] == 0)])
        good = bad[ends] == bad[ends - counts]
        live = np.repeat(good, counts)
        out = []
        for flat, starts, lengths in zip(self.flat, self.starts, self.lengths):
            starts, flat = np.array(starts, np.int64), np.array(flat, np.uint32)
            sizes = np.where(live, np.array(lengths, np.int64)[codes], 0)
            total = np.concatenate([[0], np.cumsum(sizes)])
            step = np.arange(total[-1]) - np.repeat(total[:-1], sizes)
            out += [flat[np.repeat(starts[codes], sizes) + step], total[ends] - total[ends - counts]]
        if long:  # not kept: they hardly ever repeat
            for w in long:
                del self.codes[w]
            for side in (0, 1):
                if kept < len(self.starts[side]):
                    del self.flat[side][self.starts[side][kept]:]
                del self.starts[side][kept:], self.lengths[side][kept:]
            del self.good[kept:]
        return out[0], out[1], out[2], out[3], good
