"""Plain readings of the operators' contracts, to test against."""

import re
import zlib

import numpy as np
import xxhash

LETTER_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def letter_words(text):
    return LETTER_WORD.findall(lower(text))


def plain_words(text):
    return PLAIN_WORD.findall((text or "").encode())


def fingerprint(text, shingle=3):
    words = PLAIN_WORD.findall(lower(text))
    shingles = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(n, links):
    """For each of 0..n-1 the smallest reachable number."""
    root = list(range(n))
    while True:
        before = list(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def kept_words(rows, window):
    """Kept words of every (doc_id, text), windows judged on all rows."""
    starts = {}
    for doc, text in rows:
        words = plain_words(text)
        for i in range(len(words) - window + 1):
            if doc is not None:
                starts.setdefault(tuple(words[i:i + window]), set()).add(doc)
    out = []
    for doc, text in rows:
        words, gone = plain_words(text), set()
        for i in range(len(words) - window + 1):
            if doc is not None and min(starts[tuple(words[i:i + window])]) < doc:
                gone.update(range(i, i + window))
        out.append([w for i, w in enumerate(words) if i not in gone])
    return out
