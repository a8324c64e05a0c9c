"""Operator 4: licence scans.

An Aho-Corasick automaton finds notice phrases and licence identifier tags in the words of a text, all in one pass whatever their
number. Where a tag stands, however its three words are joined, the expression behind it in the text is read by a shunting-yard parser (OR binds least,
then AND, then WITH; parentheses group) and evaluated to the licences it names.

Defined cases: null and empty texts have no words, no labels and score 0; a tag without a well-formed expression gives no label of its own;
every occurrence counts, overlapping ones too; rows that share a doc_id stay separate; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.batches import byte_slices, byte_texts, letter_words, worker_cache

# The phrases of the base scan and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notices, as words of lower-cased letters and digits.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BEHIND_TAG = re.compile(rb"[ \t]*([:=]?)[\"' \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+\-]*)")
# How far each kind of evidence is trusted.
SCORES = {"known tag": 1.0, "tag": 0.8, "base": 0.9, "notice": 0.7}
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> list[str]:
    """The expression at the start of ``text`` in postfix order; empty if there is none or it is malformed."""
    out: list[str] = []
    waiting: list[str] = []
    at, operand = 0, False  # operand: the last token ended one
    depth = 0
    while found := _TOKEN.match(text, at):
        token = found[1]
        low = token.lower()
        if low in _BINDS:
            if not operand:
                return []
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand = False
        elif token == "(":
            if operand:
                return []
            waiting.append(token)
            depth += 1
        elif token == ")":
            if not operand:
                return []
            if not depth:
                break  # closes something the expression stands in
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            depth -= 1
        elif operand:
            break  # the next word after a whole expression is prose
        else:
            out.append(low)
            operand = True
        at = found.end()
    if not operand or depth:
        return []
    return out + waiting[::-1]


def evaluate(postfix: list[str], known: frozenset[str] | set[str] = frozenset()) -> tuple[set[str], bool]:
    """(licences an expression names, whether licences of ``known`` alone satisfy it).

    OR needs one side, AND both; "x with y" is one licence, known if x is.
    """
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token not in _BINDS:
            stack.append(({token}, token in known))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            exception = "+".join(sorted(right[0]))
            stack.append(({f"{x} with {exception}" for x in left[0]}, left[1]))
        else:
            stack.append((left[0] | right[0], left[1] or right[1] if token == "or" else left[1] and right[1]))
    return stack[0] if stack else (set(), False)


# Labels that identifiers share with phrases, lower-cased.
SAME_LABEL = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc"}
# Common licence identifiers, lower-cased; a longer list comes as a table (``licence_table``).
KNOWN = frozenset("""
    0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 bsd-1-clause
    bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 cc-by-1.0 cc-by-2.0 cc-by-3.0 cc-by-4.0
    cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1
    cpl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.3-only gfdl-1.3-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0
    gpl-3.0-only gpl-3.0-or-later hpnd ipl-1.0 isc lgpl-2.0-only lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only
    lgpl-3.0-or-later mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0
    python-2.0 qpl-1.0 ruby sleepycat unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
""".split())
TABLE_ROWS = 100_000


def licence_table(table: DataFrame, name: str, label: str | None = None, limit: int = TABLE_ROWS) -> dict[str, str]:
    """A table of identifiers or notice phrases (column ``name``) with their labels, lower-cased; for ``scan_licences``.

    Every task holds the automaton, so a table of more than ``limit`` rows is an error. Null and empty names go, a null label is the name itself.
    """
    key = F.lower(F.btrim(F.col(name).cast("string")))
    rows = table.select(key.alias("name"), F.coalesce(F.lower(F.col(label).cast("string")) if label else key, key).alias("label"))
    found = rows.where("name != ''").groupBy("name").agg(F.min("label").alias("label")).limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} licences")
    return {r["name"]: r["label"] for r in sorted(found)}


def phrase_of(text: str) -> str:
    """A notice as the automaton has it: lower-cased words with single blanks."""
    return b" ".join(letter_words(text.encode())).decode()


class Scanner:
    """The automaton over both lists of phrases and the tag."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], identifiers: dict[str, str]):
        import ahocorasick

        self.identifiers, self.known = identifiers, frozenset(identifiers)

        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[str, str]]] = {TAG: [("tag", "")]}
        for kind, phrases in (("base", base), ("notice", notices)):
            for phrase, label in phrases.items():
                if words := phrase_of(phrase):
                    found.setdefault(words, []).append((kind, label))
        for phrase, meanings in found.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 1, meanings))
        self.automaton.make_automaton()

    @classmethod
    def shared(cls, *tables: dict[str, str]) -> "Scanner":
        cache, key = worker_cache().setdefault("licences", {}), tuple(tuple(t.items()) for t in tables)
        if key not in cache:
            cache[key] = cls(*tables)
        return cache[key]

    def expressions(self, text: bytes, tags: list[int]):
        """(licences named, whether known ones satisfy it) of each tag, given the words they start at.

        Behind a tag without ":" or "=" prose may follow, so all it names must be known there.
        """
        ends = {start + TAG.count(" ") for start in tags}
        for place, word in enumerate(_WORD.finditer(text)):
            if place in ends:
                mark, rest = _BEHIND_TAG.match(text, word.end()).groups()
                postfix = parse_expression(rest.decode("utf-8", "replace"))
                if mark or all(token in self.known or token in _BINDS for token in postfix):
                    yield evaluate(postfix, self.known)

    def scan(self, text: bytes) -> tuple[int, list[int], set[str], set[str], float]:
        """(words, starts of base places, base labels, all labels, score)."""
        words = letter_words(text)
        joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
        starts, base, labels, score, tags = [], set(), set(), 0.0, []
        at = word = 0  # word: the number of words before place `at`
        for end, (length, meanings) in self.automaton.iter(joined):
            for kind, label in meanings:
                if kind != "notice":
                    begin = end - length
                    # phrases end in order; a longer one may begin before the last
                    word = word + joined.count(" ", at, begin) if begin >= at else joined.count(" ", 0, begin)
                    at = begin
                    (tags if kind == "tag" else starts).append(word)
                if kind == "tag":
                    continue
                labels.add(label)
                score = max(score, SCORES[kind])
                if kind == "base":
                    base.add(label)
        for named, satisfied in self.expressions(text, tags) if tags else ():
            labels |= {self.identifiers.get(name, name) for name in named}
            score = max(score, SCORES["known tag" if satisfied else "tag"] if named else 0.0)
        return len(words), starts, base, labels, score


def scan_licences(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None,
                  identifiers: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per document.

    ``base`` and ``notices`` are phrases with their labels, ``identifiers`` what tags may name, with theirs; ``licence_table`` reads them from tables.
    """
    base, notices = BASE_PHRASES if base is None else base, NOTICE_PHRASES if notices is None else notices
    identifiers = {name: SAME_LABEL.get(name, name) for name in KNOWN} if identifiers is None else identifiers

    def run(batches):
        scanner = Scanner.shared(base, notices, identifiers)
        for part in byte_slices(batches, "text"):
            rows = [scanner.scan(text) for text in byte_texts(part, "text")]
            joined = lambda labels: ",".join(sorted(labels))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
                 pa.array([min(r[1], default=None) for r in rows], pa.int64()), pa.array([max(r[1], default=None) for r in rows], pa.int64()),
                 pa.array([joined(r[2]) for r in rows]), pa.array([joined(r[3]) for r in rows]), pa.array([r[4] for r in rows], pa.float64())],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
