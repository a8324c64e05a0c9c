"""Operator 11: alignment of two tokenizers by an associative fragment monoid.

Both tokenizers spell the bytes of ``space + text``. Where tokens of both end at one byte, the text is cut into groups; two tokens are linked
if their byte ranges overlap. Every byte range of a text gives a *fragment* from the tokens that end in it: an open prefix up
to the first common end, the closed groups between common ends, and an open suffix behind the last one; without a common end it is open as a whole.
Fragments compose: a suffix and the prefix after it are exactly one group, a fragment open as a whole extends what
is beside it, and the way they are bracketed does not matter. A text of at most ``range_bytes`` is one fragment. A longer one is cut
into ranges of that size which are tokenized by separate tasks (a range is widened to the nearest places where both tokenizers may be
cut), and its fragments are composed by a tree of fan-in ``FAN``; closed groups leave the tree at once, so what travels is open ends only.

How often an id pair is linked in the whole corpus is counted per slice of ``SLICE`` bytes first. A slice keeps its documents' links as
codes into the slice's own list of pairs; that list is summed over slices, the corpus counts are joined back to it, and slice by slice the
documents' sums are taken. No link is ever a row of a shuffle, and no count is broadcast.

Defined cases: null and empty texts, and texts that either side does not spell byte for byte (invalid UTF-8, characters the
piece model rewrites), have no tokens and zeros, and their links count nowhere; rows that share a doc_id, or have none, stay separate;
a stretch without a place to cut is tokenized whole, whatever its length; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.batches import byte_slices, byte_texts
from duskwatch.llm.pair_tokens import PairTokens
from duskwatch.llm.tables import settle

SLICE = 8 << 20  # bytes of text whose pairs are listed together
_STEP = 2 << 20  # bytes tokenized at a time
FAN = 16
_COMMA, _BAR, _SEMICOLON = b",|;"
_CUT = re.compile(rb"(?<=[!-~])(?= [!-~])")  # both tokenizers may be cut before such a space

ALIGNED = ("slice bigint, row bigint, place bigint, sub int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups string, codes binary, pairs array<bigint>, counts array<bigint>")
_ALIGNED = pa.schema([(n, t) for n, t in [
    ("slice", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("sub", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("codes", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]])


# ---------------------------------------------------------------- groups and links of whole stretches

@dataclass
class Aligned:
    """Stretches that start and end at common ends: per stretch its numbers, its groups as text, and its links as id pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    links: np.ndarray  # id a * 2^32 + id b, of all stretches in order


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, left-justified, and how many there are."""
    width = len(str(max(n - 1, 0)))
    text = np.char.mod("%d", np.arange(n)).astype(f"S{width}")
    return text.view(np.uint8).reshape(n, width), np.char.str_len(text)


class Aligner:
    """Groups and links from ids; ``sizes`` give the bytes of every id."""

    def __init__(self, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.sizes_a, self.sizes_b = sizes_a, sizes_b
        self.digits, self.n_digits = _digits(max(len(sizes_a), len(sizes_b)))

    def __call__(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray) -> Aligned:
        at_a, at_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        if not len(at_a):
            zeros = np.zeros(len(n_a), np.int64)
            return Aligned(zeros, zeros, zeros, zeros, [""] * len(n_a), np.zeros(0, np.int64))
        size = int(at_a[-1]) + 1
        ends_a, ends_b = np.zeros(size, np.int8), np.zeros(size, np.int8)
        ends_a[at_a] = 1
        ends_b[at_b] = 1
        both = ends_a & ends_b
        # a link is a stretch between two neighbouring ends of either side
        places = np.flatnonzero(ends_a | ends_b)
        upto_a, upto_b = np.cumsum(ends_a, dtype=np.int32), np.cumsum(ends_b, dtype=np.int32)
        of_a = ids_a[upto_a[places] - ends_a[places]]
        of_b = ids_b[upto_b[places] - ends_b[places]]
        links = of_a.astype(np.int64) << 32 | of_b
        common = np.flatnonzero(both)
        done = np.concatenate([[0], np.cumsum(n_a)])
        upto_c = np.cumsum(both, dtype=np.int32)
        # bytes up to the end of every stretch, then common ends up to there
        edge = np.concatenate([[0], at_a])[done]
        n_groups = np.diff(upto_c[edge]).astype(np.int64)
        n_links = np.where(n_groups > 0, n_a + n_b - n_groups, 0)
        return Aligned(n_a, n_b, n_groups, n_links, self._groups(ids_a, at_a, ids_b, at_b, both, upto_a, upto_b, upto_c, common, n_a + n_b), links)

    def _groups(self, ids_a, at_a, ids_b, at_b, both, upto_a, upto_b, upto_c, common, n) -> list[str]:
        closes_a, closes_b = both[at_a] == 1, both[at_b] == 1
        group_a, group_b = upto_c[at_a] - closes_a, upto_c[at_b] - closes_b
        b_before = np.concatenate([[0], upto_b[common]])  # ids b of earlier groups
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        mark = np.empty(len(ids), np.uint8)
        place_a = np.arange(len(ids_a)) + b_before[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[common][group_b]
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark[place_a] = np.where(closes_a, _BAR, _COMMA)
        mark[place_b] = np.where(closes_b, _SEMICOLON, _COMMA)
        width = self.n_digits[ids]
        cells = np.empty((len(ids), self.digits.shape[1] + 1), np.uint8)
        cells[:, :-1] = self.digits[ids]
        cells[np.arange(len(ids)), width] = mark
        text = cells[np.arange(cells.shape[1]) <= width[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(width + 1)])[np.concatenate([[0], np.cumsum(n)])].tolist()
        return [text[a:b - 1].decode() if b > a else "" for a, b in zip(ends, ends[1:])]


class SliceLinks:
    """Rows of one slice and the list of its id pairs, which the rows' links are codes into."""

    def __init__(self, number: int):
        self.number, self.rows, self.links = number, [], []

    def add(self, row: dict, links: np.ndarray) -> None:
        self.rows.append(row)
        self.links.append(links)

    def batch(self) -> pa.RecordBatch:
        links = np.concatenate(self.links) if self.links else np.zeros(0, np.int64)
        codes, pairs = pd.factorize(links)
        counts = np.bincount(codes, minlength=len(pairs))
        codes, at = codes.astype(_code_type(len(pairs))), 0
        for row, own in zip(self.rows, self.links):
            row["codes"] = codes[at:at + len(own)].tobytes()
            at += len(own)
        rows = [{"slice": self.number, **row} for row in self.rows]
        if len(pairs):
            rows.append({"slice": self.number, "pairs": pairs, "counts": counts})
        return pa.RecordBatch.from_pylist(rows, _ALIGNED)


def _code_type(n: int):
    return np.uint16 if n <= 1 << 16 else np.uint32


def _slice_numbers(kind: int):
    """Numbers that no other task of the written table gives."""
    first = (kind << 60) | (TaskContext.get().partitionId() << 32)
    return iter(range(first, first + (1 << 32)))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _spaced(raw: bytes) -> str:
    """Space + text; empty where there is nothing to tokenize or the bytes are no UTF-8."""
    try:
        return " " + raw.decode() if raw else ""
    except UnicodeDecodeError:
        return ""


def _align_documents(paths: tuple[str, str], digest: bool):
    def run(batches):
        tokens = PairTokens.shared(*paths)
        align, numbers = Aligner(tokens.sizes_a, tokens.sizes_b), _slice_numbers(0)
        for part in byte_slices(batches, "text", SLICE):
            out = SliceLinks(next(numbers))
            for step in byte_slices(iter([part]), "text", _STEP):
                ids_a, n_a, ids_b, n_b, _ = tokens.encode([_spaced(t) for t in byte_texts(step, "text")])
                found = align(ids_a, n_a, ids_b, n_b)
                ends = np.concatenate([[0], np.cumsum(found.n_links)])
                for k, doc in enumerate(step.column("doc_id").to_pylist()):
                    out.add({"doc_id": doc, "n_a": int(found.n_a[k]), "n_b": int(found.n_b[k]), "n_groups": int(found.n_groups[k]),
                             "n_links": int(found.n_links[k]), "groups": _sha(found.groups[k]) if digest else found.groups[k]}, found.links[ends[k]:ends[k + 1]])
            yield out.batch()
    return run


# ---------------------------------------------------------------- the monoid

@dataclass
class Fragment:
    """What a byte range says of the groups: open ends, and the groups its composition closed.

    ``cut`` tells whether there is a common end; without one everything is in ``prefix`` and ``suffix`` is empty.
    ``place`` is the leaf range in which the first common end lies. ``closed`` holds (place, ids a, ids b).
    """

    cut: bool = False
    place: int = -1
    prefix: tuple[list[int], list[int]] = ((), ())
    suffix: tuple[list[int], list[int]] = ((), ())
    closed: list[tuple[int, list[int], list[int]]] = field(default_factory=list)
    spelled: bool = True

    def __add__(self, other: "Fragment") -> "Fragment":
        spelled = self.spelled and other.spelled
        join = lambda one, two: ([*one[0], *two[0]], [*one[1], *two[1]])
        if not self.cut:
            return Fragment(other.cut, other.place, join(self.prefix, other.prefix), other.suffix, self.closed + other.closed, spelled)
        if not other.cut:
            return Fragment(True, self.place, self.prefix, join(self.suffix, other.prefix), self.closed + other.closed, spelled)
        group = (other.place, *join(self.suffix, other.prefix))
        return Fragment(True, self.place, self.prefix, other.suffix, [*self.closed, group, *other.closed], spelled)


def fragment_of(ids_a, ids_b, sizes_a, sizes_b, base: int, begin: int, end: int, place: int):
    """(the fragment of the tokens that end in (begin, end], closed ids a, closed ids b); ids start at byte ``base``."""
    at_a, at_b = base + np.cumsum(sizes_a[ids_a]), base + np.cumsum(sizes_b[ids_b])
    inside = [(at > begin) & (at <= end) for at in (at_a, at_b)]
    (ids_a, at_a), (ids_b, at_b) = (ids_a[inside[0]], at_a[inside[0]]), (ids_b[inside[1]], at_b[inside[1]])
    common = np.intersect1d(at_a, at_b, assume_unique=True)
    if not len(common):
        return Fragment(prefix=(ids_a.tolist(), ids_b.tolist())), ids_a[:0], ids_b[:0]
    cuts = [(np.searchsorted(at, common[0], "right"), np.searchsorted(at, common[-1], "right")) for at in (at_a, at_b)]
    (p, s), (q, t) = cuts
    made = Fragment(True, place, (ids_a[:p].tolist(), ids_b[:q].tolist()), (ids_a[s:].tolist(), ids_b[t:].tolist()))
    return made, ids_a[p:s], ids_b[q:t]


_IDS = "array<int>"
_FRAGMENT = (f"row bigint, seq bigint, spelled boolean, cut boolean, place bigint, prefix_a {_IDS}, prefix_b {_IDS}, suffix_a {_IDS}, "
             f"suffix_b {_IDS}, closed array<struct<place:bigint,sub:int,a:{_IDS},b:{_IDS}>>")
_INTS = pa.list_(pa.int32())
_FRAGMENTS = pa.schema([
    ("row", pa.int64()), ("seq", pa.int64()), ("spelled", pa.bool_()), ("cut", pa.bool_()), ("place", pa.int64()), ("prefix_a", _INTS),
    ("prefix_b", _INTS), ("suffix_a", _INTS), ("suffix_b", _INTS),
    ("closed", pa.list_(pa.struct([("place", pa.int64()), ("sub", pa.int32()), ("a", _INTS), ("b", _INTS)])))])


def _fragment_row(row: int, seq: int, f: Fragment, closed: list[dict]) -> dict:
    return {"row": row, "seq": seq, "spelled": f.spelled, "cut": f.cut, "place": f.place, "prefix_a": f.prefix[0], "prefix_b": f.prefix[1],
            "suffix_a": f.suffix[0], "suffix_b": f.suffix[1], "closed": closed}


def cut_ranges(raw: bytes, size: int):
    """Byte ranges of ``raw`` (space + text): (begin, end, base, bytes from ``base`` on that both tokenizers read alike).

    A range ends wherever its size is reached, inside a token or not, if there are places to cut shortly before and behind;
    otherwise at the next place to cut. So the bytes read twice are few, whatever the text is like.
    """
    begin = base = 0
    reach = max(size // 16, 256)
    while begin < len(raw):
        end = stop = after_base = min(begin + size, len(raw))
        if end < len(raw):
            before = list(_CUT.finditer(raw, max(end - reach, begin + 1), end + 2))
            after = _CUT.search(raw, end, end + reach)
            if before and after:
                after_base, stop = before[-1].start(), after.start()
            else:
                after = _CUT.search(raw, end)
                end = stop = after_base = after.start() if after else len(raw)
        yield begin, end, base, raw[base:stop]
        begin, base = end, after_base


_RANGES = "row bigint, doc_id bigint, seq bigint, begin bigint, end bigint, base bigint, bytes binary"


def _cut_documents(size: int):
    kind = pa.schema([(n, pa.int64()) for n in ("row", "doc_id", "seq", "begin", "end", "base")] + [("bytes", pa.binary())])

    def run(batches):
        for part in byte_slices(batches, "text"):
            for raw, row, doc in zip(byte_texts(part, "text"), part.column("row").to_pylist(), part.column("doc_id").to_pylist()):
                yield pa.RecordBatch.from_pylist(
                    [{"row": row, "doc_id": doc, "seq": k, "begin": begin, "end": end, "base": base, "bytes": piece}
                     for k, (begin, end, base, piece) in enumerate(cut_ranges(b" " + raw, size))], kind)
    return run


def _fragment_ranges(paths: tuple[str, str]):
    def run(batches):
        tokens = PairTokens.shared(*paths)
        for part in byte_slices(batches, "bytes", _STEP):
            texts = [_spaced(b[1:]) if b[:1] == b" " else "" for b in byte_texts(part, "bytes")]
            ids_a, n_a, ids_b, n_b, good = tokens.encode(texts)
            ends = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
            rows = []
            for k, r in enumerate(part.select(["row", "seq", "begin", "end", "base"]).to_pylist()):
                if not good[k] or not texts[k]:
                    rows.append(_fragment_row(r["row"], r["seq"], Fragment(spelled=False), []))
                    continue
                made, a, b = fragment_of(ids_a[ends[0][k]:ends[0][k + 1]], ids_b[ends[1][k]:ends[1][k + 1]], tokens.sizes_a, tokens.sizes_b,
                                         r["base"], r["begin"], r["end"], r["seq"])
                rows.append(_fragment_row(r["row"], r["seq"], made, [{"place": r["seq"], "sub": 1, "a": a, "b": b}] if len(a) else []))
            yield pa.RecordBatch.from_pylist(rows, _FRAGMENTS)
    return run


def _compose(group: pa.Table) -> pa.Table:
    """One fragment from up to ``FAN`` neighbours; the groups this closes go with it."""
    rows = sorted(group.to_pylist(), key=lambda r: r["seq"])
    made = reduce(Fragment.__add__, [Fragment(r["cut"], r["place"], (r["prefix_a"], r["prefix_b"]), (r["suffix_a"], r["suffix_b"]), [], r["spelled"])
                                     for r in rows])
    closed = [{"place": place, "sub": 0, "a": a, "b": b} for place, a, b in made.closed]
    return pa.Table.from_pylist([_fragment_row(rows[0]["row"], rows[0]["seq"] // FAN, made, closed)], _FRAGMENTS)


def _reduce(leaves: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """(one fragment per row, all closed stretches of ids: row, place, sub, a, b)."""
    levels, now = [leaves], leaves
    while longest > 1:
        pieces = now.drop("closed").withColumn("closed", F.lit(None).cast("array<struct<place:bigint,sub:int,a:array<int>,b:array<int>>>"))
        now = settle(pieces.groupBy("row", F.floor(F.col("seq") / FAN)).applyInArrow(_compose, _FRAGMENT), "fragments")
        levels.append(now)
        longest = -(-longest // FAN)
    first = now.where("cut").select("row", "place", F.lit(0).alias("sub"), F.col("prefix_a").alias("a"), F.col("prefix_b").alias("b"))
    return now, reduce(DataFrame.unionByName, [level.select("row", F.inline("closed")) for level in levels], first)


def _align_stretches(paths: tuple[str, str]):
    def run(batches):
        tokens = PairTokens.shared(*paths)
        align, numbers = Aligner(tokens.sizes_a, tokens.sizes_b), _slice_numbers(1)
        out, held = SliceLinks(next(numbers)), 0
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("a", "b"))
                found = align(a, np.array([len(a)]), b, np.array([len(b)]))
                out.add({"row": batch.column("row")[k].as_py(), "place": batch.column("place")[k].as_py(), "sub": batch.column("sub")[k].as_py(),
                         "n_a": len(a), "n_b": len(b), "n_groups": int(found.n_groups[0]), "n_links": int(found.n_links[0]),
                         "groups": found.groups[0]}, found.links)
                held += len(a) + len(b)
                if held > SLICE // 2:
                    yield out.batch()
                    out, held = SliceLinks(next(numbers)), 0
        if out.rows:
            yield out.batch()
    return run


def _in_order(digest: bool):
    """Groups of every row from its stretches, which come sorted by (row, place, sub); a digest holds one stretch at a time."""
    def run(batches):
        row, made, done = None, None, []
        for batch in batches:
            for r, text in zip(batch.column("row").to_pylist(), batch.column("groups").to_pylist()):
                if made is None or r != row:
                    if made is not None:
                        done.append((row, made.hexdigest() if digest else ";".join(made)))
                    row, made = r, hashlib.sha256(text.encode()) if digest else [text]
                elif digest:
                    made.update(b";" + text.encode())
                else:
                    made.append(text)
        if made is not None:
            done.append((row, made.hexdigest() if digest else ";".join(made)))
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], ["row", "groups"])
    return run


# ---------------------------------------------------------------- corpus counts

def _sums(slice_rows: pa.Table, weights: pa.Table) -> pa.Table:
    """Per row of one slice: how many links are best for their id b, and the sum of the links' counts."""
    n = weights.num_rows
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = weights["pos"].to_numpy()
    count[at], best[at] = weights["count"].to_numpy(), weights["best"].to_numpy()
    sums = []
    for raw in slice_rows["codes"].to_pylist():
        codes = np.frombuffer(raw or b"", _code_type(n))
        sums.append((int(best[codes].sum()), int(count[codes].sum())))
    out = slice_rows.drop_columns(["codes"])
    return (out.append_column("n_best", pa.array([s[0] for s in sums], pa.int64()))
            .append_column("count_sum", pa.array([s[1] for s in sums], pa.int64())))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold the id pair, and whether no other pair of its id b has more."""
    listed = aligned.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("_p"))
    totals = settle(listed.groupBy(F.col("_p.pairs").alias("pair")).agg(F.sum("_p.counts").alias("count")), "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = totals.groupBy(second.alias("b")).agg(F.max("count").alias("top"))
    return totals.join(top, second == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))


_KEYS = "slice bigint, row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"


def _weighed(aligned: DataFrame) -> DataFrame:
    """Every row of ``aligned`` with ``n_best`` and ``count_sum``, without its group text unless it is a digest."""
    listed = aligned.where("pairs is not null").select(F.col("slice").alias("of_slice"), F.posexplode("pairs").alias("pos", "pair"))
    weights = listed.join(pair_counts(aligned), "pair").select("of_slice", "pos", "count", "best")
    rows = aligned.where("pairs is null").select("slice", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links",
                                                 F.when(F.col("row").isNull(), F.col("groups")).alias("groups"), "codes")
    return rows.groupBy("slice").cogroup(weights.groupBy("of_slice")).applyInArrow(_sums, f"{_KEYS}, n_best bigint, count_sum bigint")


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align_documents(docs: DataFrame, path_a: str, path_b: str, range_bytes: int = 1 << 16, digest: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids a and ids b of every group in order; with ``digest`` the SHA-256 of that, empty without tokens.
    """
    paths = (path_a, path_b)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= range_bytes, F.lit(False))
    short = docs.where(~is_long).mapInArrow(_align_documents(paths, digest), ALIGNED)

    ranges = settle(docs.where(is_long).withColumn("row", F.monotonically_increasing_id()).mapInArrow(_cut_documents(range_bytes), _RANGES), "ranges")
    most = ranges.agg(F.max("seq")).first()[0]
    if most is None:
        return _weighed(settle(short, "aligned")).select("doc_id", *NUMBERS, "groups")
    leaves = settle(ranges.drop("doc_id").repartition("row", "seq").mapInArrow(_fragment_ranges(paths), _FRAGMENT), "fragments")
    roots, closed = _reduce(leaves, most + 1)
    stretches = closed.join(roots.where("spelled").select("row"), "row", "left_semi").repartition("row", "place", "sub")
    aligned = settle(short.unionByName(stretches.mapInArrow(_align_stretches(paths), ALIGNED)), "aligned")
    texts = (aligned.where("row is not null").select("row", "place", "sub", "groups").repartition("row")
             .sortWithinPartitions("row", "place", "sub").mapInArrow(_in_order(digest), "row bigint, groups string"))
    weighed = settle(_weighed(aligned), "weighed")
    sums = weighed.where("row is not null").groupBy("row").agg(*[F.sum(n).alias(n) for n in NUMBERS])
    long = ranges.where("seq = 0").select("row", "doc_id").join(sums, "row", "left").join(texts, "row", "left").select(
        "doc_id", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in NUMBERS], F.coalesce("groups", F.lit("")).alias("groups"))
    return weighed.where("row is null").select("doc_id", *NUMBERS, "groups").unionByName(long)
