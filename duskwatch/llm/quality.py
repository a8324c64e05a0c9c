"""Operator 8: quality classifier as a sparse rule ensemble.

Statistics of a text (shares of kinds of characters, repeated lines and words, line ends, lengths) are the only inputs. Shallow boosted
trees are grown on labelled rows; every path from a root to a node becomes a rule, a conjunction of
thresholds; a lasso logistic regression over the rules drops most of them; what is left is compiled into one Spark column expression.

The model is fitted on at most ``max_rows`` labelled rows, those with the smallest hash of their doc_id; everything else covers all rows.
Defined cases: a null text is empty, and an empty text is scored like any other; labels that are null or belong to no document are left out; without
labels of both kinds the score is the share of label 1 (0.5 without labels); rows sharing a doc_id are scored separately; extra columns are left out by
``score_documents`` and kept by ``keep_good``; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from duskwatch.llm.batches import byte_slices, byte_texts
from duskwatch.llm.tables import fold, settle, unfold

FEATURES = ["log_bytes", "word_bytes", "distinct_words", "longest_word", "line_bytes", "repeated_lines", "sentence_lines",
            "letters", "capitals", "digits", "stops", "commas", "symbols", "bars", "exclamations", "brackets", "other_bytes"]
FIT_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32
PENALTY = 0.002

_KINDS = np.zeros((256, 10), np.float64)
for _k, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:", b"#$%&*@^~=+_\\",
                             b"|", b"!?", b"()[]{}<>"]):
    _KINDS[list(_chars), _k] = 1
_KINDS[128:, 9] = 1


def text_statistics(text: bytes) -> list[float]:
    """The values of FEATURES."""
    n, words, lines = len(text), text.split(), [x.strip() for x in text.split(b"\n") if x.strip()]
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS / max(1, n)
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    return [float(np.log1p(n)), sum(map(len, words)) / n_words, len(set(words)) / n_words, float(np.log1p(max(map(len, words), default=0))),
            float(np.log1p(n / n_lines)), 1 - len(set(lines)) / n_lines if lines else 0.0,
            sum(x.endswith((b".", b"!", b"?")) for x in lines) / n_lines, *shares.tolist()]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (text and others) with a column for every feature, named ``_<feature>``."""
    schema = StructType([*docs.schema.fields, *(StructField(f"_{f}", DoubleType()) for f in FEATURES)])

    def run(batches):
        for part in byte_slices(batches, "text"):
            values = np.array([text_statistics(t) for t in byte_texts(part, "text")])
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(values[:, i]) for i in range(len(FEATURES)))],
                                             schema.names)

    return docs.mapInArrow(run, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (feature, whether at most, threshold), all must hold


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score as a Spark column over the feature columns."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = reduce(lambda a, b: a & b, [
                (F.col(f"_{FEATURES[f]}") <= t) if low else (F.col(f"_{FEATURES[f]}") > t) for f, low, t in rule])
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    return reduce(np.logical_and, [(x[:, f] <= t) if low else (x[:, f] > t) for f, low, t in rule])


def grow_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees on logistic loss, thresholds at quantiles."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]  # bin <= i  <=>  value <= cuts[i]
    margin, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}

    def split(rows: np.ndarray, path: Rule, gradient: np.ndarray, weight: np.ndarray) -> None:
        if path:
            rules[tuple(sorted(path))] = None
        g, h = gradient[rows], weight[rows]
        best, choice = 1e-6, None
        if len(path) < DEPTH and len(rows) >= 20:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = bins[f][rows]
                gl = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
                gain = gl**2 / (hl + 1) + (g.sum() - gl)**2 / (h.sum() - hl + 1) - g.sum()**2 / (h.sum() + 1)
                at = int(gain.argmax())
                if gain[at] > best:
                    best, choice = gain[at], (f, at)
        if choice is None:
            margin[rows] += RATE * g.sum() / (h.sum() + 1)
            return
        f, at = choice
        low = bins[f][rows] <= at
        if low.all() or not low.any():
            margin[rows] += RATE * g.sum() / (h.sum() + 1)
            return
        threshold = float(cuts[f][at])
        split(rows[low], (*path, (f, True, threshold)), gradient, weight)
        split(rows[~low], (*path, (f, False, threshold)), gradient, weight)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        split(np.arange(len(y)), (), y - p, p * (1 - p))
    return list(rules)


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> RuleModel:
    """Lasso logistic weights of the grown rules by accelerated proximal gradient steps."""
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel(float(np.log(share / (1 - share))), ())
    rules = grow_rules(x, y)
    if not rules:
        return RuleModel(float(np.log(share / (1 - share))), ())
    m = np.column_stack([_holds(x, r) for r in rules]).astype(np.float64)
    mean = m.mean(0)
    m -= mean
    # a step that suits the largest curvature, found by power iteration
    v = np.ones(m.shape[1])
    for _ in range(20):
        v = m.T @ (m @ v)
        v /= np.linalg.norm(v) or 1.0
    rate = 1.0 / (0.25 * float(np.linalg.norm(m @ v)**2) / len(y) + 1e-9)
    w, b, ahead, b_ahead, t = np.zeros(m.shape[1]), np.log(share / (1 - share)), np.zeros(m.shape[1]), np.log(share / (1 - share)), 1.0
    for _ in range(steps):
        residual = 1 / (1 + np.exp(-(m @ ahead + b_ahead))) - y
        step = ahead - rate * (m.T @ residual) / len(y)
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        b_new = b_ahead - residual.mean() * min(rate, 4.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, b_ahead = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    kept = [(r, float(k)) for r, k in zip(rules, w) if k]
    return RuleModel(float(b - mean @ w), tuple(kept))


def held_out(doc_id: Column) -> Column:
    """Rows no model is fitted on: crc32 of the doc_id as text leaves 0 over 5."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = FIT_ROWS) -> RuleModel:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    wanted = (labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("quality").cast("int").alias("_label"))
              .where("_id is not null and _label in (0, 1)").where(~held_out(F.col("_id")))
              .orderBy(F.xxhash64("_id"), "_id", "_label").limit(max_rows))
    wanted = F.broadcast(settle(wanted, "labels"))  # at most max_rows rows of two numbers
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(wanted, F.col("doc_id") == F.col("_id"))
    # a doc_id that many rows share must not fill the sample
    once = rows.groupBy("_id", "_label").agg(F.min("text").alias("text"))
    found = with_statistics(once).select("_label", *[f"_{f}" for f in FEATURES]).toPandas()
    return fit(found[[f"_{f}" for f in FEATURES]].to_numpy(np.float64), found["_label"].to_numpy(np.float64))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    model = train(docs, labels, max_rows)
    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return (with_statistics(narrow).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = FIT_ROWS) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold."""
    model = train(docs, labels, max_rows)
    folded = fold(docs, "text").withColumn("text", F.col("text").cast("string"))
    return unfold(with_statistics(folded).where(model.column() >= threshold), docs.columns, "text")
