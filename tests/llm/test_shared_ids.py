"""Operator 3 where many texts share one doc_id."""

from duskwatch.llm import substrings
from tests.llm.brute import kept_words


def test_anchor_arrays_are_bounded_by_one_text(spark, monkeypatch):
    texts = [" ".join(f"w{k}_{j}" for j in range(30)) for k in range(20)]
    rows = [(1, t) for t in texts] + [(2, t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes, blocks = [], substrings._blocks

    def seen(docs, window, gram):
        sizes.extend(len(r["anchors"]) for r in docs.select("anchors").collect())
        return blocks(docs, window, gram)

    monkeypatch.setattr(substrings, "_blocks", seen)
    got = sorted((r["doc_id"], r["n_words"] - r["n_removed"]) for r in substrings.repeated_words(docs).collect())
    assert got == sorted((d, len(k)) for (d, _), k in zip(rows, kept_words(rows, 13)))
    assert len(sizes) == len(rows) and max(sizes) <= 18  # windows of one text
