"""Word-level suffix arrays for many documents at once, and the quality rules that use them.

The words of a block of documents become numbers. Suffixes of all its documents are sorted together by prefix doubling
on ranks that begin with the document, so suffixes of different documents never tie; after each round only suffixes that
still tie are sorted again. Adjacent longest common prefixes (LCP) come from the ranks kept of each round. A suffix's
longest repeat within its document is the larger LCP with its two neighbours in the suffix array: the deepest LCP interval
it lies in. The spans of all maximal repeats of at least ``min_words`` words are united.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import data, doc_id, documents, keyed, offsets, ranges, slices, python_ready

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LATER = np.zeros(256, bool)
_LATER[0x80:0xC0] = True

#: Production thresholds: a repeat counts from so many words; a document goes if repeats cover more than this share of its
#: words, or if its longest repeat is longer than this share of them. Both lie below what the base rule leaves: words in
#: repeats are words in 3-word windows that come twice, so at half the words no document would go that base passes.
MIN_WORDS, MOST_COVERED, MOST_LONGEST = 10, 0.2, 0.1


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, how many keys are smaller, and how many are equal."""
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    return (np.cumsum(count) - count)[inverse], count[inverse]


class Words:
    """The words of a block of texts: ``doc`` (row), ``id`` (equal words, equal ids), ``begin`` and ``end`` (bytes)."""

    def __init__(self, column: pa.Array):
        o = offsets(column)
        base = int(o[0])
        b = data(column)[base : int(o[-1])]
        self.bytes, self.offsets = b, o - base
        n = len(column)
        solid = ~_SPACE[b]
        first = np.zeros(len(b) + 1, bool)
        first[self.offsets[:-1]] = True
        edge = solid.copy()
        edge[1:] &= ~solid[:-1] | first[1 : len(b)]
        self.begin = np.flatnonzero(edge)
        last = solid.copy()
        last[:-1] &= ~solid[1:] | first[1 : len(b)]
        self.end = np.flatnonzero(last) + 1
        self.count = np.diff(np.searchsorted(self.begin, self.offsets)) if n else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(n), self.count)
        self.first = np.concatenate([[0], np.cumsum(self.count)]).astype(np.int64)
        self.solid = solid
        ends = np.concatenate([[0], np.cumsum(self.end - self.begin)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(self.begin), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(b[solid]))])
        self.id = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(self.begin) else np.zeros(0, np.int64)

    def sums(self, marks: np.ndarray) -> np.ndarray:
        """Sum by document of a number for each byte."""
        c = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return c[self.offsets[1:]] - c[self.offsets[:-1]]

    def word_sums(self, marks: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return c[self.first[1:]] - c[self.first[:-1]]


def word_counts(column: pa.Array) -> np.ndarray:
    """Words of each text, as ``Words`` counts them, without telling them apart."""
    o = offsets(column)
    b = data(column)[int(o[0]) : int(o[-1])]
    o = o - o[0]
    edge = ~_SPACE[b]
    after = np.zeros(len(b) + 1, bool)  # a word may begin where a text does
    after[o] = True
    edge[1:] &= _SPACE[b[:-1]] | after[1 : len(b)]
    total = np.concatenate([[0], np.cumsum(edge)])
    return total[o[1:]] - total[o[:-1]]


def repeats(doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each word, the length in words of the longest run that begins there and begins again elsewhere in its document.

    Only suffixes that still tie are carried on: rounds[k] has the ranks by 2^k words of those."""
    n = len(ids)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    rank, count = _ranked(doc * (int(ids.max()) + 1) + ids)
    rounds, width = [rank.copy()], 1
    live = np.flatnonzero(count > 1)
    while len(live):
        ahead = live + width
        second = np.zeros(len(live), np.int64)
        inside = ahead < n
        inside[inside] = doc[ahead[inside]] == doc[live[inside]]
        second[inside] = rank[ahead[inside]] + 1
        # a rank is the number of smaller suffixes, so a class of m suffixes leaves room for m finer ranks
        key = rank[live] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        k = key[order]
        fresh = np.concatenate([[True], k[1:] != k[:-1]])
        at = np.flatnonzero(fresh)
        size = np.diff(np.append(at, len(k)))
        coarse = rank[live[order]]
        new_coarse = np.concatenate([[True], coarse[1:] != coarse[:-1]])
        start = np.maximum.accumulate(np.where(new_coarse, np.arange(len(k)), 0))
        group = np.repeat(at, size)
        fine = coarse + (group - start)
        rank = rank.copy()
        rank[live[order]] = fine
        width *= 2
        rounds.append(rank.copy())
        live = np.sort(live[order][np.repeat(size > 1, size)])
    sa = np.argsort(rank, kind="stable")
    i, j = sa[:-1].copy(), sa[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        ok = (i < n) & (j < n)
        ii, jj = np.minimum(i, n - 1), np.minimum(j, n - 1)
        same = ok & (doc[ii] == doc[sa[:-1]]) & (doc[jj] == doc[sa[1:]]) & (rounds[k][ii] == rounds[k][jj])
        lcp[same] += 1 << k
        i[same] += 1 << k
        j[same] += 1 << k
    out[sa[:-1]] = lcp
    out[sa[1:]] = np.maximum(out[sa[1:]], lcp)
    return out


def covered(doc_first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which words lie in [i, i + length[i]) for some i."""
    n = len(length)
    at = np.flatnonzero(length)
    diff = np.zeros(n + 1, np.int64)
    np.add.at(diff, at, 1)
    np.add.at(diff, at + length[at], -1)
    return np.cumsum(diff[:n]) > 0


def features(column: pa.Array, min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    w = Words(column)
    n = len(w.id)
    out = {"n_words": w.count.astype(np.int64), "word_chars": w.sums(w.solid & ~_LATER[w.bytes]), "n_symbols": w.sums(_SYMBOL[w.bytes])}
    longest = repeats(w.doc, w.id)
    out["n_repeat_words"] = w.word_sums(covered(w.first, np.where(longest >= 3, 3, 0)))
    long = np.where(longest >= min_words, longest, 0)
    out["repeat_covered"] = w.word_sums(covered(w.first, long))
    top = np.zeros(len(column), np.int64)
    np.maximum.at(top, w.doc, long)
    out["repeat_longest"] = top
    out["n_dup_lines"] = _dup_lines(w)
    assert n == out["n_words"].sum()
    return out


def _dup_lines(w: Words) -> np.ndarray:
    b, o = w.bytes, w.offsets
    newline = b == 10
    edge = np.zeros(len(b) + 1, bool)
    edge[o] = True
    edge[1:][newline] = True  # a line begins after each newline
    begin = np.flatnonzero(edge[:-1]) if len(b) else np.zeros(0, np.int64)
    end = np.append(begin[1:], len(b))
    end = end - newline[end - 1]
    solid = np.concatenate([[0], np.cumsum(w.solid)])
    real = solid[end] > solid[begin]
    begin, end = begin[real], end[real]
    doc = np.searchsorted(o, begin, "right") - 1
    size = end - begin
    joined = b[ranges(begin, size)]
    lines = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(joined)])
    ids = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(begin) else np.zeros(0, np.int64)
    out = np.zeros(len(o) - 1, np.int64)
    if len(ids):
        key = doc * (len(ids) + 1) + ids
        _, first = np.unique(key, return_index=True)
        later = np.ones(len(ids), np.int64)
        later[first] = 0
        np.add.at(out, doc, later)
    return out


SCHEMA = "_id long, _rk long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, repeat_covered long, repeat_longest long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, most=2 << 20):
        f = features(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_rk"), *[pa.array(f[k], pa.int64()) for k in NAMES[2:]]], NAMES)


def quality(docs: DataFrame, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST) -> DataFrame:
    """One row per document: _id, _rk, the counts, base_failed and kept. One pass over the texts, no shuffle.

    base_failed: under 50 words, or more than half of them in 3-word windows that come twice. kept: not base_failed, and
    repeats of at least 10 words cover at most 20 % of the words, the longest at most 10 %. A null or empty text has no
    words and fails; repeated rows give the same row each."""
    python_ready(docs.sparkSession)
    f = keyed(docs).select("_id", "_rk", "text").mapInArrow(_score, SCHEMA)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passes = (F.col("repeat_covered") <= most_covered * F.col("n_words")) & (F.col("repeat_longest") <= most_longest * F.col("n_words"))
    return f.withColumn("base_failed", failed).withColumn("kept", ~failed & passes)


def op7_quality_rules(spark, sf_dir) -> DataFrame:
    """The counts and verdict of every whole text of documents, by ``quality``. A null or empty text has no words and fails; very
    long texts are one block each; repeated rows get equal rows; an empty table gives none; other columns are not read."""
    out = quality(documents(spark, sf_dir))
    return out.select(doc_id(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_covered", "repeat_longest", "base_failed", "kept")


def quality_filter(docs: DataFrame, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all their columns, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index("text")
            text = pc.fill_null(whole.column(at).cast(pa.string()), "")
            probe = pa.RecordBatch.from_arrays([pa.array(range(whole.num_rows), pa.int64()), text], ["row", "text"])
            keep = np.zeros(whole.num_rows, bool)
            for b in slices(iter([probe]), most=2 << 20):
                f = features(b.column("text"))
                failed = (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
                ok = (f["repeat_covered"] <= most_covered * f["n_words"]) & (f["repeat_longest"] <= most_longest * f["n_words"])
                keep[b.column("row").to_numpy()] = ~failed & ok
            yield whole.filter(pa.array(keep))

    python_ready(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
