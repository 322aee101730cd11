"""Edit-aware token counts.

A document is kept as a segment tree over its units, stretches that no pre-token crosses (see ``tokens``): each leaf has the bytes
and the tokens of its units, each inner node their sums. An edit replaces a byte range. Only the units that it touches, and
one on each side as boundary context, are encoded again; what comes of them goes back as units, so that later edits find
small ones too, and the sums above are updated. The counts equal those of encoding the edited text as a whole.

Trees last: ``token_trees`` gives a table with each document's text and the bytes and tokens of its units, and ``apply_edits`` takes
such a table and gives the next one, so a further round of edits encodes only what that round touches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import data, doc_id, documents, keyed, offsets, python_ready, slices, stage
from .tokens import Encoder, encoder, vocabulary

#: The edits of the query: each e-mail address and each phone number is masked.
MASKS = ((re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), b"[email]"), (re.compile(rb"\+\d{1,3} \(\d+\) [\d-]+"), b"[phone]"))


class TokenTree:
    """Sums of (bytes, tokens) over the units of one text. A leaf is a list of units: one at first, and after an edit those
    that came of it."""

    def __init__(self, text: bytes, sizes: np.ndarray, tokens: np.ndarray, enc: Encoder):
        self.enc, n = enc, len(sizes)
        ends = np.cumsum(sizes).tolist()
        self.leaves: list[list[tuple[bytes, int]]] = [[(text[a:b], t)] for a, b, t in zip([0, *ends[:-1]], ends, tokens.tolist(), strict=True)] if n else [[]]
        self.width = 1 << max(0, (n - 1).bit_length()) if n else 1
        self.bytes, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        self.bytes[self.width : self.width + n] = sizes
        self.tokens[self.width : self.width + n] = tokens
        level = self.width
        while level > 1:
            half = level // 2
            for t in (self.bytes, self.tokens):
                t[half:level] = t[level : 2 * level : 2] + t[level + 1 : 2 * level : 2]
            level = half

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def units(self) -> list[tuple[bytes, int]]:
        return [u for leaf in self.leaves for u in leaf]

    def _unit(self, at: int) -> tuple[int, int, int]:
        """Leaf and number in it of the unit that holds byte ``at`` (the last unit, for the end), and where it begins."""
        at, node, begin = min(at, int(self.bytes[1]) - 1), 1, 0
        while node < self.width:
            node *= 2
            if at - begin >= self.bytes[node]:
                begin += int(self.bytes[node])
                node += 1
        leaf = self.leaves[node - self.width]
        for k, (u, _) in enumerate(leaf):
            if at - begin < len(u):
                return node - self.width, k, begin
            begin += len(u)
        raise IndexError(at)

    def _update(self, leaf: int) -> None:
        node = leaf + self.width
        self.bytes[node], self.tokens[node] = sum(len(u) for u, _ in self.leaves[leaf]), sum(t for _, t in self.leaves[leaf])
        while node > 1:
            node //= 2
            self.bytes[node] = self.bytes[2 * node] + self.bytes[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Put ``new`` for the bytes [begin, end); returns how many bytes were encoded again."""
        if not self.bytes[1]:
            text, lo, hi = new, (0, 0), (0, -1)
        else:
            # the units touched and one more on either side: the cuts next to them then lie between characters that stay
            *lo, first = self._unit(max(0, begin - 1))
            if first:
                *lo, first = self._unit(first - 1)
            *hi, last = self._unit(end)
            last += len(self.leaves[hi[0]][hi[1]][0])
            if last < self.bytes[1]:
                *hi, last = self._unit(last)
            inner = [u for leaf in range(lo[0], hi[0] + 1) for k, (u, _) in enumerate(self.leaves[leaf]) if (leaf, k) >= tuple(lo) and (leaf, k) <= tuple(hi)]
            text = b"".join(inner)
            text = text[: begin - first] + new + text[end - first :]
        starts, count, _ = self.enc.units(np.frombuffer(text, np.uint8), np.array([0, len(text)], np.int64))
        cuts = [*starts.tolist(), len(text)]
        made = [(text[x:y], t) for x, y, t in zip(cuts[:-1], cuts[1:], count.tolist(), strict=True)]
        after = self.leaves[hi[0]][hi[1] + 1 :]
        self.leaves[lo[0]] = self.leaves[lo[0]][: lo[1]] + made + (after if hi[0] == lo[0] else [])
        for leaf in range(lo[0] + 1, hi[0] + 1):
            self.leaves[leaf] = after if leaf == hi[0] else []
        for leaf in range(lo[0], hi[0] + 1):
            self._update(leaf)
        return len(text)


def mask_edits(text: bytes) -> list[tuple[int, int, bytes]]:
    """(begin, end, new bytes) of the masks, from the last to the first, so that earlier places stay valid."""
    out = [(m.start(), m.end(), new) for rule, new in MASKS for m in rule.finditer(text)]
    out.sort()
    kept = [e for i, e in enumerate(out) if not i or e[0] >= out[i - 1][1]]
    return kept[::-1]


TREE = "_id long, _rk long, text binary, sizes array<int>, tokens array<int>"


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def token_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row: _id, _rk, text, and of its units the bytes and the tokens, from which a tree is a few numpy sums. One
    pass over whole texts, no shuffle. A null or empty text has no units."""
    path = path or vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, most=2 << 20):
            o = offsets(b.column("text"))
            raw = data(b.column("text"))[int(o[0]) : int(o[-1])]
            o = o - o[0]
            starts, count, _ = enc.units(raw, o)
            at = np.searchsorted(starts, o)
            sizes = np.diff(np.append(starts, len(raw)))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_rk"), b.column("text").cast(pa.binary()), _lists(sizes, at), _lists(count, at)], ["_id", "_rk", "text", "sizes", "tokens"])

    python_ready(docs.sparkSession)
    return keyed(docs).mapInArrow(run, TREE)


def apply_edits(trees: DataFrame, path: str | None = None, edits=mask_edits) -> DataFrame:
    """The trees of the edited texts, with n_tokens_before, n_tokens, n_edits, n_bytes_before and n_bytes_reencoded. ``edits`` gives
    a text's edits from the last to the first; a text without any goes through as it is."""
    path = path or vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, most=2 << 20):
            texts = b.column("text").to_pylist()
            before = np.array([len(t) for t in texts], np.int64)
            bounds = [offsets_of(b.column(c)) for c in ("sizes", "tokens")]
            sizes, tokens = (b.column(c).flatten().to_numpy() for c in ("sizes", "tokens"))
            total = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
            old = total[bounds[1][1:]] - total[bounds[1][:-1]]
            now, n_edits, again = old.copy(), np.zeros(len(old), np.int64), np.zeros(len(old), np.int64)
            todo = [(i, e) for i, t in enumerate(texts) if (e := edits(t))]
            parts: list[tuple[np.ndarray, np.ndarray]] = []
            at, last = bounds[0], 0
            count = np.diff(at)
            for i, steps in todo:
                tree = TokenTree(texts[i], sizes[at[i] : at[i + 1]], tokens[at[i] : at[i + 1]], enc)
                for begin, end, new in steps:
                    again[i] += tree.replace(begin, end, new)
                units = tree.units()
                parts += [(sizes[at[last] : at[i]], tokens[at[last] : at[i]]), (np.array([len(u) for u, _ in units], np.int64), np.array([t for _, t in units], np.int64))]
                texts[i], now[i], n_edits[i], count[i], last = b"".join(u for u, _ in units), tree.total, len(steps), len(units), i + 1
            parts.append((sizes[at[last] :], tokens[at[last] :]))
            to = np.concatenate([[0], np.cumsum(count)])
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_rk"), pa.array(texts, pa.binary()), *(_lists(np.concatenate(x), to) for x in zip(*parts, strict=True)), *map(pa.array, (old, now, n_edits, before, again))],
                ["_id", "_rk", "text", "sizes", "tokens", "n_tokens_before", "n_tokens", "n_edits", "n_bytes_before", "n_bytes_reencoded"],
            )

    python_ready(trees.sparkSession)
    return trees.select("_id", "_rk", "text", "sizes", "tokens").mapInArrow(run, TREE + ", n_tokens_before long, n_tokens long, n_edits long, n_bytes_before long, n_bytes_reencoded long")


def offsets_of(lists: pa.ListArray) -> np.ndarray:
    """Where each row's elements begin among all that ``flatten`` gives."""
    o = lists.offsets.to_numpy().astype(np.int64)
    return o - o[0]


def edited_counts(docs: DataFrame, path: str | None = None, edits=mask_edits) -> DataFrame:
    """One row per row: _id, n_tokens (the whole text), n_edits, n_tokens_edited, n_bytes, n_bytes_reencoded. The trees are written
    down, and the edits are applied to what is read back."""
    trees = stage(token_trees(docs, path), "token-trees")
    out = apply_edits(trees, path, edits)
    return out.select("_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_edited"), F.col("n_bytes_before").alias("n_bytes"), "n_bytes_reencoded")


def op10_token_counts(spark, sf_dir) -> DataFrame:
    """Counts of all documents before and after masking their e-mail addresses and phone numbers, by ``edited_counts``. A null or
    empty text has no tokens; repeated rows get equal rows; an empty table gives none; other columns are not read."""
    return edited_counts(documents(spark, sf_dir)).select(doc_id(), "n_tokens", "n_edits", "n_tokens_edited", "n_bytes", "n_bytes_reencoded")
