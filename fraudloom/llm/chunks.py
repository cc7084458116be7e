"""Texts as numbers of their distinct chunks.

Most words of a corpus occur again and again: a slice of texts is cut where a
space precedes a non-blank, each distinct chunk gets a number, and whatever is
costly (splitting, encoding) is done once per chunk of the slice. Texts are put
together again by taking runs in Arrow. Nothing outlives the slice.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyarrow import compute as pc

from fraudloom.llm.common import take_runs, words_after_space


class Chunks:
    """Distinct chunks of a slice of texts, and where they occur.

    ``after`` are chunks that a space precedes (without it), ``heads`` the others:
    a string, or a tuple of one special string. ``after`` is an Arrow array. ``index`` numbers all chunks in the
    order of the texts, ``after`` first, then ``heads``; ``ends`` is where each
    text ends in it.
    """

    def __init__(self, texts: list[str], special: re.Pattern | None = None):
        heads: dict[str | tuple[str], int] = {}
        firsts, rests, rows, row_ends = [], [], [], []
        for text in texts:
            if special is not None and special.search(text):
                # The pattern has one group: every other segment is a special string.
                for k, segment in enumerate(special.split(text)):
                    head, *rest = [(segment,)] if k % 2 else words_after_space(segment)
                    firsts.append(heads.setdefault(head, len(heads)))
                    rests.append(rest)
            else:
                rest = words_after_space(text)
                firsts.append(heads.setdefault(rest[0], len(heads)))
                rests.append(rest[1:])
            row_ends.append(len(rests))
        rows = np.fromiter(map(len, rests), np.int64, len(rests)) + 1
        parts = pa.array(list(chain.from_iterable(rests)), pa.string()).dictionary_encode()
        self.after: pa.Array = parts.dictionary
        self.heads = list(heads)
        ends = np.cumsum(rows)
        first = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
        first[ends - rows] = True
        self.index = np.empty(len(first), np.int32)
        self.index[first] = np.array(firsts, np.int32) + len(self.after)
        self.index[~first] = parts.indices.to_numpy()
        self.ends = np.concatenate([[0], ends])[row_ends]

    def pieces(
        self, pattern: regex.Pattern, cut: Callable[[str], list[str]],
    ) -> tuple[list[str | tuple[str]], np.ndarray, np.ndarray]:
        """Pieces of the chunks (some may be there twice), the pieces of all chunks in order, and where each chunk ends.

        ``cut`` splits any chunk; ASCII ones are split by ``pattern``, all in one
        text where they hold no blank: a line end between them is a match of its
        own there. Special strings stay whole.
        """
        names: list[str | tuple[str]] = []
        chunk_of, piece_of = [], []

        def add(chunks: np.ndarray, found: list, numbers: np.ndarray) -> None:
            chunk_of.append(chunks)
            piece_of.append(numbers + len(names))
            names.extend(found)

        letters = pc.ascii_is_alpha(self.after).to_numpy(zero_copy_only=False)
        plain = pc.match_substring_regex(self.after, "^[!-~]+$").to_numpy(zero_copy_only=False) & ~letters
        spaced = pc.binary_join_element_wise(pa.scalar(""), self.after, pa.scalar(" "))
        whole = np.flatnonzero(letters)
        add(whole, spaced.take(pa.array(whole)).to_pylist(), np.arange(len(whole)))
        some = np.flatnonzero(plain)
        found = pa.array(pattern.findall("\n".join(spaced.take(pa.array(some)).to_pylist())), pa.string())
        ends = pc.equal(found, "\n").to_numpy(zero_copy_only=False).astype(bool)
        of = some[np.cumsum(ends)[~ends]] if len(some) else some
        distinct = found.filter(pa.array(~ends)).dictionary_encode()
        add(of, distinct.dictionary.to_pylist(), distinct.indices.to_numpy())
        others, numbers = [], {}
        rest = np.flatnonzero(~letters & ~plain)
        for chunk, text in zip(rest.tolist(), spaced.take(pa.array(rest)).to_pylist()):
            others += [(chunk, numbers.setdefault(piece, len(numbers))) for piece in cut(text)]
        for chunk, head in enumerate(self.heads, len(self.after)):
            held = [head] if isinstance(head, tuple) else cut(head)
            others += [(chunk, numbers.setdefault(piece, len(numbers))) for piece in held]
        pairs = np.array(others, np.int64).reshape(-1, 2)
        add(pairs[:, 0], list(numbers), pairs[:, 1])
        chunk, piece = np.concatenate(chunk_of), np.concatenate(piece_of)
        order = np.argsort(chunk, kind="stable")
        ends = np.cumsum(np.bincount(chunk, minlength=len(self.after) + len(self.heads)))
        return names, piece[order].astype(np.int32), ends

    def texts(self, values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the chunks (chunk i ends at ``ends[i]``) put together to those of the texts."""
        values, ends = take_runs(values, ends, self.index)
        return values, np.concatenate([[0], ends])[self.ends]
