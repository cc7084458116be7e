"""Byte-pair encoding by proposal and check, and decoding, both by arrays.

Encoding. The distinct words of a slice of texts are encoded together. Walking a
trie in lockstep, greedy longest match proposes tokens for all of them. A
sequence of tokens is the encoding of its bytes exactly if every token is what
its own bytes merge to and every two neighbours, merged on their own, come out
as these two again; all adjacent pairs are checked at once by taking both tokens
apart from their last merge backwards. Only words with a pair that fails (or a
token no text yields) are merged step by step in order of rank. Words of more
than 64 bytes are proposed one at a time, and checked with the others.

Texts are cut into words by the byte-level pattern: here where a chunk holds
ASCII and Latin letters only, by the library for all others, as the Unicode
version decides there. Strings of special tokens in a text become their ids.

Decoding. Bytes of all ids are taken in one go; ill-formed UTF-8 becomes U+FFFD,
ids that the vocabulary lacks give nothing.

Null and empty texts give no ids, null ids an empty text; repeated rows are
encoded each, whatever their doc_id, which is not read. A text of any length is
encoded whole. All other columns pass through; an input column that has the name
of the output is replaced. A worker keeps the tables of one vocabulary (some 30
MB) and nothing of the texts.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from fraudloom.llm.chunks import Chunks
from fraudloom.llm.common import binary_array, set_last, slices, take_runs, with_binary

_NEVER = 1 << 40
_SHIFT = 20
_LONG = 64  # bytes of a word above which it is proposed on its own
_SETTLED = "ɐ"  # below, Unicode classes do not change any more
_PATTERN = regex.compile(public_tokenizers.PATTERN)  # the pattern of byte-level pre-tokenizers


def byte_of_char() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Tokens, merges and trie of a byte-level BPE file as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, before = held["model"], held["pre_tokenizer"]
        plain = {"dropout": None, "ignore_merges": False, "continuing_subword_prefix": None, "end_of_word_suffix": None}
        if (model["type"], before["type"], held["normalizer"]) != ("BPE", "ByteLevel", None) or before["add_prefix_space"] \
                or any((model.get(k) or v) != v for k, v in plain.items()):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        byte = byte_of_char()
        names: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        size = max([*names.values(), *self.special.values()]) + 1
        if size >= 1 << _SHIFT:
            raise ValueError(f"{path} has more than {1 << _SHIFT} tokens")
        self.bytes_of: list[bytes] = [b""] * size
        for name, token in names.items():
            self.bytes_of[token] = bytes(byte[c] for c in name)
        for name, token in self.special.items():
            self.bytes_of[token] = name.encode()
        self.byte_token = [names[c] for c, _ in sorted(byte.items(), key=lambda pair: pair[1])]
        self.merges: dict[int, tuple[int, int]] = {}  # left << _SHIFT | right -> rank, token
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[names[left] << _SHIFT | names[right]] = (rank, names[left + right])
        self._merge_arrays(size)
        self._trie([names[n] for n in names if names[n] not in self.special.values()])
        words = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, words)) + ")") if words else None
        self.tokenizer = Tokenizer.from_file(path)

    def _merge_arrays(self, size: int) -> None:
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], _NEVER << _SHIFT)
        self.pair_ranks = np.append(np.array([rank for rank, _ in self.merges.values()], np.int64)[order], _NEVER)
        self.pair_tokens = np.append(np.array([token for _, token in self.merges.values()], np.int32)[order], -1)
        # The last merge of each token (halves and rank); none for bytes and for tokens no text yields.
        last: dict[int, tuple[int, int, int]] = {}
        reachable = set(self.byte_token)
        for key, (rank, token) in self.merges.items():
            left, right = key >> _SHIFT, key & (1 << _SHIFT) - 1
            if token not in reachable and left in reachable and right in reachable and self._meet_at(left, right, last) == rank:
                last[token] = (left, right, rank)
                reachable.add(token)
        self.left, self.right, self.made = np.full((3, size), -1, np.int64)
        for token, halves in last.items():
            self.left[token], self.right[token], self.made[token] = halves
        self.reachable = np.isin(np.arange(size), list(reachable))

    def _meet_at(self, left: int, right: int, last: dict[int, tuple[int, int, int]]) -> int:
        """Rank of the merge that first joins parts of two tokens beside each other (see ``compatible``)."""
        left_until = right_until = met = _NEVER
        while True:
            crossing = self.merges.get(left << _SHIFT | right, (_NEVER, -1))[0]
            if crossing < left_until and crossing <= right_until:
                met = crossing
            if left not in last and right not in last:
                return met
            made_left, made_right = last.get(left, (0, 0, -1)), last.get(right, (0, 0, -1))
            if made_right[2] >= made_left[2]:
                right_until, right = made_right[2], made_right[0]
            else:
                left_until, left = made_left[2], made_left[1]

    def _trie(self, tokens: list[int]) -> None:
        self.child: dict[int, int] = {}
        token_at = [-1]
        for token in tokens:
            node = 0
            for byte in self.bytes_of[token]:
                key = node << 8 | byte
                found = self.child.get(key)
                if found is None:
                    found = self.child[key] = len(token_at)
                    token_at.append(-1)
                node = found
            token_at[node] = token
        self.token_at = np.array(token_at, np.int32)
        keys, targets = np.array(list(self.child), np.int64), np.array(list(self.child.values()), np.int32)
        order = np.argsort(keys)
        self.edge_keys, self.edge_targets = np.append(keys[order], _NEVER), np.append(targets[order], 0)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the merge of each pair; the last one, of rank never, for pairs without."""
        keys = left.astype(np.int64) << _SHIFT | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, at, len(self.pair_keys) - 1)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether tokens ``left`` and ``right`` beside each other stay apart.

        At each moment the two parts that touch must have no merge of their own
        that comes before the next merge of either; equal ranks merge from the left.
        """
        fine = np.ones(len(left), bool)
        rows, left, right = np.arange(len(left)), left.copy(), right.copy()
        left_until, right_until = np.full(len(rows), _NEVER), np.full(len(rows), _NEVER)
        while len(rows):
            crossing = self.pair_ranks[self._find(left, right)]
            merges = (crossing < left_until) & (crossing <= right_until) & (crossing < _NEVER)
            fine[rows[merges]] = False
            made_left, made_right = self.made[left], self.made[right]
            going = ~merges & ((made_left >= 0) | (made_right >= 0))
            rows, left, right, left_until, right_until, made_left, made_right = (
                a[going] for a in (rows, left, right, left_until, right_until, made_left, made_right))
            later = made_right >= made_left  # the later of two merges is undone first
            left_until = np.where(later, left_until, made_left)
            right_until = np.where(later, made_right, right_until)
            left, right = np.where(later, left, self.right[left]), np.where(later, self.left[right], right)
        return fine

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words: word numbers, ascending, and tokens."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        stop = np.cumsum(sizes)
        rows = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
        at, end = (stop - sizes)[rows], stop[rows]
        node, token, after = np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int32), at
        found_words, found_tokens = [], []
        for row in np.flatnonzero(sizes > _LONG).tolist():
            tokens = self._walk(words[row])
            found_words.append(np.full(len(tokens), row))
            found_tokens.append(np.array(tokens, np.int32))
        while len(rows):
            keys = node << 8 | data[at]
            edge = np.searchsorted(self.edge_keys, keys)
            on = (self.edge_keys[edge] == keys) & (at < end)
            node = np.where(on, self.edge_targets[edge], 0)
            at = at + on
            here = self.token_at[node]
            hit = here >= 0
            token, after = np.where(hit, here, token), np.where(hit, at, after)
            off = ~on
            found_words.append(rows[off])
            found_tokens.append(token[off])
            at = np.where(off, after, at)
            going = at < end
            going |= on
            if not going.all():
                rows, at, end, node, token, after = (a[going] for a in (rows, at, end, node, token, after))
        if not found_words:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        numbers, tokens = np.concatenate(found_words), np.concatenate(found_tokens)
        order = np.argsort(numbers, kind="stable")
        return numbers[order], tokens[order]

    def _walk(self, word: bytes) -> list[int]:
        tokens, at = [], 0
        while at < len(word):
            node, token, after = 0, -1, at
            for place in range(at, len(word)):
                node = self.child.get(node << 8 | word[place], 0)
                if not node:
                    break
                if self.token_at[node] >= 0:
                    token, after = int(self.token_at[node]), place + 1
            tokens.append(token)
            at = after
        return tokens

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words, one merge a round in each: word numbers, ascending, and tokens.

        The lowest rank comes first, from the left among equals.
        """
        long = [i for i, word in enumerate(words) if len(word) > _LONG]
        merged = [self._merge_long([self.byte_token[b] for b in words[i]]) for i in long]
        done_rows = [np.repeat(np.array(long, np.int64), list(map(len, merged)))]
        done = [np.array([t for m in merged for t in m], np.int32)]
        short = np.array([len(w) if len(w) <= _LONG else 0 for w in words], np.int64)
        rows = np.repeat(np.arange(len(words)), short)
        data = b"".join([w for w in words if len(w) <= _LONG])
        tokens = np.array(self.byte_token, np.int32)[np.frombuffer(data, np.uint8)]
        pair = self._pair(tokens, rows)
        while len(rows):
            first = np.append(True, rows[1:] != rows[:-1])
            starts = np.flatnonzero(first)
            lowest = np.minimum.reduceat(self.pair_ranks[pair], starts)
            word = np.cumsum(first) - 1
            over = (lowest == _NEVER)[word]
            done_rows.append(rows[over])
            done.append(tokens[over])
            places = np.flatnonzero((self.pair_ranks[pair] == lowest[word]) & ~over)
            places = places[np.append(True, word[places[1:]] != word[places[:-1]])] if len(places) else places
            tokens[places] = self.pair_tokens[pair[places]]
            kept = ~over
            kept[places + 1] = False
            moved = np.cumsum(kept) - 1
            places = moved[places]
            rows, tokens, pair = rows[kept], tokens[kept], pair[kept]
            for at in (places, places[places > 0] - 1):
                pair[at] = self._pair(tokens, rows, at)
        rows, tokens = np.concatenate(done_rows), np.concatenate(done)
        order = np.argsort(rows, kind="stable")
        return rows[order], tokens[order]

    def _pair(self, tokens: np.ndarray, rows: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Number of the merge of each token and the next one of its word (the last number: none)."""
        if at is None:
            at = np.arange(len(tokens))
        behind = np.minimum(at + 1, max(0, len(tokens) - 1))
        found = self._find(tokens[at], tokens[behind])
        return np.where((behind > at) & (rows[behind] == rows[at]), found, len(self.pair_keys) - 1)

    def _merge_long(self, tokens: list[int]) -> list[int]:
        """The same by a heap over places and links to neighbours."""
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def entry(at: int):
            found = self.merges.get(tokens[at] << _SHIFT | tokens[after[at]])
            return None if found is None else (found[0], at, tokens[at], tokens[after[at]], found[1])

        heap = [e for at in range(n - 1) if (e := entry(at))]
        heapq.heapify(heap)
        while heap:
            _, at, left, right, made = heapq.heappop(heap)
            behind = after[at]
            if tokens[at] != left or behind >= n or tokens[behind] != right:
                continue
            tokens[at], tokens[behind] = made, -1
            after[at] = after[behind]
            if after[at] < n:
                before[after[at]] = at
            for place in (before[at], at):
                if place >= 0 and after[place] < n and (e := entry(place)):
                    heapq.heappush(heap, e)
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word ends."""
        numbers, tokens = self.propose(words)
        failing = np.zeros(len(words), bool)
        if len(tokens):
            failing[numbers[~self.reachable[tokens]]] = True
            beside = np.flatnonzero(numbers[1:] == numbers[:-1])
            pairs, of = np.unique(
                tokens[beside].astype(np.int64) << _SHIFT | tokens[beside + 1], return_inverse=True)
            fine = self.compatible(pairs >> _SHIFT, pairs & (1 << _SHIFT) - 1)
            failing[numbers[beside[~fine[of]]]] = True
        again = np.flatnonzero(failing)
        rows, merged = self.merge([words[i] for i in again.tolist()])
        kept = ~failing[numbers]
        numbers, tokens = np.concatenate([numbers[kept], again[rows]]), np.concatenate([tokens[kept], merged])
        order = np.argsort(numbers, kind="stable")
        return tokens[order].astype(np.uint32), np.cumsum(np.bincount(numbers, minlength=len(words)))

    def words(self, chunk: str) -> list[str]:
        """The library's words of a chunk of text."""
        if chunk.isascii() or max(chunk) < _SETTLED:
            return _PATTERN.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends."""
        chunks = Chunks(texts, self.cut)
        names, index, chunk_ends = chunks.pieces(_PATTERN, self.words)
        marks = [i for i, name in enumerate(names) if isinstance(name, tuple)]
        # A special string is an empty word here and gets its id afterwards.
        ids, ends = self.encode_words([b"" if isinstance(name, tuple) else name.encode() for name in names])
        if marks:
            ids = np.insert(ids, ends[marks], [self.special[names[i][0]] for i in marks])
            more = np.zeros(len(names), np.int64)
            more[marks] = 1
            ends = ends + np.cumsum(more)
        ids, ends = take_runs(ids, ends, index)
        return chunks.texts(ids, np.concatenate([[0], ends])[chunk_ends])

    @property
    def table(self) -> pa.Array:
        """Bytes of every id; the entry behind the last is empty."""
        return pa.array([*self.bytes_of, b""], pa.binary())


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as little-endian 32-bit numbers."""
    schema = with_binary(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = vocabulary(tokenizer_path)
        for batch in slices(batches, text):
            made, ends = held.encode([t or "" for t in batch.column(text).to_pylist()])
            yield set_last(batch, schema, binary_array(made.astype("<u4"), 4 * ends))

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the UTF-8 bytes of the text that ``ids`` stand for (null: empty)."""
    schema = with_binary(encoded, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(tokenizer_path).table
        for batch in slices(batches, ids):
            held = [data or b"" for data in batch.column(ids).to_pylist()]
            asked = np.frombuffer(b"".join(held), "<u4")
            ends = np.cumsum(np.array(list(map(len, held)), np.int64)) // 4
            taken = table.take(pa.array(np.minimum(asked, len(table) - 1)))
            _, places, data = taken.buffers()
            places = np.frombuffer(places, np.int32)[:len(asked) + 1] if len(asked) else np.zeros(1, np.int32)
            made = binary_array(np.frombuffer(data, np.uint8) if len(asked) else np.zeros(0, np.uint8), places[ends])
            try:
                made.cast(pa.string())
            except pa.ArrowInvalid:
                made = pa.array([d.decode("utf-8", "replace").encode() for d in made.to_pylist()], pa.binary())
            yield set_last(batch, schema, made)

    return encoded.mapInArrow(run, schema)
