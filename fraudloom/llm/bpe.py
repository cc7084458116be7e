"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly if every
two neighbours, merged on their own, come out as these two tokens again. So the
encoder is a non-deterministic transducer: a configuration is a node of the
token trie (bytes read of the token under way), the token before it and the
tokens not yet emitted. Determinising by subsets gives states that are sets of
configurations; tokens shared by all of them are emitted as soon as they agree,
which bounds the delay. States and edges are made when a text first needs them.
They are kept packed in arrays (some 100 bytes a state with its edges) and dropped
all together beyond ``max_states``; that never changes a result. The distinct
pieces of a slice of texts are encoded once each, and the texts are put together
from them.

Pieces are those of the library's pattern. Where the Unicode version of the
pattern library here takes a character for another class than the tokenizer
library does, which is asked, a character of the right class stands in for it
while the text is cut.

Decoding. Each token moves a UTF-8 state machine that carries an unfinished
character from token to token. Ill-formed bytes become U+FFFD.

Nulls are encoded as empty text, empty texts give no ids; repeated rows are
encoded each; texts of any length are encoded whole; all other columns pass
through. An input column that has the name of an output is replaced. A worker
keeps one encoder (its states are bounded) and nothing of the texts.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fraudloom.llm.chunks import Chunks
from fraudloom.llm.common import binary_array, set_last, slices, take_runs, with_binary

Config = tuple[int, int, tuple[int, ...]]
_NEVER = 1 << 62
_OUT_BITS = 24  # an edge is next state << 24 | number of its output
_OUT = (1 << _OUT_BITS) - 1
_LONG = 64  # bytes of a piece above which it is encoded on its own
_SETTLED = "\u0250"  # below, Unicode classes do not change any more


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Bytes of one pre-token to token ids.

    A state is its configurations as packed 32-bit numbers, found by their hash.
    ``edges`` has for each (state, byte) in ``keys`` the next state and the number of
    the output on the way; ``final`` has the output still pending if the text ends in
    a state. What was made last is in dictionaries until it is sorted into the arrays.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = 600_000):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.leaf: list[bool] = [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                found = self.child.get(key)
                if found is None:
                    found = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.leaf.append(True)
                    self.leaf[node] = False
                node = found
            self.token_at[node] = rank
        self.follows: dict[int, bool] = {}
        self.starts: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.grown: dict[int, list[int]] = {}  # token -> tokens whose left half it is, by rank
        for token in sorted(self.bytes_of):
            made = self._halves(token)
            if made is not None:
                self.grown.setdefault(made[0], []).append(token)
        self._restart()

    def _restart(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.int64), np.zeros(0, np.int32)  # of states, by hash
        self.packed, self.offsets, self.final = bytearray(), array("Q", [0]), array("I")
        self.keys, self.edges = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new_states: dict[int, int] = {}
        self.new_edges: dict[int, int] = {}
        self.outs, self.out_numbers = [b""], {b"": 0}
        self._state(self._pack([(0, -1, ())]))

    def _settle(self) -> None:
        """Sort the states and edges made since the last time into the arrays."""
        def merged(keys: np.ndarray, values: np.ndarray, new: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([keys, np.fromiter(new, np.int64, len(new))])
            values = np.concatenate([values, np.fromiter(new.values(), values.dtype, len(new))])
            order = np.argsort(keys, kind="stable")
            return keys[order], values[order]

        self.hashes, self.numbers = merged(self.hashes, self.numbers, self.new_states)
        self.keys, self.edges = merged(self.keys, self.edges, self.new_edges)
        self.new_states, self.new_edges = {}, {}

    @staticmethod
    def _pack(configs: list[Config]) -> bytes:
        return array("i", [x for node, before, pending in configs for x in (node, before, len(pending), *pending)]).tobytes()

    def _config(self, state: int) -> bytes:
        return bytes(self.packed[self.offsets[state]:self.offsets[state + 1]])

    @staticmethod
    def _unpack(packed: bytes) -> Iterator[Config]:
        held, at = array("i", packed), 0
        while at < len(held):
            end = at + 3 + held[at + 2]
            yield held[at], held[at + 1], tuple(held[at + 3:end])
            at = end

    def _out(self, output: bytes) -> int:
        found = self.out_numbers.get(output)
        if found is None:
            found = self.out_numbers[output] = len(self.outs)
            self.outs.append(output)
        return found

    @staticmethod
    def _among(keys: np.ndarray, values: np.ndarray, new: dict[int, int], key: int) -> int | None:
        found = new.get(key)
        if found is None:
            at = int(keys.searchsorted(key))
            if at < len(keys) and keys[at] == key:
                return int(values[at])
        return found

    def _state(self, packed: bytes) -> int:
        key = hash(packed)
        found = self._among(self.hashes, self.numbers, self.new_states, key)
        # Of two states with one hash the later is found: the other is made again, which does no harm.
        if found is None or self._config(found) != packed:
            found = self.new_states[key] = len(self.final)
            self.packed += packed
            self.offsets.append(len(self.packed))
            # What is pending where a token has just ended; before the first byte nothing is.
            ended = next((pending for node, _, pending in self._unpack(packed) if node == 0), ())
            self.final.append(self._out(array("I", ended).tobytes()))
        return found

    def _full(self) -> bool:
        return len(self.final) >= self.max_states or len(self.outs) >= _OUT

    def _edges(self, keys: np.ndarray) -> np.ndarray:
        """Edges of distinct keys; missing ones are made."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        found = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            known = self.keys[at] == keys
            found[known] = self.edges[at[known]]
        for i in np.flatnonzero(found < 0).tolist():
            key = int(keys[i])
            edge = self.new_edges.get(key)
            found[i] = self._extend(key >> 8, key & 255) if edge is None else edge
        return found

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for bytes and for tokens no text yields."""
        if token not in self.halves:
            word, made = self.bytes_of[token], None
            parts = [word[i:i + 1] for i in range(len(word))]
            while len(parts) > 2:
                ranked = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
                best = min(ranked)
                if best >= token:
                    break
                at = ranked.index(best)
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2 and parts[0] in self.ranks and parts[1] in self.ranks:
                made = (self.ranks[parts[0]], self.ranks[parts[1]])
            self.halves[token] = made
        return self.halves[token]

    def _reachable(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self._halves(token) is not None

    def may_follow(self, before: int, token: int) -> bool:
        """Whether ``token`` stays whole after ``before`` (-1: at the start).

        Both tokens are taken apart from their last merge backwards. At each
        moment the two parts that touch must not have a merge of their own that
        comes before the next merge of either.
        """
        if before < 0:
            return self._reachable(token)
        key = before << 32 | token
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > 150_000:
                self.follows.clear()
            known = self.follows[key] = self._reachable(token) and not self._crosses(before, token)
        return known

    def _crosses(self, left: int, right: int) -> bool:
        left_until = right_until = _NEVER
        while True:
            crossing = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], _NEVER)
            # Equal ranks merge from the left.
            if crossing < left_until and crossing <= right_until and crossing < _NEVER:
                return True
            halves, other = self._halves(left), self._halves(right)
            if halves is None and other is None:
                return False
            if other is not None and (halves is None or right >= left):
                right_until, right = right, other[0]
            else:
                left_until, left = left, halves[1]

    def _may_start(self, before: int, byte: int) -> bool:
        """Whether any token that begins with ``byte`` may follow ``before``."""
        if before < 0:
            return True
        key = before << 8 | byte
        known = self.starts.get(key)
        if known is None:
            edge = [before]  # the parts of `before` that reach its right end, last byte first
            while (made := self._halves(edge[0])) is not None:
                edge.insert(0, made[1])
            if len(self.starts) > 150_000:
                self.starts.clear()
            known = self.starts[key] = self._grows(edge, self.ranks[bytes([byte])])
        return known

    def _grows(self, edge: list[int], left: int) -> bool:
        """Whether ``left`` or a token grown from it stays whole after the parts in ``edge``."""
        if not self._crosses(edge[-1], left):
            return True
        for longer in self.grown.get(left, ()):
            # Parts that touch while `left` waits to become `longer`.
            for at, part in enumerate(edge):
                until = edge[at + 1] if at + 1 < len(edge) else _NEVER
                crossing = self.ranks.get(self.bytes_of[part] + self.bytes_of[left], _NEVER)
                together = part <= longer and until >= self._made(left)
                if together and crossing < until and crossing <= longer:
                    break
            else:
                if self._grows(edge, longer):
                    return True
        return False

    def _made(self, token: int) -> int:
        return -1 if self._halves(token) is None else token

    def _step(self, state: int, byte: int) -> tuple[bytes, bytes]:
        """The next state, packed, and the output on the way."""
        reached: list[Config] = []
        for node, before, pending in self._unpack(self._config(state)):
            if not node and not self._may_start(before, byte):
                continue
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token_at[node]
            if token >= 0 and self.may_follow(before, token):
                reached.append((0, token, (*pending, token)))
            if not self.leaf[node]:
                reached.append((node, before, pending))
        if not reached:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        agreed: tuple[int, ...] = ()
        if len(reached) == 1:
            agreed = reached[0][2]
        elif all(c[2] for c in reached):
            agreed = min((c[2] for c in reached), key=len)
            while any(c[2][:len(agreed)] != agreed for c in reached):
                agreed = agreed[:-1]
        if agreed:
            reached = [(n, b, p[len(agreed):]) for n, b, p in reached]
        reached.sort()
        return self._pack(reached), array("I", agreed).tobytes()

    def _extend(self, state: int, byte: int) -> int:
        packed, output = self._step(state, byte)
        edge = self.new_edges[state << 8 | byte] = self._state(packed) << _OUT_BITS | self._out(output)
        return edge

    def encode(self, word: bytes) -> bytes:
        """Ids of one word as little-endian 32-bit numbers."""
        state, made = 0, []
        for byte in word:
            edge = self._among(self.keys, self.edges, self.new_edges, state << 8 | byte)
            if edge is None:
                if self._full():
                    packed = self._config(state)
                    self._restart()
                    state = self._state(packed)
                edge = self._extend(state, byte)
            if edge & _OUT:
                made.append(self.outs[edge & _OUT])
            state = edge >> _OUT_BITS
        made.append(self.outs[self.final[state]])
        return b"".join(made)

    def encode_all(self, words: list[bytes], block: int = 16_384) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word ends."""
        ids, sizes = [], []
        for at in range(0, len(words), block):
            if self._full():
                self._restart()
            values, ends = self._in_step(words[at:at + block])
            if len(self.new_edges) > 1 << 16:
                self._settle()
            ids.append(values)
            sizes.append(np.diff(ends, prepend=0))
        none = np.zeros(0, np.int64)
        return np.concatenate([none.astype("<u4"), *ids]), np.cumsum(np.concatenate([none, *sizes]))

    def _in_step(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words byte by byte, all at once: each edge is looked up (or made) once a step."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(sizes) - sizes
        long = np.flatnonzero(sizes > _LONG)
        outputs = [self.encode(words[i]) for i in long.tolist()]
        rows = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
        state, at = np.zeros(len(rows), np.int64), 0
        found_rows, found = [long], [np.arange(len(long))]

        def add(some: np.ndarray, numbers: np.ndarray) -> None:
            found_rows.append(some)
            found.append(numbers + len(outputs))

        while len(rows):
            keys, of = np.unique(state << 8 | data[start[rows] + at], return_inverse=True)
            edge = self._edges(keys)[of]
            state, out, at = edge >> _OUT_BITS, edge & _OUT, at + 1
            add(rows[out > 0], out[out > 0])
            ended = sizes[rows] == at
            add(rows[ended], np.array([self.final[i] for i in state[ended].tolist()], np.int64))
            rows, state = rows[~ended], state[~ended]
        word, number = np.concatenate(found_rows), np.concatenate(found)
        order = np.argsort(word, kind="stable")
        outputs += self.outs
        ends = np.cumsum(np.fromiter(map(len, outputs), np.int64, len(outputs))) // 4
        ids, ends = take_runs(np.frombuffer(b"".join(outputs), "<u4"), ends, number[order].astype(np.int32))
        return ids, np.concatenate([[0], ends])[np.cumsum(np.bincount(word, minlength=len(words)))]


class Cutter:
    """Matches of a pattern over letters, numbers and blanks, with the library's Unicode classes."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.own = {name: regex.compile(rule) for name, rule in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
        # A vocabulary that shows classes: "'s" is one token only if the character before it ends
        # a match, "a" or "1" joins a first byte only if the character belongs to the match.
        lead = [bytes([b]) for b in range(0xC2, 0xF5)]
        tokens = [*[bytes([b]) for b in range(256)], b"'s", *[b"a" + b for b in lead], *[b"1" + b for b in lead]]
        self.probe = tiktoken.Encoding(
            "classes", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
        self.stand_in: dict[str, str] = {}

    def library_class(self, char: str) -> str:
        if self.probe.encode_ordinary("a" + char)[0] >= 256:
            return "L"
        if self.probe.encode_ordinary("1" + char)[0] >= 256:
            return "N"
        return "S" if 256 in self.probe.encode_ordinary(char + "'s") else "O"

    def _learn(self, char: str) -> str:
        own = next((name for name, rule in self.own.items() if rule.match(char)), "O")
        library = self.library_class(char)
        # No contraction of the pattern holds a z.
        found = self.stand_in[char] = char if own == library else {"L": "z", "N": "1", "S": "\t", "O": "!"}[library]
        return found

    def cut(self, chunk: str) -> list[str]:
        if chunk.isascii() or max(chunk) < _SETTLED:
            return self.pattern.findall(chunk)
        if len(self.stand_in) > 100_000:
            self.stand_in.clear()
        plain = "".join([c if c < _SETTLED else self.stand_in.get(c) or self._learn(c) for c in chunk])
        if plain == chunk:
            return self.pattern.findall(chunk)
        return [chunk[m.start():m.end()] for m in self.pattern.finditer(plain)]


class TextEncoder:
    """Whole texts: the pattern cuts, the transducer encodes each distinct piece of a slice once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.cutter = Cutter(pattern)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends."""
        chunks = Chunks(texts)
        pieces, index, chunk_ends = chunks.pieces(self.cutter.pattern, self.cutter.cut)
        ids, ends = self.transducer.encode_all([piece.encode() for piece in pieces])
        ids, ends = take_runs(ids, ends, index)
        return chunks.texts(ids, np.concatenate([[0], ends])[chunk_ends])


def _utf8_steps() -> list[dict[int, int]]:
    """Transitions of well-formed UTF-8: state -> byte -> state; 0 is between characters."""
    any_next, spans = (0x80, 0xBF), []
    spans.append((0, 0x00, 0x7F, 0))
    spans.append((0, 0xC2, 0xDF, 1))
    spans += [(0, 0xE1, 0xEC, 2), (0, 0xEE, 0xEF, 2), (0, 0xE0, 0xE0, 4), (0, 0xED, 0xED, 5)]
    spans += [(0, 0xF1, 0xF3, 3), (0, 0xF0, 0xF0, 6), (0, 0xF4, 0xF4, 7)]
    spans += [(1, *any_next, 0), (2, *any_next, 1), (3, *any_next, 2)]
    spans += [(4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)]
    steps: list[dict[int, int]] = [{} for _ in range(8)]
    for state, first, last, target in spans:
        steps[state].update(dict.fromkeys(range(first, last + 1), target))
    return steps


class StreamDecoder:
    """Token ids to text, one token at a time; an unfinished character waits for the next."""

    _STEPS = _utf8_steps()

    def __init__(self, token_bytes: dict[int, bytes]):
        self.token_bytes = token_bytes
        size = max(token_bytes, default=-1) + 1
        # The text of a token that begins and ends between characters, else None.
        self.clean: list[str | None] = [None] * size
        for token, data in token_bytes.items():
            try:
                self.clean[token] = data.decode()
            except UnicodeDecodeError:
                pass
        self.reset()

    def reset(self) -> None:
        self.state, self.held = 0, bytearray()

    def feed(self, token: int) -> str:
        if not self.held:
            text = self.clean[token]
            if text is not None:
                return text
        out: list[str] = []
        for byte in self.token_bytes[token]:
            target = self._STEPS[self.state].get(byte)
            if target is None and self.state:
                out.append("�")
                self.reset()
                target = self._STEPS[0].get(byte)
            if target is None:
                out.append("�")
                continue
            self.held.append(byte)
            self.state = target
            if not target:
                out.append(self.held.decode())
                self.held.clear()
        return "".join(out)

    def finish(self) -> str:
        rest = "�" if self.held else ""
        self.reset()
        return rest

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        texts = list(map(self.clean.__getitem__, ids))
        if None not in texts:
            return "".join(texts)
        self.reset()
        return "".join([*map(self.feed, ids), self.finish()])


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(read_ranks(path), pattern)


@lru_cache(maxsize=1)
def _decoder(path: str) -> StreamDecoder:
    return StreamDecoder({rank: token for token, rank in read_ranks(path).items()})


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as little-endian 32-bit numbers."""
    schema = with_binary(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in slices(batches, text):
            made, ends = encoder.encode([t or "" for t in batch.column(text).to_pylist()])
            yield set_last(batch, schema, binary_array(made.astype("<u4"), 4 * ends))
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """Add ``ids`` and, decoded from these, ``decoded``, in one pass; ``text`` is left out."""
    kept = docs.drop(text, ids, decoded).schema.fields
    schema = T.StructType([*kept, T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(ranks_path, pattern), _decoder(ranks_path)
        for batch in slices(batches, text):
            made, ends = encoder.encode([t or "" for t in batch.column(text).to_pylist()])
            texts = [decoder.decode(some.tolist()).encode() for some in np.split(made, ends[:-1])]
            kept = [batch.column(f.name) for f in schema.fields[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*kept, binary_array(made.astype("<u4"), 4 * ends), pa.array(texts, pa.binary())], schema.names)
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the UTF-8 bytes of the text that ``ids`` stand for (null: empty)."""
    schema = with_binary(encoded, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(ranks_path)
        for batch in slices(batches, ids):
            made = [decoder.decode(array("I", data or b"")).encode() for data in batch.column(ids).to_pylist()]
            yield set_last(batch, schema, pa.array(made, pa.binary()))

    return encoded.mapInArrow(run, schema)
