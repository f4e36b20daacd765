"""Operator 8: byte-level BPE as a lazily determinised finite-state transducer, and its inverse as a stream.

A sequence of tokens is what BPE makes of its bytes if and only if every two neighbours are: the merges of both
together must end in just these two. That turns the merges into a transducer that reads bytes and guesses where
tokens end; a guess survives while it is the beginning of some token and its tokens agree with their neighbours. The
transducer is made deterministic while it runs: a state is the set of guesses that are alive, and the tokens all of
them have in common are emitted. Guesses never reach back further than the longest token, which bounds states and
lookahead. States of the beginnings of pieces, which many share, and whole pieces are remembered up to fixed numbers, then
forgotten; behind a beginning the guesses are followed without making states.

Decoding joins the bytes of tokens; a UTF-8 state machine holds back an incomplete character until its rest comes.

Defined results: NULL is an empty text with no tokens; a piece of any length takes time in proportion to it; equal
texts get equal tokens; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillspan.llm.common import map_batches, small_batches, worker_state

Ranks = dict[bytes, int]
# A guess: tokens not emitted yet, and the node of the token that has begun in the tree of all tokens. A state has the
# last token emitted and its guesses, those whose token began first coming first.
Guess = tuple[tuple[int, ...], int]
State = tuple[int, tuple[Guess, ...]]

MAX_STEPS = 200_000
MAX_PIECES = 120_000
# Places for the marks of pieces that came lately, a byte each.
LATELY = 1 << 20
# States are made for the first bytes of a piece; what comes later is followed without remembering it.
DEEP = 4
MAX_PAIRS = 200_000
LONG_PIECE = 64
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
# Texts longer than this are cut into pieces one by one instead of into one list.
LONG_TEXT = 4_000_000


def read_ranks(path: str) -> Ranks:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


# An edge of a token while it is being made: its part at that edge, and the rank of the merge that ends this part.
Edge = list[tuple[bytes, int]]
NEVER = 1 << 60


def edges(ranks: Ranks, data: bytes) -> tuple[list[int], Edge, Edge]:
    """What plain BPE makes of some bytes, and how their left and right edge grew. Quadratic; for single tokens only."""
    parts = [data[k : k + 1] for k in range(len(data))]
    left, right = [(parts[0], NEVER)], [(parts[-1], NEVER)]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], NEVER))
        both = parts[best] + parts[best + 1]
        if both not in ranks:
            break
        for edge, touched in ((left, best == 0), (right, best + 2 == len(parts))):
            if touched:
                edge[-1] = edge[-1][0], ranks[both]
                edge.append((both, NEVER))
        parts[best : best + 2] = [both]
    return [ranks[p] for p in parts], left, right


class Transducer:
    """Tokens of a piece of bytes."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # The tree of all tokens: node and byte lead to (node or 0 if nothing is longer, token or -1).
        nodes = {b"": 0}
        for token in ranks:
            for k in range(1, len(token)):
                nodes.setdefault(token[:k], len(nodes))
        spelled = set(nodes) | set(ranks)
        self.tree = {nodes[t[:-1]] << 8 | t[-1]: (nodes.get(t, 0), ranks.get(t, -1)) for t in spelled if t}
        # How tokens come about; one that BPE itself never makes has no edges and can't be part of a result.
        self.grown: dict[int, tuple[Edge, Edge] | None] = {}
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        start: State = -1, (((), 0),)
        self.states: dict[State, int] = {start: 0}
        self.guesses = [start]
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _edges(self, token: int) -> tuple[Edge, Edge] | None:
        if token not in self.grown:
            made, left, right = edges(self.ranks, self.tokens[token])
            self.grown[token] = (left, right) if made == [token] else None
        return self.grown[token]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens as they are when they meet."""
        known = self.pairs.get(left << 32 | right)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            edges = self._edges(right)
            known = edges is not None and (left < 0 or self._apart(self._edges(left)[1], edges[0]))
            self.pairs[left << 32 | right] = known
        return known

    def _apart(self, ending: Edge, beginning: Edge) -> bool:
        """Whether no two parts that ever face each other merge before a merge inside takes one of them away."""
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = ending[i], beginning[j]
            across = self.ranks.get(a + b, NEVER)
            # Of equal ranks the leftmost merge comes first.
            if across < a_ends and across <= b_ends and across < NEVER:
                return False
            if a_ends == b_ends == NEVER:
                return True
            # At equal ranks the one on the left goes first, too.
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        tree, pairs = self.tree, self.pairs
        emitted, guesses = self.guesses[state]
        after: list[Guess] = []
        ended = None
        for pending, node in guesses:
            found = tree.get(node << 8 | byte)
            if found is None:
                continue
            longer, token = found
            if longer:
                after.append((pending, longer))
            # The bytes so far have but one tokenization: once it is found no other guess can end here.
            if token >= 0 and ended is None:
                last = pending[-1] if pending else emitted
                apart = pairs.get(last << 32 | token)
                if apart or (apart is None and self.neighbours(last, token)):
                    ended = (*pending, token), 0
        if ended is not None:
            after.append(ended)
        out = after[0][0]
        if out and len(after) > 1:
            common = 0
            for tokens in zip(*[pending for pending, _ in after], strict=False):
                if tokens.count(tokens[0]) < len(tokens):
                    break
                common += 1
            out = out[:common]
            if common:
                after = [(pending[common:], node) for pending, node in after]
        elif out:
            after = [((), after[0][1])]
        key = out[-1] if out else emitted, tuple(after)
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.guesses)
            self.guesses.append(key)
        self.steps[state << 8 | byte] = step = number, out
        return step

    def encode(self, piece: bytes) -> list[int]:
        if len(self.steps) >= MAX_STEPS:
            self._forget()
        state, out, steps = 0, [], self.steps
        for at, byte in enumerate(piece):
            step = steps.get(state << 8 | byte)
            if step is None:
                if at >= DEEP:
                    return self._alone(state, piece, at, out)
                step = self._step(state, byte)
            state = step[0]
            if step[1]:
                out += step[1]
        # Only one guess has no token under way: it is the result.
        return out + [t for pending, node in self.guesses[state][1] if not node for t in pending]

    def _alone(self, state: int, piece: bytes, at: int, out: list[int]) -> list[int]:
        """The rest of a piece from a state on, without states of its own: hardly any other piece would come by here.

        The same guesses are alive as in the states; their tokens are chains (token, those before it), and are emitted
        whenever a single guess is left.
        """
        tree, pairs = self.tree, self.pairs
        emitted, guesses = self.guesses[state]
        alive: list[tuple[tuple | None, int]] = []
        for pending, node in guesses:
            chain = None
            for token in pending:
                chain = token, chain
            alive.append((chain, node))
        for k in range(at, len(piece)):
            byte, after, ended = piece[k], [], False
            for chain, node in alive:
                found = tree.get(node << 8 | byte)
                if found is None:
                    continue
                longer, token = found
                if longer:
                    after.append((chain, longer))
                if token >= 0 and not ended:
                    last = chain[0] if chain is not None else emitted
                    apart = pairs.get(last << 32 | token)
                    if apart or (apart is None and self.neighbours(last, token)):
                        ended, last_chain = True, (token, chain)
            if ended:
                after.append((last_chain, 0))
            if len(after) == 1 and after[0][0] is not None:
                chain, node = after[0]
                emitted = chain[0]
                out += _unchained(chain)
                after = [(None, node)]
            alive = after
        for chain, node in alive:
            if not node:
                return out + _unchained(chain)
        return out


def _unchained(chain: tuple | None) -> list[int]:
    tokens = []
    while chain is not None:
        token, chain = chain
        tokens.append(token)
    return tokens[::-1]


class Encoder(dict):
    """Pieces and their tokens as little-endian 32-bit numbers; what is not known yet is computed.

    Two generations of pieces are kept: when the young one is full it becomes the old one, so frequent pieces stay.
    Most pieces of a corpus never come again, so one is kept when it comes a second time. What came lately is told by a
    byte of its hash; a wrong guess keeps a piece too early or too late, its tokens are the same.
    """

    def __init__(self, ranks: Ranks, pattern: str):
        super().__init__()
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.old: dict[str, bytes] = {}
        self.lately = bytearray(LATELY)

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed, mark = self._packed(piece), hash(piece)
            place, mark = mark % LATELY, mark // LATELY & 0xFF
            if self.lately[place] != mark:
                self.lately[place] = mark
                return packed
        return self._keep(piece, packed)

    def _packed(self, piece: str) -> bytes:
        data = piece.encode()
        token = self.transducer.ranks.get(data)
        ids = [token] if token is not None else self.transducer.encode(data)
        return array("I", ids).tobytes() if LITTLE else little_endian(ids)

    def _keep(self, piece: str, packed: bytes) -> bytes:
        if len(piece) <= LONG_PIECE:
            if len(self) >= MAX_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if len(text) <= LONG_TEXT:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        return b"".join(self[m[0]] for m in self.pattern.finditer(text))


def _encoder(known, pattern: str) -> Encoder:
    """A worker serves several tasks; what it has learnt about pieces stays with it."""
    return worker_state(f"bpe {pattern}", known.value, lambda: Encoder(known.value, pattern))


def little_endian(ids: Iterable[int]) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)


class Utf8Stream:
    """Text from bytes that come in parts. Between parts it remembers the beginning of one character at most."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        self.held = b""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue  # inside a character; its first byte is further back
            wanted = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            if wanted > back:
                data, self.held = data[:-back], data[-back:]
            break
        return data.decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


def decoded(tokens: list[bytes], packed: bytes, at_once: int = 1 << 16) -> str:
    """The text of packed tokens, in parts of `at_once` tokens."""
    ids = array("I", packed)
    stream, parts = Utf8Stream(), []
    for k in range(0, len(ids), at_once):
        parts.append(stream.feed(b"".join([tokens[i] for i in ids[k : k + at_once]])))
    return "".join([*parts, stream.end()])


def encode(df: DataFrame, ranks: Ranks, pattern: str, text: str = "text", back: str | None = None) -> DataFrame:
    """All columns of `df` without `text`, and `ids` (binary: little-endian 32-bit numbers). One row per row.

    `back` names a column for the text that the ids decode to; one worker then does both.
    """
    known = df.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: its size doesn't depend on the data
    place = df.columns.index(text)
    names = [*[c for c in df.columns if c != text], "ids", *([back] if back else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(known, pattern)
        tokens = sorted(known.value, key=known.value.get)
        for batch in small_batches(batches):
            ids = [encoder.encode(t.as_py() or "") for t in batch.column(place)]
            kept = [batch.column(k) for k in range(batch.num_columns) if k != place]
            made = [pa.array(ids, pa.binary())]
            if back:
                made.append(pa.array([decoded(tokens, i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([*kept, *made], names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text)
    made = "ids binary" + (f", `{back}` string" if back else "")
    return map_batches(df, work, f"{kept}, {made}" if kept else made)


def decode(df: DataFrame, ranks: Ranks, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of `df` and the text of its tokens."""
    known = df.sparkSession.sparkContext.broadcast(ranks)
    place = df.columns.index(ids)
    names = [*df.columns, to]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sorted(known.value, key=known.value.get)
        for batch in batches:
            texts = pa.array([decoded(tokens, t.as_py() or b"") for t in batch.column(place)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(work, f"{kept}, `{to}` string")
