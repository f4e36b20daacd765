"""Operator 12: SentencePiece BPE by vectorised merge rounds, and its inverse.

Blanks become U+2581, one goes in front of a text that isn't empty, and the text is cut wherever no piece of the
vocabulary holds the two characters around the cut: no merge can cross it. The distinct words of a batch that aren't
remembered are then merged together, as one flat numpy array of symbols in which every word is a segment. A round takes
the smallest rank among the pairs of each segment, merges all its pairs of this rank from the left, and closes the
gaps; segments without a pair leave. Merging one pair at a time would give the same as long as no new pair ranks as
high as the one just merged; where one does, only the pairs up to there are merged in this round. A long segment in
which that happens (thousands of blanks, whose pieces all rank the same) is merged one by one from a heap.

Symbols that are no piece become their UTF-8 bytes. Words are remembered up to a fixed number of characters.

Defined results: NULL is an empty text, which has the end id only; U+2581 itself counts as a blank, as in the library;
lone bytes decode to U+FFFD each; equal texts get equal ids; extra columns are kept.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillspan.llm.common import worker_state

BLANK = "▁"
NEVER = np.iinfo(np.int64).max
# Characters of words that a worker remembers, twice at most: a young and an old generation.
REMEMBERED = 4_000_000
# Longer words are never remembered.
LONG_WORD = 64
# Characters merged in one flat array, unless a single word is longer.
AT_ONCE = 1_000_000
# Segments from this length on go to the heap once their pairs can't be merged together.
LONG_SEGMENT = 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id with scores; kinds: n normal, b byte, c control, u unknown."""

    pieces: list[str]
    scores: list[float]
    kinds: str
    end: int
    prefix: bool  # a blank goes in front of every text


def read_model(path: str) -> Vocabulary:
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    normal, kinds = model.normalizer_spec, {1: "n", 2: "u", 3: "c", 6: "b"}
    plain = not normal.precompiled_charsmap and not normal.remove_extra_whitespaces and normal.escape_whitespaces
    if not plain or model.trainer_spec.model_type != 2 or any(p.type not in kinds for p in model.pieces) or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only BPE models without normalisation and without user-defined pieces are supported")
    found = "".join(kinds[p.type] for p in model.pieces)
    if found.count("b") != 256:
        raise ValueError("only models with a piece for every byte are supported")
    end = sentencepiece.SentencePieceProcessor(model_file=path).eos_id()
    return Vocabulary([p.piece for p in model.pieces], [p.score for p in model.pieces], found, end, normal.add_dummy_prefix)


class Merger:
    """Ids of words. Symbols are numbers: ids of pieces, then characters that are only part of pieces, then any other
    character as `others` plus its code point."""

    def __init__(self, vocabulary: Vocabulary):
        self.known = {p: k for k, p in enumerate(vocabulary.pieces) if vocabulary.kinds[k] == "n"}
        spelled = sorted({c for p in self.known for c in p} - set(self.known))
        number = {**self.known, **{c: len(vocabulary.pieces) + k for k, c in enumerate(spelled)}}
        self.first_char = len(vocabulary.pieces)
        self.others = self.first_char + len(spelled)
        self.spelled = spelled
        # Equal scores have equal ranks: of those the leftmost pair comes first.
        ranks = {s: r for r, s in enumerate(sorted({-vocabulary.scores[k] for k in self.known.values()}))}
        pairs = {}
        for piece, k in self.known.items():
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = ranks[-vocabulary.scores[k]] << 32 | k
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.pairs = pairs
        # Symbols of characters, and which characters may follow each other inside a piece.
        codes = {ord(c): number[c] for p in self.known for c in p}
        self.code_points = np.array(sorted(codes), np.int64)
        self.code_symbols = np.array([codes[c] for c in sorted(codes)], np.int64)
        inside = {ord(a) << 32 | ord(b) for p in self.known for a, b in zip(p, p[1:], strict=False)}
        self.inside = np.array(sorted(inside), np.int64)
        byte_ids = {int(p[1:-1], 16): k for k, p in enumerate(vocabulary.pieces) if vocabulary.kinds[k] == "b"}
        self.byte_ids = [byte_ids[k] for k in range(256)]

    @staticmethod
    def _found(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return places, table[places] == keys

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and piece of pairs of symbols, NEVER where they don't merge."""
        places, hit = self._found(left << 32 | right, self.keys)
        return np.where(hit, self.values[places], NEVER)

    def merged(self, words: list[str]) -> list[np.ndarray]:
        """Symbols of every word, merged to the end."""
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        places, hit = self._found(codes, self.code_points)
        symbols = np.where(hit, self.code_symbols[places], self.others + codes)
        # A segment begins with each word, and where no piece holds the two characters around a place.
        begins = np.ones(len(codes), bool)
        begins[1:] = ~self._found(codes[:-1] << 32 | codes[1:], self.inside)[1]
        begins[(ends - lengths)[lengths > 0]] = True
        segment = np.cumsum(begins) - 1
        done, at = self._rounds(symbols, segment)
        bounds = np.searchsorted(at, np.concatenate([[0], ends]))
        return [done[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _rounds(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and the place of the first character of each."""
        at = np.arange(len(symbols))
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        pair = np.full(len(symbols), NEVER)
        inner = segment[:-1] == segment[1:]
        pair[:-1][inner] = self._pair(symbols[:-1][inner], symbols[1:][inner])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(pair >> 32, starts)
            live = best < NEVER >> 32
            if not live.all():
                keep = np.repeat(live, sizes)
                finished.append((symbols[~keep], at[~keep]))
                symbols, segment, at, pair = symbols[keep], segment[keep], at[keep], pair[keep]
                if not len(symbols):
                    break
                sizes, best = sizes[live], best[live]
                starts = np.cumsum(sizes) - sizes
            chosen = pair >> 32 == np.repeat(best, sizes)
            # Of neighbouring chosen pairs every second one overlaps the one before it.
            places = np.flatnonzero(chosen)
            run = np.concatenate([[True], places[1:] != places[:-1] + 1])
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - run_start) % 2 == 0]
            made = pair[places] & 0xFFFFFFFF
            ranks = pair[places] >> 32
            # What stands beside the merged pair: on the left already merged, on the right not yet.
            after = symbols.copy()
            after[places] = made
            gone = np.zeros(len(symbols), bool)
            gone[places + 1] = True
            owner = np.searchsorted(starts, places, "right") - 1
            has_left = places > starts[owner]
            left_at = np.maximum(places - 1, 0)
            left_at = np.where(gone[left_at], left_at - 1, left_at)
            left = np.where(has_left, self._pair(after[left_at], made), NEVER)
            ends = starts[owner] + sizes[owner]
            right_at = np.minimum(places + 2, len(symbols) - 1)
            has_right = places + 2 < ends
            right = np.where(has_right, self._pair(made, symbols[right_at]), NEVER)
            sooner = np.minimum(left, right) >> 32 <= ranks
            if sooner.any():
                # Per segment only the pairs up to the first of these are certain.
                count = np.cumsum(sooner) - sooner
                first = np.searchsorted(owner, owner)
                certain = count == count[first]
                hard = np.unique(owner[sooner])
                hard = hard[sizes[hard] >= LONG_SEGMENT]
                if len(hard):
                    out = np.zeros(len(symbols), bool)
                    for k in hard.tolist():
                        begin, end = int(starts[k]), int(starts[k] + sizes[k])
                        finished.append(self._one_by_one(symbols[begin:end], at[begin:end]))
                        out[begin:end] = True
                    symbols, segment, at, pair = symbols[~out], segment[~out], at[~out], pair[~out]
                    continue  # the others go on in the next round, unchanged
                places, made = places[certain], made[certain]
                gone[:] = False
                gone[places + 1] = True
            symbols[places] = made
            keep = ~gone
            # Only pairs with a merged symbol are new.
            touched = np.zeros(len(symbols) + 1, bool)
            touched[places] = True
            symbols, segment, at, pair, touched = symbols[keep], segment[keep], at[keep], pair[keep], touched[:-1][keep]
            new = touched.copy()
            new[:-1] |= touched[1:]
            pair[new] = NEVER
            new[-1:] = False
            new[:-1] &= segment[1:] == segment[:-1]
            new = np.flatnonzero(new)
            pair[new] = self._pair(symbols[new], symbols[new + 1])
        if not finished:
            return symbols, at
        done, at = (np.concatenate(parts) for parts in zip(*finished, strict=True))
        order = np.argsort(at, kind="stable")
        return done[order], at[order]

    def _one_by_one(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One segment, its best leftmost pair at a time."""
        parts, n = symbols.tolist(), len(symbols)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def push(k: int) -> None:
            if k >= 0 and after[k] >= 0:
                found = self.pairs.get(parts[k] << 32 | parts[after[k]])
                if found is not None:
                    heapq.heappush(queue, (found >> 32, k, found & 0xFFFFFFFF, parts[k] << 32 | parts[after[k]]))

        for k in range(n):
            push(k)
        while queue:
            _, k, made, of = heapq.heappop(queue)
            if parts[k] < 0 or after[k] < 0 or parts[k] << 32 | parts[after[k]] != of:
                continue
            right = after[k]
            parts[k], parts[right], after[k] = made, -1, after[right]
            if after[k] >= 0:
                before[after[k]] = k
            push(before[k])
            push(k)
        kept = [k for k in range(n) if parts[k] >= 0]
        return np.array([parts[k] for k in kept], np.int64), at[kept]

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of final symbols: those that are no piece become bytes."""
        if not len(symbols) or symbols.max() < self.first_char:
            return symbols.astype("<u4")
        out: list[int] = []
        for s in symbols.tolist():
            if s < self.first_char:
                out.append(s)
            else:
                char = chr(s - self.others) if s >= self.others else self.spelled[s - self.first_char]
                out.extend(self.byte_ids[b] for b in char.encode())
        return np.array(out, "<u4")


# A run of blanks and what follows it; no piece holds a blank behind another character.
WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


class Encoder:
    """Texts to ids; remembers the words of earlier texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.merger = Merger(vocabulary)
        crossing = any(b == BLANK != a for p in self.merger.known for a, b in zip(p, p[1:], strict=False))
        self.word = re.compile("(?s).+") if crossing else WORD
        self.prefix = BLANK if vocabulary.prefix else ""
        self.end = np.array([vocabulary.end], "<u4").tobytes()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", BLANK) if text else ""

    def _learn(self, words: Iterable[str], into: dict[str, bytes]) -> None:
        """Ids of words, merged in flat arrays of bounded size."""
        part, size = [], 0
        for word in [*words, None]:
            if part and (word is None or size + len(word) > AT_ONCE):
                merged = self.merger.merged(part)
                into.update((w, self.merger.ids(s).tobytes()) for w, s in zip(part, merged, strict=True))
                part, size = [], 0
            if word is not None:
                part.append(word)
                size += len(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text, the end id last."""
        cut = [self.word.findall(self._normal(t)) for t in texts]
        missing, here = set(), {}
        for words in cut:
            for word in words:
                if word not in self.young and word not in missing:
                    found = self.old.get(word)
                    if found is None:
                        missing.add(word)
                    else:
                        here[word] = found
        self._learn(missing, here)
        out = [b"".join([self.young[w] if w in self.young else here[w] for w in words]) + self.end for words in cut]
        short = {w: i for w, i in here.items() if len(w) <= LONG_WORD}
        size = sum(map(len, short))
        if self.size + size > REMEMBERED:
            self.old, self.young, self.size = self.young, {}, 0
        self.young.update(short)
        self.size += size
        return out


class Decoder:
    """Ids to text."""

    def __init__(self, vocabulary: Vocabulary):
        self.strip = vocabulary.prefix
        self.kinds = vocabulary.kinds
        self.first_blank = [p.startswith(BLANK) for p in vocabulary.pieces]
        shown = {"n": lambda p: p.replace(BLANK, " ").encode(), "b": lambda p: bytes([int(p[1:-1], 16)]), "c": lambda p: b"", "u": lambda p: " ⁇ ".encode()}
        self.bytes = [shown[k](p) for k, p in zip(vocabulary.kinds, vocabulary.pieces, strict=True)]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        lead = next((k for k, i in enumerate(ids) if self.kinds[i] != "c"), len(ids))
        parts = [self.bytes[i] for i in ids]
        if self.strip and lead < len(ids) and self.kinds[ids[lead]] == "n" and self.first_blank[ids[lead]]:
            parts[lead] = parts[lead][1:]
        # Without control pieces in between, bytes that are UTF-8 together are so run by run.
        last = next((k for k in range(len(ids), 0, -1) if self.kinds[ids[k - 1]] != "c"), 0)
        if not any(self.kinds[i] == "c" for i in ids[lead:last]):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._piecewise(ids, parts)

    def _piecewise(self, ids: list[int], parts: list[bytes]) -> str:
        """Runs of byte pieces that are no UTF-8: each byte that begins no character is U+FFFD."""
        out, run = [], b""
        for i, part in zip([*ids, None], [*parts, b""], strict=True):
            if i is not None and self.kinds[i] == "b":
                run += part
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                run = run[size:]
            out.append(part.decode())
        return "".join(out)


def _tools(known) -> tuple[Encoder, Decoder]:
    """A worker serves several tasks; what it has learnt about words stays with it."""
    return worker_state("sentencepiece", known.value, lambda: (Encoder(known.value), Decoder(known.value)))


# Texts of a batch are encoded together up to so many characters.
TOGETHER = 1_000_000


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def encode(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", spelled: str | None = None, back: str | None = None
) -> DataFrame:
    """All columns of `df` without `text`, and `ids` (binary: little-endian 32-bit numbers). One row per row.

    `spelled` names a column for the ids in decimal, joined by one space, and `back` one for the text that the ids
    decode to; one worker then does it all.
    """
    known = df.sparkSession.sparkContext.broadcast(vocabulary)  # its size doesn't depend on the data
    place = df.columns.index(text)
    names = [*[c for c in df.columns if c != text], "ids", *[name for name in (spelled, back) if name]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(known)
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            ids = [i for group in _groups(texts) for i in encoder.encode(group)]
            kept = [batch.column(k) for k in range(batch.num_columns) if k != place]
            made = [pa.array(ids, pa.binary())]
            if spelled:
                made.append(pa.array([" ".join(map(str, np.frombuffer(i, "<u4").tolist())) for i in ids], pa.string()))
            if back:
                made.append(pa.array([decoder.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([*kept, *made], names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text)
    made = "ids binary" + "".join(f", `{name}` string" for name in (spelled, back) if name)
    return df.mapInArrow(work, f"{kept}, {made}" if kept else made)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of `df` and the text of its ids; NULL is no ids."""
    known = df.sparkSession.sparkContext.broadcast(vocabulary)
    place = df.columns.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _tools(known)[1]
        for batch in batches:
            texts = pa.array([decoder.decode(i or b"") for i in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*df_columns, to])

    df_columns = df.columns
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(work, f"{kept}, `{to}` string")
