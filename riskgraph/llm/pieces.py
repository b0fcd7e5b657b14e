"""SentencePiece BPE with seeded merge-dropout, and lossless decoding.

Pieces and scores come from a model file; nothing is trained. A text is escaped as the model does (a leading blank,
blanks as their mark) and cut where no piece can reach across: before each run of blanks, and at control characters
outside the vocabulary. In each chunk the agenda is worked off: the adjacent pair whose joined piece has the best
score, the leftmost of equals, is joined, until no pair joins. With dropout, a candidate is skipped if a keyed hash of
(seed, text, number of the chunk in the text, place, piece) falls below the rate, so every occurrence of a chunk has
its own draw. A candidate's piece always spells the characters that it stands on, so a chunk's result depends only on
which of its substrings that are pieces are skipped: occurrences of equal chunks with equal skips share their work
within a batch. The result is a function of seed, rate and text alone, so a task that runs again gives the same pieces.

Chunks of one length are worked off side by side in arrays, one join of every chunk a step; chunks over ``LONG``
characters use a heap. Both give the same pieces. Characters outside the vocabulary, and the blank mark itself where
it stands in a text, become byte pieces, so decoding gives back every text exactly; a model without byte pieces or
with a normalizer other than identity is refused.

NULL and empty texts have no pieces and decode to an empty text. Repeated rows and ids are encoded row by row. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import runs, text_of

RATE, SEED, LONG, BATCH = 0.1, 17, 48, 1 << 20
SHARED = 63  # candidates of a chunk whose skips fit one number; with more, each occurrence is worked off alone
MARK = "▁"
KEYS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * KEYS[1]
        x = (x ^ (x >> np.uint64(27))) * KEYS[2]
        return x ^ (x >> np.uint64(31))


def _drawn(key: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(key + place.astype(np.uint64) * KEYS[0] + piece.astype(np.uint64) * KEYS[3])


class Table:
    """Positions of distinct 64-bit keys by open addressing; a probe is one read for all keys asked."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys, self.at = np.zeros(1 << self.bits, dtype=np.uint64), np.full(1 << self.bits, -1, dtype=np.int32)
        todo, spot = np.arange(len(keys), dtype=np.int32), self._spot(keys)
        while len(todo):
            free = self.at[spot] < 0
            self.at[spot[free]] = todo[free]  # of several, the last one stays
            won = self.at[spot] == todo
            self.keys[spot[won]] = keys[todo[won]]
            todo, spot = todo[~won], (spot[~won] + 1) & (1 << self.bits) - 1

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * KEYS[0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 for one that is not there."""
        shape, keys = keys.shape, keys.ravel()
        spot = self._spot(keys)
        at = self.at[spot]
        other = np.flatnonzero((self.keys[spot] != keys) & (at >= 0))
        while len(other):
            spot[other] = (spot[other] + 1) & (1 << self.bits) - 1
            at[other] = self.at[spot[other]]
            other = other[(self.keys[spot[other]] != keys[other]) & (at[other] >= 0)]
        return at.reshape(shape)


class Pieces:
    """The vocabulary of a model as tables, with encoding and decoding of batches."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece
        tool = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.size = tool.vocab_size()
        names = [tool.id_to_piece(i) for i in range(n)]
        plain = [not (tool.is_control(i) or tool.is_unknown(i) or tool.is_byte(i) or tool.is_unused(i)) for i in range(n)]
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if tool.is_byte(i)}
        if len(self.bytes) < 256 or tool.decode(tool.encode(" ﬁ  ½ ")) != " ﬁ  ½ ":
            raise ValueError("the model cannot give every text back: it has no byte pieces, or it normalizes")
        ids = {names[i]: i for i in range(n) if plain[i]}
        chars = set("".join(ids))
        if any(MARK in p.lstrip(MARK) for p in ids) or not chars <= set(ids):
            raise ValueError("the model has pieces that reach over a blank, or letters that are no pieces")
        self.longest = max(map(len, ids))
        hashes = np.array([self._hash(p) for p in ids], dtype=np.uint64)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces of the model share a hash")
        self.hashes, self.hashed = Table(hashes), np.array(list(ids.values()), dtype=np.int64)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(hashes >> np.uint64(44)).astype(np.int64)] = True
        self.char = {ord(c): ids[c] for c in chars}
        self.table = np.full(1 << 16, -1, dtype=np.int64)
        for c, i in self.char.items():
            if c < 1 << 16:
                self.table[c] = i
        scores = np.array([tool.get_score(i) for i in range(n)])
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int64)
        joins = {ids[p[:k]] * n + ids[p[k:]]: i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        self.pair, self.joined = np.array(list(joins), dtype=np.int64), np.array(list(joins.values()), dtype=np.int64)
        self.pairs, self.made = Table(self.pair.astype(np.uint64)), np.append(self.joined, -1)  # position -1 is the last
        raw = [bytes([int(names[i][3:5], 16)]) if tool.is_byte(i) else names[i].replace(MARK, " ").encode() if plain[i] else b"" for i in range(n)]
        self.raw = pa.array(raw, pa.large_binary())
        alone = "".join(c for c in "\n\r\t" if c not in chars)
        self.chunk = re.compile(f" *[^ {alone}]+| +" + (f"|[{alone}]" if alone else ""))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(KEYS[0]) + ord(c)) & (1 << 64) - 1
        return (h ^ h >> 31) * int(KEYS[1]) & (1 << 64) - 1

    # -- symbols ---------------------------------------------------------------------------------------------
    def _symbols(self, chars: np.ndarray) -> np.ndarray:
        """Piece of each character; ``size`` + code point for one outside the vocabulary, or for a mark in the text."""
        code = np.where(chars == 32, ord(MARK), chars).astype(np.int64)
        out = self.table[np.minimum(code, (1 << 16) - 1)]
        high = code >= 1 << 16
        if high.any():
            out[high] = [self.char.get(c, -1) for c in code[high].tolist()]
        return np.where((out < 0) | (chars == ord(MARK)), self.size + chars.astype(np.int64), out)

    def _candidates(self, left: np.ndarray, right: np.ndarray, key: np.ndarray, place: np.ndarray, limit: np.uint64) -> np.ndarray:
        """The joined piece of each pair, -1 for none or for one that is skipped. ``key`` holds seed, text and number."""
        joined = self.made[self.pairs.find((left.astype(np.int64) * self.size + right).astype(np.uint64))]
        strange = (left >= self.size) | (right >= self.size)
        if strange.any():
            joined[strange] = -1
        if limit:
            joined[_drawn(key, place, joined) < limit] = -1
        return joined

    def _side_by_side(self, symbols: np.ndarray, key: np.ndarray, limit: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Agendas of chunks of one length: (rows, their final symbols) as they end. Each step joins one pair a row."""
        rows, symbols = np.arange(len(symbols)), symbols.astype(np.int32)
        place = np.tile(np.arange(symbols.shape[1], dtype=np.int32), (len(symbols), 1))
        agenda = self._ranked(symbols[:, :-1], symbols[:, 1:], key[:, None], place[:, :-1], limit)
        while len(rows):
            width = symbols.shape[1] - 1
            if not width:
                yield rows, symbols
                return
            every = np.arange(len(rows))
            best = (agenda >> 32).argmax(axis=1)  # the leftmost of equal ranks
            piece = agenda[every, best]
            if piece.min() < 0:
                going = piece >= 0
                yield rows[~going], symbols[~going]
                rows, symbols, place, agenda, key, best, piece = (x[going] for x in (rows, symbols, place, agenda, key, best, piece))
                every = np.arange(len(rows))
            symbols[every, best] = piece & 0xFFFFFFFF
            over = np.arange(width) + (np.arange(width) > best[:, None])  # the symbol after the pair's first one goes
            spots = over + (every * (width + 1))[:, None]
            symbols, place = symbols.ravel()[spots], place.ravel()[spots]
            agenda = agenda.ravel()[(over + (every * width)[:, None])[:, : width - 1]]
            for side in (best - 1, best):  # the pairs that the new symbol is part of
                fits = np.flatnonzero((side >= 0) & (side < width - 1))
                s = side[fits]
                agenda[fits, s] = self._ranked(symbols[fits, s], symbols[fits, s + 1], key[fits], place[fits, s], limit)

    def _ranked(self, left: np.ndarray, right: np.ndarray, key: np.ndarray, place: np.ndarray, limit: np.uint64) -> np.ndarray:
        """Rank and joined piece of each candidate in one number, -1 for none."""
        joined = self._candidates(left, right, key, place, limit)
        return np.where(joined >= 0, self.rank[joined] << 32 | joined, -1)

    def _by_heap(self, symbols: list[int], key: int, limit: np.uint64) -> list[int]:
        """The agenda of one chunk of any length."""
        n = len(symbols)
        alive, before, after = [True] * n, list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] >= 0]
            if lefts:
                a, b = (np.array([symbols[j] for j in js], dtype=np.int64) for js in (lefts, [after[i] for i in lefts]))
                found = self._candidates(a, b, np.full(len(lefts), key, np.uint64), np.array(lefts), limit)
                for i, piece in zip(lefts, found.tolist(), strict=True):
                    if piece >= 0:
                        heapq.heappush(agenda, (-int(self.rank[piece]), i, symbols[i], symbols[after[i]], piece))

        offer(list(range(n)))
        while agenda:
            _, i, a, b, piece = heapq.heappop(agenda)
            j = after[i]
            if not alive[i] or j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j] = piece, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer([before[i], i])
        return [s for s, here in zip(symbols, alive, strict=True) if here]

    # -- batches ---------------------------------------------------------------------------------------------
    def _ragged(self, chunks: list[str], key: np.ndarray, limit: np.uint64) -> pa.LargeListArray:
        """The pieces of each chunk."""
        sizes = np.array([len(c) for c in chunks], dtype=np.int64)
        symbols = self._symbols(np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
        starts = np.cumsum(sizes) - sizes
        count = np.zeros(len(chunks), dtype=np.int64)
        owner, values = [], []
        for n in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == n)
            if n <= LONG:
                for ended, final in self._side_by_side(symbols[starts[rows][:, None] + np.arange(n)], key[rows], limit):
                    count[rows[ended]] = final.shape[1]
                    owner.append(np.repeat(rows[ended], final.shape[1]))
                    values.append(final.ravel())
            else:
                for r in rows.tolist():
                    final = self._by_heap(symbols[starts[r] : starts[r] + n].tolist(), int(key[r]), limit)
                    count[r] = len(final)
                    owner.append(np.full(len(final), r))
                    values.append(np.array(final, dtype=np.int64))
        owner, values = np.concatenate([*owner, np.zeros(0, np.int64)]), np.concatenate([*values, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        owner, values = owner[order], values[order]
        strange = np.flatnonzero(values >= self.size)
        if len(strange):  # each becomes the pieces of its bytes
            spelt = [[self.bytes[b] for b in chr(v - self.size).encode("utf-8", "surrogatepass")] for v in values[strange].tolist()]
            many = np.ones(len(values), dtype=np.int64)
            many[strange] = [len(s) for s in spelt]
            first = np.cumsum(many) - many
            longer = np.repeat(values, many)
            for at, s in zip(first[strange].tolist(), spelt, strict=True):
                longer[at : at + len(s)] = s
            np.add.at(count, owner[strange], many[strange] - 1)
            values = longer
        return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(count)]), pa.array(values.astype(np.int32)))

    def _candidates_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, place, piece) of the substrings that are pieces, of chunks up to ``LONG``; one of an equal hash is harmless."""
        short = [c if len(c) <= LONG else "" for c in chunks]
        sizes = np.array([len(c) for c in short], dtype=np.int64)
        chars = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        chars[chars == 32] = ord(MARK)
        ends = np.repeat(np.cumsum(sizes), sizes)
        hashes, at, found = chars, np.arange(len(chars)), []
        for n in range(2, self.longest + 1):
            going = at + n <= ends[at]
            at, hashes = at[going], hashes[going]
            with np.errstate(over="ignore"):
                hashes = hashes * KEYS[0] + chars[at + n - 1]
                mixed = (hashes ^ (hashes >> np.uint64(31))) * KEYS[1]
            maybe = np.flatnonzero(self.filter[(mixed >> np.uint64(44)).astype(np.int64)])
            spot = self.hashes.find(mixed[maybe])
            same = spot >= 0
            found.append((at[maybe[same]], self.hashed[spot[same]]))
        at, piece = (np.concatenate([x[i] for x in found] + [np.zeros(0, np.int64)]) for i in (0, 1))
        chunk = np.repeat(np.arange(len(chunks)), sizes)[at]
        order = np.argsort(chunk, kind="stable")
        return chunk[order], (at - (np.cumsum(sizes) - sizes)[chunk])[order], piece[order]

    def _shared(self, chunks: list[str], code: np.ndarray, key: np.ndarray, limit: np.uint64) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Occurrences (``code``: their chunks) by equal chunk and skips: (chunk, an occurrence) of each class; each one's class."""
        owner, place, piece = self._candidates_of(chunks)
        count = np.bincount(owner, minlength=len(chunks))
        count[[i for i, c in enumerate(chunks) if len(c) > LONG]] = SHARED + 1
        alone = count > SHARED
        starts = np.cumsum(np.bincount(owner, minlength=len(chunks))) - np.bincount(owner, minlength=len(chunks))
        held = np.where(alone, 0, count)
        skips = np.zeros(len(code), dtype=np.int64)
        for k in range(int(held.max(initial=0))):  # the k-th candidate of every occurrence that has one
            rows = np.flatnonzero(held[code] > k)
            at = starts[code[rows]] + k
            skips[rows] |= (_drawn(key[rows], place[at], piece[at]) < limit).astype(np.int64) << k
        lonely = alone[code]
        skips[lonely] = np.flatnonzero(lonely)  # a number of its own
        order = np.lexsort((skips, code))
        new = np.concatenate([[True], (np.diff(code[order]) != 0) | (np.diff(skips[order]) != 0)])[: len(order)]
        label = np.empty(len(code), dtype=np.int64)
        label[order] = np.cumsum(new) - 1
        first = order[new]
        return (code[first], first), label

    def encode(self, texts: list[str], rate: float = 0.0, seed: int = SEED) -> pa.LargeListArray:
        """Piece ids of each text."""
        parts = [pa.array(self.chunk.findall(f" {t}") if t else [], pa.large_string()) for t in texts]  # compact: no strings of Python stay
        per_text = np.array([len(p) for p in parts], dtype=np.int64)
        coded = pa.chunked_array(parts, pa.large_string()).combine_chunks().dictionary_encode()
        del parts
        chunks, code = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        limit = np.uint64(min(int(rate * 2.0**64), 2**64 - 1))
        key = np.zeros(len(chunks), dtype=np.uint64)
        if limit:
            lead = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), seed) for t in texts], dtype=np.uint64)
            nth = np.arange(len(code)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
            with np.errstate(over="ignore"):
                key = _mixed(np.repeat(lead, per_text) + nth.astype(np.uint64) * KEYS[0])
            first, code = self._shared(chunks, code, key, limit)
            chunks, key = [chunks[i] for i in first[0].tolist()], key[first[1]]
        pieces = self._ragged(chunks, key, limit)
        size = np.diff(pieces.offsets.to_numpy())
        ends = np.concatenate([[0], np.cumsum(size[code])])
        return pa.LargeListArray.from_arrays(ends[np.concatenate([[0], np.cumsum(per_text)])], pieces.take(pa.array(code)).flatten())

    def decode(self, pieces: pa.LargeListArray) -> list[str]:
        """The text of each list of piece ids."""
        spelt = pa.LargeListArray.from_arrays(pieces.offsets, self.raw.take(pieces.values))
        return [b[1:].decode("utf-8", "surrogatepass") if b else "" for b in pc.binary_join(spelt, pa.scalar(b"", pa.large_binary())).to_pylist()]


def load(path: str) -> Pieces:
    """The model of one file, which is small; it is read where the driver runs and sent to the tasks."""
    with open(path, "rb") as file:
        return Pieces(file.read())


def encode(docs: DataFrame, model: Pieces, rate: float = RATE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, pieces (ids), n_pieces, lossless (whether decoding gave the text back) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, limit=BATCH):
            texts = batch.column("text").to_pylist()
            pieces = shared.value.encode(texts, rate, seed)
            same = [a == b for a, b in zip(texts, shared.value.decode(pieces), strict=True)]
            count = pa.array(np.diff(pieces.offsets.to_numpy()).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pieces.cast(pa.list_(pa.int32())), count, pa.array(same)], ["doc_id", "pieces", "n_pieces", "lossless"])

    return rows.mapInArrow(each, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, pieces array<int>, n_pieces int, lossless boolean")
