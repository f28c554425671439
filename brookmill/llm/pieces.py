"""SentencePiece encoding with seeded merge-dropout, and decoding.

A model of merge type is applied by its agenda: of all neighbouring symbols
whose concatenation is a piece the best-scored (then leftmost) pair merges
next. Each candidate is skipped where a keyed hash of seed, unit, occurrence and
place falls below ``dropout``; a skipped candidate does not come back unless a
neighbour changes. With dropout 0 the pieces are those of the library.

No piece reaches over the border before a space that follows another character,
nor over a line break, so texts fall into units there. A slice of texts is
worked on at once: equal units are encoded once without dropout, and an
occurrence that would skip a candidate on the way is encoded by itself. All
units of one length class go in step, one agenda entry each. Units over ``LONG``
characters go through a heap, one by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmill.llm.windows import Content, mix, slices, texts_of

SPACE = "▁"
LONG = 48
NONE = np.int32(2**31 - 1)
#: Characters that are no piece have this plus their code point as symbol.
CHAR = 1 << 21
SLICE = 1 << 19
_PAIR_HASH = 0x9E3779B97F4A7C15
#: Units worked on at once; the arrays of a step stay small.
UNITS = 1 << 14


class Model:
    """Vocabulary of a merge-type model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i] for i in plain) or any(pieces[i].startswith(SPACE * 2) and pieces[i].strip(SPACE) for i in plain):
            raise ValueError("a piece of this model reaches over a space or a line break")
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.symbol = {pieces[i]: i for i in plain}
        by_score = sorted(plain, key=lambda i: (-sp.get_score(i), i))
        place, last = {}, None
        for i in by_score:
            last = last if last is not None and sp.get_score(i) == sp.get_score(last) else i
            place[i] = len(place) if last == i else place[last]
        pairs = {}
        for i in plain:
            for cut in range(1, len(pieces[i])):
                left, right = self._symbol(pieces[i][:cut]), self._symbol(pieces[i][cut:])
                if left is not None and right is not None:
                    pairs[left << 22 | right] = (place[i], i)
        self._hash_pairs(pairs)
        self.char_symbol = (np.arange(0x110000) + CHAR).astype(np.int32)
        for piece, i in self.symbol.items():
            if len(piece) == 1:
                self.char_symbol[ord(piece)] = i
        self.space = self.symbol[SPACE]
        self.char_symbol[0x20] = self.space
        self.char_symbol[ord(SPACE)] = CHAR + ord(SPACE)  # a literal one goes by its bytes, so decoding keeps it apart
        raw = [pieces[i].replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_ids):
            raw[i] = bytes([b])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size

    def _symbol(self, part: str) -> int | None:
        found = self.symbol.get(part)
        return CHAR + ord(part) if found is None and len(part) == 1 else found

    def _hash_pairs(self, pairs: dict[int, tuple[int, int]]) -> None:
        """Open addressing with at least seven free slots to one pair; arrays go one slot further than the mask."""
        bits = max(4, (8 * len(pairs)).bit_length())
        self.pair_shift = np.uint64(64 - bits)
        size = (1 << bits) + len(pairs) + 1
        self.pair_keys = np.full(size, -1, np.int64)
        self.pair_rank = np.full(size, NONE, np.int32)
        self.pair_piece = np.zeros(size, np.int32)
        for key, (rank, piece) in pairs.items():
            slot = (key * _PAIR_HASH % 2**64) >> (64 - bits)
            while self.pair_keys[slot] != -1:
                slot += 1
            self.pair_keys[slot], self.pair_rank[slot], self.pair_piece[slot] = key, rank, piece

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Agenda rank (lower is first, NONE: no piece) and piece of each pair."""
        key = (left.astype(np.int64) << 22) | right
        slot = ((key.astype(np.uint64) * np.uint64(_PAIR_HASH)) >> self.pair_shift).astype(np.int64)
        held = self.pair_keys[slot]
        other = np.nonzero((held != key) & (held != -1))
        while len(other[0]):
            slot[other] += 1
            held = self.pair_keys[slot[other]]
            other = tuple(i[(held != key[other]) & (held != -1)] for i in other)
        return self.pair_rank[slot], self.pair_piece[slot]


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def skipped(unit_key: np.ndarray, start: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidate over characters [start, end) of a unit is skipped."""
    place = start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + end.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mix(unit_key + place) >> np.uint64(11)).astype(np.float64) < dropout * 2.0**53


def encode_long(model: Model, symbols: list[int], unit_key: int, dropout: float) -> list[int]:
    """One unit through a heap of candidates."""
    n = len(symbols)
    symbols, end, before, after = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple] = []
    key = np.array([unit_key], np.uint64)
    rank_of = {}

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else n
        if i < 0 or j >= n:
            return
        pair = (symbols[i], symbols[j])
        if pair not in rank_of:
            rank_of[pair] = tuple(int(x[0]) for x in model.lookup(np.array([pair[0]]), np.array([pair[1]])))
        rank, piece = rank_of[pair]
        if rank != NONE:
            heapq.heappush(agenda, (rank, i, end[j], pair, piece))

    for i in range(n - 1):
        offer(i)
    alive = [True] * n
    while agenda:
        _, i, stop, pair, piece = heapq.heappop(agenda)
        j = after[i]
        if not alive[i] or j >= n or (symbols[i], symbols[j]) != pair or end[j] != stop:
            continue
        if skipped(key, np.array([i]), np.array([stop]), dropout)[0]:
            continue
        symbols[i], end[i], after[i], alive[j] = piece, stop, after[j], False
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [s for s, a in zip(symbols, alive, strict=True) if a]


def encode_level(model: Model, symbols: np.ndarray, sizes: np.ndarray, unit_keys: np.ndarray, dropout: float, visits: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Units of one length class, in step. ``symbols`` is (units, width), filled up with -1; returns symbols and their counts.

    A merge leaves its symbol in the left cell; ``behind`` and ``ahead`` link the
    cells that hold one. ``visits`` gets (unit, start, end) of the candidates in
    turn, as arrays.
    """
    units, width = symbols.shape
    done = symbols.copy()
    rank = np.full((units, width), NONE, np.int32)
    piece = np.zeros((units, width), np.int32)
    rank[:, :-1], piece[:, :-1] = model.lookup(symbols[:, :-1], symbols[:, 1:])
    rank[:, :-1][symbols[:, 1:] < 0] = NONE
    row = np.flatnonzero(rank.min(axis=1) != NONE)
    held = [symbols[row], rank[row], piece[row], np.tile(np.arange(1, width + 1, dtype=np.int32), (len(row), 1)), np.tile(np.arange(-1, width - 1, dtype=np.int32), (len(row), 1))]
    sizes, unit_keys = sizes[row].astype(np.int32), unit_keys[row]
    while len(row):
        symbol, rank, piece, behind, ahead = (h.reshape(-1) for h in held)
        base = np.arange(len(row)) * width
        while True:
            best = held[1].argmin(axis=1)
            here = np.flatnonzero(rank[base + best] != NONE)
            if 4 * len(here) < 3 * len(row):
                break
            begin, at = base[here], best[here].astype(np.int32)
            cell = begin + at
            middle = behind[cell]
            stop = behind[begin + middle]
            if visits is not None:
                visits.append((row[here], at, stop))
            if dropout:
                skip = skipped(unit_keys[here], at, stop, dropout)
                rank[cell[skip]] = NONE
                go = ~skip
                here, begin, at, cell, middle, stop = (a[go] for a in (here, begin, at, cell, middle, stop))
            symbol[cell] = piece[cell]
            symbol[begin + middle] = -1
            rank[begin + middle] = NONE
            behind[cell] = stop
            inner = stop < sizes[here]
            after = (begin + stop)[inner]
            ahead[after] = at[inner]
            rank[cell[~inner]] = NONE
            before = ahead[cell]
            first = before >= 0
            before = (begin + before)[first]
            changed = np.concatenate([cell[inner], before])
            rank[changed], piece[changed] = model.lookup(symbol[changed], symbol[np.concatenate([after, cell[first]])])
        ended = np.ones(len(row), bool)
        ended[here] = False
        done[row[ended]] = held[0][ended]
        row, sizes, unit_keys = row[here], sizes[here], unit_keys[here]
        held = [h[here] for h in held]
    full = done >= 0
    counts = full.sum(axis=1)
    packed = np.full_like(done, -1)
    packed[np.arange(width)[None] < counts[:, None]] = done[full]
    return packed, counts


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of ranges laid end to end."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def encode_units(model: Model, symbols: np.ndarray, starts: np.ndarray, length: np.ndarray, unit_key: np.ndarray, dropout: float, visits: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all units, where each unit's begin, and how many they are. ``visits`` is as in :func:`encode_level`."""
    tokens, counts = [np.zeros(0, np.int32)], np.zeros(len(starts), np.int64)
    order, low = [np.zeros(0, np.int64)], 0
    for width in (1, 2, 4, 6, 8, 12, 16, 24, LONG):
        chosen = np.flatnonzero((length > low) & (length <= width))
        low = width
        for at in range(0, len(chosen), UNITS):
            some = chosen[at : at + UNITS]
            grid = np.full((len(some), width), -1, np.int32)
            inside = np.arange(width)[None] < length[some][:, None]
            grid[inside] = symbols[spread(starts[some], length[some])]
            met = None if visits is None else []
            grid, found = encode_level(model, grid, length[some], unit_key[some], dropout, met)
            if met:
                visits += [(some[row], start, end) for row, start, end in met]
            tokens.append(grid[np.arange(width)[None] < found[:, None]])
            counts[some] = found
            order.append(some)
    for i in np.flatnonzero(length > LONG):
        out = encode_long(model, symbols[starts[i] : starts[i] + length[i]].tolist(), int(unit_key[i]), dropout)
        tokens.append(np.array(out, np.int32))
        counts[i] = len(out)
        order.append(np.array([i]))
    order = np.concatenate(order)
    place = np.empty(len(starts), np.int64)
    place[order] = np.cumsum(counts[order]) - counts[order]
    return np.concatenate(tokens), place, counts


def apart(kinds: int, visits: list, back: np.ndarray, keys: np.ndarray, dropout: float) -> np.ndarray:
    """Whether an occurrence skips a candidate its unit (``back``) meets without dropout."""
    out = np.zeros(len(back), bool)
    if not visits:
        return out
    unit, start, end = (np.concatenate([v[i] for v in visits]) for i in range(3))
    order = np.argsort(unit, kind="stable")
    start, end = start[order], end[order]
    many = np.bincount(unit, minlength=kinds)
    first = np.cumsum(many) - many
    for at in range(0, len(back), 4 * UNITS):
        some = slice(at, at + 4 * UNITS)
        sizes = many[back[some]]
        where = spread(first[back[some]], sizes)
        who = np.repeat(np.arange(len(sizes)), sizes)
        skip = skipped(keys[some][who], start[where], end[where], dropout)
        out[at + who[skip]] = True
    return out


def encode_texts(model: Model, texts: list[str], keys: np.ndarray, dropout: float, seed: int, variants: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and the edges between texts.

    Dropout is drawn by ``keys``, one per text, and place; ``variants`` other
    than 0 bounds how many segmentations a unit has.
    """
    full = [("\n" if not t else " " + t) for t in texts]
    points = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in full], np.int64)
    first = np.cumsum(sizes) - sizes
    symbols = model.char_symbol[points]
    blank, line = symbols == model.space, points == 0x0A
    begin = line.copy()
    begin[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
    begin[first] = True
    starts = np.flatnonzero(begin)
    length = np.diff(np.append(starts, len(points)))
    owner = np.searchsorted(first, starts, "right") - 1
    content = mix(Content(symbols.astype(np.uint64) + np.uint64(1)).ranges(starts, starts + length) + (length.astype(np.uint64) << np.uint64(61)))
    _, one, back = np.unique(content, return_index=True, return_inverse=True)
    if dropout:
        ordinal = np.arange(len(starts)) - np.searchsorted(starts, first)[owner]
        draw = mix(keys.astype(np.uint64)[owner] + ordinal.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        unit_key = mix(content + np.uint64(seed)) + (draw % np.uint64(variants) if variants else draw)
        visits: list = []
        plain = np.where(length[one] > LONG, 0, length[one])  # long ones are encoded apart in any case
        flat, place, counts = encode_units(model, symbols, starts[one], plain, content[one], 0.0, visits)
        alone = np.flatnonzero((length > LONG) | apart(len(one), visits, back, unit_key, dropout))
        _, once, again = np.unique(unit_key[alone], return_index=True, return_inverse=True)
        chosen = alone[once]
        more, further, sizes = encode_units(model, symbols, starts[chosen], length[chosen], unit_key[chosen], dropout)
        back[alone] = len(one) + again
        flat, place, counts = np.concatenate([flat, more]), np.concatenate([place, further + len(flat)]), np.concatenate([counts, sizes])
    else:
        flat, place, counts = encode_units(model, symbols, starts[one], length[one], content[one], 0.0)
    ids = flat[spread(place[back], counts[back])]
    per_text = np.bincount(owner, weights=counts[back], minlength=len(texts)).astype(np.int64)
    ids, per_text = fall_back(model, ids, per_text)
    empty = np.array([not t for t in texts])
    keep = np.repeat(~empty, per_text)
    per_text[empty] = 0
    return ids[keep], np.concatenate([[0], np.cumsum(per_text)])


def fall_back(model: Model, ids: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters that are no piece by the pieces of their UTF-8 bytes."""
    other = np.flatnonzero(ids >= CHAR)
    if not len(other):
        return ids, per_text
    point = (ids[other] - CHAR).astype(np.int64)
    extra = (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
    sizes = np.ones(len(ids), np.int64)
    sizes[other] += extra
    place = np.cumsum(sizes) - sizes
    out = np.empty(sizes.sum(), np.int32)
    out[place] = ids
    lead = np.array([0, 0xC0, 0xE0, 0xF0])
    for i in range(4):
        some = extra >= i
        shift = 6 * (extra[some] - i)
        byte = (point[some] >> shift) & 0x3F | 0x80 if i else np.where(extra == 0, point, lead[extra] | (point >> shift))
        out[place[other[some]] + i] = model.byte_ids[byte]
    owner = np.repeat(np.arange(len(per_text)), per_text)
    return out, np.bincount(owner, weights=sizes, minlength=len(per_text)).astype(np.int64)


def decode_ids(model: Model, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts and the edges between texts."""
    sizes = model.raw_size[ids]
    data = model.raw[spread(model.raw_start[ids], sizes)]
    reach = np.concatenate([[0], np.cumsum(sizes)])[edges]
    full = np.flatnonzero(np.diff(reach) > 0)
    keep = np.ones(len(data), bool)
    keep[reach[full]] = False  # the space put before each text
    reach = reach - np.concatenate([[0], np.cumsum(np.diff(reach) > 0)])
    return data[keep], reach


def piece_ids(df: DataFrame, model: str, text: str = "text", key: str = "doc_id", dropout: float = 0.1, seed: int = 0, variants: int = 0, compare: bool = False) -> DataFrame:
    """Return per row of ``df``: key, ids (array of int), and decoded (binary) or, with ``compare``, lossless (boolean).

    ``model`` is the path of a merge-type SentencePiece model, readable on every
    executor. Dropout is drawn for each occurrence of a unit, by a hash of seed,
    text and place, or with ``variants`` other than 0 from so many segmentations
    of a unit; equal inputs give equal ids on every run. ``decoded`` is made from the ids alone and equals the text's UTF-8
    bytes, literal U+2581 included; ``lossless`` says whether it does. Null text counts as empty and has no ids;
    keys are passed on; repeated rows get equal ids; other columns are not read.
    """

    last = "lossless" if compare else "decoded"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(model)
        for batch in batches:
            for some in slices(batch, 2, SLICE):
                texts = [t.decode("utf-8", "surrogatepass") for t in some.column(2).to_pylist()]
                ids, edges = encode_texts(table, texts, some.column(1).to_numpy().view(np.uint64), dropout, seed, variants)
                data, reach = decode_ids(table, ids, edges)
                decoded = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(reach.astype(np.int32)), pa.py_buffer(data)])
                if compare:
                    decoded = pa.array([data[a:b].tobytes() == t.as_py() for a, b, t in zip(reach[:-1], reach[1:], some.column(2), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)), decoded], ["key", "ids", last])

    rows = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("vary"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode, f"key {kind}, ids array<int>, {last} {'boolean' if compare else 'binary'}").withColumnRenamed("key", key)
