"""SentencePiece encoding by sampling: forward filtering and backward sampling over the piece lattice.

A text is cut into units that no piece crosses: a run of blanks with what follows up to the next blank, and
line ends. The lattice of a unit has a node for each place between characters and an edge for each piece
that spells what lies between two; a character that no piece spells has an edge of its bytes. The forward pass sums the weights
of all ways to each node; the backward pass starts at the end and draws the last piece in proportion to what it carries, until
the unit's start. So a segmentation is drawn with probability proportional to the product of its weights.

The forward pass is made once for each distinct unit: for units of a length that many share side by side, for others
one after the other, at a cost that grows with their characters, so that text without blanks, which is one long unit, costs no
more than other text. Nodes and edges lie in flat tables that grow in place, and the
backward draws of all units of a batch go step by step together. A draw is a hash of the row's seed, the
unit's place and the step, compared as integers: the same row gets the same pieces on any machine, in any
batch. Decoding concatenates what pieces spell, which gives back every text.

The model file keeps ranks, not probabilities. A piece of rank r weighs 1 / (r + RANK_SHIFT), as word
frequencies fall with their rank, to the power of ``sharpness``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType

from surveymill.llm.common import slices

SHARPNESS = 1.0
RANK_SHIFT = 10
#: Edges kept by a worker (12 bytes each, and as much for their units); the tables start anew beyond it.
KEPT_EDGES = 10_000_000
SIDE_BY_SIDE = 50  # units of one length from which on a forward pass takes them together
FEW = 16  # units under which draws go on unit by unit
_BLANK = "▁"  # how the model writes a blank; one in a text is spelled by bytes
_UNIT = re.compile(r" *[^ \n]+| +|\n")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mixed(x: int) -> int:
    """The same of one number, modulo 2^64."""
    x &= 2**64 - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & (2**64 - 1)
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & (2**64 - 1)
    return x ^ (x >> 31)


class _Slots:
    """Hashes by slot: row k holds, for every slot, the number of the k-th hash that falls there, or -1."""

    def __init__(self, hashes: np.ndarray) -> None:
        bits = max(4, int(4 * len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.hashes = hashes
        slot = (mixed(hashes) >> self.shift).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        rank = np.arange(len(order)) - np.searchsorted(slot[order], slot[order])
        self.rows = np.full((int(rank.max(initial=0)) + 1, 1 << bits), -1, np.int32)
        self.rows[rank, slot[order]] = order


class _Column:
    """Numbers that are appended to; room is doubled, so each is copied a few times at most."""

    def __init__(self, dtype: type, start: int = 0) -> None:
        self._room, self.size = np.zeros(1024, dtype), start

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self._room):
            room = np.zeros(max(end, 2 * len(self._room)), self._room.dtype)
            room[: self.size] = self._room[: self.size]
            self._room = room
        self._room[self.size : end] = values
        self.size = end

    @property
    def all(self) -> np.ndarray:
        return self._room[: self.size]


class Sampler:
    """Lattices over the pieces of a model file."""

    def __init__(self, path: str, sharpness: float = SHARPNESS) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.spelled = [b""] * size  # control pieces spell nothing
        self._bytes = np.zeros(256, np.int64)
        self.pieces: dict[str, tuple[int, float]] = {}  # spelling -> number, weight
        for number in range(size):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                self.spelled[number] = bytes([int(piece[3:5], 16)])
                self._bytes[self.spelled[number][0]] = number
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                text = piece.replace(_BLANK, " ")
                self.spelled[number] = text.encode()
                self.pieces[text] = (number, (max(0.0, -model.get_score(number)) + RANK_SHIFT) ** -sharpness)
        self.longest = max(map(len, self.pieces))
        self._byte_weight = (size + RANK_SHIFT) ** -sharpness
        # by length: a hash table of the pieces, and their numbers, weights and characters
        self._tables = []
        for n in range(1, self.longest + 1):
            own = [(text, *found) for text, found in self.pieces.items() if len(text) == n]
            codes = np.array([[ord(c) for c in text] for text, *_ in own], np.uint64).reshape(-1, n)
            hashes = np.zeros(len(own), np.uint64)
            for i in range(n):
                hashes = hashes * _BASE + codes[:, i]
            numbers, weights = (np.array([x[i] for x in own], t) for i, t in ((1, np.int64), (2, np.float64)))
            self._tables.append((_Slots(hashes), numbers, weights, codes))
        self._reset()

    def _reset(self) -> None:
        """Tables: of a unit its last node; of a node its first edge; of an edge the share of the node's weight
        up to it (of 2^32), the node it comes from (0: the unit's start) and its piece (negative: a
        character in bytes)."""
        self._unit: dict[str, int] = {}
        self._first = _Column(np.int32, 1)  # node 0 is no unit's
        self._share, self._from, self._piece = _Column(np.uint32), _Column(np.int32), _Column(np.int32)

    def _pieces_in(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length, ``(piece, weight)`` of what starts at each place of units of one length (weight 0: none)."""
        n = codes.shape[1]
        found, hashes = [], np.zeros(codes.shape, np.uint64)
        for length, (slots, numbers, weights, spelled) in enumerate(self._tables[:n], 1):
            places = n - length + 1
            hashes = hashes[:, :places] * _BASE + codes[:, length - 1 :]
            piece, weight = np.zeros((len(codes), places), np.int64), np.zeros((len(codes), places))
            slot = mixed(hashes.ravel()) >> slots.shift
            for entries in slots.rows:  # a row of the table holds each slot's first, second ... piece
                entry = entries[slot]
                full = np.flatnonzero(entry >= 0)
                entry = entry[full]
                full, entry = (x[slots.hashes[entry] == hashes.ravel()[full]] for x in (full, entry))
                rows, starts = np.divmod(full, places)
                same = np.ones(len(entry), bool)
                for i in range(length):
                    same &= codes[rows, starts + i] == spelled[entry, i]
                rows, starts, entry = rows[same], starts[same], entry[same]
                piece[rows, starts], weight[rows, starts] = numbers[entry], weights[entry]
            if length == 1:
                spell = weight == 0
                wide = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
                piece[spell], weight[spell] = -1 - codes[spell].astype(np.int64), self._byte_weight ** wide[spell]
            found.append((piece, weight))
        return found

    def _add(self, units: list[str]) -> None:
        """Forward passes over new units."""
        by_length: dict[int, list[str]] = {}
        for unit in units:
            by_length.setdefault(len(unit), []).append(unit)
        rest: list[str] = []
        for alike in by_length.values():
            if len(alike) >= SIDE_BY_SIDE:
                self._add_alike(alike)
            else:
                rest += alike
        if rest:
            self._add_in_turn(rest)

    def _append(self, node: np.ndarray, nodes: int, share: np.ndarray, start: np.ndarray, piece: np.ndarray) -> None:
        """Edges in order of their node; ``node`` counts from the first of ``nodes`` new ones."""
        of_node = np.bincount(node, minlength=nodes)
        self._first.add(self._share.size + np.cumsum(of_node) - of_node)
        self._share.add(share)
        self._from.add(start)
        self._piece.add(piece)

    def _add_in_turn(self, units: list[str]) -> None:
        """Units one after the other: the pieces in all of them are found together, the sums go from place to place."""
        codes = np.frombuffer("\0".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        lengths = np.array([len(unit) for unit in units])
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        outside = np.zeros(len(codes) + 1, bool)  # no piece may reach over what stands between units
        outside[begins[1:] - 1] = True
        crossed = np.cumsum(outside)
        columns = []
        for k, (piece, weight) in enumerate(self._pieces_in(codes[None, :]), 1):
            starts = np.flatnonzero(weight[0])
            starts = starts[(crossed[starts + k - 1] == crossed[starts]) & ~outside[starts]]
            columns.append((starts + k, np.full(len(starts), k), piece[0][starts], weight[0][starts]))
        end, k, piece, weight = (np.concatenate(c) for c in zip(*columns, strict=True))
        order = np.lexsort((k, end))
        end, k, piece, weight = end[order], k[order], piece[order], weight[order]
        total = [0.0] * (len(codes) + 1)
        for begin in begins.tolist():
            total[begin] = 1.0
        shares = np.zeros(len(end), np.uint32)
        bounds = np.flatnonzero(np.append(True, end[1:] != end[:-1])).tolist()
        ks, weights, longest = k.tolist(), weight.tolist(), self.longest
        for at, stop in zip(bounds, [*bounds[1:], len(end)], strict=True):
            place = int(end[at])
            if stop == at + 1:
                total[place] = summed = total[place - ks[at]] * weights[at]
            else:
                parts, summed = [], 0.0
                for i in range(at, stop):
                    summed += total[place - ks[i]] * weights[i]
                    parts.append(summed)
                total[place] = summed
                shares[at : stop - 1] = [min(int(part / summed * 4294967296.0), 4294967295) for part in parts[:-1]]
            shares[stop - 1] = 4294967295
            if summed < 1e-100:  # only the places a piece's length back are read again, and only their ratios count
                for i in range(max(0, place - longest), place + 1):
                    total[i] = min(total[i] * 1e100, 1e300)
        unit = np.searchsorted(begins, end - 1, side="right") - 1
        base = self._first.size - 1 + np.cumsum(lengths) - lengths  # node of the unit's start, which is none of its own
        node = np.cumsum(lengths)[unit] - lengths[unit] + (end - begins[unit]) - 1
        start = end - k - begins[unit]
        self._append(node, int(lengths.sum()), shares, np.where(start > 0, base[unit] + start, 0), piece)
        self._unit.update(zip(units, (base + lengths).tolist(), strict=True))

    def _add_alike(self, alike: list[str]) -> None:
        """Units of one length side by side."""
        n, nodes = len(alike[0]), self._first.size - 1
        codes = np.frombuffer("".join(alike).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n).astype(np.uint64)
        found = self._pieces_in(codes)
        reach = len(found)
        base = nodes + n * np.arange(len(alike))
        total = np.zeros((len(alike), n + 1))
        total[:, 0] = 1
        edges = []
        for j in range(1, n + 1):
            lengths = range(1, min(reach, j) + 1)
            shares = np.stack([total[:, j - k] * found[k - 1][1][:, j - k] for k in lengths], axis=1)
            summed = np.cumsum(shares, axis=1)
            total[:, j] = summed[:, -1]
            rows, k = np.nonzero(shares)
            share = np.minimum(summed[rows, k] / summed[rows, -1] * 2.0**32, 2.0**32 - 1).astype(np.uint32)
            share[np.append(rows[1:] != rows[:-1], True)] = 2**32 - 1
            pieces = np.stack([found[k - 1][0][:, j - k] for k in lengths], axis=1)[rows, k]
            start = j - 1 - k
            edges.append((base[rows] + j, share, np.where(start > 0, base[rows] + start, 0), pieces))
            small = total[:, j] < 1e-100
            if small.any():  # only the places a piece's length back are read again, and only their ratios count
                window = slice(max(0, j - self.longest), j + 1)
                total[small, window] = np.minimum(total[small, window] * 1e100, 1e300)
        node, *columns = (np.concatenate(x) for x in zip(*edges, strict=True))
        order = np.argsort(node, kind="stable")
        self._append(node[order] - nodes - 1, n * len(alike), *[c[order] for c in columns])
        self._unit.update(zip(alike, (base + n).tolist(), strict=True))

    def sample(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """Sampled piece ids of each text; ``seeds`` are unsigned 64-bit numbers, one for each text."""
        if self._share.size > KEPT_EDGES:
            self._reset()
        units = [_UNIT.findall(f" {text}") for text in texts]
        new = set().union(*units) - self._unit.keys()
        if new:
            self._add(list(new))
        counts = np.array([len(row) for row in units], np.int64)
        node = np.fromiter((self._unit[unit] for row in units for unit in row), np.int64, int(counts.sum()))
        row = np.repeat(np.arange(len(units)), counts)
        place = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
        state = mixed(seeds[row] + _STEP * (place.astype(np.uint64) + np.uint64(1)))
        at = np.arange(len(node))
        firsts, shares, froms = self._first.all, self._share.all, self._from.all
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at) >= FEW:
            u = mixed(state[at] + _STEP * np.full(1, len(drawn) + 1, np.uint64)) >> np.uint64(32)
            u = np.minimum(u, np.uint64(2**32 - 2)).astype(np.uint32)
            edge = firsts[node[at]]
            beyond = np.flatnonzero(shares[edge] <= u)
            while len(beyond):  # on to the edge whose share is the first above the draw
                edge[beyond] += 1
                beyond = beyond[shares[edge[beyond]] <= u[beyond]]
            drawn.append((at, edge))
            node[at] = froms[edge]
            at = at[node[at] > 0]
        length = np.zeros(len(node), np.int64)
        for unit, _ in drawn:
            length[unit] += 1
        alone = []  # the few longest go on one by one
        for unit in at.tolist():
            edges, place_at, begun, step = [], int(node[unit]), int(state[unit]), len(drawn)
            while place_at:
                step += 1
                draw = min(_mixed(begun + step * int(_STEP)) >> 32, 2**32 - 2)
                number = int(firsts[place_at])
                while shares[number] <= draw:
                    number += 1
                edges.append(number)
                place_at = int(froms[number])
            length[unit] += len(edges)
            alone.append((unit, edges))
        end = np.cumsum(length)
        ids = np.zeros(int(length.sum()), np.int64)
        for back, (unit, edge) in enumerate(drawn, 1):
            ids[end[unit] - back] = self._piece.all[edge]
        for unit, edges in alone:
            stop = int(end[unit]) - len(drawn)
            ids[stop - len(edges) : stop] = self._piece.all[edges[::-1]]
        bounds = np.append(0, end)[np.append(0, np.cumsum(counts))]
        if (ids < 0).any():
            ids, bounds = self._in_bytes(ids, bounds)
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _in_bytes(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids with characters that no piece spells replaced by the pieces of their bytes."""
        places = np.flatnonzero(ids < 0)
        code = -1 - ids[places]
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        wide = np.ones(len(ids), np.int64)
        wide[places] = width
        first = np.cumsum(wide) - wide
        flat = np.repeat(ids, wide)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])  # of UTF-8, by the number of bytes
        for k in range(int(width.max(initial=0))):
            some = width > k
            bits = code[some] >> (6 * (width[some] - 1 - k))
            byte = lead[width[some]] | bits if not k else 0x80 | (bits & 0x3F)
            flat[first[places[some]] + k] = self._bytes[byte]
        return flat, np.append(first, len(flat))[bounds]

    def decode(self, ids: np.ndarray) -> str:
        """The text that piece ids spell; the blank before the first word is not the text's."""
        return b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")[1:]


@cache
def sampler(path: str, sharpness: float) -> Sampler:
    """The worker's sampler for a model file."""
    return Sampler(path, sharpness)


def public_model(name: str = "piece_bpe_32k.model") -> str:
    """Place of a public model file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def sample_pieces(
    docs: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    model: str | None = None,
    sharpness: float = SHARPNESS,
    seed: int = 0,
) -> DataFrame:
    """``(key, ids, decoded)`` of every row: a sampled segmentation of the whole text, and the text it spells.

    The draw is a function of ``seed``, the row's key and the text alone. Work and memory grow with the characters of a text, whatever
    its words; a unit of 60 000 characters takes less than two seconds. Defined cases: a null text counts
    as empty (one piece at least, the blank before the first word); rows with the same key and text get the
    same pieces; rows without key share one; blanks, line ends, and characters that no piece spells
    come back as they were; an empty table has no rows; other columns are not read.
    """
    model = model or public_model()

    def work(texts: list[str], seeds: np.ndarray) -> tuple[list, list]:
        own = sampler(model, sharpness)
        ids = own.sample(texts, seeds)
        return ids, [own.decode(x) for x in ids]

    rows = docs.select(
        F.col(key_col).alias("key"), F.xxhash64(F.lit(seed), F.col(key_col)).alias("seed"), F.col(text_col).cast("string").alias("text")
    )
    schema = rows.select("key").schema.add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, 2):
                ids, decoded = work(texts, part.column(1).to_numpy().view(np.uint64))
                flat = np.concatenate(ids).astype(np.int32)
                ends = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(types.field(1).type)
                yield pa.RecordBatch.from_arrays([part.column(0), column, pa.array(decoded)], schema=types)

    return rows.mapInArrow(run, schema)
