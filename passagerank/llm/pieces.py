"""SentencePiece-style BPE encoding with seeded merge-dropout, and decoding.

Pieces never run across the start of a word, so a text is cut into units of spaces and what
follows them.  Candidate merges of a unit are taken from an agenda, best score first, the
leftmost on ties; a keyed hash of the seed, the unit, the document, the copy of it, the place in it and the
candidate's three boundaries skips some of them for good.  Short units advance together as flat arrays, one merge of each a
round; long ones use a heap.  Both give the same pieces.  Occurrences of a unit that skip none of
the merges made without dropout share their result; every other one is segmented by itself.

Edge cases: null and empty texts have no pieces and decode to the empty text; characters outside the
vocabulary, and the sign that stands for a space, become byte pieces, so every text decodes to
itself; repeated rows are encoded alike unless a column numbers them; an empty table gives no rows; texts are never cut:
a long one is segmented window by window, between units, with the same pieces.  Extra columns stay; one that has the name of
a column to be added is an error.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagerank.llm.shared import text_of
from passagerank.llm.token_counts import NONE, PairTable

#: Chance of a candidate to be skipped.
DROPOUT = 0.1
#: Units up to this length advance as arrays; characters of texts (or ids) a task segments at a time.  A longer text is
#: read in windows that end between units.
SHORT, CHUNK_CHARS = 48, 250_000
SPACE = chr(0x2581)
#: A unit that no text gives: the sign for a space, standing for itself.
LITERAL = "\0" + SPACE
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Where a unit of spaces and what follows them begins.
BOUNDARY = re.compile("(?<! ) ")
M1, M2, M3, M4 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def load_model(path: str) -> dict:
    """Pieces, scores and the byte pieces of a model file, as plain tables."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    return {
        "pieces": [model.id_to_piece(i) for i in range(n)],
        "scores": [model.get_score(i) for i in range(n)],
        "plain": plain,
        "first_byte": model.piece_to_id("<0x00>"),
    }


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit keys evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * M2
        x = (x ^ (x >> np.uint64(27))) * M3
        return x ^ (x >> np.uint64(31))


def take_runs(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` in ``order``, one behind the other."""
    taken = lengths[order]
    return flat[np.repeat(begins[order] - (np.cumsum(taken) - taken), taken) + np.arange(int(taken.sum()))]


class Encoder:
    def __init__(self, model: dict, seed: int, dropout: float = DROPOUT, variants: int | None = None):
        """``variants`` limits the segmentations of a unit to so many; by default every occurrence has its own."""
        self.pieces, self.byte = model["pieces"], model["first_byte"]
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, model["plain"], strict=True)) if ok}
        self.of_point = np.full(0x110000, -1, np.int64)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_point[ord(p)] = i
        order = {s: r for r, s in enumerate(sorted({model["scores"][i] for i in self.ids.values()}, reverse=True))}
        self.rank_of = np.full(len(self.pieces) + 1, NONE, np.int32)
        for i in self.ids.values():
            self.rank_of[i] = order[model["scores"][i]]
        pairs = [
            (self.ids[p[:k]], self.ids[p[k:]], i)
            for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids
        ]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self.table = PairTable(table[:, 0], table[:, 1], table[:, 2], bits=20)
        self.seed, self.variants = np.uint64(seed % 2**64), variants
        self.limit = np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))

    # keys and symbols

    def described(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths, hashes of the characters and a piece for every character of the units.

        A character outside the vocabulary has the piece -1.
        """
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        first = np.cumsum(lengths) - lengths
        with np.errstate(over="ignore"):
            at = (np.arange(len(points)) - np.repeat(first, lengths)).astype(np.uint64)
            spread = _mix(points.astype(np.uint64) * M1 + at * M4)
            return lengths, np.add.reduceat(spread, first), self.of_point[points]

    def keyed(self, hashes: np.ndarray, variants) -> np.ndarray:
        """Keys of units by seed, variant and characters."""
        with np.errstate(over="ignore"):
            return _mix(hashes + (self.seed * M3 + np.asarray(variants, np.uint64) * M2))

    def skipped(self, keys, start, middle, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys + start.astype(np.uint64) * M1 + middle.astype(np.uint64) * M4 + end.astype(np.uint64) * M2
        return _mix(mixed) < self.limit

    def spelled(self, unit: str, bounds: list[int], ids: list[int]) -> list[int]:
        """Ids of the pieces between ``bounds``; what is no piece is spelled in bytes."""
        out = []
        for start, end, i in zip(bounds[:-1], bounds[1:], ids, strict=True):
            out += [i] if i >= 0 else [self.byte + b for b in unit[start:end].encode("utf-8", "surrogatepass")]
        return out

    def literal(self) -> list[int]:
        return [self.byte + b for b in SPACE.encode()]

    # one long unit

    def encode_long(self, unit: str, variant: int) -> list[int]:
        _, hashes, points = self.described([unit])
        key = self.keyed(hashes, [variant])
        ids, n = points.tolist(), len(unit)
        ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
        alive, agenda = [True] * n, []

        def offer(left: int, right: int) -> None:
            if left < 0 or right < 0 or ids[left] < 0 or ids[right] < 0:
                return
            made = int(self.table.find(np.array([ids[left]]), np.array([ids[right]]))[0])
            if made != NONE:
                heapq.heappush(agenda, (int(self.rank_of[made]), left, right, ends[right], made))

        firsts, seconds = np.array(ids[:-1]), np.array(ids[1:])
        known = np.flatnonzero((firsts >= 0) & (seconds >= 0)) if n > 1 else np.zeros(0, np.int64)
        made = self.table.find(firsts[known], seconds[known]) if len(known) else known
        agenda = [
            (int(self.rank_of[m]), i, i + 1, i + 2, m)
            for i, m in zip(known.tolist(), made.tolist(), strict=True) if m != NONE
        ]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, end, m = heapq.heappop(agenda)
            # a candidate counts only while both its sides are as they were
            if not alive[left] or not alive[right] or after[left] != right or ends[left] != right or ends[right] != end:
                continue
            if self.skipped(key, *(np.array([v]) for v in (left, right, end)))[0]:
                continue
            ids[left], ends[left], alive[right] = m, end, False
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        kept = [i for i in range(n) if alive[i]]
        return self.spelled(unit, [*kept, n], [ids[i] for i in kept])

    # many short units

    def encode_short(self, units: list[str], variants) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and their number per unit."""
        if not units:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lengths, hashes, ids = self.described(units)
        return self._advance(units, lengths, ids, self.keyed(hashes, variants))

    def _advance(self, units: list[str], lengths, ids, keys, merges: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_short``; without keys nothing is skipped, and ``merges`` gets the units and boundaries of all merges."""
        starts = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ends, who = starts + 1, np.arange(len(units))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # units, their numbers of ids, their ids

        def finish(these, ids, starts, lengths):
            first = np.cumsum(lengths) - lengths
            odd = np.minimum.reduceat(ids, first) < 0
            for n in np.flatnonzero(odd).tolist():
                unit, span = units[these[n]], slice(first[n], first[n] + lengths[n])
                found = self.spelled(unit, [*starts[span].tolist(), len(unit)], ids[span].tolist())
                done.append((these[n : n + 1], np.array([len(found)]), np.array(found, np.int64)))
            done.append((these[~odd], lengths[~odd], ids[np.repeat(~odd, lengths)]))

        while len(who):
            sequence = np.repeat(np.arange(len(who)), lengths)
            made = np.full(len(ids), NONE, np.int64)
            pair = np.flatnonzero((sequence[:-1] == sequence[1:]) & (ids[:-1] >= 0) & (ids[1:] >= 0))
            made[pair] = self.table.find(ids[pair], ids[pair + 1])
            pair = pair[made[pair] != NONE]
            if keys is not None:
                pair = pair[~self.skipped(keys[who[sequence[pair]]], starts[pair], starts[pair + 1], ends[pair + 1])]
            ranks = np.full(len(ids), NONE, np.int32)
            ranks[pair] = self.rank_of[made[pair]]
            first = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, first)
            going = lowest != NONE
            if not going.all():
                stop = np.repeat(~going, lengths)
                finish(who[~going], ids[stop], starts[stop], lengths[~going])
                keep = ~stop
                ids, starts, ends, ranks, made = ids[keep], starts[keep], ends[keep], ranks[keep], made[keep]
                who, lengths, lowest = who[going], lengths[going], lowest[going]
                if not len(who):
                    break
                sequence = np.repeat(np.arange(len(who)), lengths)
            at = np.flatnonzero(ranks == lowest[sequence])
            leftmost = np.ones(len(at), bool)
            leftmost[1:] = sequence[at[1:]] != sequence[at[:-1]]
            at = at[leftmost]
            if merges is not None:
                merges.append((who[sequence[at]], starts[at], starts[at + 1], ends[at + 1]))
            ids[at], ends[at] = made[at], ends[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, starts, ends, lengths = ids[keep], starts[keep], ends[keep], lengths - 1
        these, counts, flat = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(these)
        return take_runs(flat, np.cumsum(counts) - counts, counts, order), counts[order]

    # texts

    def units(self, text: str, first: bool = True) -> list[str]:
        """The units of a text, or of a window of it; only the ``first`` window has the space that stands before a text."""
        if not text:
            return []
        parts = text.split(SPACE)
        out = UNIT.findall((SPACE if first else "") + parts[0].replace(" ", SPACE))
        for part in parts[1:]:
            out += [LITERAL, *UNIT.findall(part.replace(" ", SPACE))]
        return out

    def _segmented(self, names: list[str], of: np.ndarray, variants: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of segmentations, and where each occurrence's (of unit ``of``) begin in them, and their number."""
        sizes = np.fromiter(map(len, names), np.int64, len(names))
        odd = sizes > SHORT
        odd[[i for i in np.flatnonzero(sizes == len(LITERAL)).tolist() if names[i] == LITERAL]] = True
        begins, lengths = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
        parts, at = [], 0

        def put(these: np.ndarray, flat: np.ndarray, firsts, counts) -> None:
            nonlocal at
            begins[these], lengths[these] = at + firsts, counts
            parts.append(flat)
            at += len(flat)

        short = np.flatnonzero(~odd)
        units = [names[i] for i in short.tolist()]
        if units:
            number = np.zeros(len(names), np.int64)
            number[short] = np.arange(len(short))
            merges: list[tuple] = []
            chars, hashes, points = self.described(units)
            flat, counts = self._advance(units, chars, points.copy(), None, merges)
            these = np.flatnonzero(~odd[of])
            unit = number[of[these]]
            put(these, flat, (np.cumsum(counts) - counts)[unit], counts[unit])
            if self.limit and merges:
                keys = self.keyed(hashes[unit], variants[these])
                who, *bounds = (np.concatenate(columns) for columns in zip(*merges, strict=True))
                order = np.argsort(who, kind="stable")
                made = np.bincount(who, minlength=len(units))
                first, taken = (np.cumsum(made) - made)[unit], made[unit]
                place = order[np.repeat(first - (np.cumsum(taken) - taken), taken) + np.arange(int(taken.sum()))]
                occurrence = np.repeat(np.arange(len(unit)), taken)
                skipped = self.skipped(keys[occurrence], *(column[place] for column in bounds))
                own = np.unique(occurrence[skipped])
                if len(own):
                    unit = unit[own]
                    ids = take_runs(points, np.cumsum(chars) - chars, chars, unit)
                    flat, counts = self._advance([units[i] for i in unit.tolist()], chars[unit], ids, keys[own])
                    put(these[own], flat, np.cumsum(counts) - counts, counts)
        memo: dict[tuple[int, int], tuple[int, int]] = {}
        for i in np.flatnonzero(odd[of]).tolist():
            name = names[of[i]]
            same = int(of[i]), int(variants[i]) if self.limit and name != LITERAL else 0
            if same not in memo:
                found = self.literal() if name == LITERAL else self.encode_long(name, int(variants[i]))
                parts.append(np.array(found, np.int64))
                memo[same] = at, len(found)
                at += len(found)
            begins[i], lengths[i] = memo[same]
        return np.concatenate(parts), begins, lengths

    def _occurrences(self, found: list[list[str]], keys: list[int], places: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of windows (their units, the key of their text, the place of the first unit in it), and their number."""
        numbers: dict[str, int] = {}
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.array([numbers.setdefault(u, len(numbers)) for units in found for u in units], np.int64)
        if not len(flat):
            return np.zeros(0, np.int32), counts
        nth = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts - np.array(places, np.int64), counts)
        document = np.repeat(np.array([k % 2**64 for k in keys], np.uint64), counts)
        with np.errstate(over="ignore"):
            variant = _mix(document * M1 + nth.astype(np.uint64) * M4 + self.seed)
        if self.variants is not None:
            variant %= np.uint64(self.variants)
        ids, begins, lengths = self._segmented(list(numbers), flat, variant)
        per_window = np.add.reduceat(np.append(lengths, 0), np.minimum(np.cumsum(counts) - counts, len(flat)))
        return take_runs(ids, begins, lengths, np.arange(len(flat))).astype(np.int32), np.where(counts > 0, per_window, 0)

    def chunks(self, texts: list[str]) -> Iterator[list[tuple[int, int, int]]]:
        """Windows (text, start, end), in order, as many as a task segments at a time."""
        held, chars = [], 0
        for n, text in enumerate(texts):
            start = 0
            while start < len(text):
                m = BOUNDARY.search(text, start + CHUNK_CHARS - chars)
                end = m.start() if m and m.start() > start else len(text)
                if held and chars + end - start > 2 * CHUNK_CHARS:
                    yield held
                    held, chars = [], 0
                    continue
                held.append((n, start, end))
                chars, start = chars + end - start, end
                if chars >= CHUNK_CHARS:
                    yield held
                    held, chars = [], 0
        if held:
            yield held

    def encode(
        self, texts: list[str], keys: list[int], decoder: Decoder | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, their number per text, and whether ``decoder`` gives the text back.

        ``keys`` tell documents apart.
        """
        parts, counts, same = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), np.ones(len(texts), bool)
        last, place = -1, 0
        for windows in self.chunks(texts):
            found, places = [], []
            for n, start, end in windows:
                place = place if n == last else 0
                last = n
                found.append(self.units(texts[n][start:end], start == 0))
                places.append(place)
                place += len(found[-1])
            ids, sizes = self._occurrences(found, [keys[n] for n, _, _ in windows], places)
            parts.append(ids)
            np.add.at(counts, [n for n, _, _ in windows], sizes)
            if decoder is not None:
                ends = np.cumsum(sizes)
                for (n, start, end), low, high in zip(windows, (ends - sizes).tolist(), ends.tolist(), strict=True):
                    same[n] &= decoder.decode(ids[low:high], start == 0) == texts[n][start:end]
        return np.concatenate(parts), counts, same


class Decoder:
    def __init__(self, model: dict):
        spelled = []
        for i, (piece, plain) in enumerate(zip(model["pieces"], model["plain"], strict=True)):
            byte = i - model["first_byte"]
            spelled.append(bytes([byte]) if 0 <= byte < 256 else piece.replace(SPACE, " ").encode() if plain else b"")
        self.spelled = spelled

    def decode(self, ids: np.ndarray, first: bool = True) -> str:
        """The text that the ids stand for, without the space that encoding puts before the ``first`` of them."""
        whole = b"".join(
            b"".join(map(self.spelled.__getitem__, ids[at : at + CHUNK_CHARS].tolist()))
            for at in range(0, len(ids), CHUNK_CHARS)
        )
        return (whole[1:] if first and whole[:1] == b" " else whole).decode("utf-8", "surrogatepass")


def encode(
    docs: DataFrame, model_path: str, seed: int = 42, dropout: float = DROPOUT, variants: int | None = None,
    doc_id: str = "doc_id", text: str = "text", into: str = "ids",
    copy: str | None = None, check: str | None = None,
) -> DataFrame:
    """``docs`` with the column ``into``: the ids of its texts.  Only the driver reads the model file.

    A column ``copy`` that numbers the copies of a document lets them be segmented each in its own way.  The column
    ``check``, if asked for, says whether the ids decode to the text; that takes no second pass.  A column of ``docs`` that
    has the name of a new one is an error.
    """
    names, added = docs.columns, [into, *([check] if check else [])]
    if clash := set(added) & set(names):
        raise ValueError(f"columns {sorted(clash)} are there already: name others by into and check")
    shipped = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    key, content = (f"__{i}" for i in _unused(names, 2))
    rows = docs.withColumns({key: F.xxhash64(doc_id, F.lit(seed), *([copy] if copy else [])), content: text_of(text)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        encoder, decoder = Encoder(model, seed, dropout, variants), Decoder(model) if check else None
        for batch in batches:
            for part in _parts(batch, content):
                ids, counts, same = encoder.encode(part.column(content).to_pylist(), part.column(key).to_pylist(), decoder)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                made = [pa.ListArray.from_arrays(offsets, pa.array(ids)), *([pa.array(same)] if check else [])]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), *made], [*names, *added])

    fields = [T.StructField(into, T.ArrayType(T.IntegerType())), *([T.StructField(check, T.BooleanType())] if check else [])]
    return rows.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def _unused(names: list[str], n: int) -> list[int]:
    """Numbers that, after two underscores, name no column yet."""
    found = (i for i in range(len(names) + n) if f"__{i}" not in names)
    return [next(found) for _ in range(n)]


def _parts(batch: pa.RecordBatch, content: str) -> Iterator[pa.RecordBatch]:
    """Rows of about ``CHUNK_CHARS`` bytes of text at a time; a longer text stands alone."""
    sizes = pc.binary_length(batch.column(content)).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (4 * CHUNK_CHARS))) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True):
        yield batch.slice(start, end - start)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the column ``into``: the texts that ``ids`` stand for."""
    shipped = rows.sparkSession.sparkContext.broadcast(load_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shipped.value)
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // CHUNK_CHARS)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lengths)], strict=True):
                part = batch.slice(start, end - start)
                texts = [decoder.decode(i.values.to_numpy()) if i.is_valid else "" for i in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())]))
