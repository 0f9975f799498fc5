"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

Text is cut into words before each run of the white space mark, which no piece
crosses. The distinct words of a batch are grouped by length, and all words of one
length advance together, character by character: the polynomial hashes of the substrings
that end there probe the sorted hashes of the pieces, every word keeps the candidate
with the best score, and its length is the backpointer.

Two kinds of model are served:

- unigram: the score of a path is the sum of its pieces' scores.
- BPE: merging pairs by rank is not a sum of scores. But a segmentation is the one that
  merging gives exactly if every two neighbours in it are what merging gives for the two alone.
  So a candidate is admitted (score 0 instead of minus infinity) if it and the last piece before it
  are such neighbours. One candidate is admitted at each place. The test of all candidates of
  a step is vectorised: it undoes the latest merges at the seam and looks for a merge across it that
  would have come first.

Characters that are no piece become their UTF-8 bytes, or the unknown piece in a
model without byte pieces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MARK = "▁"
#: Base of the rolling hash over code points, modulo 2^64.
BASE = 0x9E3779B97F4A7C15 | 1
#: Distinct words a task remembers, words encoded at once and cells of one matrix.
REMEMBERED, CELLS = 400_000, 1 << 21
#: Characters of a word above which it is cut where no piece can go across.
LONG = 40
#: Leading bits of the piece hashes that are kept as a bitmap.
TOP = 20
FAR = 1 << 40
NONE = -1


def _hash_of(codes: list[int]) -> int:
    value = 0
    for code in codes:
        value = (value * BASE + code + 1) & 0xFFFFFFFFFFFFFFFF
    return value


class Pieces:
    """The tables of a model: sorted piece hashes, scores, seams, bytes."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], unknown: int, bpe: bool, usable: list[int], dummy_prefix: bool = True):
        self.bpe, self.unknown, self.dummy_prefix = bpe, unknown, dummy_prefix
        self.size = len(pieces)
        self.scores = np.array(scores)
        self.path_scores = np.append(self.scores, self.scores.min() - 10.0)
        self.word = re.compile(r"\n| *[^ \n]+| +" if not any("\n" in p for p in pieces) else r" *[^ ]+| +")
        self.longest = max(len(pieces[i]) for i in usable)
        pairs = {ord(a) << 21 | ord(b) for i in usable for a, b in zip(pieces[i], pieces[i][1:])}
        self.pairs = np.array(sorted(pairs) or [NONE], dtype=np.int64)
        hashes = np.array([_hash_of([ord(c) for c in pieces[i]]) for i in usable], dtype=np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(usable, dtype=np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash; choose another base")
        self.top_bits = np.zeros(1 << TOP, dtype=bool)
        self.top_bits[self.keys >> np.uint64(64 - TOP)] = True
        self.hashes = np.zeros(self.size, dtype=np.uint64)
        self.hashes[usable] = hashes
        self.lengths = np.array([len(p) for p in pieces])
        self.powers = np.array([pow(BASE, n, 1 << 64) for n in range(self.longest + 1)], dtype=np.uint64)
        self.byte_ids = np.array([byte_ids.get(b, unknown) for b in range(256)], dtype=np.int32)
        self.has_bytes = len(byte_ids) == 256
        # What a piece decodes to; byte pieces to their byte.
        text = [p.replace(MARK, " ").encode() for p in pieces]
        for byte, piece in byte_ids.items():
            text[piece] = bytes([byte])
        if unknown >= 0:
            text[unknown] = " ⁇ ".encode()
        self.blob = np.frombuffer(b"".join(text), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in text])
        self.text_starts, self.text_lengths = ends - [len(t) for t in text], np.array([len(t) for t in text])
        if bpe:
            self._rank_pieces(pieces, usable)

    def _rank_pieces(self, pieces: list[str], usable: list[int]) -> None:
        """Ranks by score (ties share one) and the two parts that the last merge of each piece joins."""
        known = {pieces[i]: i for i in usable}
        by_score = {score: rank for rank, score in enumerate(sorted({self.scores[i] for i in usable}, reverse=True))}
        self.rank = np.full(self.size + 1, -1, dtype=np.int64)
        self.left = np.full(self.size + 1, NONE, dtype=np.int64)
        self.right = np.full(self.size + 1, NONE, dtype=np.int64)
        self.reached = np.zeros(self.size + 1, dtype=bool)
        self.reached[-1] = True
        for i in usable:
            if self.lengths[i] == 1:
                self.reached[i] = True
                continue
            parts, last = merged(list(pieces[i]), known, self.scores)
            if len(parts) == 1:
                self.reached[i] = True
                self.left[i], self.right[i] = last
            self.rank[i] = by_score[self.scores[i]]
        # When a piece is there at the earliest: a piece may rank before its own parts.
        self.time = self.rank.copy()
        for i in sorted(usable, key=lambda i: self.lengths[i]):
            if self.left[i] != NONE:
                self.time[i] = max(self.rank[i], self.time[self.left[i]], self.time[self.right[i]])
        self.known, self.pieces, self.settled = known, pieces, {}

    def cut(self, word: str) -> list[str]:
        """The parts of a word between characters that stand side by side in no piece; none goes across, so
        the parts' ids in order are the word's. Needs byte pieces: unknown characters are one piece otherwise."""
        codes = np.frombuffer(word.replace(" ", MARK).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        pair = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        ends = (np.flatnonzero(self.pairs[at] != pair) + 1).tolist()
        return [word[a:b] for a, b in zip([0, *ends], [*ends, len(word)])]

    def _merge_two(self, left: int, right: int) -> bool:
        """The test of ``neighbours`` by merging."""
        found = self.settled.get((left, right))
        if found is None:
            if len(self.settled) >= REMEMBERED:
                self.settled.clear()
            a, b = self.pieces[left], self.pieces[right]
            found = self.settled[left, right] = merged([*a, *b], self.known, self.scores)[0] == [a, b]
        return found

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, ``NONE`` where there is none."""
        found = np.full(hashes.shape, NONE)
        # Most substrings are no piece; the top bits tell so for nearly all of them.
        maybe = self.top_bits[hashes >> np.uint64(64 - TOP)]
        asked = hashes[maybe]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        found[maybe] = np.where(self.keys[at] == asked, self.ids[at], NONE)
        return found

    def neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the two pieces' characters gives just these two pieces.

        Where a piece that ranks before its parts is met, ranks do not tell the order of
        the merges; such pairs are merged for real, and remembered.
        """
        good = np.ones(len(left), dtype=bool)
        doubt = np.zeros(len(left), dtype=bool)
        at = np.flatnonzero((left >= 0) & (right >= 0) & (left < self.size) & (right < self.size))
        l, r = left[at], right[at]
        limit = np.full(len(at), FAR)
        while len(at):
            with np.errstate(over="ignore"):
                both = self.hashes[l] * self.powers[self.lengths[r]] + self.hashes[r]
            whole = self.find(both)
            # A hash says nothing about pieces that are too long to be one.
            whole = np.where(self.lengths[l] + self.lengths[r] <= self.longest, whole, NONE)
            late = np.maximum(self.time[l], self.time[r])
            doubt[at] |= (self.time[l] != self.rank[l]) | (self.time[r] != self.rank[r]) | ((whole != NONE) & (self.rank[whole] < late))
            crossed = (whole != NONE) & (self.rank[whole] < limit)
            good[at[crossed]] = False
            # Undo the later of the two last merges. Of equal ones the right came later.
            left_later = self.rank[l] > self.rank[r]
            end = ~left_later & (self.rank[r] < 0)
            go = ~crossed & ~end
            at, l, r, left_later = at[go], l[go], r[go], left_later[go]
            # Merges of equal rank run from left to right: across the seam comes before the right part's.
            limit = np.where(left_later, self.rank[l], self.rank[r] + 1)
            l, r = np.where(left_later, self.right[l], l), np.where(left_later, r, self.left[r])
        unsure = np.flatnonzero(doubt)
        if len(unsure):
            pairs, which = np.unique(left[unsure] * self.size + right[unsure], return_inverse=True)
            good[unsure] = np.array([self._merge_two(*divmod(p, self.size)) for p in pairs.tolist()], dtype=bool)[which]
        return good

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids laid end to end, ids per word) of words whose blanks are marks already."""
        lengths = np.array([len(w) for w in words])
        sizes = np.zeros(len(words), dtype=np.int64)
        rows, flats = [], []
        for length in np.unique(lengths[lengths > 0]):
            same = np.flatnonzero(lengths == length)
            step = max(1, CELLS // (int(length) * self.longest))
            for start in range(0, len(same), step):
                part = same[start : start + step]
                codes = "".join(words[i] for i in part).encode("utf-32-le", "surrogatepass")
                codes = np.frombuffer(codes, dtype=np.uint32).reshape(len(part), length)
                flat, sizes[part] = self._advance(codes.astype(np.int64))
                rows.append(part)
                flats.append(flat)
        if not rows:
            return np.empty(0, dtype=np.int32), sizes
        # Back from the order of lengths to the order of the words.
        order = np.concatenate(rows)
        ends = np.empty(len(words), dtype=np.int64)
        ends[order] = np.cumsum(sizes[order])
        return np.concatenate(flats)[spread(ends - sizes, sizes)], sizes

    def _advance(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over words of one length, one row each."""
        count, length = codes.shape
        rows = np.arange(count)
        rolling = np.zeros((length + 1, count), dtype=np.uint64)
        best = np.zeros((length + 1, count))
        # Last piece and its length for every prefix; size stands for a lone unknown character.
        last = np.full((length + 1, count), NONE, dtype=np.int64)
        back = np.zeros((length + 1, count), dtype=np.int64)
        for end in range(1, length + 1):
            widths = np.arange(1, min(end, self.longest) + 1)
            with np.errstate(over="ignore"):
                rolling[end] = rolling[end - 1] * np.uint64(BASE) + codes[:, end - 1].astype(np.uint64) + np.uint64(1)
                found = self.find(rolling[end] - rolling[end - widths] * self.powers[widths][:, None])
            found[0][found[0] == NONE] = self.size
            nth, row = np.nonzero(found != NONE)
            piece, start = found[nth, row], end - widths[nth]
            score = np.full(found.shape, -np.inf)
            if self.bpe:
                fits = self.reached[piece]
                fits[fits] = self.neighbours(last[start[fits], row[fits]], piece[fits])
                score[nth[fits], row[fits]] = 0.0
            else:
                score[nth, row] = best[start, row] + self.path_scores[piece]
            chosen = score.argmax(axis=0)
            best[end], last[end], back[end] = score[chosen, rows], found[chosen, rows], widths[chosen]
        ends, order = np.full(count, length), []
        while (ends > 0).any():
            order.append(np.where(ends > 0, last[ends, rows], NONE))
            ends = ends - np.where(ends > 0, back[ends, rows], 0)
        paths = np.array(order[::-1]).T
        used = paths != NONE
        lone = np.flatnonzero((paths == self.size).any(axis=1))
        if not len(lone):
            return paths[used].astype(np.int32), used.sum(axis=1)
        parts = {row: self._spell(paths[row][used[row]], codes[row]) for row in lone.tolist()}
        whole = [parts.get(row) if row in parts else paths[row][used[row]] for row in range(count)]
        return np.concatenate(whole).astype(np.int32), np.array([len(ids) for ids in whole])

    def _spell(self, ids: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Unknown characters as byte pieces."""
        out, at, unknown_before = [], 0, False
        for i in ids:
            if i == self.size:
                if self.has_bytes:
                    out.extend(self.byte_ids[b] for b in chr(codes[at]).encode("utf-8", "surrogatepass"))
                elif not unknown_before:
                    out.append(self.unknown)
                unknown_before = True
                at += 1
            else:
                out.append(i)
                unknown_before = False
                at += self.lengths[i]
        return np.array(out, dtype=np.int32)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of id lists laid end to end; list k is ids[offsets[k]:offsets[k + 1]]."""
        size = self.text_lengths[ids]
        data = self.blob[spread(self.text_starts[ids], size)].tobytes()
        cuts = np.concatenate([[0], np.cumsum(size)])[offsets]
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
        return [t[1:] if self.dummy_prefix and t.startswith(" ") else t for t in texts]


def merged(symbols: list[str], known: dict[str, int], scores) -> tuple[list[str], tuple[int, int]]:
    """Plain merging, best score first, then leftmost: the symbols left and the last merge's parts."""
    last = (NONE, NONE)
    while True:
        found = [(-scores[known[a + b]], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in known]
        if not found:
            return symbols, last
        i = min(found)[1]
        last = (known[symbols[i]], known[symbols[i + 1]])
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message: whole numbers, or bytes."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (blob[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if blob[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(blob):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = blob[at : at + size], at + size
        yield tag >> 3, value


# Fixed values of the model format: its type, and the fields that say how text is changed before.
UNIGRAM, BPE = 1, 2
TRAINER, NORMALIZER = 2, 3
MODEL_TYPE = 3
CHARS_MAP, DUMMY_PREFIX, REMOVE_BLANKS, ESCAPE_BLANKS = 2, 3, 4, 5


def load_pieces(path: str) -> Pieces:
    """Tables of a model file; read on the driver, a few MB that travel with the tasks.

    The type, BPE or unigram, is read from the file. Other types, models that normalise text, and those that
    cut at places this module does not, are refused.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    everything = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in everything]
    usable = [i for i in everything if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))]
    crossing = [pieces[i] for i in usable if MARK in pieces[i].lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces with white space inside: {crossing[:3]}")
    byte_ids = {int(pieces[i][3:5], 16): i for i in everything if model.is_byte(i)}
    bpe, dummy_prefix = read_kind(model.serialized_model_proto())
    return Pieces(pieces, [model.get_score(i) for i in everything], byte_ids, model.unk_id(), bpe, usable, dummy_prefix)


def read_kind(blob: bytes) -> tuple[bool, bool]:
    """(of the BPE type, puts a blank in front) of a serialised model; refuses what this module does not serve."""
    specs = {name: value for name, value in _fields(blob) if name in (TRAINER, NORMALIZER)}
    kind = dict(_fields(specs.get(TRAINER, b""))).get(MODEL_TYPE, UNIGRAM)
    if kind not in (UNIGRAM, BPE):
        raise ValueError(f"a model of type {kind} is neither unigram nor BPE")
    changes = dict(_fields(specs.get(NORMALIZER, b"")))
    if changes.get(CHARS_MAP) or changes.get(REMOVE_BLANKS, 1) or not changes.get(ESCAPE_BLANKS, 1):
        raise ValueError("the model normalises its text")
    return kind == BPE, bool(changes.get(DUMMY_PREFIX, 1))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for every start, as many as its size, laid end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Numbers(dict):
    """Numbers words as they are first seen; ``fresh`` has those not encoded yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        number = self[word] = len(self)
        return number


class Encoder:
    """Encodes batches of texts and remembers a bounded number of words."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.number = Numbers()
        self.flat, self.sizes = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts laid end to end."""
        if len(self.number) > REMEMBERED:
            self._forget()
        front = " " if self.pieces.dummy_prefix else ""
        words_of, number_of, cut = self.pieces.word.findall, self.number.__getitem__, self.pieces.cut
        numbers, offsets = array("q"), [0]
        for text in texts:
            if text:
                # A mark in the text is a blank to the model.
                words = words_of(front + text.replace(MARK, " "))
                if self.pieces.has_bytes and max(map(len, words)) > LONG:
                    # Scripts without blanks: a line is one word, and hardly any word comes twice.
                    words = [part for word in words for part in (cut(word) if len(word) > LONG else (word,))]
                numbers.extend(map(number_of, words))
            offsets.append(len(numbers))
        if self.number.fresh:
            flat, sizes = self.pieces.encode_words([w.replace(" ", MARK) for w in self.number.fresh])
            self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
            self.number.fresh.clear()
        chosen = np.frombuffer(numbers, dtype=np.int64)
        size = self.sizes[chosen]
        starts = np.cumsum(self.sizes) - self.sizes
        ids = self.flat[spread(starts[chosen], size)]
        return ids, np.concatenate([[0], np.cumsum(size)])[np.array(offsets)]


#: Bytes of text that are encoded at once; decoding takes an eighth as many ids.
BATCH = 1 << 22


def _portions(sizes: list[int | None], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` together, each of one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size or 0
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(df: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the column ``ids`` (array of int), replacing one of that name. Null counts as empty: no ids."""
    others = [F.col(f"`{name}`") for name in df.columns if name != ids]
    schema = StructType([f for f in df.schema.fields if f.name != ids] + [StructField(ids, ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for batch in batches:
            for start, end in _portions(pc.binary_length(batch.column(text)).to_pylist(), BATCH):
                part = batch.slice(start, end - start)
                flat, offsets = encoder.encode([t or "" for t in part.column(text).to_pylist()])
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, ids])

    return df.select(*others).mapInArrow(run, schema)


def decode(df: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the column ``text`` with the texts of the id lists; null and empty lists give empty texts."""
    others = [F.col(f"`{name}`") for name in df.columns if name != text]
    schema = StructType([f for f in df.schema.fields if f.name != text] + [StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            counts = np.array([n or 0 for n in pc.list_value_length(batch.column(ids)).to_pylist()], dtype=np.int64)
            for start, end in _portions(counts.tolist(), BATCH // 8):
                flat = batch.column(ids).slice(start, end - start).flatten().to_numpy(zero_copy_only=False)
                texts += pieces.decode(flat, np.concatenate([[0], np.cumsum(counts[start:end])]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return df.select(*others).mapInArrow(run, schema)
