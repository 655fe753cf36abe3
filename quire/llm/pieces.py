"""SentencePiece ids by suffix-array matching: every piece is looked up in a sorted index of the batch's text.

The words of a batch that are new to the task are laid end to end and their suffixes sorted to the length of the
longest piece. A binary search finds each piece's range of suffixes; the occurrences become edges, sorted by where they
end, and are relaxed from left to right:

unigram models: an edge leads to its end by the largest sum of scores.
BPE models:     a prefix of a BPE encoding is the encoding of that prefix, so each end has exactly one last piece; it is
                the one whose neighbour on the left, the last piece at the edge's start, would not have merged with it
                or with a part of it before it was complete.
"""

from __future__ import annotations

from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quire.llm import words

#: The public vocabulary of the queries; a parameter of everything below.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Code points of one index, on average; words kept in a task's memory.
INDEXED, REMEMBERED = 1 << 17, 1 << 19
_PORTION = 1 << 19
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[0x20] = True
NEVER = 1 << 40
#: Stands for U+0000 in the index, where that ends a word: no code point.
NUL = 0x110000


class Vocabulary(NamedTuple):
    """What tasks need of a model: a few MB for tens of thousands of pieces."""
    unigram: bool
    spellings: list[bytes]       # what each id decodes to
    ids: np.ndarray              # id of each piece that can be matched
    letters: np.ndarray          # code points that pieces are made of, sorted
    matrix: np.ndarray           # pieces as letter numbers from 1, in 64-bit words of four
    lengths: np.ndarray
    scores: np.ndarray           # by id
    rank: np.ndarray             # BPE: when a piece is formed, by id; -1: a single letter
    left: np.ndarray             # BPE: the two pieces it is formed of last
    right: np.ndarray
    pairs: np.ndarray            # BPE: left id << 32 | right id of all pairs that merge, sorted
    merged: np.ndarray           # and the rank of what they become
    byte_ids: np.ndarray         # ids of the 256 bytes, or none
    unknown: int
    space_runs: dict[int, int]   # ids of pieces of spaces only, by their number
    unknown_score: float


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model file: from the driver's disk, or by Spark where the path names another store."""
    if "://" not in path:
        return Path(path).read_bytes()
    return spark.read.format("binaryFile").load(path).select("content").first()[0]


def _parts(piece: str, known: dict[str, int], rank: dict[str, int]) -> list[str] | None:
    """The last merge of a piece by BPE, or None if BPE does not give the piece back."""
    parts = list(piece)
    while len(parts) > 2:
        options = [(rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in known]
        if not options:
            return None
        k = min(options)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return parts if len(parts) == 2 else None


def vocabulary(model: bytes) -> Vocabulary:
    """Tables of a unigram or BPE model that neither normalises text nor has symbols of the user."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    kind, rules = proto.trainer_spec.model_type, proto.normalizer_spec
    types = sentencepiece_model_pb2.ModelProto.SentencePiece
    if kind not in (1, 2) or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (
            rules.add_dummy_prefix and rules.escape_whitespaces) or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models without normalisation and with a leading space are supported")
    if any(p.type == types.USER_DEFINED for p in proto.pieces):
        raise ValueError("symbols defined by the user are not supported")
    unigram = kind == 1
    normal = {p.piece: no for no, p in enumerate(proto.pieces) if p.type == types.NORMAL}
    if any(SPACE in piece.lstrip(SPACE) for piece in normal):
        raise ValueError("pieces that hold a space behind other text are not supported")
    scores = np.array([p.score for p in proto.pieces])
    size = len(scores)
    rank, left, right = np.full(size, -1), np.full(size, -1), np.full(size, -1)
    usable, pairs = dict(normal), {}
    if not unigram:
        order = {piece: k for k, piece in enumerate(sorted(normal, key=lambda p: -scores[normal[p]]))}
        words_only = {piece: no for piece, no in normal.items() if piece.strip(SPACE) or piece == SPACE}
        usable = {}
        for piece, no in words_only.items():
            if len(piece) > 1:
                parts = _parts(piece, words_only, order)
                if parts is None:
                    continue
                rank[no] = order[piece]
                left[no], right[no] = (normal.get(part, -1) for part in parts)
            usable[piece] = no
        for piece, no in words_only.items():
            for cut in range(1, len(piece)):
                a, b = normal.get(piece[:cut]), normal.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = order[piece]
        made = rank[[*usable.values()]]
        parts = np.stack([left, right])[:, [*usable.values()]]
        if (parts[:, made >= 0] < 0).any() or (rank[parts[:, made >= 0]] >= made[made >= 0]).any():
            raise ValueError("a piece is formed before its parts")
    spellings = []
    for p in proto.pieces:
        spellings.append(bytes([int(p.piece[3:5], 16)]) if p.type == types.BYTE else b"" if p.type == types.CONTROL
                         else " ⁇ ".encode() if p.type == types.UNKNOWN
                         else p.piece.replace(SPACE, " ").encode())
    letters = np.array(sorted({ord(c) for piece in usable for c in piece}))
    width = -(-max(map(len, usable)) // 4) * 4
    matrix = np.zeros((len(usable), width), np.uint64)
    for row, piece in enumerate(usable):
        matrix[row, :len(piece)] = np.searchsorted(letters, [ord(c) for c in piece]) + 1
    keys = np.array(sorted(pairs), np.int64)
    return Vocabulary(
        unigram, spellings, np.array([*usable.values()]), letters, matrix, np.array([*map(len, usable)]), scores, rank,
        left, right, keys, np.array([pairs[k] for k in keys.tolist()], np.int64),
        np.array([no for no, p in enumerate(proto.pieces) if p.type == types.BYTE]),
        next(no for no, p in enumerate(proto.pieces) if p.type == types.UNKNOWN), {len(piece): no for piece, no in normal.items() if not piece.strip(SPACE)},
        min((scores[no] for no in normal.values()), default=0.0) - 10)


def _packed(letters: np.ndarray, width: int) -> np.ndarray:
    """The first `width` letters of every suffix as 64-bit words of four letters."""
    padded = np.concatenate([letters, np.zeros(width + 4, letters.dtype)]).astype(np.uint64)
    n = len(letters)
    four = sum(padded[k:k + n + width] << np.uint64(16 * (3 - k)) for k in range(4))
    return np.stack([four[k:k + n] for k in range(0, width, 4)])


def suffix_order(letters: np.ndarray, depth: int, key_bits: int = 64) -> np.ndarray:
    """Suffixes sorted by their first `depth` letters: by one letter, then two, four, ... from ranks of the halves.

    Both ranks and the place are sorted as one key where they fit into `key_bits`, else as separate columns: a single
    word may have any length.
    """
    n = len(letters)
    bits = max(int(letters.max(initial=0)), n, 1).bit_length()
    if 3 * bits > key_bits:
        return _long_suffix_order(letters, depth)
    places = np.arange(n, dtype=np.uint64)
    ranks, width = letters.astype(np.uint64), 1
    while True:
        later = np.zeros(n, np.uint64)
        later[:max(n - width, 0)] = ranks[width:]
        keys = (ranks << np.uint64(2 * bits)) | (later << np.uint64(bits)) | places
        keys.sort()
        order = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
        width *= 2
        if width >= depth:
            return order
        keys >>= np.uint64(bits)
        # Rank 0 stands for what lies behind the end.
        ranks = np.empty(n, np.uint64)
        ranks[order] = np.cumsum(np.concatenate([[1], keys[1:] != keys[:-1]])).astype(np.uint64)


def _long_suffix_order(letters: np.ndarray, depth: int) -> np.ndarray:
    ranks, width = letters.astype(np.int64), 1
    while True:
        later = np.zeros_like(ranks)
        later[:max(len(ranks) - width, 0)] = ranks[width:]
        order = np.lexsort((later, ranks))
        width *= 2
        if width >= depth:
            return order
        first, second = ranks[order], later[order]
        new = np.concatenate([[1], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])[:len(order)]
        ranks = np.empty_like(ranks)
        ranks[order] = np.cumsum(new)


def _bound(sorted_words: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, strict: bool):
    """Binary search of many values, each between its own bounds."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        have = sorted_words[np.minimum(middle, len(sorted_words) - 1)]
        after = open_ & ((have <= wanted) if strict else (have < wanted))
        low, high = np.where(after, middle + 1, low), np.where(open_ & ~after, middle, high)


def _ranges(ordered: np.ndarray, pieces: np.ndarray, lengths: np.ndarray):
    """Where the suffixes that begin with each piece start and end in the order, four letters at a time."""
    low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), ordered.shape[1])
    left = np.arange(len(lengths))
    for k, (words_, wanted) in enumerate(zip(ordered, pieces)):
        wanted, size = wanted[left], lengths[left] - 4 * k
        end = wanted.copy()
        for j in range(1, 4):
            end[size <= j] |= np.uint64(0xFFFF << 16 * (3 - j))
        if k:
            low[left], high[left] = (_bound(words_, wanted, low[left], high[left], False),
                                     _bound(words_, end, low[left], high[left], True))
        else:
            low, high = np.searchsorted(words_, wanted, "left"), np.searchsorted(words_, end, "right")
        left = left[(size > 4) & (high[left] > low[left])]
        if not len(left):
            break
    return low, high


def _by_depth(depth: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Edges ordered by depth, then end."""
    bits = [max(int(x.max(initial=0)), 1).bit_length() for x in (depth, end)] + [len(end).bit_length()]
    if sum(bits) > 64:
        return np.lexsort((end, depth))
    keys = (depth.astype(np.uint64) << np.uint64(bits[1] + bits[2])) | (end.astype(np.uint64) << np.uint64(bits[2]))
    keys |= np.arange(len(end), dtype=np.uint64)
    keys.sort()
    return (keys & np.uint64((1 << bits[2]) - 1)).astype(np.int64)


class Encoder:
    """Encodes words, each with a leading space, and remembers them for the rest of the task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        width = vocabulary.matrix.shape[1]
        self.pieces = np.stack([sum(vocabulary.matrix[:, k + j] << np.uint64(16 * (3 - j)) for j in range(4))
                                for k in range(0, width, 4)])
        # A direct-mapped table of neighbours already judged.
        self.judged = np.full(1 << 20, -1, np.int64)
        self.verdict = np.zeros(1 << 20, bool)
        self.forget()

    def forget(self) -> None:
        self.places: dict[int, int] = {}
        self.starts, self.counts, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE leaves the pieces apart when they stand side by side; -1 (no piece) is apart from all."""
        result = np.ones(len(left), bool)
        both = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[both] << 32 | right[both]
        slot = (words.mix(key.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
        apart = self.verdict[slot]
        new = np.flatnonzero(self.judged[slot] != key)
        if len(new):
            unique, where = np.unique(key[new], return_inverse=True)
            apart[new] = self._apart(unique >> 32, unique & 0xFFFFFFFF)[where]
            self.judged[slot[new]], self.verdict[slot[new]] = key[new], apart[new]
        result[both] = apart
        return result

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Undo the merges of both sides from the last to the first; at no time may the two that touch merge."""
        v, apart = self.v, np.ones(len(left), bool)
        active, a, b = np.arange(len(left)), left, right
        before = np.full(len(active), NEVER)
        while len(active):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(v.pairs, key), len(v.pairs) - 1)
            merges = (v.pairs[at] == key) & (v.merged[at] < before)
            apart[active[merges]] = False
            on_left = v.rank[a] > v.rank[b]
            before = np.where(on_left, v.rank[a], v.rank[b] + 1)
            more = ~merges & ((v.rank[a] >= 0) | (v.rank[b] >= 0))
            a, b = np.where(on_left, v.right[a], a), np.where(on_left, b, v.left[b])
            active, a, b, before = active[more], a[more], b[more], before[more]
        return apart

    def _encode(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words (a code point 0 follows each) and each one's number of ids; -1 - c: unknown letter c."""
        v = self.v
        at = np.minimum(np.searchsorted(v.letters, text), len(v.letters) - 1)
        letters = np.where(v.letters[at] == text, at + 1, 0)
        packed = _packed(letters, 4 * len(self.pieces))
        order = suffix_order(letters, int(v.lengths.max()))
        low, high = _ranges(packed[:, order], self.pieces, v.lengths)
        counts = high - low
        piece = np.repeat(np.arange(len(counts)), counts)
        begin = order[np.arange(len(piece)) + np.repeat(low - (np.cumsum(counts) - counts), counts)]
        end, ids = begin + v.lengths[piece], v.ids[piece]
        odd = np.flatnonzero((letters == 0) & (text != 0))
        begin, end = np.concatenate([begin, odd]), np.concatenate([end, odd + 1])
        ids = np.concatenate([ids, np.full(len(odd), -1)])
        word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(text))))
        depth = np.arange(len(text) + 1) - np.append(starts[word], 0)
        order = _by_depth(depth[end], end)
        begin, end, ids = begin[order], end[order], ids[order]
        steps = np.searchsorted(depth[end], np.arange(1, (depth[end[-1]] if len(end) else 0) + 2))
        last, back = np.full(len(text) + 1, -2), np.zeros(len(text) + 1, np.int64)
        best = np.full(len(text) + 1, -np.inf)
        best[starts] = 0
        for a, b in zip(steps[:-1], steps[1:]):
            i, j, p = begin[a:b], end[a:b], ids[a:b]
            if v.unigram:
                value = best[i] + np.where(p >= 0, v.scores[p], v.unknown_score)
                heads = np.flatnonzero(np.concatenate([[True], j[1:] != j[:-1]]))
                top = np.maximum.reduceat(value, heads)
                good = value == np.repeat(top, np.diff(np.append(heads, len(j))))
                best[j[heads]] = top
            else:
                first = depth[i] == 0
                good = first | self.neighbours(np.where(first, -1, last[i]), p)
            last[j[good]], back[j[good]] = p[good], i[good]
        # Follow the last pieces back from every word's end.
        ends = np.append(starts[1:], len(text)) - 1
        at, alive, found = ends.copy(), np.arange(len(starts)), []
        while len(alive):
            p = last[at]
            found.append((alive, np.where(p >= 0, p, -1 - text[at - 1])))
            at = back[at]
            more = at > starts[alive]
            alive, at = alive[more], at[more]
        owner = np.concatenate([a for a, _ in found[::-1]])
        return np.concatenate([p for _, p in found[::-1]])[np.argsort(owner, kind="stable")], np.bincount(
            owner, minlength=len(starts))

    def _learn(self, keys: list[int], spaces: list[int], texts: list[str]) -> None:
        """Encode new words and remember them under their keys."""
        v = self.v
        lead = [SPACE * s + t if v.unigram else SPACE + t for s, t in zip(spaces, texts)]
        found, at = [], 0
        while at < len(lead):
            size, end = 0, at
            while end < len(lead) and (end == at or size + len(lead[end]) < INDEXED):
                size += len(lead[end]) + 1
                end += 1
            part = lead[at:end]
            text = np.frombuffer(("\0".join(part) + "\0").encode("utf-32-le", "surrogatepass"),
                                 np.uint32).astype(np.int64)
            stops = np.cumsum([len(s) + 1 for s in part])
            starts = np.append(0, stops[:-1])
            text[text == 0] = NUL
            text[stops - 1] = 0
            found.append(self._encode(text, starts))
            at = end
        ids, counts = (np.concatenate(part) for part in zip(*found))
        stops = np.cumsum(counts)
        # Words with more spaces or unknown letters are finished one by one.
        odd = np.zeros(len(counts), bool)
        odd[np.searchsorted(stops, np.flatnonzero(ids < 0), "right")] = True
        if not v.unigram:
            odd |= np.array([s > 1 or not t for s, t in zip(spaces, texts)])
        extra, extra_counts = [], []
        for k in np.flatnonzero(odd).tolist():
            some = ids[stops[k] - counts[k]:stops[k]].tolist()
            if not v.unigram:
                some = self._with_spaces(spaces[k], texts[k], some)
            some = self._spelt(some)
            extra.extend(some)
            extra_counts.append(len(some))
        known = len(self.starts)
        self.places.update((keys[k], known + place) for place, k in enumerate(
            np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]).tolist()))
        counts = np.concatenate([counts[~odd], np.array(extra_counts, np.int64)])
        ids = np.concatenate([ids[~np.repeat(odd, np.diff(stops, prepend=0))], np.array(extra, np.int64)])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def _with_spaces(self, n_spaces: int, word: str, ids: list[int]) -> list[int]:
        """BPE merges the spaces that no word took last, the leftmost two that make a piece first."""
        runs = self.v.space_runs
        bare = n_spaces - 1
        if not word:
            bare, ids = n_spaces, []
        elif ids[0] == runs[1]:
            bare, ids = n_spaces, ids[1:]
        sizes: list[int] = []
        for _ in range(bare):
            sizes.append(1)
            while len(sizes) > 1 and sizes[-2] + sizes[-1] in runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return [runs[size] for size in sizes] + ids

    def _spelt(self, ids: list[int]) -> list[int]:
        """Unknown letters as the ids of their bytes, or as one unknown id for each run."""
        out: list[int] = []
        for no in ids:
            if no >= 0:
                out.append(no)
            elif len(self.v.byte_ids):
                letter = chr(-1 - no) if no != -1 - NUL else "\0"
                out.extend(self.v.byte_ids[[*letter.encode("utf-8", "surrogatepass")]].tolist())
            elif not out or out[-1] != self.v.unknown:
                out.append(self.v.unknown)
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and where each row's begin (one more at the end); null and empty texts have none."""
        column = pc.replace_substring(column, SPACE, " ")
        data, offsets = words.text_bytes(column)
        n = len(column)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(n + 1, np.int64)
        starts, ends, first = words.word_bounds(data, offsets, _SEPARATORS)
        sums = words.prefix_sums(data, words.PLAIN)
        # Spaces before each word, with the one that is put before every text, and behind the last.
        before = np.concatenate([[0], ends])[:-1] if len(ends) else ends
        has = np.diff(first) > 0
        before[first[:-1][has]] = offsets[:-1][has] - 1
        tail = np.where(has, ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0, offsets[:-1] - 1)
        rest = np.flatnonzero((offsets[1:] > tail) & (np.diff(offsets) > 0))
        begin = np.concatenate([starts, offsets[1:][rest]])
        end = np.concatenate([ends, offsets[1:][rest]])
        spaces = np.concatenate([starts - before, (offsets[1:] - tail)[rest]])
        order = np.argsort(np.concatenate([2 * starts, 2 * offsets[1:][rest] - 1]), kind="stable")
        begin, end, spaces = begin[order], end[order], spaces[order]
        row = np.searchsorted(offsets, np.where(end > begin, begin, begin - 1), "right") - 1
        keys = words.mix(words.range_hashes(sums, begin, end) + spaces.astype(np.uint64) * words.PLACES[7])
        unique, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.places) > REMEMBERED:
            self.forget()
        listed = unique.tolist()
        new = [k for k, key in enumerate(listed) if key not in self.places]
        if new:
            whole = data.tobytes()
            at = index[new]
            self._learn([listed[k] for k in new], spaces[at].tolist(), [
                whole[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begin[at].tolist(), end[at].tolist())])
        place = np.fromiter((self.places[key] for key in listed), np.int64, len(listed))[inverse]
        counts = self.counts[place]
        stops = np.cumsum(counts)
        ids = self.ids[np.arange(stops[-1]) + np.repeat(self.starts[place] - (stops - counts), counts)]
        per_row = np.bincount(row, weights=counts, minlength=n).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_row)])


def decoded(ids: np.ndarray, first: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The texts that rows of ids stand for; bytes that are no UTF-8 become replacement characters."""
    spelt = np.frombuffer(b"".join(vocabulary.spellings), np.uint8)
    sizes = np.array([len(s) for s in vocabulary.spellings])
    counts = sizes[ids]
    stops = np.cumsum(counts)
    letters = spelt[np.arange(stops[-1] if len(stops) else 0)
                    + np.repeat((np.cumsum(sizes) - sizes)[ids] - (stops - counts), counts)].tobytes()
    bounds = np.concatenate([[0], stops])[first].tolist()
    return [letters[a + letters.startswith(b" ", a, b):b].decode("utf-8", "replace")
            for a, b in zip(bounds, bounds[1:])]



def encode(documents: DataFrame, model_path: str = MODEL, text_column: str = "text", into: str = "ids",
           keep: list[str] | None = None, check: str | None = None) -> DataFrame:
    """The columns `keep` (all by default) and the piece ids of the whole text, as SentencePiece gives them.

    Null text has null ids, empty text none. U+2581 counts as a space. `check` names a further boolean column that
    says whether decoding the ids gives the text back (null for null). Columns with these names are replaced.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(read_model(spark, model_path)))
    columns = [c for c in (keep or documents.columns) if c not in (into, check)]
    rows = documents.select(*[F.col(f"`{c}`") for c in columns], F.col(text_column).alias("_text_to_encode"))

    def encoded(batches):
        encoder = Encoder(shared.value)
        for batch in words.portions(batches, "_text_to_encode", _PORTION):
            text = batch.column("_text_to_encode")
            ids, first = encoder.encode(text)
            missing = text.is_null()
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids), mask=missing)
            extra = [lists]
            if check:
                back = pa.array(decoded(ids, first, shared.value), pa.string())
                extra.append(pc.equal(back, pc.replace_substring(text, SPACE, " ")))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *extra],
                                             names=[*columns, into, *([check] if check else [])])

    schema = rows.drop("_text_to_encode").schema.add(into, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(encoded, schema.add(check, "boolean") if check else schema)


def decode(documents: DataFrame, model_path: str = MODEL, ids_column: str = "ids", into: str = "text") -> DataFrame:
    """All columns and the text that the ids stand for (null for null ids)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(read_model(spark, model_path)))
    columns = [c for c in documents.columns if c != into]
    rows = documents.select(*[F.col(f"`{c}`") for c in columns], F.col(ids_column).alias("_ids_to_decode"))

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, words.ROWS):
                part = batch.slice(at, words.ROWS)
                ids = part.column("_ids_to_decode")
                counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                texts = decoded(ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)]),
                                shared.value)
                texts = pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=[*columns, into])

    return rows.mapInArrow(read, rows.drop("_ids_to_decode").schema.add(into, "string"))
