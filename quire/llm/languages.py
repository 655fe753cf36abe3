"""Language of spans and texts: script ranges narrow the candidates, Viterbi over words with a switching penalty."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm import words

#: Texts to learn from for each language, about; they are taken by a hash of the text.
TEXTS_PER_LANGUAGE = 2_000
#: Hashed character n-grams of 1 to ORDERS letters, with a border on either side of a word (so ORDERS is 3 at most).
BITS, ORDERS = 17, 3
SMOOTHING = 0.5
#: Log-likelihood that a change of language must gain.
SWITCH = 6.0
#: Share of a language's letters that a script must have to be one of the language's.
SCRIPT_SHARE = 0.01
_PORTION = 1 << 19

# Ranges of code points of scripts, as Unicode's blocks have them. 0 is no letter, 1 any other script.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
_LAST = 0x323B0
_tables: list[np.ndarray] = []


def letter_tables() -> list[np.ndarray]:
    """Script number and lower case of each code point, made on first use."""
    if not _tables:
        script, lower = np.zeros(_LAST + 1, np.uint8), np.arange(_LAST + 1)
        letters = [c for c in range(_LAST) if chr(c).isalpha()]
        script[letters] = 1
        for number, ranges in enumerate(SCRIPTS.values(), 2):
            for a, b in ranges:
                script[a:b + 1][script[a:b + 1] > 0] = number
        for c in letters:
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        _tables.extend([script, lower])
    return _tables


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray   # log-likelihoods by slot and language
    allowed: np.ndarray   # by script and language


class Words(NamedTuple):
    """Words of a portion: runs of letters of one script."""
    starts: np.ndarray    # code points from the start of the row
    sizes: np.ndarray
    scripts: np.ndarray
    first: np.ndarray     # each row's first word (one more at the end)
    kinds: np.ndarray     # which distinct word each is
    slots: list           # for each order, the n-grams of the distinct words, borders between words included
    bounds: list          # and where each word's n-grams start and end


def split_words(column: pa.Array) -> Words:
    """Words of all rows, and the hashed n-grams of each distinct one."""
    data, offsets = words.text_bytes(column)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    script, lower = letter_tables()
    points = np.minimum(points, _LAST).astype(np.int64)
    kind = script[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[at] = True
    change = np.ones(len(points) + 1, bool)
    change[1:-1] = (kind[1:] != kind[:-1]) | edge[1:-1]
    bounds = np.flatnonzero(change)
    some = np.flatnonzero(kind[bounds[:-1]] > 0) if len(points) else np.empty(0, np.int64)
    starts, ends = bounds[some], bounds[some + 1] if len(some) else bounds[some]
    sizes = ends - starts
    small = lower[points]
    first = np.searchsorted(starts, at)
    sums = np.zeros(len(small) + 1, np.uint64)
    np.cumsum(words.mix(small.astype(np.uint64) + words.PLACES[0]) * words.powers(words.BASE, len(small)), out=sums[1:])
    hashes = words.range_hashes(sums, starts, ends)
    _, index, kinds = np.unique(hashes, return_index=True, return_inverse=True)
    # The distinct words, each with a border before and after.
    n = sizes[index] + 2
    stops = np.cumsum(n)
    text = np.full(stops[-1] if len(n) else 0, 0x20, np.uint32)
    inner = np.arange(len(text)) - np.repeat(stops - n, n)
    body = (inner > 0) & (inner < np.repeat(n, n) - 1)
    text[body] = small[(np.repeat(starts[index], n) + inner - 1)[body]]
    slots, bounds = [], []
    for order in range(1, ORDERS + 1):
        gram = np.full(max(len(text) - order + 1, 0), order, np.uint32)
        for j in range(order):
            gram = (gram ^ text[j:len(gram) + j]) * np.uint32(0x9E3779B1)
            gram ^= gram >> np.uint32(15)
        slots.append(gram >> np.uint32(32 - BITS))
        skip = order == 1
        bounds.append((stops - n + skip, stops - order + 1 - skip))
    rows = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(starts - at[rows], sizes, kind[starts], first, kinds, slots, bounds)


def word_scores(found: Words, weights: np.ndarray) -> np.ndarray:
    """Log-likelihood of each distinct word in each language, an average over the orders."""
    total = 0
    for slots, (low, high) in zip(found.slots, found.bounds):
        values = np.concatenate([weights[slots], np.zeros((1, weights.shape[1]), weights.dtype)])
        total = total + np.add.reduceat(values, np.stack([low, high], axis=1).ravel(), axis=0)[::2]
    return total / ORDERS


def _count(batches):
    """(lang, slot, n) of a task's texts; slots below 0 are letters of script -1 - slot."""
    totals: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in words.portions(batches, "text", _PORTION):
        found = split_words(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), object)
        of_word = np.repeat(langs, np.diff(found.first))
        n_kinds = len(found.bounds[0][0])
        for lang in set(langs.tolist()):
            mine = of_word == lang
            times = np.bincount(found.kinds[mine], minlength=n_kinds)
            counts = np.zeros(1 << BITS, np.int64)
            for slots, (low, high) in zip(found.slots, found.bounds):
                weight = np.zeros(len(slots) + 1)
                np.add.at(weight, low, times)
                np.subtract.at(weight, high, times)
                counts += np.bincount(slots, weights=np.cumsum(weight[:-1]), minlength=1 << BITS).astype(np.int64)
            totals[lang] = totals.get(lang, 0) + counts
            scripts[lang] = scripts.get(lang, 0) + np.bincount(
                found.scripts[mine], weights=found.sizes[mine], minlength=len(SCRIPTS) + 2).astype(np.int64)
    for lang, counts in totals.items():
        some, kinds = np.flatnonzero(counts), np.flatnonzero(scripts[lang])
        slots = np.concatenate([some, -1 - kinds])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(slots), pa.string()), pa.array(slots.astype(np.int32)),
             pa.array(np.concatenate([counts[some], scripts[lang][kinds]]))], ["lang", "slot", "n"])


def fit(documents: DataFrame, lang_column: str = "lang", text_column: str = "text",
        texts_per_language: int = TEXTS_PER_LANGUAGE) -> Model:
    """A model of the languages in `lang_column`, from about texts_per_language texts of each.

    The bound is by language, so rare ones are learned whole. Null texts and languages are left out. Counts of hashed
    n-grams are summed by Spark; what reaches the driver is bounded by the hash range times the languages.
    """
    rows = documents.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    sizes = {lang: n for lang, n in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros((len(SCRIPTS) + 2, 0), bool))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (
        F.lit(lang), F.lit(round(min(1.0, texts_per_language / n) * (1 << 20))))])
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")])
    counts = sample.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")).toArrow()
    languages = sorted(sizes)
    place = {lang: k for k, lang in enumerate(languages)}
    slot = counts["slot"].to_numpy()
    column = np.array([place[lang] for lang in counts["lang"].to_pylist()], np.int64)
    n = counts["n"].to_numpy()
    grams = slot >= 0
    weights = np.full((1 << BITS, len(languages)), SMOOTHING)
    weights[slot[grams], column[grams]] += n[grams]
    scripts = np.zeros((len(SCRIPTS) + 2, len(languages)))
    scripts[-1 - slot[~grams], column[~grams]] = n[~grams]
    return Model(languages, np.log(weights / weights.sum(axis=0)).astype(np.float32),
                 scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))


def _steady(scores: np.ndarray, first: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """Each row's language of the largest sum, and whether no path with a change can be better than it alone.

    A stretch in other languages gains at most the sum of their best scores less this one's, and costs two changes, or
    one at the beginning or end of a row. So no stretch may gain as much.
    """
    n = len(first) - 1
    sums = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0, dtype=np.float64)])
    best = (sums[first[1:]] - sums[first[:-1]]).argmax(axis=1)
    row = np.repeat(np.arange(n), np.diff(first))
    place = np.arange(len(scores))
    own = scores[place, best[row]]
    others = scores.copy()
    others[place, best[row]] = -np.inf
    gain = np.maximum(others.max(axis=1) - own, -1e6).astype(np.float64)
    total = np.concatenate([[0], np.cumsum(gain)])
    start = total[first[:-1]][row]
    through = total[1:] - start
    # The least sum before each word of a row: later rows are shifted far down, so that none looks back into another.
    shift = -row * (np.abs(total).max() * 2 + 1)
    least = np.minimum.accumulate(total[:-1] - start + shift) - shift
    ok = np.ones(n, bool)
    ending = (total[first[1:]] - total[first[:-1]])[row] - (total[:-1] - start)
    bad = (through >= switch) | (through - least >= 2 * switch) | (ending >= switch)
    ok[row[bad]] = False
    return best, ok


def best_path(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of every word: the path of the largest sum of scores, less `switch` for each change.

    Rows that stay in one language for certain are settled at once. The others advance together, word by word, the
    longest first in the arrays so that the ones at work lie in front.
    """
    path = np.zeros(len(scores), np.int16)
    if not len(scores):
        return path
    best, steady = _steady(scores, first, switch)
    path[:] = np.repeat(best, np.diff(first))
    sizes = np.where(steady, 0, np.diff(first))
    order = np.argsort(-sizes, kind="stable")
    order = order[:np.count_nonzero(sizes)]
    sizes, first = sizes[order], first[:-1][order]
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    sums = np.zeros((len(sizes), scores.shape[1]))
    stays, origin = np.ones(scores.shape, bool), np.zeros(len(scores), np.int16)
    rows = np.arange(len(sizes))
    for t, k in enumerate(active):
        at, have = first[:k] + t, sums[:k]
        if t:
            top = have.argmax(axis=1)
            moved = have[rows[:k], top][:, None] - switch
            stays[at], origin[at] = have >= moved, top
            have = np.maximum(have, moved)
        sums[:k] = have + scores[at]
    state = sums.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        path[at] = state[:k]
        state[:k] = np.where(stays[at, state[:k]], state[:k], origin[at])
    return path


def identify(documents: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None,
             with_spans: bool = True) -> DataFrame:
    """The columns `keep` (all by default), lang_pred, score, and spans of one language (start, end, lang).

    Words are runs of letters of one script. Only languages that use the script are candidates for a word; a script
    that no language uses says nothing. lang_pred is the language whose spans have the most letters, score its share
    of all letters (letters of unknown scripts count as no language's). `und` and 0 for null text, text without
    letters, and an empty model. Spans are in code points and run from a first to a last word; they are null for null.
    Columns of these names are replaced. Whole texts are read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    made = ["lang_pred", "score", *(["spans"] if with_spans else [])]
    columns = [c for c in (keep or documents.columns) if c not in made]
    rows = documents.select(*[F.col(f"`{c}`") for c in columns], F.col(text_column).alias("_text_to_identify"))

    def identified(batches):
        languages, weights, allowed = shared.value
        for batch in words.portions(batches, "_text_to_identify", _PORTION):
            text = batch.column("_text_to_identify")
            found = split_words(text)
            n, n_lang = len(batch), len(languages)
            row = np.repeat(np.arange(n), np.diff(found.first))
            path = np.zeros(len(row), np.int16)
            shares = np.zeros((n, max(n_lang, 1)))
            if n_lang and len(row):
                scores = word_scores(found, weights)[found.kinds]
                can = allowed[found.scripts]
                known = can.any(axis=1)
                scores = np.where(can, scores, -1e6)
                scores[~known] = 0
                path = best_path(scores.astype(np.float32), found.first)
                shares = np.bincount(row * n_lang + path, weights=found.sizes * known,
                                     minlength=n * n_lang).reshape(n, n_lang)
            letters = np.bincount(row, weights=found.sizes, minlength=n)
            best = shares.argmax(axis=1)
            names = [languages[b] if n_lang and has else "und" for b, has in zip(best.tolist(), letters > 0)]
            share = shares[np.arange(n), best] / np.maximum(letters, 1)
            out = [pa.array(names, pa.string()), pa.array(share)]
            if with_spans:
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (path[1:] != path[:-1])
                begins = np.flatnonzero(new) if n_lang else np.empty(0, np.int64)
                lasts = np.append(begins[1:], len(row))[:len(begins)] - 1
                structs = pa.StructArray.from_arrays(
                    [pa.array(found.starts[begins]), pa.array(found.starts[lasts] + found.sizes[lasts]),
                     pa.array([languages[p] for p in path[begins].tolist()], pa.string())], ["start", "end", "lang"])
                out.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(row[begins], np.arange(n + 1)).astype(
                    np.int32)), structs, mask=text.is_null()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*columns, *made])

    kinds = {"lang_pred": "string", "score": "double", "spans": "array<struct<start:bigint,end:bigint,lang:string>>"}
    described = [*rows.drop("_text_to_identify").schema.fields]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in described),
                        *(f"{name} {kinds[name]}" for name in made)])
    return rows.mapInArrow(identified, schema)
