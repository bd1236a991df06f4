"""Language of a text by cross-parsing entropy.

A text is parsed with the labelled text of each language: phrase by phrase, each the
longest one that occurs there. The fewer phrases, the closer the text. Suffix automata
give the longest matches; their steps are laid out as one hash table of what there is, so that many
texts are parsed side by side and a large alphabet costs no more than a small one. Bits for each symbol, phrases *
log2(labelled symbols) / symbols, make languages with different amounts of labelled text comparable.

What is learned from is bounded: ``SAMPLE_TEXTS`` labelled texts of a language, those of smallest hashes of their
ids, and ``SAMPLE_SYMBOLS`` symbols of them together. Each gives its share in pieces spread evenly over its whole
length.

Symbols are lower-case letters, of all planes; runs of all else are one blank. Texts are parsed in runs
of ``RUN`` symbols, a phrase ending with each run. A text that is null or has no letter is
``und`` with score 0, as is every text if nothing is labelled; ``lettered`` tells these apart. Ties go to the language
that sorts first. Very long texts are parsed whole. Repeated rows are scored alike; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtally.llm import textbytes

UNDETERMINED = "und"

# The bound of what is learned from: so many labelled texts of a language at most, and so
# many symbols of them together.
SAMPLE_TEXTS = 60
SAMPLE_SYMBOLS = 30_000

# Symbols of a piece of a labelled text.
PIECE = 500

RUN = 256
# Runs parsed side by side.
ABREAST = 4096
# How fast the score falls with the distance to the best language, in bits for each symbol.
SHARPNESS = 6.0

BLANK = 0
FREE = -1


@cache
def _letters() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


class Symbols(NamedTuple):
    codes: np.ndarray
    sizes: np.ndarray
    lettered: np.ndarray


def symbols(texts: list[str | None]) -> Symbols:
    """Code points of the letters of each text in lower case, blanks between runs of them."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    codes = np.where(letter, points, BLANK).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    text = np.repeat(np.arange(len(texts)), sizes)
    count = len(texts)
    lettered = np.bincount(text[letter], minlength=count) > 0
    return Symbols(codes[keep], np.bincount(text[keep], minlength=count), lettered)


class Model(NamedTuple):
    """Steps of all languages' automata: ``after[k]`` follows where ``steps[k]`` is state * width + symbol.

    ``fresh`` has the steps from each language's start, for all symbols.
    """

    languages: list[str]
    roots: np.ndarray
    bits: np.ndarray
    alphabet: np.ndarray
    fresh: np.ndarray
    steps: np.ndarray
    after: np.ndarray


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    """Where keys are looked for first, in a table whose size is a power of two."""
    spread = keys.astype(np.int64).view(np.uint64) * np.uint64(textbytes.RADIX)
    return (spread >> np.uint64(65 - size.bit_length())).view(np.int64)


def _hashed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An open hash table, at most two fifths full, whose keys are in the first free slot from their own."""
    size = 1 << max(4, int(len(keys) * 2.5).bit_length())
    table, held = np.full(size, FREE, np.int64), np.zeros(size, np.int32)
    slot = _slots(keys, size)
    while len(keys):
        first = np.zeros(len(keys), bool)
        first[np.unique(slot, return_index=True)[1]] = True
        first &= table[slot] == FREE
        table[slot[first]], held[slot[first]] = keys[first], values[first]
        keys, values, slot = keys[~first], values[~first], (slot[~first] + 1) & (size - 1)
    return table, held


def _following(model: Model, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The state after each, and whether there is one."""
    key = state * np.int64(len(model.alphabet) + 1) + symbol
    slot = _slots(key, len(model.steps))
    there = model.steps[slot]
    known = there == key
    open_ = np.flatnonzero(~known & (there != FREE))
    if not len(open_):
        return model.after[slot], known
    while len(open_):
        slot.flat[open_] = (slot.flat[open_] + 1) & (len(model.steps) - 1)
        there.flat[open_] = model.steps[slot.flat[open_]]
        open_ = open_[(there.flat[open_] != key.flat[open_]) & (there.flat[open_] != FREE)]
    return model.after[slot], there == key


def _automaton(codes: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of a sequence: its states' transitions, the start being 0."""
    follow, link, length = [{}], [-1], [0]
    last = 0
    for code in codes:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in follow[at]:
            follow[at][code] = new
            at = link[at]
        if at >= 0:
            to = follow[at][code]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(follow)
                follow.append(dict(follow[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and follow[at].get(code) == to:
                    follow[at][code] = twin
                    at = link[at]
                link[to] = link[new] = twin
        last = new
    return follow


def spread(codes: np.ndarray, most: int, piece: int = PIECE) -> np.ndarray:
    """At most ``most`` symbols, in pieces that lie evenly over all of them."""
    if len(codes) <= most:
        return codes
    piece = min(piece, most)
    count = most // piece
    starts = np.linspace(0, len(codes) - piece, count).astype(np.int64)
    parts = [codes[at : at + piece - 1] for at in starts.tolist()]
    return np.concatenate([x for p in parts for x in (p, np.array([BLANK], np.uint32))])


def learn(labelled: dict[str, list[str]], most: int = SAMPLE_SYMBOLS) -> Model:
    """From some texts of each language."""
    samples = {}
    for language, texts in sorted(labelled.items()):
        parsed = symbols(texts)
        ends = np.cumsum(parsed.sizes)
        share = -(-most // max(1, len(texts)))
        parts = [spread(parsed.codes[e - n : e], share) for e, n in zip(ends.tolist(), parsed.sizes.tolist(), strict=True)]
        whole = np.concatenate([x for p in parts for x in (p, [BLANK])]) if parts else np.zeros(0, np.uint32)
        if parsed.lettered.any():
            samples[language] = whole[:most]
    everything = np.concatenate(list(samples.values())) if samples else np.zeros(1, np.uint32)
    alphabet = np.unique(np.append(everything, BLANK)).astype(np.uint32)
    width = len(alphabet) + 1  # one more: a symbol seen nowhere
    fresh, keys, values, roots, bits, base = [], [], [], [], [], 0
    for whole in samples.values():
        states = _automaton(np.searchsorted(alphabet, whole).tolist())
        roots.append(base)
        bits.append(np.log2(max(2, len(whole))))
        begin = np.full(width, base, np.int32)
        for symbol, to in states[0].items():
            begin[symbol] = base + to
        fresh.append(begin)
        keys += [np.fromiter(follow, np.int64, len(follow)) + (base + at) * width for at, follow in enumerate(states)]
        values += [np.fromiter(follow.values(), np.int64, len(follow)) + base for follow in states]
        base += len(states)
    steps, after = _hashed(*(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, values)))
    first = np.stack(fresh) if fresh else np.zeros((0, width), np.int32)
    return Model(list(samples), np.array(roots, np.int64), np.array(bits), alphabet, first, steps, after)


def entropies(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bits for each symbol by text and language, and which texts have letters."""
    parsed = symbols(texts)
    place = np.searchsorted(model.alphabet, parsed.codes)
    place[place == len(model.alphabet)] = 0
    unseen = model.alphabet[place] != parsed.codes
    coded = np.where(unseen, len(model.alphabet), place)
    languages = np.arange(len(model.languages))[:, None]
    runs = -(-parsed.sizes // RUN)
    text_of = np.repeat(np.arange(len(texts)), runs)
    number = np.arange(len(text_of)) - np.repeat(np.cumsum(runs) - runs, runs)
    first = (np.cumsum(parsed.sizes) - parsed.sizes)[text_of] + number * RUN
    size = np.minimum(parsed.sizes[text_of] - number * RUN, RUN)
    phrases = np.zeros((len(texts), len(model.languages)))
    for at in range(0, len(text_of), ABREAST):
        some = slice(at, at + ABREAST)
        order = np.argsort(-size[some], kind="stable")
        begin, length = first[some][order], size[some][order]
        state = np.repeat(model.roots[:, None], len(begin), axis=1)
        breaks = np.zeros(state.shape, np.int64)
        active = np.searchsorted(-length, -np.arange(1, RUN + 1), "right")
        for k in range(int(length[0])):
            upto = active[k]
            now, symbol = state[:, :upto], coded[begin[:upto] + k]
            after, known = _following(model, now, symbol[None, :])
            # A phrase begins at the start, and where the one before cannot go on.
            breaks[:, :upto] += ~known | (now == model.roots[:, None])
            state[:, :upto] = np.where(known, after, model.fresh[languages, symbol])
        np.add.at(phrases, text_of[some][order], breaks.T)
    return phrases * model.bits / np.maximum(1, parsed.sizes)[:, None], parsed.lettered


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and bits for each symbol of every text, and whether it has a letter."""
    if not model.languages:
        nothing = np.zeros(len(texts))
        return [UNDETERMINED] * len(texts), nothing, nothing, symbols(texts).lettered
    bits, lettered = entropies(model, texts)
    best = bits.argmin(axis=1)
    least = bits.min(axis=1)
    score = 1 / np.exp2(SHARPNESS * (least[:, None] - bits)).sum(axis=1)
    names = [model.languages[b] if x else UNDETERMINED for b, x in zip(best, lettered, strict=True)]
    return names, np.where(lettered, score, 0.0), np.where(lettered, least, 0.0), lettered


def held_out(doc_id: Column) -> Column:
    """Rows nothing is learned from: those whose id's crc32 leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> dict[str, list[str]]:
    """A bounded number of labelled texts of each language, the same ones each time."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    ids = usable.where(~held_out(F.col("doc_id"))).select("lang", "doc_id", F.xxhash64("doc_id").alias("order"))
    ranked = ids.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id")))
    ranked = ranked.where(F.col("n") <= texts)
    shares = ranked.groupBy("lang").agg(F.ceil(F.lit(SAMPLE_SYMBOLS) / F.count("*")).cast("int").alias("share"))
    # So many ids for each language.
    chosen = F.broadcast(ranked.join(shares, "lang").select("lang", "doc_id", "n", "share"))
    rows = usable.select("lang", "doc_id", "text").join(chosen, ["lang", "doc_id"]).select("lang", "n", "share", "text")
    out: dict[str, list[str]] = {}
    for language, _, text in sorted(map(tuple, rows.mapInArrow(_pieces, "lang string, n int, text string").collect())):
        out.setdefault(language, []).append(text)
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's share of symbols, as a text; what comes to the driver is bounded by it."""
    for batch in batches:
        parts = []
        for text, share in zip(batch.column("text"), batch.column("share").to_pylist(), strict=True):
            codes = spread(symbols([text.as_py()]).codes, share)
            parts.append(np.where(codes == BLANK, ord(" "), codes).astype("<u4").tobytes().decode("utf-32-le"))
        columns = [batch.column("lang"), batch.column("n"), pa.array(parts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "text"])


def _label(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang_pred", "score", "bits", "lettered"]
        for batch in batches:
            texts, at, found = batch.column("text").to_pylist(), 0, []
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto] or "") < 1 << 20):
                    size += len(texts[upto] or "")
                    upto += 1
                found.append(predict(model.value, texts[at:upto]))
                at = upto
            columns = [
                pa.array([x for part in found for x in part[0]], pa.string()),
                pa.array(np.concatenate([part[1] for part in found]) if found else [], pa.float64()),
                pa.array(np.concatenate([part[2] for part in found]) if found else [], pa.float64()),
                pa.array(np.concatenate([part[3] for part in found]) if found else [], pa.bool_()),
            ]
            kept = [n for n in batch.schema.names if n not in names]
            arrays = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays(arrays + columns, names=kept + names)

    return run


def fitted(docs: DataFrame) -> Model:
    return learn(sample(docs))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``lang_pred, score, bits, lettered``; columns of these names are replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score", "bits", "lettered")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(_label(shipped), f"{fields}, lang_pred string, score double, bits double, lettered boolean")
