"""Benchmark decontamination by templates: numbers, names and units become typed places.

A text and a benchmark item are cut into windows of tokens in which numbers, names and units are
replaced by ``<number>``, ``<name>`` and ``<unit>``. Windows are joined on the template itself, so the
same question with other values meets its original; what stood in the places must then correspond one
to one (two places that hold the same value in one text do so in the other). Templates that are mostly
places prove nothing and are left out on both sides. Next to its template every window is read by its
literal forms in lower case, whatever its kinds: a verbatim passage is found in capitals too, and when it
is dense in numbers and names.

Templates have two readings, and either may match. In the first a capital at the start of a sentence says
nothing; in the second the word alone decides: capitalised words are names unless they are common ones, so
that questions whose sentences begin with names match, and what stands before a passage changes nothing.
An item shorter than a window must have the literals of a whole one, or be found verbatim, or fill a line
or a sentence of the text.

A bitmap of fixed size that holds every template window of the benchmark goes to the workers, so that
only windows that may match leave them, whatever the size of either table; the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept

WINDOW = 10
#: Literal words a window needs, as a share of its length.
LITERAL_SHARE = 0.6
#: The bitmap has 2 ** BITMAP_BITS bits (16 MB), at every size of the benchmark.
BITMAP_BITS = 27
_CHUNK_BITS = 15
CACHE_WORDS = 500_000

# Words that count as numbers and as units of measure.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNIT_WORDS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons pound pounds ounce ounces ml l litre litres "
    "liter liters s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars euro euros cent cents usd eur gbp kmh mph watt watts volt volts".split()
)

#: Words that are no names in capitals either.
COMMON_WORDS = frozenset(
    "a an the this that these those there here he she it we they you i his her its their our your my him them us me if when "
    "while after before since because although though as at by for from in into of off on onto over under up down out to with "
    "without about around per between through during until how what which who whom whose why where and or but nor so then now "
    "once again both each every all any some many much most more few less least no not only other another such same than too "
    "very first second third last next finally also suppose assume given let find compute calculate determine solve show prove "
    "write choose is are was were be been being has have had do does did can could will would shall should may might must today "
    "tomorrow yesterday however therefore thus hence together yes please "
    "le la les un une des de du et en dans que qui il elle el los las y der die das ein eine und".split()
)
#: Tokens from which an item shorter than a window counts wherever it is found verbatim.
FREE_WORDS = 4

_core = regex.compile(r"^[^\p{L}\p{N}]*(.*?)[^\p{L}\p{N}]*$", regex.S)
_number = regex.compile(r"[\p{Sc}+-]?\p{Nd}+(?:[.,:/]\p{Nd}+)*(?:%|st|nd|rd|th)?$")
_LITERAL, _NUMBER, _UNIT, _NAME = 0, 1, 2, 3
_VERBATIM = 5  # of every token in the reading without places
_COMMON = 8  # the token is a common word
_ENDS = 4  # the token closes a sentence, so the next one's capital says nothing
_PLACES = {_NUMBER: "<number>", _UNIT: "<unit>", _NAME: "<name>"}


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8"), 5)


class Tokens:
    """Kinds and forms of tokens; a bounded table of words seen."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int, int]] = {}
        self.place = {kind: _hash(name) for kind, name in _PLACES.items()}

    def look(self, token: str) -> tuple[int, int, int]:
        """(hash of the literal form, kind as far as the token alone tells, whether it ends a sentence and is common)"""
        core = self.form(token)
        low = core.lower()
        if _number.match(core) or low in NUMBER_WORDS:
            kind = _NUMBER
        elif low in UNIT_WORDS:
            kind = _UNIT
        elif core[:1].isupper() and len(core) > 1:
            kind = _NAME
        else:
            kind = _LITERAL
        ends = token.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", ";", "…")
        out = (_hash(low), kind, ends * _ENDS | (low in COMMON_WORDS) * _COMMON)
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        self.known[token] = out
        return out

    @staticmethod
    def form(token: str) -> str:
        """The token without punctuation around it (punctuation alone stays as it is)."""
        return _core.match(token)[1] or token

    def ends(self, tokens: list[str]) -> np.ndarray:
        """Per token whether it ends a sentence."""
        known, look = self.known, self.look
        return np.fromiter(((known.get(t) or look(t))[2] & _ENDS > 0 for t in tokens), bool, len(tokens))

    def read(self, tokens: list[str], starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The readings: per token the hash of its form and its kind; ``starts`` are the texts' first tokens."""
        known, look = self.known, self.look
        rows = [known.get(t) or look(t) for t in tokens]
        literal = np.fromiter((r[0] for r in rows), np.uint64, len(rows))
        kind = np.fromiter((r[1] for r in rows), np.int8, len(rows))
        flags = np.fromiter((r[2] for r in rows), np.int8, len(rows))
        opens = starts[starts < len(rows)]
        first = np.zeros(len(rows), bool)
        first[1:] = flags[:-1] & _ENDS > 0
        first[opens] = True
        after_number = np.zeros(len(rows), bool)
        after_number[1:] = kind[:-1] == _NUMBER
        after_number[opens] = False
        kind = np.where((kind == _UNIT) & ~after_number, _LITERAL, kind)
        out = []
        for no_name in (first, flags & _COMMON > 0):
            own = np.where((kind == _NAME) & no_name, _LITERAL, kind)
            form = literal.copy()
            for k, value in self.place.items():
                form[own == k] = value
            out.append((form, own))
        return [*out, (literal, np.full(len(rows), _VERBATIM, np.int8))]


def _windows(
    readings: list[tuple[np.ndarray, np.ndarray]], ends: np.ndarray, length: int, window: int, whole=None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """By reading the starts and hashes of the windows of ``length`` tokens; what an earlier reading gives is left out.

    ``ends``: end of each token's text. Templates need enough literals, the verbatim reading does not. Below a
    whole ``window`` templates need the literals of a whole one and the verbatim reading some words, but where
    ``whole(length)`` tells that the window fills a line or a sentence (None: always, as in the item itself).
    """
    out: list[tuple[np.ndarray, np.ndarray]] = []
    earlier: list[tuple[np.ndarray, np.ndarray]] = []
    n = len(ends) - length + 1
    content, filled = None, True if length >= window or whole is None or n <= 0 else whole(length)
    for form, kind in readings if n > 0 else []:
        value, literals = _hashes(form, kind, length, n)
        if content is None:
            content = literals > 0
        if length and kind[0] == _VERBATIM:
            good = filled | content & (length >= FREE_WORDS)
        else:
            good = (literals >= LITERAL_SHARE * length) & (filled | (literals >= LITERAL_SHARE * window))
        good = good & (np.arange(n) + length <= ends[:n])
        for seen, was in earlier:
            good &= ~(was & (seen == value))
        earlier.append((value, good))
        at = np.flatnonzero(good)
        out.append((at, value[at]))
    return out


def _filling(batch: pa.RecordBatch, tokens: list[str], limits: np.ndarray, flags: np.ndarray):
    """Tells of the windows of a length whether they begin and end with lines or sentences of their text."""
    opens, closes = np.zeros(len(tokens) + 1, bool), flags.copy()
    for text, at in zip(batch.column(1).to_pylist(), limits, strict=False):
        for line in text.encode("utf-8").splitlines() if text else []:
            opens[at] = True
            at += len(line.split())
            closes[at - 1 : at] = True
    opens[1:] |= closes

    def whole(length: int) -> np.ndarray:
        n = len(tokens) - length + 1
        return opens[:n] & closes[length - 1 :]

    return whole


def _hashes(form: np.ndarray, kind: np.ndarray, length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that begin at the first ``n`` tokens the hash and the number of literals."""
    value = np.zeros(n, np.uint64)
    literals = np.zeros(n, np.int16)
    for i in range(length):
        value = value * np.uint64(0x9E3779B97F4A7C15) + form[i : i + n]
        literals += kind[i : i + n] == _LITERAL
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value, literals


def _template(tokens: list[str], kind: np.ndarray, start: int, length: int) -> tuple[str, list[str]]:
    words, slots = [], []
    for i in range(start, start + length):
        place = _PLACES.get(int(kind[i]))
        low = Tokens.form(tokens[i]).lower()
        words.append(place or low)
        if place:
            slots.append(low)
    return " ".join(words), slots


def _texts(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All tokens of a batch's texts, each text's first token, and the end of each token's text."""
    tokens: list[str] = []
    bounds = [0]
    for text in batch.column(1).to_pylist():
        tokens += [t.decode("utf-8") for t in text.encode("utf-8").split()] if text else []
        bounds.append(len(tokens))
    limits = np.array(bounds, dtype=np.int64)
    return tokens, limits, np.repeat(limits[1:], np.diff(limits))


_SCHEMA = "id long, start long, length int, template string, slots array<string>"


def _rows(ids: list, starts: list, lengths: list, templates: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(starts, pa.int64()),
            pa.array(lengths, pa.int32()),
            pa.array([t[0] for t in templates], pa.string()),
            pa.array([t[1] for t in templates], pa.list_(pa.string())),
        ],
        names=["id", "start", "length", "template", "slots"],
    )


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    reader = Tokens()
    for batch in batches:
        tokens, limits, ends = _texts(batch)
        readings = reader.read(tokens, limits)
        for i in range(batch.num_rows):
            a, b = int(limits[i]), int(limits[i + 1])
            length = min(window, b - a)
            if not length:
                continue
            item = [(form[a:b], kind[a:b]) for form, kind in readings]
            for (_, kind), (at, _) in zip(item, _windows(item, np.full(b - a, b - a), length, window), strict=True):
                if len(at):
                    own = batch.column(0)[i].as_py()
                    yield _rows([own] * len(at), at.tolist(), [length] * len(at), [_template(tokens[a:b], kind, s, length) for s in at])


def _bitmap(items: DataFrame, window: int) -> tuple[np.ndarray, list[int]]:
    """The set bits of all windows of the benchmark, and the window lengths that occur (at most ``window``)."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Tokens()
        for batch in batches:
            tokens, limits, _ = _texts(batch)
            readings = reader.read(tokens, limits)
            for i in range(batch.num_rows):
                a, b = int(limits[i]), int(limits[i + 1])
                length = min(window, b - a)
                if length:
                    item = [(form[a:b], kind[a:b]) for form, kind in readings]
                    value = np.concatenate([v for _, v in _windows(item, np.full(b - a, b - a), length, window)])
                    place = np.unique((value >> np.uint64(64 - BITMAP_BITS)).astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.full(len(place), length, np.int32))], names=["place", "length"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = np.zeros(1 << _CHUNK_BITS, bool)
                bits[places] = True
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["chunk", "bits"])

    places = items.mapInArrow(chunks, "place long, length int")
    lengths = sorted(r[0] for r in places.select("length").distinct().collect())
    packed = (
        places.selectExpr(f"place >> {_CHUNK_BITS} AS chunk", f"place & {(1 << _CHUNK_BITS) - 1} AS bit")
        .groupBy("chunk")
        .agg(F.collect_set("bit"))
        .mapInArrow(pack, "chunk long, bits binary")
    )
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    step = 1 << (_CHUNK_BITS - 3)
    for chunk, bits in packed.collect():
        out[chunk * step : (chunk + 1) * step] = np.frombuffer(bits, np.uint8)
    return out, lengths


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, item_id, n_windows, first_word``: a row for every document and item that share a window.

    ``n_windows`` counts the item's windows found in the text with corresponding places, ``first_word``
    is where the first begins (words count from 0). An item shorter than a window is one window. Null and
    empty texts share nothing; a null doc_id or item_id makes no row; repeated rows of either table change
    nothing but which of them is meant. Without a benchmark nothing comes back. Other columns are not read.
    """
    items = benchmark.selectExpr("CAST(item_id AS LONG) AS id", "CAST(text AS STRING) AS text").where("id IS NOT NULL")
    slim = docs.selectExpr("CAST(doc_id AS LONG) AS id", "CAST(text AS STRING) AS text").where("id IS NOT NULL")
    bitmap, lengths = _bitmap(items, window)
    shipped = docs.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("decontaminate", lambda: None)  # an earlier operator's tables make room
        reader, bits = Tokens(), shipped.value
        for rows in batches:
            for cut in range(0, rows.num_rows, 256):
                batch = rows.slice(cut, 256)
                tokens, limits, ends = _texts(batch)
                readings = reader.read(tokens, limits)
                whole = _filling(batch, tokens, limits, reader.ends(tokens)) if lengths and lengths[0] < window else None
                for length in lengths:
                    for (_, kind), (at, value) in zip(readings, _windows(readings, ends, length, window, whole), strict=False):
                        place = (value >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                        hit = at[(bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1]
                        if not len(hit):
                            continue
                        text = np.searchsorted(limits, hit, side="right") - 1
                        ids = batch.column(0).take(pa.array(text)).to_pylist()
                        found = [_template(tokens, kind, s, length) for s in hit]
                        yield _rows(ids, (hit - limits[text]).tolist(), [length] * len(hit), found)

    asked = items.mapInArrow(lambda it: _item_windows(it, window), _SCHEMA)
    asked = asked.selectExpr("id AS item_id", "start AS item_start", "template", "slots AS item_slots").distinct()
    said = slim.mapInArrow(scan, _SCHEMA).selectExpr("id AS doc_id", "start", "template", "slots")
    pairs = F.arrays_zip("slots", "item_slots")
    same = (F.size(F.array_distinct(pairs)) == F.size(F.array_distinct("slots"))) & (
        F.size(F.array_distinct(pairs)) == F.size(F.array_distinct("item_slots"))
    )
    return (
        said.join(asked, "template")
        .where(same)
        .groupBy("doc_id", "item_id")
        .agg(F.countDistinct("item_start").alias("n_windows"), F.min("start").alias("first_word"))
    )
