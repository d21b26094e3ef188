"""Line-first cleaning: rules drop lines, then documents that lost too much of their text.

Every line is judged by itself: what is left of prose (end punctuation, enough words), whether it is
navigation (menus, breadcrumbs, lists of short entries), boilerplate (notices and calls to act), symbols or
a repetition of an earlier line. The lines that pass make the clean text; a document is kept if its
base figures pass and the lines it lost hold at most a given share of its letters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases of notices, calls to act and menus, in lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "terms and conditions", "privacy policy", "cookie policy",
    "cookie settings", "accept cookies", "accept all cookies", "we use cookies", "this site uses cookies", "sign up for our newsletter",
    "subscribe to our newsletter", "enter your email", "log in to comment", "leave a comment", "read more", "click here",
    "share on facebook", "share on twitter", "share this article", "follow us on", "skip to content", "back to top",
    "powered by", "enable javascript", "javascript is disabled", "lorem ipsum", "404 not found", "page not found",
    "copyright ©", "© copyright", "alle rechte vorbehalten", "datenschutzerklärung", "tous droits réservés",
    "politique de confidentialité", "todos los derechos reservados", "política de privacidad",
)
MENU_MARKS = ("|", "»", "›", "·", "•", "→", "/", ">")
END_MARKS = (".", "!", "?", "…", ":", ";", "。", "！", "？")
SYMBOLS = "#*$%&|<>"

_boilerplate = re.compile("|".join(map(re.escape, BOILERPLATE)))
_symbols = re.compile("[" + re.escape(SYMBOLS) + "]")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules. Shares are of a line's or a text's characters in words."""

    #: lines up to so many words need end punctuation to count as prose
    short_words: int = 3
    #: a menu has at least so many separators between entries of at most menu_entry words
    menu_separators: int = 3
    menu_entry: int = 3
    #: a line of boilerplate is at most so many words longer than its phrase
    notice_words: int = 12
    #: symbols in a line, as a share of its characters in words
    symbol_share: float = 0.1
    #: a line of at least stutter_words words repeats the word before at most so often
    stutter_words: int = 6
    stutter_share: float = 0.3
    #: a document may lose so much of its characters in words
    lost_share: float = 0.3


def _words(line: str) -> list[str]:
    return [w.decode("utf-8") for w in line.encode("utf-8").split()]


def line_fault(words: list[str], again: bool, rules: Rules) -> str | None:
    """Why a line with words fails: ``repeated``, ``boilerplate``, ``navigation``, ``symbols``, ``stutter``, ``fragment`` or None."""
    line = " ".join(words)
    chars = sum(map(len, words))
    if again:
        return "repeated"
    if (phrase := _boilerplate.search(line.lower())) and len(words) <= phrase[0].count(" ") + 1 + rules.notice_words:
        return "boilerplate"
    ends = words[-1].rstrip("\"')]}»”’").endswith(END_MARKS)
    separators = [i for i, w in enumerate(words) if w in MENU_MARKS]
    if len(separators) >= rules.menu_separators and not ends:
        cuts = [-1, *separators, len(words)]
        if max(b - a - 1 for a, b in zip(cuts, cuts[1:], strict=False)) <= rules.menu_entry:
            return "navigation"
    if len(_symbols.findall(line)) > rules.symbol_share * chars:
        return "symbols"
    if len(words) >= rules.stutter_words and sum(a == b for a, b in zip(words, words[1:], strict=False)) > rules.stutter_share * len(words):
        return "stutter"
    if len(words) <= rules.short_words and not ends:
        return "fragment"
    return None


@dataclass
class Report:
    """Figures of one text; ``clean`` is the text without its failed lines."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    lost_chars: int
    kept: bool
    clean: str
    faults: dict[str, int]


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside runs of ``size`` words that occur twice or more in the text, the first place included."""
    if len(words) < size:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends[:-size]]
    runs = [joined[s:e] for s, e in zip(starts, ends[size - 1 :], strict=True)]
    if len(set(runs)) == len(runs):
        return 0
    seen = Counter(runs)
    total, covered = 0, 0
    for i, run in enumerate(runs):
        if seen[run] > 1:
            total += i + size - max(i, covered)
            covered = i + size
    return total


def judge(text: str | None, rules: Rules = Rules()) -> Report:  # noqa: B008 - a constant
    """Figures, verdict and clean text; a null text counts as empty."""
    text = text or ""
    raw = text.encode("utf-8").split()
    word_chars = sum(len(w.decode("utf-8")) for w in raw) if not text.isascii() else sum(map(len, raw))
    seen: set[str] = set()
    kept_lines, lost, dup, faults = [], 0, 0, Counter()
    for line in text.split("\n"):
        words = _words(line)
        if not words:
            kept_lines.append("")
            continue
        again = line in seen
        dup += again
        seen.add(line)
        fault = line_fault(words, again, rules)
        if fault:
            faults[fault] += 1
            lost += sum(map(len, words))
        else:
            kept_lines.append(line)
    n_repeat = repeated_words(raw)
    failed = len(raw) < 10 or 100 * n_repeat > 20 * len(raw)
    kept = not failed and lost <= rules.lost_share * word_chars
    n_symbols = len(_symbols.findall(text))
    return Report(len(raw), word_chars, n_symbols, dup, n_repeat, failed, lost, kept, "\n".join(kept_lines).strip("\n"), dict(faults))


_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, lost_chars long, faults map<string,long>, clean_text string"
)


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008 - a constant
    """Figures, verdict, faults by rule and clean text for every row of ``docs``; no shuffle.

    Null and empty texts have no words and fail. Null and repeated doc_ids stay as they are; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                done = [judge(t, rules) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        *(pa.array([getattr(d, c) for d in done], pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                        *(pa.array([getattr(d, c) for d in done], pa.bool_()) for c in ("base_failed", "kept")),
                        pa.array([d.lost_chars for d in done], pa.int64()),
                        pa.array([list(d.faults.items()) for d in done], pa.map_(pa.string(), pa.int64())),
                        pa.array([d.clean for d in done], pa.string()),
                    ],
                    names=[c.split()[0] for c in _SCHEMA.split(", ")],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, _SCHEMA)
