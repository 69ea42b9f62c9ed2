"""Fuzzy search for short license notices: exact seeds first, bounded-error matching second.

Texts are reduced to their words: A-Z lower-cased, words are runs of digits, a-z and everything from U+0080 on, put
back together with one blank between them. A notice that occurs with at most k errors contains at least one of its
k + 1 pieces unchanged (pigeonhole). So every occurrence of a piece marks a window, overlapping windows are joined,
and the regex library holds every run of whole words in a window, if its length allows, against the notice with at most
k insertions, deletions or substitutions. What has no errors is a base place; the rest are near matches. Of those that
overlap the one with the fewest errors counts, then the first, then the longest. k is 0 for notices
shorter than 8 characters, 1 up to 16, and 2 beyond (parameter `errors`). Windows are as long as their seeds need: no cap.

Row-wise, no shuffle. Null and empty texts have no words, no labels and score 0.
The score is the best 1 - errors / length over all matches of a text, 0 without a match.
"""

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from posada.llm.common import map_texts

# phrases and their labels (fixed values)
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
BATCH_BYTES = 8 << 20


def errors_for(phrase: str) -> int:
    return 0 if len(phrase) < 8 else 1 if len(phrase) <= 16 else 2


class Notice:
    """One phrase, its pieces with their offsets, and its patterns."""

    def __init__(self, phrase: str, label: str, errors: int):
        self.phrase, self.label, self.errors = phrase, label, errors
        edges = [round(i * len(phrase) / (errors + 1)) for i in range(errors + 2)]
        self.pieces = [(phrase[a:b], a) for a, b in zip(edges, edges[1:])]
        self.near = [regex.compile(rf"(?:{regex.escape(phrase)}){{e<={n}}}") for n in range(1, errors + 1)]

    def windows(self, text: str) -> list[tuple[int, int]]:
        """Where the phrase can lie, from the exact pieces; joined where they overlap."""
        found = []
        for piece, offset in self.pieces:
            at = text.find(piece)
            while at >= 0:
                start = at - offset - self.errors
                found.append((max(0, start), min(len(text), at - offset + len(self.phrase) + self.errors)))
                at = text.find(piece, at + 1)
        out = []
        for a, b in sorted(found):
            if out and a <= out[-1][1]:
                out[-1][1] = max(b, out[-1][1])
            else:
                out.append([a, b])
        return out

    def near_runs(self, text: str, blanks: list[int], a: int, b: int) -> list[tuple[int, int, int]]:
        """(errors, start, end) of all runs of whole words between two places that have 1 to k errors."""
        inside = blanks[bisect_left(blanks, a - 1):bisect_right(blanks, min(b, len(text) - 1))]
        least, most, out = len(self.phrase) - self.errors, len(self.phrase) + self.errors, []
        for blank in inside:
            start = blank + 1
            for end in inside[bisect_left(inside, start + least):bisect_right(inside, start + most)]:
                if start >= a and text[start:end] != self.phrase:
                    n = next((n for n, pattern in enumerate(self.near, 1) if pattern.fullmatch(text, start, end)), 0)
                    if n:
                        out.append((n, start, end))
        return out

    def matches(self, text: str, blanks: list[int]) -> list[tuple[int, int, int]]:
        """(start, end, errors) in a text that has a blank at either end: base places, and near matches on word borders
        that no base place overlaps. blanks: the places of all blanks."""
        found, near = [], []
        for a, b in self.windows(text):
            at = text.find(self.phrase, a, b)
            while at >= 0:
                end = at + len(self.phrase)
                if text[at - 1] == " " and text[end] == " ":
                    found.append((at, end, 0))
                at = text.find(self.phrase, at + 1, b)
            if self.errors:
                near += self.near_runs(text, blanks, a, b)
        longest = len(self.phrase) + self.errors
        found.sort()
        for n, start, end in sorted(near, key=lambda x: (x[0], x[1], -x[2])):
            # What overlaps begins before the end, and not further before the start than a match is long.
            first, last = bisect_left(found, (start - longest,)), bisect_left(found, (end,))
            if not any(y > start for _, y, _ in found[first:last]):
                found.insert(last, (start, end, n))
        return found


@lru_cache(maxsize=4)
def notices(phrases: tuple, errors) -> tuple[Notice, ...]:
    return tuple(Notice(p, label, errors(p)) for p, label in phrases)


def scan_text(text: str, phrases=PHRASES, errors=errors_for) -> dict:
    """Words, spans (label, first word, number of words, errors) and what follows from them."""
    words = WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())
    joined = f" {' '.join(words)} "
    blanks = [0, *accumulate((len(w) + 1 for w in words))]
    spans = []
    for notice in notices(phrases, errors):
        for start, end, n in notice.matches(joined, blanks):
            word = bisect_left(blanks, start) - 1
            spans.append((notice.label, word, bisect_left(blanks, end) - word, n, 1 - n / len(notice.phrase)))
    base = [s for s in spans if s[3] == 0]
    return {"n_words": len(words), "spans": spans, "n_base": len(base),
            "first_word": min((s[1] for s in base), default=None), "last_word": max((s[1] for s in base), default=None),
            "base_labels": ",".join(sorted({s[0] for s in base})), "labels": ",".join(sorted({s[0] for s in spans})),
            "score": max((s[4] for s in spans), default=0.0)}


_COLUMNS = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
            ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType())]


def scan_licenses(df: DataFrame, text: str = "text", phrases=PHRASES, errors=errors_for, keep: list[str] | None = None) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels, score, and spans: one string
    "label:first word:words:errors" for each match, in order of place, joined by blanks."""
    fields = [T.StructField(n, t) for n, t in _COLUMNS] + [T.StructField("spans", T.StringType())]

    def rows(column: pa.Array):
        out = []
        for value in column.to_pylist():
            x = scan_text(value, phrases, errors)
            spans = " ".join(f"{s[0]}:{s[1]}:{s[2]}:{s[3]}" for s in sorted(x["spans"], key=lambda s: (s[1], s[0], s[2])))
            out.append((*(x[n] for n, _ in _COLUMNS), spans))
        return out

    return map_texts(df, text, fields, rows, BATCH_BYTES, keep)
