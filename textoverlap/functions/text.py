"""Text column functions: case folding and sentence splitting. Lengths follow byte semantics (``octet_length``)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from textoverlap.config import LEADING_WHITESPACE, LOWER, SENTENCE_DELIMITERS, UPPER

DELIM_CLASS = f"[{SENTENCE_DELIMITERS}]"
DELIM_RUN = f"{DELIM_CLASS}+"
LEAD_WS = f"^[{LEADING_WHITESPACE}]+"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (C-locale ``tolower``); other bytes unchanged."""
    return F.translate(c, UPPER, LOWER)


def delimiter_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(DELIM_CLASS)), F.lit(0))


def sentence_array(text: Column) -> Column:
    """Lower-cased sentences of ``text`` in order.

    Fragments between runs of ``.!?`` lose leading blanks; empty ones are
    dropped; at most as many sentences are kept as there are delimiters, so a
    text without a delimiter has no sentence and an unterminated tail may be
    dropped (the original's ``strtok`` loop behaves the same way).
    """
    frags = F.split(ascii_lower(text), DELIM_RUN)
    trimmed = F.transform(frags, lambda x: F.regexp_replace(x, LEAD_WS, ""))
    kept = F.filter(trimmed, lambda x: x != F.lit(""))
    n = delimiter_count(text)
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.slice(kept, 1, n))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]
_DELIMITER, _BLANK = (np.isin(np.arange(256), [ord(c) for c in chars]) for chars in (SENTENCE_DELIMITERS, LEADING_WHITESPACE))
_STEPS = 4  # leading blanks that are passed for all fragments at once


def sentence_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``sentence_array`` of many texts, given as bytes and where each begins: (sentences and delimiters of each text, bytes of all
    sentences, where each begins). Delimiters and blanks are ASCII, which no other character's bytes hold."""
    data = _LOWER[data[off[0]:off[-1]]]
    off = off - off[0]
    stop = np.flatnonzero(_DELIMITER[data])
    of = np.searchsorted(off, stop, side="right") - 1
    n = np.bincount(of, minlength=len(off) - 1)
    # a fragment ends at a delimiter or with its text
    end = np.insert(stop, np.cumsum(n), off[1:])
    owner = np.repeat(np.arange(len(n)), n + 1)
    begin = np.where(np.concatenate([[True], owner[1:] != owner[:-1]]), off[owner], np.concatenate([[0], end[:-1] + 1]))
    left = np.flatnonzero(begin < end)
    for _ in range(_STEPS):
        left = left[_BLANK[data[begin[left]]]]
        begin[left] += 1
        left = left[begin[left] < end[left]]
    if len(left):
        solid = np.append(np.flatnonzero(~_BLANK[data]), len(data))
        begin[left] = np.minimum(solid[np.searchsorted(solid, begin[left])], end[left])
    kept = np.flatnonzero(begin < end)
    first = np.searchsorted(owner[kept], np.arange(len(n)))
    kept = kept[np.arange(len(kept)) - first[owner[kept]] < n[owner[kept]]]
    begin, end = begin[kept], end[kept]
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[begin] += 1
    step[end] -= 1  # a text's last sentence may end where the next one's first begins
    inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
    return np.bincount(owner[kept], minlength=len(n)), n, data[inside], np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
