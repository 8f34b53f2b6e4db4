"""Quality rules: base counts of a text, and repetition by suffix arrays over its words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import map_texts, slim
from .textbuf import SPACE, chunks, line_spans, mix, per_text, span_hashes, word_spans

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A repeat of fewer words than MIN_REPEAT is no evidence. Above these, a text fails: share of words under repeats, words of the longest one.
MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 6, 0.4, 100

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, covered_words bigint, covered_fraction double, longest_repeat bigint, n_maximal_repeats bigint"


def suffix_array(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, longest common prefix of each suffix with the one before it) of integer tokens.

    By prefix doubling in which only suffixes that aren't alone yet are sorted again. Every text in `token` ends in a token found
    nowhere else, so no common prefix crosses a text's end. The ranks of each round are kept and give the prefixes' lengths exactly.
    """
    n = len(token)
    sa = np.argsort(token, kind="stable")
    sorted_ = token[sa]
    new = np.ones(n, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    first = ~new
    levels, step = [rank.astype(np.int32)], 1
    while len(tied):
        at = sa[tied]
        key = rank[at] * n + rank[at + step]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank.astype(np.int32))
        tied = tied[~(new & np.append(new[1:], True))]
        step *= 2
    lcp = np.zeros(n, np.int64)
    pair = np.flatnonzero(first)
    a, b = sa[pair - 1], sa[pair]
    length = np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]).astype(np.int64) << k
    lcp[pair] = length
    return sa, lcp


def maximal_repeats(sa: np.ndarray, lcp: np.ndarray, token: np.ndarray, text: np.ndarray, least: int, texts: int) -> np.ndarray:
    """For each text, how many LCP intervals of `least` words or more occur after more than one word: the maximal repeats."""
    before = np.append(token[-1:], token[:-1])[sa]
    change = np.zeros(len(sa), np.int64)
    np.cumsum(before[1:] != before[:-1], out=change[1:])
    count = np.zeros(texts, np.int64)
    rows = np.flatnonzero(lcp >= least)
    if not len(rows):
        return count
    value, change_at, stack, last = lcp[rows].tolist(), change.tolist(), [], -2

    def close(down_to: int, right: int) -> int:
        left = right
        while stack and stack[-1][0] > down_to:
            _, left = stack.pop()
            if change_at[right] > change_at[left]:
                count[text[sa[left]]] += 1
        return left

    for row, v in zip(rows.tolist(), value, strict=True):
        if row != last + 1:
            close(0, last)
        left = row - 1
        if stack and stack[-1][0] > v:
            left = close(v, row - 1)
        if not stack or stack[-1][0] < v:
            stack.append((v, left))
        last = row
    close(0, last)
    return count


def measure(data: np.ndarray, off: np.ndarray, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """The counts of each text of a chunk."""
    n = len(off) - 1
    start, end, doc = word_spans(data, off)
    words = np.bincount(doc, minlength=n)
    out = {"n_words": words, "word_chars": per_text(~SPACE[data] & ((data & 0xC0) != 0x80), off), "n_symbols": per_text(_SYMBOL[data], off)}

    ls, le, ld = line_spans(data, off)
    full = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data], out=full[1:])
    has = full[le] > full[ls]
    line = span_hashes(data, ls[has], le[has])
    ld = ld[has]
    order = np.lexsort((line, ld))
    line, ld = line[order], ld[order]
    out["n_dup_lines"] = np.bincount(ld[1:][(line[1:] == line[:-1]) & (ld[1:] == ld[:-1])], minlength=n)

    where = np.arange(len(doc)) + doc  # each text's words, then its end
    token = np.empty(len(doc) + n, np.uint64)
    text = np.empty(len(token), np.int64)
    ends = np.cumsum(words + 1) - 1
    token[where] = mix(span_hashes(data, start, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
    token[ends] = (np.uint64(1) << np.uint64(63)) + np.arange(n, dtype=np.uint64)
    text[where], text[ends] = doc, np.arange(n)
    sa, lcp = suffix_array(token)
    longest = np.zeros(len(token), np.int64)
    longest[sa] = np.maximum(lcp, np.append(lcp[1:], 0))

    def under(least: int, width: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(longest >= least)
        edge = np.bincount(at, minlength=len(token) + 1) - np.bincount(at + width[at], minlength=len(token) + 1)
        return np.bincount(text[np.cumsum(edge)[:-1] > 0], minlength=n)

    out["n_repeat_words"] = under(3, np.full(len(token), 3))
    out["covered_words"] = under(min_repeat, longest)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text, np.where(longest >= min_repeat, longest, 0))
    out["longest_repeat"] = top
    out["n_maximal_repeats"] = maximal_repeats(sa, lcp, token, text, min_repeat, n)
    return out


def repetition_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> DataFrame:
    """Counts and verdict of every row, in one pass without a shuffle.

    A suffix array with longest common prefixes over each whole text's words gives the intervals of repeated word sequences; the
    union of the maximal ones' spans is what is covered (at each place the longest repeat that begins there covers as much as all
    maximal ones do). Overlapping occurrences count. `kept` is false if a base rule fails (under 50 words, or over half of the words
    in three-word windows found twice), if repeats of `min_repeat` words cover over `max_covered` of the words, or if one has over
    `max_longest` words. A null text is an empty one: no words, so it fails. Ids may be null or repeat: a row gives a row. Other
    columns are ignored; no rows give none. Memory follows the longest text, not the partition.
    """

    def body(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [measure(data, off, min_repeat) for _, _, data, off in chunks(batch.column(1))]
        c = {k: np.concatenate([m[k] for m in made]).astype(np.int64) for k in made[0]}
        base = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
        share = c["covered_words"] / np.maximum(1, c["n_words"])
        kept = ~base & (share <= max_covered) & (c["longest_repeat"] <= max_longest)
        c |= {"base_failed": base, "kept": kept, "covered_fraction": share}
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.record_batch([batch.column(0), *(pa.array(c[k]) for k in names[1:])], names=names)

    return map_texts(slim(df, id_col, text_col), body, SCHEMA)
