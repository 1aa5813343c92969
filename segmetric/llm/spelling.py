"""Spelling variants: words one edit apart, by dynamic programming over sorted lists.

The vocabulary is dealt into sorted lists that can be scanned apart: an edit lies in one of
``SEGMENTS`` parts of a word, so near words agree in everything before and after that part
and meet in the list of that part. A list with more than ``MOST_WORDS`` words is dealt again
by halves of its part, until the part is one letter.

A list is scanned in order. The words below one prefix stand together, and their edit-matrix
rows up to that prefix (its length is the longest common prefix of neighbours) are computed once
and reused. Only the band of three cells around the diagonal is kept, as one edit allows no
more. Where all cells of a row exceed one edit, the whole range below that prefix is skipped.
All searched words of a list move through it together, one letter at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import small_side, written

#: Maximal runs of these letters are words.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
#: Parts of a word in which the edit may lie, and words of one list.
SEGMENTS = 4
MOST_WORDS = 4_096
#: Letters of the lists that are scanned together in one task.
BATCH_CELLS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def word_counts(docs: DataFrame, text_col: str = "text", min_length: int = 5, min_count: int = 3,
                change=None) -> DataFrame:
    """(word, n): the lower-cased (A-Z) letter runs of all whole texts, counted over all rows.

    ``change(word)`` may rewrite each run (a column expression over the row's other columns)
    before it is counted; results of less than ``min_length`` letters or ``min_count``
    occurrences go. Null texts hold no word.
    """
    text = F.col(f"`{text_col}`")
    # a change shortens a run by what it likes, but none is lengthened: shorter runs can't count
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = docs.select("*", F.explode(runs).alias("__run")).withColumn("__word", lower_ascii(F.col("__run")))
    word = F.col("__word") if change is None else change(F.col("__word"))
    return (rows.select(word.alias("word")).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _entries(words: DataFrame, segments: int) -> DataFrame:
    """One row per (word, part): part = [lo, hi) of the shorter of two near words; ``size`` is
    that word's length. A word enters as one of that length and as one a letter longer."""
    size = F.char_length("word")
    parts = F.array(*[F.lit(s) for s in range(segments)])
    longer = F.array(F.lit(0), F.lit(1))
    rows = (words.select("word", "n", F.explode(longer).alias("longer"), size.cast("int").alias("length"))
            .select("word", "n", "longer", (F.col("length") - F.col("longer")).alias("size"), F.explode(parts).alias("s")))
    lo = F.call_function("div", F.col("size") * F.col("s"), F.lit(segments)).cast("int")
    hi = F.call_function("div", F.col("size") * (F.col("s") + 1), F.lit(segments)).cast("int")
    return _keyed(rows.select("word", "n", "longer", "size", lo.alias("lo"), hi.alias("hi")).where("hi > lo"))


def _keyed(rows: DataFrame) -> DataFrame:
    rest = F.concat(F.substring(F.col("word"), F.lit(1), F.col("lo")),
                    F.substring(F.col("word"), F.col("hi") + F.col("longer") + 1, F.char_length("word")))
    return rows.withColumn("rest", rest)


_LIST = ["size", "lo", "hi", "rest"]


def sorted_lists(words: DataFrame, segments: int = SEGMENTS, most: int = MOST_WORDS) -> DataFrame:
    """Entries (word, n, longer, size, lo, hi, rest) of all lists with several words.

    Lists above ``most`` words are dealt again by halves of their part; a part of one letter
    leaves at most an alphabet's square of words."""
    rows, done = _entries(words, segments), []
    while True:
        held = rows.groupBy(*_LIST).agg(F.count("*").alias("words"), F.min("longer").alias("least"))
        large = written(held.where((F.col("words") > most) & (F.col("hi") - F.col("lo") > 1)).select(*_LIST), "large")
        if large.isEmpty():
            done.append(rows)
            break
        key = small_side(large)
        done.append(rows.join(key, _LIST, "left_anti"))
        middle = F.call_function("div", F.col("lo") + F.col("hi"), F.lit(2)).cast("int")
        halves = F.explode(F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi"))))
        split = rows.join(key, _LIST, "left_semi").select("word", "n", "longer", "size", halves.alias("part"))
        rows = written(_keyed(split.select("word", "n", "longer", "size", "part.lo", "part.hi")), "split")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def scan(letters: np.ndarray, length: np.ndarray, group: np.ndarray, asks: np.ndarray, start: np.ndarray
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (asking word, word of its list, common prefix) that are one edit apart.

    ``letters`` (words x most letters, 0 behind the end) is sorted by list and word; ``group`` is
    each word's list number, ascending; ``start`` how many letters all words of its list share.
    """
    n, width = letters.shape
    width_of = np.int64(n)
    # prefix ranges of the sorted lists: letters that a word shares with the one before it
    lcp = np.zeros(n + 1, dtype=np.int64)
    if n > 1:
        differ = letters[1:] != letters[:-1]
        lcp[1:n] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp[1:n] = np.where(group[1:] == group[:-1], lcp[1:n], -1)
    lcp[0] = lcp[n] = -1
    # a state: searched word q, range [a, b) of words with one prefix of d letters, the cells
    # q[:d-1], q[:d], q[:d+1] of its row, and where q and the prefix part (-1: nowhere yet)
    first = np.flatnonzero(lcp[:n] < 0)
    last = np.append(first[1:], n)
    q = np.flatnonzero(asks)
    own = np.searchsorted(first, q, side="right") - 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    big = np.int8(2)
    for depth in range(int(start.min(initial=0)), width + 1):
        new = q_new = np.flatnonzero(asks & (start == depth))
        if depth == int(start.min(initial=0)):
            a = b = low = mid = high = part = q = np.empty(0, dtype=np.int64)
        if len(q_new):
            own = np.searchsorted(first, new, side="right") - 1
            one = np.ones(len(new), dtype=np.int8)
            q, a, b = np.concatenate([q, new]), np.concatenate([a, first[own]]), np.concatenate([b, last[own]])
            low, mid, high = (np.concatenate([x.astype(np.int8), y]) for x, y in ((low, one), (mid, one * 0), (high, one)))
            part = np.concatenate([part, np.full(len(new), -1, dtype=np.int64)])
        if not len(q):
            if not (asks & (start > depth)).any():
                break
            continue
        # words that end here stand first in their range
        ends = length[a] == depth
        gap = length[q] - depth
        cost = np.select([gap == -1, gap == 0, gap == 1], [low, mid, high], big)
        hit = ends & (cost == 1)
        if hit.any():
            found.append((q[hit], a[hit], np.where(part[hit] >= 0, part[hit], np.minimum(depth, length[q[hit]]))))
        a = a + ends
        alive = a < b
        q, a, b, low, mid, high, part = (x[alive] for x in (q, a, b, low, mid, high, part))
        if not len(q) or depth == width:
            continue
        # children: starts of the ranges with one more letter
        heads = np.flatnonzero(lcp[:n] <= depth)
        lo, hi = np.searchsorted(heads, a, side="left"), np.searchsorted(heads, b, side="left")
        # a itself may share depth letters with a word that ended here: it heads a range all the same
        count = hi - lo
        rep = np.repeat(np.arange(len(q)), count)
        at = heads[np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count) + lo[rep]]
        nxt = np.append(heads, width_of)[np.searchsorted(heads, at, side="left") + 1]
        letter = letters[at, depth]
        q, part = q[rep], part[rep]
        own_len = length[q]
        low, mid, high = low[rep], mid[rep], high[rep]

        def cell(j: np.ndarray) -> np.ndarray:
            """Whether q's letter j (from 0) is another one than the child's; beyond q: always."""
            inside = (j >= 0) & (j < own_len)
            return ((letters[q, np.clip(j, 0, width - 1)] != letter) | ~inside).astype(np.int8)

        d = np.full(len(q), depth, dtype=np.int64)
        # row depth + 1 at q[:depth], q[:depth + 1], q[:depth + 2], from the row above
        n_low = np.minimum(low + cell(d - 1) if depth else big, mid + 1)
        n_mid = np.minimum(np.minimum(mid + cell(d), high + 1), n_low + 1)
        n_high = np.minimum(high + cell(d + 1), n_mid + 1)
        n_mid = np.where(own_len >= depth + 1, n_mid, big)
        n_high = np.where(own_len >= depth + 2, n_high, big)
        n_low, n_mid, n_high = (np.minimum(x, big).astype(np.int8) for x in (n_low, n_mid, n_high))
        part = np.where((part < 0) & (n_mid > 0), depth, part)
        keep = np.minimum(np.minimum(n_low, n_mid), n_high) <= 1
        q, a, b, part = q[keep], at[keep], nxt[keep], part[keep]
        low, mid, high = n_low[keep], n_mid[keep], n_high[keep]
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


_SCHEMA = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _near(words: list[str], n: np.ndarray, longer: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray,
          group: np.ndarray) -> pa.RecordBatch | None:
    """Per word of some lists: near words met there, and the most frequent of them."""
    text = np.array(words, dtype=str)
    letters = text.view(np.uint32).reshape(len(words), -1)
    length = np.char.str_len(text).astype(np.int64)
    q, w, common = scan(letters, length, group, longer == 0, lo)
    # a pair belongs to the part with the first letter in which its words differ
    mine = (common >= lo[q]) & ((common < hi[q]) | (hi[q] == size[q]))
    q, w = q[mine], w[mine]
    if not len(q):
        return None
    grown = longer[w] == 1  # the longer word asks in no list of this length: it gets the pair from here
    one, other = np.concatenate([q, w[grown]]), np.concatenate([w, q[grown]])
    order = np.lexsort((other, -n[other], one))
    # equal counts: the smaller word first; a list is sorted, and lists don't mix
    one, other = one[order], other[order]
    head = np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1])))
    count = np.diff(np.append(head, len(one)))
    return pa.RecordBatch.from_arrays([pa.array(text[one[head]].tolist()), pa.array(count), pa.array(n[other[head]]),
                                       pa.array(text[other[head]].tolist())], schema=_SCHEMA)


def _scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_near`` over whole lists, as many at a time as hold about BATCH_CELLS letters. The rows
    come sorted by list and word; their columns are those of ``sorted_lists``."""
    held: list[pa.RecordBatch] = []
    cells = 0

    def flush(whole: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        size, lo, hi = (table.column(c).to_numpy().astype(np.int64) for c in ("size", "lo", "hi"))
        rest = np.array(table.column("rest").to_pylist(), dtype=object)
        new = np.ones(len(size), dtype=bool)
        new[1:] = (size[1:] != size[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (rest[1:] != rest[:-1])
        group = np.cumsum(new)
        end = len(size) if whole else int(np.flatnonzero(new)[-1])  # the last list may go on
        if end < len(size):
            held.extend(table.slice(end).to_batches())
        if not end:
            return
        several = np.bincount(group[:end])[group[:end]] > 1
        n, longer = table.column("n").to_numpy(), table.column("longer").to_numpy()
        for length in np.unique(size[:end][several]):  # one length at a time: letters are held as a matrix
            at = np.flatnonzero(several & (size[:end] == length))
            words = table.column("word").take(pa.array(at)).to_pylist()
            found = _near(words, n[at], longer[at], size[at], lo[at], hi[at], group[at])
            if found is not None:
                yield found

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cells += batch.num_rows * (int(batch.column("size")[batch.num_rows - 1].as_py()) + 2)
        if cells >= BATCH_CELLS:
            yield from flush(False)
            cells = 0
    if held:
        yield from flush(True)


def near_words(words: DataFrame, segments: int = SEGMENTS, most: int = MOST_WORDS) -> DataFrame:
    """(word, n_near, form, form_n) of the words of ``words`` (word, n) that have near words:
    how many, and the one of largest n (ties: smallest in code-point order)."""
    lists = sorted_lists(words, segments, most)
    met = (lists.repartition(*_LIST).sortWithinPartitions(*_LIST, "word")
           .mapInArrow(_scan_lists, "word string, n_near long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best")))
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("near"), (-F.col("b.minus")).alias("near_n")))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last word that forms lead to. Paths are
    halved until none has a step left; counts at least double at a step, so they are short."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("at"), F.col("root").alias("on"))
        far = written(now.join(up, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        now = far.select("word", "root")
        if far.where("moved").isEmpty():
            return now


def spelling_groups(words: DataFrame, segments: int = SEGMENTS, most: int = MOST_WORDS, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for ``words`` (word, n; words distinct).

    Words are near if one inserted, deleted or replaced code point makes them equal. A word's
    form is its near word of largest n if that is at least ``ratio`` times its own, else null;
    root follows the forms. Null words are dropped; an empty table gives an empty result.
    Very long words are scanned whole, in lists of their own length.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms might lead in circles")
    held = written(words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(held, segments, most)
    big = F.col("near_n") >= F.lit(ratio) * F.col("n")
    judged = written(held.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(big, F.col("near")).alias("form"), F.when(big, F.col("near_n")).alias("form_n")), "forms")
    roots = follow(judged.where(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
