"""Spelling variants: words one edit apart, by dynamic programming over sorted word lists.

A word list is sorted; words that share a prefix are a range of it, given by the common prefixes of neighbours.  All
words of a list are looked up in it together: a row of the edit matrix, banded to three cells, is computed once for a
range and its next letter, and a range whose row exceeds one edit is skipped with all words in it.

Lists are cut so that no task holds the vocabulary.  Words one edit apart share the first half or the second half of the
shorter one, so every word stands in four lists.  A list of more words than a task should hold is cut again: half of what
is left free must be shared too.  A pair counts in one list only, by the length of its common prefix.

Edge cases: null and empty texts have no words; a null id gives runs the key of an empty one; repeated rows count each;
words of any length are compared whole; an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagerank.llm.shared import stored, text_of
from passagerank.operators.sizing import lookup_join

#: Fixed values of the contract: what a run of letters is, one run in how many loses a letter, and what counts as a word.
RUN, SLIP, LEAST_LENGTH, LEAST_COUNT = r"[A-Za-z\x{C0}-\x{FF}]+", 31, 7, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A form must occur so many times as often as the word.
TIMES = 10
#: Words in a list at most, and words that a task looks up together.
LIST_WORDS, LOOKED_UP = 20_000, 1 << 13
#: A common prefix of any length.
ANY = 1 << 30


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all texts: runs of letters, of which some lose a letter by a hash of the document and the run."""
    runs = F.explode(F.regexp_extract_all(F.translate(text_of(text), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run")
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), runs)
    rows = rows.filter(F.length("run") >= LEAST_LENGTH)
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    gone = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))
    word = F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word")
    counted = rows.select(word).filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


# one batch of lists


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths


def common_prefixes(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the words ``a`` and ``b``."""
    found, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
    most = np.minimum(lengths[a], lengths[b])
    while len(open_):
        at = found[open_]
        open_ = open_[at < most[open_]]
        at = found[open_]
        open_ = open_[flat[starts[a[open_]] + at] == flat[starts[b[open_]] + at]]
        found[open_] += 1
    return found


def one_edit_apart(words: list[bytes], lists: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (both ways) of words of the same list that are one edit apart.

    ``words`` are sorted in every list, and ``lists`` (a number per word) ascends; all words of a list share the first
    ``shared`` letters.  Letters are single bytes.
    """
    flat, starts, lengths = _flat(words)
    n = len(words)
    edge = np.append(True, lists[1:] != lists[:-1])[:n]
    first = np.flatnonzero(edge)
    of, ends = np.cumsum(edge) - 1, np.append(first[1:], n)
    # where a word parts from the one before it in its list, and at which depth
    place = np.flatnonzero(~edge)
    parted = np.sort(common_prefixes(flat, starts, lengths, place - 1, place) * n + place)
    us, vs = [], []
    for begin in range(0, n, LOOKED_UP):
        query = np.arange(begin, min(n, begin + LOOKED_UP))
        low, high, depth = first[of[query]], ends[of[query]], shared[query]
        # the shared letters are alike: the row at their end
        row = np.stack([np.ones_like(depth), np.zeros_like(depth), np.ones_like(depth)]).astype(np.int8)
        row[0, depth == 0] = 2
        row[2, lengths[query] <= depth] = 2
        while len(query):
            # words that end here stand first in their range
            done = lengths[low] == depth
            at = np.flatnonzero(done)
            apart = lengths[query[at]] - depth[at] + 1
            hit = at[(apart >= 0) & (apart <= 2)]
            hit = hit[row[lengths[query[hit]] - depth[hit] + 1, hit] == 1]
            us.append(query[hit])
            vs.append(low[hit])
            low = low + done
            # a list holds a word once, so the rest of the range has a next letter
            some = np.flatnonzero(low < high)
            query, low, high, depth, row = query[some], low[some], high[some], depth[some], row[:, some]
            if not len(query):
                break
            query, low, high, depth, row = _children(parted, n, query, low, high, depth, row)
            letter = flat[starts[low] + depth]
            row = _next_row(flat, starts, lengths, query, depth, letter, row)
            some = np.flatnonzero(row.min(axis=0) <= 1)
            query, low, high, depth, row = query[some], low[some], high[some], depth[some] + 1, row[:, some]
    return np.concatenate(us) if us else np.zeros(0, np.int64), np.concatenate(vs) if vs else np.zeros(0, np.int64)


def _children(parted, n, query, low, high, depth, row):
    """The ranges of one more common letter in every range; ``parted`` has the places where words part, by depth."""
    begin = np.searchsorted(parted, depth * n + low + 1)
    more = np.searchsorted(parted, depth * n + high) - begin
    who = np.repeat(np.arange(len(query)), more + 1)
    nth = np.arange(len(who)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    place = np.where(nth == 0, low[who], parted[np.maximum(begin[who] + nth - 1, 0)] - depth[who] * n) if len(parted) else low[who]
    ends = np.append(place[1:], 0)
    last = np.cumsum(more + 1) - 1
    ends[last] = high
    return query[who], place, ends, depth[who], row[:, who]


def _next_row(flat, starts, lengths, query, depth, letter, row):
    """The banded row after one more letter: edits to one letter less, as many and one more of the looked-up word."""
    def differs(at):
        inside = (at >= 0) & (at < lengths[query])
        return np.where(inside, flat[starts[query] + np.where(inside, at, 0)] != letter, 2).astype(np.int8)

    less = np.minimum(row[0] + differs(depth - 1), row[1] + 1)
    same = np.minimum(np.minimum(row[1] + differs(depth), less + 1), row[2] + 1)
    more = np.minimum(row[2] + differs(depth + 1), same + 1)
    # cells beyond the end of the word do not exist
    same = np.where(depth + 1 > lengths[query], 2, same)
    more = np.where(depth + 2 > lengths[query], 2, more)
    return np.minimum(np.stack([less, same, more]), 2).astype(np.int8)


# lists


def _list(prefix: Column, suffix: Column, below: Column) -> Column:
    """A list of words with ``shorter`` letters or one more that share ``prefix`` letters in front and ``suffix`` behind.

    Pairs with a common prefix of ``below`` letters or more belong to another list.
    """
    return F.struct(
        F.col("shorter"), prefix.cast("int").alias("prefix"), suffix.cast("int").alias("suffix"), below.cast("int").alias("below"),
        F.substring("word", F.lit(1), prefix.cast("int")).alias("head"),
        F.substring(F.col("word"), F.length("word") - suffix.cast("int") + 1, suffix.cast("int")).alias("tail"),
    )


def _halves(prefix: Column, suffix: Column, below: Column) -> Column:
    """The two lists that hold all pairs of a list: half of the free letters are shared too, in front or behind."""
    free = F.col("shorter") - prefix - suffix
    more = prefix + F.ceil(free / 2).cast("int")
    return F.explode(F.array(_list(more, suffix, below), _list(prefix, suffix + F.floor(free / 2).cast("int"), more)))


def word_lists(words: DataFrame, most: int | None = None) -> DataFrame:
    """``list, word, n``: lists of ``most`` words or fewer (or with at most one free letter) that hold every near pair."""
    most = LIST_WORDS if most is None else most
    shorter = F.explode(F.array(F.length("word") - 1, F.length("word"))).alias("shorter")
    rows = words.select("word", "n", shorter).filter(F.col("shorter") >= LEAST_LENGTH)
    rows = rows.select("word", "n", _halves(F.lit(0), F.lit(0), F.lit(ANY)).alias("list"))
    out = None
    while True:
        rows = stored(rows, "variants-lists")
        full = rows.groupBy("list").agg(F.count(F.lit(1)).alias("__n")).filter(
            (F.col("__n") > most) & (F.col("list.shorter") - F.col("list.prefix") - F.col("list.suffix") > 1)
        ).select("list", F.lit(True).alias("full"))
        full = stored(full, "variants-full")
        if full.isEmpty():
            return rows if out is None else out.union(rows)
        marked = stored(lookup_join(rows, full, ["list"], "left"), "variants-marked")
        fit = marked.filter("full is null").select("word", "n", "list")
        out = fit if out is None else out.union(fit)
        again = marked.filter("full").select("word", "n", "list", F.col("list.shorter").alias("shorter"))
        rows = again.select(
            "word", "n", _halves(F.col("list.prefix"), F.col("list.suffix"), F.col("list.below")).alias("list")
        )


NEAR = "word string, n_near bigint, least bigint, form string"


def _near_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word of a list: number of near words that count there, and the best of them (``least`` is minus its count)."""
    for batch in batches:
        for at, end in _cuts(batch):
            yield _near_of(batch.slice(at, end - at))


def _cuts(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Lists that are looked at together: about as many words as a list may have."""
    sizes = np.diff(batch.column(0).offsets.to_numpy())
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (4 * LIST_WORDS))) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True))


def _near_of(part: pa.RecordBatch) -> pa.RecordBatch:
    held = part.column(0)
    sizes = np.diff(held.offsets.to_numpy())
    names = held.flatten().field("word").to_pylist()
    counts = held.flatten().field("n").to_numpy()
    words = [w.encode("latin-1") for w in names]
    of = np.repeat(np.arange(len(sizes)), sizes)
    shorter, prefix, below = (np.repeat(part.column(i).to_numpy(), sizes) for i in (1, 2, 3))
    us, vs = one_edit_apart(words, of, prefix)
    flat, starts, lengths = _flat(words)
    common = common_prefixes(flat, starts, lengths, us, vs)
    here = (np.minimum(lengths[us], lengths[vs]) == shorter[us]) & (common < below[us])
    us, vs = us[here], vs[here]
    # by word, then the most frequent near word, the smallest of them
    order = np.lexsort((vs, -counts[vs], us))
    us, vs = us[order], vs[order]
    first = np.flatnonzero(np.append(True, us[1:] != us[:-1])[: len(us)])
    near = np.diff(np.append(first, len(us)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([names[i] for i in us[first].tolist()], pa.string()), pa.array(near, pa.int64()),
            pa.array(-counts[vs[first]], pa.int64()), pa.array([names[i] for i in vs[first].tolist()], pa.string()),
        ],
        ["word", "n_near", "least", "form"],
    )


def near_words(words: DataFrame, most: int | None = None) -> DataFrame:
    """``word, n_near, form_n, form`` of every word with a near one: their number, and the most frequent of them."""
    lists = word_lists(words, most).groupBy("list").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("held"))
    # a list of one word has no pair
    lists = lists.filter(F.size("held") > 1).select("held", "list.shorter", "list.prefix", "list.below")
    found = lists.mapInArrow(_near_in, NEAR)
    best = F.min(F.struct("least", "form")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.least")).alias("form_n"), F.col("best.form").alias("form"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` of ``links(word, form)``: the last word that forms lead to.  Forms must not lead in a circle.

    Every round follows twice as many forms as the one before.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = lookup_join(now, ahead, ["root"], "left")
        after = stored(after.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variants-roots")
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    ``form`` is the near word that occurs most often, the smallest of them, if it does ``times`` as often as the word.
    """
    words = stored(vocabulary(docs, doc_id, text), "variants-words")
    near = stored(near_words(words), "variants-near")
    rows = words.join(near, "word", "left")
    formed = F.col("form_n") >= F.lit(times) * F.col("n")
    rows = rows.select(
        "word", F.when(formed, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("form_n")).alias("form_n"),
    )
    rows = stored(rows, "variants-rows")
    led = roots(rows.filter("form is not null"))
    return rows.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
