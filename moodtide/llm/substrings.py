"""Removal of word sequences that repeat anywhere in the corpus (super-k-mer partitioning)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moodtide.llm import words as W
from moodtide.llm.frames import map_batches, plus, row_of, text_buffers, whole_keys

WINDOW = 35  # words of a window
MINIMISER = 8  # words of the grams among which a window's minimiser is chosen
LONGEST_RUN = 64  # windows of one super-k-mer; a longer run becomes several
HOT_RUNS = 20_000  # super-k-mers of one minimiser beyond which each window travels alone
BUCKET_ROWS = 4_000  # super-k-mers sorted at once, and at least one whole bucket

RUNS = "__id {id}, __h long, start int, n int, key long, weight int"
PIECES = "__id {id}, __h long, start int, key long, packed string"
SPACES = W.white_space()


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, minimiser: int = MINIMISER,
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """All rows and columns of ``docs`` plus n_words, n_removed (long) and kept_text (string).

    Words are runs of bytes other than blank and \\t..\\r. A window is ``window``
    consecutive words of one row. Every word covered by a window whose words also
    start at another place, in the same row or another, is removed; all windows
    are judged on the input. kept_text is what stays, joined by one blank.

    1. Each window's minimiser is the least hash of its ``minimiser``-word grams;
       consecutive windows with the same one form a super-k-mer. Windows with
       equal words have equal minimisers, so only super-k-mers whose minimiser is
       seen twice can hold a repeated window; this join drops the others before
       any text moves.
    2. The rest travel as one string of words to the bucket of their minimiser.
       Equal strings are counted before the shuffle, so copies of a passage cost
       one row for each task. A minimiser with over ``hot_runs`` super-k-mers
       sends windows singly, to buckets of their own hash: no bucket grows with a
       passage that a third of all rows share.
    3. A bucket sorts its windows by hash and compares neighbours word for word;
       occurrences add up exactly. Covered ranges go back to their rows.

    Null texts have no words (kept_text is ''); a text shorter than a window keeps
    all. Repeated rows and rows that share an id count each for itself, as rows are
    told apart by id and text hash; a null id is an id. Other columns pass through.
    Long texts are cut into super-k-mers of bounded length; an empty table gives an
    empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__h")
    texts = docs.select(*key, F.col(text_col).alias("__text"))
    runs = map_batches(texts, lambda b: _runs(b, window, minimiser), RUNS.format(id=kind), "__text")
    seen = runs.groupBy("key").agg(F.sum("weight").alias("n_seen"), F.count("*").alias("n_runs")).where("n_seen > 1")
    alive = runs.join(seen.select("key", (F.col("n_runs") > hot_runs).alias("hot")), "key")
    by_row = alive.groupBy(F.col("__id").alias("i"), F.col("__h").alias("h")).agg(
        F.collect_set(F.struct("start", "n", "key", "hot")).alias("runs")
    )
    met = (F.col("__id").eqNullSafe(F.col("i"))) & (F.col("__h") == F.col("h"))
    holding = texts.join(by_row, met).select("__id", "__h", "__text", "runs")
    pieces = map_batches(holding, lambda b: _pieces(b, window), PIECES.format(id=kind), "__text")
    strings = pieces.groupBy("key", "packed").agg(F.count("*").alias("copies"))
    # 128 bits name a string: two hashes of different seeds.
    mark = F.xxhash64("packed").alias("mark"), F.xxhash64(F.lit(1), "packed").alias("more")
    buckets = strings.repartition("key").sortWithinPartitions("key").select("key", "packed", "copies", *mark)
    covers = buckets.mapInArrow(lambda it: _sorted_buckets(it, window), "mark long, more long, cover array<int>")
    places = pieces.select("__id", "__h", "start", *mark).join(covers, ["mark", "more"])
    repeats = places.groupBy(F.col("__id").alias("i"), F.col("__h").alias("h")).agg(
        F.collect_set(F.struct("start", "cover")).alias("covers")
    )
    rows = docs.select(row_of(docs).alias("__row"), *key, F.col(text_col).alias("__text"))
    if set(docs.columns) == {id_col, text_col}:  # then the shuffle of the texts above serves here too
        rows = texts
    out = rows.join(repeats, met, "left")
    out = out.select(*([] if rows is texts else ["__row"]), "__id", "__text", "covers")
    body = out.schema.fieldNames()[:-1]
    done = map_batches(out, _removed, plus(out, body, "n_words long, n_removed long, kept_text string"), "__text")
    if rows is texts:
        names = {id_col: "__id", text_col: "__text"}
        return done.select(*(F.col(names[c]).alias(c) for c in docs.columns), "n_words", "n_removed", "kept_text")
    own = [F.col("__row")[c].alias(c) for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    return done.select(*own, "n_words", "n_removed", "kept_text")


def _words(batch: pa.RecordBatch) -> W.Words:
    return W.find(*text_buffers(batch.column("__text")), SPACES)


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    out, have = grams, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _runs(batch: pa.RecordBatch, window: int, minimiser: int) -> pa.RecordBatch:
    """Super-k-mers of a batch: first word, number of windows, minimiser, weight.

    The weight is 2 if the minimiser occurs twice within, as then two windows of
    the same super-k-mer may be equal.
    """
    w = _words(batch)
    width = window - minimiser + 1
    n = len(w.starts) - window + 1
    if n > 0:
        grams = W.gram_hashes(w.hashes(), minimiser)
        at = np.flatnonzero(w.doc[:n] == w.doc[window - 1 :])
    if n <= 0 or not len(at):
        at = np.zeros(0, np.int64)
        begin = at
        keys = np.zeros(0, np.uint64)
        size = weight = at
    else:
        keys = _least(grams, width)[at]
        new = np.ones(len(at), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (w.doc[at[1:]] != w.doc[at[:-1]])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at)))
        if size.max() > LONGEST_RUN:
            parts = -(-size // LONGEST_RUN)
            order = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            begin = np.repeat(begin, parts) + order * LONGEST_RUN
            size = np.minimum(np.repeat(size, parts) - order * LONGEST_RUN, LONGEST_RUN)
        first, last = at[begin], at[begin + size - 1]
        keys = keys[begin]
        grid = np.arange(width)
        weight = np.empty(len(begin), np.int32)
        for k in range(0, len(begin), 65_536):
            part = slice(k, k + 65_536)
            low = (grams[first[part, None] + grid] == keys[part, None]).argmax(1) + first[part]
            back = (grams[last[part, None] + grid[::-1]] == keys[part, None]).argmax(1)
            weight[part] = 1 + (last[part] + width - 1 - back != low)
        at = first
    doc = w.doc[at] if len(at) else np.zeros(0, np.int64)
    rows = pa.array(doc, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("__id").take(rows),
            batch.column("__h").take(rows),
            pa.array(at - w.first[doc], pa.int32()),
            pa.array(size, pa.int32()),
            pa.array(keys.view(np.int64)),
            pa.array(weight, pa.int32()),
        ],
        ["__id", "__h", "start", "n", "key", "weight"],
    )


def _pieces(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """The words of each super-k-mer as one string; a hot one as its single windows."""
    w = _words(batch)
    runs = batch.column("runs")
    owner = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
    flat = runs.flatten()
    start, n, key, hot = (np.asarray(flat.field(k).to_numpy(zero_copy_only=False)) for k in range(4))
    each = np.where(hot, n, 1)
    order = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    owner, key, hot, n = (np.repeat(x, each) for x in (owner, key, hot, n))
    start = np.repeat(start, each) + order
    length = np.where(hot, 1, n) + window - 1
    begin = w.first[owner] + start
    if hot.any():
        grams = W.gram_hashes(w.hashes(), window)
        key = np.where(hot, grams[np.minimum(begin, len(grams) - 1)].view(np.int64), key)
    lows, highs = w.starts[begin], w.ends[begin + length - 1]
    text = w.raw.tobytes()
    packed = [b" ".join(text[a:b].split()) for a, b in zip(lows.tolist(), highs.tolist())]
    rows = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("__id").take(rows),
            batch.column("__h").take(rows),
            pa.array(start, pa.int32()),
            pa.array(key, pa.int64()),
            pa.array(packed, pa.binary()).cast(pa.string()),
        ],
        ["__id", "__h", "start", "key", "packed"],
    )


def _sorted_buckets(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for table in whole_keys(batches, "key", BUCKET_ROWS):
        packed = table.column("packed").to_pylist()
        copies = table.column("copies").to_numpy()
        keys = table.column("key").to_numpy()
        codes: dict[str, int] = {}
        tokens = [[codes.setdefault(x, len(codes)) for x in p.split(" ")] for p in packed]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        first = np.cumsum(sizes) - sizes
        ids = np.concatenate([np.asarray(t, np.int32) for t in tokens])
        held = sizes - window + 1  # windows of each string
        owner = np.repeat(np.arange(len(packed)), held)
        begin = np.repeat(first - (np.cumsum(held) - held), held) + np.arange(held.sum())
        twice = np.zeros(len(begin), bool)
        names = W.gram_hashes(W.mixed(ids.astype(np.uint64) + np.uint64(1)), window)[begin]
        # Equal windows have equal keys; a bucket of the hash is the same for both.
        order = np.lexsort((names, keys[owner]))
        same = _equal_neighbours(ids, begin, order, names, keys[owner], window)
        group = np.cumsum(~np.concatenate([[False], same])) - 1
        total = np.bincount(group, copies[owner[order]])
        twice[order] = total[group] > 1
        ends = np.cumsum(held)
        some = np.unique(owner[twice])
        spans = [_ranges(twice[a:b], window) for a, b in zip((ends - held)[some].tolist(), ends[some].tolist())]
        marks = table.select(["mark", "more"]).take(pa.array(some))
        yield from marks.append_column("cover", pa.array(spans, pa.list_(pa.int32()))).to_batches()


def _equal_neighbours(ids, begin, order, names, keys, window) -> np.ndarray:
    """Whether each window in ``order`` has the words of the one before it.

    Windows of equal hash but other words (never seen) are put in exact order.
    """
    while True:
        a, b = order[:-1], order[1:]
        likely = (names[a] == names[b]) & (keys[a] == keys[b])
        equal = likely.copy()
        for k in range(window):
            equal[likely] &= ids[begin[a[likely]] + k] == ids[begin[b[likely]] + k]
        if (equal == likely).all():
            return equal
        names = _exact_ranks(ids, begin, window)
        order[:] = np.lexsort((names, keys))


def _exact_ranks(ids: np.ndarray, begin: np.ndarray, window: int) -> np.ndarray:
    grid = np.lib.stride_tricks.sliding_window_view(ids, window)[begin]
    return np.unique(grid, axis=0, return_inverse=True)[1].ravel()


def _ranges(twice: np.ndarray, window: int) -> list[int]:
    """Word ranges [from, to) covered by the marked windows, as one flat list."""
    edge = np.diff(np.concatenate([[0], twice.astype(np.int8), [0]]))
    begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + window - 1
    return np.stack([begins, stops], 1).ravel().tolist()


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    w = _words(batch)
    n_words = np.diff(w.first)
    steps = np.zeros(len(w.starts) + 1, np.int64)
    covers = batch.column("covers").to_pylist()
    for row, places in enumerate(covers):
        for place in places or ():
            base = w.first[row] + place["start"]
            flat = place["cover"]
            for k in range(0, len(flat), 2):
                steps[base + flat[k]] += 1
                steps[base + flat[k + 1]] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    below = np.concatenate([[0], np.cumsum(gone)])
    n_removed = below[w.first[1:]] - below[w.first[:-1]]
    text = w.raw.tobytes()
    kept = []
    for row in range(batch.num_rows):
        a, b = w.first[row], w.first[row + 1]
        if n_removed[row]:
            stay = np.flatnonzero(~gone[a:b]) + a
            kept.append(b" ".join(text[x:y] for x, y in zip(w.starts[stay].tolist(), w.ends[stay].tolist())))
        else:
            kept.append(b" ".join(text[w.starts[a] : w.ends[b - 1]].split()) if b > a else b"")
    body = [c for c in batch.schema.names if c != "covers"]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in body), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        [*body, "n_words", "n_removed", "kept_text"],
    )
