"""Many lexicons over a text in one pass, whatever the number of terms."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType


class Lexicons:
    """An Aho-Corasick automaton of all terms; each ends with its number, its length and the lexicons it belongs to."""

    def __init__(self, lists: Mapping[str, Iterable[str]]):
        self.names = list(lists)
        owners: dict[str, list[int]] = {}
        for k, terms in enumerate(lists.values()):
            for term in dict.fromkeys(terms):
                if not term:
                    raise ValueError("an empty term occurs everywhere")
                owners.setdefault(term, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for number, (term, own) in enumerate(owners.items()):
            self.automaton.add_word(term, (number, len(term), tuple(own)))
        if owners:
            self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[list[int], list[int]]:
        """Of each lexicon how many terms occur, and how often its terms occur, a term's own occurrences not overlapping."""
        distinct, counts = [0] * len(self.names), [0] * len(self.names)
        if not len(self.automaton):
            return distinct, counts
        ends: dict[int, int] = {}  # where each term met so far was last counted
        for last, (number, size, own) in self.automaton.iter(text):
            before = ends.get(number)
            if before is None:
                for k in own:
                    distinct[k] += 1
            elif last - size < before:
                continue
            ends[number] = last
            for k in own:
                counts[k] += 1
        return distinct, counts


def lexicon_hits(df: DataFrame, lists: Mapping[str, Iterable[str]], text: str = "text") -> DataFrame:
    """``df`` with ``<name>_distinct`` and ``<name>_count`` for each lexicon.

    The same figures as ``distinct_hits`` and ``count_hits`` over the lowered text,
    which take one search for each term and so suit a handful of them; here a text is
    read once and the terms, which travel with the tasks as one automaton, only cost
    memory. A null text has null figures. A column of a result's name is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast({k: tuple(v) for k, v in lists.items()})
    names = [f"{k}_{kind}" for k in lists for kind in ("distinct", "count")]
    kept = df.drop(*names)
    low = next(f"_low{i}" for i in range(len(kept.columns) + 1) if f"_low{i}" not in kept.columns)
    schema = StructType([*kept.schema.fields, *[StructField(n, LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = Lexicons(shared.value)
        nothing = [None] * len(names)
        for batch in batches:
            rows = []
            for body in batch.column(low):
                value = body.as_py()
                rows.append(nothing if value is None else [x for pair in zip(*lexicons.hits(value)) for x in pair])
            found = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
            plain = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != low]
            yield pa.RecordBatch.from_arrays([*plain, *found], schema.names)

    return kept.withColumn(low, F.lower(F.col(f"`{text}`"))).mapInArrow(run, schema)
