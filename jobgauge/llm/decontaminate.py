"""Benchmark decontamination by a generalised suffix automaton of the test items."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.llm.automaton import SuffixAutomaton
from jobgauge.llm.words import LETTERS, U64, Words, run_hashes, split_words, text_blocks, word_hashes

#: Consecutive item words that count as a leak; an item of fewer words counts as a whole.
WINDOW_WORDS = 10
#: Characters of benchmark text in one automaton, which every task holds. A larger benchmark takes several passes.
PASS_CHARS = 4_000_000
#: Share of a document's words that makes it contaminated as a whole, see `decontaminate`.
MOST_COVERAGE = 0.5

Hits = list[tuple[int, int, str]]


@dataclass
class ItemIndex:
    """An automaton of items over word hashes, and for its states the windows that end there."""

    automaton: SuffixAutomaton
    windows: dict[int, list[tuple[int, tuple[str, ...]]]]  # state: (length, items)
    first_words: np.ndarray  # sorted hashes of words that are windows of their own
    pairs: np.ndarray  # sorted hashes of two consecutive item words


def build_index(items: list[tuple[str, str]], window_words: int = WINDOW_WORDS) -> ItemIndex:
    """The index of (item_id, text). Items without words have no window."""
    automaton, ending, short = SuffixAutomaton(), {}, []
    pairs, alone = [np.empty(0, U64)], [np.empty(0, U64)]
    column = pa.array([text for _, text in items], pa.string())
    for low, high, offset, data in text_blocks(column):
        words = split_words(offset, data, LETTERS, fold=True)
        hashes = word_hashes(words)
        for row in range(low, high):
            own = hashes[words.first[row - low] : words.first[row - low + 1]]
            pairs.append(run_hashes(own, 2))
            if len(own) == 1:
                alone.append(own)
            states, name = automaton.add(own.tolist()), items[row][0]
            if 0 < len(own) < window_words:
                short.append((states[-1], len(own), name))
            for state in states:
                ending.setdefault(state, set()).add(name)
    for state in automaton.longest_first():  # what ends in a state ends in its suffixes, too
        if automaton.link[state] > 0 and automaton.length[state] > window_words:
            ending.setdefault(automaton.link[state], set()).update(ending.get(state, ()))
    windows: dict[int, list[tuple[int, tuple[str, ...]]]] = {}
    for state, names in ending.items():
        if automaton.length[automaton.link[state]] < window_words <= automaton.length[state]:
            windows.setdefault(state, []).append((window_words, tuple(sorted(names))))
    for state, length, name in short:
        windows.setdefault(automaton.suffix_of(state, length), []).append((length, (name,)))
    return ItemIndex(automaton, windows, np.unique(np.concatenate(alone)), np.unique(np.concatenate(pairs)))


def _known(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def find_hits(index: ItemIndex, hashes: np.ndarray) -> Hits:
    """(first word, end, item) of every window in a text, given by its word hashes.

    Only stretches whose neighbouring words are neighbours in some item are streamed; longer matches lie inside them.
    """
    paired = np.concatenate(([False], _known(run_hashes(hashes, 2), index.pairs), [False]))
    edges = np.flatnonzero(paired[1:] != paired[:-1])
    stretches = [(int(a), int(b) + 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    covered = paired[1:] | paired[:-1]
    stretches += [(int(i), int(i) + 1) for i in np.flatnonzero(_known(hashes, index.first_words) & ~covered[: len(hashes)])]
    automaton, hits = index.automaton, []
    for low, high in stretches:
        for at, (state, matched) in enumerate(automaton.matching(hashes[low:high].tolist()), low + 1):
            while state > 0:
                for length, names in index.windows.get(state, ()):
                    if length <= matched:
                        hits.extend((at - length, at, name) for name in names)
                state = automaton.link[state]
    return hits


def _texts(column: pa.Array) -> Iterator[tuple[int, Words, slice, np.ndarray]]:
    for low, high, offset, data in text_blocks(column):
        words = split_words(offset, data, LETTERS, fold=True)
        hashes = word_hashes(words)
        for row in range(low, high):
            own = slice(words.first[row - low], words.first[row - low + 1])
            yield row, words, own, hashes[own]


def item_passes(benchmark: DataFrame, pass_chars: int = PASS_CHARS) -> Iterator[list[tuple[str, str]]]:
    """The items as (item_id as text, text) in lists of at most `pass_chars` characters, read one list at a time.

    A single longer item makes a list of its own. NULL texts have no words; a NULL item_id is named by an empty text.
    """
    items = benchmark.filter("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"
    )
    batch, chars = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        if batch and chars + len(row.text) > pass_chars:
            yield batch
            batch, chars = [], 0
        batch.append((row.item_id, row.text))
        chars += len(row.text)
    if batch:
        yield batch


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, pass_chars: int = PASS_CHARS
) -> DataFrame:
    """`documents` with the columns _n_words, _spans (hit words as sorted, disjoint [first, end) pairs) and _items.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A to Z lower-cased. A window is
    `window_words` consecutive words of an item, or a whole item of fewer words; each word inside an occurrence of a
    window is hit. _items has the ids of the items whose windows occur, sorted as text. Every task holds the automaton of
    one list of items of bounded size; a larger benchmark takes one more pass over each batch of documents per list,
    in one chain without a shuffle. NULL and empty texts have no words and no hits; repeated rows stay; an empty benchmark
    hits nothing. Other columns pass through, but for ones with the names of the three new ones.
    """
    found = ["_n_words", "_spans", "_items"]
    result = documents.drop(*found).selectExpr(
        "*", "0L AS _n_words", "CAST(array() AS array<struct<first: int, end: int>>) AS _spans", "CAST(array() AS array<string>) AS _items"
    )
    passes = 0
    for items in item_passes(benchmark, pass_chars):
        result, passes = _one_pass(result, items, window_words), passes + 1
    return result if passes else _one_pass(result, [], window_words)


def _one_pass(documents: DataFrame, items: list[tuple[str, str]], window_words: int) -> DataFrame:
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(items)
    place = documents.columns.index("text")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = build_index(shared.value, window_words)
        for batch in batches:
            counts = np.zeros(len(batch), np.int64)
            spans, names = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for row, _, _, hashes in _texts(batch.column(place)):
                counts[row] = len(hashes)
                if hits := find_hits(index, hashes):
                    spans[row] = merged([(s["first"], s["end"]) for s in spans[row]] + [(a, b) for a, b, _ in hits])
                    names[row] = sorted({*names[row], *(name for _, _, name in hits)})
            schema = batch.schema
            new = [pa.array(counts), pa.array(spans, schema.field(-2).type), pa.array(names, schema.field(-1).type)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-3] + new, schema=schema)

    return documents.mapInArrow(search, documents.schema)


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    result: list[dict[str, int]] = []
    for first, end in sorted(spans):
        if result and first <= result[-1]["end"]:
            result[-1]["end"] = max(result[-1]["end"], end)
        else:
            result.append({"first": first, "end": end})
    return result


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    window_words: int = WINDOW_WORDS,
    most_coverage: float = MOST_COVERAGE,
) -> DataFrame:
    """`documents` without benchmark passages: hit spans are cut out of the text; what is around them stays as it is.

    A document with more than `most_coverage` of its words hit is dropped. All else is as in `find_contamination`;
    the columns are those of `documents`.
    """
    marked = find_contamination(documents, benchmark, window_words)
    place = marked.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [i for i, spans in enumerate(batch.column(batch.num_columns - 2).to_pylist()) if spans]
            if hit:
                spans = batch.column(batch.num_columns - 2)
                texts = batch.column(place).to_pylist()
                for row in hit:
                    texts[row] = cut_words(texts[row], [(s["first"], s["end"]) for s in spans[row].as_py()])
                columns = batch.columns
                columns[place] = pa.array(texts, batch.schema.field(place).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    n_hit = F.aggregate("_spans", F.lit(0), lambda total, span: total + span["end"] - span["first"])
    kept = marked.filter(n_hit <= most_coverage * F.col("_n_words"))
    return kept.mapInArrow(cut, kept.schema).select(*documents.columns)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the words of the spans and what is between them."""
    data = text.encode()
    words = split_words(np.array([0, len(data)]), np.frombuffer(data, np.uint8), LETTERS)
    kept, at = [], 0
    for first, end in spans:
        kept.append(data[at : words.start[first]])
        at = int(words.end[end - 1])
    return (b"".join(kept) + data[at:]).decode()
