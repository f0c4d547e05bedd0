"""Removal of passages that repeat earlier ones, exact to the word, by suffix automata over shards of the corpus.

Each window of words has an anchor: of the short runs of words in it, the one with the least hash. It depends on nothing
but the window, so equal windows have equal anchors. Neighbouring windows of a text with one anchor form a segment. Only
segments whose anchor occurs elsewhere too can hold a repeat, and all places of a window meet under its anchor: there the
distinct segments go, in the order of the corpus, through a suffix automaton that tells for each of their words how long a
passage ending in it occurred before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge.llm.automaton import SuffixAutomaton
from jobgauge.llm.words import NOT_SPACE, U64, mixed, powers, run_hashes, signed, split_words, text_blocks, word_hashes
from jobgauge.sources.scratch import written

#: Words of a window, and of the runs one of which is its anchor.
WINDOW_WORDS = 20
ANCHOR_WORDS = 5
#: Distinct segments of one anchor that go through one automaton; beyond, windows meet one by one.
MOST_SEGMENTS = 1000
#: Segments of a shard, about.
SHARD_SEGMENTS = 1000
LEAST_SHARDS = 64
_BASE = 0xC2B2AE3D27D4EB4F


def segments(hashes: np.ndarray, window_words: int = WINDOW_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, content hash, first word, number of windows) of the segments of a text, given by its word hashes."""
    windows = len(hashes) - window_words + 1
    if windows <= 0:
        return (np.empty(0, U64),) * 2 + (np.empty(0, np.int64),) * 2
    width = min(ANCHOR_WORDS, window_words)
    runs = run_hashes(hashes, width)
    places = window_words - width + 1
    at = np.empty(windows, np.int64)
    for low in range(0, windows, 1 << 16):
        part = sliding_window_view(runs[low : min(windows, low + (1 << 16)) + places - 1], places)
        at[low : low + len(part)] = part.argmin(axis=1) + np.arange(low, low + len(part))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.append(first, windows))
    end = first + count + window_words - 1
    prefix = np.concatenate(([U64(0)], np.cumsum(hashes * powers(_BASE, len(hashes))[: len(hashes)], dtype=U64)))
    value = (prefix[end] - prefix[first]) * powers(pow(_BASE, -1, 2**64), len(hashes))[first]
    return runs[at[first]], mixed(value + mixed((end - first).astype(U64))), first, count


def _segment_table(documents: DataFrame, window_words: int) -> DataFrame:
    """key, content, doc, part, first and n of all segments."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for low, high, offset, data in text_blocks(batch.column(2)):
                words = split_words(offset, data, NOT_SPACE)
                hashes = word_hashes(words)
                found, rows = [], []
                for row in range(low, high):
                    own = hashes[words.first[row - low] : words.first[row - low + 1]]
                    if len(own) >= window_words:
                        found.append(segments(own, window_words))
                        rows.append(np.full(len(found[-1][0]), row))
                if found:
                    key, content, first, count = map(np.concatenate, zip(*found, strict=True))
                    row = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays(
                        [signed(key), signed(content), pa.array(ids[row]), pa.array(place(parts[row], first)), pa.array(count.astype(np.int32))],
                        ["key", "content", "doc", "place", "n"],
                    )

    return documents.select("doc", "part", "text").mapInArrow(
        emit, "key bigint, content bigint, doc bigint, place bigint, n int"
    )


def place(part: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Part and first word in one number that sorts as both."""
    return (part << 32) | first


def _part_of(place: Column) -> Column:
    return F.shiftright(place, 32)


def _first_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit(0xFFFFFFFF))


def repeated_spans(documents: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """(doc, part, first, end) of passages of repeated windows; they overlap. `documents` has doc, part and text."""
    every = _segment_table(documents, window_words)
    # A semi-join of the table with itself: one shuffle serves both sides, and very frequent anchors are split.
    left, right = _prefixed(every, "a_"), _prefixed(every, "b_")
    elsewhere = (F.col("a_doc") != F.col("b_doc")) | (F.col("a_place") != F.col("b_place"))
    met = left.join(right, (F.col("a_key") == F.col("b_key")) & elsewhere, "left_semi")
    met = written(met.select(*[F.col(f"a_{c}").alias(c) for c in every.columns]).distinct(), "segments")
    # Of equal segments all but the first repeat as a whole.
    order = F.struct("doc", "place")
    distinct = written(met.groupBy("key", "content", "n").agg(F.min(order).alias("least")), "distinct-segments")
    copies = (
        met.join(distinct, ["key", "content", "n"])
        .filter(order != F.col("least"))
        .select("doc", _part_of(F.col("place")).alias("part"), _first_of(F.col("place")).alias("first"), "n")
    )
    copies = copies.select("doc", "part", "first", (F.col("first") + F.col("n") + window_words - 1).alias("end"))
    copies = written(copies, "copied-spans")
    # The first places of different segments with one anchor are compared word by word.
    counts = distinct.groupBy("key").agg(F.count("*").alias("segments")).filter("segments > 1")
    contested = distinct.join(counts, "key").select(
        "key", (F.col("segments") > MOST_SEGMENTS).alias("many"), "least.doc", "least.place", "n"
    )
    contested = written(contested, "contested-segments")
    shards = max(LEAST_SHARDS, contested.filter("NOT many").count() // SHARD_SEGMENTS)
    texts = _contested_texts(documents, contested, shards, window_words)
    single = written(_earlier_windows(texts.filter("words IS NULL"), window_words), "window-spans")
    matched = _matched(texts.filter("words IS NOT NULL"), window_words)
    return copies.unionByName(single).unionByName(matched)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _contested_texts(documents: DataFrame, contested: DataFrame, shards: int, window_words: int) -> DataFrame:
    """The words of contested segments with their shard; for anchors with many, the hash of each window instead."""
    wanted = contested.groupBy("doc", _part_of(F.col("place")).alias("part")).agg(
        F.collect_list(F.struct("key", "many", _first_of(F.col("place")).alias("first"), "n")).alias("wanted")
    )
    joined = documents.join(wanted, ["doc", "part"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, wishes = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for low, high, offset, data in text_blocks(batch.column(2)):
                words = split_words(offset, data, NOT_SPACE)
                hashes = word_hashes(words)
                shard, key, doc, at, texts = [], [], [], [], []
                for row in range(low, high):
                    own = hashes[words.first[row - low] : words.first[row - low + 1]]
                    for wish in wishes[row].as_py():
                        first, n = wish["first"], wish["n"]
                        text = own[first : first + n + window_words - 1]
                        entries = (
                            [(int(h), first + i, None) for i, h in enumerate(run_hashes(text, window_words).view(np.int64))]
                            if wish["many"]
                            else [(wish["key"], first, text.view(np.int64))]
                        )
                        for k, f, t in entries:
                            key.append(k)
                            shard.append(k % shards)
                            doc.append(ids[row])
                            at.append((parts[row] << 32) | f)
                            texts.append(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(texts, pa.list_(pa.int64()))],
                    ["shard", "key", "doc", "place", "words"],
                )

    found = joined.select("doc", "part", "text", "wanted").mapInArrow(
        emit, "shard bigint, key bigint, doc bigint, place bigint, words array<bigint>"
    )
    return written(found, "contested-words")


def _earlier_windows(windows: DataFrame, window_words: int) -> DataFrame:
    least = windows.groupBy("key").agg(F.min(F.struct("doc", "place")).alias("least"))
    later = windows.join(least, "key").filter(F.struct("doc", "place") != F.col("least"))
    first = _first_of(F.col("place"))
    return later.select("doc", _part_of(F.col("place")).alias("part"), first.alias("first"), (first + window_words).alias("end"))


def _matched(texts: DataFrame, window_words: int) -> DataFrame:
    """Spans of segments that an automaton of the earlier segments of their anchor has seen."""

    def match(shard: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int, int]] = []
        shard = shard.sort_values(["key", "doc", "place"])
        last_key = last_place = None
        for key, doc, at, words in zip(shard["key"], shard["doc"], shard["place"], shard["words"], strict=True):
            if key != last_key:
                automaton, last_key, last_place = SuffixAutomaton(), key, None
            if (doc, at) == last_place:  # equal rows of the documents
                continue
            last_place, part, first = (doc, at), at >> 32, at & 0xFFFFFFFF
            for low, high in long_matches(automaton.add_matching(words.tolist()), window_words):
                rows.append((doc, part, first + low, first + high))
        return pd.DataFrame(rows, columns=["doc", "part", "first", "end"], dtype="int64")

    return texts.groupBy("shard").applyInPandas(match, "doc bigint, part bigint, first bigint, end bigint")


def long_matches(lengths: Iterator[int], window_words: int) -> list[tuple[int, int]]:
    """Disjoint [first, end) word spans covered by matches of at least `window_words`."""
    spans: list[list[int]] = []
    for end, matched in enumerate(lengths, 1):
        if matched >= window_words:
            if spans and end - window_words <= spans[-1][1]:
                spans[-1][1] = end
            else:
                spans.append([end - window_words, end])
    return [(low, high) for low, high in spans]


def remove_repeats(documents: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """`documents` with the kept words as text, joined by single blanks, and _n_words and _n_removed.

    Words are runs between ASCII white space. A window is `window_words` consecutive words of one document; every word
    covered by a window whose words also start earlier is removed: in a document with a smaller doc_id, or earlier in the
    same one. A NULL text stays NULL and has no words; shorter texts lose nothing. A NULL doc_id comes first. Rows with one
    doc_id and different texts are documents of their own, ordered by a hash of the text; equal rows are one document, of
    which every row has the result. Other columns pass through, but for ones named _n_words, _n_removed, _doc, _part,
    _spans. Words are compared by 64-bit hashes. doc_id is a whole number.
    """
    documents = documents.drop("_n_words", "_n_removed", "_doc", "_part", "_spans")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    part = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))
    read = documents.select(doc.alias("doc"), part.alias("part"), "text").filter("text <> ''")
    spans = repeated_spans(read, window_words)
    per_document = spans.groupBy(F.col("doc").alias("_doc"), F.col("part").alias("_part")).agg(
        F.collect_set(F.struct("first", "end")).alias("_spans")
    )
    per_document = written(per_document, "removed-spans")
    joined = documents.join(per_document, (doc == F.col("_doc")) & (part == F.col("_part")), "left").drop("_doc", "_part")
    at = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, column = batch.column(batch.num_columns - 1), batch.column(at)
            texts, counts, removed = [], np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for low, high, offset, data in text_blocks(column):
                words = split_words(offset, data, NOT_SPACE)
                for row in range(low, high):
                    first, end = words.first[row - low], words.first[row - low + 1]
                    gone = np.zeros(end - first + 1, np.int32)
                    for span in spans[row].as_py() or ():
                        gone[span["first"]] += 1
                        gone[span["end"]] -= 1
                    kept = first + np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    counts[row], removed[row] = end - first, end - first - len(kept)
                    raw = data[offset[row - low] : offset[row - low + 1]].tobytes()
                    if removed[row]:
                        raw = b" ".join(words.text(word) for word in kept)
                    texts.append(b" ".join(raw.split()) if column[row].is_valid else None)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            names = [*batch.schema.names[:-1], "_n_words", "_n_removed"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), pa.array(removed)], names)

    return joined.mapInArrow(keep, documents.selectExpr("*", "0L AS _n_words", "0L AS _n_removed").schema)
