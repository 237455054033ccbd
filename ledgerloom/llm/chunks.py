"""Removal of passages that repeat across a corpus, found as content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines says where a chunk ends, so
a passage falls into the same chunks wherever it stands. A line as long as a
passage is a chunk of its own. Chunks of several lines, and such long lines, that
occur more than once in the corpus stay where they occur first and go elsewhere.

A passage of a few lines may fall into chunks mixed with its neighbours. Besides
the chunks, the shortest runs of lines that reach ``PASSAGE_WORDS`` from each line
on, and back from each line, are looked up; they follow from the lines alone, and
any longer run of equal lines is covered by those inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.joins import BROADCAST_ROWS, fits_broadcast
from ledgerloom.session import written_table

# Lines the rolling hash looks at, one end of chunk in so many lines, fewest and most lines in a chunk.
WINDOW = 2
ONE_IN = 2
FEWEST_LINES = 2
MOST_LINES = 64
# A line of so many words is a passage by itself.
LONG_LINE_WORDS = 40
# Equal lines in a row are a passage from so many words on, wherever chunks end.
PASSAGE_WORDS = 50

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def chunk_ends(lines: list[bytes]) -> tuple[list[int], list[bool]]:
    """Where each chunk ends (exclusive), and which chunks count as passages.

    A chunk is a passage if it has two or more lines with a word, or is one
    long line.
    """
    long_line = [len(line) >= 2 * LONG_LINE_WORDS - 1 and len(line.split()) >= LONG_LINE_WORDS for line in lines]
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    lead = pow(_BASE, WINDOW, 1 << 64)
    ends, passages, begin, rolling = [], [], 0, 0
    for at, value in enumerate(hashes):
        rolling = (rolling * _BASE + value) & _MASK
        if at >= WINDOW:
            rolling = (rolling - hashes[at - WINDOW] * lead) & _MASK
        last = at + 1 == len(lines)
        size = at + 1 - begin
        cut = size >= FEWEST_LINES and (rolling >> 32) % ONE_IN == 0 or size >= MOST_LINES
        if last or cut or long_line[at] or long_line[at + 1]:
            said = sum(1 for line in lines[begin : at + 1] if line.strip())
            ends.append(at + 1)
            passages.append(said >= 2 or (said == 1 and any(long_line[begin : at + 1])))
            begin = at + 1
    return ends, passages


def passages_of(text: str | None) -> Iterator[tuple[int, bytes]]:
    """Position and bytes of every chunk of a whole text that counts as a passage."""
    if text is None:
        return
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    ends, passages = chunk_ends(lines)
    begin = 0
    for number, (end, passage) in enumerate(zip(ends, passages)):
        if passage:
            yield number, b"\n".join(lines[begin:end])
        begin = end


def shortest_runs(lines: list[bytes]) -> set[tuple[int, int]]:
    """Runs of lines (begin, end) with ``PASSAGE_WORDS`` words that lose them without their first or their last line."""
    counts = [len(line.split()) for line in lines]
    said = [at for at, n in enumerate(counts) if n]
    runs, words, first = set(), 0, 0
    for at in said:
        # The shortest run that ends here.
        words += counts[at]
        while words - counts[said[first]] >= PASSAGE_WORDS:
            words -= counts[said[first]]
            first += 1
        if words >= PASSAGE_WORDS:
            runs.add((said[first], at + 1))
    words, last = 0, 0
    for at in said:
        # The shortest run that begins here.
        while last < len(said) and words < PASSAGE_WORDS:
            words += counts[said[last]]
            last += 1
        if words < PASSAGE_WORDS:
            break
        runs.add((at, said[last - 1] + 1))
        words -= counts[at]
    return runs


def spans_of(lines: list[bytes], runs: bool) -> list[tuple[int, int]]:
    """Where passages stand: the chunks that count as such, and with ``runs`` the shortest runs of lines."""
    ends, passages = chunk_ends(lines)
    spans = {span for span, passage in zip(zip([0, *ends], ends), passages) if passage}
    return sorted(spans | shortest_runs(lines) if runs else spans)


def _halves(digests: list[bytes]) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(b"".join(digests)), np.int64)
    return int(digest[0]), int(digest[1])


def listing(with_text: bool, runs: bool):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * with_text
        names = ["k0", "k1", "begin", "end", "h0", "h1"] + ["chunk"] * with_text
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            ids, keys = batch.column("k0").to_pylist(), batch.column("k1").to_pylist()
            for k0, k1, text in zip(ids, keys, batch.column("text")):
                if not text.is_valid:
                    continue
                lines = text.as_py().encode("utf-8", "surrogatepass").split(b"\n")
                digests = [xxhash.xxh3_128_digest(line) for line in lines]
                for begin, end in spans_of(lines, runs):
                    chunk = (b"\n".join(lines[begin:end]),) if with_text else ()
                    rows.append((k0, k1, begin, end, *_halves(digests[begin:end]), *chunk))
                    size += sum(map(len, chunk))
                    if size > 1 << 24 or len(rows) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return listed


def quoting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the passages listed in ``places``."""
    types, names = [pa.int64(), pa.int64(), pa.binary()], ["h0", "h1", "chunk"]
    for batch in batches:
        for text, places in zip(batch.column("text"), batch.column("places")):
            lines = text.as_py().encode("utf-8", "surrogatepass").split(b"\n")
            rows: list[tuple] = []
            size = 0
            for place in places.as_py():
                rows.append((place["h0"], place["h1"], b"\n".join(lines[place["begin"] : place["end"]])))
                size += len(rows[-1][2])
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with plain column names and the two row keys; null ids sort last as the largest long."""
    plain = docs.toDF(*[f"c{at}" for at in range(len(docs.columns))])
    doc_id, text = (plain[f"c{docs.columns.index(name)}"] for name in ("doc_id", "text"))
    largest = F.lit((1 << 63) - 1).cast("long")
    return plain.select(
        "*", F.coalesce(doc_id.cast("long"), largest).alias("k0"), F.xxhash64(text).alias("k1"), text.alias("text")
    )


def repeated_passages(docs: DataFrame, most_rows: int = BROADCAST_ROWS, runs: bool = False) -> DataFrame:
    """``k0, k1, begin, end, h0, h1, owner``: every place of a passage that repeats, with the id that keeps it.

    The bytes of passages are compared by counting rows by the passage itself, in
    the map tasks before anything is shuffled, so a very common passage moves
    once per task. While the hashes that repeat are few enough to broadcast, the
    others leave before that; beyond ``most_rows`` documents get the places of
    theirs by a shuffle, to the same result. Passages whose hash is shared by
    different bytes are left alone.
    """
    rows = keyed(docs).select("k0", "k1", "text")
    schema = "k0 long, k1 long, begin int, end int, h0 long, h1 long"
    keys = written_table(rows.mapInArrow(listing(False, runs), schema), "chunk-keys")
    counted = keys.groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("n"), F.min("k0").alias("owner")).where("n > 1")
    often = written_table(counted.select("h0", "h1", "owner"), "chunk-often")
    hashes = often.select("h0", "h1")
    if fits_broadcast(hashes, most_rows):
        texts = rows.mapInArrow(listing(True, runs), schema + ", chunk binary")
        texts = texts.join(F.broadcast(hashes), ["h0", "h1"], "left_semi")
    else:
        found = keys.join(hashes.hint("merge"), ["h0", "h1"])
        places = found.groupBy("k0", "k1").agg(F.collect_set(F.struct("begin", "end", "h0", "h1")).alias("places"))
        texts = rows.join(places.hint("merge"), ["k0", "k1"]).select("text", "places")
        texts = texts.mapInArrow(quoting, "h0 long, h1 long, chunk binary")
    different = (
        texts.groupBy("h0", "h1", "chunk").agg(F.lit(1).alias("kind")).groupBy("h0", "h1").agg(F.count("kind").alias("kinds"))
    )
    compared = often.join(different.where("kinds = 1"), ["h0", "h1"]).select("h0", "h1", "owner")
    return keys.join(written_table(compared, "chunk-owners").hint("merge"), ["h0", "h1"])


def dropped_spans(places: list[dict]) -> list[tuple[int, int]]:
    """Which of a document's repeated passages go: all that another document keeps, and its own behind the first."""
    first: dict[tuple[int, int], int] = {}
    gone = []
    for place in sorted(places, key=lambda p: p["begin"]):
        # A place that overlaps the first one is no copy of it.
        kept_to = first.setdefault((place["h0"], place["h1"]), place["end"])
        if not place["mine"] or place["begin"] >= kept_to:
            gone.append((place["begin"], place["end"]))
    return gone


def cutting(doc: str):
    """Put texts together again without the repeated passages, listed in ``places``, that other places keep."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, dropped_lines, dropped_chunks = [], [], []
            for text, places in zip(batch.column(doc).to_pylist(), batch.column("places").to_pylist()):
                n_lines = n_chunks = 0
                spans = dropped_spans(places or [])
                if text is not None and spans:
                    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
                    gone = np.zeros(len(lines) + 1, np.int64)
                    np.add.at(gone, [begin for begin, _ in spans], 1)
                    np.add.at(gone, [end for _, end in spans], -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    ends, _ = chunk_ends(lines)
                    n_lines = int(gone.sum())
                    n_chunks = int(np.logical_or.reduceat(gone, [0, *ends[:-1]]).sum())
                    kept = [line for line, cut_out in zip(lines, gone.tolist()) if not cut_out]
                    text = b"\n".join(kept).decode("utf-8", "surrogatepass")
                texts.append(text)
                dropped_lines.append(n_lines)
                dropped_chunks.append(n_chunks)
            columns = {name: batch.column(name) for name in batch.schema.names if name != "places"}
            columns[doc] = pa.array(texts, batch.schema.field(doc).type)
            columns["removed_lines"] = pa.array(dropped_lines, pa.int64())
            columns["removed_chunks"] = pa.array(dropped_chunks, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return cut


def remove_repeated(
    docs: DataFrame, counts: bool = False, runs: bool = False, most_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; all rows and columns stay.

    A passage stays once, in the rows with the smallest doc_id that hold it (a
    null id comes last) and there at its first place. Rows that share a doc_id
    count as one document in this, so identical rows stay identical. Null texts
    stay null, empty ones empty; a text may become empty. With ``runs``,
    as op7_line_chunks has it, runs of equal lines that have ``PASSAGE_WORDS``
    go besides the chunks, wherever chunks end; without, whole chunks alone.
    Other short single lines are never touched. With ``counts``,
    ``removed_lines`` and ``removed_chunks``, the chunks that lost a line, are
    added behind the other columns. Up to ``most_rows`` keys of texts that lose a
    passage are broadcast; beyond, all texts are shuffled, to the same result.
    """
    place = F.struct("begin", "end", "h0", "h1", (F.col("owner") == F.col("k0")).alias("mine"))
    # Straight to documents: a passage that very many share leaves its task before it is gathered. Rows equal in id and
    # text have the same places, which count once.
    places = repeated_passages(docs, most_rows, runs).groupBy("k0", "k1").agg(F.collect_set(place).alias("places"))
    rows = keyed(docs).drop("text")
    text = f"c{docs.columns.index('text')}"
    places = written_table(places, "chunk-places")
    plain = [f"c{at}" for at in range(len(docs.columns))]
    held = places.select("k0", "k1")
    others = None
    if fits_broadcast(held, most_rows):
        # Only texts that lose something are shuffled; the others stay where they are.
        none = F.lit(0).cast("long")
        others = rows.join(F.broadcast(held), ["k0", "k1"], "left_anti").select(*plain, none.alias("removed_lines"), none.alias("removed_chunks"))
        rows = rows.join(F.broadcast(held), ["k0", "k1"], "left_semi")
    out = rows.join(places.hint("merge"), ["k0", "k1"], "left").select(*plain, "places")
    schema = out.drop("places").schema.add("removed_lines", "long").add("removed_chunks", "long")
    cut = out.mapInArrow(cutting(text), schema)
    cut = cut if others is None else cut.union(others)
    names = [*docs.columns, "removed_lines", "removed_chunks"]
    cut = cut.toDF(*names) if len(set(names)) == len(names) else cut.select(
        *[F.col(a).alias(b) for a, b in zip(cut.columns, names)]
    )
    return cut if counts else cut.select(*[cut.columns[at] for at in range(len(docs.columns))])


