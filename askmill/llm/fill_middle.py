"""Fill-in-middle rearrangement of documents by a secondary sort of their pieces.

A text is cut into units (a word with the ASCII white space before it, or trailing white space) and,
at two unit boundaries that a hash of doc_id picks, into prefix, middle and suffix. A document leaves
the cut as pieces of at most ``UNITS`` units and ``BYTES`` bytes, each with its position in the output,
the sentinels being pieces of their own. The pieces are dealt by document and sorted by document and
output position within partitions (the DataFrame form of ``repartitionAndSortWithinPartitions``), so a
task reads every output in order, piece by piece, and feeds it to an incremental digest. The same pass
finds the sentinels in the output and gives each piece its position in the original text; sorting the
partition once more by it, without a further shuffle, streams the restored text into a second digest.

A document is never held whole after the cut; a task holds one batch of pieces. A row's pieces are
keyed by doc_id, a 128-bit hash of the text and the input partition, so no key grows with the table
and a hot source or text is spread like any other row.

Null text is empty; an empty text, or one that holds a sentinel, is ``plain``. A null doc_id is hashed as
if its number were the empty string. Rows that repeat a doc_id give a row each, cut alike where their texts
are equal. An empty table gives no rows. Columns other than the two named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import id_and_text

#: The sentinels, and the shares of documents and of their two forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, CUT_PERCENT, SPM_PERCENT = 42, 50, 80

UNITS, BYTES = 4096, 1 << 16
#: Pieces leave Python in batches of about this many bytes or rows.
BATCH_BYTES, BATCH_ROWS = 1 << 23, 20_000

KEY = ["doc_id", "text_hash", "part"]
_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.binary()),
        ("part", pa.int32()),
        ("place", pa.int64()),
        ("form", pa.string()),
        ("n", pa.int64()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("chunk", pa.binary()),
    ]
)
PIECES = (
    "doc_id long, text_hash binary, part int, place long, form string, n long, prefix_chars long, middle_chars long, chunk binary"
)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(data: bytes) -> np.ndarray:
    """The byte offsets where the units of a text end, in order."""
    space = _IS_SPACE[np.frombuffer(data, np.uint8)]
    if not len(space):
        return np.zeros(0, np.int64)
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(space))


def _characters(data: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def cut(doc_id: int | None, data: bytes, seed: int = SEED) -> tuple[str, np.ndarray, int, int]:
    """Form, unit ends, and the numbers of units before the middle and before the suffix."""
    ends = unit_ends(data)
    h1, h2, h3, h4 = np.frombuffer(
        hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16], ">u4"
    ).tolist()
    if not data or h3 % 100 >= CUT_PERCENT or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", ends, 0, 0
    first, second = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    return ("spm" if h4 % 100 < SPM_PERCENT else "psm"), ends, first, second


def _chunks(data: bytes, ends: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """The units from ``first`` to before ``last`` in pieces; a unit of many bytes is parted."""
    for unit in range(first, last, UNITS):
        start, stop = int(ends[unit - 1]) if unit else 0, int(ends[min(unit + UNITS, last) - 1])
        for at in range(start, stop, BYTES):
            yield data[at : min(at + BYTES, stop)]


def _cut_batches(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, rows, held = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                form, ends, first, second = cut(doc_id, data, seed)
                prefix = _chunks(data, ends, 0, first)
                middle = _chunks(data, ends, first, second)
                suffix = _chunks(data, ends, second, len(ends))
                about = (form, len(ends), None, None)
                if form == "plain":
                    chunks = [*suffix] or [b""]
                else:
                    a, b = (int(ends[n - 1]) if n else 0 for n in (first, second))
                    about = (form, len(ends), _characters(data[:a]), _characters(data[a:b]))
                    if form == "psm":
                        chunks = [PREFIX, *prefix, SUFFIX, *suffix, MIDDLE, *middle]
                    else:
                        chunks = [SUFFIX, *suffix, PREFIX, *prefix, MIDDLE, *middle]
                key = (doc_id, xxhash.xxh3_128_digest(data), part)
                rows.append((*key, 0, *about, chunks[0]))
                rows.extend((*key, place, None, None, None, None, chunks[place]) for place in range(1, len(chunks)))
                held += len(data)
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield _batch(rows, _PIECE)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, _PIECE)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pieces(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The pieces of all outputs; ``form``, ``n`` and the sizes stand on a document's first piece.

    Columns: those of ``KEY``, ``place`` (in the output, from 0), form, n (units), prefix_chars,
    middle_chars (code points; null if plain) and ``chunk`` (UTF-8).
    """
    texts = id_and_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_cut_batches(seed), PIECES)


def in_output_order(cut_pieces: DataFrame) -> DataFrame:
    """The pieces dealt by document, each output's in order within its partition."""
    return cut_pieces.repartition(*KEY).sortWithinPartitions(*KEY, "place")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


# Section ranks in the original text; a position is the rank, then the place in the output.
_SECTIONS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_RANK_BITS = 48
_BACK = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.binary()),
        ("part", pa.int32()),
        ("back", pa.int64()),
        ("form", pa.string()),
        ("n", pa.int64()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("copies", pa.int64()),
        ("output_sha256", pa.string()),
        ("chunk", pa.binary()),
    ]
)
BACK = (
    "doc_id long, text_hash binary, part int, back long, form string, n long, prefix_chars long, middle_chars long, "
    "copies long, output_sha256 string, chunk binary"
)


def _to_original(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in output order: digest of each output, and its pieces with their original positions.

    A document's last row has the position -1 and carries what is known of the whole. Copies of a
    row from one input partition have one key: their pieces come side by side and count once.
    """
    out, held = [], 0
    key = digest = section = about = place = None
    copies = 0

    def summary() -> tuple:
        return (*key, -1, *about, copies, digest.hexdigest(), None)

    for *this, at, form, n, prefix_chars, middle_chars, chunk in _rows(batches):
        this = tuple(this)
        if this != key:
            if key is not None:
                out.append(summary())
            key, digest, place, copies = this, hashlib.sha256(), -1, 0
            about, section = (form, n, prefix_chars, middle_chars), 0
        if at == 0:
            copies += 1
        if at == place:
            continue
        place = at
        digest.update(chunk)
        if about[0] != "plain" and chunk in _SECTIONS:
            section = _SECTIONS[chunk]
            continue
        out.append((*key, (section << _RANK_BITS) + at, None, None, None, None, None, None, chunk))
        held += len(chunk)
        if held >= BATCH_BYTES or len(out) >= BATCH_ROWS:
            yield _batch(out, _BACK)
            out, held = [], 0
    if key is not None:
        out.append(summary())
        yield _batch(out, _BACK)


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output_sha256", pa.string()),
        ("restored_sha256", pa.string()),
    ]
)
DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, about, copies, digest = [], None, 0, None

    def close() -> list[tuple]:
        doc_id, form, n, prefix_chars, middle_chars, output = about
        return [(doc_id, n, form, prefix_chars, middle_chars, output, digest.hexdigest())] * copies

    for doc_id, _, _, back, form, n, prefix_chars, middle_chars, times, output, chunk in _rows(batches):
        if back == -1:
            if about is not None:
                out += close()
            about, copies, digest = (doc_id, form, n, prefix_chars, middle_chars, output), times, hashlib.sha256()
            if len(out) >= BATCH_ROWS:
                yield _batch(out, _DIGEST)
                out = []
        else:
            digest.update(chunk)
    if about is not None:
        yield _batch([*out, *close()], _DIGEST)


def in_original_order(ordered: DataFrame) -> DataFrame:
    """The pieces of ``in_output_order`` sorted back; a document's first row has its totals.

    Pieces of a document share a partition, so this is a sort within partitions and no shuffle.
    """
    return ordered.mapInArrow(_to_original, BACK).sortWithinPartitions(*KEY, "back")


def digests(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: form, sizes, and digests of the output and of the text rebuilt from it."""
    return in_original_order(in_output_order(pieces(docs, seed))).mapInArrow(_digests, DIGESTS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())])
    key, form, parts, place, copies = None, None, [], -1, 0

    def close() -> pa.RecordBatch:
        return _batch([(key[0], form, b"".join(parts).decode("utf-8", "replace"))] * copies, schema)

    for *this, at, kind, _, _, _, chunk in _rows(batches):
        if tuple(this) != key:
            if key is not None:
                yield close()
            key, form, parts, place, copies = tuple(this), kind, [], -1, 0
        copies += at == 0
        if at != place:
            place = at
            parts.append(chunk)
    if key is not None:
        yield close()


def outputs(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The whole outputs: doc_id, form, output. Each is put together from its sorted pieces."""
    return in_output_order(pieces(docs, seed)).mapInArrow(_joined, "doc_id long, form string, output string")


def restore(output: str, form: str) -> str:
    """The original text of one output."""
    if form == "plain":
        return output
    first, second, third = (m.decode() for m in ((PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)))
    one, rest = output.removeprefix(first).split(second, 1)
    two, middle = rest.split(third, 1)
    return one + middle + two if form == "psm" else two + middle + one
