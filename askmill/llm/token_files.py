"""Token ids as flat unsigned integer files with 64-bit document offsets.

Each partition of the range-sorted documents becomes one part of three little-endian files:

* ``NAME.bin``: the ids of its documents one after another, 16 bits each where the vocabulary
  fits and 32 otherwise;
* ``NAME.off``: unsigned 64-bit offsets in ids, one more than documents, the first 0;
* ``NAME.doc``: signed 64-bit doc_ids; a null doc_id is the smallest value.

Names carry a random part, and only the parts in the manifest count: a task that is lost or run
twice leaves at most an unused file. A part's base, the ids in all parts before it, comes from
prefix sums over the manifest, which has one row per partition. Reading maps the files into memory
where the folder is mounted, and reads ranges elsewhere.

Documents are in ascending doc_id order, null first; equal ids follow a hash of the text, then the
text. Null text is empty and holds the end id alone. An empty table gives an empty manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askmill.llm.common import by_characters, id_and_text, saved
from askmill.llm.word_encoder import PieceEncoder

NO_ID = np.iinfo(np.int64).min
#: Texts are encoded, and read back, in groups of about this size.
CHARACTERS, IDS = 1 << 21, 1 << 20

MANIFEST = "part int, folder string, name string, width int, docs long, ids long"
_ENCODERS: dict = {}


def _encoder(path: str, end_id: int) -> PieceEncoder:
    """One for each Python worker and tokenizer, so that known words outlive a task."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = PieceEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"file:{folder}")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode and write all documents below ``folder``; the manifest, with each part's ``base``.

    ``folder`` is a path or URI that all executors share, ``tokenizer`` a tokenizer file that all
    of them can read.
    """

    def write_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder = _encoder(tokenizer, end_id)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        name = f"part-{part:06d}-{name}"
        held, ids = 0, 0
        store = None
        for frame in frames:
            if store is None:
                system, place = _file_system(folder)
                system.create_dir(place)
                store = [system.open_output_stream(f"{place}/{name}.{x}") for x in ("bin", "off", "doc")]
                store[1].write(np.zeros(1, "<u8").tobytes())
            texts = frame["text"].tolist()
            for start, stop in by_characters(texts, CHARACTERS):
                found = encoder.encode(texts[start:stop])
                ends = ids + np.cumsum([len(x) // encoder.dtype.itemsize for x in found])
                ids = int(ends[-1])
                store[0].write(b"".join(found))
                store[1].write(ends.astype("<u8").tobytes())
            known = frame["doc_id"].fillna(NO_ID).to_numpy()
            store[2].write(known.astype("<i8").tobytes())
            held += len(frame)
        if store is not None:
            for file in store:
                file.close()
            yield pd.DataFrame([(part, folder, name, encoder.dtype.itemsize, held, ids)], columns=MANIFEST.replace(",", "").split()[::2])

    ordered = (
        id_and_text(docs)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        # Exact ids even where some are null: pandas would turn those into floating point.
        .select(F.coalesce("doc_id", F.lit(int(NO_ID))).alias("doc_id"), "text")
    )
    manifest = saved(ordered.mapInPandas(write_part, MANIFEST), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


class Part:
    """One part's files, mapped where they are local and read by ranges elsewhere."""

    def __init__(self, folder: str, name: str, width: int):
        from pyarrow import fs

        self.system, place = _file_system(folder)
        self.stem, self.local = f"{place}/{name}", isinstance(self.system, fs.LocalFileSystem)
        self.width = np.dtype(f"<u{width}")

    def slice(self, kind: str, dtype, start: int, stop: int) -> np.ndarray:
        dtype = np.dtype(dtype)
        if stop <= start:
            return np.zeros(0, dtype)
        if self.local:
            return np.memmap(f"{self.stem}.{kind}", dtype, "r")[start:stop]
        with self.system.open_input_file(f"{self.stem}.{kind}") as file:
            data = file.read_at((stop - start) * dtype.itemsize, start * dtype.itemsize)
        return np.frombuffer(data, dtype)

    def ids(self, start: int, stop: int) -> np.ndarray:
        return self.slice("bin", self.width, start, stop)


def read(manifest: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, and its ids as little-endian unsigned 32 bits."""

    def read_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                part = Part(row.folder, row.name, row.width)
                offsets = part.slice("off", "<u8", 0, row.docs + 1).astype(np.int64)
                known = part.slice("doc", "<i8", 0, row.docs)
                first = 0
                while first < row.docs:
                    last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + IDS, "right")) - 1)
                    last = min(last, row.docs)
                    ids = part.ids(int(offsets[first]), int(offsets[last])).astype("<u4")
                    cuts = offsets[first : last + 1] - offsets[first]
                    yield pd.DataFrame(
                        {
                            "doc_id": known[first:last],
                            "start": row.base + offsets[first:last],
                            "n_tokens": np.diff(cuts),
                            "tokens": [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                        }
                    )
                    first = last

    parts = manifest.select("part", "folder", "name", "width", "docs", "base").repartitionByRange("part")
    found = parts.mapInPandas(read_parts, "doc_id long, start long, n_tokens long, tokens binary")
    return found.withColumn("doc_id", F.when(F.col("doc_id") != int(NO_ID), F.col("doc_id")))
