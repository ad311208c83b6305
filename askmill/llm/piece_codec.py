"""SentencePiece models run by the tokenizers library: encode, decode, and check parity.

The model file is a protobuf message, read here field by field. From it the parts are rebuilt:

* normaliser: the compiled character map if there is one, removal of extra blanks, the dummy
  prefix, and blanks as the metaspace mark;
* model: scored pieces for unigram models, merges ranked by the scores of the pieces they make for
  BPE models, both with byte fallback where the model has it;
* decoder: marks to blanks, byte pieces to UTF-8, the dummy prefix off.

No piece of a usual model has a mark behind another character, so a text falls into chunks, each
a run of marks with what follows, that are encoded on their own. This is looked up in the
vocabulary; a model with such pieces is encoded whole. Chunks recur, so each Python worker keeps
the ids of those it has met for its next tasks of the query, until it is given another query's task; the new
ones of a batch are encoded by the library's threads, ``TOGETHER`` at a time.

Parity: every new chunk is also encoded by the sentencepiece library, and every whole text's ids are
decoded by it and compared with the decoding here, which joins the pieces' bytes and leaves ids
that make no valid text to the rebuilt decoder. ``parity`` is true where all agree.

Null text is empty and has no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from askmill.llm.common import by_characters, id_and_text, marked_ids, unmarked_ids

MARK = "▁"
CHARACTERS, CHUNKS = 1 << 20, 500_000
#: Chunks the two libraries encode at once: what they make of them takes far more memory than the ids.
TOGETHER = 2048

# Types of pieces and of models, and field numbers, in the published message format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message: ints, raw 4 or 8 bytes, or byte strings."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"field kind {kind} is not known")
        yield tag >> 3, value


class Model:
    """What a model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        normalizer: dict = {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.as_suffix = bool(trainer.get(24, 0))
        self.character_map = normalizer.get(2, b"")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.strips = bool(normalizer.get(4, 1))
        self.marks = bool(normalizer.get(5, 1))
        self.unknown = next(n for n, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """All ways to make a piece of two others, the best-scored piece first."""
        usable = {p: n for n, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, rank in usable.items():
            parts = [(piece[:n], piece[n:]) for n in range(1, len(piece))]
            parts = [(a, b) for a, b in parts if a in usable and b in usable]
            parts.sort(key=lambda p: (usable[p[0]], usable[p[1]]))
            found += [(-self.pieces[rank][1], rank, p) for p in parts]
        return [p for _, _, p in sorted(found, key=lambda x: x[:2])]

    def tokenizer(self) -> Tokenizer:
        """The tokenizer of one chunk or text in which the normaliser's work is done, and its decoder."""
        unknown = self.pieces[self.unknown][0]
        if self.kind == BPE:
            vocabulary = {p: n for n, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocabulary, self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)
        elif self.kind == UNIGRAM:
            scored = [(p, s) for p, s, _ in self.pieces]
            model = models.Unigram(scored, unk_id=self.unknown, byte_fallback=self.byte_fallback)
        else:
            raise ValueError("only unigram and BPE models can be rebuilt")
        tokenizer = Tokenizer(model)
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            steps.append(decoders.Strip(" ", 1, 0))
        tokenizer.decoder = decoders.Sequence(steps)
        return tokenizer

    def normalizer(self):
        steps = []
        if self.character_map:
            steps.append(normalizers.Precompiled(self.character_map))
        if self.strips:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.marks:
            steps.append(normalizers.Replace(" ", MARK))
        return normalizers.Sequence(steps)

    def splits(self) -> bool:
        """Whether no piece has a mark behind another character."""
        return self.marks and not self.as_suffix and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in self.pieces)


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            data = file.read()
        self.model = Model(data)
        self.tokenizer = self.model.tokenizer()
        self.plain = not (self.model.character_map or self.model.strips) and self.model.marks
        self.rewriter = self.model.normalizer()
        self.chunk = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if self.model.splits() else None
        #: Single blanks between words: cutting there is the same, and quicker.
        self.quick = self.plain and self.chunk is not None and self.model.dummy_prefix
        self.peer = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.known: dict[str, bytes] = {}
        #: Of the known chunks, those that the peer encodes otherwise.
        self.unlike: set[str] = set()
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.spelled = [
            bytes.fromhex(found[1]) if (found := byte.fullmatch(p)) else p.replace(MARK, " ").encode()
            for p, _, _ in self.model.pieces
        ]

    def prepared(self, text: str) -> str:
        text = text.replace(" ", MARK) if self.plain else self.rewriter.normalize_str(text)
        return MARK + text if text and self.model.dummy_prefix else text

    def _met(self, chunks: list[str]) -> None:
        """Encode chunks together, and the same by the peer, whose own dummy prefix is the first mark."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        # A chunk's first mark is the peer's own dummy prefix; a lone mark is the prefix of nothing,
        # and a chunk without one cannot stand alone there.
        asked = {
            n: c[1:].replace(MARK, " ") for n, c in enumerate(chunks) if self.model.dummy_prefix and c[0] == MARK and c != MARK
        }
        peers = dict(zip(asked, self.peer.encode(list(asked.values()), num_threads=1), strict=True))
        for n, (chunk, own) in enumerate(zip(chunks, ids, strict=True)):
            self.known[chunk] = np.array(own, "<u4").tobytes()
            if peers.get(n, own) != own:
                self.unlike.add(chunk)

    def _chunks(self, text: str) -> list[str]:
        if self.quick and text and MARK not in text and "  " not in text and text[0] != " " != text[-1]:
            return (MARK + text.replace(" ", " " + MARK)).split(" ")
        text = self.prepared(text)
        return self.chunk.findall(text) if self.chunk else [text] if text else []

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        cut = [self._chunks(t) for t in texts]
        if len(self.known) > CHUNKS:
            self.known.clear()
            self.unlike.clear()
        new = list(set().union(*cut).difference(self.known))
        for start in range(0, len(new), TOGETHER):
            self._met(new[start : start + TOGETHER])
        known = self.known
        return [b"".join([known[c] for c in chunks]) for chunks in cut], [self.unlike.isdisjoint(chunks) for chunks in cut]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Pieces joined as bytes; ids that make no valid text go through the library's decoder."""
        return [self._decoded(x) for x in ids]

    def _decoded(self, ids: list[int]) -> str:
        try:
            text = b"".join(map(self.spelled.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def codec(path: str) -> Codec:
    return Codec(path)


class SharedCodec:
    """A model's path, to be broadcast; the codec is made where it is first asked for.

    A Python worker holds a broadcast's value over the tasks that use it and lets it go with the first task that does
    not. So known chunks outlive a task, but take no memory from the worker's later stages.
    """

    def __init__(self, path: str):
        self.path, self.made = path, None

    def __getstate__(self) -> dict:
        return {"path": self.path, "made": None}

    def codec(self) -> Codec:
        if self.made is None:
            self.made = codec(self.path)
        return self.made


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, tokens (little-endian unsigned 32-bit ids), decoded text and parity.

    ``model`` is a path that all executors can read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(SharedCodec(model))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value.codec()
        for frame in frames:
            texts = frame["text"].tolist()
            for start, stop in by_characters(texts, CHARACTERS):
                tokens, same = own.encode(texts[start:stop])
                ids = [np.frombuffer(t, "<u4").tolist() for t in tokens]
                decoded = own.decode(ids)
                peers = own.peer.decode(ids, num_threads=1)
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[start:stop].to_numpy(),
                        "n_tokens": [len(x) for x in ids],
                        "tokens": tokens,
                        "decoded": decoded,
                        "parity": [s and d == p for s, d, p in zip(same, decoded, peers, strict=True)],
                    }
                )

    schema = "doc_id long, n_tokens long, tokens binary, decoded string, parity boolean"
    return unmarked_ids(marked_ids(id_and_text(docs)).mapInPandas(run, schema))
