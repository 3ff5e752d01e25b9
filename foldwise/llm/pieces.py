"""Operator 2: encoding and decoding with a merge-type SentencePiece vocabulary.

Each text is normalised as the model does (spaces become U+2581, one in front), cut where no vocabulary
entry can span the cut (between a word and the spaces of the next one, and around line feeds), and each
distinct part of some texts is merged by a score-ordered agenda of adjacent symbol pairs. Characters
outside the vocabulary become byte tokens. Every text is checked against the sentencepiece library, both its ids and what they
decode to; a difference ends the job.

Nulls count as empty texts; an empty text has the begin and end ids alone. Repeated rows and any other
columns pass through unchanged, but for columns named ``ids`` or ``decoded``, which are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.bpe import Pairs, merged_rows
from foldwise.llm.common import slices, texts

SPACE = "▁"
SLICE = 4 << 20  # bytes of texts encoded at once


def cut_parts(text: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the parts ``\\n| *[^ \\n]+| +`` of texts begin and the last ends; ``text``: their bytes in a row."""
    space, line = text == 32, text == 10
    starts = line.copy()
    starts[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    starts[begins] = True
    return np.append(np.flatnonzero(starts), len(text))


def values(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all values of a large binary column in a row, and where each begins and the last ends."""
    if not len(column):
        return memoryview(b""), np.zeros(1, np.int64)
    return memoryview(column.buffers()[2] or b""), np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]


class Codec:
    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = lib.get_piece_size()
        plain = [i for i in range(self.size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.id_of = {lib.id_to_piece(i): i for i in plain}
        byte_id = {int(lib.id_to_piece(i)[1:-1], 16): i for i in range(self.size) if lib.is_byte(i)}
        if sorted(byte_id) != [*range(256)] or any(re.search(rf"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p in self.id_of):
            raise ValueError("the vocabulary needs all byte tokens, and no entry with a space after another character or a line feed beside one")
        self.byte_id = np.array([byte_id[b] for b in range(256)], dtype=np.int32)
        scores = sorted({lib.get_score(i) for i in plain}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        entries = {}
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    entries[a, b] = rank[lib.get_score(i)], i
        self.pairs = Pairs(entries)
        self.first = np.arange(0x110000, dtype=np.int32) + self.size  # a character's symbol
        for c, i in self.id_of.items():
            if len(c) == 1:
                self.first[ord(c)] = i
        shown = [b"" if lib.is_control(i) else b" \xe2\x81\x87 " if lib.is_unknown(i) else bytes([int(lib.id_to_piece(i)[1:-1], 16)]) if lib.is_byte(i) else lib.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.size)]
        self.bos, self.eos = (np.array([i], dtype="<u4").tobytes() for i in (lib.bos_id(), lib.eos_id()))
        self.shown = pa.array(shown, pa.large_binary())
        self.control = np.array([lib.is_control(i) for i in range(self.size)])
        self.spaced = np.array([b[:1] == b" " and not (lib.is_byte(i) or lib.is_unknown(i)) for i, b in enumerate(shown)])

    def symbol(self, s: str) -> int | None:
        found = self.id_of.get(s)
        return found if found is not None else self.size + ord(s) if len(s) == 1 else None

    def parts(self, some: pa.Array) -> pa.Array:
        """Ids of each part as little-endian unsigned 32-bit integers."""
        data, at = values(some)
        flat = np.frombuffer(str(data[at[0] : at[-1]], "utf-8").replace(" ", SPACE).encode("utf-32-le"), dtype="<u4")
        lengths = pc.utf8_length(some).to_numpy().astype(np.int64)
        found = [*merged_rows(self.first[flat], lengths, self.pairs)]
        counts = np.zeros(len(some) + 1, np.int64)
        for which, ids in found:
            counts[which + 1] = ids.shape[1]
        begins = np.cumsum(counts)
        out = np.empty(begins[-1], np.int32)
        for which, ids in found:
            out[begins[which][:, None] + np.arange(ids.shape[1])] = ids
        odd = out >= self.size  # characters outside the vocabulary
        if odd.any():
            text = "".join(map(chr, (out[odd] - self.size).tolist()))
            times = np.ones(len(out), np.int64)
            times[odd] = [len(c.encode()) for c in text]
            begins = np.append(0, np.cumsum(times))[begins]
            out, odd = np.repeat(out, times), np.repeat(odd, times)
            out[odd] = self.byte_id[np.frombuffer(text.encode(), dtype=np.uint8)]
        return pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(4 * begins), pa.py_buffer(out.astype("<u4"))])

    def encode(self, some: list[str]) -> list[bytes]:
        """Texts are cut into parts as bytes; each distinct part is merged once."""
        raw = [(" " + t.replace(SPACE, " ")).encode() if t else b"" for t in some]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data, ends = b"".join(raw), np.cumsum(lengths)
        parts = cut_parts(np.frombuffer(data, dtype=np.uint8), (ends - lengths)[lengths > 0])
        coded = pa.Array.from_buffers(pa.large_string(), len(parts) - 1, [None, pa.py_buffer(parts), pa.py_buffer(data)]).dictionary_encode()
        ids, at = values(self.parts(coded.dictionary).take(coded.indices))
        at = at[np.searchsorted(parts, np.append(0, ends))].tolist()
        return [b"".join((self.bos, ids[i:j], self.eos)) for i, j in pairwise(at)]

    def decode(self, ids: bytes) -> str:
        return self.decode_many([ids])[0]

    def decode_many(self, ids: list[bytes]) -> list[str]:
        """What the ids show is looked up for all rows at once, then cut by rows."""
        numbers = np.frombuffer(b"".join(ids), dtype="<i4")
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        starts = np.append(0, ends)[:-1]
        raw, at = values(self.shown.take(pa.array(numbers, pa.int32())))
        solid = np.append(np.flatnonzero(~self.control[numbers]), len(numbers))
        first = solid[np.searchsorted(solid, starts)]  # of each row, the first id that is no control
        begin = at[starts] + ((first < ends) & np.append(self.spaced[numbers], False)[first])
        out = []
        for i, j, row in zip(begin.tolist(), at[ends].tolist(), ids, strict=True):
            try:
                out.append(str(raw[i:j], "utf-8"))
            except UnicodeDecodeError:  # byte tokens that are no UTF-8: as the library repairs them
                out.append(self.library.decode(np.frombuffer(row, dtype="<i4").tolist()))
        return out

    def check(self, some: list[str], ids: list[bytes], decoded: list[str]) -> None:
        right = self.library.encode(some, add_bos=True, add_eos=True, num_threads=1, return_type="numpy")
        again = self.library.decode(right, num_threads=1)
        for text, want, own, back, shown in zip(some, right, ids, again, decoded, strict=True):
            if want.astype("<u4", copy=False).tobytes() != own or back != shown:
                raise ValueError(f"differs from the sentencepiece library: {text[:80]!r}")


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Adds ``ids`` (binary: little-endian unsigned 32-bit ids with begin and end) and ``decoded``."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    rest = [c for c in docs.columns if c not in ("ids", "decoded")]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches):
        own = codec(model.value)
        for batch in slices(batches, text_col, SLICE):
            some = texts(batch, text_col)
            ids = own.encode(some)
            decoded = own.decode_many(ids)
            own.check(some, ids, decoded)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=[*rest, "ids", "decoded"])

    return docs.select(*rest).mapInArrow(run, schema)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    out = encode_decode(docs.select("doc_id", "text"), model_path)
    return out.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
