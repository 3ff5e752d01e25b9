"""Operator 8: packing token sequences into windows by non-negative least squares.

Documents are tokenised once and cut into full windows and a rest. The histogram of piece lengths (at
most ``window`` numbers) goes to the driver; combinations of up to four length bins that fill a window
are enumerated, their repeat counts solved against the histogram by active-set non-negative least
squares and rounded, and what is left is packed greedily, the longest first into the tightest gap. Only
lengths are planned there. Each piece then finds its place from its rank among pieces of its length: the
ranks come from salted groups of bounded size, so a length that many copies share is no hot group.

A null text counts as empty: its document has the end token alone. Repeated rows are packed each. An
empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.bpe import Memo, Pairs, merged_words
from foldwise.llm.common import kept, slices, texts

#: Fixed values of the vocabulary's pre-tokeniser, and of byte-level vocabularies in general.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Characters whose lower case and composition are alike in every Unicode version; others go to the library.
PLAIN = regex.compile(r"[\t-\r\x20-\x7e\xa1-įı-ɏ]*")
CHUNK = regex.compile(r"[^\t-\r ]+")


class WordCodec:
    """Ids of whole texts by a vocabulary with word ends; ``tokenizers`` does chunks beyond plain Latin."""

    def __init__(self, spec: bytes):
        self.library = tokenizers.Tokenizer.from_str(spec.decode())
        model = json.loads(spec)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        others = [b for b in range(256) if b not in set(PRINTABLE)]
        char = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.inner, self.last = (np.array([vocab[char[b] + e] for b in range(256)], dtype=np.int32) for e in ("", end))
        entries: dict = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            entries.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.pairs = Pairs(entries)
        self.memo, self.odd = Memo(self.words), Memo(self.chunks, 50_000)

    def words(self, some: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        flat = np.frombuffer("".join(some).encode(), dtype=np.uint8)
        lengths = np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in some), np.int64, len(some))
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        return merged_words(symbols, lengths, self.pairs, self.finish)

    @staticmethod
    def finish(rows: np.ndarray) -> list[bytes]:
        step, raw = 4 * rows.shape[1], rows.astype("<u4").tobytes()
        return [raw[k : k + step] for k in range(0, len(raw), step)]

    def chunks(self, some: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch(some, add_special_tokens=False)]

    def encode(self, some: list[str]) -> list[bytes]:
        """Texts in plain Latin go by words; of others, the chunks beyond it go to the library."""
        cut, odd = [], []
        for text in some:
            if "<|" in text or not unicodedata.is_normalized("NFC", text):
                cut.append([(text, False)])
            elif PLAIN.fullmatch(text):
                cut.append(None)
            else:
                cut.append([(c, bool(PLAIN.fullmatch(c))) for c in CHUNK.findall(text)])
        parts = [WORDS.findall(t.lower()) if c is None else None for t, c in zip(some, cut, strict=True)]
        for c in cut:
            odd += [x for x, plain in c or () if not plain]
        mixed = [[(WORDS.findall(x.lower()) if plain else x) for x, plain in c] if c else () for c in cut]
        self.odd.learn(odd)
        self.memo.learn(chain.from_iterable([p for p in parts if p] + [x for m in mixed for x in m if isinstance(x, list)]))
        get = self.memo.__getitem__
        return [b"".join(map(get, p)) if p is not None else b"".join(b"".join(map(get, x)) if isinstance(x, list) else self.odd[x] for x in m) for p, m in zip(parts, mixed, strict=True)]


@lru_cache(maxsize=2)
def word_codec(spec: bytes) -> WordCodec:
    return WordCodec(spec)


def tokenise(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, if asked for, ``ids``."""
    with open(tokenizer_path, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = [docs.schema[id_col], *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        own = word_codec(spec.value)
        for batch in slices(batches, text_col):
            row, start, ids, total = [], [], [], []
            for k, body in enumerate(own.encode(texts(batch, text_col))):
                body += end
                for at in range(0, len(body), 4 * window):
                    row.append(k)
                    start.append(at // 4)
                    ids.append(body[at : at + 4 * window])
                    total.append(len(body) // 4)
            columns = [batch.column(id_col).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(total, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=[f.name for f in fields])
        own.memo.forget()
        own.odd.forget()

    return docs.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def combinations(bins: int, depth: int) -> np.ndarray:
    """All sorted tuples of at most ``depth`` bins that sum to ``bins``; unused places hold 0."""
    done, part = [], np.arange(1, bins + 1)[:, None]
    left = bins - part[:, 0]
    for d in range(1, depth + 1):
        full = part[left == 0]
        done.append(np.pad(full, ((0, 0), (0, depth - d))))
        keep = left >= part[:, -1]
        part, left = part[keep], left[keep]
        if d == depth:
            break
        if d == depth - 1:  # the last bin is given by what is left
            part = np.hstack([part, left[:, None]])
            left = np.zeros_like(left)
            continue
        reps = np.minimum(left, bins) - part[:, -1] + 1
        first = np.repeat(np.cumsum(reps) - reps, reps)
        grown = np.repeat(part[:, -1], reps) + np.arange(reps.sum()) - first
        part, left = np.hstack([np.repeat(part, reps, 0), grown[:, None]]), np.repeat(left, reps) - grown
    return np.vstack(done)


def nnls(combos: np.ndarray, target: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Active-set non-negative least squares: chosen combinations and their repeat counts."""
    bins = len(target) - 1
    chosen, x = [], np.zeros(0)
    columns = np.zeros((bins + 1, 0))
    for _ in range(rounds):
        rest = target - columns @ x
        rest[0] = 0
        slope = rest[combos].sum(1)
        slope[chosen] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= 1e-9 * max(1.0, target.max()):
            break
        column = np.bincount(combos[best], minlength=bins + 1).astype(float)
        column[0] = 0
        chosen.append(best)
        columns, x = np.column_stack([columns, column]), np.append(x, 0.0)
        while True:
            z = np.linalg.lstsq(columns.T @ columns, columns.T @ target, rcond=None)[0]
            if (z > 1e-9).all():
                x = z
                break
            low = z <= 1e-9
            step = np.min(x[low] / np.maximum(x[low] - z[low], 1e-300))
            x = x + step * (z - x)
            stay = x > 1e-9
            if stay.all():
                stay[np.argmin(np.where(low, x, np.inf))] = False
            columns, x, chosen = columns[:, stay], x[stay], [c for c, s in zip(chosen, stay, strict=True) if s]
            if not chosen:
                break
    return np.array(chosen, dtype=int), x


def plan(counts: dict[int, int], window: int, bins: int = 256, depth: int = 4) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of piece lengths with repeat counts that use each piece exactly once."""
    grain = -(-window // bins)
    bins = window // grain
    left = {k: v for k, v in counts.items() if v > 0}
    out = []
    if left.get(window):
        out.append(((window,), left.pop(window)))
    queues: list[list[list[int]]] = [[] for _ in range(bins + 1)]  # of each bin: [length, count], the longest last
    for length in sorted(left):
        if -(-length // grain) <= bins:
            queues[-(-length // grain)].append([length, left[length]])
    target = np.array([float(sum(c for _, c in q)) for q in queues])
    combos = combinations(bins, depth)
    chosen, x = nnls(combos, target, 3 * bins)
    there = target.astype(int)
    for k in np.argsort(-x, kind="stable"):
        need = np.bincount(combos[chosen[k]], minlength=bins + 1)
        need[0] = 0
        used = np.flatnonzero(need)
        repeat = min(int(round(x[k])), *(int(there[b] // need[b]) for b in used))
        if repeat <= 0:
            continue
        there -= repeat * need
        places = [b for b in used for _ in range(need[b])]
        for part in runs(queues, places, repeat):
            out.append(part)
            for length in part[0]:
                left[length] -= part[1]
    return out + greedy({k: v for k, v in left.items() if v}, window)


def runs(queues, places, repeat):
    """Take ``repeat`` pieces of each place's bin, in stretches over which all lengths stay the same."""
    taken = []
    for b in places:
        need, own = repeat, []
        while need:
            length, there = queues[b][-1]
            m = min(need, there)
            own.append([length, m])
            need -= m
            if m == there:
                queues[b].pop()
            else:
                queues[b][-1][1] -= m
        taken.append(own[::-1])
    while repeat:
        m = min(own[-1][1] for own in taken)
        yield tuple(own[-1][0] for own in taken), m
        repeat -= m
        for own in taken:
            own[-1][1] -= m
            if not own[-1][1]:
                own.pop()


def greedy(left: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the tightest gap that holds it; equal packs are handled together."""
    gaps: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern, count, gap):
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((pattern, count))

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                pattern, there = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(at)
                m = min(count, there)
                if there > m:
                    put(pattern, there - m, gap)
                put((*pattern, length), m, gap - length)
                count -= m
            else:
                each = min(count, window // length)
                m = count // each
                put((length,) * each, m, window - each * length)
                count -= m * each
    return [p for some in open_.values() for p in some]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Stretches of ranks within a length, and the sequence and offset of the first piece of each."""
    key, sequence, offset = [], [], []
    seen: dict[int, int] = {}
    base = 0
    for pattern, repeat in patterns:
        at = 0
        for length in pattern:
            rank = seen.get(length, 0)
            key.append(length << 40 | rank)
            sequence.append(base)
            offset.append(at)
            seen[length] = rank + repeat
            at += length
        base += repeat
    order = np.argsort(np.array(key, dtype=np.int64), kind="stable")
    return {k: np.array(v, dtype=np.int64)[order] for k, v in (("key", key), ("sequence", sequence), ("offset", offset))}


def pack(pieces: DataFrame, window: int = 4096, group_rows: int = 200_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table with ``length`` from 1 to ``window``. The table is
    written once, with a salt for each row, so that every later job sees the same rows and salts."""
    spark = pieces.sparkSession
    table = kept(pieces.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    counts = table.groupBy("length").count()
    sizes = {r["length"]: r["count"] for r in counts.collect()}  # at most `window` numbers
    if any(k < 1 or k > window for k in sizes):
        raise ValueError("a piece is longer than the window")
    where = spark.sparkContext.broadcast(places(plan(sizes, window)))
    # one group for each `group_rows` pieces of a length: at most `window` rows, so it is broadcast
    salts = spark.createDataFrame([(k, -(-v // group_rows)) for k, v in sizes.items()], "length long, salts long")
    salted = table.join(F.broadcast(salts), "length").withColumn("salt", F.expr("pmod(salt, salts)")).drop("salts")
    ahead = W.partitionBy("length").orderBy("salt")
    base = salted.groupBy("length", "salt").count().withColumn("base", F.sum("count").over(ahead) - F.col("count")).drop("count")
    rows = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    ranked = salted.withColumn("rank", F.row_number().over(W.partitionBy("length", "salt").orderBy(*[c for c in rows if c != "ids"])).cast("long"))
    ranked = ranked.join(base, ["length", "salt"]).select(*rows, (F.col("rank") - 1 + F.col("base")).alias("rank"))
    schema = T.StructType([pieces.schema[c] for c in rows] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        own = where.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(own["key"], length << 40 | rank, side="right") - 1
            first = own["key"][at] & ((1 << 40) - 1)
            out = [pa.array(own["sequence"][at] + rank - first), pa.array(own["offset"][at])]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rows] + out, names=[*rows, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)
