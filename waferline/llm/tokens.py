"""Token files in patched frame-of-reference blocks (operator 4).

``write_tokens`` tokenises documents in ascending doc_id order and writes them as a Parquet
table of *segments*; ``read_tokens`` decodes them again; ``digest`` derives the contract's
columns from what was read.

A segment is one row holding whole documents: their ids and token counts, and the token ids
as patched frame-of-reference blocks of ``BLOCK`` ids:

* ``base``  - the block's minimum, subtracted from every id;
* ``width`` - bits per id: the width that the 90th percentile of the differences needs;
* ``packed`` - the low ``width`` bits of each difference, most significant bit first, every
  block beginning on a byte; ``starts`` indexes where each block begins in it, so that one
  block can be read alone (``read_block``);
* ``exception_at`` / ``exception_high`` - places in the segment and high bits of the ids
  that are wider than that.

Order: one range partitioning on doc_id (the texts' only shuffle); each task sorts and
tokenises its range. Ties in doc_id are ordered by text. A document's global start is its
range's start (a running sum over one row per range) plus its place in the range.

Pieces of text are tokenised once per worker and reset of its memory: byte-level tokenizers
without a normaliser always cut before a space that follows a printing character, between a
letter and a full stop or comma, and around a single line feed, so a text's ids are the
concatenation of its pieces' ids. Other tokenizers encode whole texts.

Defined cases: null and empty texts hold only the end id; a null doc_id sorts first;
repeated rows are written as often as they come; extra columns are ignored; an empty table
gives empty files.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from waferline.llm.common import ranges, starts_of, stored

BLOCK = 256
SEGMENT_TOKENS = 1 << 16
PERCENTILE = 90
END_ID = 2
#: Text bytes that one task sorts and tokenises.
RANGE_BYTES = 24 << 20
#: Texts that cannot simply be cut before every space, full stop and comma and around every
#: line feed: with white space before a space or line feed, or with anything but a plain
#: letter or digit before a full stop or comma.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSAFE = (_WHITE + r"[ \n]|\n" + _WHITE + r"|[^A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}][.,]|^[.,]|\x00")
#: Pieces whose ids a worker remembers.
REMEMBERED = 1 << 20

SEGMENT_SCHEMA = ("part int, seq int, first_doc long, n_tokens long, doc_ids array<long>, doc_tokens array<int>, "
                  "base array<int>, width array<int>, starts array<int>, packed binary, "
                  "exception_at array<int>, exception_high array<int>")


# ------------------------------------------------------------------ blocks

def pack(ids: np.ndarray) -> dict:
    """Patched frame-of-reference blocks of the ids (unsigned, below 2**31)."""
    n = len(ids)
    m = -(-n // BLOCK)
    grid = np.empty(m * BLOCK, np.uint32)
    grid[:n] = ids
    if n:
        grid[n:] = ids[-1]
    grid = grid.reshape(m, BLOCK)
    base = grid.min(axis=1) if m else np.zeros(0, np.uint32)
    diff = grid - base[:, None]
    need = np.frexp(diff.astype(np.float64))[1].astype(np.uint8)  # bits of each difference
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    width = (np.partition(need, rank, axis=1)[:, rank] if m else np.zeros(0)).astype(np.int64)
    at = np.flatnonzero((need > width[:, None]).ravel())
    size = width * BLOCK // 8
    starts = starts_of(size)
    packed = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width):
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        wide = 16 if w <= 16 else 32
        bits = np.unpackbits(diff[rows].astype(f">u{wide // 8}").reshape(-1, 1).view(np.uint8), axis=1)[:, wide - w:]
        packed[ranges(starts[rows], size[rows])] = np.packbits(bits.ravel())
    return {"base": base.astype(np.int32), "width": width.astype(np.int32), "starts": starts[:-1].astype(np.int32),
            "packed": packed.tobytes(), "exception_at": at.astype(np.int32),
            "exception_high": (diff.ravel()[at].astype(np.int64) >> width[at // BLOCK]).astype(np.int32)}


def unpack(seg: dict, n: int) -> np.ndarray:
    """The ``n`` ids of a segment."""
    base, width, starts = (np.asarray(seg[k], np.int64) for k in ("base", "width", "starts"))
    packed = np.frombuffer(seg["packed"], np.uint8)
    out = np.zeros((len(base), BLOCK), np.int64)
    for w in np.unique(width).tolist():
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        n_bytes = w * BLOCK // 8
        raw = packed[starts[rows][:, None] + np.arange(n_bytes)]
        # Each id lies in at most (w + 14) // 8 bytes from its first bit's on.
        bit = np.arange(BLOCK) * w
        some = (w + 14) // 8
        got = np.zeros((len(rows), BLOCK), np.int64)
        for k in range(some):
            got = (got << 8) | raw[:, np.minimum((bit >> 3) + k, n_bytes - 1)]
        out[rows] = (got >> (8 * some - w - (bit & 7))) & ((1 << w) - 1)
    at = np.asarray(seg["exception_at"], np.int64)
    flat = out.ravel()
    flat[at] |= np.asarray(seg["exception_high"], np.int64) << width[at // BLOCK]
    return (flat.reshape(-1, BLOCK) + base[:, None]).ravel()[:n].astype(np.uint32)


def read_block(seg: dict, k: int) -> np.ndarray:
    """Block ``k`` of a segment alone, by the block index (the last may be padded)."""
    at = np.asarray(seg["exception_at"], np.int64)
    mine = at // BLOCK == k
    start, w = seg["starts"][k], seg["width"][k]
    return unpack({"base": seg["base"][k:k + 1], "width": seg["width"][k:k + 1], "starts": [0],
                   "packed": seg["packed"][start:start + w * BLOCK // 8], "exception_at": at[mine] - k * BLOCK,
                   "exception_high": np.asarray(seg["exception_high"])[mine]}, BLOCK)


# ------------------------------------------------------------------ tokenising

class Encoder:
    """Token ids of texts; remembers the ids of pieces it has met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                         and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                                     for t in spec.get("added_tokens", [])))
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # byte-level tokens spell one character per byte
            self.token_bytes[i] = len(token)
        for t in spec.get("added_tokens", []):
            self.token_bytes[t["id"]] = len(t["content"].encode())
        self.forget()

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces. Pieces that begin with a space and end in a printing character
        are joined as they are, pieces without white space by line feeds: the tokenizer cuts
        there as it does when a piece is alone, and the tokens' byte lengths tell where one
        ends."""
        spaced = [p for p in pieces if p[:1] == " " and not p[-1:].isspace()]
        bare = [p for p in pieces if p and not re.search(r"\s", p)]
        known = {*spaced, *bare}
        alone = [p for p in pieces if p not in known]
        ids, sizes = [self.ids], [np.diff(self.starts)]
        for some, between in [(spaced[at:at + 512], "") for at in range(0, len(spaced), 512)] + [
                (bare[at:at + 512], "\n") for at in range(0, len(bare), 512)]:
            got = np.array(self.encode_whole([between.join(some)])[0], np.uint32)
            ends = np.cumsum([len(p.encode()) + len(between) for p in some]) - len(between)
            reached = np.cumsum(self.token_bytes[got])
            last = np.searchsorted(reached, ends)
            first = np.r_[0, last[:-1] + 1 + len(between)]
            if not np.array_equal(reached[np.minimum(last, len(reached) - 1)], ends):
                raise ValueError("pieces were not cut apart; set by_piece to False for this tokenizer")
            ids.append(got[ranges(first, last + 1 - first)])
            sizes.append(last + 1 - first)
        for at in range(0, len(alone), 512):
            each = self.encode_whole(alone[at:at + 512])
            ids.append(np.array([i for e in each for i in e], np.uint32))
            sizes.append(np.array([len(e) for e in each], np.int64))
        for p in chain(spaced, bare, alone):
            self.place[p] = len(self.place)
        self.ids = np.concatenate(ids)
        self.starts = starts_of(np.concatenate(sizes))

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """The numbers of the pieces, learning those that are new."""
        if len(self.place) + len(pieces) > REMEMBERED:
            self.forget()
        new = [p for p in dict.fromkeys(pieces) if p not in self.place]
        if new:
            self.learn(new)
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of a string array without nulls."""
        if not self.by_piece:
            each = self.encode_whole(texts.to_pylist())
            return np.array([i for e in each for i in e], np.uint32), np.array([len(e) for e in each], np.int64)
        odd = np.flatnonzero(pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False))
        marked = texts
        for char, cut in ((" ", "\0 "), (",", "\0,"), (".", "\0."), ("\n", "\0\n\0")):
            marked = pc.replace_substring(marked, char, cut)
        split = pc.split_pattern(marked, "\0")
        counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        k = self.look_up(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = self.starts[k + 1] - self.starts[k]
        got, per = self.ids[ranges(self.starts[k], size)], np.diff(starts_of(size)[starts_of(counts)])
        if len(odd):  # cut only at a space behind a printing character
            cut = starts_of(per)
            parts = [got[cut[i]:cut[i + 1]] for i in range(len(per))]
            for i in odd.tolist():
                n = self.look_up(re.split(r"(?<=\S)(?= )", texts[i].as_py()))
                parts[i] = self.ids[ranges(self.starts[n], self.starts[n + 1] - self.starts[n])]
            got, per = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return got, per


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------ operators

def _segment_row(part: int, seq: int, ids: list, counts: list, tokens: np.ndarray) -> pa.RecordBatch:
    p = pack(tokens)
    ints = lambda k: pa.array([p[k]], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array(ids[:1], pa.int64()),
         pa.array([len(tokens)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
         pa.array([counts], pa.list_(pa.int32())), ints("base"), ints("width"), ints("starts"),
         pa.array([p["packed"]], pa.binary()), ints("exception_at"), ints("exception_high")],
        [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, n_ranges: int | None = None) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text), write the segments to the shared folder and return
    the written table. ``n_ranges``: tasks; by default as many as texts fill ``RANGE_BYTES``
    each. ``tokenizer`` is a path that every executor can open."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if n_ranges is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        n_ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, counts, tokens, total = [], [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                piece = b.slice(at, 2048)
                got, n = enc.encode(piece.column(1))
                cut = starts_of(n)
                for k, doc_id in enumerate(piece.column(0).to_pylist()):
                    if total and total + n[k] >= SEGMENT_TOKENS:
                        yield _segment_row(part, seq, ids, counts, np.concatenate(tokens))
                        ids, counts, tokens, total, seq = [], [], [], 0, seq + 1
                    ids.append(doc_id)
                    counts.append(int(n[k]) + 1)
                    tokens += [got[cut[k]:cut[k + 1]], np.array([end_id], np.uint32)]
                    total += counts[-1]
        if ids:
            yield _segment_row(part, seq, ids, counts, np.concatenate(tokens))

    return stored(rows.repartitionByRange(n_ranges, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
                  .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
                  .mapInArrow(run, SEGMENT_SCHEMA), "tokens")


def segment_starts(segments: DataFrame) -> DataFrame:
    """part, seq and the number of ids before each segment. The ranges' order is that of
    their first doc_ids; parts are summed first, so the ordered window sees one row each."""
    first = segments.filter(F.col("seq") == 0).select("part", "first_doc")
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).join(first, "part")
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return segments.select("part", "seq", "n_tokens").join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"))


READ_SCHEMA = "part int, seq int, doc_id long, place long, n_tokens long, ids_crc32 long"


def digest(segments: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 per document. Segments are
    decoded where they are read; only the digests are joined with the segments' starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                seg = {n: b.column(i)[k] for i, n in enumerate(b.schema.names)}
                seg = {n: x.values.to_numpy() if pa.types.is_list(x.type) and n != "doc_ids" else x.as_py()
                       for n, x in seg.items()}
                n = seg["doc_tokens"].astype(np.int64)
                cut = starts_of(n)
                raw = memoryview(unpack(seg, int(cut[-1])).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seg["part"]] * len(n), pa.int32()), pa.array([seg["seq"]] * len(n), pa.int32()),
                     pa.array(seg["doc_ids"], pa.int64()), pa.array(cut[:-1], pa.int64()),
                     pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "place", "n_tokens", "ids_crc32"])

    read = segments.mapInArrow(run, READ_SCHEMA)
    return read.join(segment_starts(segments), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
