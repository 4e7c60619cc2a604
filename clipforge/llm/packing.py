"""Best-fit packing of tokenised documents into fixed-length sequences.

Hierarchical residual packing: every task tokenises its documents, cuts long
ones, and packs its pieces best-fit decreasing. Bins that are nearly full are
final. The underfull bins become items of the next round, in which up to
``FAN_IN`` tasks' bins meet in one task and are packed best-fit again, until one
group is left. A bin keeps its content in order, so a piece's place is the sum
of the offsets on its way up.

What moves between rounds is one small row per underfull bin. After best fit no
two bins of a task fit together, so all but one of them are over half full and
could only take one of the few small bins of other tasks; a task passes on its
``CARRY`` emptiest underfull bins and closes the rest as they are (no piece is
ever left out).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import stored

CAPACITY = 1024
END_ID = 2
#: A bin with at most this many free places is final.
SLACK = 4
FAN_IN = 16
CARRY = 4096

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "bin long, offset long, fill long, task int, carried boolean")
MOVED = "bin long, into long, at long, fill long, carried boolean"

_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a byte-level BPE vocabulary file, once per worker process.
    Ranks are read from the ``tokenizers`` JSON file and run by tiktoken, which gives
    the same ids several times faster; strings of its added tokens are one id each."""
    if path not in _ENCODERS:
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        vocab, added = whole["model"]["vocab"], {t["content"]: t["id"] for t in whole["added_tokens"]}
        # The byte-level alphabet: printable bytes stand for themselves, the others
        # for the code points from 256 on, in order.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}
        ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in added and all(c in chars for c in token)}
        _ENCODERS[path] = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and offset, and each bin's fill.

    The rooms of open bins are the set bits of one integer, so the tightest bin that
    fits is the lowest set bit from the item's size on."""
    at, off, room_of = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            b, room = len(room_of), capacity
            room_of.append(capacity)
        at[i], off[i] = b, capacity - room
        room -= size
        room_of[b] = room
        if room:
            if not open_bins[room]:
                rooms |= 1 << room
            open_bins[room].append(b)
    return at, off, capacity - np.array(room_of, np.int64)


def carry_mask(fill: np.ndarray, capacity: int, carry: int = CARRY) -> np.ndarray:
    """The emptiest ``carry`` bins among those with more than ``SLACK`` free places.

    More would save no sequence. Best fit leaves at most one bin of a task at or under half
    full (the items of a second one would have gone into the first), and two bins over half
    full never share a sequence. So a merge of FAN_IN tasks joins at most FAN_IN bins to
    others, and for each of them the emptiest bins are room enough; what stays behind is
    over half full and could only have taken one of those few."""
    mask = np.zeros(len(fill), bool)
    order = np.argsort(fill, kind="stable")[:carry]
    mask[order[fill[order] < capacity - SLACK]] = True
    return mask


def _pieces(tokenizer: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_to_numpy
        docs, piece, start, length, crc = [], [], [], [], []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or "", allowed_special="all"), np.uint32(END_ID)).astype("<u4")
                n = len(ids)
                first = n % capacity or capacity
                for k, s in enumerate([0, *range(first, n, capacity)]):
                    e = first if k == 0 else s + capacity
                    docs.append(doc)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[s:e].tobytes()))
        if not docs:
            return
        task = TaskContext.get().partitionId()
        sizes = np.array(length, np.int64)
        at, off, fill = best_fit(sizes, capacity)
        carried = carry_mask(fill, capacity)
        base = task << 32
        for s in range(0, len(docs), 50_000):
            e = s + 50_000
            yield pa.RecordBatch.from_arrays([
                pa.array(docs[s:e], pa.int64()), pa.array(piece[s:e], pa.int32()), pa.array(start[s:e], pa.int64()),
                pa.array(sizes[s:e]), pa.array(crc[s:e], pa.int64()), pa.array(base + at[s:e]), pa.array(off[s:e]),
                pa.array(fill[at[s:e]]), pa.array(np.full(len(at[s:e]), task, np.int32)), pa.array(carried[at[s:e]]),
            ], ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill", "task", "carried"])
    return run


def _merge(capacity: int, level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", kind="stable")
        at, off, fill = best_fit(pdf["fill"].to_numpy(), capacity)
        group = int(pdf["group"].iloc[0])
        into = (np.int64(level) << 56) + (np.int64(group) << 32) + at
        return pd.DataFrame({"bin": pdf["bin"].to_numpy(), "into": into, "at": off, "fill": fill[at],
                             "carried": carry_mask(fill, capacity)[at]})
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are its tokens and then the end id; null text is empty (one
    piece of one id). Only documents over ``capacity`` are cut: the first piece takes
    the remainder, the others are full. Repeated rows and null ids are documents of
    their own. No rows in, no rows out. ``tokenizer`` is the path of a ``tokenizers``
    JSON file that every worker can read."""
    path = tokenizer or default_tokenizer()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = stored(src.mapInArrow(_pieces(path, capacity), PIECES), "pieces")

    items = (pieces.where("carried").groupBy("bin").agg(F.max("fill").alias("fill"), F.max("task").alias("group")))
    tasks = (pieces.agg(F.max("task")).first()[0] or 0) + 1
    places = None  # bin of the first round -> bin and offset so far
    level = 0
    while tasks > 1:
        level, tasks = level + 1, -(-tasks // FAN_IN)
        items = items.withColumn("group", F.floor(F.col("group") / FAN_IN).cast("int"))
        moved = stored(items.groupBy("group").applyInPandas(_merge(capacity, level), MOVED), "bins")
        places = (moved.select("bin", "into", "at") if places is None else
                  places.join(moved.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("at").alias("more")), "into", "left")
                  .select("bin", F.coalesce("next", "into").alias("into"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at")))
        items = (moved.where("carried").groupBy(F.col("into").alias("bin"))
                 .agg(F.max("fill").alias("fill"))
                 .withColumn("group", F.shiftright(F.col("bin"), 32).bitwiseAND(F.lit((1 << 24) - 1)).cast("int")))
    if places is not None:
        pieces = pieces.join(places, "bin", "left")
    else:
        pieces = pieces.withColumns({"into": F.lit(None).cast("long"), "at": F.lit(None).cast("long")})
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32",
                         F.coalesce("into", "bin").alias("sequence_id"),
                         (F.col("offset") + F.coalesce("at", F.lit(0).cast("long"))).alias("offset"))
