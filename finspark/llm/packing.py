"""Vector best-fit packing of tokenised documents (operator 8).

A document is tokenised whole, ended by one end id, and cut only when longer
than a sequence (the first piece takes the remainder). Pieces are packed by
best fit on a vector of capacities - tokens, pieces and attention cost (sum
of squared lengths) - in order of falling length: of the open sequences that
fit under EVERY capacity, the one with the largest weighted dot product of
residual and demand (``rule='dot'``) or the smallest weighted residual norm
after placing (``rule='norm'``) takes the piece.

Packing runs on shards of about ``shard_rows`` documents, their pieces dealt
by a hash, so memory and time of a task do not grow with the corpus; each
shard wastes a fraction of one sequence, which is a share of 1/thousands.
Only lengths and checksums move between tasks unless ids are asked for.

Defined results: null or empty text = the end id alone; repeated rows and
rows without an id are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices

END_ID = 0
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Texts of these characters alone go through the faster encoder: Latin
#: letters, and common marks. In others the two libraries' Unicode tables
#: might differ.
LATIN = re.compile("[\x00-\u024f\u2010-\u2027]*").fullmatch
#: How byte-level BPE files of this kind split a text (fixed value).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones for themselves, the others in order from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def fast_encoder(spec: dict):
    """The tokenizer of a file as a tiktoken encoding, or None where it is
    anything but byte-level BPE whose merges are in the order of their ids."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or spec.get("normalizer") or spec.get("truncation") or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))):
        return None
    import tiktoken

    added = spec.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    special = {t["content"]: t["id"] for t in added}
    table = byte_of()
    try:
        ranks = {bytes(table[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [ranks[bytes(table[c] for c in a + b)] for a, b in pairs]
    except KeyError:
        return None
    if any(x >= y for x, y in zip(merged, merged[1:])) or len(ranks) != 256 + len(merged):
        return None
    return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Ids of whole texts from the tokenizer file, as little-endian unsigned
    32-bit bytes. Latin texts go through a faster reader of the same
    vocabulary and merges (tests hold its ids against the tokenizer's)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = fast_encoder(json.loads(Path(path).read_text("utf-8")))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.ids(t) if t else b"" for t in texts]

    def ids(self, text: str) -> bytes:
        if self.fast is not None and LATIN(text):
            ids = self.fast.encode(text, allowed_special="all", disallowed_special=())
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only longer ones are cut."""
    first = n % size or size
    return [(0, n)] if n <= size else [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, tokenizer_path: str, size: int, keep_ids: bool = False) -> DataFrame:
    """One row per piece of every document, with the ids themselves (bytes)
    when ``keep_ids``."""
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
             ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if keep_ids else [])
    schema = pa.schema(kinds)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            for part in slices(batch):
                rows: list[list] = [[] for _ in schema]
                for i, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text").to_pylist())):
                    ids += end
                    for k, (a, n) in enumerate(cuts(len(ids) // 4, size)):
                        own = ids[4 * a:4 * (a + n)]
                        for c, v in zip(rows, (i, k, a, n, zlib.crc32(own), own)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return docs.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


def best_fit(lengths: np.ndarray, tokens: int, most_pieces: int, attention: float, rule: str,
             weights: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, packed in order of falling length."""
    caps = np.array([tokens, most_pieces, attention], float)
    w = np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    smallest = np.minimum.accumulate(lengths[order][::-1])[::-1] if len(lengths) else lengths
    res, names = np.empty((3, len(lengths) + 1)), np.empty(len(lengths) + 1, np.int64)
    n_open = n_bins = 0
    for step, i in enumerate(order):
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        at = -1
        if n_open:
            left = res[:, :n_open] - need[:, None]
            fits = np.flatnonzero((left >= 0).all(axis=0))
            if len(fits):
                if rule == "dot":
                    score = -((w * need / caps ** 2) @ res[:, fits])
                else:
                    score = w @ (left[:, fits] / caps[:, None]) ** 2
                at = fits[np.argmin(score)]
        if at < 0:
            at = n_open
            res[:, at], names[at] = caps, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        place[i], offset[i] = names[at], tokens - int(res[0, at])
        res[:, at] -= need
        # Close what no later piece can enter.
        if step + 1 < len(order) and (res[0, at] < smallest[step + 1] or res[1, at] < 1
                                      or res[2, at] < float(smallest[step + 1]) ** 2):
            n_open -= 1
            res[:, at], names[at] = res[:, n_open], names[n_open]
    return place, offset


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, most_pieces: int | None = None,
         attention: float | None = None, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6),
         shard_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
         wanted_pieces: int | None = None) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. ``most_pieces`` (per
    sequence) and ``attention`` (sum of squared lengths) default to values
    that the token capacity implies, so they bind only when set.
    ``wanted_pieces`` is a capacity that gives way: it binds in a shard
    unless the shard takes fewer sequences without it."""
    if rule not in ("dot", "norm"):
        raise ValueError(f"rule {rule!r}: dot or norm")
    attention = float(size) ** 2 if attention is None else float(attention)
    most_pieces = size if most_pieces is None else most_pieces
    piece_size = min(size, int(attention ** 0.5))  # a piece must fit alone
    cut = pieces(id_text(docs, id_col, text_col), tokenizer_path, piece_size, keep_ids)
    shards = max(1, -(-docs.count() // shard_rows))
    # Dealt by piece and place, so that many rows of one id (or without any) are spread.
    of = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    cut = cut.withColumn("_shard", F.pmod(of, F.lit(shards)).cast("int"))

    def group(key, table):
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        lengths = table.column("length").to_numpy()
        most = most_pieces if wanted_pieces is None else min(wanted_pieces, most_pieces)
        place, offset = best_fit(lengths, size, most, attention, rule, weights)
        if most < most_pieces and place.max(initial=-1) + 1 > -(-int(lengths.sum()) // size):
            loose = best_fit(lengths, size, most_pieces, attention, rule, weights)
            if loose[0].max(initial=-1) < place.max(initial=-1):
                place, offset = loose
        return table.drop_columns("_shard").append_column(
            "sequence_id", pa.array((key[0].as_py() << 32) + place)).append_column("offset", pa.array(offset))

    out = PIECES + (", ids binary" if keep_ids else "") + ", sequence_id bigint, offset bigint"
    return cut.groupBy("_shard").applyInArrow(group, out)
