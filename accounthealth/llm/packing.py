"""Packed token-id matrices by best-fit-decreasing.

Every text is tokenised with a public byte-level vocabulary (its path is a
parameter) and ended by ``END``. A document longer than a row is cut into
pieces of a row's length and a rest, losslessly. Pieces are dealt to groups of
about ``GROUP_TOKENS`` tokens, and each group is packed by itself: longest
piece first, each into the row with the least room that still takes it, which
a segment tree over the capacities finds in logarithmic time.

A row of the result holds ``ids`` (little-endian unsigned 16-bit, padded with
``END`` to the row's length), ``cu_seqlens`` (cumulative segment lengths from
0), ``positions`` (16-bit, from 0 again at each segment; 0 in the padding),
``n_tokens`` and ``segments`` (identifier, row id, piece, offset and length).

Defined results: null and empty texts are one segment of ``END`` alone. A very
long text is tokenised in slices that give the ids of the whole. Pieces of equal
length go by their row id and piece number; rows that repeat an identifier and a
text share a row id, and each has all its segments. Null identifiers stay null.
An empty table has no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accounthealth.llm.frames import quoted, staged

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EXACT = "/opt/tokenizers/byte_bpe_50k.json"  # the same vocabulary for another library
# Fixed by the vocabulary: how it splits text into words, and its free id.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
ROW = 2048
GROUP_TOKENS = 2_000_000
SLICE = 200_000  # characters tokenised at once, or up to the next place to cut
_BORDER = re.compile(r"[^\W_] (?=[^\W_])")


class CapacityTree:
    """Rows by the room they have left; finds the least room of at least a size."""

    def __init__(self, row: int):
        self.leaves = 1 << row.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows = [[] for _ in range(self.leaves)]

    def _add(self, room: int, change: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += change
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row that takes ``size``, removed from the tree."""
        at = size + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], row: int) -> list[list[int]]:
    """Rows (lists of piece numbers) for pieces given longest first."""
    tree, rows = CapacityTree(row), []
    for k, size in enumerate(lengths):
        hit = tree.take(size)
        if hit is None:
            hit = (row, len(rows))
            rows.append([])
        room, at = hit
        rows[at].append(k)
        if room > size:
            tree.put(room - size, at)
    return rows


def cut(text: str, size: int = SLICE) -> Iterator[str]:
    """Slices whose ids, one after the other, are those of the whole text.

    A cut lies before a space that stands alone between a letter, digit or sign and another
    such character: there every match of the vocabulary's pattern ends, whatever surrounds
    it. A text without such a place stays whole from there on."""
    begin = 0
    while len(text) - begin > size:
        found = _BORDER.search(text, begin + size)
        if found is None:
            break
        at = found.start() + 1
        yield text[begin:at]
        begin = at
    yield text[begin:]


def _ids(model, text: str, content: str) -> np.ndarray:
    """Ids of a slice. The model's regular expressions refuse a very long run of white space;
    the other library reads the same vocabulary and does not."""
    try:
        return model.encode_to_numpy(text, disallowed_special=())
    except ValueError:
        from tokenizers import Tokenizer

        exact = Tokenizer.from_str(content)
        exact.encode_special_tokens = True  # their strings are ordinary text
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def token_pieces(df: DataFrame, id_col: str, text_col: str, ranks_file: str, row: int,
                 exact_file: str = EXACT) -> DataFrame:
    """``id, rid, piece, size, ids`` of every text, cut to rows."""
    with open(ranks_file, "rb") as source, open(exact_file, encoding="utf-8") as other:
        ranks, content = source.read(), other.read()
    shared = df.sparkSession.sparkContext.broadcast((ranks, content))  # a vocabulary

    def run(batches):
        import tiktoken

        ranks, content = shared.value
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        model = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=known,
                                  special_tokens={})
        for batch in batches:
            at, piece, size, ids = [], [], [], []
            for k, text in enumerate(batch.column("text")):
                parts = [_ids(model, s, content) for s in cut(text.as_py() or "")]
                tokens = np.concatenate([*parts, [END]]).astype("<u2")
                for n, lo in enumerate(range(0, len(tokens), row)):
                    at.append(k)
                    piece.append(n)
                    size.append(min(row, len(tokens) - lo))
                    ids.append(tokens[lo:lo + row].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())),
                 batch.column("rid").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(size, pa.int32()), pa.array(ids, pa.binary())],
                names=["id", "rid", "piece", "size", "ids"])

    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("rid"), "text")
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, rid long, piece int, size int, ids binary")


def packed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ranks_file: str = RANKS, row: int = ROW) -> DataFrame:
    """``pack_group, pack_row, n_tokens, ids, cu_seqlens, positions, segments``."""
    pieces = staged(token_pieces(df, id_col, text_col, ranks_file, row), "pieces")
    kind = dict(pieces.dtypes)["id"]
    total = pieces.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-total // GROUP_TOKENS))
    # Exact copies of a text may share a row id: the identifier and piece spread them.
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("rid", "id", "piece"), F.lit(groups)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "rid", "piece"], ascending=[False, True, True],
                                  kind="stable")
        size, ids = frame["size"].tolist(), frame["ids"].tolist()
        name = [None if pd.isna(x) else x for x in frame["id"].tolist()]
        rid, piece = frame["rid"].tolist(), frame["piece"].tolist()
        out = []
        for nth, members in enumerate(best_fit(size, row)):
            lens = [size[k] for k in members]
            ends = np.cumsum([0, *lens])
            tokens = np.full(row, END, "<u2")
            tokens[:ends[-1]] = np.frombuffer(b"".join(ids[k] for k in members), "<u2")
            places = np.zeros(row, "<u2")
            places[:ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], lens)
            out.append({
                "pack_group": int(frame["pack_group"].iloc[0]), "pack_row": nth,
                "n_tokens": int(ends[-1]), "ids": tokens.tobytes(), "cu_seqlens": ends.tolist(),
                "positions": places.tobytes(),
                "segments": [{"id": name[k], "rid": rid[k], "piece": piece[k], "offset": int(a),
                              "size": size[k]} for k, a in zip(members, ends[:-1], strict=True)]})
        return pd.DataFrame(out)

    return dealt.groupBy("pack_group").applyInPandas(
        pack, "pack_group long, pack_row int, n_tokens int, ids binary, cu_seqlens array<int>, "
        f"positions binary, segments array<struct<id:{kind},rid:long,piece:int,offset:int,size:int>>")


def op7_token_packing(spark, sf_dir: str) -> DataFrame:
    return packed_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
