"""Packing pieces of documents into fixed-length sequences by vector bin packing.

Every piece has three demands: tokens, segments and loss-bearing tokens; a sequence has
a limit on each. Sequences are filled one at a time by the dot-product heuristic: of the waiting
pieces that fit in all three dimensions, the one whose demands have the largest dot product
with what the sequence has left, both as shares of the limits, is placed next. So a
sequence short of segments takes long pieces, and one short of loss takes prompts.

Pieces wait in a window of bounded size per task, which is topped up from the input as pieces
are placed; memory does not grow with the input, and nothing is shuffled. What a task cannot fill at its end
is at most a few sequences. Documents that may be cut are cut at the sequence length, and once more where no waiting
piece fits what a sequence has left. Input partitions are fixed by the files read, so
a task that is run again gives the same sequences with the same numbers.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial
from types import MappingProxyType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROUNDING = 1e-9


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold, how many pieces wait per task, and the shortest piece to cut off."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024
    window: int = 4096
    shortest_cut: int = 16


class Filler:
    """Fills sequences from a window of waiting pieces.

    A piece is (tokens, segments, loss, payload). ``cut(payload, tokens)`` splits a piece in two,
    or is None if pieces must stay whole. Sequences come out as lists of (payload, offset).
    """

    def __init__(self, limits: Limits, cut: Callable | None = None):
        self.limits, self.cut = limits, cut
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        places = limits.window + 2
        self.demands = np.zeros((3, places))
        self.payloads: list = [None] * places
        self.free = list(range(places))[::-1]
        self.waiting = 0

    def add(self, tokens: int, segments: int, loss: int, payload) -> None:
        if tokens > self.limits.tokens or segments > self.limits.segments or loss > self.limits.loss_tokens:
            raise ValueError(f"a piece of {tokens} tokens, {segments} segments, {loss} loss tokens fits no sequence")
        slot = self.free.pop()
        self.demands[:, slot] = np.array((tokens, segments, loss)) / self.caps
        self.payloads[slot] = (tokens, segments, loss, payload)
        self.waiting += 1

    def _take(self, slot: int):
        piece = self.payloads[slot]
        self.payloads[slot] = None
        self.demands[:, slot] = 0
        self.free.append(slot)
        self.waiting -= 1
        return piece

    def fill(self) -> list:
        """One sequence, as full as the window allows."""
        left = np.ones(3)
        used, out = 0, []
        while self.waiting:
            tokens_, segments_, loss_ = self.demands
            fits = (tokens_ <= left[0] + _ROUNDING) & (segments_ <= left[1] + _ROUNDING) & (loss_ <= left[2] + _ROUNDING)
            scores = np.where(fits & (tokens_ > 0), left @ self.demands, -1.0)
            slot = int(scores.argmax())
            room = self.limits.tokens - used
            if scores[slot] < 0:
                if not self._cut_to(left, room):
                    break
                continue
            tokens, _, _, payload = self._take_with(slot, left)
            out.append((payload, used))
            used += tokens
            if used == self.limits.tokens:
                break
        return out

    def _take_with(self, slot: int, left: np.ndarray):
        left -= self.demands[:, slot]
        return self._take(slot)

    def _cut_to(self, left: np.ndarray, room: int) -> bool:
        """Cut the longest waiting piece so that its head fits in ``room``; both parts wait."""
        room = min(room, int(left[2] * self.limits.loss_tokens + _ROUNDING))
        if self.cut is None or room < self.limits.shortest_cut or left[1] * self.limits.segments < 1:
            return False
        slot = int(self.demands[0].argmax())
        if self.payloads[slot][0] <= room:
            return False
        for part in self.cut(self._take(slot)[3], room):
            self.add(*part)
        return True


def _fill_all(pieces: Iterator[tuple], limits: Limits, cut: Callable | None) -> Iterator[list]:
    filler = Filler(limits, cut)
    for piece in pieces:
        if piece[0] == limits.tokens:  # full as it is
            yield [(piece[3], 0)]
            continue
        filler.add(*piece)
        while filler.waiting >= limits.window:
            yield filler.fill()
    while filler.waiting:
        yield filler.fill()


def pack_examples(examples: DataFrame, limits: Limits = Limits(), partitions: int | None = None) -> DataFrame:
    """Sequences of whole instruction examples.

    ``examples``: example_id, tokens, segments, loss_tokens (bigint). Returns example_id, sequence_id, offset. An example over
    a limit fails the job, as do nulls in the three counts. Examples of no tokens are left out.
    Rows with equal ids are separate examples.
    """
    rows = examples.select("example_id", "tokens", "segments", "loss_tokens").where(F.col("tokens").isNull() | (F.col("tokens") > 0))
    rows = (rows.repartition(partitions) if partitions else rows).withColumn("part", F.spark_partition_id())

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = [0]

        def pieces():
            for batch in batches:
                part[0] = int(batch["part"].iloc[0]) if len(batch) else part[0]
                for row in batch.itertuples(index=False):
                    yield int(row.tokens), int(row.segments), int(row.loss_tokens), row.example_id

        out = []
        for number, sequence in enumerate(_fill_all(pieces(), limits, None)):
            out += [(payload, (part[0] << 33) + number, offset) for payload, offset in sequence]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["example_id", "sequence_id", "offset"])
                out = []
        yield pd.DataFrame(out, columns=["example_id", "sequence_id", "offset"])

    # As text, since pandas would turn whole numbers beside nulls into doubles.
    kind = examples.schema["example_id"].dataType
    named = rows.withColumn("example_id", F.col("example_id").cast("string"))
    found = named.mapInPandas(work, "example_id string, sequence_id bigint, offset bigint")
    return found.withColumn("example_id", F.col("example_id").cast(kind))


# ---- documents

def _encoder(ranks_path: str, pattern: str, specials: Mapping[str, int]) -> Callable[[str], list[int]]:
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(specials))
    return partial(encoding.encode, allowed_special="all") if specials else encoding.encode_ordinary


def special_tokens(tokenizer_path: str) -> dict[str, int]:
    """Spelling and id of the special tokens in a ``tokenizers`` file."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", ()) if t.get("special")}


def pack_documents(
    docs: DataFrame, ranks_path: str, pattern: str, limits: Limits = Limits(), specials: Mapping[str, int] = MappingProxyType({})
) -> DataFrame:
    """Token sequences of all documents.

    ``ranks_path`` is a rank file of a byte-level vocabulary, present on every executor, and ``pattern`` the pattern
    its pre-tokens are split by. The spelling of a token in ``specials`` becomes its id; without them it is ordinary text. A document is
    its text's ids, then id 0. It is cut at the sequence length; a shorter rest is one piece. The loss-bearing
    tokens of a piece are all but its first, which nothing predicts.

    Returns one row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32 bit), doc_tokens,
    sequence_id, offset. Null and empty texts are the one id 0. Rows with equal or null doc_id are separate documents.
    Other columns are not looked at. An empty table gives no pieces.
    """
    # Ids go as text, since pandas would turn whole numbers beside nulls into doubles.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").withColumn("part", F.spark_partition_id())
    specials = dict(specials)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(ranks_path, pattern, specials)
        part = [0]

        def piece(doc_id, start: int, data: bytes, total: int) -> tuple:
            length = len(data) // 4
            return length, 1, length - 1, (doc_id, start, data, total)

        def cut(payload: tuple, tokens: int) -> list[tuple]:
            doc_id, start, data, total = payload
            return [
                piece(doc_id, start, data[: 4 * tokens], total),
                piece(doc_id, start + tokens, data[4 * tokens :], total),
            ]

        def pieces():
            for batch in batches:
                part[0] = int(batch["part"].iloc[0]) if len(batch) else part[0]
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    data = np.array([*encode(text or ""), 0], dtype="<u4").tobytes()
                    total = len(data) // 4
                    for start in range(0, total, limits.tokens):
                        yield piece(doc_id, start, data[4 * start : 4 * (start + limits.tokens)], total)

        columns = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
        out: list[tuple] = []

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=columns)
            made.insert(2, "length", [len(row[2]) // 4 for row in out])
            return made

        for number, sequence in enumerate(_fill_all(pieces(), limits, cut)):
            out += [(*payload, (part[0] << 33) + number, offset) for payload, offset in sequence]
            if len(out) > 2_000:
                yield frame()
                out.clear()
        yield frame()

    schema = (
        "doc_id string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return rows.mapInPandas(work, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))


